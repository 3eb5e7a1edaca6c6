"""Python-compatible string helpers as Catalyst Columns.

Python's ``str.strip()`` and ``str.splitlines()`` use the Unicode whitespace and line
boundary sets; Spark's ``trim`` only removes spaces. These builders reproduce the
Python behaviour with Java regular expressions so they stay inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.isspace() set is Unicode White_Space plus the four
# information separators U+001C..U+001F; str.splitlines() boundaries are
# \r\n, \n, \x0b, \x0c, \r, \x1c, \x1d, \x1e, \x85, U+2028, U+2029.
_WS = r"[\s\x{1c}-\x{1f}]"
STRIP_PATTERN = r"(?U)^" + _WS + r"+|" + _WS + r"+$"
LINE_SPLIT_PATTERN = r"\r\n|[\n\x{0b}\x{0c}\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
TOKEN_PATTERN = r"[^ \t\n\r]+"
# The same whitespace set as characters, derived from Python itself (29 code points,
# all below U+3001); ``btrim`` with a character set avoids a regex per call.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()`` with Python's whitespace set."""
    return F.btrim(col_of(c), F.lit(PY_WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """True for null, empty or whitespace-only text (Python: ``not s or not s.strip()``)."""
    c = col_of(c)
    return c.isNull() | (py_strip(c) == F.lit(""))


def strip_newlines(c: Column | str) -> Column:
    """``str.strip('\\n')``."""
    return F.btrim(col_of(c), F.lit("\n"))


def splitlines(c: Column | str) -> Column:
    """``str.splitlines()`` up to a trailing empty element (callers drop blanks)."""
    return F.split(col_of(c), LINE_SPLIT_PATTERN)


def whitespace_tokens(c: Column | str) -> Column:
    """Default native token count: runs of characters other than space, tab, CR, LF."""
    c = col_of(c)
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN_PATTERN)), F.lit(0)).cast("bigint")


def locate_from(substr: str, c: Column, pos: Column) -> Column:
    """1-based ``locate(substr, c, pos)`` with a Column position (0 when absent)."""
    return F.call_function("locate", F.lit(substr), c, pos)
