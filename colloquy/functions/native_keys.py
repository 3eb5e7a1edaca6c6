"""Canonical equality keys without Python, for texts proved simple.

Each step adds the columns ``<out>_known`` and ``<out>_key``. Where the first holds, the key
equals what ``canonical`` writes for the text (null: no object there); elsewhere the text
has to go through Python. Parts that are used several times are columns of their own, so
that Catalyst works them out once a row. A text counts as simple only if every form it uses means the same to both
readers; whatever is in doubt is left unknown.

* Envelopes: strings of printable ASCII without quotes, backslashes or braces, whole
  numbers of at most 15 digits, objects and lists, and keys whose order is the same
  quoted or not. They are read as VARIANT, which refuses repeated keys and broken JSON.
* Semantic sections: one key over an indented mapping of plain words and whole numbers,
  all keys different and none of them a YAML word of another kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CONTAINERS = 500  # far from any reader's limit of depth

# Classes name their characters one by one: Java looks those up in a table, ranges it tries in turn.
_CHARS = "".join(chr(c) for c in range(32, 127) if chr(c) not in '"\\{}')
_NUMBER = r"[ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.+\-]"
_STRING = '"[' + "".join(f"\\{c}" if c in "[]^&-" else c for c in _CHARS) + ']*"'
_WHOLE = f"(?<!{_NUMBER})-?(?:0|[123456789][0123456789]{{0,14}})(?!{_NUMBER})"
_SPACED_KEY = r'"[^" !]*[ !][^"]*+"\s*:'

# Plain words that YAML 1.1 reads as something else than text.
_TRUE = ("yes", "Yes", "YES", "true", "True", "TRUE", "on", "On", "ON")
_FALSE = ("no", "No", "NO", "false", "False", "FALSE", "off", "Off", "OFF")
_NULL = ("null", "Null", "NULL")


def envelope(df: DataFrame, tail: Column, out: str) -> DataFrame:
    """Key of the object that ``tail`` (null, or a text from its first ``{``) begins with."""
    t, body, bare, key = (f"{out}_{c}" for c in ("tail", "body", "bare", "key"))
    df = df.withColumn(t, tail)
    df = df.withColumn(body, F.regexp_extract(t, r"(?s)^\{.*\}", 0))
    df = df.withColumn(bare, F.regexp_replace(F.regexp_replace(body, _STRING, "s"), _WHOLE, "n"))
    containers = F.length(bare) - F.length(F.translate(bare, "[{", ""))  # no more than there are signs
    simple = (
        F.col(bare).rlike(r"^[{}\[\]:, \n\t\rsn]+$") & ((F.length(bare) <= MAX_CONTAINERS) | (containers <= MAX_CONTAINERS))
        & ~F.col(body).rlike(_SPACED_KEY) & ~(F.col(body).contains("-0") & F.col(body).rlike(r"-0(?![0-9])"))
    )
    df = df.withColumn(key, F.when(simple, F.to_json(F.try_parse_json(body))))
    # without a closing brace there is no object at all
    known = F.col(key).isNotNull() | F.col(t).isNull() | ~F.col(t).contains("}")
    return df.withColumn(f"{out}_known", known).drop(t, body, bare)


def semantic(df: DataFrame, section: Column, out: str) -> DataFrame:
    """Key of a PASS_3 section (null, or stripped of blank lines at both ends)."""
    t, lines, rest, head, key = (f"{out}_{c}" for c in ("section", "lines", "rest", "head", "key"))
    other = [*_TRUE, *_FALSE, *_NULL]
    name = lambda line: F.substr(F.substring_index(line, ":", 1), F.lit(3))  # noqa: E731  (of lines that fit)
    fits = lambda line: line.rlike(r"^  [A-Za-z_]{1,64}: (?:[A-Za-z]+|0|[1-9][0-9]{0,14})\z") & ~name(line).isin(other)

    def written(line: Column) -> Column:
        v = F.substring_index(line, " ", -1)
        text = (
            F.when(v.isin(*_TRUE), "1").when(v.isin(*_FALSE), "0").when(v.isin(*_NULL), "null")
            .when(v < ":", v).otherwise(F.concat(F.lit('"'), v, F.lit('"')))
        )
        return F.concat(F.lit('"'), name(line), F.lit('":'), text)

    df = df.withColumn(t, section)
    df = df.withColumn(lines, F.split(t, "\n"))
    df = df.withColumns({head: F.regexp_extract(F.get(lines, 0), r"^([A-Za-z_]{1,64}):\z", 1), rest: F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))})
    simple = (F.col(head) != "") & ~F.col(head).isin(other) & (F.size(rest) > 0) & F.forall(rest, fits)
    distinct = F.size(F.array_distinct(F.transform(rest, name))) == F.size(rest)
    text = F.concat(F.lit('{"'), F.col(head), F.lit('":{'), F.array_join(F.array_sort(F.transform(rest, written)), ","), F.lit("}}"))
    df = df.withColumn(key, F.when(simple & distinct, text))
    return df.withColumn(f"{out}_known", F.col(key).isNotNull() | F.col(t).isNull()).drop(t, lines, rest, head)
