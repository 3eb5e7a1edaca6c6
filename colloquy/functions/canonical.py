"""Strict JSON / YAML parsing and canonical equality keys (Arrow-batched Python).

Catalyst cannot reproduce Python's value equality for parsed documents: key order
free, ``1 == 1.0 == True``, duplicate keys last-wins, ``NaN`` accepted, trailing text
rejected, YAML 1.1 scalars. These helpers turn a parsed document into one canonical
JSON string so that equality of strings equals Python equality of values. They run
inside ``pandas_udf`` batches; Spark partitions the rows and the UDF never sees more
than one Arrow batch at a time.
"""

from __future__ import annotations

import base64
import datetime as _dt
import json
import math
import re
from typing import Any, Optional

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:
    import yaml as _yaml
except ImportError:  # reported where a YAML section would have to be read
    _yaml = None

_SURROGATE = re.compile("[\ud800-\udfff]")


def escape_surrogates(text: str) -> str:
    """``text`` with lone surrogates (no UTF-8 form) spelt as backslash, u and four digits."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def yaml_loader() -> type:
    """The safe YAML loader (libyaml's when present); without a YAML library this raises."""
    if _yaml is None:
        raise RuntimeError("reading PASS_3 needs the yaml library on the driver and on every executor")
    return getattr(_yaml, "CSafeLoader", None) or _yaml.SafeLoader


class _Open:
    """A container being written: its remaining pieces and closing bracket."""

    __slots__ = ("close", "ident", "items")

    def __init__(self, ident: int, items: Any, close: str):
        self.ident, self.items, self.close = ident, items, close


def _scalar(value: Any) -> Optional[str]:
    """Canonical text of a value that holds no others; ``None`` for containers.

    What JSON has no form for is written outside JSON's grammar (``@kind(...)``), so no
    parsed mapping or string can have the same text.
    """
    if value is None or isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, bool):
        return str(int(value))  # True == 1
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return str(int(value)) if math.isfinite(value) and value.is_integer() else json.dumps(value)  # 1.0 == 1
    if isinstance(value, (_dt.datetime, _dt.date)):
        return f"@date({value.isoformat()})"
    if isinstance(value, bytes):
        return f"@bytes({base64.b64encode(value).decode('ascii')})"
    if isinstance(value, (dict, list, tuple, set, frozenset)):
        return None
    return f"@{type(value).__name__}({json.dumps(str(value), ensure_ascii=False)})"


def _pieces(value: Any) -> tuple[str, Any, str]:
    """Opening text, (prefix, child) pairs and closing text of a container."""
    if isinstance(value, dict):
        keyed = sorted(((canonical_json(k), v) for k, v in value.items()), key=lambda x: x[0])
        return "{", ((f"{',' if i else ''}{k}:", v) for i, (k, v) in enumerate(keyed)), "}"
    if isinstance(value, (set, frozenset)):
        texts = sorted(canonical_json(v) for v in value)
        return "@set(" + ",".join(texts), iter(()), ")"
    return "[", (("," if i else "", v) for i, v in enumerate(value)), "]"


def canonical_json(value: Any) -> str:
    """Canonical text of a parsed value: sorted keys, no spaces, integral floats as ints.

    Written with a stack of its own, so depth is no limit; a value that contains itself
    raises ``ValueError``.
    """
    out: list[str] = []
    stack: list[_Open] = []
    path: set[int] = set()

    def put(v: Any) -> None:
        text = _scalar(v)
        if text is not None:
            out.append(text)
            return
        if id(v) in path:
            raise ValueError("a value that contains itself has no canonical form")
        path.add(id(v))
        start, items, close = _pieces(v)
        out.append(start)
        stack.append(_Open(id(v), items, close))

    put(value)
    while stack:
        top = stack[-1]
        step = next(top.items, None)
        if step is None:
            out.append(top.close)
            path.discard(top.ident)
            stack.pop()
        else:
            out.append(step[0])
            put(step[1])
    return escape_surrogates("".join(out))


_BRACE = re.compile(r"[{}]")


def envelope_slice(text: str) -> Optional[str]:
    """Text from the first ``{`` after the first ``PASS_4`` to its depth-matched ``}``.

    Brace counting is deliberately not string-aware: a brace inside a JSON string
    shifts the match, exactly like the behaviour being reproduced.
    """
    marker = text.find("PASS_4")
    if marker < 0:
        return None
    start = text.find("{", marker)
    if start < 0:
        return None
    depth = 0
    for m in _BRACE.finditer(text, start):
        depth += 1 if m.group() == "{" else -1
        if depth == 0:
            return text[start : m.end()]
    return None


def _balanced_prefix(tail: str) -> Optional[str]:
    """``tail`` starts at ``{``: the prefix up to its depth-matched ``}``."""
    depth = 0
    for m in _BRACE.finditer(tail):
        depth += 1 if m.group() == "{" else -1
        if depth == 0:
            return tail[: m.end()]
    return None


def _load_object(candidate: Optional[str]) -> Optional[dict]:
    if candidate is None:
        return None
    try:
        value = json.loads(candidate)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def parse_envelope(text: Optional[str]) -> Optional[dict]:
    return None if text is None else _load_object(envelope_slice(text))


def parse_envelope_tail(tail: Optional[str]) -> Optional[dict]:
    """Envelope from a text that already starts at the first ``{`` after ``PASS_4``."""
    return None if tail is None else _load_object(_balanced_prefix(tail))


def parse_semantic(section: Optional[str]) -> Optional[dict]:
    if not section:
        return None
    loader = yaml_loader()
    try:
        value = _yaml.load(section, Loader=loader)
    except Exception:  # any text that is not YAML
        return None
    return value if isinstance(value, dict) else None


def _canon_or_none(value: Any) -> Optional[str]:
    """Canonical text, null for what has none (absent, or containing itself)."""
    try:
        return None if value is None else canonical_json(value)
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def envelope_key(text: pd.Series) -> pd.Series:
    """Canonical PASS_4 envelope of each reply, null when absent or unparseable."""
    return pd.Series([_canon_or_none(parse_envelope(t)) for t in text], dtype=object)


@F.pandas_udf(T.StringType())
def semantic_key(section: pd.Series) -> pd.Series:
    """Canonical PASS_3 YAML mapping of each section, null when not a mapping."""
    return pd.Series([_canon_or_none(parse_semantic(s)) for s in section], dtype=object)


_KEYS_TYPE = T.StructType([T.StructField("semantic", T.StringType()), T.StructField("envelope", T.StringType())])


@F.pandas_udf(_KEYS_TYPE)
def structured_keys(envelope_tail: pd.Series, pass3: pd.Series) -> pd.DataFrame:
    """PASS_3 and PASS_4 canonical keys in one Arrow round trip.

    ``envelope_tail`` is the reply from the first ``{`` after ``PASS_4`` (cut natively,
    so only that part crosses into Python).
    """
    return pd.DataFrame(
        {
            "semantic": [None if s is None else _canon_or_none(parse_semantic(s)) for s in pass3],
            "envelope": [None if t is None else _canon_or_none(parse_envelope_tail(t)) for t in envelope_tail],
        }
    )
