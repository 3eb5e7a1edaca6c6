"""Five-section reply parsing and scoring as Columns.

A reply carries markers ``PASS_0`` .. ``PASS_4``. Sections 0-2 are parsed with native
string/array expressions; sections 3 (YAML) and 4 (JSON envelope) become canonical
equality keys through one Arrow-batched UDF. ``with_parsed_reply`` adds one struct
column (sections and line arrays as staged projections), so a reply is parsed exactly
once per plan and every score reads that struct; ``parse_reply`` is the equivalent
single-expression form for small inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import native_keys
from colloquy.functions.canonical import envelope_key, semantic_key, structured_keys, yaml_loader
from colloquy.functions.text import PY_WHITESPACE, col_of, locate_from, py_strip, splitlines, strip_newlines

# Section markers and the literal header line each section may start with.
PASS_NAMES = ("PASS_0", "PASS_1", "PASS_2", "PASS_3", "PASS_4")
HEADERS = {"PASS_0": "Normalization", "PASS_1": "Lexical Detection", "PASS_2": "Intent"}
NONE_LINE = "(none)"
ARROW_LINE = "↓"
MARKER = "PASS_"  # what all names begin with
ODD_BREAKS = r"[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"  # line boundaries other than \n

PAIRS_TYPE = "array<struct<src:string,dst:string>>"
PARSED_TYPE = (
    "struct<norm:array<struct<src:string,dst:string>>,lexemes:array<string>,"
    "intent:string,semantic:string,envelope:string>"
)


def section(text: Column | str, name: str) -> Column:
    """Text after the first ``name`` marker up to the earliest other marker, ``\\n``-stripped."""
    t = col_of(text)
    pos = F.instr(t, name)
    body_start = pos + F.lit(len(name))
    ends = [F.nullif(locate_from(other, t, body_start), F.lit(0)) for other in PASS_NAMES if other != name]
    end = F.coalesce(F.least(*ends), F.length(t) + 1)
    return F.when(pos > 0, strip_newlines(t.substr(body_start, end - body_start)))


def _stripped_lines(sec: Column) -> Column:
    """Non-blank lines of a section, each stripped; a pattern splits only where ``\\n`` alone doesn't do."""
    lines = F.when(sec.rlike(ODD_BREAKS), splitlines(sec)).otherwise(F.split(sec, "\n"))
    return F.filter(F.transform(lines, lambda ln: py_strip(ln)), lambda ln: ln != F.lit(""))


def _drop_header(lines: Column, header: str) -> Column:
    n = F.size(lines)
    return F.when((n > 0) & (F.get(lines, 0) == F.lit(header)), F.slice(lines, F.lit(2), n - 1)).otherwise(lines)


def section_lines(sec: Column, header: str) -> Column:
    """Stripped non-blank lines of a section, minus a first line equal to ``header``."""
    return _drop_header(_stripped_lines(sec), header)


def _norm_from_lines(sec: Column, lines: Column) -> Column:
    n = F.size(lines)
    groups = F.sequence(F.lit(0), F.floor(n / 3).cast("int") - 1)
    arrows_ok = F.forall(groups, lambda i: F.get(lines, i * 3 + 1) == F.lit(ARROW_LINE))
    pairs = F.transform(
        groups, lambda i: F.struct(F.get(lines, i * 3).alias("src"), F.get(lines, i * 3 + 2).alias("dst"))
    )
    return (
        F.when(sec.isNull(), F.lit(None).cast(PAIRS_TYPE))
        .when((n == 0) | (F.get(lines, 0) == F.lit(NONE_LINE)), F.array().cast(PAIRS_TYPE))
        .when(n % 3 != 0, F.lit(None).cast(PAIRS_TYPE))
        .when(arrows_ok, pairs)
    )


def _lexeme(line: Column) -> Column:
    """What a stripped line ``- "..."`` holds between its outer quotes, null for other lines."""
    rest = F.ltrim(F.substr(line, F.lit(2)), F.lit(PY_WHITESPACE))
    quoted = line.startswith("-") & rest.startswith('"') & rest.endswith('"') & (F.length(rest) >= 2)
    return F.when(quoted, F.substr(rest, F.lit(2), F.length(rest) - 2))


def _all_or_none(lexemes: Column) -> Column:
    return F.when(F.forall(lexemes, lambda x: x.isNotNull()), lexemes)


def _intent_from_lines(sec: Column, lines: Column) -> Column:
    return F.when(sec.isNotNull() & (F.size(lines) == 1), F.get(lines, 0))


def parse_normalizations(text: Column | str) -> Column:
    sec = section(text, "PASS_0")
    return _norm_from_lines(sec, section_lines(sec, HEADERS["PASS_0"]))


def parse_lexemes(text: Column | str) -> Column:
    sec = section(text, "PASS_1")
    return _all_or_none(F.transform(section_lines(sec, HEADERS["PASS_1"]), _lexeme))


def parse_intent(text: Column | str) -> Column:
    sec = section(text, "PASS_2")
    return _intent_from_lines(sec, section_lines(sec, HEADERS["PASS_2"]))


def parse_semantic(text: Column | str) -> Column:
    return semantic_key(section(text, "PASS_3"))


def parse_envelope(text: Column | str) -> Column:
    return envelope_key(col_of(text))


def with_envelope(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the canonical envelope key of column ``text``; only texts that are not simple go through Python."""
    t, tmp = F.col(text), f"_{out}"
    df = df.withColumn(f"{tmp}_at", F.locate("PASS_4", t))
    df = df.withColumn(f"{tmp}_from", F.when(F.col(f"{tmp}_at") > 0, locate_from("{", t, F.col(f"{tmp}_at"))))
    df = native_keys.envelope(df, F.when(F.col(f"{tmp}_from") > 0, F.substr(t, F.col(f"{tmp}_from"))), tmp)
    known = F.col(f"{tmp}_known")
    key = F.when(known, F.col(f"{tmp}_key")).otherwise(envelope_key(F.when(~known, t)))
    return df.withColumn(out, key).drop(*[f"{tmp}_{c}" for c in ("at", "from", "key", "known")])


# Parser registry: section name -> Column builder over the reply text. Callers may add
# or replace entries; parsing, scores and accuracy rows follow this mapping.
PASS_PARSERS: dict[str, Callable[[Column | str], Column]] = {
    "PASS_0": parse_normalizations,
    "PASS_1": parse_lexemes,
    "PASS_2": parse_intent,
    "PASS_3": parse_semantic,
    "PASS_4": parse_envelope,
}
_OWN_PARSERS = dict(PASS_PARSERS)
PARSED_FIELDS = {"PASS_0": "norm", "PASS_1": "lexemes", "PASS_2": "intent", "PASS_3": "semantic", "PASS_4": "envelope"}


def field_of(name: str) -> str:
    """Field of the parsed struct that holds section ``name``."""
    return PARSED_FIELDS.get(name, name.lower())


def parse_reply(text: Column | str) -> Column:
    """All five sections of one reply as a struct (single expression form).

    Convenient for small inputs; ``with_parsed_reply`` is the staged form that keeps
    each section and line array computed once per row.
    """
    return F.struct(*[parser(text).alias(field_of(p)) for p, parser in PASS_PARSERS.items()])


def _sections(t: Column, names: tuple[str, ...]) -> Column:
    """``section`` of each name as one array, for texts with markers in any order and number."""

    def one(name: Column) -> Column:
        pos = F.call_function("locate", name, t)
        start = pos + F.length(name)
        others = F.filter(F.array(*map(F.lit, PASS_NAMES)), lambda m: m != name)
        ends = F.transform(others, lambda m: F.nullif(F.call_function("locate", m, t, start), F.lit(0)))
        end = F.coalesce(F.array_min(ends), F.length(t) + 1)
        return F.when(pos > 0, strip_newlines(F.substr(t, start, end - start)))

    return F.transform(F.array(*map(F.lit, names)), one)


def _from_marker(t: Column, name: str) -> Column:
    """Text after the first ``name``, null without one."""
    pos = F.instr(t, name)
    return F.when(pos > 0, F.substr(t, pos + F.lit(len(name))))


def with_parsed_reply(df: DataFrame, text: str, out: str, keep: bool = False, like: str | None = None) -> DataFrame:
    """Add struct column ``out`` holding the five parsed sections of column ``text``.

    Sections and their line arrays are separate projections, so Catalyst keeps them as
    attributes (it does not inline an expensive expression into several consumers)
    and lambdas read an array instead of recomputing it per element. Sections whose
    parser was replaced in, or added to, ``PASS_PARSERS`` come from that parser.

    ``keep`` leaves the texts that Python would read in two more columns; ``like`` names
    a struct parsed that way: equal texts take its keys and don't go to Python again.
    """
    yaml_loader()  # a missing YAML library shows here, not in results
    t = F.col(text)
    tmp = f"_{out}"
    # Mostly the five sections stand once each and in order: then one split gives them all.
    parts = F.col(f"{tmp}_p")
    staged = df.select("*", F.split(t, MARKER).alias(f"{tmp}_p"))
    plain = F.size(parts) == len(PASS_NAMES) + 1
    for i, name in enumerate(PASS_NAMES):
        plain = plain & F.get(parts, i + 1).startswith(name[len(MARKER) :])
    own_part = [F.substr(F.get(parts, i + 1), F.lit(len(name) - len(MARKER) + 1)) for i, name in enumerate(PASS_NAMES)]
    staged = staged.select(
        "*",
        F.when(plain, F.array(*[strip_newlines(x) for x in own_part[:4]])).otherwise(_sections(t, PASS_NAMES[:4])).alias(f"{tmp}_s"),
        F.when(plain, own_part[4]).otherwise(_from_marker(t, PASS_NAMES[4])).alias(f"{tmp}_e"),
    )
    sec = [F.get(F.col(f"{tmp}_s"), i) for i in range(4)]
    staged = staged.select("*", *[_stripped_lines(sec[i]).alias(f"{tmp}_r{i}") for i in range(3)])
    staged = staged.select(
        "*", *[_drop_header(F.col(f"{tmp}_r{i}"), HEADERS[PASS_NAMES[i]]).alias(f"{tmp}_l{i}") for i in range(3)]
    )
    lines = [F.col(f"{tmp}_l{i}") for i in range(3)]
    staged = staged.withColumn(f"{tmp}_x", F.transform(lines[1], _lexeme))
    brace = F.instr(F.col(f"{tmp}_e"), "{")
    tail = F.when(brace > 0, F.substr(F.col(f"{tmp}_e"), brace))
    # Only valid UTF-8 crosses into Python (invalid bytes become U+FFFD natively).
    staged = staged.select("*", F.make_valid_utf8(tail).alias(f"{tmp}_t4"), F.make_valid_utf8(sec[3]).alias(f"{tmp}_t3"))
    texts = {"semantic": F.col(f"{tmp}_t3"), "envelope": F.col(f"{tmp}_t4")}
    known = {k: F.col(f"_{like}_t{n}") for k, n in (("semantic", 3), ("envelope", 4))} if like else {}
    # simple texts get their keys natively; only the others cross into Python
    same = {k: x.eqNullSafe(known[k]) if like else F.lit(False) for k, x in texts.items()}
    ask = {k: F.when(~same[k], x) for k, x in texts.items()}
    staged = native_keys.semantic(staged, ask["semantic"], f"{tmp}_n3")
    staged = native_keys.envelope(staged, ask["envelope"], f"{tmp}_n4")
    native = {"semantic": f"{tmp}_n3", "envelope": f"{tmp}_n4"}
    ask = {k: F.when(~same[k] & ~F.col(f"{native[k]}_known"), x) for k, x in texts.items()}
    staged = staged.select("*", structured_keys(ask["envelope"], ask["semantic"]).alias(f"{tmp}_k"))
    keys = {
        k: F.when(same[k], F.col(f"{like}.{k}") if like else F.lit(None)).when(F.col(f"{native[k]}_known"), F.col(f"{native[k]}_key")).otherwise(F.col(f"{tmp}_k.{k}"))
        for k in texts
    }
    own = {
        "PASS_0": _norm_from_lines(sec[0], lines[0]),
        "PASS_1": _all_or_none(F.col(f"{tmp}_x")),
        "PASS_2": _intent_from_lines(sec[2], lines[2]),
        "PASS_3": keys["semantic"],
        "PASS_4": keys["envelope"],
    }
    parsed = F.struct(*[
        (own[p] if _OWN_PARSERS.get(p) is parser else parser(text)).alias(field_of(p)) for p, parser in PASS_PARSERS.items()
    ])
    kept = {f"{tmp}_t3", f"{tmp}_t4"} if keep else set()
    gone = {c for c in staged.columns if c.startswith(f"{tmp}_")} - kept
    if like:
        gone |= {f"_{like}_t3", f"_{like}_t4"}
    return staged.select("*", parsed.alias(out)).drop(*gone)


def exact_match(pred_text: Column | str, gold_text: Column | str, pred_env: Column, gold_env: Column) -> Column:
    """1.0/0.0: envelopes compared structurally when both parse, stripped texts otherwise."""
    both = pred_env.isNotNull() & gold_env.isNotNull()
    same = F.when(both, pred_env == gold_env).otherwise(py_strip(col_of(pred_text)) == py_strip(col_of(gold_text)))
    return same.cast("double")


def metric_of(name: str) -> Callable[[Column, Column], Column]:
    """The metric that scores section ``name``."""
    return PASS_METRICS.get(name, pass_metric)


def pass_metric(pred_value: Column, gold_value: Column) -> Column:
    """Null when the gold section is unparseable; 1.0 equal, 0.0 otherwise."""
    return F.when(gold_value.isNotNull(), F.when(pred_value.eqNullSafe(gold_value), 1.0).otherwise(0.0))


# Metric registry: section name -> Column builder over (prediction, gold); others use ``pass_metric``.
PASS_METRICS: dict[str, Callable[[Column, Column], Column]] = {}
