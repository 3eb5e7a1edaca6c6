"""PII: format-preserving Feistel pseudonyms, wholly in DataFrame functions.

Values found in a text are validated (Luhn, mod 97, octets, calendar, SSN ranges) and
replaced by a keyed permutation of their own format, so equal values get equal pseudonyms
in every document and different values of one format stay different:

* card numbers (13-19 digits): first digit and separators stay, the check digit is redone;
  in a longer run of numbers every place where a number begins is tried, the usual
  groupings (unbroken, 4-4-4-4, 4-4-4-4-3, 4-6-5, 4-6-4) before others;
* phone numbers: country code and separators stay; first digits 2-9 stay in 2-9;
* social security numbers: permuted within the valid areas, groups and serials;
* IPv4 addresses: permuted as four octets; IBANs: country and check digits are redone;
* dates (yyyy-mm-dd, dd/mm/yyyy, dd.mm.yyyy): permuted among the days from
  1900-01-01 to 2099-08-04, others stay;
* e-mail addresses: letters and digits permuted in their class, all but the top domain;
* secrets (access keys, values of password=, token=, secret=, api_key=): likewise,
  longer ones than ``SECRET_PIECE`` piece by piece.

A value is a list of small integers, each with its own range. Eight rounds of a Feistel
network add a keyed hash of one half (odd places) to the other (even places), each place
modulo its range.

Defined cases: null text stays null, empty text stays empty; ids are never used, so null
or repeated ids and rows don't matter; values that fail validation stay as they are;
other columns pass through; an empty table gives an empty result. The key is a parameter;
the default only serves tests and the registered query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import own_names, read

ROUNDS = 8
DEFAULT_KEY = "colloquy-pii"
ROOT = 270
DAYS = ROOT * ROOT  # days from 1900-01-01 to 2099-08-04, as two places of ROOT each

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,5}\.[A-Za-z]{2,24}"
SECRET = r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?i:password|passwd|secret|token|api_key|apikey)[ ]{0,2}[=:][ ]{0,2}[\"']?[A-Za-z0-9_+/-]{8,}+)"
IPV4 = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])"
PHONE = r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
#: Numbers apart by one blank or hyphen, as far as no other kind begins that may reach beyond them.
_NUMBER, _REACHES = r"[0-9]++(?![A-Za-z])", rf"{EMAIL}|{IPV4}|[0-9]{{2}}([/.])[0-9]{{2}}\1[0-9]{{4}}(?![0-9A-Za-z])|[0-9]{{3}}(?:\.[0-9]{{3}}[ .-]|[ -][0-9]{{3}}\.)[0-9]{{4}}(?![0-9A-Za-z])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
RUN = rf"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){{12}}){_NUMBER}(?:[ -](?!{_REACHES}){_NUMBER})*+"
ANY = "|".join((EMAIL, SECRET, IPV4, DATE, SSN, PHONE, RUN, IBAN))
#: What may stand beside the cards of a run; at its start it was tried before.
INNER = f"(?!^)(?:{DATE}|{SSN}|{PHONE})"
_GROUPED = (r"[0-9]{13,19}", r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}\1[0-9]{3}", r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}", r"[0-9]{4}([ -])[0-9]{6}\1[0-9]{4,5}")
_LOOSE = tuple(f"[0-9](?:[ -]?[0-9]){{{n}}}" for n in range(18, 11, -1))
SECRET_PIECE = 256  # characters of a secret permuted together
_CODE = r"^\+[0-9]{1,3}"
_HEAD = r"^(?:AKIA(?=[0-9A-Z]{16}$)|[A-Za-z_]{5,8}[ ]{0,2}[=:][ ]{0,2}[\"']?)"


#: Kinds of values, by the order of their patterns; 0 is "leave as it is".
PATTERNS = {1: EMAIL, 2: SECRET, 3: IPV4, 4: DATE, 5: SSN, 6: PHONE, 7: CARD, 8: IBAN}
#: Character classes: digit, lower, upper, lower hexadecimal, digit 2-9, digit 0-1.
BASES, SIZES = (48, 97, 65, 97, 50, 48), (10, 26, 26, 6, 8, 2)


def feistel(values: Column, sizes: Column, tweak: Column, key: str) -> Column:
    """A keyed permutation of arrays of integers, place i staying within [0, sizes[i])."""

    def one_round(acc: Column, r: Column) -> Column:
        other = F.array_join(F.filter(acc, lambda y, j: F.pmod(j, F.lit(2)) != F.pmod(r, F.lit(2))).cast("array<string>"), ",")

        def place(x: Column, i: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, r, i, F.size(acc), other).cast("binary"), 256)
            noise = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
            return F.when(F.pmod(i, F.lit(2)) == F.pmod(r, F.lit(2)), F.pmod(x + noise, F.element_at(sizes, i + 1).cast("long")).cast("int")).otherwise(x)

        return F.transform(acc, place)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, one_round)


def _at(s: Column, i: Column) -> Column:
    return s.substr(i, F.lit(1))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of a string of digits, the check digit last."""

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int") * (2 - F.pmod(i, F.lit(2)))
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add), F.lit(10))


def _mod97(flat: Column) -> Column:
    """An IBAN without spaces modulo 97: account part, then country and check digits."""

    def add(acc: Column, i: Column) -> Column:
        c = _at(flat, F.pmod(i + 4, F.length(flat)) + 1)
        return F.pmod(F.when(c.rlike("[0-9]"), acc * 10 + c.cast("int")).otherwise(acc * 100 + F.ascii(c) - 55), F.lit(97))

    return F.aggregate(F.sequence(F.lit(0), F.length(flat) - 1), F.lit(0), add)


def _day(s: Column) -> Column:
    parts = F.when(s.rlike("-"), s).otherwise(F.concat_ws("-", s.substr(7, 4), s.substr(4, 2), s.substr(1, 2)))
    return F.datediff(F.try_to_date(parts, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))


def _iban(s: Column) -> Column:
    flat = F.regexp_replace(s, " ", "")
    return F.length(flat).between(15, 34) & (_mod97(flat) == 1)


def _kind(s: Column) -> Column:
    """Which kind of value ``s`` is, 0 when it fails that kind's validation."""
    area, group, serial = (s.substr(a, n).try_cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = {
        3: F.forall(F.split(s, r"\."), lambda x: x.cast("int") <= 255),
        4: F.coalesce(_day(s).between(0, DAYS - 1), F.lit(False)),
        5: area.between(1, 899) & (area != 666) & group.between(1, 99) & serial.between(1, 9999),
        7: _luhn(_digits(s)) == 0,
        8: _iban(s),
    }
    found = F
    for k, p in PATTERNS.items():
        found = found.when(s.rlike(f"^(?:{p})$"), F.when(valid[k], k).otherwise(0) if k in valid else F.lit(k))
    return found.otherwise(0)


def _span(chars: Column, i: Column, n: Column) -> Column:
    return F.array_join(F.slice(chars, i, n), "")


def _card_at(chars: Column, i: Column, shapes: tuple[str, ...]) -> Column:
    """The first of ``shapes`` at place i of ``chars`` that is a valid card number, or null."""
    tail = _span(chars, i, F.lit(38))  # 19 digits, what stands between them, and what follows
    found = [F.regexp_extract(tail, f"^(?:{shape})(?![0-9A-Za-z])", 0) for shape in shapes]
    begins = F.element_at(chars, i).rlike("[0-9]") & ~F.coalesce(F.get(chars, i - 2), F.lit("")).rlike("[0-9A-Za-z]")
    return F.when(begins, F.coalesce(*(F.when(F.when(c != "", _luhn(_digits(c)) == 0), c) for c in found)))


def _part(s: Column, kind: int | None) -> Column:
    return F.struct(s.alias("s"), F.lit(kind).cast("int").alias("k"))


def _cut_out(p: Column) -> Column:
    """Card numbers of the run ``p.s`` and the text around them, as parts."""
    s, none = p["s"], F.array().cast("array<struct<s:string,k:int>>")

    def step(acc: Column, i: Column) -> Column:
        grouped, loose = F.element_at(p["grouped"], i), F.element_at(p["loose"], i)
        later = F.exists(F.slice(p["grouped"], i + 1, F.coalesce(F.length(loose), F.lit(1)) - 1), lambda c: c.isNotNull())
        c = F.coalesce(grouped, F.when(~later, loose))
        put = F.concat(acc["o"], F.array(_part(_span(p["chars"], acc["at"], i - acc["at"]), 0), _part(c, 7)))
        new = F.struct(put.alias("o"), (i + F.length(c)).alias("at"))
        return F.when((i >= acc["at"]) & c.isNotNull(), new).otherwise(acc)

    start = F.struct(none.alias("o"), F.lit(1).alias("at"))
    end = lambda acc: F.concat(acc["o"], F.array(_part(s.substr(acc["at"], F.length(s)), 0)))
    cards = F.aggregate(F.sequence(F.lit(1), F.length(s)), start, step, end)

    def inner(x: Column) -> Column:
        around, hits = F.split(x["s"], INNER, -1), F.regexp_extract_all(x["s"], F.lit(INNER), F.lit(0))
        both = F.zip_with(around, hits, lambda a, b: F.array(_part(a, 0), _part(b, None)))
        return F.when(x["k"] == 7, F.array(x)).otherwise(F.filter(F.flatten(both), lambda y: y["s"].isNotNull()))

    return F.flatten(F.transform(cards, inner))


def _pieces(p: Column) -> Column:
    """A long secret in pieces, the first with what stands before the value."""
    s = p["s"]
    first = F.length(F.regexp_extract(s, _HEAD, 0)) + SECRET_PIECE
    rest = F.transform(F.sequence(F.lit(0), F.floor((F.length(s) - first - 1) / SECRET_PIECE).cast("int")), lambda i: _part(s.substr(first + i * SECRET_PIECE + 1, F.lit(SECRET_PIECE)), 2))
    return F.when(F.length(s) > first, F.concat(F.array(_part(s.substr(F.lit(1), first), None)), rest)).otherwise(F.array(_part(s, None)))


def _class(p: Column, i: Column) -> Column:
    """The class of character i of value ``p.s``: 0 stays, else 1 + its place in BASES."""
    s, k, c = p["s"], p["kind"], _at(p["s"], i)
    digit = c.rlike("[0-9]")
    plain = F.when(digit, 1).when(c.rlike("[a-z]"), F.when(p["hexadecimal"], 4).otherwise(2)).when(c.rlike("[A-Z]"), 3).otherwise(0)
    nth = F.length(_digits(s.substr(p["first"], i - p["first"] + 1)))
    return (
        F.when((i < p["first"]) | (i > p["last"]), 0)
        .when((k == 6) & digit & nth.isin(1, 4), F.when(c >= "2", 5).otherwise(6))
        .when((k == 7) & (~digit | (nth == 1) | (i == F.length(s))), 0)
        .otherwise(plain)
    )


def _first(p: Column) -> Column:
    s = p["s"]
    return (
        F.when(p["kind"] == 2, F.length(F.regexp_extract(s, _HEAD, 0)) + 1)
        .when(p["kind"] == 6, F.length(F.regexp_extract(s, _CODE, 0)) + 1)
        .when(p["kind"] == 8, 5).otherwise(1)
    )


def _values(p: Column) -> Column:
    """The value as integers."""
    s, k = p["s"], p["kind"]
    base = F.array(*map(F.lit, BASES))
    area = s.substr(1, 3).try_cast("int")
    chars = F.transform(
        F.filter(F.transform(p["cls"], lambda c, i: F.struct(c.alias("c"), F.ascii(_at(s, i + 1)).alias("a"))), lambda x: x["c"] > 0),
        lambda x: x["a"] - F.element_at(base, F.greatest(x["c"], F.lit(1))),
    )
    return (
        F.when(k == 3, F.transform(F.split(s, r"\."), lambda x: x.cast("int")))
        .when(k == 4, F.array(F.floor(_day(s) / ROOT).cast("int"), F.pmod(_day(s), F.lit(ROOT))))
        .when(k == 5, F.array(F.when(area > 666, area - 2).otherwise(area - 1), s.substr(5, 2).cast("int") - 1, s.substr(8, 4).cast("int") - 1))
        .otherwise(chars)
    )


def _ranges(p: Column) -> Column:
    k, size = p["kind"], F.array(*map(F.lit, SIZES))
    ints = lambda *x: F.array(*map(F.lit, x))
    return (
        F.when(k == 3, ints(256, 256, 256, 256)).when(k == 4, ints(ROOT, ROOT)).when(k == 5, ints(898, 99, 9999))
        .otherwise(F.transform(F.filter(p["cls"], lambda c: c > 0), lambda c: F.element_at(size, F.greatest(c, F.lit(1)))))
    )


def _spelt(p: Column) -> Column:
    """The permuted integers in the value's own shape, check digits not yet redone."""
    s, k, new = p["s"], p["kind"], p["new"]
    base = F.array(*map(F.lit, BASES))

    def put(acc: Column, i: Column) -> Column:
        c = F.element_at(p["cls"], i)
        live = F.char(F.element_at(base, F.greatest(c, F.lit(1))) + F.get(new, acc["j"]))
        return F.struct(F.concat(acc["o"], F.when(c > 0, live).otherwise(_at(s, i))).alias("o"), (acc["j"] + F.when(c > 0, 1).otherwise(0)).alias("j"))

    filled = F.aggregate(F.sequence(F.lit(1), F.length(s)), F.struct(F.lit("").alias("o"), F.lit(0).alias("j")), put, lambda acc: acc["o"])
    to = F.date_add(F.lit("1900-01-01").cast("date"), F.get(new, F.lit(0)) * ROOT + F.get(new, F.lit(1)))
    area = F.get(new, F.lit(0))
    return (
        F.when(k == 0, s)
        .when(k == 3, F.array_join(new.cast("array<string>"), "."))
        .when(k == 4, F.when(s.rlike("-"), F.date_format(to, "yyyy-MM-dd")).when(s.rlike("/"), F.date_format(to, "dd/MM/yyyy")).otherwise(F.date_format(to, "dd.MM.yyyy")))
        .when(k == 5, F.format_string("%03d-%02d-%04d", F.when(area >= 665, area + 2).otherwise(area + 1), F.get(new, F.lit(1)) + 1, F.get(new, F.lit(2)) + 1))
        .otherwise(filled)
    )


def _checked(p: Column) -> Column:
    """``p.o`` with its check digits redone."""
    o, n = p["o"], F.length(p["o"])
    body = F.concat(o.substr(F.lit(1), n - 1), F.lit("0"))
    check = F.pmod(10 - _luhn(_digits(body)), F.lit(10)).cast("string")
    flat = F.regexp_replace(F.concat(o.substr(1, 2), F.lit("00"), o.substr(F.lit(5), n)), " ", "")
    return (
        F.when(p["kind"] == 7, F.concat(o.substr(F.lit(1), n - 1), check))
        .when(p["kind"] == 8, F.concat(o.substr(1, 2), F.lpad((98 - _mod97(flat)).cast("string"), 2, "0"), o.substr(F.lit(5), n)))
        .otherwise(o)
    )


def _with_field(values: str, have: tuple[str, ...], name: str, step: Callable[[Column], Column]) -> Column:
    return F.transform(values, lambda p: F.struct(*(p[n].alias(n) for n in have), step(p).alias(name)))


def with_pseudonyms(rows: DataFrame, values: str, into: str, key: str = DEFAULT_KEY) -> DataFrame:
    """``rows`` with the array column ``into``: the pseudonyms of the array ``values`` of parts ``(s, k)``;
    ``k`` is their kind where it is known.

    Each step adds a field to an array of structures, so every step is evaluated once.
    """
    steps = [
        ("kind", lambda p: F.coalesce(p["k"], _kind(p["s"]))),
        ("first", lambda p: F.when(p["k"] == 2, 1).otherwise(_first(p))),
        ("last", lambda p: F.when(p["kind"] == 1, F.length(p["s"]) - F.instr(F.reverse(p["s"]), ".")).otherwise(F.length(p["s"]))),
        ("hexadecimal", lambda p: (p["kind"] == 2) & p["s"].substr(p["first"], F.length(p["s"])).rlike("^[0-9a-f]+$")),
        ("cls", lambda p: F.when(p["kind"].isin(1, 2, 6, 7, 8), F.transform(F.sequence(F.lit(1), F.length(p["s"])), lambda i: _class(p, i))).otherwise(F.array().cast("array<int>"))),
        ("v", _values),
        ("m", _ranges),
        ("new", lambda p: feistel(p["v"], p["m"], p["kind"].cast("string"), key)),
        ("o", _spelt),
        ("out", _checked),
    ]
    done = rows.withColumn("__llm_p", F.col(values))
    names = ["s", "k"]
    for name, step in steps:
        done = done.withColumn("__llm_p", _with_field("__llm_p", tuple(names), name, step))
        names.append(name)
    return done.withColumn(into, F.transform("__llm_p", lambda p: p["out"])).drop("__llm_p")


def _parts(rows: DataFrame, hits: str, into: str) -> DataFrame:
    """``rows`` with the array column ``into``: for each of ``hits`` the parts it is made of."""
    number = lambda s: s.rlike("^[0-9][0-9 -]{12,}$")
    steps = [
        ("run", lambda p: F.when(number(p["s"]), True).when(p["s"].rlike(f"^(?:{IBAN})$"), ~_iban(p["s"])).otherwise(False)),
        ("chars", lambda p: F.when(p["run"], F.split(p["s"], ""))),
        ("grouped", lambda p: F.when(p["run"], F.transform(F.sequence(F.lit(1), F.length(p["s"])), lambda i: _card_at(p["chars"], i, _GROUPED)))),
        ("loose", lambda p: F.when(p["run"], F.transform(F.sequence(F.lit(1), F.length(p["s"])), lambda i: _card_at(p["chars"], i, _LOOSE)))),
    ]
    done = rows.withColumn(into, F.transform(hits, lambda s: F.struct(s.alias("s"))))
    names = ["s"]
    for name, step in steps:
        done = done.withColumn(into, _with_field(into, tuple(names), name, step))
        names.append(name)
    long = lambda p: (F.length(p["s"]) > SECRET_PIECE) & p["s"].rlike(f"^(?:{SECRET})$")
    return done.withColumn(into, F.transform(into, lambda p: F.when(p["run"], _cut_out(p)).when(long(p), _pieces(p)).otherwise(F.array(_part(p["s"], None)))))


@own_names
def pseudonymise(docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY, count: str | None = None) -> DataFrame:
    """``docs`` with the values in ``text`` replaced; ``count`` names a column for how many."""
    t = F.col(text)
    maybe = t.rlike("[0-9@=:]|AKIA")  # no kind of value goes without one of these
    hits = docs.withColumn("__llm_hits", F.when(maybe, F.regexp_extract_all(t, F.lit(ANY), F.lit(0))))
    hits = hits.withColumn("__llm_hits", F.when(F.size("__llm_hits") > 0, F.col("__llm_hits")))
    parts = _parts(hits, "__llm_hits", "__llm_parts")
    new = with_pseudonyms(parts.withColumn("__llm_flat", F.flatten("__llm_parts")), "__llm_flat", "__llm_new", key)
    # the parts of each hit are joined again from where they stand in the flat array
    sizes = F.transform("__llm_parts", lambda x: F.size(x))
    ends = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    new = new.withColumn("__llm_ends", ends)
    values = F.transform(sizes, lambda n, i: F.array_join(F.slice("__llm_new", F.get("__llm_ends", i) + 1, n), ""))
    joined = F.array_join(F.zip_with(F.split(t, ANY, -1), F.concat(values, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    out = F.when(F.col("__llm_hits").isNotNull(), joined).otherwise(t)
    cols = [out.alias(text) if c == text else F.col(c) for c in docs.columns]
    if count:
        changed = F.size(F.filter(F.arrays_zip("__llm_flat", "__llm_new"), lambda z: F.coalesce(z["__llm_flat"]["k"] != 2, F.lit(True)) & (z["__llm_flat"]["s"] != z["__llm_new"])))
        cols.append(F.when(F.col("__llm_hits").isNotNull(), changed).otherwise(0).cast("long").alias(count))
    return new.select(*cols)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, n_pseudonyms, text)`` for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, count="n_pseudonyms").select("doc_id", "n_pseudonyms", "text")
