"""Conversation structure repair as a lightest derivation (Knuth's agenda).

A repaired conversation reads ``(s?(ua)+)?`` in role initials. Rows are kept (0), given the
role user or assistant (3), or deleted (4, and so must be blank rows and repeats), and rows
with empty text may be inserted (3); a truncated row costs 3 more unless deleted. Among the
cheapest repairs the one whose edits spell the ASCII-least word wins (D < I < K < R).

Weighted deductions over items (rows read, role state):

    [i, p]  and  edit of row i from p to q      derive  [i + 1, q]
    [i, p]  and  an insertion from p to q       derive  [i, q]
    [b, p]  and  block b from p to q            derive  [b + 1, q]

A derivation weighs (cost, edits); costs add and edits are strung together, which never
makes a weight smaller and keeps the order of weights: insertions come before a row's own
edit, so all words that read the same rows to the end end in an edit, and none is a proper
beginning of another. So the agenda may pop the lightest item, take it as final, and stop
at the goal.

The work is dealt in blocks of turns, so a conversation may be of any length. Narrow rows
(no texts) are reduced to a block's lightest derivations between each pair of states; a
conversation's blocks, 16 short words each, are then derived to the goal, and the edits of
each block go back to its rows. Texts are shuffled once and streamed through the hash.

Defined cases: null roles and texts are one space, and so is a null id or turn in the key
of the damage; a null turn stays null for order and gaps, a null id is a conversation of
its own; rows of one turn go by role, then by the md5 of role and text; equal rows are
repeats; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import read, stage

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3  # costs
BLOCK = 10  # a block holds 2 ** BLOCK turns
STEP = 512  # rows derived at once within a block
START, SYSTEM, USER, ASSISTANT, GOAL = "0", "s", "u", "a", "!"
STATES = START + SYSTEM + USER + ASSISTANT
#: What may follow each state, and what an insertion or a new role leads to.
LEGAL = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
TURNS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
GONE = "-"  # class of a row that must be deleted; else its initial, in upper case if truncated, or OTHER
OTHER = "o"
PAIRS = ("su", "ua", "au")

Weight = tuple[int, object]
Item = Hashable


def lightest(axioms: Iterable[tuple[Weight, Item]], rules: Callable[[Item, Weight], Iterable[tuple[Weight, Item]]], done: Callable[[Item], bool]) -> dict[Item, tuple[Weight, Item]]:
    """Final weights of items, each with the item it came from, until ``done`` says stop.

    Items leave the agenda lightest first. As weights are superior (no consequence is
    lighter than what it follows from), the first weight of an item is its least.
    """
    agenda = [(w, item, item) for w, item in axioms]
    heapq.heapify(agenda)
    final: dict[Item, tuple[Weight, Item]] = {}
    while agenda:
        weight, item, origin = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (weight, origin)
        if done(item):
            break
        for w, nxt in rules(item, weight):
            if nxt not in final:
                heapq.heappush(agenda, (w, nxt, item))
    return final


def edits(kind: str, state: str) -> Iterator[tuple[int, str, str]]:
    """(cost, letter, next state) of every edit of a row of this class."""
    yield DELETE, "D", state
    if kind != GONE:
        extra = CUT if kind.isupper() else 0
        if kind.lower() in LEGAL[state]:
            yield KEEP + extra, "K", kind.lower()
        yield REROLE + extra, "R", TURNS[state]


class Blocks:
    """Lightest derivations of short runs of rows, remembered for runs seen before."""

    def __init__(self, most: int = 20_000):
        self.known: dict[str, list[tuple[str, str, int, str]]] = {}
        self.most = most

    def __call__(self, kinds: str) -> list[tuple[str, str, int, str]]:
        """(from, to, cost, edits) over the rows of these classes, without insertions after the last."""
        got = self.known.get(kinds)
        if got is None:
            got = [x for p in STATES for x in self._from(kinds, p)]
            if len(kinds) <= 32:
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[kinds] = got
        return got

    @staticmethod
    def _from(kinds: str, start: str) -> Iterator[tuple[str, str, int, str]]:
        end, open_ends = len(kinds), set(STATES)

        def rules(item: tuple[int, str], weight: tuple[int, str]) -> Iterator[tuple[Weight, Item]]:
            (i, p), (cost, word) = item, weight
            if i < end:
                for c, letter, q in edits(kinds[i], p):
                    yield (cost + c, word + letter), (i + 1, q)
                yield (cost + INSERT, word + "I"), (i, TURNS[p])

        def done(item: tuple[int, str]) -> bool:
            if item[0] == end:
                open_ends.discard(item[1])
            return not open_ends

        for (i, q), ((cost, word), _) in lightest([((0, ""), (0, start))], rules, done).items():
            if i == end:
                yield start, q, cost, word


#: Insertions after the last row.
CLOSE = [(START, GOAL, 0, ""), (SYSTEM, GOAL, 2 * INSERT, "II"), (USER, GOAL, INSERT, "I"), (ASSISTANT, GOAL, 0, "")]


def derive(blocks: list[list[tuple[str, str, int, str]]]) -> tuple[int, list[str]]:
    """Cost of the lightest repair, and the edits of each block (the last: insertions at the end)."""
    chain = [*blocks, CLOSE]

    def rules(item: tuple[int, str], weight: tuple[int, tuple]) -> Iterator[tuple[Weight, Item]]:
        (b, p), (cost, words) = item, weight
        for frm, to, c, word in chain[b]:
            if frm == p:
                yield (cost + c, (*words, word)), (b + 1, to)

    goal = (len(chain), GOAL)
    final = lightest([((0, ()), (0, START))], rules, lambda item: item == goal)
    (cost, words), _ = final[goal]
    return cost, list(words)


# --- columns ----------------------------------------------------------------------------

VISIBLE = r"[^\x20\x09-\x0D]"


def damaged(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` after the damage that crc32(``conv_id:turn``) % 20 picks."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), F.pmod(F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))), F.lit(20)).alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("d <> 0").select(
        "conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    ).drop("again")


def described(rows: DataFrame) -> DataFrame:
    """``rows`` with the block ``blk`` (null turns: the first), the fingerprint ``fp`` and what is seen of the text."""
    last = F.regexp_extract("text", rf"({VISIBLE})[\x20\x09-\x0D]*\z", 1)
    return rows.withColumns(
        {
            "blk": F.coalesce(F.shiftright("turn", BLOCK), F.lit(-(1 << 62))),
            "fp": F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))),
            "ini": F.substring("role", 1, 1),
            "last": last,
        }
    )


PLAN = "conv_id {id}, blk long, step int, word string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SUMS = ("n", "distinct", "blank", "duplicate", "truncated", "illegal")


def block_rows(narrow: DataFrame, conv: str) -> DataFrame:
    """One row for each run of at most STEP rows of a block: its counts and derivations.

    ``narrow`` has (conv_id, blk, turn, role, fp, ini, last, later); it is sorted here.
    """
    order = [F.col("conv_id"), F.col("blk"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("fp")]
    given = narrow.repartition("conv_id", "blk").sortWithinPartitions(*order).select("conv_id", "blk", "turn", "fp", "ini", "last", "later")
    kind = f"conv_id {conv}, blk long, step int, lo long, hi long, " + ", ".join(f"{c} long" for c in _SUMS) + ", first string, final string, frm array<string>, to array<string>, costs array<long>, words array<string>"
    names = ["conv_id", "blk", "step", "lo", "hi", *_SUMS, "first", "final", "frm", "to", "costs", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, group, step, kinds, row, seen = Blocks(), None, 0, [], None, None

        def fresh() -> dict:
            return dict.fromkeys(_SUMS, 0) | {"lo": None, "hi": None, "first": None, "final": None}

        def closed() -> list:
            found = known("".join(kinds))
            return [*group, step, row["lo"], row["hi"], *(row[c] for c in _SUMS), row["first"], row["final"], *(list(x) for x in zip(*found))]

        for batch in batches:
            ids, out = batch.column(0), []
            for conv_id, blk, turn, fp, ini, last, later in zip(*(c.to_pylist() for c in (ids, *batch.columns[1:]))):
                at = (conv_id, blk)
                if row is not None and (at != group or len(kinds) >= STEP):
                    out.append(closed())
                    step, kinds = (0 if at != group else step + 1), []
                    row = fresh()
                if row is None:
                    row = fresh()
                if at != group:
                    group, seen, prior = at, None, None
                row["n"] += 1
                if turn is not None:
                    row["distinct"] += seen is None or seen[0] != turn
                    row["lo"] = turn if row["lo"] is None else row["lo"]
                    row["hi"] = turn
                same = seen == (turn, fp)
                seen = (turn, fp)
                if row["first"] is None:
                    row["first"] = ini
                else:
                    row["illegal"] += prior + ini not in PAIRS
                row["final"] = prior = ini
                if not last:
                    row["blank"] += 1
                    kinds.append(GONE)
                elif later or same:
                    row["duplicate"] += 1
                    kinds.append(GONE)
                else:
                    cut = last not in ".!?"
                    row["truncated"] += cut
                    k = ini if ini and ini in "sua" else OTHER
                    kinds.append(k.upper() if cut else k)
            if out:
                yield _batch(out, names, schema)
        if row is not None:
            yield _batch([closed()], names, schema)

    schema = _schema(narrow.sparkSession, kind)
    return given.mapInArrow(run, kind)


def _schema(spark: SparkSession, kind: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], kind).schema)


def _batch(rows: list, names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*rows))], schema=schema)


def conversation_plans(blocks: DataFrame, conv: str) -> DataFrame:
    """One row for each run of rows with its edits; the conversation's figures stand on its first."""
    kind = PLAN.format(id=conv)
    schema = _schema(blocks.sparkSession, kind)
    names = schema.names
    given = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "blk", "step").select("conv_id", "blk", "step", "lo", "hi", *_SUMS, "first", "final", "frm", "to", "costs", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def closed() -> pa.RecordBatch:
            total = {c: sum(b[c] for b in held) for c in _SUMS}
            lows, highs = [b["lo"] for b in held if b["lo"] is not None], [b["hi"] for b in held if b["hi"] is not None]
            gaps = max(highs) - min(lows) + 1 - total["distinct"] if lows else 0
            illegal = total["illegal"] + sum(a["final"] + b["first"] not in PAIRS for a, b in zip(held, held[1:]))
            cost, words = derive([list(zip(b["frm"], b["to"], b["costs"], b["words"])) for b in held])
            figures = [gaps, total["blank"], total["duplicate"], total["truncated"], illegal, cost, "".join(words)]
            # insertions after the last row travel with the last run
            words[-2:] = [words[-2] + words[-1]]
            rows = [[b["conv_id"], b["blk"], b["step"], w, *(figures if i == 0 else [None] * 7)] for i, (b, w) in enumerate(zip(held, words))]
            return _batch(rows, names, schema)

        for batch in batches:
            for b in batch.to_pylist():
                if held and held[-1]["conv_id"] != b["conv_id"]:
                    yield closed()
                    held = []
                held.append(b)
        if held:
            yield closed()

    return given.mapInArrow(run, kind)


class Hashed:
    """The repaired conversation, streamed: role states, and the hash of ``role:text`` lines."""

    def __init__(self) -> None:
        self.state, self.sha, self.any, self.word, self.at = START, hashlib.sha256(), False, "", 0

    def more(self, word: str) -> None:
        self.word, self.at = self.word[self.at :] + word, 0

    def line(self, role: str, text: str) -> None:
        self.sha.update(("\n" if self.any else "").encode() + role.encode() + b":" + text.encode())
        self.any = True

    def inserted(self) -> None:
        while self.at < len(self.word) and self.word[self.at] == "I":
            self.state = TURNS[self.state]
            self.line(NAMES[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter = self.word[self.at]
        self.at += 1
        if letter == "K":
            self.state = role[0]
            self.line(role, text)
        elif letter == "R":
            self.state = TURNS[self.state]
            self.line(NAMES[self.state], text)

    def hex(self) -> str:
        self.inserted()
        return self.sha.hexdigest()


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repaired(rows: DataFrame, plans: DataFrame, ids: DataFrame, conv: str) -> DataFrame:
    """Streams each conversation's texts, in order, through its edits.

    Kind 0 names the conversation, kind 1 brings a run's edits, kind 2 is a row. Only the
    edits of one block and one text are held.
    """
    void = lambda **given: [F.lit(given.get(c)).cast(t).alias(c) if c in given else F.lit(None).cast(t).alias(c) for c, t in columns]
    columns = [("blk", "long"), ("kind", "int"), ("step", "int"), ("turn", "long"), ("role", "string"), ("text", "string"), ("fp", "binary"), ("word", "string"), *((c, "long") for c in FIGURES[:-1]), ("audit", "string")]
    parts = [
        ids.select("conv_id", *void(kind=0)),
        plans.withColumns({"kind": F.lit(1), "turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "fp": F.lit(None).cast("binary")}).select("conv_id", *(F.col(c).cast(t) for c, t in columns)),
        rows.withColumns({"kind": F.lit(2), "step": F.lit(0)} | {c: F.lit(None).cast(t) for c, t in columns if c in ("word", *FIGURES)}).select("conv_id", *(F.col(c).cast(t) for c, t in columns)),
    ]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    order = [F.col("conv_id"), F.col("blk").asc_nulls_first(), F.col("kind"), F.col("step"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("fp")]
    given = both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text", "word", *FIGURES)
    kind = f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    schema = _schema(rows.sparkSession, kind)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, figures, told = None, None, None
        for batch in batches:
            out = []
            ids_, kinds, roles, texts, words = (batch.column(i) for i in range(5))
            told_columns = [c.to_pylist() for c in batch.columns[5:]]
            for i, (conv_id, k, role, word) in enumerate(zip(ids_.to_pylist(), kinds.to_pylist(), roles.to_pylist(), words.to_pylist())):
                if k == 0:
                    if now is not None:
                        out.append([told, *figures, now.hex()])
                    now, told, figures = Hashed(), conv_id, [0] * 6 + [""]
                elif k == 1:
                    now.more(word)
                    if told_columns[0][i] is not None:
                        figures = [c[i] for c in told_columns]
                else:
                    now.row(role, texts[i].as_py())
            if out:
                yield _batch(out, names, schema)
        if now is not None:
            yield _batch([[told, *figures, now.hex()]], names, schema)

    return given.mapInArrow(run, kind)


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Faults, lightest repair and hash of each conversation of ``ids``; ``rows`` are as ``damaged`` gives them."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    full = described(rows)
    narrow = full.select("conv_id", "blk", "turn", "role", "fp", "ini", "last")
    # a repeat: the same role and text at an earlier turn (or, seen while streaming, just before)
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = narrow.where("last <> ''").groupBy(F.col("conv_id").alias("c1"), F.col("fp").alias("f1")).agg(F.min(place).alias("since"))
    narrow = narrow.join(first, F.col("conv_id").eqNullSafe(F.col("c1")) & (F.col("fp") == F.col("f1")), "left")
    narrow = narrow.withColumn("later", F.coalesce(place > F.col("since"), F.lit(False))).drop("c1", "f1", "since")
    plans = stage(conversation_plans(block_rows(narrow, conv), conv), "repair-plans")
    return repaired(full.select("conv_id", "blk", "turn", "role", "text", "fp"), plans, ids, conv)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of all conversations after the stated damage."""
    turns = read(spark, sf_dir, "conversations")
    return repair(damaged(turns), turns.select("conv_id").distinct())


def _least(*choices: str) -> str:
    return f"list_min([{', '.join(choices)}])"


def _step(state: str, cost: str, letters: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'w': {state}.w || '{letters}'}}"


def _oracle() -> str:
    """The same in SQL: one row of a conversation at a time, four states carried along."""
    user = _least("u", _step("z", "3", "I"), _step("s", "3", "I"), _step("a", "3", "I"))
    never = "{'c': 1000000000, 'w': ''}"
    rerole = "CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 6 ELSE 3 END"
    keep = lambda ini: f"CASE WHEN ini <> '{ini}' OR fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    return rf"""
WITH RECURSIVE
crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, n: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) b(i))),
k AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
d AS (
  SELECT k.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS d
  FROM k CROSS JOIN crc),
h AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d JOIN range(2) b(again) ON d <> 0 AND (again = 0 OR d = 3)),
r AS (
  SELECT *, left(role, 1) AS ini, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS i
  FROM h),
f AS (
  SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini NOT IN ('su', 'ua', 'au') AS bad
  FROM r),
p AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'w': ''}} AS z, {never} AS s, {never} AS u, {never} AS a FROM conversations
  UNION ALL
  SELECT conv_id, i,
    {_step("z", "4", "D")},
    {_least(_step("s", "4", "D"), _step("z", keep("s"), "K"))},
    {_least(_step("u1", "4", "D"), *(x for q in ("z", "s", "a1") for x in (_step(q, keep("u"), "K"), _step(q, rerole, "R"))))},
    {_least(_step("a1", "4", "D"), _step("u1", keep("a"), "K"), _step("u1", rerole, "R"))}
  FROM (
    SELECT *, {_least("a", _step("u1", "3", "I"))} AS a1 FROM (
      SELECT f.conv_id, f.i, f.fault, f.ini, z, s, u, a, {user} AS u1
      FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1) x) y),
e AS (
  SELECT conv_id, {_least("z", "a", _step("s", "6", "II"), _step("u", "3", "I"))} AS g
  FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
w AS (
  SELECT conv_id, unnest(string_split(g.w, '')) AS letter, generate_subscripts(string_split(g.w, ''), 1) AS pos FROM e WHERE g.w <> ''),
x AS (
  SELECT *, count(CASE WHEN letter <> 'I' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY pos) AS i,
    count(CASE WHEN letter <> 'D' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY pos) AS o
  FROM w),
y AS (
  SELECT x.conv_id, x.pos, x.letter, x.o, CASE WHEN letter <> 'I' THEN f.role END AS role, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text,
    max(CASE WHEN o = 1 AND letter = 'K' AND f.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.conv_id) AS led
  FROM x LEFT JOIN f ON x.conv_id IS NOT DISTINCT FROM f.conv_id AND x.i = f.i),
t AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS text
  FROM y WHERE letter <> 'D' GROUP BY conv_id),
m AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal
  FROM f GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(e.g.c AS BIGINT) AS cost, e.g.w AS audit,
  sha256(coalesce(t.text, '')) AS repaired_sha256
FROM e LEFT JOIN m ON e.conv_id IS NOT DISTINCT FROM m.conv_id LEFT JOIN t ON e.conv_id IS NOT DISTINCT FROM t.conv_id"""


SQL = _oracle()
