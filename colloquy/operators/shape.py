"""Corpus shaping: training text, prompt/gold split, response spans, packing, sampling.

The chat template is a parameter (``ChatTemplate``); rendering is string concatenation
in Catalyst. Every running sum is two-level: inside a conversation, windows run over
blocks of at most 1,024 turns plus a one-row-per-block offsets table; across the corpus
(wrapped packing), range-partitioned blocks plus a one-row-per-block prefix table. No
window or collection ever spans a whole conversation's rows or the whole corpus, except
the final gathering of a text that is itself the output.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



@dataclass(frozen=True)
class ChatTemplate:
    """Literal pieces of a turn-based chat template.

    A turn renders as ``turn_open + role_name + '\\n' + content + turn_close`` and the
    text starts with ``bos``. ``assistant`` shows as ``model`` by default.
    """

    bos: str = "<bos>"
    turn_open: str = "<|turn>"
    turn_close: str = "<turn|>\n"
    role_names: dict = field(default_factory=lambda: {"assistant": "model"})
    instruction_part: str = "<|turn>user\n"
    response_part: str = "<|turn>model\n"

    def role_name(self, role: Column) -> Column:
        out = role
        for src, dst in self.role_names.items():
            out = F.when(role == src, F.lit(dst)).otherwise(out)
        return out

    def header(self, role: Column) -> Column:
        return F.concat(F.lit(self.turn_open), self.role_name(role), F.lit("\n"))

    def render_turn(self, role: Column, content: Column) -> Column:
        return F.concat(self.header(role), F.coalesce(content, F.lit("")), F.lit(self.turn_close))


DEFAULT_TEMPLATE = ChatTemplate()


def _ordered_concat(pieces: Column, order: Column) -> Column:
    """Concatenate per-row strings of one group in ``order`` (aggregate expression)."""
    ordered = F.array_sort(F.collect_list(F.struct(order.alias("o"), pieces.alias("p"))))
    return F.array_join(F.transform(ordered, lambda x: x["p"]), "")


TEXT_BLOCK_ROWS = 1024


def ordered_text(df: DataFrame, key: str, order: str, piece: Column, block_rows: int = TEXT_BLOCK_ROWS) -> DataFrame:
    """``(key, text)``: the pieces of each key concatenated in ``order`` (an integer column).

    Two levels: pieces are first joined per ``(key, order div block_rows)`` — groups of
    at most ``block_rows`` consecutive positions, hashed on both columns so one huge key
    is spread over many tasks — and only the block strings are gathered per key.
    """
    blk = F.floor(F.col(order) / F.lit(block_rows)).cast("bigint")
    blocks = df.groupBy(key, blk.alias("_blk")).agg(_ordered_concat(piece, F.col(order)).alias("_t"))
    return blocks.groupBy(key).agg(_ordered_concat(F.col("_t"), F.col("_blk")).alias("text"))


def flatten_text(turns: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, key: str = "conv_id") -> DataFrame:
    """One rendered training text per conversation: ``(key, text)``."""
    piece = template.render_turn(F.col("role"), F.col("text"))
    body = ordered_text(turns, key, "turn", piece)
    return body.select(key, F.concat(F.lit(template.bos), F.col("text")).alias("text"))


def prompt_gold(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Conversations whose last turn is the assistant's: ``(key, n_prompt_turns, gold)``.

    Splittable: the last turn is ``max_by`` over position, no group is collected.
    """
    last = turns.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(F.struct(F.col("role").alias("role"), F.col("text").alias("text")), F.col("turn")).alias("_last"),
    )
    return last.filter(F.col("_last.role") == "assistant").select(
        key, (F.col("_n") - 1).cast("bigint").alias("n_prompt_turns"), F.col("_last.text").alias("gold")
    )


def prompt_gold_records(conversations: DataFrame, key: str = "conv_id", messages: str = "messages") -> DataFrame:
    """Nested form: ``(key, prompt_messages, prompt_json, gold)`` for rows ending on the assistant."""
    m = F.col(messages)
    last = F.try_element_at(m, F.lit(-1))
    prompt = F.slice(m, F.lit(1), F.size(m) - 1)
    return conversations.filter((F.size(m) > 0) & (last["role"] == "assistant")).select(
        key,
        prompt.alias("prompt_messages"),
        F.to_json(prompt, {"ignoreNullFields": "false"}).alias("prompt_json"),
        F.coalesce(last["content"], F.lit("")).alias("gold"),
    )


def prompt_before_first_reply(conversations: DataFrame, key: str = "conv_id", messages: str = "messages") -> DataFrame:
    """Turns before the first assistant turn (sanity-sample prompts)."""
    m = F.col(messages)
    pos = F.array_position(F.transform(m, lambda x: x["role"]), "assistant")
    return conversations.select(
        key, F.when(pos > 0, F.slice(m, F.lit(1), (pos - 1).cast("int"))).otherwise(m).alias("prompt_messages")
    )


def prompt_prefix(turns: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, key: str = "conv_id") -> DataFrame:
    """Rendered prompt ending exactly at the assistant header of the final reply.

    For conversations ending on the assistant, this is a byte prefix of ``flatten_text``.
    """
    # The last turn is identified by a splittable max, then excluded.
    mx = turns.groupBy(key).agg(F.max("turn").alias("_last"), F.max_by("role", "turn").alias("_last_role"))
    body = turns.join(mx.filter(F.col("_last_role") == "assistant"), key).filter(F.col("turn") < F.col("_last"))
    piece = template.render_turn(F.col("role"), F.col("text"))
    text = ordered_text(body, key, "turn", piece)
    return text.select(
        key, F.concat(F.lit(template.bos), F.col("text"), template.header(F.lit("assistant"))).alias("prompt")
    )


SPAN_BLOCK_TURNS = 1024


def response_spans(turns: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, key: str = "conv_id",
                   block_turns: int = SPAN_BLOCK_TURNS) -> DataFrame:
    """Loss spans of the rendered text: ``(key, turn, span_start, span_end)``, 0-based, end exclusive.

    A span starts right after the response header of an assistant turn and runs to the
    next instruction header (or the end of the text), as response-only masking does.

    Offsets are two-level prefix sums, so no window ever spans a whole conversation:
    windows run inside ``(key, turn div block_turns)`` blocks (at most ``block_turns``
    rows each); a per-block table (one row per block) carries block offsets, the text
    length and the first instruction turn of later blocks, and is joined back.
    """
    bos = F.lit(len(template.bos))
    header_len = F.length(template.header(F.col("role")))
    piece_len = header_len + F.length(F.coalesce(F.col("text"), F.lit(""))) + F.lit(len(template.turn_close))
    t = turns.select(
        key,
        "turn",
        F.floor(F.col("turn") / F.lit(block_turns)).cast("bigint").alias("_blk"),
        piece_len.alias("_len"),
        header_len.alias("_hl"),
        (template.header(F.col("role")) == F.lit(template.instruction_part)).alias("_ins"),
        (template.header(F.col("role")) == F.lit(template.response_part)).alias("_resp"),
    )
    in_block = Window.partitionBy(key, "_blk").orderBy("turn")
    local = t.select(
        "*",
        F.coalesce(F.sum("_len").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_lp"),
    ).select(
        "*",
        F.min(F.when(F.col("_ins"), F.col("_lp"))).over(in_block.rowsBetween(1, Window.unboundedFollowing)).alias("_nloc"),
    )
    blocks = local.groupBy(key, "_blk").agg(
        F.sum("_len").alias("_bsum"), F.min(F.when(F.col("_ins"), F.col("_lp"))).alias("_first_ins")
    )
    by_block = Window.partitionBy(key).orderBy("_blk")
    boff = F.coalesce(F.sum("_bsum").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select(key, "_blk", "_bsum", "_first_ins", boff.alias("_boff")).select(
        key,
        "_blk",
        "_boff",
        F.sum("_bsum").over(Window.partitionBy(key)).alias("_total"),
        F.min(F.when(F.col("_first_ins").isNotNull(), F.col("_boff") + F.col("_first_ins")))
        .over(by_block.rowsBetween(1, Window.unboundedFollowing))
        .alias("_next_blk_ins"),
    )
    j = local.filter("_resp").join(blocks, [key, "_blk"])
    next_ins = F.coalesce(F.col("_boff") + F.col("_nloc"), F.col("_next_blk_ins"))
    return j.select(
        key,
        "turn",
        (bos + F.col("_boff") + F.col("_lp") + F.col("_hl")).cast("bigint").alias("span_start"),
        (bos + F.coalesce(next_ins, F.col("_total"))).cast("bigint").alias("span_end"),
    )


def marker_guard(flat: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, text: str = "text") -> DataFrame:
    """Whether both template markers occur in every rendered row (empty input fails)."""
    both = F.col(text).contains(template.instruction_part) & F.col(text).contains(template.response_part)
    return flat.agg(
        F.coalesce(F.bool_and(both), F.lit(False)).alias("markers_ok"),
        F.count_if(~both).alias("n_rows_missing_markers"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _straddles(marker: str, before: str) -> bool:
    """Whether ``marker`` can begin at the end of ``before`` and go on in the next piece."""
    return any(before.endswith(marker[:n]) for n in range(1, len(marker)))


def marker_guard_of_turns(turns: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, key: str = "conv_id") -> DataFrame:
    """``marker_guard`` without assembling texts: a row holds a marker if one of its turns does.

    A template whose turns can end in the beginning of a marker needs the assembled text.
    """
    markers = (template.instruction_part, template.response_part)
    if any(_straddles(m, end) for m in markers for end in (template.bos, template.turn_close)):
        return marker_guard(flatten_text(turns, template, key), template)
    piece = template.render_turn(F.col("role"), F.col("text"))
    rows = turns.groupBy(key).agg(*[F.coalesce(F.bool_or(piece.contains(m)), F.lit(False)).alias(f"_m{i}") for i, m in enumerate(markers)])
    both = F.col("_m0") & F.col("_m1")
    return rows.agg(
        F.coalesce(F.bool_and(both), F.lit(False)).alias("markers_ok"),
        F.count_if(~both).alias("n_rows_missing_markers"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def text_lengths(turns: DataFrame, template: ChatTemplate = DEFAULT_TEMPLATE, key: str = "conv_id") -> DataFrame:
    """``(key, n_chars)`` of the rendered texts, as sums of the lengths of their pieces."""
    piece = F.length(template.header(F.col("role"))) + F.length(F.coalesce(F.col("text"), F.lit(""))) + F.lit(len(template.turn_close))
    return turns.groupBy(key).agg((F.coalesce(F.sum(piece), F.lit(0)) + F.lit(len(template.bos))).cast("bigint").alias("n_chars"))


def masked_fraction(spans: DataFrame, flat: DataFrame, key: str = "conv_id") -> DataFrame:
    """Share of rendered characters that carry loss; ``flat`` has the texts, or their ``n_chars``."""
    trained = spans.groupBy().agg(F.sum(F.col("span_end") - F.col("span_start")).alias("_t"))
    total = flat.groupBy().agg(F.sum("n_chars" if "n_chars" in flat.columns else F.length("text")).alias("_a"))
    return trained.unionByName(total, allowMissingColumns=True).agg(
        F.try_divide(F.sum("_t").cast("double"), F.sum("_a").cast("double")).alias("trained_fraction")
    )


SAMPLE_BUCKETS = 65_536  # ranges of the sampling hash; one small row each


def seeded_sample(df: DataFrame, key: str | tuple[str, ...], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, count)`` rows: the ``n`` smallest hashes of ``'<seed>:' || key`` (``key`` unique).

    Deterministic under any partitioning, and one plan for every size. Narrow ``(key,
    hash)`` rows are counted per range of the hash; the running count over the ranges (a
    table of at most ``SAMPLE_BUCKETS`` rows) says how many rows come before each range,
    rows are numbered inside their range only, and those whose number is at most ``n``
    are joined back to the rows.
    """
    keys = (key,) if isinstance(key, str) else tuple(key)
    h = df.select(*keys, F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])).alias("_h"))
    h = h.withColumn("_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    counts = h.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_b", F.coalesce(before, F.lit(0)).alias("_before")).filter(F.col("_before") < n)
    at = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *keys))
    chosen = h.join(offsets, "_b").withColumn("_at", F.col("_before") + at).filter(F.col("_at") <= n)
    return df.join(chosen.select(*keys), list(keys), "left_semi")


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest (unique) ``key``: an ordered limit over the keys only,
    joined back (whole rows never meet in one task)."""
    return df.join(df.select(key).orderBy(key).limit(n), key, "left_semi")


KEY_SLOTS, KEYS_A_BLOCK = 16_384, 4  # sampled keys; sampled keys between two blocks
_STEPS = tuple(1 << i for i in reversed(range(KEY_SLOTS.bit_length())))


def key_bounds(df: DataFrame, key: str, slots: int = KEY_SLOTS, each: int = KEYS_A_BLOCK) -> DataFrame:
    """One row ``bounds``: a sorted array of at most ``slots / each`` keys that cut ``df`` evenly.

    Every key falls into a slot of its hash, and a slot keeps the key of the smallest
    hash: a sample that merges task by task, and is the same under any partitioning and
    after any retry. Keys that are null take no part.
    """
    h = F.xxhash64(F.col(key))
    kept = df.filter(F.col(key).isNotNull()).groupBy(F.pmod(h, F.lit(slots)).alias("_slot")).agg(F.min_by(F.col(key), h).alias("_key"))
    keys = kept.agg(F.array_sort(F.collect_set("_key")).alias("_keys"))  # at most ``slots`` keys
    return keys.select(F.filter("_keys", lambda _, i: i % each == each - 1).alias("bounds"))


def block_of(key: Column, bounds: Column) -> Column:
    """How many of the sorted ``bounds`` are at most ``key`` (0 for null), by binary search."""
    step = lambda at, s: at + F.when(F.get(bounds, at + s - 1) <= key, s).otherwise(0)
    return F.coalesce(F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), step), F.lit(0))


def wrapped_packing(lengths: DataFrame, max_seq_length: int, key: str = "conv_id", value: str = "n_tokens",
                    slots: int = KEY_SLOTS) -> DataFrame:
    """Assign rows, concatenated in ``key`` order, to packs of ``max_seq_length`` tokens.

    Output ``(key, pack_id, offset_in_pack, n_tokens)``: one row per piece, a row that
    crosses a pack boundary yields several pieces. The corpus-wide running sum is
    computed without a job of its own: a mergeable sample of the keys alone gives the
    bounds of the blocks, rows are dealt by block once, and that one exchange serves both
    the block totals (prefix-summed, one row a block) and the running sum inside blocks.
    """
    L = int(max_seq_length)
    ranged = (
        lengths.select(key, F.col(value).cast("bigint").alias("_n"))
        .withColumn("_bounds", key_bounds(lengths, key, slots).scalar())
        .select(key, "_n", block_of(F.col(key), F.col("_bounds")).alias("_blk"))
        .repartition("_blk")
    )
    # ``_first`` only keeps the key: both readers of the exchange then ask for the same columns
    block_totals = ranged.groupBy("_blk").agg(F.sum("_n").alias("_bt"), F.min(key).alias("_first"))
    # One row per block: at most slots / KEYS_A_BLOCK + 1 rows, broadcast.
    offsets = block_totals.filter(F.col("_first").isNotNull() | (F.col("_blk") == 0)).select(
        "_blk",
        F.coalesce(
            F.sum("_bt").over(Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_bo"),
    )
    local = F.coalesce(
        F.sum("_n").over(Window.partitionBy("_blk").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = ranged.withColumn("_lo", local).join(F.broadcast(offsets), "_blk").select(
        key, "_n", (F.col("_bo") + F.col("_lo")).alias("_s")
    )
    pieces = starts.select(
        key,
        "_s",
        (F.col("_s") + F.col("_n")).alias("_e"),
        # rows without tokens have no piece; a filter would count the tokens twice
        F.explode(F.when(F.col("_n") > 0, F.sequence(F.floor(F.col("_s") / L), F.floor((F.col("_s") + F.col("_n") - 1) / L)))).alias("pack_id"),
    )
    lo = F.greatest(F.col("_s"), F.col("pack_id") * L)
    hi = F.least(F.col("_e"), (F.col("pack_id") + 1) * L)
    return pieces.select(
        key,
        F.col("pack_id").cast("bigint").alias("pack_id"),
        (lo - F.col("pack_id") * L).cast("bigint").alias("offset_in_pack"),
        (hi - lo).cast("bigint").alias("n_tokens"),
    )
