"""Registered queries over the driver tables and their independent SQL oracles.

Each query reads whole tables (inputs derived row-by-row with ``fixtures`` SQL) and
runs the library operators; each oracle restates the expected result in plain SQL
that DuckDB runs on the same parquet files. Column names match one to one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators import evaluate, generate, metrics, registry, shape, stats, telemetry, validate
from colloquy.functions.replies import with_parsed_reply
from colloquy.plans import fixtures as fx
from colloquy.plans import stubs
from colloquy.session import checkpoint_dir, cut_lineage
from colloquy.streaming import requests as streaming_requests
from colloquy.sources.conversations import assemble_messages, read_table, read_turns
from colloquy.sources import jsonl
from colloquy.sources.telemetry import decode_ndjson, decode_sse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MAX_SEQ = 1536
PLAN = stats.TrainingPlan(max_seq_length=MAX_SEQ)


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


def defect_turns(spark: SparkSession, sf: str) -> DataFrame:
    return read_turns(spark, sf).selectExpr(
        "conv_id", "turn", f"{fx.TURN_ROLE_SQL} AS role", f"{fx.TURN_TEXT_SQL} AS text"
    )


def split_tokens(spark: SparkSession, sf: str) -> DataFrame:
    turns = read_turns(spark, sf).withColumn("split", F.expr(fx.SPLIT_SQL))
    return stats.conversation_tokens(turns, extra=("split",))


_DEFECTS_SQL = f"SELECT conv_id, turn, {fx.TURN_ROLE_SQL} AS role, {fx.TURN_TEXT_SQL} AS text FROM conversations"
# Python str.isspace() set, restated for RE2.
_BLANK_RE = r"^[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*$"
_TOKENS_SQL = r"coalesce(len(regexp_extract_all(text, '[^ \t\n\r]+')), 0)"
_PER_CONV_SQL = f"""
  SELECT conv_id, {fx.SPLIT_SQL} AS split, count(*) AS n_turns,
         CAST(sum(CASE WHEN role = 'assistant' THEN 0 ELSE {_TOKENS_SQL} END) AS BIGINT) AS prompt_tokens,
         CAST(sum(CASE WHEN role = 'assistant' THEN {_TOKENS_SQL} ELSE 0 END) AS BIGINT) AS response_tokens
  FROM conversations GROUP BY conv_id"""
_TOTAL_SQL = "(prompt_tokens + response_tokens + 4 * n_turns + 1)"
_ROLE_NAME_SQL = "CASE role WHEN 'assistant' THEN 'model' ELSE role END"


# ---------------------------------------------------------------- conversations
@register(
    "conv_assemble",
    """SELECT conv_id, count(*) AS n_turns, string_agg(role, ',' ORDER BY turn) AS roles,
              count(*) FILTER (WHERE role = 'assistant') AS n_exchanges, CAST(sum(length(text)) AS BIGINT) AS n_chars
       FROM conversations GROUP BY conv_id""",
)
def q_conv_assemble(spark: SparkSession, sf: str) -> DataFrame:
    conv = assemble_messages(read_turns(spark, sf))
    m = F.col("messages")
    return conv.select(
        "conv_id",
        F.size(m).cast("bigint").alias("n_turns"),
        F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
        F.size(F.filter(m, lambda x: x["role"] == "assistant")).cast("bigint").alias("n_exchanges"),
        F.aggregate(m, F.lit(0).cast("bigint"), lambda acc, x: acc + F.length(x["content"])).alias("n_chars"),
    )


_VALIDATE_ORACLE = f"""
WITH t AS ({_DEFECTS_SQL}),
per_turn AS (
  SELECT conv_id, turn,
    CASE WHEN role IS NULL OR role NOT IN ('system', 'user', 'assistant')
           THEN 'turn_' || CAST(turn AS VARCHAR) || '_invalid_role:' || coalesce(role, 'None')
         WHEN role = 'system' AND turn <> 0 THEN 'system_role_not_first'
         WHEN text IS NULL OR regexp_matches(text, '{_BLANK_RE}') THEN 'turn_' || CAST(turn AS VARCHAR) || '_empty_content'
    END AS r
  FROM t),
first_fail AS (SELECT conv_id, arg_min(r, turn) AS r FROM per_turn WHERE r IS NOT NULL GROUP BY conv_id),
ns AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev
       FROM t WHERE role IS DISTINCT FROM 'system'),
seqs AS (SELECT conv_id, count(*) AS n_ns, arg_min(role, turn) AS first_role,
                bool_or(role = 'assistant' AND prev = 'assistant') AS consec FROM ns GROUP BY conv_id),
convs AS (SELECT conv_id, count(*) AS n_turns FROM t GROUP BY conv_id),
verdict AS (
  SELECT c.conv_id, c.n_turns,
    coalesce(f.r, CASE WHEN coalesce(s.n_ns, 0) = 0 THEN 'no_user_or_assistant_turns'
                       WHEN s.first_role <> 'user' THEN 'does_not_start_with_user_turn'
                       WHEN s.consec THEN 'consecutive_assistant_turns' END) AS reason
  FROM convs c LEFT JOIN first_fail f USING (conv_id) LEFT JOIN seqs s USING (conv_id))
"""


@register(
    "validate_turns",
    _VALIDATE_ORACLE
    + r"""SELECT conv_id, n_turns, reason,
          regexp_replace(regexp_replace(reason, '^turn_\d+_', 'turn_i_'), ':.*$', '') AS reason_class FROM verdict""",
)
def q_validate_turns(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate_turns(defect_turns(spark, sf))


@register(
    "validate_reasons",
    _VALIDATE_ORACLE
    + r"""SELECT reason, count(*) AS n, min(conv_id) AS first_seen,
          regexp_replace(regexp_replace(reason, '^turn_\d+_', 'turn_i_'), ':.*$', '') AS reason_class
          FROM verdict WHERE reason IS NOT NULL GROUP BY reason""",
)
def q_validate_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return validate.reason_histogram(validate.validate_turns(defect_turns(spark, sf)))


@register(
    "validate_summary",
    _VALIDATE_ORACLE
    + """SELECT count(*) AS total, count(*) FILTER (WHERE reason IS NULL) AS valid,
              count(*) FILTER (WHERE reason IS NOT NULL) AS invalid,
              count(DISTINCT regexp_replace(regexp_replace(reason, '^turn_[0-9]+_', 'turn_i_'), ':.*$', '')) AS n_reason_classes,
              (SELECT string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FROM
                 (SELECT conv_id FROM verdict WHERE reason IS NOT NULL ORDER BY conv_id LIMIT 50)) AS dropped
       FROM verdict""",
)
def q_validate_summary(spark: SparkSession, sf: str) -> DataFrame:
    rep = validate.validation_report(validate.validate_turns(defect_turns(spark, sf)))
    return rep.select(
        "total",
        "valid",
        "invalid",
        F.size(F.map_keys("reason_classes")).cast("bigint").alias("n_reason_classes"),
        F.array_join(F.transform("dropped", lambda x: x.cast("string")), ",").alias("dropped"),
    )


# ------------------------------------------------------------------- statistics
@register(
    "dataset_stats",
    f"""WITH c AS ({_PER_CONV_SQL})
    SELECT split, count(*) AS num_examples, round(avg(n_turns), 6) AS avg_turns,
           round(avg(prompt_tokens), 6) AS avg_prompt_tokens, round(avg(response_tokens), 6) AS avg_response_tokens,
           round(avg({_TOTAL_SQL}), 6) AS avg_total_tokens, round(quantile_cont({_TOTAL_SQL}, 0.95), 6) AS p95_total_tokens,
           max({_TOTAL_SQL}) AS max_total_tokens, count(*) FILTER (WHERE {_TOTAL_SQL} > {MAX_SEQ}) AS num_exceeding_max_seq_length,
           CAST(NULL AS DOUBLE) AS packing_efficiency,
           CAST(greatest(floor(count(*) / 16), 1) AS BIGINT) AS estimated_optimizer_steps,
           round(count(*) * {MAX_SEQ}.0 / 500.0 / 3600.0, 9) AS estimated_training_time_hours
    FROM c GROUP BY split""",
)
def q_dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.dataset_statistics(split_tokens(spark, sf), PLAN)
    six = ["avg_turns", "avg_prompt_tokens", "avg_response_tokens", "avg_total_tokens", "p95_total_tokens"]
    return out.select(
        *[F.round(c, 6).alias(c) if c in six else c for c in out.columns if c != "estimated_training_time_hours"],
        F.round("estimated_training_time_hours", 9).alias("estimated_training_time_hours"),
    )


@register(
    "dataset_stats_packed",
    f"""WITH c AS ({_PER_CONV_SQL})
    SELECT split, count(*) AS num_examples, round(avg({_TOTAL_SQL}) / {MAX_SEQ}.0, 9) AS packing_efficiency,
           CAST(greatest(floor(greatest(floor(sum({_TOTAL_SQL}) / {MAX_SEQ}.0), 1) / 16), 1) AS BIGINT) AS estimated_optimizer_steps,
           round(count(*) * avg({_TOTAL_SQL}) / 3000.0 / 3600.0, 9) AS estimated_training_time_hours
    FROM c GROUP BY split""",
)
def q_dataset_stats_packed(spark: SparkSession, sf: str) -> DataFrame:
    plan = stats.TrainingPlan(max_seq_length=MAX_SEQ, packing=True, device="A100")
    out = stats.dataset_statistics(split_tokens(spark, sf), plan)
    return out.select(
        "split",
        "num_examples",
        F.round("packing_efficiency", 9).alias("packing_efficiency"),
        "estimated_optimizer_steps",
        F.round("estimated_training_time_hours", 9).alias("estimated_training_time_hours"),
    )


@register(
    "token_analysis",
    f"""WITH c AS ({_PER_CONV_SQL})
    SELECT split, round(avg({_TOTAL_SQL}), 6) AS mean, round(quantile_cont({_TOTAL_SQL}, 0.5), 6) AS median,
           round(quantile_cont({_TOTAL_SQL}, 0.95), 6) AS p95, max({_TOTAL_SQL}) AS max,
           count(*) FILTER (WHERE {_TOTAL_SQL} > {MAX_SEQ}) AS num_exceeding_max_seq_length, count(*) AS n
    FROM c GROUP BY split""",
)
def q_token_analysis(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.token_analysis(split_tokens(spark, sf), MAX_SEQ)
    return out.select(
        "split", *[F.round(c, 6).alias(c) for c in ("mean", "median", "p95")], "max", "num_exceeding_max_seq_length", "n"
    )


@register(
    "token_histogram",
    f"""WITH c AS (SELECT split, {_TOTAL_SQL} AS v FROM ({_PER_CONV_SQL})),
    b AS (SELECT split, min(v) AS lo, max(v) AS hi FROM c GROUP BY split),
    w AS (SELECT split, lo, hi, CAST(hi - lo AS DOUBLE) / 20.0 AS w FROM b),
    binned AS (SELECT c.split, CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((v - lo) / w) AS INTEGER), 19) END AS bin
               FROM c JOIN w USING (split)),
    counts AS (SELECT split, bin, count(*) AS cnt FROM binned GROUP BY split, bin),
    grid AS (SELECT split, lo, hi, w, unnest(CASE WHEN hi = lo THEN [0] ELSE range(0, 20) END) AS bin FROM w),
    full_ AS (SELECT g.split, g.bin, g.lo, g.hi, g.w, coalesce(c.cnt, 0) AS cnt
              FROM grid g LEFT JOIN counts c USING (split, bin))
    SELECT split, CAST(bin AS INTEGER) AS bin,
           round(lo + bin * CASE WHEN hi = lo THEN 0.0 ELSE w END, 6) AS bucket_lo,
           round(lo + bin * CASE WHEN hi = lo THEN 0.0 ELSE w END + CASE WHEN hi = lo THEN 0.0 ELSE w END, 6) AS bucket_hi,
           cnt AS count,
           repeat('#', CAST(floor(cnt / greatest(max(cnt) OVER (PARTITION BY split), 1) * 50.0) AS INTEGER)) AS bar
    FROM full_""",
)
def q_token_histogram(spark: SparkSession, sf: str) -> DataFrame:
    h = stats.histogram(split_tokens(spark, sf), "total_tokens", bins=20, width=50)
    return h.select(
        "split", "bin", F.round("bucket_lo", 6).alias("bucket_lo"), F.round("bucket_hi", 6).alias("bucket_hi"), "count", "bar"
    )


@register(
    "cost_by_device",
    f"""WITH c AS ({_PER_CONV_SQL}), s AS (SELECT split, count(*) AS n FROM c GROUP BY split),
    d(device, tps) AS (VALUES ('A100', 3000.0), ('L4', 900.0), ('T4', 250.0), ('OTHER', 500.0), ('CPU', 5.0))
    SELECT split, device, round(n * {MAX_SEQ}.0 / CAST(tps AS DOUBLE) / 3600.0, 9) AS estimated_training_time_hours
    FROM s, d""",
)
def q_cost_by_device(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.cost_by_device(stats.dataset_statistics(split_tokens(spark, sf), PLAN), PLAN)
    return out.select("split", "device", F.round("estimated_training_time_hours", 9).alias("estimated_training_time_hours"))


@register(
    "exchanges_per_row",
    """SELECT n_exchanges, count(*) AS n_rows FROM
       (SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS n_exchanges FROM conversations GROUP BY conv_id)
       GROUP BY n_exchanges""",
)
def q_exchanges_per_row(spark: SparkSession, sf: str) -> DataFrame:
    return stats.exchanges_per_row(read_turns(spark, sf))


# ---------------------------------------------------------------------- shaping
_RENDER_SQL = f"'<|turn>' || {_ROLE_NAME_SQL} || chr(10) || coalesce(text, '') || '<turn|>' || chr(10)"


@register(
    "flatten_text",
    f"""SELECT conv_id, '<bos>' || string_agg({_RENDER_SQL}, '' ORDER BY turn) AS text,
              CAST(length('<bos>' || string_agg({_RENDER_SQL}, '' ORDER BY turn)) AS BIGINT) AS n_chars
       FROM conversations GROUP BY conv_id""",
)
def q_flatten_text(spark: SparkSession, sf: str) -> DataFrame:
    flat = shape.flatten_text(read_turns(spark, sf))
    return flat.select("conv_id", "text", F.length("text").cast("bigint").alias("n_chars"))


@register(
    "prompt_gold",
    """SELECT conv_id, count(*) - 1 AS n_prompt_turns, arg_max(text, turn) AS gold
       FROM conversations GROUP BY conv_id HAVING arg_max(role, turn) = 'assistant'""",
)
def q_prompt_gold(spark: SparkSession, sf: str) -> DataFrame:
    return shape.prompt_gold(read_turns(spark, sf))


@register(
    "prompt_prefix",
    f"""WITH last AS (SELECT conv_id, max(turn) AS lt, arg_max(role, turn) AS lr FROM conversations GROUP BY conv_id)
    SELECT c.conv_id, '<bos>' || coalesce(string_agg({_RENDER_SQL}, '' ORDER BY turn), '') || '<|turn>model' || chr(10) AS prompt
    FROM conversations c JOIN last l ON c.conv_id = l.conv_id AND l.lr = 'assistant' AND c.turn < l.lt
    GROUP BY c.conv_id""",
)
def q_prompt_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return shape.prompt_prefix(read_turns(spark, sf))


@register(
    "response_spans",
    f"""WITH p AS (
      SELECT conv_id, turn, role,
             length('<|turn>' || {_ROLE_NAME_SQL} || chr(10)) AS hl,
             length('<|turn>' || {_ROLE_NAME_SQL} || chr(10)) + length(coalesce(text, '')) + length('<turn|>' || chr(10)) AS pl
      FROM conversations),
    o AS (SELECT *, 5 + coalesce(sum(pl) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ts,
                 5 + sum(pl) OVER (PARTITION BY conv_id) AS total FROM p),
    n AS (SELECT *, min(CASE WHEN role = 'user' THEN ts END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM o)
    SELECT conv_id, turn, CAST(ts + hl AS BIGINT) AS span_start, CAST(coalesce(nxt, total) AS BIGINT) AS span_end
    FROM n WHERE role = 'assistant'""",
)
def q_response_spans(spark: SparkSession, sf: str) -> DataFrame:
    return shape.response_spans(read_turns(spark, sf))


@register(
    "marker_guard",
    """SELECT bool_and(contains(t, '<|turn>user' || chr(10)) AND contains(t, '<|turn>model' || chr(10))) AS markers_ok,
              count(*) FILTER (WHERE NOT (contains(t, '<|turn>user' || chr(10)) AND contains(t, '<|turn>model' || chr(10)))) AS n_rows_missing_markers,
              count(*) AS n_rows
       FROM (SELECT conv_id, string_agg('<|turn>' || CASE role WHEN 'assistant' THEN 'model' ELSE role END || chr(10) || text || '<turn|>' || chr(10), '' ORDER BY turn) AS t
             FROM conversations GROUP BY conv_id)""",
)
def q_marker_guard(spark: SparkSession, sf: str) -> DataFrame:
    return shape.marker_guard_of_turns(read_turns(spark, sf))


@register(
    "wrapped_packing",
    f"""WITH c AS (SELECT conv_id, {_TOTAL_SQL} AS n FROM ({_PER_CONV_SQL})),
    s AS (SELECT conv_id, n, coalesce(sum(n) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM c WHERE n > 0),
    p AS (SELECT conv_id, n, st, unnest(range(CAST(floor(st / {MAX_SEQ}.0) AS BIGINT), CAST(floor((st + n - 1) / {MAX_SEQ}.0) AS BIGINT) + 1)) AS pack_id FROM s)
    SELECT conv_id, CAST(pack_id AS BIGINT) AS pack_id,
           CAST(greatest(st, pack_id * {MAX_SEQ}) - pack_id * {MAX_SEQ} AS BIGINT) AS offset_in_pack,
           CAST(least(st + n, (pack_id + 1) * {MAX_SEQ}) - greatest(st, pack_id * {MAX_SEQ}) AS BIGINT) AS n_tokens
    FROM p""",
)
def q_wrapped_packing(spark: SparkSession, sf: str) -> DataFrame:
    per = stats.conversation_tokens(read_turns(spark, sf)).select("conv_id", F.col("total_tokens").alias("n_tokens"))
    return shape.wrapped_packing(per, MAX_SEQ)


@register(
    "doc_packing",
    r"""WITH c AS (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^ \t\n\r]+')), 0) AS n FROM documents),
    s AS (SELECT doc_id, n, coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM c WHERE n > 0),
    p AS (SELECT doc_id, n, st, unnest(range(CAST(floor(st / 2048.0) AS BIGINT), CAST(floor((st + n - 1) / 2048.0) AS BIGINT) + 1)) AS pack_id FROM s)
    SELECT doc_id, CAST(pack_id AS BIGINT) AS pack_id,
           CAST(greatest(st, pack_id * 2048) - pack_id * 2048 AS BIGINT) AS offset_in_pack,
           CAST(least(st + n, (pack_id + 1) * 2048) - greatest(st, pack_id * 2048) AS BIGINT) AS n_tokens
    FROM p""",
)
def q_doc_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    docs = docs.select("doc_id", stats.whitespace_tokens(F.col("text")).alias("n_tokens"))
    return shape.wrapped_packing(docs, 2048, key="doc_id")


@register(
    "seeded_sample",
    """SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id
       ORDER BY md5('42:' || CAST(conv_id AS VARCHAR)), conv_id LIMIT 50""",
)
def q_seeded_sample(spark: SparkSession, sf: str) -> DataFrame:
    per = read_turns(spark, sf).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    return shape.seeded_sample(per, "conv_id", 50, seed=42)


@register(
    "doc_sample",
    """SELECT doc_id, lang, n_chars FROM documents ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100""",
)
def q_doc_sample(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return shape.seeded_sample(docs, "doc_id", 100, seed=7)


# --------------------------------------------------------------- reply scoring
def dealt(df: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt by ``key`` over the session's shuffle partitions, at every size:
    the reply texts made from them cost far more to parse than these rows to move."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def order_replies(spark: SparkSession, sf: str) -> DataFrame:
    orders = dealt(read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"), "o_orderkey")
    return orders.selectExpr("o_orderkey", f"{fx.GOLD_SQL} AS gold", f"{fx.GENERATED_SQL} AS generated")


def _pairs_text(c):
    return F.array_join(F.transform(c, lambda p: F.concat(p["src"], F.lit("=>"), p["dst"])), "|")


_EXPECT_SQL = f"""
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 8 = 5 AND o_orderkey % 3 <> 0 THEN NULL ELSE {fx.NORM_CANON_SQL} END AS norm,
    CASE WHEN o_orderkey % 8 = 4 THEN NULL ELSE {fx.LEX_CANON_SQL} END AS lexemes,
    CASE WHEN o_orderkey % 8 = 2 THEN 'UNSUPPORTED' WHEN o_orderkey % 13 = 0 THEN NULL ELSE {fx.OP_SQL} END AS intent,
    CASE WHEN o_orderkey % 8 = 6 THEN NULL ELSE {fx.SEM_CANON_SQL} END AS semantic,
    CASE WHEN o_orderkey % 8 = 3 THEN NULL WHEN o_orderkey % 8 = 7 THEN {fx.ENV_WRONG_CANON_SQL} ELSE {fx.ENV_CANON_SQL} END AS envelope,
    CAST(CASE WHEN o_orderkey % 8 IN (3, 7) THEN 0.0 ELSE 1.0 END AS DOUBLE) AS exact_match,
    CAST(CASE WHEN o_orderkey % 8 = 5 AND o_orderkey % 3 <> 0 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS pass_0_score,
    CAST(CASE WHEN o_orderkey % 8 = 4 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS pass_1_score,
    CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 8 = 2 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS pass_2_score,
    CAST(CASE WHEN o_orderkey % 8 = 6 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS pass_3_score,
    CAST(CASE WHEN o_orderkey % 8 IN (3, 7) THEN 0.0 ELSE 1.0 END AS DOUBLE) AS pass_4_score,
    o_orderkey % 8 = 5 AND o_orderkey % 3 <> 0 AS pu0, o_orderkey % 8 = 4 AS pu1, o_orderkey % 13 <> 0 AND o_orderkey % 8 = 2 AS pu2x,
    o_orderkey % 8 = 6 AS pu3, o_orderkey % 8 = 3 AS pu4
  FROM orders"""


@register("parse_replies", f"SELECT o_orderkey, norm, lexemes, intent, semantic, envelope FROM ({_EXPECT_SQL})")
def q_parse_replies(spark: SparkSession, sf: str) -> DataFrame:
    p = with_parsed_reply(order_replies(spark, sf).select("o_orderkey", "generated"), "generated", "p")
    return p.select(
        "o_orderkey",
        _pairs_text(F.col("p.norm")).alias("norm"),
        F.array_join("p.lexemes", "|").alias("lexemes"),
        F.col("p.intent").alias("intent"),
        F.col("p.semantic").alias("semantic"),
        F.col("p.envelope").alias("envelope"),
    )


@register(
    "reply_scores",
    f"SELECT o_orderkey, exact_match, pass_0_score, pass_1_score, pass_2_score, pass_3_score, pass_4_score FROM ({_EXPECT_SQL})",
)
def q_reply_scores(spark: SparkSession, sf: str) -> DataFrame:
    s = evaluate.score_predictions(order_replies(spark, sf))
    return s.select("o_orderkey", "exact_match", *[f"pass_{i}_score" for i in range(5)])


_PASS_ACC_ORACLE = f"""WITH e AS ({_EXPECT_SQL}),
u AS (
  SELECT 'PASS_0' AS pass_name, pass_0_score AS s, pu0 AS pu FROM e UNION ALL
  SELECT 'PASS_1', pass_1_score, pu1 FROM e UNION ALL
  SELECT 'PASS_2', pass_2_score, false FROM e UNION ALL
  SELECT 'PASS_3', pass_3_score, pu3 FROM e UNION ALL
  SELECT 'PASS_4', pass_4_score, pu4 FROM e)
SELECT pass_name, round(coalesce(sum(s) / nullif(count(s), 0), 0.0), 9) AS accuracy, count(s) AS num_scored,
       count(*) FILTER (WHERE s IS NULL) AS num_gold_unparseable,
       count(*) FILTER (WHERE s IS NOT NULL AND pu) AS num_prediction_unparseable
FROM u GROUP BY pass_name"""


@register("pass_accuracy", _PASS_ACC_ORACLE)
def q_pass_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    acc = evaluate.pass_accuracy(evaluate.parse_pair(order_replies(spark, sf)))
    return acc.withColumn("accuracy", F.round("accuracy", 9))


@register(
    "exact_match_rate",
    f"SELECT round(avg(exact_match), 9) AS exact_match_rate, count(*) AS num_examples FROM ({_EXPECT_SQL})",
)
def q_exact_match_rate(spark: SparkSession, sf: str) -> DataFrame:
    rate = evaluate.exact_match_rate(evaluate.score_predictions(order_replies(spark, sf)))
    return rate.select(F.round("exact_match_rate", 9).alias("exact_match_rate"), "num_examples")


# ------------------------------------------------------------------ robustness
def robustness_results(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events").selectExpr(
        "CAST(user_id AS STRING) AS group_id", f"{fx.LEVEL_SQL} AS level", "event_id AS seq",
        f"{fx.ROBUST_REPLY_SQL} AS generated",
    )
    ev = ev.withColumn("level_name", evaluate.level_name_column(F.col("level")))
    return evaluate.robustness_of_replies(ev).drop("generated")


_ROBUST_ORACLE = f"""WITH e AS (
  SELECT CAST(user_id AS VARCHAR) AS group_id, CAST(1 + event_id % 4 AS INTEGER) AS level, event_id AS seq,
         CASE WHEN event_type = 'error' THEN NULL WHEN event_type IN ('view', 'click') THEN 'LOOKUP' ELSE upper(event_type) END AS env
  FROM events),
r AS (SELECT group_id, max(seq) FILTER (WHERE level = 1) AS rs FROM e GROUP BY group_id),
ref AS (SELECT r.group_id, r.rs, e.env AS renv FROM r LEFT JOIN e ON e.group_id = r.group_id AND e.seq = r.rs),
m AS (SELECT e.group_id, e.level, e.seq,
        CASE WHEN e.level > 1 AND ref.rs IS NOT NULL AND ref.renv IS NOT NULL THEN coalesce(e.env = ref.renv, false) END AS matches_level1
      FROM e JOIN ref USING (group_id))
"""


@register("robustness", _ROBUST_ORACLE + "SELECT group_id, level, seq, matches_level1 FROM m")
def q_robustness(spark: SparkSession, sf: str) -> DataFrame:
    return robustness_results(spark, sf).select("group_id", "level", "seq", "matches_level1")


@register(
    "robustness_summary",
    _ROBUST_ORACLE
    + """SELECT level,
           CASE level WHEN 1 THEN 'Explicit entity + explicit identifier' WHEN 2 THEN 'Synonyms'
                      WHEN 3 THEN 'Implicit entity from identifier' ELSE 'Natural operator language' END AS level_name,
           count(*) AS num_queries,
           CASE WHEN level <> 1 THEN count(matches_level1) END AS num_scoreable,
           CASE WHEN level <> 1 THEN round(coalesce(count(*) FILTER (WHERE matches_level1) / nullif(count(matches_level1), 0), 0.0), 9) END AS consistency_with_level1,
           CASE WHEN level = 1 THEN 'reference level — each group''s own baseline, not scored against itself' END AS note
    FROM m GROUP BY level""",
)
def q_robustness_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = evaluate.robustness_summary(robustness_results(spark, sf))
    return s.withColumn("consistency_with_level1", F.round("consistency_with_level1", 9))


# ------------------------------------------------------------------- telemetry
def chunk_log(spark: SparkSession, sf: str, line_sql: str) -> DataFrame:
    return read_table(spark, sf, "events").selectExpr(
        f"{fx.REQUEST_SQL} AS request_id", "event_id AS seq", "ts AS arrived_at", f"{line_sql} AS line"
    )


def _rounded_metrics(m: DataFrame) -> DataFrame:
    return m.select(
        "request_id",
        "text",
        F.round("ttft_seconds", 6).alias("ttft_seconds"),
        F.round("total_seconds", 6).alias("total_seconds"),
        "tokens_generated",
        F.round("tokens_per_second", 6).alias("tokens_per_second"),
    )


def sse_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.request_metrics(decode_sse(chunk_log(spark, sf, fx.SSE_LINE_SQL)), end_inclusive=False)


def ndjson_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.request_metrics(decode_ndjson(chunk_log(spark, sf, fx.NDJSON_LINE_SQL)), end_inclusive=True)


_SSE_ORACLE = f"""WITH l AS (
  SELECT {fx.REQUEST_SQL} AS rid, event_id AS seq, epoch_us(ts) AS us, trim({fx.SSE_LINE_SQL}) AS line FROM events),
d AS (SELECT rid, seq, us, starts_with(line, 'data: ') AS is_data,
             starts_with(line, 'data: ') AND substr(line, 7) = '[DONE]' AS is_end, substr(line, 7) AS payload FROM l),
d2 AS (SELECT *, CASE WHEN is_data AND NOT is_end THEN json_extract_string(payload, '$.choices[0].delta.content') END AS delta,
              CASE WHEN is_data AND NOT is_end THEN CAST(json_extract(payload, '$.usage.completion_tokens') AS BIGINT) END AS usage
       FROM d),
b AS (SELECT rid, min(us) AS st, max(us) AS last_us, min(seq) FILTER (WHERE is_end) AS es,
             arg_min(us, seq) FILTER (WHERE is_end) AS eus FROM d2 GROUP BY rid),
k AS (SELECT d2.* FROM d2 JOIN b USING (rid) WHERE is_data AND (es IS NULL OR seq < es)),
s AS (SELECT rid, min(us) FILTER (WHERE coalesce(delta, '') <> '') AS fu,
             arg_max(usage, seq) FILTER (WHERE usage IS NOT NULL) AS usage,
             string_agg(coalesce(delta, ''), '' ORDER BY seq) AS text FROM k GROUP BY rid),
x AS (SELECT b.rid, coalesce(s.text, '') AS text, (coalesce(eus, last_us) - st) / 1e6 AS total,
             CASE WHEN fu IS NOT NULL THEN (fu - st) / 1e6 ELSE (coalesce(eus, last_us) - st) / 1e6 END AS ttft,
             coalesce(usage, 0) AS tokens
      FROM b LEFT JOIN s USING (rid)),
mt AS (SELECT rid AS request_id, text, round(ttft, 6) AS ttft_seconds, round(total, 6) AS total_seconds,
              CAST(tokens AS BIGINT) AS tokens_generated,
              round(CASE WHEN tokens > 1 AND total > ttft THEN (tokens - 1) / (total - ttft) ELSE 0.0 END, 6) AS tokens_per_second,
              ttft AS rt, total AS rtot, CASE WHEN tokens > 1 AND total > ttft THEN (tokens - 1) / (total - ttft) ELSE 0.0 END AS rtps
       FROM x)
"""


@register(
    "request_metrics",
    _SSE_ORACLE + "SELECT request_id, text, ttft_seconds, total_seconds, tokens_generated, tokens_per_second FROM mt",
)
def q_request_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_metrics(sse_metrics(spark, sf))


@register(
    "metrics_summary",
    _SSE_ORACLE
    + """SELECT count(*) AS num_queries, round(avg(rt), 6) AS avg_ttft_seconds, round(avg(rtot), 6) AS avg_total_seconds,
              round(avg(rtps), 6) AS avg_tokens_per_second, CAST(sum(tokens_generated) AS BIGINT) AS total_tokens_generated FROM mt""",
)
def q_metrics_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = telemetry.metrics_summary(sse_metrics(spark, sf))
    return s.select(
        "num_queries",
        *[F.round(c, 6).alias(c) for c in ("avg_ttft_seconds", "avg_total_seconds", "avg_tokens_per_second")],
        "total_tokens_generated",
    )


@register(
    "ndjson_metrics",
    f"""WITH l AS (
  SELECT {fx.REQUEST_SQL} AS rid, event_id AS seq, epoch_us(ts) AS us, trim({fx.NDJSON_LINE_SQL}) AS line FROM events),
d AS (SELECT rid, seq, us, line <> '' AS is_line,
             line <> '' AND coalesce(CAST(json_extract(line, '$.done') AS VARCHAR) = 'true', false) AS is_end,
             json_extract_string(line, '$.message.content') AS delta FROM l),
d2 AS (SELECT d.*, CASE WHEN is_end THEN CAST(json_extract(l.line, '$.eval_count') AS BIGINT) END AS ec,
              CASE WHEN is_end THEN CAST(json_extract(l.line, '$.eval_duration') AS BIGINT) END AS ens
       FROM d JOIN l USING (rid, seq)),
b AS (SELECT rid, min(us) AS st, max(us) AS last_us, min(seq) FILTER (WHERE is_end) AS es,
             arg_min(us, seq) FILTER (WHERE is_end) AS eus FROM d2 GROUP BY rid),
k AS (SELECT d2.* FROM d2 JOIN b USING (rid) WHERE is_line AND (es IS NULL OR seq <= es)),
s AS (SELECT rid, min(us) FILTER (WHERE coalesce(delta, '') <> '') AS fu, max(ec) AS ec, max(ens) AS ens,
             string_agg(coalesce(delta, ''), '' ORDER BY seq) AS text FROM k GROUP BY rid),
x AS (SELECT b.rid, coalesce(s.text, '') AS text, (coalesce(eus, last_us) - st) / 1e6 AS total,
             CASE WHEN fu IS NOT NULL THEN (fu - st) / 1e6 ELSE (coalesce(eus, last_us) - st) / 1e6 END AS ttft,
             coalesce(ec, 0) AS tokens, ens
      FROM b LEFT JOIN s USING (rid))
SELECT rid AS request_id, text, round(ttft, 6) AS ttft_seconds, round(total, 6) AS total_seconds, CAST(tokens AS BIGINT) AS tokens_generated,
       round(CASE WHEN ens IS NOT NULL AND ens <> 0 AND tokens <> 0 THEN tokens / (ens / 1e9)
                  WHEN tokens > 1 AND total > ttft THEN (tokens - 1) / (total - ttft) ELSE 0.0 END, 6) AS tokens_per_second
FROM x""",
)
def q_ndjson_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_metrics(ndjson_metrics(spark, sf))


# -------------------------------------------------------------------- registry
def runs_table(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return orders.selectExpr(
        "o_orderkey", f"{fx.BASE_DIR_SQL} AS base_dir", f"{fx.RUN_NAME_SQL} AS run_name", f"{fx.HAS_ADAPTER_SQL} AS has_adapter"
    )


def checkpoints_table(spark: SparkSession, sf: str) -> DataFrame:
    items = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_tax")
    items = items.selectExpr(
        "l_orderkey AS o_orderkey", f"{fx.CKPT_NAME_SQL} AS name", f"{fx.CKPT_LOSS_SQL} AS eval_loss"
    )
    return items.join(runs_table(spark, sf).select("o_orderkey", "base_dir", "run_name"), "o_orderkey").drop("o_orderkey")


def uneven_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """Checkpoints where some runs hold only ``checkpoint-final`` and some losses are null."""
    return checkpoints_table(spark, sf).selectExpr("base_dir", "run_name", f"{_FINAL_SQL} AS name", f"{_UNKNOWN_LOSS_SQL} AS eval_loss")


_FINAL_SQL = "CASE WHEN right(run_name, 1) IN ('1', '4', '7') THEN 'checkpoint-final' ELSE name END"
_UNKNOWN_LOSS_SQL = "CASE WHEN right(name, 1) IN ('0', '5') THEN NULL ELSE eval_loss END"


_RUNS_SQL = f"SELECT o_orderkey, {fx.BASE_DIR_SQL} AS base_dir, {fx.RUN_NAME_SQL} AS run_name, {fx.HAS_ADAPTER_SQL} AS has_adapter FROM orders"
_CKPT_SQL = f"""SELECT r.base_dir, r.run_name, {fx.CKPT_NAME_SQL} AS name, {fx.CKPT_LOSS_SQL} AS eval_loss
  FROM lineitem JOIN ({_RUNS_SQL}) r ON l_orderkey = r.o_orderkey"""
_CKPT_NUM_SQL = rf"""SELECT *, CAST(regexp_extract(name, '^checkpoint-(\d+)$', 1) AS BIGINT) AS step
  FROM ({_CKPT_SQL}) WHERE regexp_matches(name, '^checkpoint-\d+$')"""


@register(
    "latest_checkpoint",
    f"""SELECT base_dir, run_name, arg_max(name, step) AS latest_checkpoint, max(step) AS latest_step
    FROM ({_CKPT_NUM_SQL}) GROUP BY base_dir, run_name""",
)
def q_latest_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return registry.latest_checkpoint(checkpoints_table(spark, sf))


@register(
    "latest_synced_run",
    f"""SELECT base_dir, max(run_name) AS latest_run FROM ({_RUNS_SQL})
    WHERE starts_with(run_name, 'run_') AND has_adapter GROUP BY base_dir""",
)
def q_latest_synced_run(spark: SparkSession, sf: str) -> DataFrame:
    return registry.latest_synced_run(runs_table(spark, sf))


@register(
    "latest_resumable_run",
    rf"""SELECT base_dir, max(run_name) AS resume_run FROM ({_RUNS_SQL}) r
    WHERE regexp_matches(run_name, '^run_\d{{8}}_\d{{6}}$')
      AND EXISTS (SELECT 1 FROM (SELECT base_dir, run_name, {_FINAL_SQL} AS name FROM ({_CKPT_SQL})) c
                  WHERE c.base_dir = r.base_dir AND c.run_name = r.run_name AND starts_with(c.name, 'checkpoint-'))
    GROUP BY base_dir""",
)
def q_latest_resumable_run(spark: SparkSession, sf: str) -> DataFrame:
    return registry.latest_resumable_run(runs_table(spark, sf), uneven_checkpoints(spark, sf))


@register(
    "stale_checkpoints",
    rf"""WITH u AS (SELECT base_dir, run_name, {_FINAL_SQL} AS name, {_UNKNOWN_LOSS_SQL} AS eval_loss FROM ({_CKPT_SQL})),
    c AS (SELECT *, CAST(regexp_extract(name, '^checkpoint-(\d+)$', 1) AS BIGINT) AS step FROM u WHERE regexp_matches(name, '^checkpoint-\d+$')),
    best AS (SELECT base_dir, run_name, name AS best FROM
               (SELECT base_dir, run_name, name, row_number() OVER (PARTITION BY base_dir, run_name ORDER BY eval_loss, step) AS rn
                FROM c WHERE eval_loss IS NOT NULL)
             WHERE rn = 1),
    latest AS (SELECT base_dir, run_name, arg_max(name, step) AS latest FROM c GROUP BY base_dir, run_name)
    SELECT c.base_dir, c.run_name, c.name, c.eval_loss, c.step FROM c
    LEFT JOIN best USING (base_dir, run_name) JOIN latest USING (base_dir, run_name)
    WHERE c.name IS DISTINCT FROM best.best AND c.name <> latest.latest""",
)
def q_stale_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    stale = registry.stale_checkpoints(uneven_checkpoints(spark, sf))
    return stale.select("base_dir", "run_name", "name", "eval_loss", registry.checkpoint_step(F.col("name")).alias("step"))


@register(
    "inherit_manifest",
    f"""WITH p AS (SELECT {fx.PRIOR_PATH_SQL} AS adapter_path, {fx.PRIOR_BASE_SQL} AS base_model, {fx.PRIOR_R_SQL} AS lora_r,
                          {fx.PRIOR_ALPHA_SQL} AS lora_alpha, {fx.PRIOR_LEN_SQL} AS max_seq_length FROM customer),
    c AS (SELECT o_orderkey, 'base-' || o_orderpriority AS base_model, CAST(16 AS BIGINT) AS lora_r, CAST(32 AS BIGINT) AS lora_alpha,
                 CAST(1536 AS BIGINT) AS max_seq_length, {fx.CHILD_LINK_SQL} AS continue_adapter FROM orders)
    SELECT c.o_orderkey, coalesce(p.base_model, c.base_model) AS base_model, coalesce(p.lora_r, c.lora_r) AS lora_r,
           coalesce(p.lora_alpha, c.lora_alpha) AS lora_alpha, coalesce(p.max_seq_length, c.max_seq_length) AS max_seq_length,
           CASE WHEN c.continue_adapter IS NOT NULL THEN 'continue_lora' ELSE 'fresh_lora' END AS training_mode
    FROM c LEFT JOIN p ON c.continue_adapter = p.adapter_path""",
)
def q_inherit_manifest(spark: SparkSession, sf: str) -> DataFrame:
    priors = read_table(spark, sf, "customer").selectExpr(
        f"{fx.PRIOR_PATH_SQL} AS adapter_path", f"{fx.PRIOR_BASE_SQL} AS base_model", f"{fx.PRIOR_R_SQL} AS lora_r",
        f"{fx.PRIOR_ALPHA_SQL} AS lora_alpha", f"{fx.PRIOR_LEN_SQL} AS max_seq_length",
    )
    configs = read_table(spark, sf, "orders").selectExpr(
        "o_orderkey", "'base-' || o_orderpriority AS base_model", "CAST(16 AS BIGINT) AS lora_r",
        "CAST(32 AS BIGINT) AS lora_alpha", "CAST(1536 AS BIGINT) AS max_seq_length", f"{fx.CHILD_LINK_SQL} AS continue_adapter",
    )
    out = registry.inherit_from_prior(configs, priors)
    return out.select("o_orderkey", "base_model", "lora_r", "lora_alpha", "max_seq_length", "training_mode")


# --------------------------------------------------------------- metric series
def trainer_logs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").selectExpr(
        "CAST(user_id % 20 AS BIGINT) AS run_id", "event_id AS step", "ts", f"{fx.LOG_SOURCE_SQL} AS source",
        f"{fx.LOG_KEY_SQL} AS key", "value",
    )


_SERIES_SQL = f"""SELECT CAST(user_id % 20 AS BIGINT) AS run_id, event_id AS step, ts, value,
    CASE WHEN event_type = 'error' THEN 'eval/loss' ELSE 'train/' || ({fx.LOG_KEY_SQL}) END AS metric FROM events"""


@register(
    "metric_summary",
    f"""SELECT run_id, metric, arg_max(value, step) AS last_value, max(step) AS last_step, count(*) AS n_points
    FROM ({_SERIES_SQL}) GROUP BY run_id, metric""",
)
def q_metric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.summary(metrics.to_series(trainer_logs(spark, sf)))


@register("metric_every_n", f"SELECT run_id, step, metric, value FROM ({_SERIES_SQL}) WHERE step % 50 = 0")
def q_metric_every_n(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.every_n(metrics.to_series(trainer_logs(spark, sf)), 50).select("run_id", "step", "metric", "value")


@register(
    "throughput_eta",
    """WITH l AS (SELECT CAST(user_id % 20 AS BIGINT) AS run_id, event_id AS step, epoch_us(ts) AS us FROM events),
    s AS (SELECT run_id, min(us) AS t0 FROM l GROUP BY run_id),
    x AS (SELECT l.run_id, l.step, (us - t0) / 1e6 AS el FROM l JOIN s USING (run_id) WHERE l.step > 0)
    SELECT run_id, step, round(el, 6) AS elapsed_seconds, round(step * 16 / greatest(el, 1e-6), 6) AS examples_per_sec,
           round(step * 16 / greatest(el, 1e-6) * 1536.0, 4) AS tokens_per_sec,
           round((100000 - step) * (el / step), 4) AS eta_seconds
    FROM x""",
)
def q_throughput_eta(spark: SparkSession, sf: str) -> DataFrame:
    t = metrics.throughput(trainer_logs(spark, sf), metrics.ThroughputPlan(max_steps=100000))
    return t.select(
        "run_id", "step", F.round("elapsed_seconds", 6).alias("elapsed_seconds"),
        F.round("examples_per_sec", 6).alias("examples_per_sec"), F.round("tokens_per_sec", 4).alias("tokens_per_sec"),
        F.round("eta_seconds", 4).alias("eta_seconds"),
    )


# ------------------------------------------------------------------ generation
_PY_WS_SQL = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


@register(
    "generate_eval",
    f"""WITH last AS (SELECT conv_id, max(turn) AS lt, arg_max(role, turn) AS lr, arg_max(text, turn) AS gold
                      FROM conversations GROUP BY conv_id),
    g AS (SELECT l.conv_id, coalesce(c.text, '') AS generated, l.gold FROM last l
          LEFT JOIN conversations c ON c.conv_id = l.conv_id AND c.turn = l.lt - 1 WHERE l.lr = 'assistant')
    SELECT conv_id, generated, CAST(CASE WHEN trim(generated, '{_PY_WS_SQL}') = trim(gold, '{_PY_WS_SQL}') THEN 1.0 ELSE 0.0 END AS DOUBLE) AS exact_match,
           'ok' AS status
    FROM g""",
)
def q_generate_eval(spark: SparkSession, sf: str) -> DataFrame:
    conv = assemble_messages(read_turns(spark, sf))
    prompts = shape.prompt_gold_records(conv)
    gen = generate.generate(prompts, batch_factory=stubs.echo_last_turn_batch_factory, batch_size=8)
    rec = generate.prediction_records(gen, "conv_id")
    return rec.select("conv_id", "generated", "exact_match", "status")


# ------------------------------------------------------------------ raw JSONL
@register(
    "jsonl_validate",
    _VALIDATE_ORACLE
    + """SELECT conv_id, CASE
        WHEN conv_id % 9 = 0 THEN 'invalid_json:Expecting property name enclosed in double quotes'
        WHEN conv_id % 9 = 1 THEN 'not_a_json_object'
        WHEN conv_id % 18 IN (2, 11) THEN 'missing_messages_key'
        WHEN conv_id % 18 IN (3, 12) THEN 'messages_not_a_nonempty_list'
        WHEN conv_id % 9 = 4 THEN 'turn_0_invalid_role:5'
        WHEN conv_id % 9 = 5 THEN 'invalid_json:Extra data'
        WHEN conv_id % 9 = 6 THEN 'turn_0_not_a_dict'
        ELSE reason END AS reason
    FROM verdict WHERE conv_id % 9 <> 7""",
)
def q_jsonl_validate(spark: SparkSession, sf: str) -> DataFrame:
    conv = assemble_messages(defect_turns(spark, sf))
    lines = conv.select("conv_id", F.to_json(F.struct("messages")).alias("json_line")).selectExpr(
        "conv_id", f"{fx.JSONL_LINE_SQL} AS value"
    )
    return jsonl.validate_lines(lines).select("conv_id", "reason")


# ------------------------------------------------------------------- streaming
@register(
    "stream_request_metrics",
    _SSE_ORACLE + "SELECT request_id, text, ttft_seconds, total_seconds, tokens_generated, tokens_per_second FROM mt",
)
def q_stream_request_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The SSE metrics query as a Structured Streaming job over the events files."""
    src = sf.rstrip("/")
    schema = read_table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/event[s].parquet")
    log = stream.selectExpr(
        f"{fx.REQUEST_SQL} AS request_id", "event_id AS seq", "ts AS arrived_at", f"{fx.SSE_LINE_SQL} AS line"
    )
    metrics_stream = streaming_requests.request_metrics_single_pass(decode_sse(log), end_inclusive=False)
    run = uuid.uuid4().hex
    out = f"{checkpoint_dir(spark).rstrip('/')}/results/stream_request_metrics-{run}"
    streaming_requests.run_complete_to_table(metrics_stream, out, f"stream_request_metrics-{run}")
    return _rounded_metrics(spark.read.parquet(out))


# --------------------------------------------------------- more statistics
@register(
    "length_distribution",
    f"""WITH t AS (SELECT role, {_TOKENS_SQL} AS n FROM conversations)
    SELECT role, round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.99), 6) AS p99, max(n) AS max,
           count(*) AS n, count(*) FILTER (WHERE n >= 400) AS n_at_budget
    FROM t GROUP BY role""",
)
def q_length_distribution(spark: SparkSession, sf: str) -> DataFrame:
    t = read_turns(spark, sf).select("role", stats.whitespace_tokens(F.col("text")).alias("n_tokens"))
    d = stats.length_distribution(t, "n_tokens", group="role", max_tokens=400)
    return d.select("role", F.round("median", 6).alias("median"), F.round("p99", 6).alias("p99"),
                    F.col("max"), F.col("n"), "n_at_budget")


@register(
    "masked_fraction",
    f"""WITH p AS (
      SELECT conv_id, turn, role,
             length('<|turn>' || {_ROLE_NAME_SQL} || chr(10)) AS hl,
             length('<|turn>' || {_ROLE_NAME_SQL} || chr(10)) + length(coalesce(text, '')) + length('<turn|>' || chr(10)) AS pl
      FROM conversations),
    o AS (SELECT *, 5 + coalesce(sum(pl) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ts,
                 5 + sum(pl) OVER (PARTITION BY conv_id) AS total FROM p),
    n AS (SELECT *, min(CASE WHEN role = 'user' THEN ts END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM o),
    spans AS (SELECT sum(coalesce(nxt, total) - (ts + hl)) AS trained FROM n WHERE role = 'assistant'),
    texts AS (SELECT sum(total) AS chars FROM (SELECT DISTINCT conv_id, total FROM o))
    SELECT round(trained / chars, 9) AS trained_fraction FROM spans, texts""",
)
def q_masked_fraction(spark: SparkSession, sf: str) -> DataFrame:
    t = read_turns(spark, sf)
    m = shape.masked_fraction(shape.response_spans(t), shape.text_lengths(t))
    return m.select(F.round("trained_fraction", 9).alias("trained_fraction"))


@register(
    "split_row_counts",
    f"SELECT split, count(*) AS rows FROM (SELECT DISTINCT conv_id, {fx.SPLIT_SQL} AS split FROM conversations) GROUP BY split",
)
def q_split_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    convs = read_turns(spark, sf).select("conv_id").distinct().withColumn("split", F.expr(fx.SPLIT_SQL))
    return registry.split_row_counts(convs)


@register(
    "prompt_before_reply",
    """WITH f AS (SELECT conv_id, min(turn) FILTER (WHERE role = 'assistant') AS fa FROM conversations GROUP BY conv_id)
    SELECT c.conv_id, count(*) FILTER (WHERE f.fa IS NULL OR c.turn < f.fa) AS n_prompt_turns,
           CAST(coalesce(sum(length(c.text)) FILTER (WHERE f.fa IS NULL OR c.turn < f.fa), 0) AS BIGINT) AS prompt_chars
    FROM conversations c JOIN f USING (conv_id) GROUP BY c.conv_id""",
)
def q_prompt_before_reply(spark: SparkSession, sf: str) -> DataFrame:
    p = shape.prompt_before_first_reply(assemble_messages(read_turns(spark, sf)))
    m = F.col("prompt_messages")
    return p.select(
        "conv_id",
        F.size(m).cast("bigint").alias("n_prompt_turns"),
        F.aggregate(m, F.lit(0).cast("bigint"), lambda acc, x: acc + F.length(x["content"])).alias("prompt_chars"),
    )


@register(
    "doc_token_stats",
    r"""WITH d AS (SELECT lang, coalesce(len(regexp_extract_all(text, '[^ \t\n\r]+')), 0) AS total_tokens FROM documents)
    SELECT lang AS split, round(avg(total_tokens), 6) AS mean, round(quantile_cont(total_tokens, 0.5), 6) AS median,
           round(quantile_cont(total_tokens, 0.95), 6) AS p95, max(total_tokens) AS max,
           count(*) FILTER (WHERE total_tokens > 2048) AS num_exceeding_max_seq_length, count(*) AS n
    FROM d GROUP BY lang""",
)
def q_doc_token_stats(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("lang", "text")
    per = docs.select(F.col("lang").alias("split"), stats.whitespace_tokens(F.col("text")).alias("total_tokens"))
    out = stats.token_analysis(per, max_seq_length=2048)
    return out.select("split", *[F.round(c, 6).alias(c) for c in ("mean", "median", "p95")], "max",
                      "num_exceeding_max_seq_length", "n")


@register(
    "token_analysis_all",
    f"""WITH c AS ({_PER_CONV_SQL})
    SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE split END AS split, round(avg({_TOTAL_SQL}), 6) AS mean,
           round(quantile_cont({_TOTAL_SQL}, 0.5), 6) AS median, round(quantile_cont({_TOTAL_SQL}, 0.95), 6) AS p95,
           max({_TOTAL_SQL}) AS max, count(*) FILTER (WHERE {_TOTAL_SQL} > {MAX_SEQ}) AS num_exceeding_max_seq_length,
           count(*) AS n
    FROM c GROUP BY GROUPING SETS ((split), ())""",
)
def q_token_analysis_all(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.token_analysis(split_tokens(spark, sf), MAX_SEQ, with_total=True)
    return out.select(
        "split", *[F.round(c, 6).alias(c) for c in ("mean", "median", "p95")], "max", "num_exceeding_max_seq_length", "n"
    )


# -------------------------------------------------------- lenient scan, deltas
@register(
    "jsonl_parseable",
    "SELECT conv_id FROM conversations GROUP BY conv_id HAVING conv_id % 9 NOT IN (0, 5, 7)",
)
def q_jsonl_parseable(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that parse as JSON of any type (the lenient scan keeps them; blank and broken lines drop)."""
    conv = assemble_messages(defect_turns(spark, sf))
    lines = conv.select("conv_id", F.to_json(F.struct("messages")).alias("json_line")).selectExpr(
        "conv_id", f"{fx.JSONL_LINE_SQL} AS value"
    )
    return jsonl.parseable_lines(lines).select("conv_id")


@register(
    "stream_deltas",
    f"SELECT {fx.REQUEST_SQL} AS request_id, event_id AS token_index, event_type AS delta FROM events",
)
def q_stream_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Per-step deltas recovered from cumulative decoded text (steps built from events)."""
    from pyspark.sql import Window

    ev = read_table(spark, sf, "events").selectExpr(
        f"{fx.REQUEST_SQL} AS request_id", "event_id AS token_index", "event_type"
    )
    upto = Window.partitionBy("request_id").orderBy("token_index").rowsBetween(Window.unboundedPreceding, 0)
    steps = ev.select("request_id", "token_index", F.array_join(F.collect_list("event_type").over(upto), "").alias("text"))
    return telemetry.cumulative_to_delta(steps).select("request_id", "token_index", "delta")


@register(
    "latest_per_group",
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM (
         SELECT o_custkey, o_orderkey, o_orderstatus,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
         FROM orders) WHERE rn = 1""",
)
def q_latest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """Newest row per group (W3) with a splittable max_by; ties on the date broken by key."""
    orders = read_table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.struct("o_orderdate", "o_orderkey").alias("_ord")
    )
    return registry.latest_per_group(orders, "o_custkey", "_ord").select("o_custkey", "o_orderkey", "o_orderstatus")
