"""Registered queries of the composed jobs, on the driver tables, with SQL oracles.

Importing this module adds its queries to ``suite.QUERIES`` and ``suite.ORACLE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from colloquy.operators import evaluate, generate, metrics, registry, shape, stats
from colloquy.plans import fixtures as fx
from colloquy.plans import jobs, stubs
from colloquy.plans.suite import (
    _CKPT_SQL,
    _PY_WS_SQL,
    _RUNS_SQL,
    _VALIDATE_ORACLE,
    checkpoints_table,
    defect_turns,
    register,
    runs_table,
)
from colloquy.sources import jsonl
from colloquy.sources.conversations import assemble_messages, read_table, read_turns

_FLAT = lambda messages: F.array_join(F.transform(messages, lambda m: F.concat_ws(":", m["role"], m["content"])), "|")
_FLAT_SQL = "string_agg(concat_ws(':', role, text), '|' ORDER BY turn)"


@register(
    "valid_messages",
    _VALIDATE_ORACLE + f"""SELECT t.conv_id, {_FLAT_SQL} AS messages FROM t JOIN verdict v USING (conv_id)
    WHERE v.reason IS NULL GROUP BY t.conv_id""",
)
def q_valid_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Valid JSONL rows keep their messages and nothing else."""
    conv = assemble_messages(defect_turns(spark, sf))
    lines = conv.select("conv_id", F.to_json(F.struct("messages", F.lit(1).alias("other"))).alias("value"))
    valid = jsonl.validate_lines(lines).filter(F.col("reason").isNull())
    return valid.select("conv_id", _FLAT(F.col("messages")).alias("messages"))


_CORPUS_SQL = "SELECT conv_id, role, text, turn, 'f' || CAST(conv_id % 3 AS VARCHAR) AS file, CAST(conv_id // 3 AS BIGINT) AS line_no FROM conversations"


def _keyed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as lines of three files; line numbers repeat from file to file."""
    conv = assemble_messages(read_turns(spark, sf))
    return conv.selectExpr("'f' || CAST(conv_id % 3 AS STRING) AS file", "conv_id DIV 3 AS line_no", "to_json(struct(messages)) AS value")


@register(
    "sampled_lines",
    f"""SELECT file, line_no FROM (SELECT DISTINCT file, line_no FROM ({_CORPUS_SQL}))
    ORDER BY md5('11:' || file || ':' || CAST(line_no AS VARCHAR)), file, line_no LIMIT 25""",
)
def q_sampled_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Parseable lines of several files, capped exactly by (file, line number)."""
    lines = jsonl.parseable_lines(_keyed_lines(spark, sf))
    return shape.seeded_sample(lines, ("file", "line_no"), 25, seed=11).select("file", "line_no")


@register("first_conversations", "SELECT DISTINCT conv_id FROM conversations ORDER BY conv_id LIMIT 20")
def q_first_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows by key."""
    return shape.first_n(assemble_messages(read_turns(spark, sf)).select("conv_id"), "conv_id", 20)


_ENDED_SQL = f"""WITH n AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id),
    g AS (SELECT c.conv_id,
                 string_agg(concat_ws(':', role, text), '|' ORDER BY turn) FILTER (WHERE turn < last) AS prompt,
                 arg_max(text, turn) FILTER (WHERE turn < last) AS generated,
                 arg_max(text, turn) AS gold
          FROM conversations c JOIN n USING (conv_id) GROUP BY c.conv_id HAVING arg_max(role, turn) = 'assistant'),
    s AS (SELECT *, CASE WHEN trim(generated, '{_PY_WS_SQL}') = trim(gold, '{_PY_WS_SQL}') THEN 1.0 ELSE 0.0 END AS exact_match FROM g)"""
_TURNS_TYPE = "array<struct<role:string,content:string>>"


@register("prediction_records", _ENDED_SQL + " SELECT conv_id, prompt, generated, gold, CAST(exact_match AS DOUBLE) AS exact_match, 'ok' AS status FROM s")
def q_prediction_records(spark: SparkSession, sf: str) -> DataFrame:
    """G1, C4: the generation job's records, with the prompt read back from its JSON."""
    conv = assemble_messages(read_turns(spark, sf))
    rec = jobs.generate_predictions(conv, "conv_id", batch_factory=stubs.echo_last_turn_batch_factory)
    return rec.select("conv_id", _FLAT(F.from_json("prompt", _TURNS_TYPE)).alias("prompt"), "generated", "gold", "exact_match", "status")


@register(
    "golden_evaluation",
    _ENDED_SQL + " SELECT CAST(coalesce(avg(exact_match), 0) AS DOUBLE) AS exact_match_rate, count(*) AS num_examples, CAST(0 AS BIGINT) AS num_errors FROM s",
)
def q_golden_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """The golden evaluation's report row."""
    conv = assemble_messages(read_turns(spark, sf))
    return jobs.run_golden_evaluation(conv, "conv_id", batch_factory=stubs.echo_last_turn_batch_factory, batch_size=4)


_REFUSED = "CAST(o_orderkey % 5 AS VARCHAR)"


@register(
    "row_fallback",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 2 THEN {_REFUSED} END AS generated,
        CASE WHEN o_orderkey % 5 <> 2 THEN 'ok' ELSE 'error' END AS status,
        CASE WHEN o_orderkey % 5 = 2 THEN 'RuntimeError: boom' END AS error,
        CAST(CASE WHEN o_orderkey % 5 IN (0, 1) THEN 1 ELSE 0 END AS DOUBLE) AS exact_match FROM orders""",
)
def q_row_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """A failing batch is retried row by row; a failing row is reported and scores 0.0."""
    rows = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.array(F.struct(F.lit("user").alias("role"), (F.col("o_orderkey") % 5).cast("string").alias("content"))).alias("prompt_messages"),
        F.when(F.col("o_orderkey") % 5 < 2, (F.col("o_orderkey") % 5).cast("string")).otherwise("other").alias("gold"),
    )
    gen = generate.generate(rows, batch_factory=stubs.failing_batch_factory("2"), batch_size=8)
    rec = generate.prediction_records(gen, "o_orderkey")
    return rec.select("o_orderkey", "generated", "status", "error", "exact_match")


@register(
    "robustness_prompts",
    "SELECT event_id, 'system:be exact|user:shop|user:## Query' || chr(10) || event_type || ' ' || CAST(user_id AS VARCHAR) AS prompt FROM events",
)
def q_robustness_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Every query under the same system and context turns."""
    queries = read_table(spark, sf, "events").selectExpr("event_id", "event_type || ' ' || CAST(user_id AS STRING) AS query")
    out = jobs.robustness_prompts(queries, system_prompt="be exact", context="shop")
    return out.select("event_id", _FLAT(F.col("prompt_messages")).alias("prompt"))


@register(
    "robustness_run",
    f"""WITH e AS (SELECT CAST(user_id AS VARCHAR) AS group_id, {fx.LEVEL_SQL} AS level, event_id AS seq,
                          CASE WHEN event_id % 7 <> 3 THEN event_type END AS answer FROM events),
    ref AS (SELECT group_id, arg_max(struct_pack(a := answer), seq) AS r FROM e WHERE level = 1 GROUP BY group_id)
    SELECT e.seq, e.group_id, e.level, row_number() OVER (PARTITION BY e.group_id ORDER BY e.level, e.seq) AS place,
           CASE WHEN e.level > 1 AND r.a IS NOT NULL THEN coalesce(e.answer = r.a, false) END AS matches_level1
    FROM e LEFT JOIN ref USING (group_id)""",
)
def q_robustness_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole robustness run with a predictor, in group and level order."""
    queries = read_table(spark, sf, "events").selectExpr(
        "CAST(user_id AS STRING) AS group_id", f"{fx.LEVEL_SQL} AS level", "event_id AS seq",
        """CASE WHEN event_id % 7 <> 3 THEN 'PASS_4 {"e": "' || event_type || '"}' ELSE 'no envelope' END AS query""",
    )
    scored = jobs.run_lookup_level_benchmark(queries, decode_factory=stubs.echo_last_turn_factory)
    place = F.row_number().over(Window.partitionBy("group_id").orderBy("level", "seq")).cast("bigint")
    return evaluate.in_report_order(scored).select("seq", "group_id", "level", place.alias("place"), "matches_level1")


@register(
    "prediction_sample",
    _ENDED_SQL + ", f AS (SELECT DISTINCT conv_id FROM conversations ORDER BY conv_id LIMIT 12) SELECT gold, generated FROM s JOIN f USING (conv_id)",
)
def q_prediction_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The periodic sample of gold and generated replies."""
    conv = assemble_messages(read_turns(spark, sf))
    return jobs.prediction_sample(conv, "conv_id", stubs.echo_last_turn_factory, eval_count=4, every_n_evals=2, sample_size=12)


@register(
    "device_families",
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'A100' WHEN 1 THEN 'L4' WHEN 2 THEN 'OTHER' WHEN 3 THEN 'T4' WHEN 4 THEN 'OTHER' ELSE 'A100' END AS family
    FROM part""",
)
def q_device_families(spark: SparkSession, sf: str) -> DataFrame:
    """device names to families."""
    names = F.element_at(F.array(*map(F.lit, ("NVIDIA A100-40GB", "nvidia l4", "NVIDIA L40S", "Tesla T4", "cpu", "a100"))), (F.col("p_partkey") % 6 + 1).cast("int"))
    return read_table(spark, sf, "part").select("p_partkey", stats.device_family(names).alias("family"))


@register(
    "run_times",
    rf"""SELECT o_orderkey, CASE WHEN regexp_matches(run_name, '^run_\d{{8}}_\d{{6}}$')
        THEN strftime(strptime(run_name[5:], '%Y%m%d_%H%M%S'), '%Y-%m-%d %H:%M:%S') END AS started FROM ({_RUNS_SQL})""",
)
def q_run_times(spark: SparkSession, sf: str) -> DataFrame:
    """run names to times."""
    return runs_table(spark, sf).select("o_orderkey", F.date_format(registry.run_timestamp(F.col("run_name")), "yyyy-MM-dd HH:mm:ss").alias("started"))


@register(
    "run_metadata",
    """SELECT event_id AS run_id, CAST(0 AS BIGINT) AS step, 'run/' || event_type AS metric, CAST(user_id AS VARCHAR) AS value
    FROM events WHERE event_type <> 'error'""",
)
def q_run_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Scalar run metadata become step-0 series."""
    meta = read_table(spark, sf, "events").selectExpr(
        "event_id AS run_id", "event_type AS k", "CASE event_type WHEN 'error' THEN 'dict' WHEN 'view' THEN 'int' ELSE 'str' END AS kind", "CAST(user_id AS STRING) AS value"
    )
    return metrics.scalar_metadata(meta)


@register("checkpoint_counts", f"SELECT base_dir, run_name, count(*) AS n FROM ({_CKPT_SQL}) WHERE regexp_matches(name, '^checkpoint-') GROUP BY base_dir, run_name")
def q_checkpoint_counts(spark: SparkSession, sf: str) -> DataFrame:
    """how many ``checkpoint-*`` folders each run holds."""
    named = checkpoints_table(spark, sf).filter(F.col("name").startswith(registry.CHECKPOINT_PREFIX))
    return named.groupBy("base_dir", "run_name").agg(F.count(F.lit(1)).alias("n"))


_SOURCE_SQL = "CASE event_type WHEN 'error' THEN 'gpu' WHEN 'view' THEN 'system' ELSE 'train' END"
_KEY_SQL = "CASE event_id % 4 WHEN 0 THEN 'memory_used_gb' WHEN 1 THEN 'tokens_per_sec' WHEN 2 THEN 'loss' ELSE 'epoch' END"


@register(
    "device_series",
    f"""WITH s AS (SELECT event_id AS step, value, {_SOURCE_SQL} AS source, {_KEY_SQL} AS key FROM events)
    SELECT step, source || '/' || key AS metric, value FROM s
    WHERE (source = 'gpu' AND key = 'memory_used_gb') OR (source = 'system' AND key IN ('tokens_per_sec', 'epoch'))
       OR (source = 'train' AND key IN ('loss', 'epoch'))""",
)
def q_device_series(spark: SparkSession, sf: str) -> DataFrame:
    """K5: device, progress and trainer figures under their own names."""
    logs = read_table(spark, sf, "events").selectExpr("event_id AS step", "value", f"{_SOURCE_SQL} AS source", f"{_KEY_SQL} AS key")
    return metrics.to_series(logs).select("step", "metric", "value")


@register(
    "statistics_with_empty_split",
    """WITH d AS (SELECT lang AS split, len(string_split(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g')), ' ')) AS n FROM documents)
    SELECT split, round(avg(n), 6) AS mean, CAST(max(n) AS BIGINT) AS max, count(*) AS n,
           CASE WHEN count(*) FILTER (WHERE n > 512) > 0 THEN CAST(count(*) FILTER (WHERE n > 512) AS VARCHAR) || ' of ' || CAST(count(*) AS VARCHAR) || ' conversations are longer than 512 tokens' END AS note
    FROM d GROUP BY split UNION ALL SELECT 'xx', 0.0, 0, 0, NULL""",
)
def q_statistics_with_empty_split(spark: SparkSession, sf: str) -> DataFrame:
    """A split without rows has zeros, and over-length splits a remark."""
    docs = read_table(spark, sf, "documents")
    per = docs.select(F.col("lang").alias("split"), stats.whitespace_tokens(F.col("text")).alias("total_tokens"))
    out = stats.with_empty_splits(stats.token_analysis(per, max_seq_length=512), ["de", "en", "es", "fr", "xx"])
    note = stats.over_length_note(F.col("num_exceeding_max_seq_length"), F.col("n"), 512)
    return out.select("split", F.round("mean", 6).alias("mean"), F.col("max").cast("bigint").alias("max"), "n", note.alias("note"))


@register(
    "reply_length_ratio",
    """SELECT quantile_cont(l_partkey % 97 + 1, 0.5) AS median_generated, quantile_cont(l_suppkey % 31 + 1, 0.5) AS median_gold, count(*) AS n,
           quantile_cont(l_partkey % 97 + 1, 0.5) / quantile_cont(l_suppkey % 31 + 1, 0.5) AS ratio FROM lineitem""",
)
def q_reply_length_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """How much longer generated replies are than gold ones."""
    df = read_table(spark, sf, "lineitem").selectExpr("l_partkey % 97 + 1 AS generated", "l_suppkey % 31 + 1 AS gold")
    return stats.length_ratio(df, "generated", "gold")
