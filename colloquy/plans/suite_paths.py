"""Registered queries that go through written and re-read paths, registries and hooks.

Importing this module adds its queries to ``suite.QUERIES`` and ``suite.ORACLE``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import replies
from colloquy.operators import evaluate, metrics, registry, stats
from colloquy.plans import fixtures as fx
from colloquy.plans import jobs, stubs
from colloquy.plans.suite import _PASS_ACC_ORACLE, _PER_CONV_SQL, _SSE_ORACLE, _VALIDATE_ORACLE, defect_turns, order_replies, register, split_tokens, sse_metrics
from colloquy.plans.suite_jobs import _ENDED_SQL
from colloquy.session import checkpoint_dir
from colloquy.sources import jsonl, sinks
from colloquy.sources.conversations import assemble_messages, read_table, read_turns


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/paths/{name}-{uuid.uuid4().hex}"


@register(
    "split_loads",
    _VALIDATE_ORACLE + f""", v AS (SELECT *, {fx.SPLIT_SQL} AS split FROM verdict)
    SELECT split, count(*) AS n_lines, count(*) FILTER (reason IS NULL) AS n_valid,
      count(*) FILTER (reason IS NOT NULL) AS n_rejected, split = (SELECT CASE WHEN count(*) > 0 THEN 'golden' ELSE 'val' END FROM v WHERE split = 'golden' AND reason IS NULL) AS evaluated
    FROM v GROUP BY split""",
)
def q_split_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Splits written as JSONL, loaded as required and optional ones; the evaluation's source is tagged."""
    root = _folder(spark, "splits")
    conv = assemble_messages(defect_turns(spark, sf)).withColumn("split", F.expr(fx.SPLIT_SQL))
    sinks.write_jsonl(conv.select("messages", "split"), root, partition_by="split")
    train = jobs.load_train(spark, f"{root}/split=train")
    val, golden = (jobs.load_optional(spark, f"{root}/split={s}", s) for s in ("val", "golden"))
    absent = jobs.load_optional(spark, f"{root}/split=none", "none")
    _, tag = jobs.pick_eval_source(golden.valid if golden else None, val.valid if val else absent)
    rows = None
    for split, load in (("train", train), ("val", val), ("golden", golden)):
        n = jsonl.count_nonblank_lines(spark, f"{root}/split={split}")
        counts = load.verdicts.agg(F.count_if(F.col("reason").isNull()).alias("n_valid"), F.count_if(F.col("reason").isNotNull()).alias("n_rejected"))
        one = counts.select(F.lit(split).alias("split"), F.lit(n).cast("long").alias("n_lines"), "n_valid", "n_rejected", F.lit(split == tag).alias("evaluated"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@register(
    "benchmark_report",
    _ENDED_SQL + """ SELECT 'golden' AS source, CAST(coalesce(avg(exact_match), 0) AS DOUBLE) AS exact_match_rate, count(*) AS num_examples,
      count(*) AS n_exported, 5 AS n_sections, CAST(0.25 AS DOUBLE) AS val_loss FROM s""",
)
def q_benchmark_report(spark: SparkSession, sf: str) -> DataFrame:
    """The benchmark's exported predictions and its one-document report, both read again."""
    run = _folder(spark, "benchmark")
    conv = assemble_messages(read_turns(spark, sf))
    report = jobs.run_benchmark(spark, conv, None, "conv_id", run, batch_factory=stubs.echo_last_turn_batch_factory, val_metrics={"eval_loss": 0.25})
    sinks.write_report(report, f"{run}/report")
    back = spark.read.json(f"{run}/report")
    exported = spark.read.json(f"{run}/predictions/golden_predictions").agg(F.count(F.lit(1)).alias("n_exported"))
    sections = F.size(F.array(*[F.col(f"pass_metrics.PASS_{i}.num_scored") for i in range(5)]))
    return back.crossJoin(exported).select(  # one row beside one row
        F.col("eval_dataset_source").alias("source"), F.col("golden_metrics.exact_match_rate").alias("exact_match_rate"),
        F.col("golden_metrics.num_examples").alias("num_examples"), "n_exported", sections.alias("n_sections"), F.col("val_metrics.eval_loss").alias("val_loss"),
    )


@register(
    "run_manifest",
    f"""SELECT count(DISTINCT conv_id) FILTER (s = 'train') AS train_rows, count(DISTINCT conv_id) FILTER (s = 'val') AS val_rows,
      count(DISTINCT conv_id) FILTER (s = 'golden') AS golden_rows, 'continue_lora' AS training_mode, 'prior-m' AS prior_base
    FROM (SELECT conv_id, {fx.SPLIT_SQL} AS s FROM conversations)""",
)
def q_run_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The run's manifest from its split counts, written and read as JSON."""
    rows = read_turns(spark, sf).select("conv_id").distinct().withColumn("split", F.expr(fx.SPLIT_SQL))
    prior = spark.range(1).select(F.lit("prior-m").alias("base_model"))
    manifest = jobs.build_manifest(spark, registry.split_row_counts(rows), {"base_model": "m", "continued_from": "adapters/1"}, prior)
    path = _folder(spark, "manifest")
    sinks.write_report(manifest, path)
    return registry.parse_manifest_body(spark.read.text(path), "value").select(
        "manifest.train_rows", "manifest.val_rows", "manifest.golden_rows", "manifest.training_mode", F.get_json_object("manifest.prior_manifest", "$.base_model").alias("prior_base")
    )


_MANIFESTS_SQL = f"""SELECT 'a' || CAST(c_custkey % 61 AS VARCHAR) AS adapter, c_custkey, {fx.PRIOR_BASE_SQL} AS base_model, {fx.PRIOR_R_SQL} AS lora_r,
  {fx.PRIOR_ALPHA_SQL} AS lora_alpha, {fx.PRIOR_LEN_SQL} AS max_seq_length, c_custkey % 61 % 3 = 0 OR c_custkey % 7 < 2 AS legacy FROM customer"""


@register(
    "manifest_inheritance",
    f"""WITH m AS ({_MANIFESTS_SQL}),
b AS (SELECT *, min(legacy) OVER (PARTITION BY adapter) AS best FROM m),
p AS (SELECT * FROM b WHERE legacy = best QUALIFY row_number() OVER (PARTITION BY adapter ORDER BY c_custkey DESC) = 1)
SELECT o_orderkey, coalesce(p.base_model, 'own') AS base_model, coalesce(p.lora_r, 16) AS lora_r, coalesce(p.lora_alpha, 32) AS lora_alpha,
  coalesce(p.max_seq_length, 1536) AS max_seq_length FROM orders LEFT JOIN p ON p.adapter = 'a' || CAST(o_custkey % 70 AS VARCHAR)""",
)
def q_manifest_inheritance(spark: SparkSession, sf: str) -> DataFrame:
    """Manifests in many folders under two names; children take one whole prior, the newest under the preferred name."""
    root = _folder(spark, "adapters")
    rows = read_table(spark, sf, "customer").selectExpr(
        "'a' || CAST(c_custkey % 61 AS STRING) AS adapter", "c_custkey", f"{fx.PRIOR_BASE_SQL} AS base_model", f"{fx.PRIOR_R_SQL} AS lora_r",
        f"{fx.PRIOR_ALPHA_SQL} AS lora_alpha", f"{fx.PRIOR_LEN_SQL} AS max_seq_length", "c_custkey % 61 % 3 = 0 OR c_custkey % 7 < 2 AS legacy",
    )
    body = F.to_json(F.struct("base_model", "lora_r", "lora_alpha", "max_seq_length", F.col("c_custkey").alias("created"))).alias("value")
    rows.where("NOT legacy").select("adapter", body).write.mode("append").partitionBy("adapter").json(root)
    rows.where("legacy").select("adapter", body).write.mode("append").partitionBy("adapter").text(root)
    found = registry.preferred(registry.scan_manifests(spark, root, ["*.json", "*.txt"], whole_file=False))
    inner = F.when(F.get_json_object("body", "$.value").isNotNull(), F.get_json_object("body", "$.value")).otherwise(F.col("body"))
    parsed = found.withColumn("body", inner)
    parsed = registry.parse_manifest_body(parsed).select(
        F.regexp_extract("folder", "adapter=([^/]+)$", 1).alias("adapter_path"), "manifest.base_model", "manifest.lora_r", "manifest.lora_alpha",
        "manifest.max_seq_length", F.get_json_object("body", "$.created").cast("long").alias("created"),
    )
    configs = read_table(spark, sf, "orders").selectExpr(
        "o_orderkey", "'own' AS base_model", "16L AS lora_r", "32L AS lora_alpha", "1536L AS max_seq_length", "'a' || CAST(o_custkey % 70 AS STRING) AS continue_adapter"
    )
    out = registry.inherit_from_prior(configs, parsed, newest="created")
    return out.select("o_orderkey", "base_model", "lora_r", "lora_alpha", "max_seq_length")


_RESULTS_SQL = f"""SELECT request_id, max(seq) AS seq, count(*) AS n FROM (
  SELECT CASE WHEN user_id % 11 = 0 THEN 'lost-' ELSE '' END || {fx.REQUEST_SQL} AS request_id, event_id AS seq, user_id FROM events WHERE event_type <> 'view') GROUP BY request_id"""


@register(
    "remote_run_settled",
    _SSE_ORACLE + f""", r AS ({_RESULTS_SQL}), j AS (SELECT r.request_id AS a, mt.request_id AS b, r.n FROM r FULL JOIN mt USING (request_id))
SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS matched, count(*) FILTER (b IS NULL) AS without_log,
  count(*) FILTER (a IS NULL) AS without_result, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeats,
  (SELECT CAST(sum(r.seq) AS BIGINT) FROM r JOIN mt USING (request_id)) AS seq_sum FROM j""",
)
def q_remote_run_settled(spark: SparkSession, sf: str) -> DataFrame:
    """A run's results against its request log; repeats and missing sides are counted."""
    results = read_table(spark, sf, "events").where("event_type <> 'view'").selectExpr(
        f"CASE WHEN user_id % 11 = 0 THEN 'lost-' ELSE '' END || {fx.REQUEST_SQL} AS request_id", "event_id AS seq"
    )
    joined, counts = jobs.settle_remote(results, sse_metrics(spark, sf))
    return counts.crossJoin(joined.agg(F.sum("seq").alias("seq_sum")))  # one row beside one row


@register(
    "tokenizer_counts",
    r"""SELECT doc_id, CAST(coalesce(list_sum(list_transform(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: w <> ''), lambda w: (length(w) + 3) // 4)), 0) AS BIGINT) AS n_tokens
    FROM documents""",
)
def q_tokenizer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A tokenizer that cuts words into fours, asked once for each distinct word of the table."""
    count = stats.arrow_token_counter(stubs.fours_factory)
    return stats.distinct_word_tokens(read_table(spark, sf, "documents"), "doc_id", "text", count)


@register(
    "extra_section_accuracy",
    _PASS_ACC_ORACLE + """ UNION ALL SELECT 'PASS_5', round(avg(CASE WHEN o_orderkey % 8 = 2 THEN 0.0 ELSE 1.0 END), 9), count(*), 0, 0 FROM orders""",
)
def q_extra_section_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """A sixth section in the registries is parsed, scored and counted."""
    own = lambda text: F.regexp_extract(replies.col_of(text), "PASS_2\nIntent\n([A-Z]+)", 1)
    replies.PASS_PARSERS["PASS_5"] = own
    replies.PASS_METRICS["PASS_5"] = lambda pred, gold: F.when(pred == gold, 1.0).otherwise(0.0)
    try:
        accuracy = evaluate.pass_accuracy(evaluate.parse_pair(order_replies(spark, sf)))
        return accuracy.withColumn("accuracy", F.round("accuracy", 9))
    finally:
        del replies.PASS_PARSERS["PASS_5"], replies.PASS_METRICS["PASS_5"]


@register(
    "series_table",
    """SELECT CAST(user_id % 20 AS BIGINT) AS run_id, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1""",
)
def q_series_table(spark: SparkSession, sf: str) -> DataFrame:
    """K5: metric points appended in two writes and read back run by run."""
    path = _folder(spark, "series")
    logs = read_table(spark, sf, "events").selectExpr("CAST(user_id % 20 AS BIGINT) AS run_id", "event_id AS step", f"{fx.LOG_KEY_SQL} AS key", f"{fx.LOG_SOURCE_SQL} AS source", "CAST(value AS DOUBLE) AS value")
    series = metrics.to_series(logs)
    for half in range(2):
        sinks.append_series(series.where(F.pmod("step", F.lit(2)) == half), path)
    return spark.read.parquet(path).groupBy(F.col("run_id").cast("long").alias("run_id")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total"))


_BLOCK_BYTES, _LINES_A_FILE = 1 << 12, 50  # many blocks a file, more files as the table grows


@register(
    "rejected_line_numbers",
    _VALIDATE_ORACLE + f""", l AS (SELECT conv_id, conv_id // {_LINES_A_FILE} AS part, row_number() OVER (PARTITION BY conv_id // {_LINES_A_FILE} ORDER BY conv_id) AS line_no, reason FROM verdict)
    SELECT part, line_no, CASE
        WHEN conv_id % 9 = 0 THEN 'invalid_json:Expecting property name enclosed in double quotes'
        WHEN conv_id % 9 = 1 THEN 'not_a_json_object'
        WHEN conv_id % 18 IN (2, 11) THEN 'missing_messages_key'
        WHEN conv_id % 18 IN (3, 12) THEN 'messages_not_a_nonempty_list'
        WHEN conv_id % 9 = 4 THEN 'turn_0_invalid_role:5'
        WHEN conv_id % 9 = 5 THEN 'invalid_json:Extra data'
        WHEN conv_id % 9 = 6 THEN 'turn_0_not_a_dict'
        ELSE reason END AS reason
    FROM l WHERE conv_id % 9 <> 7 AND (conv_id % 9 <> 8 OR reason IS NOT NULL)""",
)
def q_rejected_line_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected lines of many files, each read as many blocks; their numbers are joined late."""
    root = _folder(spark, "numbered")
    conv = assemble_messages(defect_turns(spark, sf))
    lines = conv.select("conv_id", F.to_json(F.struct("messages")).alias("json_line")).selectExpr(f"conv_id DIV {_LINES_A_FILE} AS part", "conv_id", f"{fx.JSONL_LINE_SQL} AS value")
    lines.repartition("part").sortWithinPartitions("part", "conv_id").select("part", "value").write.partitionBy("part").text(root)
    split_bytes = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", _BLOCK_BYTES)  # the read takes place in load_split
    try:
        load = jobs.load_split(spark, root, "numbered")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part")
    return load.verdicts.where("reason IS NOT NULL").select(part, "line_no", "reason")


_POINTS = (0.5, 0.95, 0.99)


@register(
    "sketched_quantiles",
    f"""WITH c AS ({_PER_CONV_SQL}), s AS (SELECT split, count(*) AS n FROM c GROUP BY split)
    SELECT split, n, CAST(p AS DOUBLE) AS p, TRUE AS within FROM s, (VALUES {", ".join(f"({p})" for p in _POINTS)}) t(p)""",
)
def q_sketched_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches of sixteen shards, stored and merged; each quantile's rank among all rows
    must lie within three times the stated error (which holds in 99 of 100 cases)."""
    per = split_tokens(spark, sf).withColumn("shard", F.pmod(F.xxhash64("conv_id"), F.lit(16)))
    path = _folder(spark, "sketches")
    stats.quantile_sketches(per, "total_tokens", "split", "shard").write.parquet(path)
    found = stats.sketch_quantiles(stats.merge_sketches(spark.read.parquet(path), "split"), _POINTS)
    counts = per.groupBy("split", "total_tokens").agg(F.count(F.lit(1)).alias("rows"))
    ranks = found.join(counts, "split").groupBy("split", "n", "p").agg(
        F.sum(F.when(F.col("total_tokens") < F.col("quantile"), F.col("rows")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("total_tokens") <= F.col("quantile"), F.col("rows")).otherwise(0)).alias("upto"),
    )
    room = F.col("n") * (3 * stats.rank_error()) + 1
    return ranks.select("split", "n", "p", ((F.col("below") <= F.col("p") * F.col("n") + room) & (F.col("upto") >= F.col("p") * F.col("n") - room)).alias("within"))
