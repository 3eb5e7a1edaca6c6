"""Run registry: manifests, latest run / checkpoint selection, inheritance, stale checkpoints.

Tables (any source: a listing of a shared folder, a ``runs`` table, ...):

* runs ``(base_dir, run_name, has_adapter)``
* checkpoints ``(base_dir, run_name, name, eval_loss)``
* manifests ``(adapter_path, file_name, body)`` raw JSON text per manifest file

Everything is grouped aggregates and joins; the selection rules never delete
anything, they produce candidate tables.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.session import list_paths

# Naming rules and the inherited manifest fields.
CHECKPOINT_PATTERN = r"^checkpoint-(\d+)$"
CHECKPOINT_PREFIX = "checkpoint-"
RUN_ID_PATTERN = r"^run_\d{8}_\d{6}$"
RUN_PREFIX = "run_"
MANIFEST_NAME = "manifest.json"
INHERITED_FIELDS = ("base_model", "lora_r", "lora_alpha", "max_seq_length")

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("base_model", T.StringType()),
        T.StructField("continued_from", T.StringType()),
        T.StructField("prior_manifest", T.StringType()),
        T.StructField("reasoning", T.BooleanType()),
        T.StructField("lora_r", T.LongType()),
        T.StructField("lora_alpha", T.LongType()),
        T.StructField("lora_dropout", T.DoubleType()),
        T.StructField("max_seq_length", T.LongType()),
        T.StructField("packing", T.BooleanType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("val_rows", T.LongType()),
        T.StructField("golden_rows", T.LongType()),
        T.StructField("training_mode", T.StringType()),
        T.StructField("dataset_version", T.StringType()),
        T.StructField("lora_version", T.StringType()),
        T.StructField("generator_version", T.StringType()),
        T.StructField("validator_version", T.StringType()),
        T.StructField("git_hash", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("experiment_name", T.StringType()),
    ]
)


def checkpoint_step(name: F.Column) -> F.Column:
    """Numeric N of ``checkpoint-N`` (null for other names)."""
    return F.when(name.rlike(CHECKPOINT_PATTERN), F.regexp_extract(name, CHECKPOINT_PATTERN, 1).cast("bigint"))


def latest_checkpoint(checkpoints: DataFrame, run_keys: tuple[str, ...] = ("base_dir", "run_name")) -> DataFrame:
    """Per run, the checkpoint with the highest numeric step (not lexicographic)."""
    step = checkpoint_step(F.col("name"))
    return (
        checkpoints.filter(step.isNotNull())
        .groupBy(*run_keys)
        .agg(F.max_by("name", step).alias("latest_checkpoint"), F.max(step).alias("latest_step"))
    )


def latest_synced_run(runs: DataFrame, base: str = "base_dir") -> DataFrame:
    """Per base folder, the lexicographically last ``run_*`` that has an adapter."""
    return (
        runs.filter(F.col("run_name").startswith(RUN_PREFIX) & F.col("has_adapter"))
        .groupBy(base)
        .agg(F.max("run_name").alias("latest_run"))
    )


def latest_resumable_run(runs: DataFrame, checkpoints: DataFrame, base: str = "base_dir") -> DataFrame:
    """Per base folder, the newest ``run_YYYYMMDD_HHMMSS`` holding at least one ``checkpoint-*``."""
    with_ckpt = checkpoints.filter(F.col("name").startswith(CHECKPOINT_PREFIX)).select(base, "run_name").distinct()
    return (
        runs.filter(F.col("run_name").rlike(RUN_ID_PATTERN))
        .select(base, "run_name")
        .join(with_ckpt, [base, "run_name"], "left_semi")
        .groupBy(base)
        .agg(F.max("run_name").alias("resume_run"))
    )


def stale_checkpoints(checkpoints: DataFrame, run_keys: tuple[str, ...] = ("base_dir", "run_name"),
                      loss: str = "eval_loss") -> DataFrame:
    """Checkpoints outside the keep-set (best by loss + latest by step): candidates only.

    A checkpoint without a loss was never evaluated: it can be the latest, never the best.
    """
    step = checkpoint_step(F.col("name"))
    ck = checkpoints.filter(step.isNotNull())
    known = F.col(loss).isNotNull() & ~F.isnan(F.col(loss).cast("double"))
    keep = ck.groupBy(*run_keys).agg(
        F.min_by("name", F.when(known, F.struct(F.col(loss), step))).alias("_best"), F.max_by("name", step).alias("_latest")
    )
    kept = F.coalesce(F.col("name") == F.col("_best"), F.lit(False)) | (F.col("name") == F.col("_latest"))
    return ck.join(keep, list(run_keys)).filter(~kept).drop("_best", "_latest")


def read_manifests(spark: SparkSession, adapter_dirs: list[str], legacy: str | None = None) -> DataFrame:
    """``(adapter_path, file_name, body)`` for every manifest file under the adapter folders.

    Each manifest is one small whole-text file; missing folders are simply absent.
    ``legacy`` names an older manifest file to accept as well.
    """
    names = f"{{{MANIFEST_NAME},{legacy}}}" if legacy else MANIFEST_NAME
    files_found = [f for d in adapter_dirs for f in list_paths(spark, f"{d.rstrip('/')}/{names}")]
    if not files_found:
        return spark.createDataFrame([], "adapter_path string, file_name string, body string")
    files = spark.read.text(files_found, wholetext=True)
    path = F.col("_metadata.file_path")
    return files.select(
        F.regexp_replace(F.regexp_extract(path, r"^(.*)/[^/]+$", 1), "^file:", "").alias("adapter_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("body"),
    )


def scan_manifests(spark: SparkSession, root: str, names: list[str], whole_file: bool = True) -> DataFrame:
    """``(folder, rank, body)`` of every manifest below ``root``; one listing, made by Spark's own file index.

    ``names`` are file name patterns, the preferred one first (``rank`` 0). With
    ``whole_file`` false every line is a manifest of its own.
    """
    found = []
    for rank, name in enumerate(names):
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(root, wholetext=whole_file)
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]+$", 1)
        found.append(files.select(folder.alias("folder"), F.lit(rank).alias("rank"), F.col("value").alias("body")))
    return functools.reduce(DataFrame.unionByName, found)


def preferred(manifests: DataFrame) -> DataFrame:
    """Per folder, the manifests under its most preferred name only."""
    best = manifests.groupBy("folder").agg(F.min("rank").alias("rank"))
    return manifests.join(best, ["folder", "rank"]).drop("rank")


def prefer_manifest(manifests: DataFrame, adapter: str = "adapter_path", file_name: str = "file_name",
                    legacy: str | None = None) -> DataFrame:
    """Per adapter folder, ``manifest.json`` wins over the ``legacy`` name; a corrupt preferred file gives none."""
    rank = F.when(F.col(file_name) == MANIFEST_NAME, 0)
    if legacy:
        rank = rank.when(F.col(file_name) == legacy, 1)
    ranked = manifests.filter(rank.isNotNull()).withColumn("_rank", rank)
    best = ranked.groupBy(adapter).agg(F.min_by(F.struct("*"), "_rank").alias("m"))
    return best.select("m.*").drop("_rank")


def parse_manifest_body(df: DataFrame, body: str = "body") -> DataFrame:
    """Typed manifest fields from JSON text (null when the text is not an object)."""
    return df.withColumn("manifest", F.from_json(F.col(body), MANIFEST_SCHEMA, {"mode": "PERMISSIVE"}))


def inherit_from_prior(configs: DataFrame, priors: DataFrame, link: str = "continue_adapter",
                       adapter: str = "adapter_path", newest: str | None = None) -> DataFrame:
    """Child configs take base_model / lora_r / lora_alpha / max_seq_length from their prior manifest.

    ``priors`` carries the four fields (null = absent in the prior); a child with no
    prior keeps its own values. ``training_mode`` records continuation. Of several prior
    rows of one adapter a single whole one counts: the greatest in the column ``newest``,
    ties (and tables without it) by the fields themselves. Fields of different manifests
    are never mixed, and children never multiplied.
    """
    fields = F.struct(*INHERITED_FIELDS)
    one = F.max(F.struct(F.col(newest).alias("n"), fields.alias("m"))) if newest else F.max(F.struct(fields.alias("m")))
    priors = priors.groupBy(adapter).agg(one.alias("_one")).select(adapter, "_one.m.*")
    p = priors.select(F.col(adapter).alias("_link"), *[F.col(c).alias(f"_p_{c}") for c in INHERITED_FIELDS])
    j = configs.join(p, configs[link] == p["_link"], "left")
    out = j
    for c in INHERITED_FIELDS:
        out = out.withColumn(c, F.coalesce(F.col(f"_p_{c}"), F.col(c)))
    mode = F.when(F.col(link).isNotNull(), F.lit("continue_lora")).otherwise(F.lit("fresh_lora"))
    return out.withColumn("training_mode", mode).drop("_link", *[f"_p_{c}" for c in INHERITED_FIELDS])


def run_timestamp(run_name: F.Column) -> F.Column:
    """``run_YYYYMMDD_HHMMSS`` -> TIMESTAMP (null otherwise)."""
    return F.when(
        run_name.rlike(RUN_ID_PATTERN), F.to_timestamp(F.substring(run_name, 5, 15), "yyyyMMdd_HHmmss")
    )


def split_row_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """Provenance row counts per split (train / val / golden)."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))


def latest_per_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """Newest row per group via ``max_by`` over a struct of all columns (splittable)."""
    return df.groupBy(group).agg(F.max_by(F.struct("*"), order).alias("r")).select("r.*")

