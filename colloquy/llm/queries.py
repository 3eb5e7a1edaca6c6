"""Registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colloquy.llm import bpe, centroids, hamming, lines, neardup, packing, passages, pii, quality, repair, simhash, suffixes, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": suffixes.query,
    "op2_embedding_neardup": neardup.query,
    "op3_topk": topk.query,
    "op4_quality": quality.query,
    "op5_pii": pii.query,
    "op6_packing": packing.query,
    "op7_passages": passages.query,
    "op8_bpe": bpe.query,
    "op9_simhash": simhash.query,
    "op10_line_dedup": lines.query,
    "op11_repair": repair.query,
    "op12_ann": hamming.query,
    "op13_centroids": centroids.query,
}
ORACLE: dict[str, str] = {
    "op3_topk": topk.SQL,
    "op11_repair": repair.SQL,
    "op13_centroids": centroids.SQL,
}
