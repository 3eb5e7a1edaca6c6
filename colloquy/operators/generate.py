"""Batch generation over a table with a user-supplied predictor.

The predictor is injected as a factory so heavy state (a model client, weights) is
built once per Python worker task, never shipped per row. Rows keep every input
column (including the example key) so predictions join back by key, never by
position. Batches are formed inside each partition; a failing batch is retried row
by row, and a failing row is reported in ``status``/``error`` instead of failing the
job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DecodeFn = Callable[[list[dict], int], str]
BatchDecodeFn = Callable[[list[list[dict]], int], list[str]]

SLICE = 256  # prompts held as Python objects at a time


def _as_messages(value: Any) -> list[dict]:
    if value is None:
        return []
    out = []
    for m in value:
        if hasattr(m, "asDict"):
            m = m.asDict()
        out.append({"role": m.get("role"), "content": m.get("content")})
    return out


def generate(
    df: DataFrame,
    decode_factory: Callable[[], DecodeFn] | None = None,
    batch_factory: Callable[[], BatchDecodeFn] | None = None,
    prompt_col: str = "prompt_messages",
    out_col: str = "generated",
    batch_size: int = 1,
    max_new_tokens: int = 400,
) -> DataFrame:
    """Add ``generated``, ``status`` (ok / error) and ``error`` columns.

    ``batch_size > 1`` requires ``batch_factory`` (a list-in, list-out predictor).
    """
    if batch_size > 1 and batch_factory is None:
        raise ValueError("batch_size > 1 requires a batch predictor")
    if batch_size <= 1 and decode_factory is None:
        raise ValueError("a single-example predictor is required")
    schema = T.StructType(
        [*df.schema.fields, T.StructField(out_col, T.StringType()), T.StructField("status", T.StringType()),
         T.StructField("error", T.StringType())]
    )

    prompts_at = df.columns.index(prompt_col)
    size = max(batch_size, SLICE // max(batch_size, 1) * batch_size, 1)  # whole batches of the predictor

    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single = decode_factory() if decode_factory is not None else None
        batched = batch_factory() if batch_factory is not None else None

        def one(prompt: list[dict]) -> tuple[str | None, str, str | None]:
            try:
                if single is not None:
                    return single(prompt, max_new_tokens), "ok", None
                return batched([prompt], max_new_tokens)[0], "ok", None
            except Exception as exc:  # noqa: BLE001 - reported per row
                return None, "error", f"{type(exc).__name__}: {exc}"

        def answers(prompts: list[list[dict]]) -> list[tuple[str | None, str, str | None]]:
            if batch_size <= 1:
                return [one(p) for p in prompts]
            results: list[tuple[str | None, str, str | None]] = []
            for i in range(0, len(prompts), batch_size):
                chunk = prompts[i : i + batch_size]
                try:
                    texts = batched(chunk, max_new_tokens)
                    if len(texts) != len(chunk):
                        raise ValueError("predictor returned a different number of outputs")
                    results += [(t, "ok", None) for t in texts]
                except Exception:  # noqa: BLE001 - fall back to one at a time
                    results += [one(p) for p in chunk]
            return results

        for batch in batches:
            # the input columns stay in Arrow; prompts become Python objects a slice at a time
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                results = answers([_as_messages(v) for v in part.column(prompts_at).to_pylist()])
                new = [pa.array([r[i] for r in results], pa.string()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names)

    return df.mapInArrow(run, schema)


def prediction_records(generated: DataFrame, key: str, gold: str = "gold") -> DataFrame:
    """Prediction records ``(key, prompt, generated, gold, [status, error,] exact_match)``.

    Scored by envelope or stripped text; a failed prediction scores 0.0.
    """
    from colloquy.functions.replies import exact_match, parse_envelope

    passthrough = [c for c in ("status", "error") if c in generated.columns]
    return generated.select(
        key,
        F.to_json("prompt_messages", {"ignoreNullFields": "false"}).alias("prompt"),
        "generated",
        gold,
        *passthrough,
        F.when(
            F.col("generated").isNotNull(),
            exact_match(F.col("generated"), F.col(gold), parse_envelope(F.col("generated")), parse_envelope(F.col(gold))),
        ).otherwise(0.0).alias("exact_match"),
    )


def predict_column(make_batch_predict: Callable[[], BatchDecodeFn], batch_size: int = 8, max_new_tokens: int = 400):
    """Column form of batch generation on Spark's batch-inference UDF.

    ``make_batch_predict()`` runs once per Python worker (cached by
    ``predict_batch_udf``); each call receives up to ``batch_size`` prompts. Input is
    the prompt turns as JSON text (``to_json(prompt_messages)``); output is the reply.
    Use ``generate`` instead when failing rows must be reported rather than fail the task.
    """
    import json as _json

    import numpy as np
    from pyspark.ml.functions import predict_batch_udf

    def make():
        predict = make_batch_predict()

        def run(prompts: np.ndarray) -> np.ndarray:
            batch = [_json.loads(p) if p is not None else [] for p in prompts]
            return np.array(predict(batch, max_new_tokens), dtype=object)

        return run

    return predict_batch_udf(make, return_type=T.StringType(), batch_size=batch_size)
