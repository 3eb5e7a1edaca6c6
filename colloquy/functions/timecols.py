"""Time-zone independent epoch values for event-time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch of a timestamp column.

    ``TIMESTAMP_NTZ`` values are taken as wall-clock UTC (no session time-zone or DST
    shift); ``TIMESTAMP`` values are instants; numbers are seconds since the epoch.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{col}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    return (c.cast("double") * F.lit(1e6)).cast("bigint")
