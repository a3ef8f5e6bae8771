"""Join helpers with an explicit, measured broadcast decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest reference table (bytes, as measured below) that is ever broadcast
# by hint. Beyond it the join is left to the planner: sort-merge, or a runtime
# broadcast by AQE when the measured shuffle output is below its threshold.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# Per-value bytes of fixed-width types (UnsafeRow: 8-byte slots); strings and
# binaries are measured, any other type counts as one slot plus 64 bytes.
_FIXED = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
          T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` as rows × fixed slots plus the actual lengths of its
    string and binary values: one aggregation, a real upper-bound estimate
    of the broadcast payload (no sampling, no statistics guess)."""
    fixed, measured = 0, []
    for f in df.schema.fields:
        fixed += 8
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            measured.append(F.coalesce(F.sum(F.length(F.col(f.name))), F.lit(0)))
        elif not isinstance(f.dataType, _FIXED):
            fixed += 64
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 sum(measured, F.lit(0)).alias("chars") if measured else F.lit(0).alias("chars")).first()
    return int(row["n"]) * fixed + int(row["chars"] or 0) * 4


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join a reference table (aisles, departments, the product catalog) onto
    a large frame, broadcasting it only when its measured size is within
    ``max_bytes``; larger tables fall back to a shuffle join.

    Measuring is one cheap aggregation over a reference table; it is the
    proof of the size bound a broadcast needs.
    """
    if measured_bytes(small) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
