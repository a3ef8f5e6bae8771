"""Pieces shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tokens are maximal runs of anything but ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A frame is broadcast only when its measured size is at most this.
BROADCAST_BYTES = 16 * 1024 * 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")
