"""Corpus pipeline: rate, clear recurring lines, drop near copies, drop
benchmark leaks, mix sources. Each stage is written as Parquet to the shared
folder and read again as the next one's documents.

Stages take ``(spark, docs, sf_dir)``; all but the last return the columns of
``docs``. Extra columns pass through whatever their names are: an operator never
sees them under a name that it uses itself. ``n_chars``, where present, follows a
changed text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import quality as rating
from basketry.llm.common import read
from basketry.llm.decontam import decontaminate
from basketry.llm.line_dedup import line_dedup, long_line_dedup
from basketry.llm.mixing import mix
from basketry.llm.near_dup import keep_first
from basketry.session import cut_lineage


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _keeping_columns(stage: Stage) -> Stage:
    """``stage`` with columns that are not the documents' own under private names."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in DOCUMENT else f"__extra_{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).select(*names).toDF(*docs.columns)
    return run_stage


@_keeping_columns
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the ordinal classifier keeps (P(not toxic) and P(good) at least 0.5)."""
    model = rating.fit(docs, read(spark, sf_dir, "labels"))
    return rating.rate(docs, model).where("keep").select(docs.columns)


@_keeping_columns
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go from all documents but the first; no document goes."""
    return _with_chars(docs, line_dedup(docs))


def _with_chars(docs: DataFrame, got: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        got = got.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return got.select(docs.columns)


@_keeping_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays; long lines that two or
    more of these still share go from all but the first."""
    left = cut_lineage(keep_first(docs).select(docs.columns), "pipeline-left")
    return _with_chars(left, long_line_dedup(left))


@_keeping_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words taken of each."""
    return mix(docs).where(F.col("taken") > 0).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing)]

# A trained classifier and sampled hashes have no SQL form; tests/llm holds the
# stages against brute force and the operators' SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
