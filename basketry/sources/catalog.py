"""Expose tables to SQL users: temp views over lazy models, and external
tables of a named schema pointing at the current version of written tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from . import tables


def ensure_schema(spark: SparkSession, schema: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (the namespace of the raw layer)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")


def register_views(frames: Mapping[str, DataFrame]) -> list[str]:
    """One temp view per DataFrame, so the models can be queried with SQL
    (staging is view-materialised: nothing is computed until queried)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def publish(spark: SparkSession, root: str, names: Iterable[str], schema: str) -> list[str]:
    """Define ``schema.<name>`` as a view over the segments of the current
    version of each written table (re-pointing never touches data)."""
    ensure_schema(spark, schema)
    published = []
    for name in names:
        columns, folders = tables.columns_by_segment(spark, root, name)
        parts = " UNION ALL ".join("SELECT " + ", ".join(
            f"`{f.name}`" if f.name in have else f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in columns.fields)
            + f" FROM parquet.`{folder}`" for folder, have in folders.items())
        spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS {parts}")
        published.append(f"{schema}.{name}")
    return published
