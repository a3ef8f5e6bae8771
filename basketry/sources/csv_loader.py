"""Typed CSV load of the six raw files with audit columns and a summary.

Each configured file is scanned with its fixed schema (no inference): columns
are found by their header names, in any order, columns that the schema does not
declare are left out, and a declared column that is absent fails the file.
``_loaded_at`` (the run time) and ``_source_file`` (the file name) are
added, and the table is written as the next version of ``root/<table>``
(one distributed write; readers keep seeing the previous version until it
commits). A missing file, or one whose rows do not parse, is reported and
skipped; the other files still load.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_FILES
from . import tables

log = logging.getLogger(__name__)

SUMMARY_SCHEMA = "table_name string, source_file string, rows long, status string, error string"


def csv_options(strict: bool = True) -> dict[str, str]:
    """Reader options of the batch and the streaming load. Headers are compared
    with the schema in every file; ``strict`` fails on a malformed row."""
    return {"header": "true", "escape": '"', "enforceSchema": "false",
            "mode": "FAILFAST" if strict else "PERMISSIVE"}


def file_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """``schema`` in the order of the file's header; columns it does not declare
    are text. Raises when a declared column is absent."""
    header = spark.read.options(**csv_options()).csv(path).columns
    declared = {f.name.lower(): f for f in schema.fields}
    absent = [f.name for f in schema.fields if f.name.lower() not in {h.strip().lower() for h in header}]
    if absent:
        raise ValueError(f"{path}: no column {', '.join(absent)} in the header ({', '.join(header)})")
    return T.StructType([T.StructField(h, declared[h.strip().lower()].dataType if h.strip().lower() in declared
                                       else T.StringType()) for h in header])


def _cause(e: Exception) -> str:
    """First line of the innermost cause of a failed load."""
    java = getattr(e, "java_exception", None)
    if java is None:
        return str(e).splitlines()[0][:500]
    while java.getCause() is not None:
        java = java.getCause()
    return str(java.getMessage() or java.toString()).splitlines()[0][:500]


def read_raw_csv(spark: SparkSession, path: str, schema, run_ts, strict: bool = True) -> DataFrame:
    """Scan one CSV file (or folder of part files) with ``schema``.

    Quotes are escaped by doubling (``"a ""b"", c"``), the convention of the
    source files; Spark's default escape character would shift columns.
    ``strict`` fails the load on a malformed row instead of nulling it.
    """
    ts = F.to_timestamp(F.lit(run_ts)) if isinstance(run_ts, str) else F.lit(run_ts)
    df = spark.read.schema(file_schema(spark, path, schema)).options(**csv_options(strict)).csv(path)
    named = {c.strip().lower(): c for c in df.columns}
    data = [F.col(f"`{named[f.name.lower()]}`").alias(f.name) for f in schema.fields]
    return df.select(*data, ts.alias("_loaded_at"), F.col("_metadata.file_name").alias("_source_file"))


def _exists(spark: SparkSession, path: str) -> bool:
    """File or folder present (through the path's Hadoop FileSystem)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_raw_csv(spark: SparkSession, data_dir: str, root: str, run_ts=None,
                 files: dict | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load every configured file into ``root`` (as ``raw_<table>``); returns the loaded tables
    (read back from storage) and a summary DataFrame with one row per file
    (table_name, source_file, rows, status, error) plus a TOTAL row naming
    the skipped or failed files."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    files = files or RAW_FILES
    loaded: dict[str, DataFrame] = {}
    summary = []
    for table, (file_name, schema) in files.items():
        path = f"{data_dir.rstrip('/')}/{file_name}"
        if not _exists(spark, path):
            log.warning("file not found: %s - skipped", path)
            summary.append((table, file_name, None, "missing", None))
            continue
        try:
            # rows are counted while they are written: the file is scanned once
            seen = Observation(f"load_{table}")
            data = read_raw_csv(spark, path, schema, run_ts).observe(seen, F.count(F.lit(1)).alias("rows"))
            tables.commit(data, root, f"raw_{table}")
            loaded[table] = tables.read(spark, root, f"raw_{table}")
            rows = seen.get["rows"]
            summary.append((table, file_name, rows, "loaded", None))
            log.info("%s: %d rows loaded into %s", file_name, rows, table)
        except Exception as e:  # noqa: BLE001 - a failing file is reported, others go on
            log.error("failed to load %s: %s", file_name, e)
            summary.append((table, file_name, None, "failed", _cause(e)))
    failed = [t for t, _, _, status, _ in summary if status != "loaded"]
    total = sum(r[2] or 0 for r in summary)
    summary.append(("TOTAL", None, total, "loaded" if not failed else "partial",
                    ("skipped/failed: " + ", ".join(failed)) if failed else None))
    return loaded, spark.createDataFrame(summary, SUMMARY_SCHEMA)


def write_raw_csv(raw, data_dir: str, files: dict | None = None) -> None:
    """Write raw tables (audit columns dropped) as CSV folders named like
    the source files: the landing layout :func:`load_raw_csv` reads."""
    files = files or RAW_FILES
    for table, (file_name, schema) in files.items():
        df = raw[table].select(*[f.name for f in schema.fields])
        (df.write.mode("overwrite").option("header", True).option("escape", '"')
         .csv(f"{data_dir.rstrip('/')}/{file_name}"))
