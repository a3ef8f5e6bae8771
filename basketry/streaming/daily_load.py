"""The daily incremental load as Structured Streaming.

New CSV files dropped into a landing folder (one folder per raw table) are
picked up by a file stream with the table's fixed schema. Each micro-batch
gets audit columns and is upserted on the table key into the versioned raw
table (``foreachBatch``); ``trigger(availableNow=True)`` processes what has
arrived and stops, which is the scheduled daily run. The stream's checkpoint
records processed files, so a restarted or retried run neither skips nor
double-loads a file, and the key upsert makes a replayed batch idempotent.
Of several rows of one key in a micro-batch the one in the file written last
stays (then by file name; within a file, whose rows have no order in Spark, the
greatest), so a correction that arrives with what it corrects is not lost.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_FILES
from ..sources import tables
from ..sources.csv_loader import _exists, csv_options, file_schema

# Upsert keys of the raw tables (line tables by order and product).
RAW_KEYS = {
    "orders": ["order_id"],
    "order_products_prior": ["order_id", "product_id"],
    "order_products_train": ["order_id", "product_id"],
    "products": ["product_id"],
    "aisles": ["aisle_id"],
    "departments": ["department_id"],
}

# Input files of one micro-batch: bounds a batch when a backlog has built up.
FILES_PER_BATCH = 1000


def start_daily_load(spark: SparkSession, landing_dir: str, root: str, checkpoint_root: str,
                     table: str = "orders", available_now: bool = True):
    """Start the load stream of one raw table (written as ``raw_<table>``);
    returns the StreamingQuery. Columns are found by header name as in the batch
    load; all files of one run share a header, and a file with another one, or
    with a malformed row, fails the stream."""
    file_name, schema = RAW_FILES[table]
    path = f"{landing_dir.rstrip('/')}/{file_name}"
    in_file = file_schema(spark, path, schema) if _exists(spark, path) else schema
    named = {f.name.strip().lower(): f.name for f in in_file.fields}
    source = (spark.readStream.schema(in_file).options(**csv_options())
              .option("maxFilesPerTrigger", FILES_PER_BATCH)
              .csv(path)
              .select(*[F.col(f"`{named[f.name.lower()]}`").alias(f.name) for f in schema.fields],
                      F.col("_metadata.file_name").alias("_source_file"),
                      F.col("_metadata.file_modification_time").alias("_file_time")))
    # Raw tables keep the audit columns last, as the batch loader writes them.
    writer = (source.writeStream
              .foreachBatch(_upsert_batch(root, f"raw_{table}", RAW_KEYS[table]))
              .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{table}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()


def _upsert_batch(root: str, table: str, key: list[str]):
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        cols = [c for c in batch.columns if c not in ("_source_file", "_file_time")]
        newest = tables.one_per_key(batch, key, ["_file_time", "_source_file"])
        stamped = newest.select(*cols, F.to_timestamp(F.lit(now)).alias("_loaded_at"), "_source_file")
        # Written once as a segment; only segments with colliding keys are rewritten.
        tables.upsert_commit(stamped, root, table, key,
                             prune="order_id" if "order_id" in key else None)
    return apply


def run_daily_load(spark: SparkSession, landing_dir: str, root: str, checkpoint_root: str,
                   table_names=None) -> None:
    """Process everything that has arrived for each table, then stop."""
    for table in table_names or list(RAW_FILES):
        q = start_daily_load(spark, landing_dir, root, checkpoint_root, table)
        q.awaitTermination()
