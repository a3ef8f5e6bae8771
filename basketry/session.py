"""SparkSession construction and shared-storage helpers.

Cluster settings (``spark.checkpoint.dir``, shuffle partitions, broadcast
thresholds) are read from the session when they are already set; the
defaults here only fill gaps, as in local tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings every job relies on. What the launcher was given (``--conf``, its
# defaults file) wins over them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (post-shuffle, measured) broadcast threshold for AQE.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Only for sessions this module launches itself (local runs): the driver is
# the whole cluster there.
LOCAL_CONF = {
    "spark.driver.memory": "12g",
    "spark.sql.shuffle.partitions": "8",
}


def launcher_conf() -> dict[str, str]:
    """What ``spark-submit`` was given for this application; nothing where the
    session is started by this process itself."""
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        return {}
    SparkContext._ensure_initialized()  # joins the launcher's JVM, whose properties hold the settings
    return dict(SparkConf().getAll())


def get_session(master: str | None = None, app_name: str = "basketry",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, creating one with :data:`DEFAULT_CONF`.
    Settings of the launcher win over the defaults, arguments over both.

    ``master`` is only used when no session exists yet (tests, bench); on a
    cluster the submitter decides.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    given = launcher_conf()
    conf = {k: v for k, v in conf.items() if k not in given}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Looked up in the session conf, then the SparkContext conf, then the
    context's checkpoint directory. Only when none is set (local tests) is a
    scratch folder created, and it is then set in the session. Without a
    reachable SparkContext (Spark Connect) only the session conf is used.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and sc is not None:
        current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="basketry-ckpt-")
    if spark.conf.get("spark.checkpoint.dir", None) != current:
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for written intermediate
    tables that cut lineage)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, *parts]) if not root.startswith("/") else os.path.join(root, *parts)


_ANCHORS: list[str] = []
_RELEASED = [0]


def anchors_generation() -> int:
    """Number of times the anchors have been released: frames that read
    anchors, kept by a caller, are good within one generation."""
    return _RELEASED[0]


# How the tables and the anchors of orders and lines are written: hex keys and ids
# take about half the bytes of the default codec and encodings.
COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}
# Rows that are moved at once where a table is written in shares, and the most
# shares: each of them reads the input again.
SHARE_ROWS, MAX_SHARES = 250_000, 8


def shares_of(rows: int) -> int:
    """Shares in which ``rows`` rows are written (:func:`write_shares`)."""
    return max(1, min(MAX_SHARES, rows // SHARE_ROWS))


def free_shuffles(spark) -> None:
    """Let Spark delete the shuffle files of what has been written meanwhile: it
    does so once the driver's JVM has collected its garbage, which else happens
    too late to spare the disks. The last query is let go by the second time."""
    import gc
    import time
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.1)
    spark.sparkContext._jvm.System.gc()


def share(df, by: str, i: int, shares: int):
    """Rows of the ``i``-th of ``shares`` shares of the ``by`` values."""
    return df if shares == 1 else df.where(F.pmod(F.xxhash64(by), F.lit(shares)) == i)


def write_shares(df, path: str, by: str | None = None, shares: int = 1, options: dict[str, str] | None = None) -> None:
    """Write ``df`` as Parquet to the folder ``path``, over what is there. With
    several ``shares`` the rows of one share of the ``by`` values (NULL is one)
    are written after the other, each row once: only the shuffles of one share
    lie on the disks at a time. ``df`` is evaluated for each share and must give
    the same rows each time."""
    for i in range(shares):
        share(df, by, i, shares).write.mode("append" if i else "overwrite").options(**options or {}).parquet(path)
        if shares > 1:
            free_shuffles(df.sparkSession)


def cut_lineage(df, label: str = "anchor", options: dict[str, str] | None = None, by: str | None = None, shares: int = 1):
    """Write ``df`` as Parquet to a new folder under the shared checkpoint
    folder and return the read-back frame: one job (or one for each of the
    ``shares`` of the ``by`` values), lineage and plan cut,
    and the rows are on shared storage (no recomputation after an executor
    is lost). Columnar files are far cheaper to write and re-read than an
    RDD checkpoint of serialized rows."""
    import uuid
    spark = df.sparkSession
    path = shared_path(spark, "basketry-anchors", f"{label}-{uuid.uuid4().hex}")
    write_shares(df, path, by, shares, options)
    _ANCHORS.append(path)
    return spark.read.parquet(path)


def drop_anchor(df) -> None:
    """Delete what ``cut_lineage`` wrote for ``df``, which nothing reads any
    more: neither this frame nor one that is derived from it and not written."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for path in [p for p in _ANCHORS if any(f.endswith("/" + p.rstrip("/").rsplit("/", 1)[-1]) for f in folders)]:
        _ANCHORS.remove(path)
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def release_anchors(spark) -> int:
    """Delete the lineage anchors written so far by this process. Call only
    when no DataFrame that reads them is used again (e.g. at the end of a
    run whose models were written as tables); otherwise they are removed
    with the checkpoint folder. Returns the count."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    _RELEASED[0] += 1
    while _ANCHORS:
        p = jvm.org.apache.hadoop.fs.Path(_ANCHORS.pop())
        p.getFileSystem(conf).delete(p, True)
        n += 1
    return n


def by_key(df, *cols: str):
    """``df`` dealt by ``cols`` to as many partitions as the session shuffles to.
    The count is fixed: narrow rows shrink so far in a shuffle that partitions
    put together by their bytes would hold too many of them for one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


# Sizing rule for clusters: shuffle partitions of about TARGET_PARTITION_BYTES
# of input each (AQE coalesces small ones and splits skewed join partitions);
# input splits of the same size; broadcast only small measured sides.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000


def cluster_conf(input_bytes: int) -> dict[str, str]:
    """Spark settings sized for ``input_bytes`` of input (e.g. 100 TB:
    ~400k splits of 256 MB, shuffle partitions capped at 100k).

    Shuffle partitions bound the numbering operators' per-partition count
    table (their only broadcast) as well."""
    parts = max(200, min(MAX_SHUFFLE_PARTITIONS, input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(TARGET_PARTITION_BYTES * 4),
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
