"""Secret scan with an incremental blob ledger.

A text version is a blob addressed by the SHA-256 of its UTF-8 bytes. The
ledger (Parquet under a given folder) holds three kinds of rows, all appended:

* findings: one row for each blob and version of the rules that was scanned. The
  rules' version is a digest of their patterns, so changed patterns are new rules;
* paths: one row for each path (document id) and numbered version, with its blob;
* texts, if wanted (``keep_texts``): the blobs themselves, so that older versions
  can be scanned with later rules too.

A run scans only the (blob, rule version) pairs that the ledger lacks and joins
the findings back to all paths; :func:`path_findings` joins them to every version
that a path ever had. Copies of a blob are reduced map-side before texts are
shuffled, so a hot blob is scanned once. Runs that overlap or are repeated may
append the same rows; readers take each once.

Rules: ``assign``, ``access`` and ``hex`` as constants below, and ``pem``
(header of a private key). Matches are leftmost and non-overlapping per kind;
positions are code points, end exclusive.

Defined cases: null text is the empty blob; repeated rows all get the
findings of their blob; a path that occurs more than once in a version has all
its blobs there, a null path is a path; extra columns pass through, but for those
that bear a result's name, which it replaces.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

# The rule patterns, in the order that spans list their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # runs are maximal, so shorter ones can be passed over
PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
KINDS = ("assign", "access", "hex", "pem")
BASE = 3
RULE_VERSION = hashlib.sha256("\n".join(f"{k} {r.pattern} {r.flags}" for k, r in zip(KINDS, (ASSIGN, ACCESS, HEX, PEM))).encode()).hexdigest()[:16]
_PATHS, _TEXTS = "__version bigint, __sha binary", "__sha binary, __t string"
_SCHEMA = "__sha binary, __rules string, n_assign bigint, n_access bigint, n_hex bigint, base string, spans string"


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all findings, ordered."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "-----BEGIN " in text:
        out += [(m.start(), 3, m.end()) for m in PEM.finditer(text)]
    return sorted(out)


def _scan(rules: str):
    def line(found):
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)

    def run(batches):
        for batch in batches:
            sha, text = batch.column("__sha"), batch.column("__t")
            rows = [find(x.as_py() or "") for x in text]
            counts = [[sum(k == kind for _, k, _ in r) for r in rows] for kind in range(BASE)]
            yield pa.RecordBatch.from_arrays(
                [sha, pa.array([rules] * len(rows)), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([line([x for x in r if x[1] < BASE]) for r in rows]), pa.array([line(r) for r in rows])],
                ["__sha", "__rules", "n_assign", "n_access", "n_hex", "base", "spans"])
    return run


def new_ledger(spark: SparkSession) -> str:
    """A folder for a ledger on shared storage."""
    return shared_path(spark, "secret-ledger", uuid.uuid4().hex)


def _blobs(docs: DataFrame, text_col: str) -> DataFrame:
    t = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.unhex(F.sha2(t, 256)).alias("__sha"), t.alias("__t")).groupBy("__sha").agg(F.any_value("__t").alias("__t"))


def _scan_unseen(blobs: DataFrame, ledger: str, rules: str) -> int:
    spark = blobs.sparkSession
    known = read_ledger(spark, ledger)
    if known is not None:
        blobs = blobs.join(known.where(F.col("__rules") == rules).select("__sha"), "__sha", "left_anti")
    part = f"{ledger}/run-{uuid.uuid4().hex}"
    blobs.mapInArrow(_scan(rules), _SCHEMA).write.parquet(part)
    return spark.read.schema(_SCHEMA).parquet(part).count()


def update_ledger(docs: DataFrame, ledger: str, text_col: str = "text", rules: str = RULE_VERSION, *, keep_texts: bool = False) -> int:
    """Scan the blobs of ``docs`` that ``ledger`` lacks for ``rules`` and append
    them; the number of blobs scanned. ``keep_texts`` stores blobs not stored yet."""
    blobs = _blobs(docs, text_col)
    if keep_texts:
        stored = _read(docs.sparkSession, ledger, "texts", _TEXTS)
        new = blobs if stored is None else blobs.join(stored.select("__sha"), "__sha", "left_anti")
        new.write.parquet(f"{ledger}/texts-{uuid.uuid4().hex}")
    return _scan_unseen(blobs, ledger, rules)


def rescan(spark: SparkSession, ledger: str, rules: str = RULE_VERSION) -> int:
    """Scan all stored texts, of every version, that ``ledger`` lacks for
    ``rules``; the number of blobs scanned."""
    stored = _read(spark, ledger, "texts", _TEXTS)
    return 0 if stored is None else _scan_unseen(stored.dropDuplicates(["__sha"]), ledger, rules)


def record_version(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text", version: int | None = None) -> int:
    """Append the paths of ``docs`` with their blobs as a version (default: one
    above the latest recorded); the version's number."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    if version is None:
        known = _read(spark, ledger, "paths", f"__path {kind}, {_PATHS}")
        version = 1 if known is None else (known.agg(F.max("__version")).first()[0] or 0) + 1
    sha = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    (docs.select(F.col(id_col).alias("__path"), F.lit(version).cast("long").alias("__version"), sha.alias("__sha"))
     .write.parquet(f"{ledger}/paths-{uuid.uuid4().hex}"))
    return version


def path_findings(spark: SparkSession, ledger: str, path_type: str = "bigint", rules: str = RULE_VERSION) -> DataFrame:
    """Findings of every recorded version of every path: ``path``, ``version``,
    ``sha256`` (hex), the counts, ``base`` and ``spans`` (null where the version's
    blob was not scanned with ``rules``)."""
    paths = _read(spark, ledger, "paths", f"__path {path_type}, {_PATHS}").distinct()
    found = read_ledger(spark, ledger).where(F.col("__rules") == rules).drop("__rules")
    return paths.join(found, "__sha", "left").select(
        F.col("__path").alias("path"), F.col("__version").alias("version"), F.lower(F.hex("__sha")).alias("sha256"),
        "n_assign", "n_access", "n_hex", "base", "spans")


def _read(spark: SparkSession, ledger: str, kind: str, schema: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{kind}-*")
    some = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return spark.read.schema(schema).parquet(f"{ledger}/{kind}-*") if some else None


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's findings, each blob and rule version once, or None before its first run."""
    rows = _read(spark, ledger, "run", _SCHEMA)
    return None if rows is None else rows.dropDuplicates(["__sha", "__rules"])


def secret_scan(docs: DataFrame, ledger: str, text_col: str = "text", rules: str = RULE_VERSION, *,
                id_col: str | None = "doc_id", version: int | None = None, keep_texts: bool = False) -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base`` and
    ``spans`` (``kind:start:end``, comma-joined) from the brought-up ledger. The
    paths are recorded as a version, unless ``id_col`` is None."""
    update_ledger(docs, ledger, text_col, rules, keep_texts=keep_texts)
    if id_col is not None:
        record_version(docs, ledger, id_col, text_col, version)
    found = read_ledger(docs.sparkSession, ledger).where(F.col("__rules") == rules).drop("__rules")
    sha = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    own = docs.drop("n_assign", "n_access", "n_hex", "base", "spans").withColumn("__sha", sha)
    return own.join(found, "__sha", "left").drop("__sha")
