"""Mixing sources to target weights by Efraimidis-Spirakis sampling
(DataFrame functions only).

Each document gets the key ``u ** (1 / weight)`` with ``u`` a hash of its id
and text and ``weight`` its quality weight; documents are taken in falling key
order, that is in rising order of ``-log(u) / weight``, an exponential variable of
rate ``weight``, which tells keys apart where the power would round to 0 or 1. A source whose target exceeds its size is first taken whole as often as
it fits (complete epochs); the rest of the target is filled by key order and
the document at the budget's edge is cut to what is left, so each source
reaches its target to the word.

Prefix sums without a global or per-source sort: the variables' logarithms are
spread over ``CELLS`` cells per level, word counts per cell are summed (map-side
combined), and only the one cell of each source that holds the budget's edge is
refined; after two levels (``CELLS ** 2`` cells) the edge cell alone is ordered
by a window. The logarithm of an exponential variable has the same spread
whatever its rate, so documents of any weight are spread alike: a cell of the
second level holds at most about 3 in a million of them (see ``tests/llm``). A hot
source therefore never meets in one task.

The table of sources (one row each) is ordered by one task; it holds no
documents. Targets: a source's share is its weight, capped at ``max_epochs``
times its size, the excess reshared by weight; the level at which nothing is
above its cap is found by one running sum over sources ordered by
cap / weight.

Defined cases: null text has size 0; null source is a source of its own,
ordered last; documents of size 0 take 0; repeated rows count each; ties of
keys go to the smaller id (null last); weights that are null, NaN or not
positive count as ``MIN_WEIGHT``. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..session import cut_lineage
from .common import BROADCAST_BYTES, n_tokens

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
CELLS = 4096
LOWEST, HIGHEST = -64.0, 64.0  # of the logarithms told apart
MIN_WEIGHT = 0.05
SEED = "mix-1"


def quality_weight(text: Column) -> Column:
    """Share of characters that are not ASCII digits, marks or upper-case
    letters, at least ``MIN_WEIGHT``."""
    junk = F.length(text) - F.length(F.regexp_replace(text, r"[!-Z\[-`{-~]", ""))
    return F.greatest(F.lit(MIN_WEIGHT), F.coalesce(
        F.lit(1.0) - junk / F.nullif(F.length(text), F.lit(0)), F.lit(0.0)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (``source``, ``source_size``) with ``target``."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % k + 1).cast("int"))
    t = sizes.withColumn("__w", w).withColumn("__cap", (F.col("source_size") * max_epochs).cast("double"))
    order = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    t = t.withColumn("__left", F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
    t = t.withColumn("__rest", F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
    # with sources before this one at their caps, its share of the rest
    t = t.withColumn("__level", F.col("__left") / F.col("__rest"))
    t = t.withColumn("__free", F.col("__level") * F.col("__w") <= F.col("__cap"))
    # the first source below its cap sets the level of all after it
    first = F.first(F.when(F.col("__free"), F.col("__level")), ignorenulls=True).over(order)
    return t.withColumn("target", F.when(first.isNull(), F.col("__cap")).otherwise(
        F.least(first * F.col("__w"), F.col("__cap")))).select("source", "source_size", "target")


def _cell(level: int) -> Column:
    place = (F.log("__x") - LOWEST) / (HIGHEST - LOWEST) * F.lit(float(CELLS ** level))
    return F.greatest(F.lit(0), F.least(F.floor(place), F.lit(CELLS ** level - 1))).cast("long") % CELLS


def _edges(hist: DataFrame, keys: list[str], cell: str, done: str) -> DataFrame:
    """Per source: the first cell whose running sum reaches the rest."""
    run = Window.partitionBy(*keys).orderBy(cell)
    t = hist.withColumn("__run", F.sum("__s").over(run))
    past = t.where(F.col("__run") >= F.col("__need"))
    return past.groupBy(*keys).agg(
        F.min(F.struct(F.col(cell), (F.col("__run") - F.col("__s")).alias(done))).alias("__e"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        weight: Column | None = None, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``,
    ``target``, ``weight``, ``taken`` (words, repeats counted)."""
    q = quality_weight(F.col(text_col)) if weight is None else weight.cast("double")
    q = F.when(q.isNull() | F.isnan(q) | (q <= 0), F.lit(MIN_WEIGHT)).otherwise(q)
    code = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"), F.md5(
        F.coalesce(F.col(text_col), F.lit(""))))), 1, 12)
    u = (F.conv(code, 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 48))
    base = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_tokens(F.col(text_col)).alias("size"),
        q.alias("weight"), u.alias("__u")).withColumn("__x", -F.log("__u") / F.col("weight")), "op3-sizes")
    base = base.withColumn("__c1", _cell(1)).withColumn("__c2", _cell(2))
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    tgt = source_targets(sizes, weights, max_epochs)
    plan = (tgt.withColumn("__epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("long"))
            .withColumn("__need", F.round(F.col("target") - F.col("__epochs") * F.col("source_size")).cast("long"))
            .withColumn("__sid", F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))))
    plan = cut_lineage(plan, "op3-plan")
    sid = F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    on_plan = plan.select("__sid", "__need", "__epochs", "source_size", "target")
    base = base.withColumn("__sid", sid)
    h1 = (base.groupBy("__sid", "__c1").agg(F.sum("size").alias("__s"))
          .join(on_plan.select("__sid", "__need"), "__sid").where(F.col("__need") > 0))
    e1 = _edges(h1, ["__sid"], "__c1", "__done").select(
        "__sid", F.col("__e.__c1").alias("__e1"), F.col("__e.__done").alias("__done1"))
    state1 = cut_lineage(on_plan.join(e1, "__sid", "left"), "op3-edge1")
    in1 = join_small(base, state1, "__sid", "inner", BROADCAST_BYTES)
    h2 = (in1.where(F.col("__c1") == F.col("__e1")).groupBy("__sid", "__c2").agg(
        F.sum("size").alias("__s"), F.first("__need").alias("__n"), F.first("__done1").alias("__d"))
        .select("__sid", "__c2", "__s", (F.col("__n") - F.col("__d")).alias("__need")))
    e2 = _edges(h2, ["__sid"], "__c2", "__done").select(
        "__sid", F.col("__e.__c2").alias("__e2"), F.col("__e.__done").alias("__done2"))
    state2 = cut_lineage(state1.join(e2, "__sid", "left"), "op3-edge2")
    got = join_small(base, state2, "__sid", "inner", BROADCAST_BYTES)
    c1, c2, e1c, e2c = F.col("__c1"), F.col("__c2"), F.col("__e1"), F.col("__e2")
    at_edge = F.coalesce((c1 == e1c) & (c2 == e2c), F.lit(False))
    before = F.coalesce((c1 < e1c) | ((c1 == e1c) & (c2 < e2c)), F.lit(False))
    # the edge cell: a few documents in a million of a source
    run = (Window.partitionBy("__sid").orderBy("__x", F.col("doc_id").asc_nulls_last(), "size")
           .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("__need") - F.col("__done1") - F.col("__done2") - F.coalesce(F.sum("size").over(run), F.lit(0))
    edge = got.where(at_edge).withColumn("__part", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    rest = got.where(~at_edge).withColumn("__part", F.when(before, F.col("size")).otherwise(0).cast("long"))
    out = rest.unionByName(edge)
    return out.select("doc_id", "source", "size", "source_size", "target", "weight",
                      (F.col("__epochs") * F.col("size") + F.col("__part")).cast("long").alias("taken"))
