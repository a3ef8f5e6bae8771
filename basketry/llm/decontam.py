"""Benchmark decontamination by winnowing (DataFrame functions only).

Texts are lower-cased (A-Z) and cut into words. Both sides keep, for every
run of ``span`` words, the minimum of its ``k``-word hashes; a run of ``span``
words that both share gives the same minimum on both sides, so each shared run
is found by an equi-join of fingerprints. Documents with a hit are extended:
their runs are compared as text with the runs of all items, and every word
inside an equal run is marked.

An item with fewer than ``span`` words is one window of its own length; for
each such length (at most ``span - 1`` of them) the window is the fingerprint.

Fingerprints of the benchmark are broadcast only when their measured size
allows; hits are (document, fingerprint) rows, never pairs of documents.

Defined cases: null or wordless texts have no words, hits or items; an item
with a null id still marks words but is not listed; repeated rows get the same
result each; rows with the same id and text are one document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..session import cut_lineage
from .common import BROADCAST_BYTES, ascii_lower

SPAN, GRAM = 10, 5
SEP = "\x1f"  # between item ids while they travel as one string
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _gram_hashes(hashes: str, k: int) -> Column:
    """Hashes of all runs of ``k`` words."""
    head = F.slice(F.col(hashes), F.lit(1), F.greatest(F.size(hashes) - (k - 1), F.lit(0)))
    return F.transform(head, lambda x, i: F.xxhash64(x, *[F.get(F.col(hashes), i + j) for j in range(1, k)]))


def _minima(grams: str, width: int) -> Column:
    head = F.slice(F.col(grams), F.lit(1), F.greatest(F.size(grams) - (width - 1), F.lit(0)))
    if width == 1:
        return F.array_distinct(head)
    return F.array_distinct(F.transform(
        head, lambda x, i: F.least(x, *[F.get(F.col(grams), i + j) for j in range(1, width)])))


def _fingerprints(texts: DataFrame, keys: list[str], text: str, k: int, width: int) -> DataFrame:
    """Rows (keys, ``__f``): winnowed ``k``-word hashes."""
    w = texts.select(*keys, F.transform(words(F.col(text)), lambda x: F.xxhash64(x)).alias("__h"))
    g = w.select(*keys, _gram_hashes("__h", k).alias("__g"))
    return g.select(*keys, F.explode(_minima("__g", width)).alias("__f"))


def _runs(texts: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """Rows (keys, ``__p``, ``__n``, ``__run``): all runs of the lengths, as text."""
    def of(n: int) -> DataFrame:
        head = F.slice(F.col("__w"), F.lit(1), F.greatest(F.size("__w") - (n - 1), F.lit(0)))
        runs = F.transform(head, lambda x, i: F.array_join(F.slice(F.col("__w"), i + 1, F.lit(n)), " "))
        return texts.select(*keys, F.posexplode(runs).alias("__p", "__run")).withColumn("__n", F.lit(n))
    return reduce(DataFrame.unionByName, [of(n) for n in lengths])


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", *,
                  span: int = SPAN, k: int = GRAM) -> DataFrame:
    """One row per row of ``docs`` with all its columns plus ``n_words``,
    ``n_hit``, ``n_items``, ``items`` (sorted strings) and ``contaminated``."""
    items = cut_lineage(bench.select(F.col(item_col).cast("string").alias("__item"), words(F.col(item_text)).alias("__w"))
                        .where(F.size("__w") > 0), "op4-items")
    lengths = sorted(r[0] for r in items.select(F.least(F.size("__w"), F.lit(span))).distinct().collect())
    keyed = docs.select(F.col(id_col).alias("__d"), F.xxhash64(text_col).alias("__x"), F.col(text_col).alias("__t"))
    known = items.withColumn("__t", F.array_join("__w", " "))
    found = []
    for n in lengths:
        kk, width = (k, span - k + 1) if n == span else (n, 1)
        own = known.where(F.size("__w") >= n if n == span else F.size("__w") == n)
        mine = _fingerprints(own, [], "__t", kk, width).distinct()
        theirs = _fingerprints(keyed, ["__d", "__x"], "__t", kk, width)
        found.append(join_small(theirs, cut_lineage(mine, "op4-prints"), "__f", "left_semi", BROADCAST_BYTES).select("__d", "__x"))
    out = ["n_words", "n_hit", "n_items", "items", "contaminated"]
    mark = docs.drop(*out).withColumns({"__kd": F.col(id_col), "__kx": F.xxhash64(text_col)})
    n_words = F.coalesce(F.regexp_count(text_col, F.lit(_WORD_ANY_CASE)), F.lit(0)).cast("long")
    if not found:
        return mark.drop("__kd", "__kx").withColumns({
            "n_words": n_words, "n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"),
            "items": F.array().cast("array<string>"), "contaminated": F.lit(False)})
    hits = cut_lineage(reduce(DataFrame.union, found).distinct(), "op4-candidates")
    same = lambda a, b: a["__d"].eqNullSafe(b["__d"]) & (a["__x"] == b["__x"])
    near = join_small(keyed, hits, same(keyed, hits), "left_semi", BROADCAST_BYTES)
    near = near.dropDuplicates(["__d", "__x"]).select("__d", "__x", words(F.col("__t")).alias("__w"))
    windows = []
    for n in lengths:
        own = items.where(F.size("__w") >= n if n == span else F.size("__w") == n)
        windows.append(_runs(own, ["__item"], [n]))
    runs = cut_lineage(reduce(DataFrame.unionByName, windows).groupBy("__n", "__run").agg(
        F.concat_ws(SEP, F.sort_array(F.collect_set("__item"))).alias("__items")), "op4-runs")
    equal = cut_lineage(join_small(_runs(near, ["__d", "__x"], lengths), runs, ["__n", "__run"], "inner", BROADCAST_BYTES)
                        .select("__d", "__x", "__p", "__n", "__items"), "op4-hits")
    n_hit = (equal.select("__d", "__x", F.explode(F.sequence("__p", F.col("__p") + F.col("__n") - 1)).alias("__at"))
             .distinct().groupBy("__d", "__x").agg(F.count(F.lit(1)).alias("n_hit")))
    listed = (equal.select("__d", "__x", "__items").distinct()
              .select("__d", "__x", F.explode(F.split("__items", SEP)).alias("__i")).where(F.col("__i") != "")
              .groupBy("__d", "__x").agg(F.concat_ws(SEP, F.sort_array(F.collect_set("__i"))).alias("__list"))
              .withColumnsRenamed({"__d": "__d2", "__x": "__x2"}))
    per_doc = n_hit.join(listed, n_hit["__d"].eqNullSafe(listed["__d2"]) & (n_hit["__x"] == listed["__x2"]), "left")
    per_doc = cut_lineage(per_doc.select("__d", "__x", "n_hit", F.coalesce("__list", F.lit("")).alias("__list")), "op4-docs")
    got = join_small(mark, per_doc, mark["__kd"].eqNullSafe(per_doc["__d"]) & (mark["__kx"] == per_doc["__x"]),
                     "left", BROADCAST_BYTES)
    none = F.array().cast("array<string>")
    listing = F.when(F.coalesce("__list", F.lit("")) == "", none).otherwise(F.split("__list", SEP))
    return (got.withColumn("n_words", n_words).withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
            .withColumn("items", listing).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", F.col("n_hit") > 0).drop("__kd", "__kx", "__d", "__x", "__list"))
