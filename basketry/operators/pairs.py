"""Most frequent pairs of items in baskets, exactly, without counting all pairs.

*Support bound.* A pair is in no more baskets than its rarer item. So the pairs
among the most frequent items are counted first; the ``k``-th count found is a
bound, and an item in fewer baskets than the bound is in no pair of the result
(ties included, as only strictly rarer items go). The bound rises, and the set
of items that may matter shrinks or is settled, until all items in at least
``bound`` baskets have been counted among each other: then the first ``k`` pairs
are final.

*Bounded pair rows.* A basket gives the pairs of its items in play, never those
of all its items. Baskets are not gathered: an item row meets the rows of its
basket that have a smaller item, dealt by basket and *block* of items. The items
in play are numbered by frequency and cut into blocks of ``BLOCK``; a basket is
at most one row per block of up to ``BLOCK`` items, and a pair of blocks is one
join row, so one huge basket is many rows of bounded size and not one group in
one task. Pairs are counted by a map-side combined aggregation.

Without a bound to start from (fewer than ``k`` pairs among the items tried)
four times as many items are tried; in the end all of them, which is the exact
answer where few pairs exist at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ranking import global_row_number, sort_key

START_ITEMS, BLOCK = 64, 64


def _pair_counts(lines: DataFrame, items: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``n``): number of baskets with both items, for all pairs
    of ``items`` (``item``, ``place``), the smaller item first."""
    kept = lines.join(items, "item").select("basket", "item", F.floor(F.col("place") / BLOCK).alias("block"))
    # at most BLOCK items a row
    rows = kept.groupBy("basket", "block").agg(F.sort_array(F.collect_set("item")).alias("items"))
    rows = cut_lineage(rows, "pairs-blocks")
    left, right = rows.toDF("basket", "block_a", "one"), rows.toDF("basket", "block_b", "two")
    met = left.join(right, "basket").where(F.col("block_a") <= F.col("block_b"))
    ones = met.select("block_a", "block_b", "two", F.explode("one").alias("x"))
    pairs = ones.select("x", F.explode(F.filter("two", lambda y: (F.col("block_a") < F.col("block_b")) | (y > F.col("x")))).alias("y"))
    return pairs.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("n"))


def top_pairs(lines: DataFrame, basket_col: str, item_col: str, k: int) -> DataFrame:
    """The ``k`` pairs of different items that share most baskets: (``item_a``,
    ``item_b``, ``baskets``, ``baskets_a``, ``baskets_b``), ``item_a`` the
    smaller; ties go to the smaller items. Rows with a null basket or item take
    no part; an item repeated in a basket counts once."""
    lines = cut_lineage(lines.select(F.col(basket_col).alias("basket"), F.col(item_col).alias("item")).dropna().distinct(), "pairs-lines")
    support = cut_lineage(lines.groupBy("item").agg(F.count(F.lit(1)).alias("support")), "pairs-support")
    n_items = support.count()
    tried, bound = START_ITEMS, 0
    while True:
        # the items to count: all that may be in the result, as far as is known
        most = support.orderBy(F.desc("support"), "item").limit(tried) if tried < n_items else support
        least = most.agg(F.min("support")).first()[0] or 0
        floor = max(least, bound)
        items = support.where(F.col("support") >= floor)  # whole classes of equal support
        items = global_row_number(items, [sort_key("support", False), sort_key("item")], "place")
        best = cut_lineage(_pair_counts(lines, items).orderBy(F.desc("n"), "a", "b").limit(k), "pairs-best")
        found, kth = best.agg(F.count(F.lit(1)), F.min("n")).first()
        if found == k and kth > bound:
            bound = kth
        # done if no item was left out that is in as many baskets as the k-th pair
        if floor <= bound or floor <= 1 or tried >= n_items:
            break
        tried = tried * 4 if found < k else n_items
    about = support.select(F.col("item").alias("a"), F.col("support").alias("baskets_a"))
    other = support.select(F.col("item").alias("b"), F.col("support").alias("baskets_b"))
    return best.join(about, "a").join(other, "b").select(
        F.col("a").alias("item_a"), F.col("b").alias("item_b"), F.col("n").alias("baskets"), "baskets_a", "baskets_b")
