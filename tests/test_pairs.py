"""Support-bounded top pairs against a plain count of all pairs."""
import random
from collections import Counter
from itertools import combinations

import pytest

from basketry.operators import pairs
from basketry.operators.pairs import top_pairs


def _plain(rows, k):
    baskets, support = {}, Counter()
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    counts = Counter()
    for items in baskets.values():
        support.update(items)
        counts.update(combinations(sorted(items), 2))
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
    return [(a, b, n, support[a], support[b]) for (a, b), n in top]


def _top(df, k):
    return sorted((tuple(r) for r in top_pairs(df, "o", "p", k).collect()), key=lambda r: (-r[2], r[0], r[1]))


@pytest.mark.parametrize("k", [1, 5, 40, 100_000])
def test_pairs_match_plain(spark, k):
    rng = random.Random(k)
    rows = [(o, min(int(rng.paretovariate(0.6)), 300)) for o in range(300) for _ in range(rng.randint(1, 9))]
    rows += [(None, 1), (3, None), (5, 2), (5, 2)] + [(900, i) for i in range(400)]  # nulls, repeats, a basket of every item
    df = spark.createDataFrame(rows, "o long, p long").repartition(5)
    assert _top(df, k) == _plain(rows, k)


def test_only_frequent_items_are_paired(spark, monkeypatch):
    """A bound that settles the result keeps rare items out of all pair rows."""
    monkeypatch.setattr(pairs, "START_ITEMS", 4)
    seen = []
    count = pairs._pair_counts
    monkeypatch.setattr(pairs, "_pair_counts", lambda lines, items: seen.append(items.count()) or count(lines, items))
    rows = [(o, p) for o in range(50) for p in (1, 2, 3, 4)] + [(o, 100 + 7 * o + j) for o in range(50) for j in range(7)]
    df = spark.createDataFrame(rows, "o long, p long")
    assert _top(df, 6) == _plain(rows, 6)
    assert seen == [4]  # of 354 items


def test_empty(spark):
    assert top_pairs(spark.createDataFrame([], "o long, p long"), "o", "p", 3).count() == 0
