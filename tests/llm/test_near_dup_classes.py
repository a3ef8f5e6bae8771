"""Near-duplicate classes against a comparison of all pairs."""
import random

import numpy as np
import pytest

from basketry.llm import near_dup as N
from basketry.llm import textkit as tk
import pyarrow as pa


def _grams(text):
    data, off = tk.utf8(pa.array([text]))
    return N._kmers(data, off)[3]


def _classes(texts, threshold=N.THRESHOLD):
    """Smallest id of each text's component, from all pairs."""
    grams = [_grams(t) for t in texts]
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if len(grams[i]) and len(grams[j]) and N.aligned(grams[i], grams[j], threshold) >= threshold:
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return [find(i) for i in range(len(texts))]


def _family(rng, words, copies, edits):
    base = [f"w{rng.randrange(3000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(1, edits)):
            at = rng.randrange(len(w))
            kind = rng.random()
            if kind < 0.5:
                w[at] = f"x{rng.randrange(10 ** 6)}"
            elif kind < 0.75:
                w.insert(at, f"y{rng.randrange(10 ** 6)}")
            else:
                del w[at]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("low,high,edits,recall", [(60, 220, 5, 1.0), (20, 80, 1, 0.97)])
def test_classes_match_all_pairs(spark, low, high, edits, recall):
    rng = random.Random(low)
    texts = [t for _ in range(16) for t in _family(rng, rng.randint(low, high), 14, edits)]
    rng.shuffle(texts)
    want = _classes(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(df).collect()}
    together = [(i, j) for i in range(len(texts)) for j in range(i) if want[i] == want[j]]
    assert sum(got[i] == got[j] for i, j in together) >= recall * len(together) > 100
    assert all(want[i] == want[j] for i in range(len(texts)) for j in range(i) if got[i] == got[j])  # nothing extra
    if recall == 1.0:
        assert got == dict(enumerate(want))


def test_a_group_of_copies_near_the_threshold_makes_few_pairs(spark, monkeypatch):
    """Copies that are near their base, but not near each other, are told apart
    by signature: pairs to align stay far below all pairs."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(f"z{rng.randrange(10 ** 6)}" if i in cut else w for i, w in enumerate(base))
             for cut in (set(rng.sample(range(150), 5)) | {0} for _ in range(250))]
    seen = []
    cut_lineage = N.cut_lineage
    monkeypatch.setattr(N, "cut_lineage", lambda df, tag: (out := cut_lineage(df, tag), seen.append(out.count()) if tag == "op2-verified" else None)[0])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["class_id"] for r in N.near_duplicates(df).orderBy("doc_id").collect()]
    assert got == _classes(texts)
    assert sum(seen) < 250 * 249 / 2 / 10


def test_signatures_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(5)
    lost = 0
    for _ in range(60):
        n = int(rng.integers(40, 400))
        common = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        own = max(1, int(n * 0.2 / 0.8 / 2))  # n / (n + 2 * own) is 0.8
        a, b = (np.concatenate([common, rng.integers(0, 2 ** 63, own, dtype=np.uint64)]) for _ in range(2))
        words = N._signature(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2)
        lost += int(np.bitwise_count(words[0] ^ words[1]).sum()) > N.allowed_bits(0.8)
    assert lost == 0
