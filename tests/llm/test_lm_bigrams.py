"""The bigram model: probabilities sum to one, seen pairs beat unseen ones, scores against plain code."""
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import lm_score as L


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def _scores(spark, model, texts):
    return [r["score"] for r in L.score(_frame(spark, texts), model).orderBy("doc_id").collect()]


def test_seen_pairs_beat_unseen_ones(spark):
    model = L.fit(_frame(spark, ["alpha beta"] * 50 + ["omaha bent"] * 50))
    seen, unseen, backwards = _scores(spark, model, ["alpha beta", "alpha bent", "beta alpha"])
    assert seen > unseen + 1 and seen > backwards + 1


@pytest.mark.parametrize("frequent", [1 << 17, 12])
def test_probabilities_sum_to_one(spark, monkeypatch, frequent):
    """Of every context, over all one-token continuations: known tokens, the end and one place for unknown ones."""
    monkeypatch.setattr(L, "FREQUENT", frequent)
    monkeypatch.setattr(L, "HOT", 5)
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{min(int(x), 25)}" for x in rng.zipf(1.5, 12)) for _ in range(60)]
    model = L.fit(_frame(spark, texts))
    vocabulary = sorted({w for t in texts for w in t.split()})
    for context in ("w1", vocabulary[-1], "neverseen"):
        words = [*vocabulary, "unknown"]
        pairs = dict(zip(words, _scores(spark, model, [f"{context} {w}" for w in words])))
        alone = _scores(spark, model, [context])[0]
        probability = _conditional(model, context, words)
        assert abs(sum(probability.values()) - 1) < 1e-6
        first = math.log10(_conditional(model, None, [context])[context])
        for w in words:
            assert pairs[w] == pytest.approx(first + math.log10(probability[w]) + math.log10(_conditional(model, w, [])["<end>"]), abs=1e-4)
        assert alone == pytest.approx(first + math.log10(probability["<end>"]), abs=1e-4)


def _conditional(model, context, words):
    """Plain P(word | context) from the model's tables, for ``words`` and the end."""
    names = model["names"]
    h = lambda w: L.tk.run_hashes(np.frombuffer(w.encode() + b" ", np.uint8), np.array([0]), np.array([len(w.encode())]))
    number = lambda w: int(names.of(h(w))[0])
    pairs = {}
    for r in model["pairs"].collect():
        key, c, d = names.split(r["bucket"], np.frombuffer(r["k"], np.uint32))
        pairs.update({(int(a), int(b)): float(x) for a, b, x in zip(c, d, np.frombuffer(r["x"], np.float32))})
    v = names.end if context is None else number(context)
    rare = {r["h"]: r["lp"] for r in model["tokens"].collect()}
    unknown = math.log10(_unknown(model))

    def p(d):
        return sum(f[v] * q[d] for f, q in model["states"]) / len(model["states"]) * 10 ** pairs.get((v, d), 0.0)
    out = {"<end>": p(names.end)}
    for w in words:
        d = number(w)
        out[w] = p(d) * (10 ** rare.get(int(h(w).view(np.int64)[0]), unknown) if d == names.rare else 1.0)
    return out


def _unknown(model):
    """Probability of an unknown token behind the common dish: what known ones leave."""
    return 1 - sum(10 ** r["lp"] for r in model["tokens"].where("c > 0").collect())


def test_held_out_gain_over_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = L.score(docs, L.fit(docs, "text", held), held=held).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert got[0] > got[1] + 0.05 * got[2]


def test_pairs_are_counted_whole(spark):
    texts = ["a b a b", "A b", "", None, "c"] * 7
    df = _frame(spark, texts)
    model = L.fit(df)
    names = model["names"]
    counted = df.select(F.col("text").alias("__t"), F.lit(False).alias("__held")).mapInArrow(
        L._pair_counts(spark.sparkContext.broadcast(names)), "bucket int, k binary, n binary")
    got = Counter()
    for r in counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(L._merged, "bucket int, k binary, c binary").collect():
        _, c, d = names.split(r["bucket"], np.frombuffer(r["k"], np.uint32))
        got.update({(int(a), int(b)): int(n) for a, b, n in zip(c, d, np.frombuffer(r["c"], np.int64))})
    want = Counter()
    for t in texts:
        x = ["", *(t or "").lower().split(), ""]
        want.update(zip(x, x[1:]))
    assert sorted(got.values()) == sorted(want.values())


def test_no_training_rows(spark):
    df = _frame(spark, ["a b", None])
    got = L.score(df, L.fit(df, held=F.lit(True)), held=F.lit(True)).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got] == [(3, 0, 0), (1, 0, 0)]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
