"""Pairs with tokens beyond the frequent ones: none is dropped, probabilities against plain code."""
import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from basketry.llm import lm_score as L
from basketry.llm import queries

from test_lm_bigrams import _conditional, _frame, _scores


def _texts():
    rng = np.random.default_rng(1)
    return [" ".join(f"w{min(int(x), 25)}" for x in rng.zipf(1.5, 12)) for _ in range(60)]


def _number(model, w):
    return int(model["names"].of(L.tk.run_hashes(np.frombuffer(w.encode() + b" ", np.uint8), np.array([0]), np.array([len(w)])))[0])


def test_other_pairs_against_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 12)
    monkeypatch.setattr(L, "HOT", 5)
    texts = _texts()
    model = L.fit(_frame(spark, texts), other_pairs=True)
    vocabulary = sorted({w for t in texts for w in t.split()})
    is_other = {w: _number(model, w) == model["names"].rare for w in [*vocabulary, "unknown"]} | {"<end>": False}
    pairs = Counter(p for t in texts for p in zip(["<end>", *t.split()], [*t.split(), "<end>"]))
    rooms = {c: {d: n for (a, d), n in pairs.items() if a == c and (is_other[c] or is_other[d])} for c in is_other}
    strength, discount = L.STRENGTH[1], L.DISCOUNT[1]

    names, found = model["names"], Counter()
    for r in model["pairs"].collect():
        _, a, b = names.split(r["bucket"], np.frombuffer(r["k"], np.uint32))
        found.update({(int(x), int(y)): float(z) for x, y, z in zip(a, b, np.frombuffer(r["x"], np.float32))})

    def to_others(c):
        v = names.end if c == "<end>" else _number(model, c)
        return sum(f[v] * q[names.rare] for f, q in model["states"]) / len(model["states"]) * 10 ** found[v, names.rare]

    known = {}

    def plain(c, d):
        """P(d | c) from the counts over the model of frequent tokens."""
        if c not in known:
            known[c] = _conditional(model, None if c == "<end>" else c, [w for w in is_other if w != "<end>"])
        base, room = known[c][d], rooms[c]
        if not room or not (is_other[c] or is_other[d]):
            return base
        free = strength + discount * len(room)
        within = 1.0 if is_other[c] else to_others(c)
        return within * (max(room.get(d, 0) - discount, 0) + free * base / within) / (strength + sum(room.values()))

    others = [w for w in vocabulary if is_other[w]]
    assert others and any(n > 1 for c in others for n in rooms[c].values())
    frequent = next(w for w in vocabulary if not is_other[w])
    for context in (others[0], frequent):
        words = [*vocabulary, "unknown"]
        got = dict(zip(words, _scores(spark, model, [f"{context} {w}" for w in words])))
        for w in words:
            assert got[w] == pytest.approx(sum(math.log10(plain(*p)) for p in (("<end>", context), (context, w), (w, "<end>"))), abs=1e-4)
        assert sum(plain(context, w) for w in [*words, "<end>"]) == pytest.approx(1, abs=1e-6)


def test_query_scores_seen_pairs_of_other_tokens(spark, monkeypatch, tmp_path):
    """Without the pairs of other tokens all orders of them score alike."""
    monkeypatch.setattr(L, "FREQUENT", 2)
    texts = ["alpha beta", "omaha bent"] * 20 + ["alpha beta", "alpha bent", "beta alpha"]
    ids = [i for i in range(1000) if crc32(str(i).encode()) % 7 != 2][:40]
    held = [i for i in range(1000) if crc32(str(i).encode()) % 7 == 2][:3]
    spark.createDataFrame(list(zip(ids + held, texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["score"] for r in queries.op9_lm_score(spark, str(tmp_path)).collect()}
    seen, unseen, backwards = (got[i] for i in held)
    assert seen > unseen + 0.5 and seen > backwards + 0.5


def test_without_other_tokens_nothing_changes(spark):
    df = _frame(spark, _texts())
    assert L.fit(df, other_pairs=True)["others"] is None
