"""Disk: what op9 leaves written for tokens beyond the frequent ones, and their packed numbers."""
import glob
import os

import numpy as np

from basketry.llm import lm_score as L
from basketry.session import ensure_checkpoint_dir

from test_lm_bigrams import _frame


def _written(spark):
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    return {f: os.path.getsize(f) for f in glob.glob(f"{root}/basketry-anchors/**/*.parquet", recursive=True)}


def test_bytes_written_for_other_tokens(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 12)
    rng = np.random.default_rng(2)
    others = 300 * 300
    df = _frame(spark, [" ".join(f"w{x} the" for x in rng.integers(0, 40000, 300)) for _ in range(300)])
    before = _written(spark)
    assert L.score(df, L.fit(df, other_pairs=True)).count() == 300
    after = _written(spark)
    assert sum(size for f, size in after.items() if f not in before) < 45 * others


def test_packed_numbers_come_back():
    a, b, h = np.array([0, 7, 1 << 31, (1 << 32) - 1]), np.array([3, 300]), np.array([5, 1 << 63], np.uint64)
    x, y, rest = L._unpacked(L._packed(a, b) + h.tobytes(), 4, 2)
    assert x.tolist() == a.tolist() and y.tolist() == b.tolist() and rest.tolist() == h.tolist()
    for at in (np.array([0, 0, 5, 2, 65535, 1], np.uint16), np.array([9, 1 << 20, 3], np.uint32)):
        assert np.cumsum(np.frombuffer(L._rise(at), at.dtype), dtype=at.dtype).tolist() == at.tolist()
