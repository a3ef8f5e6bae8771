"""Language ID: word-first backoff.

Known words score the log of their relative frequency in each language. For a
word that no language knows, each character position scores the longest
character n-gram (4 down to 1) that starts there and is known; the word's score
is the mean over its positions. The language with the highest sum wins; the
score is its posterior under equal priors.

The model is fit on a sample of labelled rows of about ``fit_rows`` rows, dealt
evenly to the languages but at least ``LANG_ROWS`` of each (or all it has); a hash
of the id picks them. Every word and n-gram of the sample is an entry, in a
written table of (language, kind, hash, count). Up to ``MODEL_BYTES`` the entries
are broadcast and a row is scored in one pass. Beyond, only the most frequent
words within that size are; every other word of the texts, once each, joins the
table, and its score joins the rows that hold it. Both ways give the same scores.

A language's score is a sum over matched entries of a constant of (kind,
language) plus, where the language has the entry, log((count + s) / s), so
entries are held by the languages that have them, not as a dense matrix.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
as is everything when there is nothing to learn from; ties go to the language
first in code point order; repeated rows score alike; a long text is cut between
words into pieces whose sums add up; extra columns pass through, but for
``lang_pred`` and ``score``, which the results replace.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_small
from ..session import cut_lineage
from . import textkit as tk
from .common import BROADCAST_BYTES

FIT_ROWS, LANG_ROWS, ORDER = 24_000, 24, 4
# entries that are broadcast: at most this, at ENTRY_BYTES a (language, kind, hash)
MODEL_BYTES, ENTRY_BYTES = 64 * 1024 * 1024, 24
PIECE, CELLS = 1 << 19, 1 << 22
SMOOTH = 0.5
_U = np.uint64
_LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])


def _points(low: list[str]) -> tuple[np.ndarray, np.ndarray]:
    off = np.zeros(len(low) + 1, np.int64)
    np.cumsum([len(t) for t in low], out=off[1:])
    return np.frombuffer("".join(low).encode("utf-32-le"), np.uint32), off


def _pieces(texts: list[str | None], limit: int = 0):
    """(row numbers, lower-case parts) of about ``limit`` characters; a text may
    be cut where a part ends, before a character that is no letter."""
    limit = limit or PIECE
    rows, parts, n = [], [], 0
    for i, t in enumerate(texts):
        low, at = (t or "").lower(), 0
        while at < len(low):
            end = min(len(low), at + limit - n)
            while end < len(low) and low[end].isalpha():
                end += 1
            rows.append(i)
            parts.append(low[at:end])
            n, at = n + end - at, end
            if n >= limit:
                yield np.array(rows), parts
                rows, parts, n = [], [], 0
    if rows:
        yield np.array(rows), parts


def _gram(points: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    h = np.full(len(at), n, _U)
    for j in range(n):
        h = h * _U(0x9FB21C651E98DF25) + points[at + j].astype(_U) + _U(1)
    return tk.mix(h)


def _word_hashes(points, starts, ends):
    return tk.mix(tk.run_hashes(points, starts, ends) ^ _U(0x2545F4914F6CDD1D))


def _counts(batches):
    """(lang, kind, hash, count): kind 0 words, 1 to ORDER n-grams."""
    for batch in batches:
        names = batch.column("__lang").to_pylist()
        for lang in sorted(set(names)):
            rows = pa.array([i for i, x in enumerate(names) if x == lang])
            for _, parts in _pieces(batch.column("__t").take(rows).to_pylist()):
                points, off = _points(parts)
                starts, ends, _ = tk.spans(_LETTER[points], off)
                if not len(starts):
                    continue
                at, gap = _positions(starts, ends)
                found = [(0, _word_hashes(points, starts, ends))]
                found += [(n, _gram(points, at[gap >= n], n)) for n in range(1, ORDER + 1)]
                for kind, h in found:
                    key, count = np.unique(h, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(key), pa.string()), pa.array(np.full(len(key), kind, np.int32)),
                         pa.array(key.view(np.int64)), pa.array(count.astype(np.int64))], ["lang", "kind", "h", "n"])


def _positions(starts, ends):
    """All positions inside the words, and the characters from each to its word's end."""
    size = ends - starts
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return at + np.repeat(starts, size), np.repeat(size, size) - at


def _index(table: pa.Table, place: dict[str, int]) -> tuple:
    """(sorted hashes, first pair of each, language numbers, gains) of one kind's entries."""
    h = table.column("h").to_numpy().view(_U)
    lang = np.array([place[x] for x in table.column("lang").to_pylist()], np.int32)
    order = np.lexsort((lang, h))
    keys, first = np.unique(h[order], return_index=True)
    gain = np.log((table.column("n").to_numpy()[order] + SMOOTH) / SMOOTH)
    return keys, np.append(first, len(h)), lang[order], gain


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, use: Column, *,
        fit_rows: int = FIT_ROWS, model_bytes: int | None = None) -> dict | None:
    """The model from the rows where ``use`` holds, or None without any."""
    limit = MODEL_BYTES if model_bytes is None else model_bytes
    known = docs.where(use & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("__id"), F.col(text_col).alias("__t"), F.col(lang_col).alias("__lang"))
    sizes = cut_lineage(known.groupBy("__lang").agg(F.count(F.lit(1)).alias("__size")), "op6-sizes")
    share = max(LANG_ROWS, fit_rows / max(1, sizes.count()))
    pick = F.pmod(F.xxhash64(F.lit("lang-sample"), "__id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = join_small(known, sizes, "__lang", "inner", BROADCAST_BYTES).where(pick < F.lit(float(share)) / F.col("__size"))
    table = cut_lineage(sample.select("__t", "__lang").mapInArrow(_counts, "lang string, kind int, h bigint, n bigint")
                        .groupBy("lang", "kind", "h").agg(F.sum("n").alias("n")), "op6-entries")
    # one row a language and kind
    sums = {(r[0], r[1]): (r[2], r[3]) for r in table.groupBy("lang", "kind").agg(F.sum("n"), F.count(F.lit(1))).collect()}
    if not sums:
        return None
    langs = sorted({lang for lang, _ in sums})
    keys = {r[0]: r[1] for r in table.groupBy("kind").agg(F.count_distinct("h")).collect()}
    floors = np.array([[np.log(SMOOTH) - np.log(sums.get((lang, kind), (0, 0))[0] + SMOOTH * (keys.get(kind, 0) + 1)) for lang in langs]
                       for kind in range(ORDER + 1)])
    held, rest = table, None
    if sum(n for _, n in sums.values()) * ENTRY_BYTES > limit:
        held, rest = _frequent_words(table, limit // ENTRY_BYTES), table
    flat, place = held.toArrow(), {lang: j for j, lang in enumerate(langs)}
    kind = flat.column("kind").to_numpy()
    kinds = [0] if rest is not None else range(ORDER + 1)
    return {"langs": langs, "floors": floors, "parts": [_index(flat.filter(pa.array(kind == k)), place) for k in kinds], "rest": rest}


def _frequent_words(table: DataFrame, entries: int) -> DataFrame:
    """Entries of the most frequent words, all languages of a word or none:
    words of at least 2^b occurrences for the smallest b that fits."""
    word = table.where(F.col("kind") == 0).groupBy("h").agg(F.sum("n").alias("f"), F.count(F.lit(1)).alias("m"))
    word = cut_lineage(word.withColumn("b", F.floor(F.log2("f")).cast("int")), "op6-words")
    least, room = 64, entries
    for b, m in sorted(((r[0], r[1]) for r in word.groupBy("b").agg(F.sum("m")).collect()), reverse=True):
        if m > room:
            break
        least, room = b, room - m
    return table.where(F.col("kind") == 0).join(word.where(F.col("b") >= least).select("h"), "h", "left_semi").select(table.columns)


def _lookup(keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places of the hashes in ``keys``, -1 where unknown."""
    if not len(keys):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, at, -1)


def _gains(index: tuple, place: np.ndarray, owner: np.ndarray, weight: np.ndarray | None, shape: tuple[int, int]) -> np.ndarray:
    """Sums of the found entries' gains by (owner, language)."""
    _, first, lang, gain = index
    size = first[place + 1] - first[place]
    pair = np.arange(size.sum()) + np.repeat(first[place] - (np.cumsum(size) - size), size)
    value = gain[pair] if weight is None else gain[pair] * np.repeat(weight, size)
    cell = np.repeat(owner, size) * shape[1] + lang[pair]
    return np.bincount(cell, weights=value, minlength=shape[0] * shape[1]).reshape(shape)


def _backoff(model: dict, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Scores (words x languages) of words that no language knows."""
    at, gap = _positions(starts, ends)
    word = np.repeat(np.arange(len(starts)), ends - starts)
    open_ = np.arange(len(at))
    score = np.zeros((len(starts), len(model["langs"])))
    for n in range(ORDER, 0, -1):
        can = open_[gap[open_] >= n]
        index = model["parts"][n]
        place = _lookup(index[0], _gram(points, at[can], n))
        hit = can[place >= 0]
        score += _gains(index, place[place >= 0], word[hit], None, score.shape)
        score += np.bincount(word[hit], minlength=len(starts))[:, None] * model["floors"][n]
        done = np.zeros(len(at), bool)
        done[hit] = True
        open_ = open_[~done[open_]]
    return score / (ends - starts)[:, None]


def score_sums(model: dict, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sums (texts x languages) of all words that the broadcast part settles,
    and which texts have a letter."""
    langs = len(model["langs"])
    total, some = np.zeros((len(texts), langs)), np.zeros(len(texts), bool)
    for rows, parts in _pieces(texts, max(1, min(PIECE, 2 * CELLS // langs))):
        points, off = _points(parts)
        starts, ends, part = tk.spans(_LETTER[points], off)
        if not len(starts):
            continue
        row = rows[part]
        some[row] = True
        low, n = row[0], row[-1] - row[0] + 1  # rows of a piece are consecutive
        index = model["parts"][0]
        h, back = np.unique(_word_hashes(points, starts, ends), return_inverse=True)
        place = _lookup(index[0], h)[back]
        hit = place >= 0
        own = row[hit] - low
        total[low:low + n] += _gains(index, place[hit], own, None, (n, langs))
        total[low:low + n] += np.bincount(own, minlength=n)[:, None] * model["floors"][0]
        if len(model["parts"]) > 1 and not hit.all():
            # words that no language knows: once each, then spread to their rows
            _, one, again = np.unique(back[~hit], return_index=True, return_inverse=True)
            score = _backoff(model, points, starts[~hit][one], ends[~hit][one])
            np.add.at(total, row[~hit], score[again])
    return total, some


def _rest_words(held, text_col: str):
    """(``__row``, word hash, word, count) of the words outside the broadcast part."""
    def run(batches):
        for batch in batches:
            ids = batch.column("__row").to_numpy()
            for rows, parts in _pieces(batch.column(text_col).to_pylist()):
                points, off = _points(parts)
                starts, ends, part = tk.spans(_LETTER[points], off)
                h = _word_hashes(points, starts, ends) if len(starts) else np.zeros(0, _U)
                miss = np.flatnonzero(_lookup(held.value["parts"][0][0], h) < 0)
                order = miss[np.lexsort((h[miss], part[miss]))]
                if not len(order):
                    continue
                new = np.append(True, (h[order][1:] != h[order][:-1]) | (part[order][1:] != part[order][:-1]))
                one, text = order[new], "".join(parts)
                n = np.diff(np.append(np.flatnonzero(new), len(order)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows[part[one]]]), pa.array(tk.as_long(h[one])), pa.array([text[a:b] for a, b in zip(starts[one], ends[one])]),
                     pa.array(n.astype(np.int64))], ["__row", "__w", "__word", "__n"])
    return run


def _word_items(batches):
    """(``__w``, length, kind, position, hash): a word and all n-grams in it."""
    for batch in batches:
        own = batch.column("__w").to_numpy()
        for rows, words in _pieces(batch.column("__word").to_pylist(), 1 << 16):
            points, off = _points(words)
            at, gap = _positions(off[:-1], off[1:])
            word = np.repeat(np.arange(len(words)), np.diff(off))
            items = [(0, np.arange(len(words)), np.zeros(len(words), np.int64), own[rows].view(_U))]
            for n in range(1, ORDER + 1):
                ok = gap >= n
                items.append((n, word[ok], at[ok] - off[word[ok]], _gram(points, at[ok], n)))
            for kind, w, pos, h in items:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[rows][w]), pa.array(np.diff(off)[w]), pa.array(np.full(len(w), kind, np.int32)), pa.array(pos), pa.array(tk.as_long(h))],
                    ["__w", "__len", "kind", "__pos", "h"])


def _joined(rows: DataFrame, model: dict, held, text_col: str) -> DataFrame:
    """``rows`` (with ``__row``) plus ``__cover`` (kind, weight) and ``__gain``
    (language, sum) of the words that the broadcast part lacks."""
    words = cut_lineage(rows.select("__row", text_col).mapInArrow(
        _rest_words(held, text_col), "__row bigint, __w bigint, __word string, __n bigint"), "op6-rest")
    items = (words.groupBy("__w").agg(F.any_value("__word").alias("__word"))
             .mapInArrow(_word_items, "__w bigint, __len bigint, kind int, __pos bigint, h bigint"))
    met = cut_lineage(items.join(model["rest"], ["kind", "h"]), "op6-met")
    whole = met.where(F.col("kind") == 0)
    longest = (met.where(F.col("kind") > 0).join(whole.select("__w").distinct(), "__w", "left_anti")
               .groupBy("__w", "__pos").agg(F.max("kind").alias("kind")))
    cols = ["__w", "kind", "__pos", "__len", "lang", "n"]
    used = cut_lineage(whole.select(cols).unionByName(met.join(longest, ["__w", "__pos", "kind"]).select(cols)), "op6-used")
    share = F.when(F.col("kind") == 0, F.lit(1.0)).otherwise(1.0 / F.col("__len"))
    cover = used.groupBy("__w", "kind", "__pos").agg(F.max(share).alias("c")).groupBy("__w", "kind").agg(F.sum("c").alias("c"))
    gain = used.groupBy("__w", "lang").agg(F.sum(share * F.log((F.col("n") + SMOOTH) / SMOOTH)).alias("g"))
    uses = words.select("__row", "__w", "__n")
    covers = (uses.join(cover, "__w").groupBy("__row", "kind").agg(F.sum(F.col("__n") * F.col("c")).alias("c"))
              .groupBy("__row").agg(F.collect_list(F.struct("kind", "c")).alias("__cover")))
    gains = (uses.join(gain, "__w").groupBy("__row", "lang").agg(F.sum(F.col("__n") * F.col("g")).alias("g"))
             .groupBy("__row").agg(F.collect_list(F.struct("lang", "g")).alias("__gain")))
    return rows.join(covers, "__row", "left").join(gains, "__row", "left")


def _add_joined(model: dict, batch: pa.RecordBatch, total: np.ndarray) -> None:
    place = {lang: j for j, lang in enumerate(model["langs"])}
    for i, (cover, gain) in enumerate(zip(batch.column("__cover").to_pylist(), batch.column("__gain").to_pylist())):
        for x in cover or ():
            total[i] += x["c"] * model["floors"][x["kind"]]
        for x in gain or ():
            total[i, place[x["lang"]]] += x["g"]


def identify(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    out = docs.drop("lang_pred", "score")
    if model is None:
        return out.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))
    own = {k: v for k, v in model.items() if k != "rest"}
    held = docs.sparkSession.sparkContext.broadcast(own)
    frame = out
    if model["rest"] is not None:
        frame = _joined(cut_lineage(out.withColumn("__row", F.monotonically_increasing_id()), "op6-rows"), model, held, text_col)

    names = out.columns

    def run(batches):
        step = max(1, CELLS // len(held.value["langs"]))
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                total, some = score_sums(held.value, batch.column(text_col).to_pylist())
                if "__row" in batch.schema.names:
                    _add_joined(held.value, batch, total)
                best = total.argmax(axis=1)
                odds = np.exp(total - total.max(axis=1, keepdims=True))
                top = odds[np.arange(len(odds)), best] / odds.sum(axis=1)
                pred = [held.value["langs"][b] if x else "und" for b, x in zip(best, some)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(pred, pa.string()), pa.array(np.where(some, top, 0.0))],
                                                 [*names, "lang_pred", "score"])

    schema = T.StructType([*out.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return frame.mapInArrow(run, schema)
