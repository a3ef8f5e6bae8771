"""Word-first backoff against a plain implementation, both ways of holding the model."""

import math
import re
from collections import Counter
from random import Random

import pytest
from pyspark.sql import functions as F

from basketry.llm import lang_id

ALPHABET = {"aa": "abcde", "bb": "cdefg", "cc": "efghé"}


@pytest.fixture(scope="module")
def rows():
    rng = Random(11)
    out = []
    for i in range(90):
        lang = ["aa", "bb", "cc"][i % 3]
        words = ["".join(rng.choice(ALPHABET[lang]) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 40))]
        out.append((i, rng.choice([" ", ", ", "\n1"]).join(words), lang))
    out += [(90, None, "aa"), (91, "", "bb"), (92, "12 ?!", "cc"), (93, "Abc ABC abc", None), (None, "cde cde", "bb"),
            (94, "xyz xé", None), (95, out[0][1], "bb"), (95, out[0][1], "bb"), (96, " ".join(r[1] for r in out), None)]
    return out


def words_of(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def plain(rows):
    """doc text -> (language, posterior) from dictionaries, learnt from all labelled rows."""
    count = {}
    for _, text, lang in rows:
        for w in words_of(text) if lang else ():
            count.setdefault((lang, 0), Counter())[w] += 1
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    count.setdefault((lang, n), Counter())[w[i:i + n]] += 1
    langs = sorted({lang for lang, _ in count})
    known = [set().union(*(count.get((lang, n), ()) for lang in langs)) for n in range(5)]

    def log(lang, n, x):
        c = count.get((lang, n), Counter())
        return math.log((c[x] + 0.5) / (sum(c.values()) + 0.5 * (len(known[n]) + 1)))

    def score(text):
        found = words_of(text)
        if not found:
            return "und", 0.0
        total = dict.fromkeys(langs, 0.0)
        for w in found:
            for lang in langs:
                if w in known[0]:
                    total[lang] += log(lang, 0, w)
                    continue
                for i in range(len(w)):
                    n = next((n for n in range(min(4, len(w) - i), 0, -1) if w[i:i + n] in known[n]), 0)
                    total[lang] += log(lang, n, w[i:i + n]) / len(w) if n else 0.0
        best = max(langs, key=lambda x: total[x])
        return best, 1 / sum(math.exp(total[x] - total[best]) for x in langs)
    return score


@pytest.mark.parametrize("model_bytes", [None, 24 * 150, 0])
def test_scores(spark, rows, model_bytes):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = lang_id.fit(docs, "doc_id", "text", "lang", F.lit(True), model_bytes=model_bytes)
    assert (model["rest"] is None) == (model_bytes is None) and model["langs"] == ["aa", "bb", "cc"]
    # only a third of the rows is learnt from below: words unknown to all languages occur
    learnt = [r for r in rows if r[0] is not None and r[0] % 3 != 1 or r[0] is None]
    part = spark.createDataFrame(learnt, docs.schema)
    for train, data in ((docs, rows), (part, learnt)):
        model = lang_id.fit(train, "doc_id", "text", "lang", F.lit(True), model_bytes=model_bytes)
        want = plain(data)
        got = lang_id.identify(docs, model).collect()
        assert len(got) == len(rows)
        for r in got:
            lang, score = want(r["text"])
            assert abs(r["score"] - score) < 1e-9
            assert r["lang_pred"] == lang or abs(score - 0.5) < 1e-9


def test_long_texts_are_cut_between_words(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(docs.where("doc_id % 3 != 1"), "doc_id", "text", "lang", F.lit(True))
    texts = [r[1] for r in rows]
    total, some = lang_id.score_sums(model, texts)
    monkeypatch.setattr(lang_id, "PIECE", 40)
    assert len(list(lang_id._pieces(texts))) > 50
    cut, cut_some = lang_id.score_sums(model, texts)
    assert abs(total - cut).max() < 1e-9 and (some == cut_some).all()


def test_many_languages_are_all_learnt(spark):
    n = 1500
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("same "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"),
                                 F.concat(F.lit("l"), F.col("id")).alias("lang"))
    model = lang_id.fit(docs, "doc_id", "text", "lang", F.lit(True))
    assert len(model["langs"]) == n
    assert lang_id.identify(docs, model).where(F.col("lang") == F.col("lang_pred")).count() == n


def test_columns(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("h", F.lit(1)).withColumn("kind", F.lit(2))
    for model_bytes in (None, 0):
        model = lang_id.fit(docs, "doc_id", "text", "lang", F.lit(True), model_bytes=model_bytes)
        got = lang_id.identify(docs, model)
        assert got.columns == ["doc_id", "text", "lang", "h", "kind", "lang_pred", "score"]
        assert {(r["h"], r["kind"]) for r in got.collect()} == {(1, 2)}
    assert lang_id.fit(docs.where("false"), "doc_id", "text", "lang", F.lit(True)) is None
    assert {tuple(r) for r in lang_id.identify(docs, None).select("lang_pred", "score").collect()} == {("und", 0.0)}
