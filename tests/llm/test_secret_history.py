"""The ledger over versions and overlapping runs; base spans against plain regular expressions."""
import hashlib
import re


from basketry.llm import queries, secrets as S

KEY = "token = abcdef123456"


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_three_versions_and_overlapping_runs(spark):
    ledger = S.new_ledger(spark)
    one = _docs(spark, [(1, KEY), (2, KEY), (3, "clean"), (None, None)])
    two = _docs(spark, [(1, "now clean"), (2, KEY), (3, "clean"), (3, "clean")])
    three = _docs(spark, [(1, "now clean"), (2, "gone"), (4, "AKIA" + "Q" * 16)])
    for docs in (one, two, three):
        S.secret_scan(docs, ledger, keep_texts=True).count()
    got = {(r["path"], r["version"]): r["spans"] for r in S.path_findings(spark, ledger).collect()}
    span = f"assign:0:{len(KEY)}"
    assert got == {(1, 1): span, (2, 1): span, (3, 1): "", (None, 1): "", (1, 2): "", (2, 2): span, (3, 2): "",
                   (1, 3): "", (2, 3): "", (4, 3): "access:0:20"}
    # a run that is repeated, or overlaps another, appends its findings once more
    for part in ("run-again", "run-copy"):
        S._read(spark, ledger, "run", S._SCHEMA).write.parquet(f"{ledger}/{part}")
    assert S.secret_scan(one, ledger, version=1).count() == 4
    assert S.path_findings(spark, ledger).count() == len(got)
    # later rules: every version that was ever stored is scanned with them, once
    assert S.rescan(spark, ledger, "later") == 6 and S.rescan(spark, ledger, "later") == 0
    assert S.path_findings(spark, ledger, rules="later").where("spans IS NULL").count() == 0


def test_rules_are_named_by_their_patterns(monkeypatch):
    import importlib
    before = S.RULE_VERSION
    assert importlib.reload(S).RULE_VERSION == before and re.fullmatch("[0-9a-f]{16}", before)


def _plain(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(out)


def test_query_matches_plain(spark, tmp_path):
    rows = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    rows += [(90001, 'Password="short" API_KEY: é😀 secret=abcdef0123456789abcdef01 tokEn:xxxxxx'), (90002, None), (90003, ""),
             (90004, "AKIA" * 6 + " 0123456789abcdef0123456789abcdefg"), (90005, "passwd = 'a' token='aaaaaa' ſecret=aaaaaa"), (None, KEY)]
    _docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op5_secret_scan(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for doc, text in rows:
        want = _plain(text or "")
        r = got[doc]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for _, k, _ in want) for x in range(3)]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
