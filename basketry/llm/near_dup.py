"""Near-duplicate classes by order MinHash with banded alignment.

1. *Exact copies.* Texts with the same word sequence (A-Z lower-cased, words
   are runs of 0-9, a-z and non-ASCII) share a 128-bit digest and are one node.
2. *Order MinHash.* A node's k-mers are its runs of five words (a shorter text
   is one k-mer), each labelled with its occurrence number. For each of
   ``SKETCHES`` hash functions the ``ORDER`` smallest labelled k-mers, put back
   in text order, give one bucket key. Texts of similarity s share a key with
   probability about s ** ORDER per function: at 0.8 one pair in 300,000 is missed.
3. *Links.* In each bucket every node is compared with the bucket's centres,
   not with every other node. A centre has then met all its bucket and leaves
   it; the classes found so far are joined up; a bucket whose nodes are all in
   one class is done; the others go on with more centres, the smallest classes
   first, until no node is left, so no bucket is cut off. Only nodes of
   different classes meet, and only if their k-mers can reach the threshold:
   a k-mer that occurs in no other node is in no chain, so a node with c others of its m
   k-mers links only with nodes of at most c * (1 + t) / t - m k-mers (exact). Of these, a
   pair is compared only if its signatures fit the threshold: ``BITS`` bits, each of the least
   k-mer by one more hash function. Two nodes of similarity t differ in (1 - t) / 2 of them on
   average; pairs that differ in more than ``SPREAD`` standard deviations above that are set
   aside (at the threshold one pair in 300,000, fewer above it). They are told apart inside the
   lists of a bucket, before a row is made for a pair.
4. *Banded alignment.* A pair's labelled k-mers are matched inside a diagonal
   band whose width follows from the lengths and the threshold; the longest
   increasing chain L of matches gives the similarity L / (m + n - L), an order-aware
   Jaccard of five-word shingles. 0.8 or more is a link.
5. *Classes.* Connected components by minimum label with pointer jumping, each
   round written to shared storage.

Defined cases: null texts and texts without words are classes of their own;
repeated rows join one class; null ids are ordered last, and a class of null
ids only has a null class id; extra columns pass through.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import textkit as tk

K, ORDER, SKETCHES, THRESHOLD = 5, 4, 24, 0.8
BITS, SPREAD = 1024, 4.5
FORMING = 16  # up to so many centres of a bucket are its nodes that share most keys
STEP = 256  # a bucket's centres in one round; rounds go on until no node is left
_U = np.uint64
_TOP = _U(0xFFFFFFFFFFFFFFFF)
_FLIPS = np.random.default_rng(20240301).integers(1, 2 ** 63, (BITS, 2), dtype=np.uint64) * _U(2) + _U(1)
_SEEDS = np.random.default_rng(20240229).integers(1, 2 ** 63, (SKETCHES, 2), dtype=np.uint64) * _U(2) + _U(1)


def _kmers(data: np.ndarray, off: np.ndarray):
    """Per row: word count, two digests of the word sequence; per labelled
    k-mer: its hash and row, in text order."""
    low = tk.LOWER[data]
    starts, ends, row = tk.spans(tk.WORD[low], off)
    words = tk.run_hashes(low, starts, ends)
    rows = len(off) - 1
    count = np.bincount(row, minlength=rows)
    first = np.zeros(rows + 1, np.int64)
    np.cumsum(count, out=first[1:])
    salt = count.astype(_U) * _U(0xA0761D6478BD642F)
    one = tk.mix(tk.range_sums(words, first[:-1], first[1:]) ^ salt)
    two = tk.mix(tk.range_sums(tk.mix(words ^ _U(0x8BB84B93962EACC9)), first[:-1], first[1:]) + salt)
    n = len(words)
    if n >= K:
        grams = np.zeros(n - K + 1, _U)
        for j in range(K):
            grams = grams * _U(0x9FB21C651E98DF25) + words[j:n - K + 1 + j]
        inside = row[:n - K + 1] == row[K - 1:]
        grams, at = tk.mix(grams[inside]), row[:n - K + 1][inside]
    else:
        grams, at = np.zeros(0, _U), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < K))
    if len(short):
        at = np.concatenate([at, short])
        grams = np.concatenate([grams, one[short]])
        order = np.argsort(at, kind="stable")
        grams, at = grams[order], at[order]
    # number repeated k-mers of a row in text order
    both = tk.mix(grams ^ (at.astype(_U) * _U(0xE7037ED1A0B428DB)))
    order = np.argsort(both, kind="stable")
    s = both[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    head = np.flatnonzero(new)
    if len(head) < len(s):
        nth = np.arange(len(s)) - np.repeat(head, np.diff(np.append(head, len(s))))
        label = np.zeros(len(s), _U)
        label[order] = nth.astype(_U)
        grams = np.where(label > 0, tk.mix(grams + label * _U(0x8EBC6AF09C88C6E3)), grams)
    return count, one, two, grams, at


def _sketch(grams: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
    """Bucket keys, rows x SKETCHES (rows without k-mers: 0)."""
    size = np.bincount(at, minlength=rows)
    have = np.flatnonzero(size)
    keys = np.zeros((rows, SKETCHES), _U)
    if not len(have):
        return keys
    size = size[have]
    start = np.zeros(len(have), np.int64)
    np.cumsum(size[:-1], out=start[1:])
    missing = len(grams)
    tail = np.append(grams, _U(0))
    for i, (flip, factor) in enumerate(_SEEDS):
        v = (grams ^ flip) * factor
        picked = np.full((len(have), ORDER), missing, np.int64)
        for j in range(ORDER):
            least = np.minimum.reduceat(v, start)
            hit = np.flatnonzero(v == np.repeat(least, size))
            owner = np.searchsorted(start, hit, "right") - 1
            hit, owner = hit[v[hit] != _TOP], owner[v[hit] != _TOP]
            picked[owner, j] = hit
            v[hit] = _TOP
        picked.sort(axis=1)
        key = np.full(len(have), i + 1, _U)
        for j in range(ORDER):
            key = key * _U(0x9FB21C651E98DF25) + tail[picked[:, j]]
        keys[have, i] = tk.mix(key)
    return keys


def _signature(grams: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
    """One bit of each hash function's least k-mer, rows x BITS / 64 words."""
    size = np.bincount(at, minlength=rows)
    have = np.flatnonzero(size)
    words = np.zeros((rows, BITS // 64), _U)
    if len(have):
        start = np.zeros(len(have), np.int64)
        np.cumsum(size[have][:-1], out=start[1:])
        for i, (flip, factor) in enumerate(_FLIPS):
            least = np.minimum.reduceat((grams ^ flip) * factor, start)
            words[have, i // 64] |= (tk.mix(least) & _U(1)) << _U(i % 64)
    return words


def allowed_bits(threshold: float) -> int:
    """Bits in which the signatures of a pair to compare may differ."""
    p = (1 - threshold) / 2
    return int(BITS * p + SPREAD * (BITS * p * (1 - p)) ** 0.5)


def _digests(one: np.ndarray, two: np.ndarray, some: np.ndarray) -> pa.Array:
    raw = np.stack([one, two], axis=1).tobytes()
    return pa.array([raw[16 * i:16 * i + 16] if some[i] else None for i in range(len(one))], pa.binary())


def _sketch_batches(batches):
    for batch in batches:
        for lo, hi, data, off in tk.pieces(batch, "__t"):
            count, one, two, grams, at = _kmers(data, off)
            keys = tk.as_long(_sketch(grams, at, hi - lo))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__d")[lo:hi], _digests(one, two, count > 0),
                 tk.lists(keys.reshape(-1), np.arange(hi - lo + 1) * SKETCHES)], ["__d", "__c", "__keys"])


def _kmer_batches(batches):
    for batch in batches:
        for lo, hi, data, off in tk.pieces(batch, "__t"):
            count, one, two, grams, at = _kmers(data, off)
            bounds = np.searchsorted(at, np.arange(hi - lo + 1))
            words = tk.as_long(_signature(grams, at, hi - lo))
            yield pa.RecordBatch.from_arrays(
                [_digests(one, two, count > 0), tk.lists(tk.as_long(grams), bounds),
                 tk.lists(words.reshape(-1), np.arange(hi - lo + 1) * (BITS // 64))], ["__c", "__g", "__sig"])


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two sequences of distinct labelled k-mers: the longest
    chain of matches inside the band, over all k-mers of either."""
    m, n = len(a), len(b)
    if min(m, n) < threshold * max(m, n):
        return 0.0
    # a pair at the threshold leaves at most this many k-mers unmatched in all
    band = int((1 - threshold) / (1 + threshold) * (m + n)) + 1
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    order = np.argsort(i)
    i, j = i[order], j[order]
    j = j[np.abs(i - j) <= band]
    if len(j) < 2 or (j[1:] > j[:-1]).all():
        chain = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            k = bisect_left(tails, x)
            tails[k:k + 1] = [x]
        chain = len(tails)
    return chain / (m + n - chain)


def _verify(threshold: float):
    def run(batches):
        for batch in batches:
            fa, oa = batch.column("__ga").flatten().to_numpy(), batch.column("__ga").offsets.to_numpy()
            fb, ob = batch.column("__gb").flatten().to_numpy(), batch.column("__gb").offsets.to_numpy()
            oa, ob = oa - oa[0], ob - ob[0]
            ok = [aligned(fa[oa[i]:oa[i + 1]], fb[ob[i]:ob[i + 1]], threshold) >= threshold for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("__a"), batch.column("__b"), pa.array(ok, pa.bool_())],
                                             ["__a", "__b", "__ok"])
    return run


def components(links: DataFrame) -> DataFrame:
    """Rows (``__c``, ``__l``): the smallest node of each linked node's component."""
    if links.isEmpty():
        return links.select(F.col("__a").alias("__c"), F.col("__b").alias("__l"))
    edges = cut_lineage(links.select("__a", "__b").union(links.select("__b", "__a")).distinct(), "op2-edges")
    labels = cut_lineage(edges.groupBy("__a").agg(F.min("__b").alias("__m"))
                         .select(F.col("__a").alias("__c"), F.least("__a", "__m").alias("__l")), "op2-labels")
    while True:
        near = (edges.join(labels, edges["__a"] == labels["__c"]).groupBy("__b").agg(F.min("__l").alias("__n")))
        step = labels.join(near, labels["__c"] == near["__b"]).select(
            "__c", F.col("__l").alias("__old"), F.least("__l", "__n").alias("__via"))
        jump = labels.select(F.col("__c").alias("__j"), F.col("__l").alias("__jl"))
        labels = cut_lineage(step.join(jump, step["__via"] == jump["__j"], "left").select(
            "__c", "__old", F.least("__via", F.coalesce("__jl", "__via")).alias("__l")), "op2-labels")
        if labels.where(F.col("__l") != F.col("__old")).isEmpty():
            return labels.select("__c", "__l")
        labels = labels.select("__c", "__l")


def _links(nodes: DataFrame, texts: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame] | None:
    """Verified links between different texts and the classes they make, or None."""
    rows = nodes.select("__c", F.explode("__keys").alias("__k"))
    shared = rows.groupBy("__k").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    members = cut_lineage(rows.join(shared, "__k"), "op2-members")
    rank = members.groupBy("__c").agg(F.sum(F.log2("__n")).alias("__s"))
    members = cut_lineage(members.select("__k", "__c").join(rank, "__c"), "op2-ranked")
    if members.isEmpty():
        return None
    asked = cut_lineage(rank.select("__c").join(nodes.select("__c", F.col("__rep").alias("__id")), "__c"), "op2-asked")
    # each text moves once, at every size
    found = texts.join(asked.select("__id").distinct().hint("shuffle_hash"), texts["__d"].eqNullSafe(F.col("__id"))).select("__t")
    grams = found.mapInArrow(_kmer_batches, "__c binary, __g array<bigint>, __sig array<bigint>")
    grams = cut_lineage(grams.join(asked.select("__c").hint("shuffle_hash"), "__c", "left_semi").dropDuplicates(["__c"]), "op2-grams")
    # a node links only if threshold of its k-mers occur in some other node at all
    kmers = grams.select("__c", F.size("__g").alias("__m"), F.explode("__g").alias("__g"))
    often = kmers.groupBy("__g").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("__g")
    # and only with a node of m k-mers, m at most __hi: the chain is no longer than those k-mers
    able = (kmers.join(often, "__g").groupBy("__c").agg(F.count(F.lit(1)).alias("__n"), F.first("__m").alias("__m"))
            .select("__c", "__m", (F.col("__n") * ((1 + threshold) / threshold) - F.col("__m") + 1e-6).alias("__hi"))
            .where(F.col("__hi") >= threshold * F.col("__m")))
    able = able.join(grams.select("__c", "__sig"), "__c")
    members = _open(members.join(able, "__c").withColumn("__l", F.col("__c")), "op2-able")
    if members.isEmpty():
        return None
    links, tested, classes, centres = None, None, None, 1
    while True:
        if centres == 1:
            top = members.groupBy("__k").agg(F.max(F.struct("__s", "__c", "__m", "__hi", "__sig")).alias("__top")).select("__k", "__top.*")
            members = members.withColumn("__z", F.lit(1).cast("long"))
            chosen = top.withColumn("__l", F.col("__c"))
        else:
            # first nodes that share most keys, then nodes of the smallest classes
            order = [F.col("__s").desc()] if centres <= FORMING else [F.col("__z"), F.col("__s").desc()]
            w = Window.partitionBy("__k").orderBy(*order, F.col("__c").desc())
            chosen = members.withColumn("__i", F.row_number().over(w)).where(F.col("__i") <= centres)
        chosen = cut_lineage(chosen.select("__k", F.struct(F.col("__c").alias("b"), F.col("__l").alias("l"), F.col("__m").alias("m"),
                                                           F.col("__hi").alias("hi"), F.col("__sig").alias("sig")).alias("__b")), "op2-centres")
        # Texts that are in one class already, or whose k-mers cannot reach the threshold, need no
        # comparison. A bucket's centres (at most STEP) travel as one list, a node's lists are merged:
        # a pair that shares many buckets is one row.
        lists = members.join(chosen.groupBy("__k").agg(F.collect_list("__b").alias("__bs")), "__k").select("__c", F.transform(F.filter(
            "__bs", lambda x: (x["l"] != F.col("__l")) & (F.col("__m") <= x["hi"]) & (x["m"] <= F.col("__hi")) & _alike(x["sig"], threshold)),
            lambda x: x["b"]).alias("__bs"))
        met = lists.where(F.size("__bs") > 0).groupBy("__c").agg(F.array_distinct(F.flatten(F.collect_list("__bs"))).alias("__bs"))
        pairs = (met.select("__c", F.explode("__bs").alias("__b"))
                 .select(F.least("__c", "__b").alias("__a"), F.greatest("__c", "__b").alias("__b")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["__a", "__b"], "left_anti")
        ga, gb = grams.select(F.col("__c").alias("__a"), F.col("__g").alias("__ga")), grams.select(F.col("__c").alias("__b"), F.col("__g").alias("__gb"))
        done = cut_lineage(pairs.join(ga, "__a").join(gb, "__b").mapInArrow(
            _verify(threshold), "__a binary, __b binary, __ok boolean"), "op2-verified")
        found = done.where("__ok").select("__a", "__b")
        if classes is None or not found.isEmpty():
            links = found if links is None else cut_lineage(links.unionByName(found), "op2-links")
            classes = _classes(links)
        tested = done.select("__a", "__b") if tested is None else cut_lineage(tested.unionByName(done.select("__a", "__b")), "op2-tested")
        # a centre has met all its bucket and leaves it
        left = (members.drop("__l", "__z").join(chosen.select("__k", F.col("__b.b").alias("__c")), ["__k", "__c"], "left_anti")
                .join(classes, "__c", "left")
                .withColumns({"__l": F.coalesce("__l", "__c"), "__z": F.coalesce("__z", F.lit(1).cast("long"))}))
        members = _open(left, "op2-left")
        if members.isEmpty():
            return links, classes
        centres = min(centres * 16, STEP)


def _alike(other, threshold: float):
    """Whether a signature and ``__sig`` fit the threshold."""
    differing = F.aggregate(F.zip_with(other, "__sig", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, x: n + x)
    return differing <= allowed_bits(threshold)


def _open(members: DataFrame, tag: str) -> DataFrame:
    """``members`` without buckets of one class and without nodes that can
    reach the threshold with no size in their bucket."""
    members = cut_lineage(members, tag)
    per = (members.groupBy("__k").agg(F.min("__l").alias("__l0"), F.max("__l").alias("__l1"),
                                      F.min("__m").alias("__m0"), F.max("__hi").alias("__h1"))
           .where(F.col("__l0") != F.col("__l1")).select("__k", "__m0", "__h1"))
    kept = members.join(per, "__k").where((F.col("__m0") <= F.col("__hi")) & (F.col("__m") <= F.col("__h1")))
    return cut_lineage(kept.drop("__m0", "__h1"), tag)


def _classes(links: DataFrame) -> DataFrame:
    """Rows (``__c``, class ``__l``, its size ``__z``) of linked nodes."""
    found = components(links)
    return cut_lineage(found.join(found.groupBy("__l").agg(F.count(F.lit(1)).alias("__z")), "__l"), "op2-sizes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``class_id`` (smallest id of the class), ``n_links``
    (links verified on the way from the row's text to different texts), ``text_key``
    (digest of the word sequence, null without words) and ``class_key`` (smallest
    ``text_key`` of the class: ids may repeat or be null, it tells classes apart)."""
    texts = docs.select(F.col(id_col).alias("__d"), F.col(text_col).alias("__t"))
    kind = texts.schema["__d"].dataType
    schema = T.StructType([T.StructField("__d", kind), T.StructField("__c", T.BinaryType()),
                           T.StructField("__keys", T.ArrayType(T.LongType()))])
    sketched = cut_lineage(texts.mapInArrow(_sketch_batches, schema), "op2-sketch")
    nodes = cut_lineage(sketched.where(F.col("__c").isNotNull()).groupBy("__c").agg(
        F.min("__d").alias("__rep"), F.any_value("__keys").alias("__keys")), "op2-nodes")
    found = _links(nodes, texts, threshold)
    per = nodes.select("__c", "__rep")
    if found is None:
        per = per.select("__c", F.col("__rep").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("__c").alias("class_key"))
    else:
        links, classes = found
        degree = (links.select(F.explode(F.array("__a", "__b")).alias("__c"))
                  .groupBy("__c").agg(F.count(F.lit(1)).alias("n_links")))
        lab = classes.select("__c", "__l").join(per, "__c")
        first = lab.groupBy("__l").agg(F.min("__rep").alias("__min"))
        lab = lab.join(first, "__l").select("__c", "__l", "__min")
        per = (per.join(lab, "__c", "left").join(degree, "__c", "left")
               .select("__c", F.coalesce("__min", "__rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                       F.coalesce("__l", "__c").alias("class_key")))
    per = cut_lineage(per, "op2-classes")
    rows = sketched.select("__d", "__c")
    return rows.join(per, "__c", "left").select(
        F.col("__d").alias(id_col), F.when(F.col("__c").isNull(), F.col("__d")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("__c").alias("text_key"), "class_key")


@F.arrow_udf(T.BinaryType())
def _text_key(texts: pa.Array) -> pa.Array:
    batch, keys = pa.RecordBatch.from_arrays([texts], ["__t"]), []
    for _, _, data, off in tk.pieces(batch, "__t"):
        count, one, two, _, _ = _kmers(data, off)
        keys.append(_digests(one, two, count > 0))
    return pa.concat_arrays(keys) if keys else pa.array([], pa.binary())


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with one row left of each class: the smallest id (null last),
    then the smallest ``text_key``, then the smallest text. Rows whose text has
    no words all stay."""
    found = near_duplicates(docs, id_col, text_col, **params).where(F.col("text_key").isNotNull())
    per = cut_lineage(found.groupBy(F.col(id_col).alias("__id"), F.col("text_key").alias("__key")).agg(
        F.any_value("class_key").alias("__class"), F.count(F.lit(1)).alias("__n")), "op2-per-id")
    # ids may be null or repeated: a row is decided on by its id and text together
    first = F.min(F.struct(F.col("__id").isNull().alias("__null"), "__id", "__key", "__n"))
    kept = cut_lineage(per.groupBy("__class").agg(first.alias("__x")).select("__x.__id", "__x.__key", "__x.__n"), "op2-kept")
    keyed = docs.withColumn("__text_key", _text_key(text_col))
    mine = keyed[id_col].eqNullSafe(kept["__id"]) & (keyed["__text_key"] == kept["__key"])
    left = (keyed.join(kept.hint("shuffle_hash"), mine, "left")
            .where(F.col("__text_key").isNull() | F.col("__n").isNotNull()).drop("__id", "__key"))
    if kept.where(F.col("__n") > 1).isEmpty():
        return left.select(docs.columns)
    left = cut_lineage(left, "op2-kept-rows")
    again = (left.where(F.col("__n") > 1).groupBy(id_col, "__text_key")
             .agg(F.min_by(F.struct(*docs.columns), text_col).alias("__row")).select("__row.*"))
    return left.where(F.col("__n").isNull() | (F.col("__n") == 1)).select(docs.columns).unionByName(again)
