"""Line dedup by a log-template tree (DataFrame functions only).

A line is cut into tokens; a token that holds a digit is a variable field and
becomes ``<*>``. The tree has a fixed depth: the first level is the number of
tokens, the next ``depth`` levels are the leading tokens, so one hash of
(token count, leading tokens) names the leaf. Within a leaf the template keeps
a token at a position when more than half of the leaf's lines, each weighted by
its documents, have it there and generalises the position to ``<*>`` otherwise; a line belongs to the leaf's
template when at least ``similarity`` of its positions after the leading ones
equal a kept token. A leaf holds several templates: lines that miss it vote
again among themselves, and a group that finds no template is split by its
tokens at one position, that of the most frequent token not common to all, so
that each family is judged by its own weight. This goes on until no group of
several lines has ``min_docs`` documents; a line left over is a template of its
own in its masked form. The vote is order-free: the result does not depend on
how rows arrive.

A template found in ``min_docs`` or more documents recurs: its lines stay in
the document with the smallest id and are dropped from all others.

Shape of the job: only digests of lines (16 bytes) are shuffled; tokens are
exploded just for leaves that hold several different lines and enough
documents. Document texts meet the drop lists in one join on the id, rows
without an id on a hash of their text too, so that many of them are neither one
task nor one long list. Hot lines are pre-aggregated map-side.

Defined cases: null text stays null and has no line; an empty text or line is
never dropped; lines under ``min_tokens`` tokens are never dropped; rows with
the same id are one document (null is one id, ordered last); rows that repeat an
id share its drop list; repeated rows are all kept, with the same decisions;
extra columns pass through, but for ``n_lines`` and ``n_dropped``, which the
results replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small
from ..session import cut_lineage
from .common import BROADCAST_BYTES

DEPTH, MIN_TOKENS, MIN_DOCS, SIMILARITY = 3, 4, 5, 0.6
LONG_TOKENS, LONG_DOCS = 20, 2
# a whole token with a digit; each token is read once (no step back)
_FIELD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"


def masked(line: Column) -> Column:
    """The line with single blanks and ``<*>`` for tokens that hold a digit.
    Most lines need neither change; the guards spare them the rewriting."""
    blanks = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    flat = F.when(blanks | line.rlike(r"[\x09-\x0D]"), F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)
    return F.when(blanks | line.rlike(r"[0-9\x09-\x0D]"), F.regexp_replace(flat, _FIELD, "<*>")).otherwise(line)


def _digest(c: Column) -> Column:
    return F.unhex(F.md5(c))


def _text_key(id_: Column, text: Column) -> Column:
    """Tells rows without an id apart; 0 for all others."""
    return F.when(id_.isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("__d"), _text_key(F.col(id_col), F.col(text_col)).alias("__x"), F.col(text_col).alias("__t"))


def _documents() -> Column:
    """Documents among rows of one line, one row an id and text key."""
    return F.count("__d") + F.max(F.col("__d").isNull().cast("long"))


def _lines(src: DataFrame, min_tokens: int) -> DataFrame:
    """Rows (``__d``, ``__x``, position ``__p``, masked line ``__m``, tokens
    ``__n``); masking inside the generated array runs once for each line."""
    m = src.select("__d", "__x", F.posexplode(F.transform(F.split("__t", "\n"), masked)).alias("__p", "__m"))
    n = F.length("__m") - F.length(F.replace(F.col("__m"), F.lit(" "), F.lit(""))) + 1
    return m.select("__d", "__x", "__p", "__m", n.alias("__n")).where(F.col("__n") >= min_tokens)


def _leaf(depth: int) -> Column:
    return F.concat_ws(" ", F.col("__n").cast("string"), F.substring_index("__m", " ", depth))


def _templates(words: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """Rows (``__k`` line, ``__tpl``): the lines of a leaf's templates. A leaf
    is one group at first; lines that miss their group's template are grouped
    anew until no group with several lines has enough documents."""
    words = words.withColumnRenamed("__leaf", "__tpl")
    found = None
    while True:
        # a token that more than half of the group's lines (weighted by documents) have at a position
        weight = cut_lineage(words.groupBy("__tpl", "__p", "__w").agg(F.sum("__docs").alias("__v"), F.first("__sum").alias("__sum")), "op1-weight")
        votes = weight.where(F.col("__v") * 2 > F.col("__sum")).select("__tpl", "__p", "__w", F.lit(1).alias("__hit"))
        scored = cut_lineage(
            words.join(votes, ["__tpl", "__p", "__w"], "left").groupBy("__tpl", "__k")
            .agg(F.avg(F.coalesce("__hit", F.lit(0))).alias("__sim"), F.first("__docs").alias("__docs"), F.first("__sum").alias("__sum")), "op1-scored")
        hits = scored.where(F.col("__sim") >= similarity).select("__k", "__tpl")
        found = hits if found is None else found.unionByName(hits)
        missed = scored.where(F.col("__sim") < similarity)
        again = (missed.groupBy("__tpl").agg(F.sum("__docs").alias("__left"), F.count(F.lit(1)).alias("__lines"), F.first("__sum").alias("__sum"))
                 .where((F.col("__lines") > 1) & (F.col("__left") >= min_docs))
                 .select("__tpl", (F.col("__left") == F.col("__sum")).alias("__split")))
        # a group without a template is split by its tokens at the position of the most frequent one that not all lines have
        at = (weight.where(F.col("__v") < F.col("__sum")).groupBy("__tpl")
              .agg(F.max(F.struct("__v", -F.col("__p"))).alias("__top")).select("__tpl", (-F.col("__top.col2")).alias("__at")))
        again = again.join(at, "__tpl")
        lines = missed.select("__tpl", "__k").join(again, "__tpl")
        by = (words.join(lines, ["__tpl", "__k"]).where(F.col("__p") == F.col("__at"))
              .select("__k", "__tpl", "__docs", _digest(F.concat_ws(" ", F.hex("__tpl"), F.when(F.col("__split"), F.concat_ws(
                  " ", F.col("__at").cast("string"), F.col("__w"))))).alias("__new")))
        total = by.groupBy("__new").agg(F.sum("__docs").alias("__sum"), F.count(F.lit(1)).alias("__lines"))
        total = total.where((F.col("__lines") > 1) & (F.col("__sum") >= min_docs)).drop("__lines")
        moved = by.select("__tpl", "__k", "__new").join(total, "__new")
        words = cut_lineage(words.drop("__sum").join(moved, ["__tpl", "__k"]).drop("__tpl")
                            .withColumnRenamed("__new", "__tpl"), "op1-words")
        if words.isEmpty():
            return found


def line_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   depth: int = DEPTH, min_tokens: int = MIN_TOKENS,
                   min_docs: int = MIN_DOCS, similarity: float = SIMILARITY) -> DataFrame:
    """Lines to drop: rows (``__d`` document id, ``__x`` text key of a row without
    id, ``__k`` digest of the masked line), each once."""
    if not 0 < depth < min_tokens:
        raise ValueError("min_tokens must exceed depth, depth must be positive")
    src = _source(docs, id_col, text_col)
    occ = cut_lineage(
        _lines(src, min_tokens)
        .select("__d", "__x", "__p", _digest(_leaf(depth)).alias("__leaf"), _digest(F.col("__m")).alias("__k"))
        .groupBy("__d", "__x", "__leaf", "__k").agg(F.min("__p").alias("__p")), "op1-lines")
    # where: one place to read a line's text from again, in a row with an id if there is one
    per_line = cut_lineage(occ.groupBy("__leaf", "__k").agg(
        _documents().alias("__docs"), F.min(F.struct(F.col("__d").isNull().alias("__no"), "__d", "__x", "__p")).alias("__where")), "op1-distinct")
    # leaves with several lines and enough documents to recur
    contested = (per_line.groupBy("__leaf").agg(F.sum("__docs").alias("__sum"), F.count(F.lit(1)).alias("__lines"))
                 .where((F.col("__lines") > 1) & (F.col("__sum") >= min_docs)).select("__leaf", "__sum"))
    asked = cut_lineage(per_line.join(contested, "__leaf").select(
        "__leaf", "__sum", "__k", "__docs", F.col("__where.__d").alias("__id"),
        F.col("__where.__x").alias("__ix"), F.col("__where.__p").alias("__p")), "op1-asked")
    places = cut_lineage(asked.groupBy("__id", "__ix").agg(F.concat_ws(",", F.collect_set("__p")).alias("__ps")), "op1-places")
    there = join_small(src, places, src["__d"].eqNullSafe(places["__id"]) & (src["__x"] == places["__ix"]), "inner", BROADCAST_BYTES)
    wanted = F.transform(F.split("__ps", ","), lambda p: F.get(F.split("__t", "\n"), p.cast("int")))
    lines = (there.select(F.explode(wanted).alias("__l")).where(F.col("__l").isNotNull())
             .select(masked(F.col("__l")).alias("__m")).distinct()
             .select(_digest(F.col("__m")).alias("__k"), F.split("__m", " ").alias("__ws")))
    words = cut_lineage(
        lines.join(asked.select("__leaf", "__sum", "__k", "__docs"), "__k")
        .select("__leaf", "__sum", "__k", "__docs", F.posexplode("__ws").alias("__p", "__w"))
        .where(F.col("__p") >= depth), "op1-words")
    member = _templates(words, min_docs, similarity)
    # a leaf digest and a line digest never meet: the leaf's text starts with a count
    member = cut_lineage(member, "op1-member")
    tagged = (join_small(occ.select("__d", "__x", "__k"), member, "__k", "left", BROADCAST_BYTES)
              .withColumn("__tpl", F.coalesce("__tpl", "__k")))
    recurring = cut_lineage(
        tagged.select("__d", "__tpl").distinct()
        .groupBy("__tpl").agg(F.count(F.lit(1)).alias("__docs"), F.min("__d").alias("__first"))
        .where(F.col("__docs") >= min_docs).select("__tpl", "__first"), "op1-recurring")
    return (join_small(tagged, recurring, "__tpl", "inner", BROADCAST_BYTES)
            .where(F.col("__d").isNull() | (F.col("__d") != F.col("__first")))
            .select("__d", "__x", "__k"))


def long_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               min_tokens: int = LONG_TOKENS, min_docs: int = LONG_DOCS) -> DataFrame:
    """Rows (``__d``, ``__x``, ``__k``) as ``line_templates`` has them: masked lines of at
    least ``min_tokens`` tokens that ``min_docs`` or more documents share."""
    src = _source(docs, id_col, text_col)
    occ = cut_lineage(_lines(src, min_tokens).select("__d", "__x", _digest(F.col("__m")).alias("__k")).distinct(), "op1-long")
    recurring = cut_lineage(occ.groupBy("__k").agg(_documents().alias("__docs"), F.min("__d").alias("__first"))
                            .where(F.col("__docs") >= min_docs).select("__k", "__first"), "op1-long-recurring")
    return (join_small(occ, recurring, "__k", "inner", BROADCAST_BYTES)
            .where(F.col("__d").isNull() | (F.col("__d") != F.col("__first"))).select("__d", "__x", "__k"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with ``text_col`` cleared of recurring lines, plus ``n_lines``
    and ``n_dropped`` (0 for a null text)."""
    return _cleared(docs, line_templates(docs, id_col, text_col, **params), id_col, text_col)


def long_line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``line_dedup`` by the rule of ``long_lines``. A copied passage recurs in
    two documents already; near copies of whole documents should be gone
    before, else they are left as fragments."""
    return _cleared(docs, long_lines(docs, id_col, text_col, **params), id_col, text_col)


def _cleared(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str) -> DataFrame:
    lists = cut_lineage(
        drops.groupBy("__d", "__x").agg(F.concat_ws("", F.sort_array(F.collect_set(F.hex("__k")))).alias("__drop"))
        .withColumnsRenamed({"__d": "__id", "__x": "__ix"}), "op1-drops")
    mark = docs.drop("n_lines", "n_dropped").withColumns({"__id": F.col(id_col), "__ix": _text_key(F.col(id_col), F.col(text_col))})
    on = mark["__id"].eqNullSafe(lists["__id"]) & (mark["__ix"] == lists["__ix"])
    # texts meet their lists by a shuffle at every size: the lists grow with the documents
    got = mark.join(lists.hint("shuffle_hash"), on, "left").drop("__id", "__ix")
    size = 32  # hex digits of a digest
    cut = F.filter(F.split(text_col, "\n"), lambda x: ~F.array_contains(
        F.col("__list"), F.upper(F.md5(masked(x)))))
    got = got.withColumn("__list", F.when(F.col("__drop").isNotNull(), F.regexp_extract_all(
        "__drop", F.lit(f"[0-9A-F]{{{size}}}"), F.lit(0))))
    # the kept lines are a column of their own, so that they are worked out once
    got = got.withColumn("__kept", F.when(F.col("__list").isNotNull(), cut))
    lines = lambda c: F.coalesce(F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    return (got.withColumn("n_lines", lines(F.col(text_col)).cast("long"))
            .withColumn("n_dropped", F.when(F.col("__kept").isNotNull(), F.col("n_lines") - F.size("__kept")).otherwise(0).cast("long"))
            .withColumn(text_col, F.when(F.col("__kept").isNotNull(), F.array_join("__kept", "\n")).otherwise(F.col(text_col)))
            .drop("__kept", "__list", "__drop"))
