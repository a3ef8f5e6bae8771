"""Registered queries of the operators: each applies one operator with its
production parameters to its whole table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lang_id, lm_score, quality
from .centroids import cluster
from .chat_format import format_chats, read_target, read_turns
from .common import read
from .decontam import decontaminate
from .line_dedup import line_dedup
from .mixing import mix
from .near_dup import near_duplicates
from .repair import repair
from .secrets import new_ledger, secret_scan
from .suffix_dedup import dedup_substrings
from .topk import top_k


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "n_links")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    got = decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    got = secret_scan(docs, new_ledger(spark))
    return got.select("doc_id", "n_assign", "n_access", "n_hex",
                      F.sha2("base", 256).alias("base_sha256"), "spans")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_id.fit(docs, "doc_id", "text", "lang", ~F.coalesce(held_out, F.lit(False)))
    got = lang_id.identify(docs.select("doc_id", "text"), model)
    return got.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).drop("kept")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.rate(docs, model).drop("text")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm_score.fit(docs, "text", held, other_pairs=True)
    if model is None:
        return docs.select("doc_id", F.lit(False).alias("held_out"), *[F.lit(0).cast("long").alias(c) for c in ("n_tokens", "n_known", "train_tokens")],
                           F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    return lm_score.score(docs, model, "doc_id", "text", held).drop("perplexity")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("__i") % 50 == 0)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    harmed = given.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), harm.alias("harm")).where("harm <> 0")
    harmed = harmed.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("harm") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
    return repair(harmed, given)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = cluster(read(spark, sf_dir, "embeddings"))
    return got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    made = format_chats(chats)
    # everything below is read back from the formatted examples
    read_back = made.select("conv_id", "example", "n_turns", "formatted", F.when(
        F.col("trainable"), read_target(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))).alias("target"))
    whole = read_back.groupBy("conv_id").agg(
        F.max_by("formatted", "n_turns").alias("last"), F.sort_array(F.collect_list(F.struct("example", "target"))).alias("targets"),
        F.sum(F.length("formatted")).alias("formatted_chars"))
    turns = F.transform(read_turns(F.col("last")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("targets", lambda t: t["target"]), "")
    got = whole.select("conv_id", "formatted_chars", turns.alias("turns"), loss.alias("loss"))
    return got.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


REGISTRY = {f.__name__: f for f in (
    op1_line_dedup, op2_minhash_near_dup, op3_mixing, op4_decontamination, op5_secret_scan,
    op6_language_id, op7_suffix_dedup, op8_quality, op9_lm_score, op10_top_k,
    op11_repair, op12_centroids, op13_chat_format)}
