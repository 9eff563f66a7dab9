"""One query per operator over the driver tables, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from . import (
    chat, dac, decontaminate, hilbert, language_model, line_rules, mil, mixing, phrases, private_data, repeats, runs, simhash,
)
from .common import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]


@query()
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query(
    mixing.MIX_SQL.format(docs="documents")
    + "SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed"
)
def op2_mix_to_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(line_rules.RULES_SQL)
def op3_line_frequency_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judged(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("doc_id", "rules.*").drop("removed_words")


@query()
def op4_contextual_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.digest(private_data.personal_data(table(spark, sf_dir, "documents")))


@query(repeats.REPEATS_SQL)
def op5_de_bruijn_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), window=20)


@query()
def op6_spaced_seed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that share a verified overlap."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    sharded = hilbert.curve_shards(
        rows, texts=["source", "lang"], numbers=["size"], ties=["doc_id", "size", "text_crc32"], shards=16
    )
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op8_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = mil.fit(docs, table(spark, sf_dir, "labels"))
    return mil.score(docs, model).select("doc_id", "held_out", "score", "predicted")


@query()
def op9_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    dac.write_tokens(table(spark, sf_dir, "documents"), path)
    return dac.read_digests(spark, path)


@query()
def op10_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = language_model.score_texts(table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query(runs.RUNS_SQL)
def op11_maximal_pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return runs.digests(runs.periodic_runs(planted, carry=["doc_id"]))


@query(phrases.PHRASES_SQL)
def op12_misra_gries_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query(chat.CHATS_SQL)
def op13_chat_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    path = new_path(spark, "chats")
    chat.write_chats(turns.unionByName(probe), path)
    return chat.digests(chat.read_chats(spark, path)).withColumnRenamed("conv", "conv_id")
