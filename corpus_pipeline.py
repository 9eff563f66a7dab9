"""The corpus pipeline: rules, near duplicates, decontamination, mixing, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import dac, decontaminate, line_rules, mixing, simhash
from recordloom.llm.common import table
from recordloom.session import new_path, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that many documents of a source share."""
    return line_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the least id."""
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token file says of every document of the mix."""
    path = new_path(spark, "tokens")
    dac.write_tokens(docs, path)
    return dac.read_digests(spark, path)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token ids", token_ids),
]

#: SimHash groups, spaced seeds and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
