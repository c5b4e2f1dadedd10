"""From documents to training sequences, in stages that each write a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterbill.llm import mixing, packing, secrets, simhash, toxicity
from quarterbill.llm.common import ship, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model that learns from the labels of `sf_dir`."""
    ship(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: shingles of three words, at most three bits apart."""
    ship(spark)
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    ship(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last copy of a source may be cut."""
    ship(spark)
    return mixing.mixed(docs, weights=(5, 2, 1), budget=1.5, cap=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, with their token ids."""
    ship(spark)
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Stages 1 and 5 have no SQL form; tests/llm/test_registered.py holds run() against brute force
#: on a small table, where the labels stand for the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
