"""From raw documents to packed training sequences.

Each stage takes all rows that the stage before it kept, written as Parquet and read again.  All but
the last return the columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ridegauge.llm import minhash, packing, pii, rules, toxicity
from ridegauge.llm.common import table
from ridegauge.llm.queries import registered
from ridegauge.session import written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain takes for toxic go."""
    return toxicity.without_toxic(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def junk_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or the learned decision list go."""
    return rules.without_junk(docs, rules.learned(docs, table(spark, sf_dir, "labels")))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.without_near_copies(docs, words=5, similarity=0.8)


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind."""
    spans = written(pii.detected(docs.select("text")).select("pii"), "pii")
    return pii.masked(docs, pii.fitted(spans))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("toxicity", toxic_out),
    ("quality_rules", junk_out),
    ("minhash_near_dedup", near_copies_out),
    ("pii", personal_data_masked),
    ("pattern_packing", sequences),
]

# The stages hold trained models, which SQL cannot express.
ORACLE_SQL = None


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registered(_run)(spark, sf_dir)
