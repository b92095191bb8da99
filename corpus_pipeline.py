"""From raw documents to packed training sequences, in five stages.

Each stage is one of the ``fleetlens.llm`` operators with its production parameters. It takes
(spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes every stage's result to the shared folder and reads it again as
the next one's input, so a lost executor never repeats more than the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm import packing, pii_weak, quality_rules, simhash_gph, toxicity_knn
from fleetlens.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the examples' labels are the corpus's own."""
    return toxicity_knn.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy rejects go."""
    return quality_rules.filter_documents(docs, quality_rules.POLICIES[quality_rules.CURRENT])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked fingerprints the document with the smallest id stays."""
    return simhash_gph.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets."""
    return pii_weak.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("simhash_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# Votes of learnt models, hashes and tokenizers have no SQL form; tests/llm/test_pipeline.py
# holds every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
