"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes `(spark, docs, sf_dir)`, works on all that its predecessor kept and is
written before the next one reads it. All but the last return the columns of `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm.common import keep, table
from rowtide.llm.exact_dedup import drop_copies
from rowtide.llm.mixing import mixed_documents
from rowtide.llm.near_dedup import drop_near
from rowtide.llm.packing import pack, public_codec
from rowtide.llm.toxicity import drop_toxic

# Several stages are no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the restored text shows to be toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the document with the smallest id stays."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, that with the smallest id stays."""
    return drop_near(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences."""
    return pack(docs, public_codec(), with_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("source mix", source_mix),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; all but the last are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
