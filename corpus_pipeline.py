"""From raw documents to packed training sequences; the folder tallyroom/llm holds the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm import exact_dedup, jaccard_join, packing, quality, source_mix
from tallyroom.llm.stages import run_stages


# Every stage: a null text is read as empty, repeated rows are documents of their own, an empty table
# gives an empty result, and further columns of any name come through as they are. Ids may be null
# or repeated: no stage takes or drops rows by their ids. Texts are kept whole.


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold stay; an empty text has a score like any other."""
    return quality.accepted(docs, quality.learned(spark, docs, sf_dir))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest id of every group of equal texts stays, one of rows that tie.

    Null and empty texts are equal to each other; an id wins against none.
    """
    return exact_dedup.dedup(docs, keep="max")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of every component of linked documents stays.

    Texts without words, and rows without an id, are linked with nothing and stay.
    """
    return jaccard_join.one_of_each(docs, stored=True)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every use of a document in the mix, its text whole.

    A null source is a source of its own. Texts without words add nothing to a mix and go.
    """
    mixed = source_mix.mixed_documents(docs, stored=True)
    return mixed.withColumn("n_chars", F.char_length("text").cast("bigint"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their ids; a document's end is an id of its own."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("source_mix", source_mixing),
    ("packing", sequence_packing),
]

# A learned score and the ids of a tokenizer cannot be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stages(spark, sf_dir, STAGES)
