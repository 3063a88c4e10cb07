"""From raw documents to packed sequences: quality, line dedup, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
`docs`. All but the last return the columns of `documents`: doc_id, text, lang, source, n_chars. A null text counts as
empty throughout; rows that repeat are documents of their own until the near-duplicate stage; an empty table stays empty;
columns beyond those five are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reqloom.llm import line_dedup, mixing, near_dedup, packing, quality
from reqloom.llm.queries import quality_weights
from reqloom.operators.staging import new_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at its threshold or above; the texts do not change."""
    docs = docs.select(*COLUMNS)
    return quality.keep_good(docs, quality_weights(spark, docs, sf_dir))


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines found in ten documents or more; n_chars follows the text."""
    kept = line_dedup.drop_common_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup.keep_one(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each run of words that the mix draws from a document, in the documents' columns."""
    docs = docs.select(*COLUMNS)
    draws, _ = mixing.mix(docs)
    return mixing.texts(docs, draws).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the drawn texts and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("line dedup", without_common_lines),
    ("near duplicates", one_of_each_class),
    ("mixing", mixed),
    ("packing", packed),
]

#: Trained weights, signatures and seeded draws have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        path = new_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
