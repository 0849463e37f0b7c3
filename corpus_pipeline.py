"""A corpus from raw documents: quality filter, line dedup, near-duplicate removal, decontamination, mixing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the next
one's documents. All but the last return the columns of documents.

* quality: documents that the classifier rejects go; it learns from the labels beside the documents.
* line_dedup: boilerplate lines are removed from the texts, no document goes.
* near_dedup: one document of each group of near duplicates stays; they link by SimHash fingerprints of four-word shingles that
  differ in 4 bits or less.
* decontaminate: documents that hold a window of a benchmark item go.
* mix: how many words of each document the mix takes.

Documents with a null in any column take part: a null text counts as empty, a null id never is the smallest of a group, a
null source is a source of its own. Documents without words are copies of each other, so one of them stays. Repeated rows are
exact copies. Texts are scanned whole, however long. Further columns are kept up to the mix, whatever their names. An empty
table gives an empty result, as long as the labels hold both classes for the quality classifier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.llm import decontaminate, linededup, mixing, quality, simhash
from shoptrail.llm.columns import all_of
from shoptrail.runtime import stored


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = linededup.deduplicated(docs)
    if "n_chars" not in docs.columns:
        return clean
    n_chars = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")
    return clean.withColumn("n_chars", n_chars).select(*all_of(docs))


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.query(docs)


STAGES = [
    ("quality", _quality),
    ("line_dedup", _line_dedup),
    ("near_dedup", _near_dedup),
    ("decontaminate", _decontaminate),
    ("mix", _mix),
]

#: The classifier and the seeded mix are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
