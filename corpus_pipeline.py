"""From raw documents to a training mix, in five stages; each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import decontaminate, jaccard, linededup, mixing, quality
from feedmill.session import materialise, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rejected ones go.  A NULL or empty text is rejected."""
    return quality.keep_good(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier place has; those that lose all their lines go.

    n_chars, where there is such a column, counts the new text.
    """
    left = linededup.dedup_lines(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")]))
    kept = left.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return jaccard.keep_one(docs, width=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make less than 5 % of the words."""
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's rate has them, numbered by ``copy``."""
    return mixing.mix(docs)


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: The quality model is fitted, which SQL cannot express; tests/llm has a brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again; what a stage wrote besides is removed."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch(spark):
            docs = materialise(stage(spark, docs, sf_dir), outlive=1)
    return docs
