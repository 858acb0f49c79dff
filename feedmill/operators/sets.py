"""Comparison of two id sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_difference(a: DataFrame, b: DataFrame, column: str = "id") -> DataFrame:
    """Distinct ids of ``a`` that ``b`` lacks."""
    return a.select(column).subtract(b.select(column))


def id_coverage(a: DataFrame, b: DataFrame, column: str = "id") -> DataFrame:
    """One row: both sizes, the size of the intersection, its share of ``b``.

    Both sides are tagged and grouped once instead of being read twice.
    """
    tagged = a.select(column, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(column, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    per_id = tagged.groupBy(column).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    totals = per_id.agg(
        F.coalesce(F.sum("in_a"), F.lit(0)).alias("n_a"),
        F.coalesce(F.sum("in_b"), F.lit(0)).alias("n_b"),
        F.coalesce(F.sum(F.col("in_a") * F.col("in_b")), F.lit(0)).alias("n_both"),
    )
    return totals.withColumn("rate", F.try_divide(F.col("n_both").cast("double"), F.col("n_b")))
