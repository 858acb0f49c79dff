"""Row numbers over a whole table or over groups of any size.

``row_number`` without partitions pulls every row into one task, and with them
it pulls each group into one.  Here the rows are range-sorted instead, every
sorted run numbers itself, and only the run lengths (one row per shuffle
partition) are summed up to turn those numbers into global ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.operators.joins import dimension_join
from feedmill.session import materialise

# monotonically_increasing_id: partition in the upper bits, row in the lower 33.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 0-based position of each row in ``order``, which must be total.

    The sorted rows are written once: run lengths and row numbers have to come
    from the same sort, also after a lost executor.
    """
    numbered = materialise(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_run", F.shiftright("_row", _ROW_BITS))
    lengths = numbered.groupBy("_run").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select("_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    position = F.col("_start") + F.col("_row").bitwiseAND(F.lit(_ROW_MASK))
    # One row per shuffle partition, so the broadcast does not grow with the data.
    return numbered.join(F.broadcast(starts), "_run").select(*df.columns, position.alias(name))


def grouped_rank(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rank"
) -> DataFrame:
    """Add the 0-based position of each row within its group (groups not NULL)."""
    ranked = global_rank(df, [F.col(g) for g in groups] + list(order), "_at")
    firsts = ranked.groupBy(*groups).agg(F.min("_at").alias("_first"))
    return (
        dimension_join(ranked, firsts, list(groups))
        .withColumn(name, F.col("_at") - F.col("_first"))
        .select(*df.columns, name)
    )


def top_per_key(df: DataFrame, key: str, order: Sequence[Column], k: int, name: str) -> DataFrame:
    """First ``k`` rows of each key with their 0-based position.

    Spark keeps only ``k`` rows per key in each map task before it shuffles,
    so a hot key sends a bounded number of rows to its task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn(name, F.row_number().over(window))
        .where(F.col(name) <= k)
        .withColumn(name, F.col(name) - 1)
    )
