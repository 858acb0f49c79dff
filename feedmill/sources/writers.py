"""Writers. Parquet is the form between steps, text the form for others."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_tab_text(df: DataFrame, path: str) -> None:
    """One line per row, scalar columns only, nothing quoted."""
    df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])).write.mode(
        "overwrite"
    ).text(path)


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    """One formatted line per row."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_by(df: DataFrame, path: str, *columns: str) -> None:
    """Parquet with one directory per value: kinds of ids, shards of factors.

    Rebalanced by value first: few files per directory, and a value that holds
    much of the data is split over several of them.
    """
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def replace_day(df: DataFrame, path: str, day_column: str = "dt") -> None:
    """Replace the days present in ``df`` and leave the other days alone."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_column)
        .parquet(path)
    )


def save_day_table(df: DataFrame, table: str, day_column: str = "dt") -> None:
    """Append days to a catalogue table partitioned by day, created on first use."""
    df.write.mode("append").partitionBy(day_column).format("parquet").saveAsTable(table)


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_state_day(
    state: DataFrame, table: str, buckets: int, key: str = "uid", day_column: str = "dt"
) -> None:
    """Append a day of state to a table bucketed by user.

    The next merge then reads yesterday's state where it lies and shuffles
    today's lists only; a merged table written back needs no shuffle either,
    each task holding the users of one bucket.
    """
    (
        state.write.mode("append")
        .partitionBy(day_column)
        .bucketBy(buckets, key)
        .format("parquet")
        .saveAsTable(table)
    )
