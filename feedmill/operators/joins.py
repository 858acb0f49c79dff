"""Joins of a large, possibly skewed side with a dictionary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.session import materialise

#: A key is hot when it holds more than this share of the facts.
HOT_SHARE = 0.005
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20
#: Bins that the facts of all keys are counted in first.
HOT_BINS = 4096
#: Rows that a counted row is repeated to at once.
RUN_ROWS = 10_000


def _width(field: T.StructField) -> Column:
    """Bytes of a value: of text as it is, of arrays of numbers by their length, of other values 16."""
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        return F.greatest(F.size(column), F.lit(0)).cast("bigint") * 8
    if isinstance(kind, T.ArrayType | T.MapType | T.StructType):
        return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)).cast("bigint")
    return F.lit(16).cast("bigint")


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure a dictionary; one aggregate row comes back."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(0).cast("bigint"))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def hot_keys(facts: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame | None:
    """Keys that hold more than ``share`` of the facts: at most 1 / share of them.  None where there are none.

    Facts are counted by a hash of the key first, which moves a few rows for each task.  A hot key makes its bin hot,
    so only the facts in hot bins are counted by key.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(HOT_BINS))
    bins = facts.groupBy(place.alias("_bin")).agg(F.count(F.lit(1)).alias("_n")).collect()
    least = max(1.0, share * sum(r["_n"] for r in bins))
    hot = [r["_bin"] for r in bins if r["_n"] > least]
    if not hot:
        return None
    counts = facts.where(place.isin(hot)).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    found = materialise(counts.where(F.col("_n") > F.lit(least)).select(*on, F.lit(True).alias("_hot")))
    return None if found.isEmpty() else found


def runs_of(counted: DataFrame, n: str, run: int = RUN_ROWS) -> DataFrame:
    """The rows with their number ``n`` split into runs of at most ``run``; any 64-bit number can be split.

    A row becomes blocks of ``run`` times ``run`` first, so that no array grows with the number.
    """
    one = F.lit(1).cast("bigint")

    def cut(df: DataFrame, of: int) -> DataFrame:
        whole = F.call_function("div", F.col(n) - 1, F.lit(of)) + 1
        at = F.explode(F.sequence(one * 0, whole - 1)).alias("_at")
        rows = df.where(F.col(n) > 0).select("*", at)
        return rows.withColumn(n, F.least(F.col(n) - F.col("_at") * of, F.lit(of).cast("bigint"))).drop("_at")

    return cut(cut(counted, run * run), run)


def repeated(counted: DataFrame, n: str, run: int = RUN_ROWS) -> DataFrame:
    """Every row as often as its number ``n`` says, without that column.

    The number is split into runs and the runs are dealt over all shuffle partitions before they are repeated,
    so a row that stands for any part of the table leaves no task with much more than its share.
    """
    spark = counted.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The number of partitions is given, as runs are too few bytes for adaptive execution to leave them apart.
    numbered = runs_of(counted, n, run).withColumn("_run", F.monotonically_increasing_id())
    dealt = numbered.repartition(tasks, "_run")
    rows = dealt.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n))))
    return rows.drop("_row", "_run", n)


def dimension_join(
    facts: DataFrame,
    dictionary: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = 64,
) -> DataFrame:
    """Join facts, where one key may hold a large share, with a dictionary.

    A dictionary measured to be small is broadcast and the facts stay where they are.
    A larger one is joined by key; only keys counted as hot are salted too, and only
    their dictionary rows are copied.  The salt is a hash of the row, so a retried task
    gives the same one.  Facts that hold nothing but the key are counted, joined once
    and repeated, in runs dealt over all tasks.

    Beyond the bound both sides are merged by key, so neither goes through the driver: Spark
    tells a side's size by its files, and rows of exploded lists are far more than these.
    """
    on = list(on)
    if how not in ("inner", "left_semi", "left_anti", "left"):
        raise ValueError(f"the dictionary is the replicated side, {how} would repeat it")
    if fits_broadcast(dictionary, max_rows):
        return facts.join(F.broadcast(dictionary), on, how)
    if set(facts.columns) == set(on):
        counted = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
        return repeated(counted.join(dictionary.hint("merge"), on, how), "_n")
    hot = hot_keys(facts, on)
    if hot is None:
        return facts.join(dictionary.hint("merge"), on, how)
    hot = F.broadcast(hot)  # at most 1 / HOT_SHARE rows
    place = F.pmod(F.xxhash64(*facts.columns), F.lit(salts))
    marked = facts.join(hot, on, "left")
    salted = marked.withColumn("_salt", F.when(F.col("_hot"), place).otherwise(F.lit(0).cast("bigint"))).drop("_hot")
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    one = F.array(F.lit(0).cast("bigint"))
    copies = dictionary.join(hot, on, "left").withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(one)))
    return salted.join(copies.drop("_hot").hint("merge"), on + ["_salt"], how).drop("_salt")


def restrict(facts: DataFrame, keys: DataFrame, on: Sequence[str], max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Facts whose key is among ``keys``, repeated or not, when the different ones are few enough to share.

    A reduction ahead of a shuffle, never a filter the result depends on: with
    too many keys the facts pass unchanged.  Their number is estimated first, as
    that moves no keys; only what may fit is made distinct and measured.
    """
    about = keys.agg(F.approx_count_distinct(F.struct(*on))).first()[0]
    if about > 1.2 * max_rows:
        return facts
    keys = keys.select(*on).distinct()
    if fits_broadcast(keys, max_rows):
        return facts.join(F.broadcast(keys), list(on), "left_semi")
    return facts
