"""The candidate table that lives from day to day, and its export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from feedmill.functions.values import filled, strict_int
from feedmill.operators.quality import counted, one_row_per
from feedmill.operators.ranking import grouped_rank

TTL_DAYS = 30


def _fate(new_list: Column, base_list: Column) -> Column:
    """new, update or decrease; NULL when neither side has a list."""
    return (
        F.when(filled(new_list) & filled(base_list), "update")
        .when(filled(new_list), "new")
        .when(filled(base_list), "decrease")
    )


def merge_state(
    new: DataFrame,
    base: DataFrame,
    ttl: int = TTL_DAYS,
    observation: Observation | None = None,
) -> DataFrame:
    """Today's lists replace the base ones, the rest ages by a day and expires.

    Lists stay whole: the rows are joined on the user, never exploded.  A user
    with two rows on one side is an error.  A list that would age but has no
    readable ttl is counted apart; ``merge_state_rejects`` gives its row, and
    ``nameless_rows`` the rows without a user, which have no place in a table by user.
    """
    rows = _merged(new, base, ttl)
    if observation is not None:
        rows = counted(rows, observation, _counters(F.col("fate"), F.col("ttl")))
    return rows.where(F.col("fate").isNotNull() & (F.col("ttl") > 0)).select("uid", "list", "ttl")


def _merged(new: DataFrame, base: DataFrame, ttl: int) -> DataFrame:
    """(uid, fate, list, ttl) of every user of either side.

    Rows without a user are left out ahead of the window and the join, where they would all meet in one task.
    """
    named = F.col("uid").isNotNull()
    today = one_row_per(new.where(named).select("uid", F.col("list").alias("new_list")), "uid")
    before = one_row_per(
        base.where(named).select("uid", F.col("list").alias("base_list"), F.col("ttl").alias("base_ttl")), "uid"
    )
    joined = today.join(before, "uid", "full_outer")
    fate = _fate(F.col("new_list"), F.col("base_list"))
    left = F.col("base_ttl") - 1
    return joined.select(
        "uid",
        fate.alias("fate"),
        F.when(fate == "decrease", F.col("base_list")).otherwise(F.col("new_list")).alias("list"),
        F.when(fate == "decrease", left).otherwise(F.lit(ttl)).cast("int").alias("ttl"),
    )


def merge_state_rejects(new: DataFrame, base: DataFrame) -> DataFrame:
    """(uid, list): base lists without a new one whose ttl cannot be read."""
    rejected = (F.col("fate") == "decrease") & F.col("ttl").isNull()
    return _merged(new, base, TTL_DAYS).where(rejected).select("uid", "list")


def nameless_rows(new: DataFrame, base: DataFrame) -> DataFrame:
    """(side, list): rows of ``new`` and ``base`` that the merge leaves out as they name no user."""
    sides = [df.where(F.col("uid").isNull()).select(F.lit(side).alias("side"), "list") for side, df in (("new", new), ("base", base))]
    return sides[0].unionByName(sides[1])


def aged(base: DataFrame, days: int) -> DataFrame:
    """The base as if ``days`` more days had passed; what they let expire still counts as removed in the merge."""
    return base.withColumn("ttl", (F.col("ttl") - days).cast("int")) if days else base


def _counters(fate: Column, ttl: Column) -> dict[str, Column]:
    return {
        "uid_num": F.lit(True),
        "new_num": fate == "new",
        "update_num": fate == "update",
        "decrease_num": fate == "decrease",
        "remove_num": (fate == "decrease") & (ttl <= 0),
        "bad_ttl_num": (fate == "decrease") & ttl.isNull(),
    }


def merge_state_counters(new: DataFrame, base: DataFrame) -> DataFrame:
    """The merge's counters alone; only keys and 'has a list' are shuffled.  Repeated users are an error here too."""

    def flags(df: DataFrame) -> DataFrame:
        return df.withColumn("list", F.when(filled(F.col("list")), "x"))

    rows = _merged(flags(new.select("uid", "list")), flags(base.select("uid", "list", "ttl")), TTL_DAYS)
    conditions = _counters(F.col("fate"), F.col("ttl"))
    return rows.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def keyed_payloads(state: DataFrame, parts: int = 8) -> DataFrame:
    """(part, uid as number, payload) of the rows that the store takes."""
    key = strict_int(F.col("uid"), "bigint")
    return (
        state.select(key.alias("key"), F.col("list").alias("payload"))
        .where(F.col("key").isNotNull() & (F.length("payload") > 1))
        .select(F.pmod("key", F.lit(parts)).cast("int").alias("part"), "key", "payload")
    )


def export_plan(state: DataFrame, parts: int = 8) -> DataFrame:
    """Where each key goes: its part and its position in the part's key order."""
    keyed = keyed_payloads(state, parts).select("part", "key")
    return grouped_rank(keyed, ["part"], [F.col("key")], "position")


def export_kv(state: DataFrame, path: str, parts: int = 8) -> None:
    """One directory per part, its files sorted by key and disjoint in key range.

    Range partitioning splits a part over as many files as its size asks for.
    """
    (
        keyed_payloads(state, parts)
        .repartitionByRange("part", "key")
        .sortWithinPartitions("part", "key")
        .write.mode("overwrite")
        .partitionBy("part")
        .parquet(path)
    )


def export_order(rows: DataFrame) -> DataFrame:
    """(part, keys, smallest, largest, ascending, apart) from exported rows (part, key, file, at).

    ``at`` is the row's place in its file.  A file's rows are looked at together; files are of bounded size.
    """
    before = F.lag("key").over(Window.partitionBy("part", "file").orderBy("at"))
    files = (
        rows.select("part", "file", "key", (before.isNull() | (before < F.col("key"))).alias("up"))
        .groupBy("part", "file")
        .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.bool_and("up").alias("up"))
    )
    # One row for each file.
    above = F.max("high").over(Window.partitionBy("part").orderBy("low", "file").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.select("*", (above.isNull() | (above < F.col("low"))).alias("clear"))
    return placed.groupBy("part").agg(
        F.sum("n").alias("keys"),
        F.min("low").alias("smallest"),
        F.max("high").alias("largest"),
        F.bool_and("up").alias("ascending"),
        F.bool_and("clear").alias("apart"),
    )
