"""Item popularity and the white list of good items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.guards import is_member
from feedmill.functions.scores import popularity
from feedmill.operators.ranking import global_rank
from feedmill.session import materialise

ACTIONS = ("repost", "comment", "attitude", "play")


def item_action_counts(behaviour: DataFrame) -> DataFrame:
    """Actions of members per item; an item with other actions only gives zeros."""
    return (
        behaviour.where(is_member(F.col("uid")) & F.col("mid").isNotNull())
        .groupBy("mid")
        .agg(*[F.count_if(F.col("action") == a).alias(a) for a in ACTIONS])
    )


def _slice_bounds(counts: DataFrame, skip: int, pool_end: int) -> tuple[int, int, int] | None:
    """(fewest plays, most plays, items with more): where the places ``skip`` to ``pool_end`` - 1 lie.

    They come from a histogram, the number of items for each number of plays.  It has at most sqrt(2 * plays)
    rows, as d different numbers of plays add up to d * (d - 1) / 2 or more.
    """
    histogram = counts.groupBy("play").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(F.desc("play")).rowsBetween(Window.unboundedPreceding, -1)
    placed = histogram.select("play", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("above"))
    touched = placed.where((F.col("above") < pool_end) & (F.col("above") + F.col("n") > skip))
    low, high, above = touched.agg(F.min("play"), F.max("play"), F.min("above")).first()
    return None if low is None else (low, high, above)


def good_items(
    counts: DataFrame, skip: int = 200, pool_end: int = 300_000, top: int = 100_000
) -> DataFrame:
    """Skip the most played items, pool the next ones, keep the best of the pool.

    A histogram of the plays tells which items the pool is cut from, so only
    those are ranked, by a distributed sort.  The pool's size is bounded by the
    arguments, whatever the catalogue holds, so the second cut may end in one task.
    """
    counts = materialise(counts)
    bounds = _slice_bounds(counts, skip, pool_end)
    low, high, above = bounds if bounds else (1, 0, 0)
    ranked = global_rank(counts.where(F.col("play").between(low, high)), [F.col("play").desc(), F.col("mid")])
    pool = ranked.where(F.col("rank").between(skip - above, pool_end - 1 - above))
    scored = pool.select(
        "mid",
        popularity(F.col("repost"), F.col("comment"), F.col("attitude"), F.col("play")).alias("score"),
    )
    return scored.orderBy(F.col("score").desc(), "mid").limit(top)


def count_per(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, combined before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


