"""Behaviour logs x white list -> (user, item, score)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.guards import LONG_PLAY_MS, is_member
from feedmill.functions.props import FIRST, framed, prop, readable
from feedmill.functions.scores import behaviour_score
from feedmill.functions.values import strict_double, strict_int
from feedmill.operators.joins import dimension_join
from feedmill.operators.steps import derive

MARKS = ("repost", "comment", "attitude")
REJECTED = "rejected"


def _classified(behaviour: DataFrame, good: DataFrame) -> DataFrame:
    """One row per log line of a member on a good item: (uid, mid, signal, rate)."""
    bag = F.col("bag")
    lines = behaviour.where(is_member(F.col("uid")))
    on_list = dimension_join(lines, good.select("mid"), ["mid"], "left_semi")
    is_play = F.col("action") == "play"
    read = derive(
        on_list.select("uid", "mid", "action", F.when(is_play, framed(F.col("extend"))).alias("bag")),
        ["uid", "mid", "action"],
        {
            "readable": readable(bag, FIRST),
            "watched": strict_double(prop(bag, "valid_play_duration", FIRST)),
            "length": strict_double(prop(bag, "object_duration", FIRST)),
            "index": prop(bag, "index", FIRST),
        },
    )
    long_play = is_play & (F.col("watched") >= LONG_PLAY_MS)
    index = strict_int(F.col("index"))
    understood = (
        F.col("readable")
        & F.col("length").isNotNull()
        & F.col("watched").isNotNull()
        & (~long_play | F.col("index").isNull() | index.isNotNull())
    )
    signal = (
        F.when(is_play & ~F.coalesce(understood, F.lit(False)), REJECTED)
        .when(long_play & (index == 0), "diversion")
        .when(long_play, "play")
        .when(F.col("action").isin(*MARKS), F.col("action"))
        .otherwise("touch")
    )
    rate = F.coalesce(F.try_divide("watched", "length"), F.lit(float("inf")))
    return read.select(
        "uid", "mid", signal.alias("signal"), F.when(long_play, rate).alias("rate")
    )


def behaviour_signals(behaviour: DataFrame, good: DataFrame) -> DataFrame:
    """One row per usable log line on a good item: (uid, mid, signal, rate).

    ``signal`` is diversion, play, repost, comment, attitude or touch; the
    last one scores nothing but counts as an item the user has touched.
    A play whose bag or numbers cannot be read is left out.
    """
    return _classified(behaviour, good).where(F.col("signal") != REJECTED)


def user_item_vector(signals: DataFrame) -> DataFrame:
    """Distinct completion rates, best rate and marks per (user, item).

    Equal signals collapse first, before the shuffle and after it: what is left
    for one pair is its distinct rates, themselves spread by value.
    """
    distinct = signals.distinct()

    def of(kind):
        return F.col("signal") == kind

    return distinct.groupBy("uid", "mid").agg(
        F.count_if(of("diversion")).alias("diversions"),
        F.max(F.when(of("diversion"), F.col("rate"))).alias("diversion_rate"),
        F.count_if(of("play")).alias("plays"),
        F.max(F.when(of("play"), F.col("rate"))).alias("play_rate"),
        *[F.max(of(mark)).alias(mark) for mark in MARKS],
    )


def user_item_score(
    behaviour: DataFrame, good: DataFrame, min_items: int = 50, max_items: int = 2000
) -> DataFrame:
    """Scores of users who touched between ``min_items`` and ``max_items`` good items.

    The count per user runs over (user, item) rows, so one user brings at most
    as many rows as the white list has items.
    """
    vector = user_item_vector(behaviour_signals(behaviour, good))
    per_user = Window.partitionBy("uid")
    score = behaviour_score(
        F.col("diversions"),
        F.col("diversion_rate"),
        F.col("plays"),
        F.col("play_rate"),
        F.col("comment"),
        F.col("attitude"),
        F.col("repost"),
    )
    return (
        vector.select("uid", "mid", score.alias("score"))
        .withColumn("items", F.count(F.lit(1)).over(per_user))
        .where(F.col("items").between(min_items, max_items) & (F.col("score") != 0))
        .select("uid", "mid", "score")
    )


def score_counters(behaviour: DataFrame, good: DataFrame) -> DataFrame:
    """One row: what became of the members' log lines on good items."""

    def of(*kinds):
        return F.count_if(F.col("signal").isin(*kinds))

    return _classified(behaviour, good).agg(
        F.count(F.lit(1)).alias("lines"),
        of(REJECTED).alias("rejected_plays"),
        of("play", "diversion").alias("scored_plays"),
        of("touch").alias("touches"),
        *[of(mark).alias(mark) for mark in MARKS],
    )
