"""Popularity of an item and strength of a user's interest in it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the behaviour score.
COMMENT_WEIGHT = 4.0
ATTITUDE_WEIGHT = 16.0
REPOST_WEIGHT = 20.0
DIVERSION_WEIGHT = 2.0
REPLAY_RATE = 0.8
REPLAY_TWICE = 5.0
REPLAY_MORE = 16.0


def popularity(repost: Column, comment: Column, attitude: Column, play: Column) -> Column:
    """Sum of the log interactions times the log plays.

    Rounded to nine places, so that items with the same counts in another
    order tie exactly and the id decides.
    """
    interest = F.log2(comment + 1) + F.log2(repost + 1) + F.log2(attitude + 1)
    return F.round(interest * F.log2(play + 1), 9)


def capped_rate(best: Column) -> Column:
    """Best completion rate held within 0..1; no play at all counts as 0."""
    return F.least(F.greatest(F.coalesce(best, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def replay_bonus(times: Column, rate: Column) -> Column:
    return F.when(
        rate > REPLAY_RATE,
        F.when(times == 2, REPLAY_TWICE).when(times > 2, REPLAY_MORE).otherwise(0.0),
    ).otherwise(0.0)


def behaviour_score(
    diversions: Column,
    diversion_rate: Column,
    plays: Column,
    play_rate: Column,
    comment: Column,
    attitude: Column,
    repost: Column,
) -> Column:
    """Score of one (user, item); rates are best rates, flags are booleans."""
    d, p = capped_rate(diversion_rate), capped_rate(play_rate)
    return (
        diversions * d * DIVERSION_WEIGHT
        + replay_bonus(diversions, d)
        + plays * p
        + replay_bonus(plays, p)
        + comment.cast("int") * COMMENT_WEIGHT
        + attitude.cast("int") * ATTITUDE_WEIGHT
        + repost.cast("int") * REPOST_WEIGHT
    )
