"""Numeric ids for users and items, and the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedmill.functions.lists import in_order
from feedmill.operators.joins import MAX_BROADCAST_ROWS, dimension_join
from feedmill.operators.quality import counted
from feedmill.operators.ranking import global_rank, grouped_rank

USER, ITEM = "uid", "mid"
SHORT, NO_NUMBER = "short", "not a number"


def id_bucket(real_id: Column) -> Column:
    """Last four characters, a leading 0 written as 1; NULL for a shorter id."""
    tail = F.substring(real_id, -4, 4)
    return F.when(
        F.length(real_id) >= 4,
        F.when(tail.startswith("0"), F.overlay(tail, F.lit("1"), 1, 1)).otherwise(tail),
    )


def distinct_ids(scores: DataFrame) -> DataFrame:
    """(kind, real_id) of every user and item, one scan for both kinds."""
    pair = F.explode(
        F.array(
            F.struct(F.lit(USER).alias("kind"), F.col("uid").alias("real_id")),
            F.struct(F.lit(ITEM).alias("kind"), F.col("mid").alias("real_id")),
        )
    )
    return scores.select(pair.alias("id")).select("id.kind", "id.real_id").distinct()


def _bucketed(scores: DataFrame) -> DataFrame:
    """(kind, real_id, bucket, cause): cause is NULL where the bucket gives a number."""
    bucket = id_bucket(F.col("real_id"))
    cause = F.when(bucket.isNull(), SHORT).when(~bucket.rlike("^[0-9]{4}$"), NO_NUMBER)
    return distinct_ids(scores).select("kind", "real_id", bucket.alias("bucket"), cause.alias("cause"))


def assign_ids(scores: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Bucket text followed by the ordinal in the bucket, users and items apart.

    Ids that give no number are left out here and given by ``id_rejects``; an observation counts them on the way.
    """
    ids = _bucketed(scores)
    if observation is not None:
        conditions = {"ids": F.lit(True), "short_ids": F.col("cause") == SHORT, "no_number_ids": F.col("cause") == NO_NUMBER}
        ids = counted(ids, observation, conditions)
    ids = ids.where(F.col("cause").isNull()).drop("cause")
    ranked = grouped_rank(ids, ["kind", "bucket"], [F.col("real_id")], "ordinal")
    number = F.concat("bucket", F.col("ordinal").cast("string")).cast("bigint")
    return ranked.select("real_id", number.alias("num_id"), "kind")


def id_rejects(scores: DataFrame) -> DataFrame:
    """(kind, real_id, cause) of the ids that ``assign_ids`` gives no number."""
    return _bucketed(scores).where(F.col("cause").isNotNull()).select("kind", "real_id", "cause")


def assign_dense_ids(scores: DataFrame) -> DataFrame:
    """0, 1, 2, ... per kind in order of the real id.

    Bucketed ids overflow the 32 bits a factoriser takes once a bucket grows
    large; these do not before there are as many users or items.
    """
    ranked = global_rank(distinct_ids(scores), [F.col("kind"), F.col("real_id")], "at")
    first = ranked.groupBy("kind").agg(F.min("at").alias("first"))
    return ranked.join(F.broadcast(first), "kind").select(
        "real_id", (F.col("at") - F.col("first")).alias("num_id"), "kind"
    )


def of_kind(ids: DataFrame, kind: str, real: str, num: str) -> DataFrame:
    return ids.where(F.col("kind") == kind).select(
        F.col("real_id").alias(real), F.col("num_id").alias(num)
    )


def encode_ratings(scores: DataFrame, ids: DataFrame) -> DataFrame:
    """(user, item, rating) with numeric ids; an id beyond 32 bits is an error."""
    items = dimension_join(scores, of_kind(ids, ITEM, "mid", "item"), ["mid"])
    users = of_kind(ids, USER, "uid", "user")
    return items.join(users, "uid").select(
        F.col("user").cast("int").alias("user"),
        F.col("item").cast("int").alias("item"),
        F.round("score", 2).alias("rating"),
    )


def decode_triples(triples: DataFrame, ids: DataFrame) -> DataFrame:
    """(user, item, score) -> (uid, mid, score)."""
    items = dimension_join(triples, of_kind(ids, ITEM, "mid", "item"), ["item"])
    return items.join(of_kind(ids, USER, "uid", "user"), "user").select("uid", "mid", "score")


def decode_rows(recs: DataFrame, ids: DataFrame, observation: Observation | None = None) -> DataFrame:
    """(user, items array<struct<item, score>>) -> (uid, pos, mid).

    Items without a real id are left out; ``missing_items`` counts them, and an observation does so on the way.
    """
    entries = recs.join(of_kind(ids, USER, "uid", "user"), "user").select(
        "uid", F.posexplode("items").alias("pos", "entry")
    )
    numbered = entries.select("uid", "pos", F.col("entry.item").alias("item"))
    names = of_kind(ids, ITEM, "mid", "item")
    if observation is None:
        return dimension_join(numbered, names, ["item"]).select("uid", "pos", "mid")
    named = dimension_join(numbered, names, ["item"], "left")
    named = counted(named, observation, {"entries": F.lit(True), "missing": F.col("mid").isNull()})
    return named.where(F.col("mid").isNotNull()).select("uid", "pos", "mid")


def decode_recommendations(recs: DataFrame, ids: DataFrame) -> DataFrame:
    """The decoded rows as (uid, mids), in the same order.  A list holds at most k."""
    return decode_rows(recs, ids).groupBy("uid").agg(in_order("pos", "mid").alias("mids"))


def missing_items(recs: DataFrame, ids: DataFrame) -> DataFrame:
    """One row: recommended entries, and those without a real id."""
    entries = recs.select(F.explode("items").alias("entry")).select(
        F.col("entry.item").alias("item")
    )
    counted = entries.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    known = of_kind(ids, ITEM, "mid", "item")
    return counted.join(known, "item", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("entries"),
        F.coalesce(F.sum(F.when(F.col("mid").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
    )


def lookup(
    numbers: DataFrame, ids: DataFrame, kind: str = ITEM, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """(num_id) -> (num_id, real_id); numbers without one are left out."""
    names = ids.where(F.col("kind") == kind).select("num_id", "real_id")
    return dimension_join(numbers.select("num_id"), names, ["num_id"], max_rows=max_rows)
