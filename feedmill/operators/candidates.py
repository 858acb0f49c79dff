"""From decoded lists to lists worth showing.

Each step exists over rows (uid, pos, mid) and over lists (uid, mids).  A chain
of steps stays with rows and builds its lists once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill import schemas
from feedmill.functions.lists import in_order
from feedmill.operators.joins import dimension_join, restrict
from feedmill.operators.quality import counted
from feedmill.operators.steps import derive

ITEM_TYPE = "mid"


def list_rows(candidates: DataFrame) -> DataFrame:
    """(uid, mids) -> (uid, pos, mid) with 0-based positions."""
    return candidates.select("uid", F.posexplode("mids").alias("pos", "mid"))


def row_lists(rows: DataFrame) -> DataFrame:
    """(uid, pos, mid) -> (uid, mids); a repeated item keeps its first position."""
    together = rows.select("uid", "pos", "mid").repartition("uid")
    return together.groupBy("uid").agg(F.array_distinct(in_order("pos", "mid")).alias("mids"))


def unseen_rows(
    rows: DataFrame,
    history: DataFrame,
    offered: DataFrame | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Candidate rows whose (uid, mid) is not in the history.  An observation counts kept and removed ones.

    History of items that nobody is offered is dropped before it is shuffled;
    ``offered`` (mid) may name them, or more, where they are known already.
    The sides meet on (uid, mid), the history as one row per pair, so neither
    a busy user nor a popular item makes a large group.
    """
    offered = rows.select("mid") if offered is None else offered.select("mid")
    seen = restrict(history.select("uid", "mid"), offered, ["mid"]).distinct()
    if observation is None:
        return rows.join(seen, ["uid", "mid"], "left_anti").select("uid", "pos", "mid")
    flagged = rows.join(seen.withColumn("_seen", F.lit(True)), ["uid", "mid"], "left")
    unseen = F.col("_seen").isNull()
    flagged = counted(flagged, observation, {"kept": unseen, "removed": ~unseen})
    return flagged.where(unseen).select("uid", "pos", "mid")


def remove_seen(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Drop items the user has acted on in any way; keep the order of the rest.

    A user with nothing left has no row.
    """
    return row_lists(unseen_rows(list_rows(candidates), history))


def seen_counters(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """One row: users offered something, items kept and removed, users with items left."""
    rows = list_rows(candidates.select("uid", F.array_distinct("mids").alias("mids")))
    seen = restrict(history.select("uid", "mid"), rows.select("mid"), ["mid"])
    flagged = rows.join(seen.distinct().withColumn("seen", F.lit(True)), ["uid", "mid"], "left")
    per_user = flagged.groupBy("uid").agg(
        F.count_if(F.col("seen").isNull()).alias("kept"), F.count("seen").alias("removed")
    )
    return per_user.agg(
        F.count(F.lit(1)).alias("users"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"),
        F.coalesce(F.sum("removed"), F.lit(0)).alias("removed"),
        F.count_if(F.col("kept") > 0).alias("users_left"),
    )


def unique_meta(meta: DataFrame) -> DataFrame:
    """One metadata row per item, the smallest (author, object id)."""
    picked = F.min(F.struct(F.col("uid").alias("author"), F.col("object_id").alias("oid")))
    return meta.groupBy("mid").agg(picked.alias("m")).select("mid", "m.author", "m.oid")


def enrich_rows(rows: DataFrame, meta: DataFrame, cap: int = 200) -> DataFrame:
    """(uid, pos, mid) -> (uid, items): the first ``cap`` entries that have metadata.

    ``meta`` is what ``sources.read_item_meta`` gives: one day, long enough items.
    """
    known = dimension_join(rows, unique_meta(meta), ["mid"])
    # Rows of a user lie anywhere by now, so lists are made once they are together, not before as well.
    together = known.select("uid", "pos", "author", "mid", "oid").repartition("uid")
    first = F.slice(in_order("pos", "author", "mid", "oid"), 1, cap)
    entries = F.transform(
        first,
        lambda e: F.struct(
            e["author"].alias("uid"), F.lit(ITEM_TYPE).alias("type"), e["mid"].alias("id"), e["oid"].alias("oid")
        ),
    )
    return together.groupBy("uid").agg(entries.alias("items"))


def enrich(candidates: DataFrame, meta: DataFrame, cap: int = 200) -> DataFrame:
    """(uid, mids) -> (uid, items)."""
    return enrich_rows(list_rows(candidates), meta, cap)


def items_json(items: Column) -> Column:
    """The enriched list as the JSON text the store takes."""
    return F.to_json(items)


_ENTRIES = schemas.ENRICHED["items"].dataType
_UNREAD = T.StructType([T.StructField("items", _ENTRIES), T.StructField("unread", T.StringType())])


def _decoded(stored: DataFrame) -> DataFrame:
    """``stored`` with ``items``, and ``unread`` holding a text that is no such list."""
    # The text is wrapped, as a record that cannot be read is kept by name.
    whole = F.concat(F.lit('{"items":'), F.col("list"), F.lit("}"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unread"}
    read = derive(stored, stored.columns, {"read": F.from_json(whole, _UNREAD, options)})
    bad = F.col("read.unread").isNotNull() | F.col("read.items").isNull()
    return read.select(*stored.columns, F.col("read.items").alias("items"), bad.alias("bad"))


def json_entries(stored: DataFrame) -> DataFrame:
    """(uid, list) with lists as ``items_json`` prints them -> (owner, pos, uid, type, id, oid).

    A text that is no such list gives no rows; ``json_rejects`` has it.
    """
    rows = _decoded(stored).where(~F.col("bad")).select(F.col("uid").alias("owner"), F.posexplode("items").alias("pos", "entry"))
    return rows.select("owner", "pos", "entry.*")


def json_rejects(stored: DataFrame) -> DataFrame:
    """(uid, list) of the stored lists that cannot be read; a NULL list is none."""
    return _decoded(stored).where("bad").select("uid", "list")
