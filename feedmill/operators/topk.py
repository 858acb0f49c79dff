"""Best items per user by dot product, exact or limited to probed clusters.

Both factor tables are (id, features), with a ``cluster`` column where probing
is asked for.  A matrix kernel scores a tile of users against a block of items
and lets out at most ``k`` rows per user, so pairs never become rows.

An item matrix measured to fit is shared with every task and the users stay
where they are.  Beyond that size users and items are both cut into blocks and
meet by block number; the per-block lists are then merged.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast, cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.functions.lists import in_order
from feedmill.functions.values import dot
from feedmill.operators import topk_kernel
from feedmill.operators.joins import dimension_join, fits_broadcast
from feedmill.operators.ranking import global_rank, top_per_key
from feedmill.session import materialise

cloudpickle.register_pickle_by_value(topk_kernel)

MAX_ITEM_BYTES = 256 << 20
BLOCK_BYTES = 128 << 20
#: Blocks that a side is cut into, as long as they stay below ``BLOCK_BYTES``: every block of the one side is copied to
#: every block of the other.
BLOCKS = 12


@dataclass(frozen=True)
class Probe:
    """Score only the items of the ``clusters`` best item clusters of a user cluster.

    Item clusters of ``min_size`` members or fewer are never probed.
    """

    clusters: int
    min_size: int = 0


# --- clusters --------------------------------------------------------------


def cluster_sizes(factors: DataFrame, above: int = 0) -> DataFrame:
    """(cluster, n) of clusters with more than ``above`` members."""
    sizes = factors.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return sizes.where(F.col("n") > above)


def centroids(factors: DataFrame, above: int = 0) -> DataFrame:
    """(cluster, centre): mean features, summed inside the map tasks first."""
    vector = array_to_vector(F.col("features").cast("array<double>"))
    means = factors.groupBy("cluster").agg(
        Summarizer.mean(vector).alias("mean"), F.count(F.lit(1)).alias("n")
    )
    return means.where(F.col("n") > above).select(
        "cluster", vector_to_array("mean").alias("centre")
    )


def cluster_routes(users: DataFrame, items: DataFrame, probe: Probe) -> DataFrame:
    """(user_cluster, item_cluster, pos): the probed clusters, best first.

    Centroids go through the same kernel as users and items do; their products
    are cut to whole numbers before they are ranked.
    """

    def as_factors(means: DataFrame) -> DataFrame:
        return means.select(F.col("cluster").alias("id"), F.col("centre").alias("features"))

    best = recommend_top_k(
        as_factors(centroids(users)),
        as_factors(materialise(centroids(items, probe.min_size))),
        probe.clusters,
        whole_products=True,
    )
    return best.select("user", F.posexplode("items").alias("pos", "entry")).select(
        F.col("user").alias("user_cluster"), F.col("entry.item").alias("item_cluster"), "pos"
    )


# --- the operators ---------------------------------------------------------


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(user, item) -> (user, item, score); pairs without factors are left out."""
    of_users = users.select(F.col("id").alias("user"), F.col("features").alias("user_features"))
    of_items = items.select(F.col("id").alias("item"), F.col("features").alias("item_features"))
    # Users first: a pair then carries one vector through one shuffle, and items are shared where they fit.
    both = dimension_join(pairs.select("user", "item").join(of_users, "user"), of_items, ["item"])
    return both.select(
        "user", "item", dot(F.col("user_features"), F.col("item_features")).alias("score")
    )


def _prepared(factors: DataFrame, probing: bool) -> DataFrame:
    cluster = F.col("cluster") if probing else F.lit(0)
    return factors.select(
        F.col("id").cast("bigint").alias("id"),
        cluster.cast("bigint").alias("cluster"),
        "features",
    )


def _share(items: DataFrame, by: str = "cluster") -> Broadcast:
    """Broadcast the columns of an item table measured to fit, ordered by cluster, or by length from the longest on."""
    ids, clusters, matrix = topk_kernel.columns(items.toArrow())
    order = np.argsort(clusters, kind="stable") if by == "cluster" else np.lexsort((ids, -(matrix * matrix).sum(axis=1)))
    held = {"ids": ids[order], "clusters": clusters[order], "matrix": matrix[order]}
    return items.sparkSession.sparkContext.broadcast(held)


def _merge_lists(rows: DataFrame, k: int) -> DataFrame:
    best = top_per_key(rows, "user", [F.col("score").desc(), F.col("item")], k, "pos")
    return best.groupBy("user").agg(in_order("pos", "item", "score").alias("items"))


def rows_per_block(rows: int, row_bytes: int, block_bytes: int) -> int:
    """Rows in a block of ``block_bytes``, or more where these would make more than ``BLOCKS`` blocks of a side.

    A block never goes beyond ``BLOCK_BYTES`` for that, which bounds the memory of a task.
    """
    return max(1, block_bytes // row_bytes, min(BLOCK_BYTES // row_bytes, -(-rows // BLOCKS)))


def _by_blocks(
    users: DataFrame, items: DataFrame, routes: DataFrame | None, k: int, n_items: int, row_bytes: int, block_bytes: int,
    whole_products: bool,
) -> DataFrame:
    """Score block against block, then merge each user's lists.

    A cluster's items make one list, cut by a hash of the id into as many blocks as its size asks for; its users
    are cut likewise, and meet the blocks of the lists that they probe and no others.
    """
    if routes is not None:
        to_probe = routes.select(
            F.col("user_cluster").alias("cluster"), F.col("item_cluster").alias("target")
        )
        users = dimension_join(users, to_probe, ["cluster"]).select(
            "id", F.col("target").alias("cluster"), "features"
        )
        users = materialise(users)

    def blocks(df: DataFrame, name: str, rows: int) -> DataFrame:
        per_block = rows_per_block(rows, row_bytes, block_bytes)
        return df.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias(name))

    # One row for each list.
    cuts = materialise(blocks(users, "ubs", users.count()).join(blocks(items, "ibs", n_items), "cluster"))

    def dealt(df: DataFrame, own: str, other: str, a: str, c: str) -> DataFrame:
        cut = dimension_join(df, cuts, ["cluster"])
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(c)
        # Named anew, as both sides may be the same table.
        columns = [F.col(x).alias(x) for x in ("id", "cluster", "features")]
        return cut.select(*columns, F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(a), every)

    left, right = dealt(users, "ubs", "ibs", "ub", "ib"), dealt(items, "ibs", "ubs", "ib", "ub")
    keys = ["cluster", "ub", "ib"]
    lists = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        topk_kernel.block_scorer(k, whole_products), topk_kernel.LISTS
    )
    return _merge_lists(lists.select("user", F.inline("items").alias("item", "score")), k)


def recommend_top_k(
    users: DataFrame,
    items: DataFrame,
    k: int = 300,
    probe: Probe | None = None,
    max_item_bytes: int = MAX_ITEM_BYTES,
    block_bytes: int = BLOCK_BYTES,
    whole_products: bool = False,
) -> DataFrame:
    """(user, items array<struct<item, score>>), best first, ties by item id."""
    routes = materialise(cluster_routes(users, items, probe)) if probe is not None else None
    users, items = _prepared(users, probe is not None), _prepared(items, probe is not None)
    n_items, width = items.agg(
        F.count(F.lit(1)), F.coalesce(F.max(F.size("features")), F.lit(1))
    ).first()
    row_bytes = 8 * max(1, width)
    if n_items * row_bytes <= max_item_bytes and (routes is None or fits_broadcast(routes)):
        reach: dict[int, list[int]] = {0: [0]} if routes is None else defaultdict(list)
        for row in routes.collect() if routes is not None else ():
            reach[row.user_cluster].append(row.item_cluster)
        kernel = topk_kernel.shared_scorer(_share(items), dict(reach), k, whole_products)
        # Each task brings its users of a cluster together; they need not move for that.
        near = users if routes is None else users.sortWithinPartitions("cluster")
        return near.mapInArrow(kernel, topk_kernel.LISTS)
    return _by_blocks(users, items, routes, k, n_items, row_bytes, block_bytes, whole_products)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (users, entries, hits, recall): how much of the exact lists the found ones hold.

    Both are (user, items).  A user without a found list misses all of its entries.
    """

    def rows(lists: DataFrame) -> DataFrame:
        return lists.select("user", F.inline("items")).select("user", "item")

    met = rows(exact).join(rows(found).withColumn("hit", F.lit(1)), ["user", "item"], "left")
    per_user = met.groupBy("user").agg(F.count(F.lit(1)).alias("entries"), F.count("hit").alias("hits"))
    totals = per_user.agg(
        F.count(F.lit(1)).alias("users"),
        F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("hits"),
    )
    return totals.withColumn("recall", F.try_divide("hits", "entries"))


def top_k_by_norm(
    users: DataFrame,
    items: DataFrame,
    k: int = 300,
    max_item_bytes: int = MAX_ITEM_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(user, items, products): the lists of ``recommend_top_k`` without probing, from fewer products.

    Items are met in order of their length, the longest first, and a user is done once no item to come can reach
    its k-th score.  Items beyond ``max_item_bytes`` are cut into blocks by length: all users meet the first
    block, and go on only to blocks whose longest item could still enter their list.  ``products`` counts the
    pairs that were scored for a user.
    """
    users, items = _prepared(users, False), _prepared(items, False)
    n_items, width = items.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("features")), F.lit(1))).first()
    row_bytes = 8 * max(1, width)
    if n_items * row_bytes <= max_item_bytes:
        kernel = topk_kernel.norm_scorer(_share(items, "length"), np.zeros(0), np.zeros(0, np.int64), k)
        return users.mapInArrow(kernel, topk_kernel.NORM_LISTS).where(F.size("items") > 0).select("user", "items", "products")
    per_block = rows_per_block(n_items, row_bytes, block_bytes)
    square = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    ranked = global_rank(items.withColumn("length", F.sqrt(square)), [F.desc("length"), F.asc("id")])
    ranked = materialise(ranked.withColumn("block", F.call_function("div", "rank", F.lit(per_block)).cast("int")))
    # One row for each block of ``block_bytes``.
    edges = ranked.groupBy("block").agg(F.max("length").alias("length"), F.count(F.lit(1)).alias("n")).orderBy("block").collect()
    tails, sizes = np.array([e["length"] for e in edges[1:]]) * (1 + 1e-9), np.array([e["n"] for e in edges[1:]], np.int64)
    head = _share(ranked.where("block = 0").select("id", "cluster", "features"), "length")
    first = materialise(users.mapInArrow(topk_kernel.norm_scorer(head, tails, sizes, k), topk_kernel.NORM_LISTS))

    n_users = first.count()
    user_blocks = max(1, math.ceil(n_users / rows_per_block(n_users, row_bytes, block_bytes)))
    ub = F.pmod(F.xxhash64("id"), F.lit(user_blocks)).cast("int").alias("ub")
    left = first.where("blocks > 0").withColumnRenamed("user", "id")
    left = left.select("id", F.lit(0).cast("bigint").alias("cluster"), "features", ub, F.explode(F.sequence(F.lit(1), "blocks")).alias("ib"))
    every = F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))).alias("ub")
    right = ranked.where("block > 0").select("id", "cluster", "features", every, F.col("block").alias("ib"))
    lists = left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib")).applyInArrow(
        topk_kernel.block_scorer(k, False), topk_kernel.LISTS
    )
    rows = lists.unionByName(first.select("user", "items")).select("user", F.inline("items").alias("item", "score"))
    return _merge_lists(rows, k).join(first.select("user", "products"), "user")
