"""Implicit-feedback factorisation, its evaluation, and sharding of factors."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.operators.topk import top_k_by_norm
from feedmill.session import current_scratch, materialise, shared_dir


@dataclass(frozen=True)
class Settings:
    """Factorisation settings.

    ``blocks`` is the parallelism on either side, the session's own by default.
    """

    rank: int = 256
    reg: float = 0.04
    iterations: int = 10
    alpha: float = 1.0
    seed: int = 10
    blocks: int | None = None


def train(ratings: DataFrame, settings: Settings = Settings()) -> ALSModel:
    """Fit non-negative implicit factors of (user, item, rating).

    The iterations cut their lineage in the shared checkpoint folder.
    """
    spark = ratings.sparkSession
    shared_dir(spark)
    blocks = settings.blocks or spark.sparkContext.defaultParallelism
    als = ALS(
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        implicitPrefs=True,
        nonnegative=True,
        rank=settings.rank,
        regParam=settings.reg,
        maxIter=settings.iterations,
        alpha=settings.alpha,
        seed=settings.seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=5,
        coldStartStrategy="drop",
    )
    return als.fit(ratings)


def recommend_for_all(model: ALSModel, k: int = 100) -> DataFrame:
    """(user, items) for every user of the model.

    The lists of the model's own ``recommendForAllUsers``, up to its single precision, without crossing all blocks
    of users with all blocks of items.
    """
    return top_k_by_norm(model.userFactors, model.itemFactors, k).select("user", "items")


# --- sharding --------------------------------------------------------------


def shard_by_hash(factors: DataFrame, n: int = 100) -> DataFrame:
    """Add ``shard`` 0..n-1 from a digest of the id.

    It is the same on every attempt of a task, and outside of Spark.
    """
    digest = F.substring(F.md5(F.col("id").cast("string")), 1, 8)
    return factors.withColumn("shard", F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(n)).cast("int"))


def fit_clusters(
    factors: DataFrame, k: int = 100, iterations: int = 3, seed: int = 10
) -> BisectingKMeansModel:
    vectors = factors.select(array_to_vector(F.col("features").cast("array<double>")).alias("v"))
    model = BisectingKMeans(featuresCol="v", predictionCol="shard", k=k, maxIter=iterations, seed=seed)
    return model.fit(vectors)


def shard_by_cluster(factors: DataFrame, model: BisectingKMeansModel) -> DataFrame:
    """Add ``shard``: the cluster that the features fall in."""
    with_vector = factors.withColumn("v", array_to_vector(F.col("features").cast("array<double>")))
    return model.transform(with_vector).drop("v")


def training_cost(model: BisectingKMeansModel) -> float:
    return model.summary.trainingCost


# --- evaluation ------------------------------------------------------------


def split_ratings(
    ratings: DataFrame, train_share: float = 0.8, seed: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Training and held-out ratings, split by a digest of the pair.

    Unlike a random split this does not depend on partitioning or retries, and
    it can be told outside of Spark.
    """
    text = F.concat_ws(":", F.col("user").cast("string"), F.col("item").cast("string"), F.lit(str(seed)))
    draw = F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(1_000_000))
    in_train = draw < int(train_share * 1_000_000)
    return ratings.where(in_train), ratings.where(~in_train)


def squared_error(held_out: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row (pairs, mse) over the held-out pairs that have a prediction."""
    pairs = predicted.select("user", "item", "prediction").join(
        held_out.select("user", "item", "rating"), ["user", "item"]
    )
    gap = F.col("rating") - F.col("prediction")
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.avg(gap * gap).alias("mse"))


def _fit_and_compare(fitted: DataFrame, held_out: DataFrame, settings: Settings) -> DataFrame:
    model = train(fitted, settings)
    error = squared_error(held_out, model.transform(held_out.select("user", "item")))
    return error.select(
        F.lit(settings.rank).alias("rank"),
        F.lit(settings.reg).alias("reg"),
        F.lit(settings.iterations).alias("iterations"),
        "pairs",
        "mse",
    )


def evaluate(
    ratings: DataFrame, settings: Settings = Settings(), train_share: float = 0.8
) -> DataFrame:
    """(rank, reg, iterations, pairs, mse) on held-out ratings."""
    return _fit_and_compare(*split_ratings(ratings, train_share, settings.seed), settings)


def grid(
    ratings: DataFrame,
    ranks: Iterable[int],
    regs: Iterable[float],
    iterations: Iterable[int],
    base: Settings = Settings(),
    train_share: float = 0.8,
    at_once: int = 2,
) -> DataFrame:
    """Evaluate every combination; one row each, in the order of the arguments.

    All fits share one split, which is written once.  ``at_once`` of them run side by side, so that the narrow
    stages of one fit leave no executor idle.
    """
    every = [
        replace(base, rank=rank, reg=reg, iterations=steps) for rank, reg, steps in product(ranks, regs, iterations)
    ]
    if not every:
        raise ValueError("an empty grid")
    fitted, held_out = (materialise(part) for part in split_ratings(ratings, train_share, base.seed))

    def row(settings: Settings) -> DataFrame:
        return materialise(_fit_and_compare(fitted, held_out, settings), owner=held)

    held = current_scratch()
    with ThreadPool(max(1, at_once)) as pool:
        return reduce(DataFrame.unionByName, pool.map(inheritable_thread_target(row), every, 1))
