"""Readers. Paths may be one string, a list, or hold globs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill import schemas
from feedmill.functions import lists

Paths = str | list[str]


def _tab_text(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """Tab-separated lines without quoting; a missing or empty field is NULL."""
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("quote", "")
        .option("escape", "")
        .csv(paths)
    )


def _lines(spark: SparkSession, paths: Paths) -> DataFrame:
    return spark.read.text(paths)


def read_behaviour(spark: SparkSession, paths: Paths) -> DataFrame:
    return _tab_text(spark, paths, schemas.BEHAVIOUR)


def read_item_set(spark: SparkSession, paths: Paths) -> DataFrame:
    """Distinct first fields of tab-separated lines as (mid): a white list in text form."""
    mid = F.trim(F.substring_index("value", "\t", 1))
    return _lines(spark, paths).select(mid.alias("mid")).where("mid <> ''").distinct()


def read_pairs(spark: SparkSession, paths: Paths) -> DataFrame:
    """``uid<tab>mid`` lines: a history, or diversion records, in text form."""
    return _tab_text(spark, paths, schemas.PAIRS)


def _columnar(
    spark: SparkSession, source: Paths, format: str, positions: Mapping[str, int]
) -> DataFrame:
    """Named columns of a parquet, orc or catalogue table, or columns by position.

    A source whose columns carry the wanted names is read by name; any other
    must have at least as many columns as the positions ask for.
    """
    df = spark.table(source) if format == "table" else spark.read.format(format).load(source)
    if set(positions) <= set(df.columns):
        return df.select(*positions)
    if len(df.columns) <= max(positions.values()):
        raise ValueError(f"{len(df.columns)} columns where position {max(positions.values())} is read")
    return df.select(*[F.col(f"`{df.columns[at]}`").alias(name) for name, at in positions.items()])


def read_client_log(spark: SparkSession, source: Paths, format: str = "parquet") -> DataFrame:
    return _columnar(spark, source, format, schemas.CLIENT_LOG_POSITIONS)


def read_exposure(spark: SparkSession, source: Paths, format: str = "parquet") -> DataFrame:
    return _columnar(spark, source, format, schemas.EXPOSURE_POSITIONS)


def read_item_meta(
    spark: SparkSession, source: str, day: str, min_duration: float = 5, format: str = "table"
) -> DataFrame:
    """Metadata of one day, items longer than ``min_duration``."""
    df = spark.table(source) if format == "table" else spark.read.format(format).load(source)
    return item_meta_of(df, day, min_duration)


def item_meta_of(meta: DataFrame, day: str, min_duration: float = 5) -> DataFrame:
    return meta.where((F.col("dt") == day) & (F.col("object_duration") > min_duration)).select(
        "mid", "uid", "object_id"
    )


def read_factors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_shards(spark: SparkSession, base: str, shards: Iterable[int], column: str = "shard") -> DataFrame:
    """Rows of the listed shards; other directories are not opened."""
    return spark.read.parquet(base).where(F.col(column).isin(*shards))


def last_days(df: DataFrame, day: str, n: int, from_day: int = 1, column: str = "dt") -> DataFrame:
    """Rows of the ``n``th to the ``from_day``th day before ``day`` (yyyyMMdd).

    The bounds are literals, so a table partitioned by day is pruned.  Days
    that are not there simply bring no rows.
    """
    base = dt.datetime.strptime(day, "%Y%m%d").date()
    first, last = base - dt.timedelta(days=n), base - dt.timedelta(days=from_day)
    if isinstance(df.schema[column].dataType, T.DateType):
        return df.where(F.col(column).between(F.lit(first), F.lit(last)))
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.where(F.col(column).between(f"{first:%Y%m%d}", f"{last:%Y%m%d}"))
    return df.where(F.col(column).between(int(f"{first:%Y%m%d}"), int(f"{last:%Y%m%d}")))


def read_id_list(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Text dictionary ``real<tab>num_kind`` -> (real_id, num_id, kind)."""
    text = _tab_text(
        spark,
        path,
        T.StructType([T.StructField("real_id", T.StringType()), T.StructField("num", T.StringType())]),
    )
    return text.select(
        "real_id", lists.parse_num_id(F.col("num")).alias("num_id"), F.lit(kind).alias("kind")
    )


def read_scored_lists(spark: SparkSession, paths: Paths) -> DataFrame:
    """``u_m:s<tab>m:s`` lines -> (user, items array<struct<item, score>>)."""
    line = F.col("value")
    items = F.transform(
        lists.scored_list_items(line),
        lambda e: F.struct(e["mid"].try_cast("bigint").alias("item"), e["score"].alias("score")),
    )
    return _lines(spark, paths).select(
        lists.scored_list_owner(line).try_cast("bigint").alias("user"), items.alias("items")
    )


def read_candidates(spark: SparkSession, paths: Paths, sep: str = "\t") -> DataFrame:
    """``u<sep>m,m`` lines -> (uid, mids); a line without items is left out."""
    line = F.col("value")
    return (
        _lines(spark, paths)
        .select(
            lists.candidate_owner(line, sep).alias("uid"),
            lists.candidate_mids(line, sep).alias("mids"),
        )
        .where(F.col("mids").isNotNull())
    )


def read_new_lists(spark: SparkSession, paths: Paths) -> DataFrame:
    return _tab_text(spark, paths, schemas.NEW_LISTS)


def read_state(spark: SparkSession, paths: Paths) -> DataFrame:
    """Text state ``uid<tab>list<tab>ttl``."""
    return _tab_text(spark, paths, schemas.STATE)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
