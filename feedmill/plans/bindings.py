"""The sample tables in the shape of the engine's own tables.

Each binding is plain arithmetic on whole tables, so that an oracle can work
from the source columns without going through the text the engine parses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ACTION_OF_EVENT = {"view": "play", "click": "attitude", "purchase": "repost", "signup": "comment"}
META_DAY = "20240101"
LIST_LENGTH = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column) -> Column:
    return column.cast("string")


def _pair(key: str, value: Column) -> Column:
    """``key:value``, NULL for a NULL value, which ``concat_ws`` then leaves out."""
    return F.concat(F.lit(f"{key}:"), _text(value))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    member, guest = F.lit(1_000_000), F.lit(100_000_000_000)
    return table(spark, sf_dir, "events").select(
        e.alias("e"),
        "event_type",
        "ts",
        _text(F.when(e % 101 == 0, guest).otherwise(member) + F.col("user_id")).alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.floor(F.col("value") * 100).cast("bigint").alias("watched"),
    )


def behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = F.col("e"), F.col("k")
    action = F.col("event_type")
    for event, name in ACTION_OF_EVENT.items():
        action = F.when(F.col("event_type") == event, name).otherwise(action)
    extend = F.concat_ws(
        "|",
        _pair("valid_play_duration", F.col("watched")),
        # A pair without a value spoils the bag of a play.
        F.when(e % 83 == 0, "object_duration").otherwise(
            _pair("object_duration", F.when(k == 7, 0).otherwise(10000 + 100 * k))
        ),
        _pair("index", F.when(e % 11 != 0, e % 3)),
    )
    return _events(spark, sf_dir).select(
        "uid", action.alias("action"), _text(2_000_000 + k).alias("mid"), extend.alias("extend")
    )


def _digit(divisor: int, base: int) -> Column:
    """A digit of the event id, so that the columns vary independently."""
    return F.floor(F.col("e") / divisor) % base


def _choice(digit: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), digit.cast("int") + 1)


def client_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = F.col("e"), F.col("k")
    page = _pair("page", _digit(117, 4))
    extend = F.concat_ws(
        "|",
        # An earlier pair of the same key and a value with colons change nothing.
        F.when(e % 79 == 0, "valid_play_duration:1"),
        F.when(e % 7 == 0, "note:a:b"),
        _pair("mid", F.when(e % 97 != 0, 2_000_000 + k)),
        _pair("authorid", k % 10),
        _pair("valid_play_duration", F.col("watched")),
        _pair("playduration", F.col("watched")),
        _pair("index", _digit(9, 13)),
        page,
        F.when(e % 89 == 0, page),
        F.when(e % 13 == 0, "recom_scene:1"),
        _pair("recom_code", F.when(e % 17 != 0, 4001 + k % 3)),
    )
    return _events(spark, sf_dir).select(
        F.concat(F.lit("x|"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("day_key"),
        "uid",
        F.when(F.col("event_type") != "error", "799").otherwise("800").alias("action"),
        _choice(e % 3, "10000376", "10000756", "10000789").alias("uicode"),
        _choice(_digit(9, 4), "231553", "231091", "231278", "0").alias("previous_id"),
        _choice(_digit(36, 2), "10000700", "10000000").alias("root_uicode"),
        F.concat(F.lit("10862"), _choice(_digit(3, 3), "95010", "93010", "99999")).alias("from"),
        extend.alias("extend"),
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    return lines.join(orders, "l_orderkey")


def exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two items a line, the second of them without an author on every first line."""
    second = F.when(
        F.col("l_linenumber") != 1,
        F.concat_ws("|", F.col("l_partkey") + 1, F.col("l_suppkey"), F.lit("x")),
    ).otherwise(_text(F.col("l_partkey") + 1))
    first = F.concat_ws("|", F.col("l_partkey"), F.col("l_suppkey"), F.lit("x"))
    shown = F.substring("o_orderpriority", 1, 1).isin("1", "2")
    return _order_lines(spark, sf_dir).select(
        F.when(shown, "discover").otherwise("hot").alias("type"),
        F.concat_ws(",", first, second).alias("recom_list"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid, dt): parts bought."""
    return _order_lines(spark, sf_dir).select(
        _text(F.col("o_custkey")).alias("uid"),
        _text(F.col("l_partkey")).alias("mid"),
        F.col("o_orderdate").cast("date").alias("dt"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid) with ids whose tails collide."""
    return _order_lines(spark, sf_dir).select(
        _text(1_000_000 + F.col("o_custkey") * 7919).alias("uid"),
        _text(20_000_000 + F.col("l_partkey") * 104_729).alias("mid"),
    )


def one_sided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid) of all order lines; only every tenth order keeps its own, the others name the first part."""
    part = F.when(F.col("l_orderkey") % 10 == 0, F.col("l_partkey")).otherwise(F.col("_first"))
    lines = table(spark, sf_dir, "lineitem")
    first = lines.agg(F.min("l_partkey")).scalar()
    return lines.select("*", first.alias("_first")).select(_text(20_000_000 + part * 104_729).alias("mid"))


def _rows(spark: SparkSession, sf_dir: str, name: str) -> Column:
    """Rows of a table, as one value that the plan computes."""
    return table(spark, sf_dir, name).agg(F.count(F.lit(1))).scalar()


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of 50 parts of the whole catalogue per customer, the last five of them repeated."""
    c = F.col("c_custkey")
    catalogue = _rows(spark, sf_dir, "part")
    mids = F.transform(
        F.sequence(F.lit(0), F.lit(LIST_LENGTH - 1)),
        lambda p: _text((c * 31 + (p % 45) * 37) % F.col("_parts")),
    )
    # A customer is a few bytes in a file and fifty rows later on: without this a task or two would make all of them.
    # The number of partitions is given, as keys are too few bytes for adaptive execution to leave them apart.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    customers = table(spark, sf_dir, "customer").select("c_custkey").repartition(tasks, "c_custkey")
    return customers.select("c_custkey", catalogue.alias("_parts")).select(_text(c).alias("uid"), mids.alias("mids"))


def item_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        _text(p).alias("mid"),
        _text(p % 100).alias("uid"),
        F.concat(F.lit("1034:"), _text(p)).alias("object_id"),
        F.col("p_size").cast("double").alias("object_duration"),
        F.lit(META_DAY).alias("dt"),
    )


def base_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a list; every seventh one has an empty list."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        _text(c).alias("uid"),
        F.when(c % 7 == 0, "").otherwise(F.concat(F.lit("base-"), _text(c))).alias("list"),
        (1 + c % 30).cast("int").alias("ttl"),
    )


def spoilt_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base with a ttl that could not be read on every eleventh row."""
    c = F.col("uid").cast("bigint")
    return base_state(spark, sf_dir).withColumn("ttl", F.when(c % 11 != 0, F.col("ttl")))


def members_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base of which every user with an even number took part in events, so that today's lists meet it."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    u = F.col("user_id")
    return users.where(u % 2 == 0).select(
        _text(1_000_000 + u).alias("uid"), F.concat(F.lit("base-"), _text(u)).alias("list"), (1 + u % 3).cast("int").alias("ttl")
    )


def nameless_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base with no user on every thirteenth row."""
    c = F.col("uid").cast("bigint")
    return base_state(spark, sf_dir).withColumn("uid", F.when(c % 13 != 0, F.col("uid")))


def odd_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid) of all order lines, some of the ids too short or without digits at their end."""
    customer, part = F.col("o_custkey"), F.col("l_partkey")
    return _order_lines(spark, sf_dir).select(
        F.when(customer % 9 == 0, F.concat(F.lit("user"), _text(customer), F.lit("x")))
        .otherwise(_text(1_000_000 + customer)).alias("uid"),
        _text(part).alias("mid"),
    )


def new_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of four customers who ever ordered; every fiftieth one has an empty list."""
    c = F.col("o_custkey")
    buyers = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    return buyers.where(c % 4 != 0).select(
        _text(c).alias("uid"),
        F.when(c % 50 == 0, "").otherwise(F.concat(F.lit("new-"), _text(c))).alias("list"),
    )


def exported_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State with a few uids that are no numbers and payloads too short to keep."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(c % 41 == 0, F.concat(F.lit("g"), _text(c))).otherwise(_text(c)).alias("uid"),
        F.when(c % 37 == 0, "-").otherwise(F.concat(F.lit("list-"), _text(c))).alias("list"),
        (1 + c % 30).cast("int").alias("ttl"),
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector, in the role of a user and of an item alike."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("features"),
        F.col("label").alias("cluster"),
    )


def uneven_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors at very different lengths, as the items of a fitted model have them."""
    weight = 1.0 / (1 + F.col("id") % 97)
    scaled = F.transform(F.col("features").cast("array<double>"), lambda x: x * weight)
    return factors(spark, sf_dir).withColumn("features", scaled)


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item, rating): every vector with another one, its label as the rating."""
    v = F.col("vec_id")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", _rows(spark, sf_dir, "embeddings").alias("n"))
    return vectors.select(v.alias("user"), ((v * 7 + 3) % F.col("n")).alias("item"), F.col("label").alias("rating"))


def factor_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary of the vectors for both kinds."""
    v = F.col("vec_id")
    entry = F.explode(
        F.array(
            F.struct(F.concat(F.lit("u"), _text(v)).alias("real_id"), F.lit("uid").alias("kind")),
            F.struct(F.concat(F.lit("m"), _text(v)).alias("real_id"), F.lit("mid").alias("kind")),
        )
    )
    return (
        table(spark, sf_dir, "embeddings")
        .select(v.alias("num_id"), entry.alias("entry"))
        .select("entry.real_id", "num_id", "entry.kind")
    )
