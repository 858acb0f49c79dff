"""Declared schemas. Log data is text on disk, so nothing is ever inferred."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


BEHAVIOUR = _strings("uid", "action", "c2", "mid", "c4", "extend")

PAIRS = _strings("uid", "mid")

CLIENT_LOG = _strings(
    "day_key", "uid", "action", "uicode", "previous_id", "root_uicode", "from", "extend"
)

# Columns of the client log by position, for sources that carry no names.
CLIENT_LOG_POSITIONS = {
    "day_key": 0,
    "uid": 1,
    "action": 2,
    "uicode": 4,
    "previous_id": 6,
    "root_uicode": 8,
    "from": 9,
    "extend": 14,
}

EXPOSURE = _strings("type", "recom_list")
EXPOSURE_POSITIONS = {"type": 8, "recom_list": 9}

ITEM_COUNTS = T.StructType(
    [
        T.StructField("mid", T.StringType()),
        T.StructField("repost", T.LongType()),
        T.StructField("comment", T.LongType()),
        T.StructField("attitude", T.LongType()),
        T.StructField("play", T.LongType()),
    ]
)

GOOD_ITEMS = T.StructType(
    [T.StructField("mid", T.StringType()), T.StructField("score", T.DoubleType())]
)

SCORES = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("mid", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)

ID_LIST = T.StructType(
    [
        T.StructField("real_id", T.StringType()),
        T.StructField("num_id", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)

FACTORS = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("features", T.ArrayType(T.FloatType()))]
)

CANDIDATES = T.StructType(
    [T.StructField("uid", T.StringType()), T.StructField("mids", T.ArrayType(T.StringType()))]
)

ITEM_META = T.StructType(
    [
        T.StructField("mid", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("object_id", T.StringType()),
        T.StructField("object_duration", T.DoubleType()),
        T.StructField("dt", T.StringType()),
    ]
)

RECOMMENDATIONS = T.StructType(
    [
        T.StructField("user", T.LongType()),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [T.StructField("item", T.LongType()), T.StructField("score", T.DoubleType())]
                )
            ),
        ),
    ]
)

ENRICHED = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("items", T.ArrayType(_strings("uid", "type", "id", "oid"))),
    ]
)

NEW_LISTS = _strings("uid", "list")

STATE = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("list", T.StringType()),
        T.StructField("ttl", T.IntegerType()),
    ]
)
