"""Reports on the client log and the exposure log.

Every report filters on plain columns before it looks into the property bag,
and counts distinct users in two combining steps.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import guards as g
from feedmill.functions.props import PAIR, REST, framed, prop, readable, repeats
from feedmill.functions.values import event_time, filled, strict_int
from feedmill.operators.popularity import count_per
from feedmill.operators.quality import KEPT, first_failure
from feedmill.operators.steps import derive


def _plays_on(log: DataFrame, *pages: str) -> DataFrame:
    """Plays on the given pages with their framed property bag."""
    plays = log.where(
        g.is_play(F.col("action")) & g.on_page(F.col("uicode"), pages) & filled(F.col("extend"))
    )
    return plays.withColumn("bag", framed(F.col("extend")))


def _member_plays_on(
    log: DataFrame, uicode: str, keep: list[str], fields: dict[str, Column]
) -> DataFrame:
    """Plays of named members; the bag must be readable and name one page at most."""
    members = log.where(filled(F.col("uid")) & g.is_member(F.col("uid")))
    bag = F.col("bag")
    read = derive(
        _plays_on(members, uicode),
        keep,
        {"usable": readable(bag, REST) & ~repeats(bag, "page"), **fields},
    )
    return read.where("usable").drop("usable")


def _rest(key: str) -> Column:
    return prop(F.col("bag"), key, REST)


def _pair(key: str) -> Column:
    return prop(F.col("bag"), key, PAIR)


# --- diversion plays -------------------------------------------------------


def _diversion_plays(log: DataFrame, keep: list[str], fields: dict[str, Column]) -> DataFrame:
    """Plays longer than the bound whose index does not mark a recommended video."""
    read = derive(
        _plays_on(log, g.DETAIL_PAGE, g.FEED_PAGE),
        keep,
        {
            "watched": _pair("valid_play_duration"),
            "index": _pair("index"),
            "mid": _pair("mid"),
            **fields,
        },
    )
    watched = strict_int(F.col("watched"))
    return read.where((watched > g.LONG_PLAY_MS) & filled(F.col("mid")))


def diversion_records(log: DataFrame) -> DataFrame:
    """(uid, mid) of diversion plays; a negative index is let through."""
    members = log.where(filled(F.col("uid")) & g.is_member(F.col("uid")))
    plays = _diversion_plays(members, ["uid"], {"scene": _pair("recom_scene")})
    return plays.where(
        g.not_recommended(F.col("index")) & ~F.col("scene").eqNullSafe("1")
    ).select("uid", "mid")


def diversion_counts(records: DataFrame) -> DataFrame:
    """Diversion plays per item."""
    return count_per(records, "mid")


def diversion_events(log: DataFrame) -> DataFrame:
    """(time_ms, uid, authorid, mid) of diversion plays, guests and scenes included."""
    timed = log.where(filled(F.col("uid")) & filled(F.col("day_key")))
    plays = _diversion_plays(timed, ["uid", "day_key"], {"authorid": _pair("authorid")})
    events = plays.where(g.is_entry_video(F.col("index")) & filled(F.col("authorid")))
    return events.select(
        F.unix_millis(event_time(F.col("day_key"))).alias("time_ms"), "uid", "authorid", "mid"
    ).where(F.col("time_ms").isNotNull())


# --- consumption -----------------------------------------------------------


def daily_consume(log: DataFrame) -> DataFrame:
    """Feed plays per member, of any length."""
    members = log.where(filled(F.col("uid")) & g.is_member(F.col("uid")))
    read = derive(
        _plays_on(members, g.FEED_PAGE),
        ["uid"],
        {"mid": _pair("mid"), "scene": _pair("recom_scene")},
    )
    return count_per(read.where(filled(F.col("mid")) & ~F.col("scene").eqNullSafe("1")), "uid")


def tab_consumers(log: DataFrame, exclude_clients: Iterable[str] = ()) -> DataFrame:
    """uid of every long play in the video tab, one row per play."""
    plays = _member_plays_on(
        log.where(filled(F.col("from"))),
        g.TAB_PAGE,
        ["uid", "from"],
        {
            "watched": _rest("valid_play_duration"),
            "index": _rest("index"),
            "page": _rest("page"),
        },
    )
    kind = g.client(F.col("from"))
    return plays.where(
        (strict_int(F.col("watched")) >= g.LONG_PLAY_MS)
        & F.col("index").isNotNull()
        & F.col("page").isNotNull()
        & _client_allowed(kind, exclude_clients)
    ).select("uid")


def _client_allowed(kind: Column, excluded: Iterable[str]) -> Column:
    excluded = list(excluded)
    return kind.isNotNull() & ~kind.isin(*excluded) if excluded else kind.isNotNull()


def find_users(log: DataFrame) -> DataFrame:
    """(uid, duration) of long plays that came from the find page, one row per play."""
    plays = _member_plays_on(
        log.where(
            g.came_from_find(F.col("previous_id"), F.col("root_uicode")) & filled(F.col("from"))
        ),
        g.FEED_PAGE,
        ["uid"],
        {"duration": _rest("playduration")},
    )
    return plays.select("uid", strict_int(F.col("duration")).alias("duration")).where(
        F.col("duration") >= g.LONG_PLAY_MS
    )


# --- reject causes ---------------------------------------------------------


def _causes(
    log: DataFrame, plain: dict[str, Column], keys: dict[str, Column], rest: dict[str, Column]
) -> DataFrame:
    """(cause, n) by the first guard a record fails; its bag is read only if none of ``plain`` did."""
    passed = F.col("plain") == KEPT
    checked = log.select("*", first_failure(plain).alias("plain"))
    read = derive(
        checked.withColumn("bag", F.when(passed, framed(F.col("extend")))), ["from", "plain"], keys
    )
    cause = F.when(passed, first_failure(rest)).otherwise(F.col("plain"))
    return count_per(read.select(cause.alias("cause")), "cause")


def tab_consumer_causes(log: DataFrame, exclude_clients: Iterable[str] = ()) -> DataFrame:
    """Why records are left out of ``tab_consumers``; its rows are the kept ones."""
    bag = F.col("bag")
    watched = strict_int(F.col("watched"))
    return _causes(
        log,
        {
            "no_uid": filled(F.col("uid")),
            "guest": g.is_member(F.col("uid")),
            "other_action": g.is_play(F.col("action")),
            "no_uicode": filled(F.col("uicode")),
            "other_page": g.on_page(F.col("uicode"), [g.TAB_PAGE]),
            "no_from": filled(F.col("from")),
            "no_extend": filled(F.col("extend")),
        },
        {
            "two_pages": repeats(bag, "page"),
            "readable": readable(bag, REST),
            "watched": _rest("valid_play_duration"),
            "index": _rest("index"),
            "page": _rest("page"),
        },
        {
            "two_pages": ~F.col("two_pages"),
            "unreadable": F.col("readable"),
            "no_duration": F.col("watched").isNotNull(),
            "bad_duration": watched.isNotNull(),
            "short": watched >= g.LONG_PLAY_MS,
            "no_index_or_page": F.col("index").isNotNull() & F.col("page").isNotNull(),
            "other_client": _client_allowed(g.client(F.col("from")), exclude_clients),
        },
    )


def diversion_causes(log: DataFrame) -> DataFrame:
    """Why records are left out of ``diversion_records``; its rows are the kept ones."""
    watched = strict_int(F.col("watched"))
    return _causes(
        log,
        {
            "other_action": g.is_play(F.col("action")),
            "other_page": g.on_page(F.col("uicode"), [g.DETAIL_PAGE, g.FEED_PAGE]),
            "no_extend": filled(F.col("extend")),
            "no_uid": filled(F.col("uid")),
            "guest": g.is_member(F.col("uid")),
        },
        {
            "watched": _pair("valid_play_duration"),
            "scene": _pair("recom_scene"),
            "index": _pair("index"),
            "mid": _pair("mid"),
        },
        {
            "no_duration": F.col("watched").isNotNull(),
            "short_or_bad_duration": watched > g.LONG_PLAY_MS,
            "scene": ~F.col("scene").eqNullSafe("1"),
            "recommended": g.not_recommended(F.col("index")),
            "no_mid": filled(F.col("mid")),
        },
    )


# --- exposure --------------------------------------------------------------


def author_exposure(exposure: DataFrame) -> DataFrame:
    """Distinct discover items per author; an item without an author is skipped."""
    shown = exposure.where(F.col("type") == "discover").select(
        F.explode(F.split(F.trim("recom_list"), ",")).alias("item")
    )
    parts = F.split(F.trim("item"), r"\|")
    pairs = shown.select(F.get(parts, F.lit(0)).alias("mid"), F.get(parts, F.lit(1)).alias("author"))
    return items_per_author(pairs.where(filled(F.col("author"))))


def items_per_author(items: DataFrame) -> DataFrame:
    """(mid, author) -> distinct items per author."""
    return items.groupBy("author").agg(F.count_distinct("mid").alias("n"))


# --- feed depth and traffic source ----------------------------------------

MAX_DEPTH = 11


def depth_plays(log: DataFrame, exclude_clients: Iterable[str] = ()) -> DataFrame:
    """(uid, tail, depth, duration) of plays in the video tab."""
    plays = _member_plays_on(
        log.where(filled(F.col("from"))),
        g.TAB_PAGE,
        ["uid", "from"],
        {
            "duration": _rest("valid_play_duration"),
            "index": _rest("index"),
            "page": _rest("page"),
        },
    )
    kind = g.client(F.col("from"))
    placed = derive(
        plays.where(_client_allowed(kind, exclude_clients)),
        ["uid"],
        {
            "tail": g.user_tail(F.col("uid")),
            "depth": g.feed_depth(kind, F.col("page"), F.col("index")),
            "duration": strict_int(F.col("duration")),
        },
    )
    return placed.where(
        F.col("tail").isNotNull() & (F.col("depth") != 0) & F.col("duration").isNotNull()
    ).select(
        "uid", "tail", F.least("depth", F.lit(MAX_DEPTH)).alias("depth"), "duration"
    )


def depth_report(log: DataFrame, exclude_clients: Iterable[str] = ()) -> DataFrame:
    """(tail, depth, pv, uv, duration, class): long plays and all plays."""
    return depth_totals(depth_plays(log, exclude_clients))


def depth_totals(plays: DataFrame) -> DataFrame:
    """The report from ``depth_plays``.

    Users are collapsed first, so a distinct user count is a plain count and
    a popular position is spread over its users.
    """
    long_play = F.col("duration") > g.LONG_PLAY_MS
    per_user = (
        plays.groupBy("tail", "depth", "uid")
        .agg(
            F.count_if(long_play).alias("long_pv"),
            F.sum(F.when(long_play, F.col("duration")).otherwise(0)).alias("long_ms"),
            F.count(F.lit(1)).alias("pv"),
            F.sum("duration").alias("ms"),
        )
    )
    totals = per_user.groupBy("tail", "depth").agg(
        F.sum("long_pv").alias("long_pv"),
        F.count_if(F.col("long_pv") > 0).alias("long_uv"),
        F.sum("long_ms").alias("long_ms"),
        F.sum("pv").alias("pv"),
        F.count(F.lit(1)).alias("uv"),
        F.sum("ms").alias("ms"),
    )
    return totals.selectExpr(
        "tail",
        "depth",
        "stack(2, long_pv, long_uv, long_ms, 'largereal', pv, uv, ms, 'lessall')"
        " AS (pv, uv, duration, class)",
    )


def source_plays(log: DataFrame) -> DataFrame:
    """(tail, code, index, source, long) of feed plays."""
    text = ("page", "index", "recom_code", "valid_play_duration")
    plays = _member_plays_on(
        log,
        g.FEED_PAGE,
        ["uid", "previous_id", "root_uicode"],
        {name: _rest(name) for name in text},
    )

    def number(name: str, default: str) -> Column:
        text = F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default))
        return strict_int(text).cast("bigint")

    placed = derive(
        plays,
        ["previous_id", "root_uicode", "recom_code"],
        {
            "tail": g.user_tail(F.col("uid")),
            "index": (number("page", "1") - 1) * 10 + number("index", "0"),
            "duration": strict_int(F.col("valid_play_duration")),
        },
    )
    code = F.when(F.col("index") == 0, g.DIVERSION_CODE).otherwise(
        F.nullif(F.col("recom_code"), F.lit(""))
    )
    found = g.came_from_find(F.col("previous_id"), F.col("root_uicode")) & (F.col("index") != 0)
    return placed.where(
        F.col("tail").isNotNull() & F.col("index").isNotNull() & F.col("duration").isNotNull()
    ).select(
        "tail",
        code.alias("code"),
        "index",
        F.when(found, "find").otherwise("vvs").alias("source"),
        (F.col("duration") > g.LONG_PLAY_MS).alias("long"),
    ).where(F.col("code").isNotNull())


def source_report(log: DataFrame) -> DataFrame:
    """(tail, code, index, source, less3, large3): two rows per key, also when zero."""
    return source_totals(source_plays(log))


def source_totals(plays_: DataFrame) -> DataFrame:
    """The report from ``source_plays``."""

    def plays(source: str, long: bool) -> Column:
        is_long = F.col("long") if long else ~F.col("long")
        return F.count_if((F.col("source") == source) & is_long)

    totals = plays_.groupBy("tail", "code", "index").agg(
        plays("vvs", False).alias("vvs_less3"),
        plays("vvs", True).alias("vvs_large3"),
        plays("find", False).alias("find_less3"),
        plays("find", True).alias("find_large3"),
    )
    return totals.selectExpr(
        "tail",
        "code",
        "index",
        "stack(2, 'vvs', vvs_less3, vvs_large3, 'find', find_less3, find_large3)"
        " AS (source, less3, large3)",
    )
