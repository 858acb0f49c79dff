"""Why records are left out of the log reports, and counters that come with a report's own pass.

A rule names the guards of a report in the order in which they are asked.  The same rule gives the report's
rows, the counts by cause, and both at once: an observed pass counts every record by its cause while the kept
ones go on, so a counter costs no scan of its own.

Counts of an observed pass are those of the tasks that ran.  A stage that runs again after a lost executor may
count its records again; ``cause_counts`` is exact whatever happens, for one more pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedmill.functions import guards as g
from feedmill.functions.props import PAIR, REST, framed, prop, readable, repeats
from feedmill.functions.values import filled, strict_int
from feedmill.operators.popularity import count_per
from feedmill.operators.quality import KEPT, counted, first_failure
from feedmill.operators.steps import derive


@dataclass(frozen=True)
class Rule:
    """Guards on plain columns, keys of the bag, values made of them, guards on those, and the columns of a kept row."""

    plain: Mapping[str, Column]
    keys: Mapping[str, Column]
    rest: Mapping[str, Column]
    out: Mapping[str, Column]
    made: Mapping[str, Column] = field(default_factory=dict)
    base: tuple[str, ...] = ("uid", "from", "previous_id", "root_uicode")

    @property
    def causes(self) -> list[str]:
        return [*self.plain, *self.rest, KEPT]


def _classified(log: DataFrame, rule: Rule) -> DataFrame:
    """Every record with the first guard that it fails as ``cause``; a bag is read only if no plain guard failed."""
    passed = F.col("plain") == KEPT
    checked = log.select("*", first_failure(rule.plain).alias("plain"))
    bags = checked.withColumn("bag", F.when(passed, framed(F.col("extend"))))
    read = derive(bags, [*rule.base, "plain"], rule.keys)
    if rule.made:
        read = derive(read, read.columns, rule.made)
    cause = F.when(passed, first_failure(rule.rest)).otherwise(F.col("plain"))
    return derive(read, read.columns, {"cause": cause})


def cause_counts(log: DataFrame, rule: Rule) -> DataFrame:
    """(cause, n); ``kept`` has the records that the report works on."""
    return count_per(_classified(log, rule).select("cause"), "cause")


def kept_rows(log: DataFrame, rule: Rule, observation: Observation | None = None) -> DataFrame:
    """The report's rows; with an observation their pass counts all records by cause."""
    read = _classified(log, rule)
    if observation is not None:
        read = counted(read, observation, {c: F.col("cause") == c for c in rule.causes})
    return read.where(F.col("cause") == KEPT).select(*[c.alias(n) for n, c in rule.out.items()])


# --- the rules -------------------------------------------------------------


def _value(key: str, rule: str) -> Column:
    return prop(F.col("bag"), key, rule)


def _member() -> dict[str, Column]:
    return {"no_uid": filled(F.col("uid")), "guest": g.is_member(F.col("uid"))}


def _play_on(*pages: str) -> dict[str, Column]:
    return {
        "other_action": g.is_play(F.col("action")),
        "no_uicode": filled(F.col("uicode")),
        "other_page": g.on_page(F.col("uicode"), pages),
    }


def _there(*columns: str) -> dict[str, Column]:
    return {f"no_{c}": filled(F.col(c)) for c in columns}


def _one_page() -> dict[str, Column]:
    return {"two_pages": ~F.col("two_pages"), "unreadable": F.col("readable")}


def _page_keys(**keys: Column) -> dict[str, Column]:
    bag = F.col("bag")
    return {"two_pages": repeats(bag, "page"), "readable": readable(bag, REST), **keys}


def _client_allowed(excluded: Iterable[str]) -> Column:
    kind = g.client(F.col("from"))
    return kind.isNotNull() & ~kind.isin(*excluded) if excluded else kind.isNotNull()


def find_users_rule() -> Rule:
    """Long plays that came from the find page."""
    duration = strict_int(F.col("text"))
    return Rule(
        plain=_member() | _play_on(g.FEED_PAGE) | {
            "no_previous": filled(F.col("previous_id")),
            "other_previous": F.col("previous_id").isin(*g.FIND_REFERRERS),
            "no_root": filled(F.col("root_uicode")),
            "other_root": F.col("root_uicode") == g.FIND_ROOT,
        } | _there("from", "extend"),
        keys=_page_keys(text=_value("playduration", REST)),
        rest=_one_page() | {
            "no_duration": F.col("text").isNotNull(),
            "bad_duration": duration.isNotNull(),
            "short": duration >= g.LONG_PLAY_MS,
        },
        out={"uid": F.col("uid"), "duration": duration},
    )


def depth_rule(exclude_clients: Iterable[str] = (), max_depth: int = 11) -> Rule:
    """Plays in the video tab at a known depth; a client that is neither Android nor iOS has depth 0."""
    kind = g.client(F.col("from"))
    known = kind.isin(*g.CLIENT_SUFFIX)
    return Rule(
        plain=_member() | _play_on(g.TAB_PAGE) | _there("from", "extend"),
        keys=_page_keys(
            text=_value("valid_play_duration", REST), index=_value("index", REST), page=_value("page", REST)
        ),
        made={
            "tail": g.user_tail(F.col("uid")),
            "depth": F.when(known, g.feed_depth(kind, F.col("page"), F.col("index"))).otherwise(0),
            "duration": strict_int(F.col("text")),
        },
        rest=_one_page() | {
            "no_duration": F.col("text").isNotNull(),
            "no_index_or_page": F.col("index").isNotNull() & F.col("page").isNotNull(),
            "other_client": _client_allowed(tuple(exclude_clients)),
            "bad_number": F.col("depth").isNotNull() & F.col("duration").isNotNull(),
            "zero_depth": F.col("depth") != 0,
            "short_uid": F.col("tail").isNotNull(),
        },
        out={
            "uid": F.col("uid"), "tail": F.col("tail"), "depth": F.least("depth", F.lit(max_depth)),
            "duration": F.col("duration"),
        },
    )


def source_rule() -> Rule:
    """Feed plays with their recommendation code, place and source."""

    def number(name: str, default: str) -> Column:
        text = F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(default))
        return strict_int(text).cast("bigint")

    at_entry = F.col("place") == 0
    found = g.came_from_find(F.col("previous_id"), F.col("root_uicode")) & ~at_entry
    return Rule(
        plain=_member() | _play_on(g.FEED_PAGE) | _there("extend"),
        keys=_page_keys(**{k: _value(k, REST) for k in ("page", "index", "recom_code", "valid_play_duration")}),
        made={
            "tail": g.user_tail(F.col("uid")),
            "place": (number("page", "1") - 1) * 10 + number("index", "0"),
            "duration": strict_int(F.col("valid_play_duration")),
        },
        rest=_one_page() | {
            "no_duration": F.col("valid_play_duration").isNotNull(),
            "bad_duration": F.col("duration").isNotNull(),
            "bad_number": F.col("place").isNotNull(),
            "no_code": at_entry | filled(F.col("recom_code")),
            "short_uid": F.col("tail").isNotNull(),
        },
        out={
            "tail": F.col("tail"),
            "code": F.when(at_entry, g.DIVERSION_CODE).otherwise(F.col("recom_code")),
            "index": F.col("place"),
            "source": F.when(found, "find").otherwise("vvs"),
            "long": F.col("duration") > g.LONG_PLAY_MS,
        },
    )


def daily_consume_rule() -> Rule:
    """Feed plays of members, of any length."""
    return Rule(
        plain=_member() | _play_on(g.FEED_PAGE) | _there("extend"),
        keys={"mid": _value("mid", PAIR), "scene": _value("recom_scene", PAIR)},
        rest={"no_mid": filled(F.col("mid")), "scene": ~F.col("scene").eqNullSafe("1")},
        out={"uid": F.col("uid")},
    )


def tab_consumers_rule(exclude_clients: Iterable[str] = ()) -> Rule:
    """Long plays in the video tab."""
    watched = strict_int(F.col("watched"))
    return Rule(
        plain=_member() | _play_on(g.TAB_PAGE) | _there("from", "extend"),
        keys=_page_keys(
            watched=_value("valid_play_duration", REST), index=_value("index", REST), page=_value("page", REST)
        ),
        rest=_one_page() | {
            "no_duration": F.col("watched").isNotNull(),
            "bad_duration": watched.isNotNull(),
            "short": watched >= g.LONG_PLAY_MS,
            "no_index_or_page": F.col("index").isNotNull() & F.col("page").isNotNull(),
            "other_client": _client_allowed(tuple(exclude_clients)),
        },
        out={"uid": F.col("uid")},
    )


def diversion_rule() -> Rule:
    """Plays longer than the bound whose index does not mark a recommended video."""
    pages = _play_on(g.DETAIL_PAGE, g.FEED_PAGE)
    pages.pop("no_uicode")
    return Rule(
        plain=pages | _there("extend") | _member(),
        keys={
            "watched": _value("valid_play_duration", PAIR), "scene": _value("recom_scene", PAIR),
            "index": _value("index", PAIR), "mid": _value("mid", PAIR),
        },
        rest={
            "no_duration": F.col("watched").isNotNull(),
            "short_or_bad_duration": strict_int(F.col("watched")) > g.LONG_PLAY_MS,
            "scene": ~F.col("scene").eqNullSafe("1"),
            "recommended": g.not_recommended(F.col("index")),
            "no_mid": filled(F.col("mid")),
        },
        out={"uid": F.col("uid"), "mid": F.col("mid")},
    )


# --- exposure --------------------------------------------------------------

EXPOSURE_RECORDS = ("other_type", "no_list")
EXPOSURE_ITEMS = ("no_author", KEPT)


def _exposed(exposure: DataFrame, observation: Observation | None = None) -> DataFrame:
    """(cause, mid, author): a row for each record left out, and for each item of the others."""
    record = first_failure({"other_type": F.col("type") == "discover", "no_list": F.col("recom_list").isNotNull()})
    items = F.when(record == KEPT, F.split(F.trim("recom_list"), ",")).otherwise(F.array(F.lit("")))
    rows = exposure.select(record.alias("record"), F.explode(items).alias("item"))
    parts = F.split(F.trim("item"), r"\|")
    read = rows.select(
        "record", F.get(parts, F.lit(0)).alias("mid"), F.get(parts, F.lit(1)).alias("author")
    )
    cause = F.when(F.col("record") != KEPT, F.col("record")).otherwise(
        first_failure({"no_author": filled(F.col("author"))})
    )
    read = read.select(cause.alias("cause"), "mid", "author")
    if observation is not None:
        read = counted(read, observation, {c: F.col("cause") == c for c in EXPOSURE_RECORDS + EXPOSURE_ITEMS})
    return read


def exposure_causes(exposure: DataFrame) -> DataFrame:
    """(cause, n): records that are left out whole, items without an author, items kept (repeats included)."""
    return count_per(_exposed(exposure).select("cause"), "cause")


def exposed_items(exposure: DataFrame, observation: Observation | None = None) -> DataFrame:
    """(mid, author) of discover items with an author; an observation counts the rest by cause."""
    return _exposed(exposure, observation).where(F.col("cause") == KEPT).select("mid", "author")
