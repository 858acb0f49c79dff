"""Rules of the log reports: the same rows as the reports, and a cause for every other record."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from feedmill.operators import causes, logstats
from feedmill.operators.popularity import count_per
from feedmill.operators.quality import RunCounters
from feedmill.plans import bindings as b
from feedmill.plans import reports

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ("day_key", "uid", "action", "uicode", "previous_id", "root_uicode", "from", "extend")
FEED = {"uicode": "10000756", "extend": "page:1|index:2|playduration:3000|valid_play_duration:4000|mid:m1"}
FOUND = FEED | {"previous_id": "231553", "root_uicode": "10000700"}
TAB = {"uicode": "10000789", "extend": "page:0|index:3|valid_play_duration:4000"}


def log(spark, *records):
    base = dict.fromkeys(COLUMNS, "") | {"uid": "1234567", "action": "799", "from": "1086295010"}
    rows = [tuple((base | r)[c] for c in COLUMNS) for r in records]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))


def counts(df):
    return {r["cause"]: r["n"] for r in df.collect()}


COMMON = [
    ({"uid": ""}, "no_uid"),
    ({"uid": None}, "no_uid"),
    ({"uid": "1" * 12}, "guest"),
    ({"action": "800"}, "other_action"),
    ({"action": None}, "other_action"),
    ({"uicode": ""}, "no_uicode"),
    ({"uicode": "1"}, "other_page"),
    ({"extend": None}, "no_extend"),
    ({"extend": "page:1|page:1"}, "two_pages"),
    ({"extend": "page:1|:|index:2"}, "unreadable"),
]
CASES = {
    "find_users": (FOUND, COMMON + [
        ({"previous_id": ""}, "no_previous"),
        ({"previous_id": "1"}, "other_previous"),
        ({"root_uicode": None}, "no_root"),
        ({"root_uicode": "1"}, "other_root"),
        ({"from": ""}, "no_from"),
        ({"extend": "page:1"}, "no_duration"),
        ({"extend": "playduration:x"}, "bad_duration"),
        ({"extend": "playduration:2999"}, "short"),
    ]),
    "depth": (TAB, COMMON + [
        ({"from": ""}, "no_from"),
        ({"extend": "page:0|index:3"}, "no_duration"),
        ({"extend": "page:0|valid_play_duration:1"}, "no_index_or_page"),
        ({"from": "010"}, "other_client"),
        ({"from": "1086299999"}, "zero_depth"),
        ({"extend": "page:0|index:0|valid_play_duration:1"}, "zero_depth"),
        ({"extend": "page:0|index:x|valid_play_duration:1"}, "bad_number"),
        ({"extend": "page:0|index:1|valid_play_duration:x"}, "bad_number"),
        ({"uid": "12"}, "short_uid"),
    ]),
    "source": (FEED | {"extend": FEED["extend"] + "|recom_code:7"}, COMMON + [
        ({"extend": "page:1|index:2"}, "no_duration"),
        ({"extend": "valid_play_duration:9.5"}, "bad_duration"),
        ({"extend": "page:x|valid_play_duration:9"}, "bad_number"),
        ({"extend": "page:1|index:2|valid_play_duration:9"}, "no_code"),
        ({"uid": "12"}, "short_uid"),
    ]),
    "daily_consume": (FEED, [c for c in COMMON if c[1] not in ("two_pages", "unreadable")] + [
        ({"extend": "index:2"}, "no_mid"),
        ({"extend": "mid:m|recom_scene:1"}, "scene"),
    ]),
    "tab_consumers": (TAB, COMMON + [
        ({"extend": "page:0|index:3|valid_play_duration:2999"}, "short"),
        ({"extend": "valid_play_duration:3000"}, "no_index_or_page"),
        ({"from": "010"}, "other_client"),
    ]),
}


def rule_of(name):
    return getattr(causes, f"{name}_rule")()


@pytest.mark.parametrize("name", CASES)
def test_each_record_has_its_cause(spark, name):
    kept, cases = CASES[name]
    expected = {"kept": 2}
    for _, cause in cases:
        expected[cause] = expected.get(cause, 0) + 1
    records = log(spark, kept, kept, *[kept | change for change, _ in cases])
    assert counts(causes.cause_counts(records, rule_of(name))) == expected
    seen = Observation()
    rows = causes.kept_rows(records, rule_of(name), seen)
    assert len(rows.collect()) == 2
    assert {c: n for c, n in seen.get.items() if n} == expected


@pytest.mark.parametrize("name", CASES)
def test_an_empty_log_gives_nothing(spark, name):
    empty = log(spark, {}).limit(0)
    assert counts(causes.cause_counts(empty, rule_of(name))) == {}
    assert causes.kept_rows(empty, rule_of(name)).collect() == []


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_kept_rows_are_the_reports_input(spark):
    table = b.client_log(spark, SF_DIR)
    same(causes.kept_rows(table, causes.find_users_rule()), logstats.find_users(table))
    same(causes.kept_rows(table, causes.depth_rule()), logstats.depth_plays(table))
    same(causes.kept_rows(table, causes.depth_rule(("android",))), logstats.depth_plays(table, ("android",)))
    same(causes.kept_rows(table, causes.source_rule()), logstats.source_plays(table))
    same(causes.kept_rows(table, causes.tab_consumers_rule()), logstats.tab_consumers(table))
    same(causes.kept_rows(table, causes.diversion_rule()), logstats.diversion_records(table))
    same(count_per(causes.kept_rows(table, causes.daily_consume_rule()), "uid"), logstats.daily_consume(table))
    assert counts(causes.cause_counts(table, causes.diversion_rule())) == counts(logstats.diversion_causes(table))


def test_exposure_causes(spark):
    rows = [("discover", "m1|a1|x,m2|a1|x,m1|a1|x"), ("discover", "m3,m4|a2"), ("hot", "m5|a3"), (None, "m6|a"), ("discover", None)]
    shown = spark.createDataFrame(rows, "type string, recom_list string")
    expected = {"other_type": 2, "no_list": 1, "no_author": 1, "kept": 4}
    assert counts(causes.exposure_causes(shown)) == expected
    seen = Observation()
    found = logstats.items_per_author(causes.exposed_items(shown, seen))
    same(found, logstats.author_exposure(shown))
    assert seen.get == expected


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_a_run_of_reports_counts_what_it_leaves_out(spark, tmp_path):
    table, shown = b.client_log(spark, SF_DIR), b.exposure(spark, SF_DIR)
    found = reports.run_reports(table, shown, str(tmp_path))
    assert {k: v for k, v in found["depth_report"].items() if v} == counts(causes.cause_counts(table, causes.depth_rule()))
    assert {k: v for k, v in found["author_exposure"].items() if v} == counts(causes.exposure_causes(shown))
    same(spark.read.parquet(f"{tmp_path}/depth_report").select("tail", "depth", "pv", "uv", "duration", "class"), logstats.depth_report(table))
    assert sum(found["find_users"].values()) == table.count()


def test_a_name_is_observed_once(spark):
    counters = RunCounters()
    df = spark.range(5).observe(counters.watch("a"), F.count_if(F.col("id") > 2).alias("x"))
    with pytest.raises(ValueError, match="a is observed already"):
        counters.watch("a")
    df.collect()
    assert counters.counts() == {"a": {"x": 2}}
