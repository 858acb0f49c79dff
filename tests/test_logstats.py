import pytest
from pyspark.sql import functions as F

from feedmill.functions.guards import client, feed_depth, user_tail
from feedmill.functions.values import event_time, half_up_ratio, strict_int
from feedmill.operators import logstats

COLUMNS = ("day_key", "uid", "action", "uicode", "previous_id", "root_uicode", "from", "extend")
DAY_KEY = "x|2020-07-13 12:00:00"
MS = 1_594_641_600_000


def log(spark, *records):
    base = dict.fromkeys(COLUMNS, "") | {
        "day_key": DAY_KEY,
        "uid": "1234567",
        "action": "799",
        "from": "1086295010",
    }
    rows = [tuple((base | r)[c] for c in COLUMNS) for r in records]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))


def tab(extend, **other):
    return {"uicode": "10000789", "extend": extend} | other


def depth_rows(spark, *records, **options):
    rows = logstats.depth_report(log(spark, *records), **options).collect()
    return sorted(tuple(r) for r in rows)


ANDROID = tab("page:0|index:3|valid_play_duration:4000")
IOS = tab("page:2|index:3|valid_play_duration:3000", **{"from": "1086293010"})
OTHER = tab("page:1|index:3|valid_play_duration:4000", **{"from": "1086299999"})


def test_depth_report_rows(spark):
    assert depth_rows(spark, ANDROID, IOS, OTHER) == [
        ("56", 3, 1, 1, 4000, "largereal"),
        ("56", 3, 1, 1, 4000, "lessall"),
        ("56", 11, 0, 0, 0, "largereal"),
        ("56", 11, 1, 1, 3000, "lessall"),
    ]


def test_depth_report_counts_users_once(spark):
    again = ANDROID | {"extend": "page:0|index:3|valid_play_duration:10"}
    other = ANDROID | {"uid": "7654560"}
    rows = depth_rows(spark, ANDROID, ANDROID, again, other)
    assert ("56", 3, 3, 2, 12000, "largereal") in rows
    assert ("56", 3, 4, 2, 12010, "lessall") in rows


@pytest.mark.parametrize(
    "record",
    [
        tab("page:0|page:1|index:3|valid_play_duration:4000"),
        tab("page:0|index:3|valid_play_duration:4000", uid="12"),
        tab("page:0|index:3|valid_play_duration:soon"),
        tab("page:0|index:0|valid_play_duration:4000"),
        tab("page:0|valid_play_duration:4000"),
        tab("index:3|valid_play_duration:4000"),
        tab("page:0|index:3"),
        tab("page:0|index:3|valid_play_duration:4000", uid="123456789012"),
        tab("page:0|index:3|valid_play_duration:4000", action="800"),
        tab("page:0|index:3|valid_play_duration:4000", **{"from": "10"}),
        tab("page:0|index:3|valid_play_duration:4000", uicode="10000756"),
        tab(""),
    ],
)
def test_depth_report_drops(spark, record):
    assert depth_rows(spark, record) == []


def test_negative_depth_is_kept_and_android_can_be_excluded(spark):
    negative = tab("page:-1|index:3|valid_play_duration:4000")
    assert depth_rows(spark, negative)[0][:2] == ("56", -7)
    assert {r[1] for r in depth_rows(spark, ANDROID, IOS, exclude_clients=("android",))} == {11}


def test_tab_consumers_keep_duplicates_and_other_clients(spark):
    short = tab("page:0|index:3|valid_play_duration:2999")
    empty_index = tab("page:0|index|valid_play_duration:3000")
    rows = logstats.tab_consumers(log(spark, ANDROID, ANDROID, OTHER, short, empty_index)).collect()
    assert [r.uid for r in rows] == ["1234567"] * 4
    only_ios = logstats.tab_consumers(log(spark, ANDROID, IOS, OTHER), ("android",)).collect()
    assert len(only_ios) == 2


def detail(extend, **other):
    return {"uicode": "10000376", "extend": extend} | other


DIVERSIONS = [
    # record, in records, in events
    (detail("mid:m1|authorid:a|valid_play_duration:3000"), 0, 0),
    (detail("mid:m1|authorid:a|valid_play_duration:3001|index:NULL"), 1, 1),
    (detail("mid:m1|authorid:a|valid_play_duration:3001|index"), 1, 1),
    (detail("mid:m1|authorid:a|valid_play_duration:3001"), 1, 1),
    (detail("mid:m1|authorid:a|valid_play_duration:3001|index:0"), 1, 1),
    (detail("mid:m1|authorid:a|valid_play_duration:3001|index:1"), 0, 0),
    (detail("mid:m1|authorid:a|valid_play_duration:3001|index:-1"), 1, 0),
    (detail("mid:m1|authorid:a|valid_play_duration:3001|index:a"), 0, 0),
    (detail("mid:m1|authorid:a|valid_play_duration:3001|recom_scene:1"), 0, 1),
    (detail("mid:m1|authorid:a|valid_play_duration:3001|recom_scene:2"), 1, 1),
    (detail("mid:m1|valid_play_duration:3001"), 1, 0),
    (detail("mid|authorid:a|valid_play_duration:3001"), 0, 0),
    (detail("mid:m1|authorid:a|valid_play_duration:3001", uid="123456789012"), 0, 1),
    (detail("mid:m1|authorid:a|valid_play_duration:3001", uid=""), 0, 0),
    (detail("mid:m1|authorid:a|valid_play_duration:3001", day_key="x"), 1, 0),
    (detail("mid:m1|authorid:a|valid_play_duration:99999999999"), 0, 0),
    (detail("mid:m1|authorid:a|valid_play_duration:3001", uicode="10000789"), 0, 0),
]


def test_diversions(spark):
    for record, in_records, in_events in DIVERSIONS:
        one = log(spark, record)
        assert logstats.diversion_records(one).count() == in_records, record
        assert logstats.diversion_events(one).count() == in_events, record


def test_diversion_event_fields_and_counts(spark):
    plays = log(spark, DIVERSIONS[1][0], DIVERSIONS[3][0])
    assert {tuple(r) for r in logstats.diversion_events(plays).collect()} == {(MS, "1234567", "a", "m1")}
    counts = logstats.diversion_counts(logstats.diversion_records(plays)).collect()
    assert [tuple(r) for r in counts] == [("m1", 2)]


def feed(extend, **other):
    return {"uicode": "10000756", "extend": extend} | other


def test_causes_add_up_with_the_reports(spark):
    records = [r for r, _, _ in DIVERSIONS] + [ANDROID, IOS, OTHER, tab(""), tab("::|page:1"), tab("page:1")]
    everything = log(spark, *records)
    for causes, report in (
        (logstats.diversion_causes, logstats.diversion_records),
        (logstats.tab_consumer_causes, logstats.tab_consumers),
    ):
        counts = {r.cause: r.n for r in causes(everything).collect()}
        assert sum(counts.values()) == len(records)
        assert counts["kept"] == report(everything).count()
    one = log(spark, tab("::|page:1"))
    assert [tuple(r) for r in logstats.tab_consumer_causes(one).collect()] == [("unreadable", 1)]


def test_daily_consume(spark):
    records = [
        feed("mid:m1"),
        feed("mid:m1|recom_scene:2"),
        feed("mid:m1|recom_scene:1"),
        feed("mid"),
        feed("mid:m1", uid="123456789012"),
        detail("mid:m1"),
    ]
    rows = logstats.daily_consume(log(spark, *records)).collect()
    assert [tuple(r) for r in rows] == [("1234567", 2)]


def test_find_users(spark):
    found = {"previous_id": "231553", "root_uicode": "10000700"}
    records = [
        feed("playduration:3000", **found),
        feed("playduration:2999", **found),
        feed("valid_play_duration:3000", **found),
        feed("playduration:3000", previous_id="1", root_uicode="10000700"),
        feed("playduration:3000", previous_id="231553", root_uicode="1"),
        feed("playduration:3000", **found, **{"from": ""}),
    ]
    rows = logstats.find_users(log(spark, *records)).collect()
    assert [tuple(r) for r in rows] == [("1234567", 3000)]


def test_source_report(spark):
    found = {"previous_id": "231278", "root_uicode": "10000700"}
    records = [
        feed("valid_play_duration:100"),
        feed("valid_play_duration:100", **found),
        feed("page:2|index:1|recom_code:7|valid_play_duration:3001", **found),
        feed("page:2|index:1|recom_code:7|valid_play_duration:3000"),
        feed("page:2|index:1|valid_play_duration:3000"),
        feed("page:2|index:1|recom_code:7"),
        feed("page:2147483647|index:1|recom_code:8|valid_play_duration:1"),
        feed("index:1:2|recom_code:7|valid_play_duration:1"),
    ]
    rows = sorted(tuple(r) for r in logstats.source_report(log(spark, *records)).collect())
    assert rows == [
        ("56", "4000", 0, "find", 0, 0),
        ("56", "4000", 0, "vvs", 2, 0),
        ("56", "7", 11, "find", 0, 1),
        ("56", "7", 11, "vvs", 1, 0),
        ("56", "8", 21474836461, "find", 0, 0),
        ("56", "8", 21474836461, "vvs", 1, 0),
    ]


def test_author_exposure(spark):
    rows = [
        ("discover", "m1|a1|x,m2|a1|x,m1|a1|x"),
        ("discover", "m3,m4|a2"),
        ("hot", "m5|a3"),
        ("discover", ""),
        ("discover", None),
    ]
    shown = logstats.author_exposure(spark.createDataFrame(rows, "type string, recom_list string"))
    assert sorted(tuple(r) for r in shown.collect()) == [("a1", 2), ("a2", 1)]


def test_values(spark):
    df = spark.createDataFrame(
        [("12",), (" 12 ",), ("+5",), ("-7",), ("+",), ("",), ("99999999999",), ("1.0",), (None,)],
        "t string",
    )
    found = [r.n for r in df.select(strict_int(F.col("t")).alias("n")).collect()]
    assert found == [12, None, 5, -7, None, None, None, None, None]
    row = spark.range(1).select(
        half_up_ratio(F.lit(1), F.lit(8), 2).alias("half"),
        half_up_ratio(F.lit(1), F.lit(0), 2).alias("none"),
        user_tail(F.lit("12")).alias("short"),
        user_tail(F.lit("1234567")).alias("tail"),
        client(F.lit("010")).alias("unknown"),
        client(F.lit("x9999")).alias("other"),
        feed_depth(F.lit("ios"), F.lit("1"), F.lit("x")).alias("bad"),
        event_time(F.lit("nothing")).alias("no_time"),
    ).first()
    assert tuple(row) == (0.13, None, None, "56", None, "other", None, None)
