from itertools import product

import pytest
from pyspark.sql import functions as F

from feedmill.functions.scores import behaviour_score
from feedmill.operators.popularity import good_items, item_action_counts
from feedmill.operators.scoring import (
    behaviour_signals,
    score_counters,
    user_item_score,
    user_item_vector,
)

SCHEMA = "uid string, action string, mid string, extend string"


def play(duration, length=10000, index=1):
    bag = f"valid_play_duration:{duration}|object_duration:{length}"
    return bag if index is None else f"{bag}|index:{index}"


def signals(spark, rows, mids=("m1", "m2", "m3", "m4")):
    log = spark.createDataFrame(rows, SCHEMA)
    good = spark.createDataFrame([(m,) for m in mids], "mid string")
    return behaviour_signals(log, good)


def test_signals_of_listed_lines(spark):
    rows = [
        ("1001", "play", "m1", play(9000)),
        ("1001", "play", "m1", play(2999)),
        ("1001", "play", "m1", play(3000, index=0)),
        ("1001", "play", "m2", play(3000, length=0, index=None)),
        ("1001", "play", "m2", "valid_play_duration:3000|object_duration"),
        ("1001", "play", "m2", play(3000, index="first")),
        ("1001", "play", "m2", play(2000, index="first")),
        ("1001", "play", "m2", "valid_play_duration:long|object_duration:9"),
        ("1001", "play", "m2", "valid_play_duration:5000"),
        ("1001", "play", "m2", None),
        ("1001", "repost", "m3", None),
        ("1001", "follow", "m4", ""),
        ("1001", "repost", "m9", None),
        ("123456789012", "play", "m1", play(9000)),
    ]
    found = [(r.mid, r.signal, r.rate) for r in signals(spark, rows).collect()]
    assert sorted(found, key=str) == sorted(
        [
            ("m1", "play", 0.9),
            ("m1", "touch", None),
            ("m1", "diversion", 0.3),
            ("m2", "play", float("inf")),
            ("m2", "touch", None),
            ("m3", "repost", None),
            ("m4", "touch", None),
        ],
        key=str,
    )


def test_equal_rates_are_one_play(spark):
    rows = [("1001", "play", "m1", play(9000))] * 3 + [("1001", "play", "m1", play(5000))]
    row = user_item_vector(signals(spark, rows)).first()
    assert (row.plays, row.play_rate, row.diversions) == (2, 0.9, 0)


def expected_score(nd, md, np, mp, c, a, r):
    def side(n, m, weight):
        m = min(max(m, 0.0), 1.0) if n else 0.0
        bonus = 0.0
        if n == 2 and m > 0.8:
            bonus = 5.0
        if n > 2 and m > 0.8:
            bonus = 16.0
        return n * m * weight + bonus

    return side(nd, md, 2.0) + side(np, mp, 1.0) + 4.0 * c + 16.0 * a + 20.0 * r


def test_behaviour_score_over_its_cases(spark):
    rates = [-0.5, 0.3, 0.8, 0.81, 1.0, float("inf")]
    cases = [
        (nd, md if nd else None, np, mp if np else None, c, a, r)
        for nd, np in product(range(4), repeat=2)
        for md, mp in product(rates, repeat=2)
        for c, a, r in ((False, False, False), (True, False, True), (False, True, False))
    ]
    df = spark.createDataFrame(
        cases, "nd bigint, md double, np bigint, mp double, c boolean, a boolean, r boolean"
    )
    cols = [F.col(c) for c in ("nd", "md", "np", "mp", "c", "a", "r")]
    for row in df.withColumn("score", behaviour_score(*cols)).collect():
        want = expected_score(row.nd, row.md or 0, row.np, row.mp or 0, row.c, row.a, row.r)
        assert row.score == pytest.approx(want)


@pytest.mark.parametrize("touched, kept", [(49, False), (50, True), (2000, True), (2001, False)])
def test_activity_bounds_count_touched_items(spark, touched, kept):
    mids = [f"m{i}" for i in range(touched)]
    rows = [("1001", "follow", m, None) for m in mids] + [("1001", "repost", "m0", None)]
    log = spark.createDataFrame(rows, SCHEMA)
    good = spark.createDataFrame([(m,) for m in mids], "mid string")
    out = user_item_score(log, good).collect()
    assert [tuple(r) for r in out] == ([("1001", "m0", 20.0)] if kept else [])


def test_counters_add_up(spark):
    rows = [
        ("1001", "play", "m1", play(9000)),
        ("1001", "play", "m1", "broken"),
        ("1001", "comment", "m1", None),
        ("1001", None, "m1", None),
    ]
    log = spark.createDataFrame(rows, SCHEMA)
    row = score_counters(log, spark.createDataFrame([("m1",)], "mid string")).first()
    assert row.asDict() == {
        "lines": 4,
        "rejected_plays": 1,
        "scored_plays": 1,
        "touches": 1,
        "repost": 0,
        "comment": 1,
        "attitude": 0,
    }


def test_counts_keep_items_with_unknown_actions(spark):
    log = spark.createDataFrame(
        [("1", "play", "a", None), ("1", "follow", "b", None), ("123456789012", "play", "c", None)],
        SCHEMA,
    )
    rows = {r.mid: (r.repost, r.comment, r.attitude, r.play) for r in item_action_counts(log).collect()}
    assert rows == {"a": (0, 0, 0, 1), "b": (0, 0, 0, 0)}


def test_good_items_slice_and_ties(spark):
    counts = spark.createDataFrame(
        [(f"i{n:02d}", 1, 1, 1, 100 - n // 2) for n in range(20)],
        "mid string, repost bigint, comment bigint, attitude bigint, play bigint",
    )
    pool = [f"i{n:02d}" for n in range(3, 9)]
    kept = [r.mid for r in good_items(counts, skip=3, pool_end=9, top=3).collect()]
    # Plays fall with the number and tie in pairs, scores follow the plays.
    assert kept == pool[:3]
