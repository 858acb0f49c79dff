import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from feedmill.operators import candidates, ids, quality, sets, state
from feedmill.sources.readers import item_meta_of

CANDIDATES = "uid string, mids array<string>"


def as_dict(df):
    return {r[0]: list(r[1]) for r in df.collect()}


def test_remove_seen(spark):
    offered = spark.createDataFrame(
        [
            ("u1", ["m1", "m2", "m3"]),
            ("u2", ["m1"]),
            ("u4", ["m1", "m2"]),
            ("u6", ["m3", "m1", "m3", "m2", "m1"]),
        ],
        CANDIDATES,
    )
    seen = spark.createDataFrame(
        [("u1", "m2"), ("u1", "m2"), ("u2", "m1"), ("u3", "m1"), ("u5", "m1")], "uid string, mid string"
    )
    assert as_dict(candidates.remove_seen(offered, seen)) == {
        "u1": ["m1", "m3"],
        "u4": ["m1", "m2"],
        "u6": ["m3", "m1", "m2"],
    }


META = [
    ("m1", "a", "o", 5.0, "day"),
    ("m2", "b", "o2", 6.0, "day"),
    ("m2", "a", "o3", 6.0, "day"),
    ("m2", "a", "o1", 6.0, "day"),
    ("m3", "a", "o", 6.0, "other"),
    ("m4", "c", "o4", 6.0, "day"),
]


def test_enrich(spark):
    meta = spark.createDataFrame(
        META, "mid string, uid string, object_id string, object_duration double, dt string"
    )
    offered = spark.createDataFrame([("u", ["m4", "m1", "m2", "m3"]), ("v", ["m1"])], CANDIDATES)
    out = candidates.enrich(offered, item_meta_of(meta, "day"))
    text = out.select("uid", candidates.items_json(F.col("items")).alias("j")).collect()
    assert [tuple(r) for r in text] == [
        (
            "u",
            '[{"uid":"c","type":"mid","id":"m4","oid":"o4"},{"uid":"a","type":"mid","id":"m2","oid":"o1"}]',
        )
    ]
    capped = candidates.enrich(offered, item_meta_of(meta, "day"), cap=1).first()
    assert [e["id"] for e in capped["items"]] == ["m4"]


NEW = [("u1", "L1"), ("u2", "L2"), ("u5", ""), ("u6", ""), ("u8", "L8")]
BASE = [
    ("u2", "K2", 7),
    ("u3", "K3", 7),
    ("u4", "K4", 1),
    ("u5", "K5", 7),
    ("u7", "K7", 0),
    ("u8", "", 9),
]


@pytest.fixture(scope="module")
def merge_inputs(spark):
    return (
        spark.createDataFrame(NEW, "uid string, list string"),
        spark.createDataFrame(BASE, "uid string, list string, ttl int"),
    )


def test_merge_state(merge_inputs):
    seen = Observation("merge")
    rows = state.merge_state(*merge_inputs, observation=seen).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("u1", "L1", 30),
        ("u2", "L2", 30),
        ("u3", "K3", 6),
        ("u5", "K5", 6),
        ("u8", "L8", 30),
    ]
    counters = state.merge_state_counters(*merge_inputs).first().asDict()
    assert counters == {
        "uid_num": 8,
        "new_num": 2,
        "update_num": 1,
        "decrease_num": 4,
        "remove_num": 2,
        "bad_ttl_num": 0,
    }
    assert seen.get == counters


def test_merge_counters_balance(spark):
    """The three sums that hold for any day without empty lists."""
    new = spark.range(0, 700).select(F.col("id").cast("string").alias("uid"), F.lit("n").alias("list"))
    base = spark.range(300, 1500).select(
        F.col("id").cast("string").alias("uid"),
        F.lit("b").alias("list"),
        (1 + F.col("id") % 30).cast("int").alias("ttl"),
    )
    c = state.merge_state_counters(new, base).first()
    assert c.uid_num == c.new_num + c.update_num + c.decrease_num
    assert state.merge_state(new, base).count() == c.uid_num - c.remove_num
    assert 700 + 1200 == c.uid_num + c.update_num


def test_merge_counts_and_gives_bad_ttls(spark):
    new = spark.createDataFrame([("u1", "L1")], "uid string, list string")
    base = spark.createDataFrame(
        [("u1", "K1", None), ("u2", "K2", None), ("u3", "K3", 1), ("u4", "K4", 2), ("u5", "", None)],
        "uid string, list string, ttl int",
    )
    seen = Observation("bad")
    rows = state.merge_state(new, base, observation=seen).collect()
    assert sorted(map(tuple, rows)) == [("u1", "L1", 30), ("u4", "K4", 1)]
    assert seen.get["bad_ttl_num"] == 1
    assert seen.get == state.merge_state_counters(new, base).first().asDict()
    assert [tuple(r) for r in state.merge_state_rejects(new, base).collect()] == [("u2", "K2")]
    assert [r.ttl for r in state.aged(base.where("ttl > 0"), 3).orderBy("uid").collect()] == [-2, -1]


def test_merge_refuses_a_repeated_user(spark, merge_inputs):
    new, base = merge_inputs
    with pytest.raises(Exception, match=quality.REPEATED):
        state.merge_state(new.unionByName(new), base).collect()
    with pytest.raises(Exception, match=quality.REPEATED):
        state.merge_state(new, base.unionByName(base)).collect()
    with pytest.raises(Exception, match=quality.REPEATED):
        state.merge_state_counters(new.unionByName(new), base).collect()


def test_export(spark, tmp_path):
    rows = [(str(n), f"list {n}", 1) for n in range(100)] + [
        ("x1", "list", 1),
        ("7.5", "list", 1),
        ("200", "-", 1),
        ("201", "", 1),
        ("-3", "minus", 1),
    ]
    table = spark.createDataFrame(rows, "uid string, list string, ttl int")
    plan = state.export_plan(table, 8).collect()
    assert len(plan) == 101
    parts = {}
    for r in plan:
        parts.setdefault(r.part, []).append((r.position, r.key))
    assert set(parts) == set(range(8))
    for part, placed in parts.items():
        placed.sort()
        assert [p for p, _ in placed] == list(range(len(placed)))
        assert [k for _, k in placed] == sorted(k for _, k in placed)
        assert all(k % 8 == part for _, k in placed)
    state.export_kv(table, str(tmp_path / "kv"), 8)
    written = spark.read.parquet(str(tmp_path / "kv"))
    assert sorted((r.part, r.key) for r in written.collect()) == sorted((r.part, r.key) for r in plan)


def test_ids_of_listed_buckets(spark):
    pairs = spark.createDataFrame(
        [("50001234", "70000234"), ("60001234", "70001234"), ("50001234", "123")],
        "uid string, mid string",
    )
    rows = {(r.kind, r.real_id): r.num_id for r in ids.assign_ids(pairs).collect()}
    assert rows == {
        ("uid", "50001234"): 12340,
        ("uid", "60001234"): 12341,
        ("mid", "70000234"): 12340,
        ("mid", "70001234"): 12341,
    }
    dense = {(r.kind, r.real_id): r.num_id for r in ids.assign_dense_ids(pairs).collect()}
    assert dense == {
        ("uid", "50001234"): 0,
        ("uid", "60001234"): 1,
        ("mid", "123"): 0,
        ("mid", "70000234"): 1,
        ("mid", "70001234"): 2,
    }


def test_encode_and_decode(spark):
    dictionary = spark.createDataFrame(
        [("u1", 1, "uid"), ("u2", 2, "uid"), ("a", 10, "mid"), ("b", 11, "mid")],
        "real_id string, num_id bigint, kind string",
    )
    scores = spark.createDataFrame(
        [("u1", "a", 1.234), ("u2", "b", 2.0), ("u3", "a", 1.0), ("u1", "z", 1.0)],
        "uid string, mid string, score double",
    )
    encoded = sorted(tuple(r) for r in ids.encode_ratings(scores, dictionary).collect())
    assert encoded == [(1, 10, 1.23), (2, 11, 2.0)]

    recs = spark.createDataFrame(
        [(1, [(11, 3.0), (99, 2.0), (10, 1.0)]), (7, [(10, 1.0)])],
        "user bigint, items array<struct<item:bigint,score:double>>",
    )
    assert as_dict(ids.decode_recommendations(recs, dictionary)) == {"u1": ["b", "a"]}
    assert tuple(ids.missing_items(recs, dictionary).first()) == (4, 1)
    triples = spark.createDataFrame([(1, 10, 0.5), (3, 10, 0.5)], "user int, item int, score double")
    assert [tuple(r) for r in ids.decode_triples(triples, dictionary).collect()] == [("u1", "a", 0.5)]
    numbers = spark.createDataFrame([(10,), (10,), (99,)], "num_id bigint")
    assert [tuple(r) for r in ids.lookup(numbers, dictionary).collect()] == [(10, "a")] * 2


def test_id_beyond_32_bits_is_an_error(spark):
    dictionary = spark.createDataFrame(
        [("u1", 1 << 40, "uid"), ("a", 10, "mid")], "real_id string, num_id bigint, kind string"
    )
    scores = spark.createDataFrame([("u1", "a", 1.0)], "uid string, mid string, score double")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        ids.encode_ratings(scores, dictionary).collect()


def test_sets(spark):
    a = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "id string")
    b = spark.createDataFrame([("2",), ("4",)], "id string")
    assert sorted(r.id for r in sets.id_difference(a, b).collect()) == ["1", "3"]
    assert tuple(sets.id_coverage(a, b).first()) == (3, 2, 1, 0.5)
    assert tuple(sets.id_coverage(a, b.limit(0)).first()) == (3, 0, 0, None)


def test_require_rows(spark):
    assert quality.require_rows(spark.range(5), 5).count() == 5
    with pytest.raises(quality.TooFewRows):
        quality.require_rows(spark.range(4), 5)


def test_ids_without_a_number_are_given(spark):
    pairs = spark.createDataFrame([("u12", "m1234"), ("9", "1234"), ("userabcd", None), ("00012", "1234")], "uid string, mid string")
    numbered = ids.assign_ids(pairs).collect()
    assert sorted((r.real_id, r.num_id) for r in numbered) == [("00012", 10120), ("1234", 12340), ("m1234", 12341)]
    rejected = sorted((r.kind, r.real_id or "", r.cause) for r in ids.id_rejects(pairs).collect())
    assert rejected == [
        ("mid", "", "short"), ("uid", "9", "short"), ("uid", "u12", "short"), ("uid", "userabcd", "not a number"),
    ]
