"""Stored forms that are read back, and what the histogram cuts."""

import pytest
from pyspark.sql import functions as F

from feedmill.operators import candidates, factors, popularity, state
from feedmill.session import current_scratch, materialise, scratch

COUNTS = "mid string, repost bigint, comment bigint, attitude bigint, play bigint"


def pool_of(rows, skip, pool_end):
    order = sorted(rows, key=lambda r: (-r[4], r[0]))
    return {r[0] for r in order[skip:pool_end]}


@pytest.mark.parametrize("skip, pool_end", [(0, 5), (3, 9), (5, 5), (7, 3), (0, 100), (39, 60), (40, 50), (12, 13)])
def test_histogram_slice_equals_a_full_sort(spark, skip, pool_end):
    # Long ties, also across both ends of the slice.
    rows = [(f"i{n * 7 % 40:02d}", 1, 1, 1, [9, 9, 5, 5, 5, 5, 5, 1][n % 8]) for n in range(40)]
    kept = popularity.good_items(spark.createDataFrame(rows, COUNTS), skip, pool_end, 1000)
    assert {r.mid for r in kept.collect()} == pool_of(rows, skip, pool_end)


def test_histogram_of_nothing(spark):
    assert popularity.good_items(spark.createDataFrame([], COUNTS), 0, 10, 10).collect() == []


def test_only_the_slice_is_ranked(spark):
    counts = spark.range(1000).select(F.col("id").cast("string").alias("mid"), *[F.lit(1).cast("bigint").alias(c) for c in ("repost", "comment", "attitude")], (F.col("id") % 100).alias("play"))
    assert popularity._slice_bounds(counts, 15, 25) == (97, 98, 10)
    assert popularity._slice_bounds(counts, 1000, 2000) is None


def test_json_lists_round_trip(spark):
    entry = "struct<uid:string,type:string,id:string,oid:string>"
    rows = [("u1", [("a", "mid", 'm"1', None), ("ä\\", "mid", "m2", "1034:2")]), ("u2", [])]
    lists = spark.createDataFrame(rows, f"uid string, items array<{entry}>")
    stored = lists.select("uid", candidates.items_json(F.col("items")).alias("list"))
    assert candidates.json_rejects(stored).collect() == []
    found = [tuple(r) for r in candidates.json_entries(stored).orderBy("owner", "pos").collect()]
    assert found == [("u1", 0, "a", "mid", 'm"1', None), ("u1", 1, "ä\\", "mid", "m2", "1034:2")]


def test_bad_json_lists_are_named(spark):
    texts = ['[{"uid":"a"', "7", "", None, '{"uid":"a"}', "[]", '[{"uid":"a","type":"mid","id":"m","oid":"o"}]', "null"]
    stored = spark.createDataFrame([(f"u{k}", t) for k, t in enumerate(texts)], "uid string, list string")
    assert sorted(r.uid for r in candidates.json_rejects(stored).collect()) == ["u0", "u1", "u2", "u3", "u4", "u7"]
    assert [r.owner for r in candidates.json_entries(stored).collect()] == ["u6"]


def test_export_order_sees_unsorted_files_and_overlaps(spark):
    rows = [
        (0, 1, "a", 0), (0, 2, "a", 1), (0, 3, "b", 0), (0, 9, "b", 1),  # in order, apart
        (1, 2, "c", 0), (1, 1, "c", 1),  # falls
        (2, 1, "d", 0), (2, 5, "d", 1), (2, 3, "e", 0),  # files overlap
        (3, 4, "f", 0), (3, 4, "f", 1),  # a key twice does not ascend
    ]
    found = state.export_order(spark.createDataFrame(rows, "part int, key long, file string, at long")).orderBy("part")
    assert [tuple(r) for r in found.collect()] == [
        (0, 4, 1, 9, True, True), (1, 2, 1, 2, False, True), (2, 3, 1, 5, True, False), (3, 2, 4, 4, False, True),
    ]


def test_nameless_rows_are_left_out_of_the_merge(spark):
    new = spark.createDataFrame([("u1", "n1"), (None, "n2"), (None, "n3")], "uid string, list string")
    base = spark.createDataFrame([("u1", "b1", 3), (None, "b2", 3), ("u2", "b3", 3)], "uid string, list string, ttl int")
    assert sorted(tuple(r) for r in state.merge_state(new, base).collect()) == [("u1", "n1", 30), ("u2", "b3", 2)]
    assert sorted(tuple(r) for r in state.nameless_rows(new, base).collect()) == [("base", "b2"), ("new", "n2"), ("new", "n3")]


def test_grid_shares_one_split(spark):
    ratings = spark.range(400).select((F.col("id") % 20).cast("int").alias("user"), F.expr("cast(id div 20 AS int)").alias("item"), F.lit(1.0).alias("rating"))
    settings = factors.Settings(rank=2, iterations=1, blocks=2)
    with scratch(spark):
        # Copies made by threads of the pool belong to the block too.
        found = factors.grid(ratings, (2, 3), (0.1,), (1, 2), settings, at_once=3).collect()
        assert len(current_scratch()) == 2 + 4
    assert [(r["rank"], r["iterations"]) for r in found] == [(2, 1), (2, 2), (3, 1), (3, 2)]
    assert len({r["pairs"] for r in found}) == 1 and all(r["mse"] >= 0 for r in found)
    one = factors.evaluate(ratings, factors.Settings(rank=3, iterations=2, blocks=2)).first()
    # The fit itself hangs on the order of the rows, the split does not.
    assert found[-1]["pairs"] == one["pairs"]
    with pytest.raises(ValueError):
        factors.grid(ratings, (), (0.1,), (1,))


def test_a_copy_may_belong_to_a_named_block(spark):
    with scratch(spark):
        outer = current_scratch()
        with scratch(spark):
            kept = materialise(spark.range(3), owner=outer)
        assert kept.count() == 3
    assert current_scratch() is None
