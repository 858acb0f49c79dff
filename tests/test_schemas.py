"""Operators give the tables that ``schemas`` declares."""

import pytest
from pyspark.sql import functions as F

from feedmill import schemas
from feedmill.operators import candidates, ids, popularity, scoring, state, topk
from feedmill.plans import bindings as b

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def behaviour(spark):
    rows = [("1001234", "repost", "2001234", None), ("1001235", "play", "2001234", "k")]
    return spark.createDataFrame(rows, "uid string, action string, mid string, extend string")


def same(df, schema):
    assert df.schema.simpleString() == schema.simpleString()


def test_scores_and_ids(behaviour):
    counts = popularity.item_action_counts(behaviour)
    same(counts, schemas.ITEM_COUNTS)
    good = popularity.good_items(counts, 0, 10, 10)
    same(good, schemas.GOOD_ITEMS)
    scores = scoring.user_item_score(behaviour, good, 1)
    same(scores, schemas.SCORES)
    same(ids.assign_ids(scores), schemas.ID_LIST)
    same(ids.assign_dense_ids(scores), schemas.ID_LIST)


def test_lists_and_state(spark):
    factors = spark.createDataFrame([(1, [1.0, 2.0])], schemas.FACTORS)
    same(topk.recommend_top_k(factors, factors, 1), schemas.RECOMMENDATIONS)
    same(topk.recommend_top_k(factors, factors, 1, max_item_bytes=0), schemas.RECOMMENDATIONS)
    offered = spark.createDataFrame([("u", ["m"])], schemas.CANDIDATES)
    seen = spark.createDataFrame([("u", "x")], schemas.PAIRS)
    same(candidates.remove_seen(offered, seen), schemas.CANDIDATES)
    meta = spark.createDataFrame([("m", "a", "o", 9.0, "d")], schemas.ITEM_META)
    enriched = candidates.enrich(offered, meta)
    same(enriched, schemas.ENRICHED)
    new = enriched.select("uid", candidates.items_json(F.col("items")).alias("list"))
    same(new, schemas.NEW_LISTS)
    same(state.merge_state(new, spark.createDataFrame([], schemas.STATE)), schemas.STATE)


def test_bindings_have_the_declared_columns(spark):
    log = b.client_log(spark, SF_DIR)
    assert log.columns == schemas.CLIENT_LOG.fieldNames()
    assert b.exposure(spark, SF_DIR).columns == schemas.EXPOSURE.fieldNames()
    assert set(b.behaviour(spark, SF_DIR).columns) <= set(schemas.BEHAVIOUR.fieldNames())
    same(b.item_meta(spark, SF_DIR), schemas.ITEM_META)
    same(b.base_state(spark, SF_DIR), schemas.STATE)
    same(b.new_lists(spark, SF_DIR), schemas.NEW_LISTS)
    same(b.candidates(spark, SF_DIR), schemas.CANDIDATES)
