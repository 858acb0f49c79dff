"""The chain end to end on the sample tables."""

import dataclasses
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from feedmill import session
from feedmill.operators.quality import RunCounters, TooFewRows
from feedmill.operators.topk import Probe
from feedmill.plans import bindings as b
from feedmill.plans import catalog, daily

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")


def inputs(spark):
    log = b.behaviour(spark, SF_DIR)
    return log, log.select("uid", "mid"), catalog._event_item_meta(spark, SF_DIR)


def test_lists_hold_unseen_items_in_bounds(spark):
    log, history, meta = inputs(spark)
    settings = daily.DailySettings(
        skip=5, pool_end=100, top_items=95, min_items=5, min_users=1, k=40, cap=7,
        factorisation=catalog.SMALL_MODEL,
    )
    found = daily.todays_lists(log, history, meta, settings).cache()
    rows = found.select("uid", F.explode("items").alias("e")).select("uid", F.col("e.id").alias("mid"))
    assert rows.count() > 0
    assert rows.join(history, ["uid", "mid"], "left_semi").count() == 0
    assert found.where(F.size("items") > 7).count() == 0
    assert rows.count() == rows.distinct().count()


def test_chain_stops_with_too_few_users(spark):
    log, history, meta = inputs(spark)
    settings = daily.DailySettings(skip=5, pool_end=100, top_items=95, min_items=5)
    with pytest.raises(TooFewRows):
        daily.todays_lists(log, history, meta, settings)


SETTINGS = daily.DailySettings(
    skip=5, pool_end=100, top_items=95, min_items=5, min_users=1, k=95, factorisation=catalog.SMALL_MODEL
)


def dated(spark, day):
    log = b.behaviour(spark, SF_DIR).withColumn("dt", F.lit(day))
    meta = inputs(spark)[2].withColumn("dt", F.lit(day)).withColumn("object_duration", F.lit(9.0))
    return log, meta


def balanced(counters, state):
    """Every user is new, updated, aged or without any list; output is what was not removed."""
    kinds = counters["new_num"] + counters["update_num"] + counters["decrease_num"]
    assert kinds <= counters["uid_num"]
    assert state.count() == kinds - counters["remove_num"] - counters["bad_ttl_num"]


def test_a_day_is_stored_and_exported(spark, tmp_path):
    day, before = "20240120", "20240119"
    log, meta = dated(spark, before)
    base = b.base_state(spark, SF_DIR).withColumn("dt", F.lit(before))
    state_path, export_path = str(tmp_path / "state"), str(tmp_path / "kv")
    base.write.partitionBy("dt").parquet(state_path)
    counters = daily.run_day(log, meta, day, state_path, export_path, SETTINGS)
    stored = spark.read.parquet(state_path)
    assert stored.where(F.col("dt") == before).count() == base.count()
    today = stored.where(F.col("dt") == day)
    balanced(counters, today)
    fresh = today.where("ttl = 30 AND list LIKE '[%'")
    assert fresh.count() > 0
    assert today.join(base.where("ttl = 1"), "uid", "left_semi").where("list LIKE 'base%'").count() == 0
    exported = spark.read.parquet(export_path)
    assert exported.count() == today.count()
    assert exported.where(F.col("key") % 8 != F.col("part")).count() == 0
    # What the run left out, from its own passes.
    assert counters["missing"] == 0 and counters["kept"] + counters["removed"] == counters["entries"] > 0
    # The copies made on the way are gone.
    own = pathlib.Path(session._own_folder(spark).removeprefix("file:"))
    before_run = set(own.iterdir())
    daily.run_day(log, meta, day, state_path, export_path, SETTINGS)
    assert set(own.iterdir()) == before_run


def test_no_user_is_lost_when_days_are_left_out(spark, tmp_path):
    log, meta = dated(spark, "20240119")
    state_path, export_path = str(tmp_path / "state"), str(tmp_path / "kv")
    base = b.spoilt_state(spark, SF_DIR)
    base.withColumn("dt", F.lit("20240117")).write.partitionBy("dt").parquet(state_path)
    counters = daily.run_day(log, meta, "20240120", state_path, export_path, SETTINGS)
    today = spark.read.parquet(state_path).where(F.col("dt") == 20240120)
    balanced(counters, today)
    kept = today.where("list LIKE 'base%'")
    # Three days have passed since.
    expected = base.where("list <> '' AND ttl > 3")
    assert kept.count() == expected.count() > 0
    assert kept.join(expected.withColumnRenamed("ttl", "was"), "uid").where("ttl <> was - 3").count() == 0
    assert counters["bad_ttl_num"] == base.where("list <> '' AND ttl IS NULL").count() > 0


def test_no_base_is_an_error_but_on_a_first_run(spark, tmp_path):
    log, meta = dated(spark, "20240119")
    state_path, export_path = str(tmp_path / "state"), str(tmp_path / "kv")
    counters = daily.run_day(log, meta, "20240120", state_path, export_path, SETTINGS, first_run=True)
    assert counters["new_num"] == counters["uid_num"] == spark.read.parquet(state_path).count()
    with pytest.raises(daily.NoBase):
        daily.run_day(log, meta, "20240119", state_path, export_path, SETTINGS)
    with pytest.raises(TooFewRows):
        daily.run_day(log, meta.where("false"), "20240121", state_path, export_path, SETTINGS)


def test_probing_in_the_chain(spark):
    log, history, meta = inputs(spark)
    probing = dataclasses.replace(SETTINGS, k=10, probe=Probe(clusters=2), probe_clusters=4)
    probed = daily.todays_lists(log, history, meta, probing)
    assert probed.where(F.size("items") > 0).count() > 0


def test_bucketed_ids_are_counted_on_the_way(spark):
    log, history, meta = inputs(spark)
    counters = RunCounters()
    settings = dataclasses.replace(SETTINGS, bucketed_ids=True)
    daily.todays_lists(log, history, meta, settings, counters).collect()
    found = counters.counts()
    assert found["ids"]["ids"] > 0 and found["ids"]["short_ids"] == found["ids"]["no_number_ids"] == 0
    assert found["seen"]["kept"] + found["seen"]["removed"] == found["decode"]["entries"] - found["decode"]["missing"]
