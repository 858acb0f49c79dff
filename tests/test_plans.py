"""Plan shapes that the results do not show."""

import os

import pytest
from pyspark.sql import functions as F

from feedmill.operators import joins, logstats, popularity, scoring, state
from feedmill.plans import bindings as b
from feedmill.plans import catalog, oracle
from feedmill.sources.readers import item_meta_of
from feedmill.sources.writers import save_state_day

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")

COLUMN_QUERIES = sorted(
    set(oracle.ORACLE)
    - {
        "top_k_exact",
        "top_k_blocks",
        "top_k_probed",
        "top_k_probed_blocks",
        "top_k_pruned",
        "top_k_pruned_blocks",
        "probe_recall",
        "scored_list_text",
        "recommend_checks",
        "cluster_routes",
        "scored_list_lines",
        "decode_recommendations",
        "decode_triples",
    }
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(df, capsys):
    """Details of the scans, which the short plan cuts off."""
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", COLUMN_QUERIES)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(catalog.registered()[name](spark, SF_DIR))
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas", "InArrow"):
        assert step not in plan, plan


@pytest.fixture
def log_table(spark, tmp_path):
    path = str(tmp_path / "log")
    b.client_log(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


def test_reports_push_plain_filters_and_prune_columns(log_table, capsys):
    scan = scan_of(logstats.tab_consumers(log_table), capsys)
    assert "EqualTo(action,799)" in scan and "EqualTo(uicode,10000789)" in scan
    assert "day_key" not in scan and "previous_id" not in scan


def test_bag_is_read_once_per_key(log_table):
    plan = plan_of(logstats.find_users(log_table))
    lines = [line for line in plan.splitlines() if "|playduration:" in line]
    assert len(lines) == 1 and "Generate inline" in lines[0]


def test_depth_report_shuffles_combined_rows(log_table):
    plan = plan_of(logstats.depth_report(log_table))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Expand" not in plan


def test_white_list_meets_the_log_before_parsing(spark, tmp_path):
    path = str(tmp_path / "behaviour")
    b.behaviour(spark, SF_DIR).write.parquet(path)
    log = spark.read.parquet(path)
    good = popularity.good_items(popularity.item_action_counts(log), 0, 100, 50)
    plan = plan_of(scoring.behaviour_signals(log, good))
    assert plan.index("Generate inline") < plan.index("BroadcastHashJoin [mid")
    assert "Exchange hashpartitioning(mid" not in plan.split("BroadcastExchange")[0]


def test_merge_shuffles_each_side_once(spark, tmp_path):
    for name, df in (("new", b.new_lists(spark, SF_DIR)), ("base", b.base_state(spark, SF_DIR))):
        df.write.parquet(str(tmp_path / name))
    new, base = (spark.read.parquet(str(tmp_path / n)) for n in ("new", "base"))
    plan = plan_of(state.merge_state(new, base))
    assert plan.count("Exchange hashpartitioning(uid") == 2
    assert "Generate" not in plan


def test_bucketed_state_is_not_shuffled(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS feedmill_state LOCATION '{tmp_path / 'db'}'")
    try:
        first = b.base_state(spark, SF_DIR).withColumn("dt", F.lit("20200101"))
        save_state_day(first, "feedmill_state.lists", 4)
        base = spark.table("feedmill_state.lists").where("dt = '20200101'").drop("dt")
        merged = state.merge_state(b.new_lists(spark, SF_DIR), base)
        plan = plan_of(merged)
        of_base = plan[plan.rindex("FileScan") :]
        assert "Bucketed: true" in of_base
        # One shuffle makes the new lists distinct, one brings them to the state.
        assert plan.count("Exchange hashpartitioning") == 2
        want = sorted(map(tuple, merged.collect()))
        save_state_day(merged.withColumn("dt", F.lit("20200102")), "feedmill_state.lists", 4)
        written = spark.table("feedmill_state.lists").where("dt = '20200102'")
        assert sorted(map(tuple, written.drop("dt").collect())) == want
        assert len(written.inputFiles()) <= 4
    finally:
        spark.sql("DROP DATABASE feedmill_state CASCADE")


def test_metadata_filter_reaches_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "meta")
    b.item_meta(spark, SF_DIR).write.partitionBy("dt").parquet(path)
    plan = scan_of(item_meta_of(spark.read.parquet(path), b.META_DAY), capsys)
    assert "GreaterThan(object_duration,5.0)" in plan and "PartitionFilters: [isnotnull(dt" in plan


def test_history_passes_whole_when_too_many_items_are_offered(spark):
    facts = spark.range(10).withColumn("k", F.col("id") % 3)
    keys = spark.range(2).withColumnRenamed("id", "k")
    assert joins.restrict(facts, keys, ["k"]).count() == 7
    assert joins.restrict(facts, keys, ["k"], max_rows=1).count() == 10


def test_lists_are_made_in_all_tasks(spark):
    from feedmill.plans import bindings

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bindings.candidates(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == tasks
