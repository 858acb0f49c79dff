import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedmill.functions import lists
from feedmill.sources import readers, writers
from feedmill import session


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


def test_behaviour_text(spark, tmp_path):
    put(tmp_path / "dt=1" / "a", '1\tplay\tx\tm"1\ty\tk:v|k:\\w', "2\trepost\tx\tm2", "3\tplay\t\tm3\t\t")
    put(tmp_path / "dt=2" / "a", "4\tplay\tx\tm4\ty\tz\textra")
    rows = readers.read_behaviour(spark, str(tmp_path / "dt=*" / "*")).orderBy("uid").collect()
    assert [(r.uid, r.action, r.mid, r.extend) for r in rows] == [
        ("1", "play", 'm"1', "k:v|k:\\w"),
        ("2", "repost", "m2", None),
        ("3", "play", "m3", None),
        ("4", "play", "m4", "z"),
    ]
    both = readers.read_behaviour(spark, [str(tmp_path / "dt=1"), str(tmp_path / "dt=2")])
    assert both.count() == 4


@pytest.mark.parametrize("format", ["parquet", "orc"])
def test_client_log_by_name_and_by_position(spark, tmp_path, format):
    wide = spark.range(1).select(*[F.lit(f"v{i}").alias(f"c{i}") for i in range(15)])
    wide.write.format(format).save(str(tmp_path / "wide"))
    by_position = readers.read_client_log(spark, str(tmp_path / "wide"), format)
    assert tuple(by_position.first()) == ("v0", "v1", "v2", "v4", "v6", "v8", "v9", "v14")
    by_position.write.format(format).save(str(tmp_path / "named"))
    by_name = readers.read_client_log(spark, str(tmp_path / "named"), format)
    assert by_name.columns == by_position.columns and by_name.first() == by_position.first()
    assert tuple(readers.read_exposure(spark, str(tmp_path / "wide"), format).first()) == ("v8", "v9")
    spark.range(1).write.format(format).save(str(tmp_path / "narrow"))
    with pytest.raises(ValueError):
        readers.read_client_log(spark, str(tmp_path / "narrow"), format)


def test_item_meta_of_one_day(spark, tmp_path):
    rows = [("m1", "a", "o", 5.0, "d1"), ("m2", "a", "o", 6.0, "d1"), ("m3", "a", "o", 6.0, "d2")]
    meta = spark.createDataFrame(
        rows, "mid string, uid string, object_id string, object_duration double, dt string"
    )
    writers.write_by(meta, str(tmp_path / "meta"), "dt")
    found = readers.read_item_meta(spark, str(tmp_path / "meta"), "d1", format="parquet").collect()
    assert [tuple(r) for r in found] == [("m2", "a", "o")]


def test_shards_read_back_and_pruned(spark, tmp_path):
    path = str(tmp_path / "f")
    factors = spark.range(20).select("id", F.array(F.lit(1.0)).alias("features"), (F.col("id") % 4).alias("shard"))
    writers.write_by(factors, path, "shard")
    assert readers.read_factors(spark, path).count() == 20
    some = readers.read_shards(spark, path, [1, 3])
    assert sorted(r.id for r in some.collect()) == [1, 3, 5, 7, 9, 11, 13, 15, 17, 19]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [shard#" in plan


@pytest.mark.parametrize("kind", ["date", "string", "int"])
def test_last_days(spark, kind):
    first = dt.date(2020, 7, 1)
    days = spark.range(20).where("id <> 4").select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"), "id"
    )
    text = F.date_format("d", "yyyyMMdd")
    column = {"date": F.col("d"), "string": text, "int": text.cast("int")}[kind]
    df = days.select(column.alias("dt"), "id")
    assert sorted(r.id for r in readers.last_days(df, "20200708", 5).collect()) == [2, 3, 5, 6]
    assert sorted(r.id for r in readers.last_days(df, "20200708", 5, from_day=2).collect()) == [2, 3, 5]


def test_text_forms(spark, tmp_path):
    ids = readers.read_id_list(spark, put(tmp_path / "ids", "real1\t12340_uid", "real2\tx_uid"), "uid")
    assert [tuple(r) for r in ids.collect()] == [("real1", 12340, "uid"), ("real2", None, "uid")]
    scored = readers.read_scored_lists(spark, put(tmp_path / "scored", "7_11:2.50\t12:1.00"))
    assert tuple(scored.first()) == (7, [(11, 2.5), (12, 1.0)])
    tabbed = put(tmp_path / "tabbed", "u1\tm1,m2,", "u2\t")
    assert [tuple(r) for r in readers.read_candidates(spark, tabbed).collect()] == [("u1", ["m1", "m2"])]
    underscored = put(tmp_path / "underscored", "u1_m1")
    assert tuple(readers.read_candidates(spark, underscored, "_").first()) == ("u1", ["m1"])
    state = readers.read_state(spark, put(tmp_path / "state", "u1\t[1,2]\t30"))
    assert tuple(state.first()) == ("u1", "[1,2]", 30)
    new = readers.read_new_lists(spark, put(tmp_path / "new", 'u1\t[{"id":"1"}]'))
    assert tuple(new.first()) == ("u1", '[{"id":"1"}]')


def test_item_set(spark, tmp_path):
    found = readers.read_item_set(spark, put(tmp_path / "good", "m1\t3.210", " m2 ", "m1", ""))
    assert sorted(r.mid for r in found.collect()) == ["m1", "m2"]


def test_pairs(spark, tmp_path):
    pairs = readers.read_pairs(spark, put(tmp_path / "pairs", "u1\tm1", "u2\tm2\textra"))
    assert [tuple(r) for r in pairs.collect()] == [("u1", "m1"), ("u2", "m2")]


def test_text_written_and_read_back(spark, tmp_path):
    state = spark.createDataFrame([("u1", '[{"id":"1"}]', 30), ("u2", "", 1)], "uid string, list string, ttl int")
    writers.write_tab_text(state, str(tmp_path / "state"))
    back = readers.read_state(spark, str(tmp_path / "state")).orderBy("uid").collect()
    assert [tuple(r) for r in back] == [("u1", '[{"id":"1"}]', 30), ("u2", None, 1)]
    recs = spark.createDataFrame([(7, [(11, 2.5), (12, 1.0)])], "user bigint, items array<struct<mid:bigint,score:double>>")
    writers.write_lines(recs, lists.scored_list_line(F.col("user"), F.col("items")), str(tmp_path / "recs"))
    assert spark.read.text(str(tmp_path / "recs")).first().value == "7_11:2.50\t12:1.00"


def test_one_day_is_replaced(spark, tmp_path):
    path = str(tmp_path / "days")

    def day(d, *ids):
        return spark.createDataFrame([(i, d) for i in ids], "id int, dt string")

    writers.replace_day(day("d1", 1, 2).unionByName(day("d2", 3)), path)
    writers.replace_day(day("d2", 4), path)
    assert sorted((r.id, str(r.dt)) for r in spark.read.parquet(path).collect()) == [(1, "d1"), (2, "d1"), (4, "d2")]


def test_day_table(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS feedmill_days LOCATION '{tmp_path / 'db'}'")
    try:
        for d in ("d1", "d2"):
            writers.save_day_table(spark.createDataFrame([("u", "m", d)], "uid string, midlist string, dt string"), "feedmill_days.uploads")
        assert spark.table("feedmill_days.uploads").where("dt = 'd2'").count() == 1
    finally:
        spark.sql("DROP DATABASE feedmill_days CASCADE")


def test_materialise_uses_the_shared_folder(spark):
    df = spark.range(5).withColumn("t", F.lit("x"))
    fixed = session.materialise(df)
    assert fixed.schema["t"].dataType == df.schema["t"].dataType
    assert sorted(r.id for r in fixed.collect()) == list(range(5))
    folder = session.shared_dir(spark).rstrip("/")
    assert folder.replace("file:", "") in fixed.inputFiles()[0].replace("file://", "")
