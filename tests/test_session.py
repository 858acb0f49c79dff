"""Copies made in a block are gone after it, those that outlive it stay."""

import pathlib
import time

from pyspark.sql import functions as F

from feedmill.session import SHUFFLE_CLEANUP, materialise, scratch, short_shuffles


def folder(df):
    return pathlib.Path(df.inputFiles()[0].removeprefix("file:")).parent


def test_scratch_removes_its_copies(spark):
    with scratch(spark):
        with scratch(spark):
            inner, kept = materialise(spark.range(3)), materialise(spark.range(4), outlive=1)
            places = folder(inner), folder(kept)
            assert inner.count() == 3
        assert [p.exists() for p in places] == [False, True]
        assert kept.count() == 4
        beyond = materialise(spark.range(5), outlive=1)
    assert not places[1].exists()
    assert beyond.count() == 5


def test_a_failing_block_cleans_up_too(spark):
    places = []
    try:
        with scratch(spark):
            places.append(folder(materialise(spark.range(2))))
            raise KeyError
    except KeyError:
        pass
    assert not places[0].exists()


def test_short_shuffles_holds_in_its_block_alone(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    try:
        with short_shuffles(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
            counted = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
            # A plan that runs again still has all its rows.
            assert [len(counted.collect()) for _ in range(2)] == [7, 7]
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_a_written_copy_leaves_no_shuffle_files(spark):
    folders = [pathlib.Path(p) for p in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def shuffles():
        return {p.name for folder in folders for p in folder.rglob("shuffle_*")}

    with scratch(spark), short_shuffles(spark):
        before = shuffles()
        copy = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
        assert copy.count() == 7
        for _ in range(50):  # executors remove them soon after
            if not (left := shuffles() - before):
                break
            time.sleep(0.1)
        assert not left
