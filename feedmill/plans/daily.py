"""The daily chain, from behaviour logs to today's candidate table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.operators.candidates import enrich_rows, items_json, unseen_rows
from feedmill.operators.factors import Settings, fit_clusters, shard_by_cluster, train
from feedmill.operators.ids import assign_dense_ids, assign_ids, decode_rows, encode_ratings
from feedmill.operators.popularity import good_items, item_action_counts
from feedmill.operators.quality import RunCounters, require_rows
from feedmill.operators.scoring import user_item_score
from feedmill.operators.state import TTL_DAYS, aged, export_kv, merge_state
from feedmill.operators.topk import Probe, recommend_top_k
from feedmill.schemas import STATE
from feedmill.session import materialise, scratch
from feedmill.sources.readers import item_meta_of, last_days
from feedmill.sources.writers import replace_day


class NoBase(ValueError):
    """There is no earlier candidate table, and nobody said that this is the first run."""


_STORED = T.StructType(STATE.fields + [T.StructField("dt", T.StringType())])


@dataclass(frozen=True)
class DailySettings:
    skip: int = 200
    pool_end: int = 300_000
    top_items: int = 100_000
    min_items: int = 50
    max_items: int = 2000
    min_users: int = 10_000
    k: int = 300
    cap: int = 200
    ttl: int = TTL_DAYS
    score_days: int = 8
    seen_days: int = 30
    export_parts: int = 8
    bucketed_ids: bool = False
    probe: Probe | None = None
    probe_clusters: int = 100
    factorisation: Settings = field(default_factory=Settings)


def todays_lists(
    behaviour: DataFrame,
    history: DataFrame,
    meta: DataFrame,
    s: DailySettings = DailySettings(),
    counters: RunCounters | None = None,
) -> DataFrame:
    """(uid, items): enriched recommendations of every active user.

    Scores, ids and decoded candidates feed several later steps each and are
    written once.  Candidates stay rows until the last step.  ``counters`` get
    ``ids`` (where they are bucketed, so that some may have no number),
    ``decode`` and ``seen`` from the passes that run anyway.
    """

    def watch(name: str):
        return counters.watch(name) if counters is not None else None

    counts = item_action_counts(behaviour)
    good = require_rows(materialise(good_items(counts, s.skip, s.pool_end, s.top_items)))
    scores = materialise(user_item_score(behaviour, good, s.min_items, s.max_items))
    ids = materialise(assign_ids(scores, watch("ids")) if s.bucketed_ids else assign_dense_ids(scores))
    require_rows(ids.where(F.col("kind") == "uid"), s.min_users)
    model = train(encode_ratings(scores, ids), s.factorisation)
    users, items = model.userFactors, model.itemFactors
    if s.probe is not None:
        # Users go to the clusters of the items, so that both sides speak of the same ones.
        clusters = fit_clusters(items, s.probe_clusters)
        users, items = (
            materialise(shard_by_cluster(f, clusters).withColumnRenamed("shard", "cluster")) for f in (users, items)
        )
    recs = recommend_top_k(users, items, s.k, s.probe)
    candidates = materialise(decode_rows(recs, ids, watch("decode")))
    return enrich_rows(unseen_rows(candidates, history, good, watch("seen")), meta, s.cap)


def todays_state(
    behaviour: DataFrame,
    history: DataFrame,
    meta: DataFrame,
    base: DataFrame,
    s: DailySettings = DailySettings(),
    counters: RunCounters | None = None,
) -> DataFrame:
    """Candidate table of the day: today's lists over yesterday's table."""
    lists = todays_lists(behaviour, history, meta, s, counters)
    new = materialise(lists.select("uid", items_json(F.col("items")).alias("list")))
    return merge_state(new, base, s.ttl, counters.watch("merge") if counters is not None else None)


def newest_base(stored: DataFrame, day: str) -> tuple[DataFrame, int] | None:
    """The newest stored day before ``day``, and by how many days more than one it lies back."""
    newest = stored.where(F.col("dt") < day).agg(F.max("dt")).first()[0]
    if newest is None:
        return None
    gap = (dt.datetime.strptime(day, "%Y%m%d") - dt.datetime.strptime(newest, "%Y%m%d")).days
    return stored.where(F.col("dt") == newest).drop("dt"), gap - 1


def run_day(
    log: DataFrame,
    meta: DataFrame,
    day: str,
    state_path: str,
    export_path: str,
    s: DailySettings = DailySettings(),
    first_run: bool = False,
) -> dict[str, int]:
    """Compute, store and export the candidate table of ``day`` (yyyyMMdd); gives the counters of the run.

    They are the merge's, ``entries`` and ``missing`` of the decoded lists, ``kept`` and ``removed`` of the seen
    items and, with bucketed ids, ``ids``, ``short_ids`` and ``no_number_ids``; none of them needs a job of its own.

    ``log`` and ``meta`` are partitioned by ``dt``; the table at ``state_path``
    holds one partition per day, and today's is replaced.  The base is the
    newest day before: with days left out, its lists age by each of them.  No
    earlier day is an error, and so is a day without metadata; only a
    ``first_run`` starts from an empty base.
    """
    spark = log.sparkSession
    yesterday = f"{dt.datetime.strptime(day, '%Y%m%d') - dt.timedelta(days=1):%Y%m%d}"
    if first_run:
        base = spark.createDataFrame([], STATE)
    else:
        found = newest_base(spark.read.schema(_STORED).parquet(state_path), day)
        if found is None:
            raise NoBase(f"{state_path} holds no day before {day}")
        base = aged(*found)
    todays_meta = require_rows(item_meta_of(meta, yesterday))
    counters = RunCounters()
    with scratch(spark):
        state = todays_state(
            last_days(log, day, s.score_days), last_days(log, day, s.seen_days), todays_meta, base, s, counters
        )
        replace_day(state.withColumn("dt", F.lit(day)), state_path)
    today = spark.read.schema(_STORED).parquet(state_path).where(F.col("dt") == day)
    export_kv(today, export_path, s.export_parts)
    return {name: n for counts in counters.counts().values() for name, n in counts.items()}
