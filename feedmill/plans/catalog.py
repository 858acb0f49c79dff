"""Queries over the sample tables: one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedmill.functions import lists
from feedmill.operators import candidates, causes, factors, ids, logstats, popularity, quality, scoring
from feedmill.operators import sets, state, topk
from feedmill.operators.joins import dimension_join
from feedmill.plans import bindings as b
from feedmill.plans import daily, reports, roundtrips
from feedmill.session import materialise
from feedmill.sources.readers import item_meta_of, last_days, read_behaviour, read_shards
from feedmill.sources.writers import write_by, write_tab_text

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

IOS_ONLY = ("android",)
K = 10
SMALL_MODEL = factors.Settings(rank=8, iterations=3, blocks=4)


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, column: str, digits: int) -> DataFrame:
    # Adding zero turns -0.0 into 0.0.
    return df.withColumn(column, F.round(column, digits) + 0.0)


# --- popularity, scores, ids ----------------------------------------------


@_query
def item_action_counts(spark, sf_dir):
    return popularity.item_action_counts(b.behaviour(spark, sf_dir))


_new_path = roundtrips.new_path


@_query
def behaviour_text_counts(spark, sf_dir):
    """The log written as tab-separated text and read back, then counted."""
    path = _new_path(spark)
    unused = F.lit("")
    log = b.behaviour(spark, sf_dir).select(
        "uid", "action", unused.alias("c2"), "mid", unused.alias("c4"), "extend"
    )
    write_tab_text(log, path)
    return popularity.item_action_counts(read_behaviour(spark, path))


def _good(spark, sf_dir, skip=5, pool_end=100, top=95):
    return popularity.good_items(item_action_counts(spark, sf_dir), skip, pool_end, top)


@_query
def good_items(spark, sf_dir):
    return _rounded(_good(spark, sf_dir, pool_end=80, top=30), "score", 6)


def _scores(spark, sf_dir):
    good = materialise(_good(spark, sf_dir))
    return scoring.user_item_score(b.behaviour(spark, sf_dir), good, min_items=45)


@_query
def user_item_score(spark, sf_dir):
    return _scores(spark, sf_dir)


@_query
def score_counters(spark, sf_dir):
    return scoring.score_counters(b.behaviour(spark, sf_dir), _good(spark, sf_dir))


@_query
def assign_ids(spark, sf_dir):
    return ids.assign_ids(b.purchases(spark, sf_dir))


@_query
def assign_dense_ids(spark, sf_dir):
    return ids.assign_dense_ids(b.purchases(spark, sf_dir))


def _ratings(spark, sf_dir):
    scores = materialise(_scores(spark, sf_dir))
    return ids.encode_ratings(scores, materialise(ids.assign_ids(scores)))


@_query
def id_rejects(spark, sf_dir):
    return ids.id_rejects(b.odd_ids(spark, sf_dir))


@_query
def encode_ratings(spark, sf_dir):
    return _ratings(spark, sf_dir)


@_query
def lookup(spark, sf_dir):
    pairs = b.purchases(spark, sf_dir)
    dictionary = materialise(ids.assign_ids(pairs))
    numbers = dictionary.where(F.col("kind") == ids.ITEM).select("num_id")
    return ids.lookup(numbers, dictionary)


@_query
def lookup_large(spark, sf_dir):
    """The same with a dictionary that is never shared, over every line of every order."""
    pairs = b.purchases(spark, sf_dir)
    dictionary = materialise(ids.assign_ids(pairs))
    items = ids.of_kind(dictionary, ids.ITEM, "mid", "num_id")
    return ids.lookup(pairs.join(items, "mid").select("num_id"), dictionary, max_rows=0)


@_query
def lookup_hot(spark, sf_dir):
    """Every line of every order, nine of ten of them for one item, against a dictionary that is never shared."""
    dictionary = materialise(ids.assign_ids(b.purchases(spark, sf_dir)))
    items = ids.of_kind(dictionary, ids.ITEM, "mid", "num_id")
    numbers = dimension_join(b.one_sided(spark, sf_dir), items, ["mid"])
    return ids.lookup(numbers.select("num_id"), dictionary, max_rows=0)


# --- factors and top-k -----------------------------------------------------


def _entries(recs: DataFrame) -> DataFrame:
    rows = recs.select("user", F.posexplode("items").alias("pos", "entry"))
    return rows.select("user", "pos", "entry.item", "entry.score")


@_query
def top_k_exact(spark, sf_dir):
    vectors = b.factors(spark, sf_dir)
    return _rounded(_entries(topk.recommend_top_k(vectors, vectors, K)), "score", 4)


@_query
def top_k_blocks(spark, sf_dir):
    vectors = b.factors(spark, sf_dir)
    recs = topk.recommend_top_k(vectors, vectors, K, max_item_bytes=0, block_bytes=64 << 10)
    return _rounded(_entries(recs), "score", 4)


@_query
def top_k_probed(spark, sf_dir):
    vectors = b.factors(spark, sf_dir)
    recs = topk.recommend_top_k(vectors, vectors, K, topk.Probe(clusters=3, min_size=2))
    return _rounded(_entries(recs), "score", 4)


@_query
def top_k_probed_blocks(spark, sf_dir):
    """Probing where the items are too many to share: blocks of each cluster's list."""
    vectors = b.factors(spark, sf_dir)
    probe = topk.Probe(clusters=3, min_size=2)
    recs = topk.recommend_top_k(vectors, vectors, K, probe, max_item_bytes=0, block_bytes=16 << 10)
    return _rounded(_entries(recs), "score", 4)


@_query
def probe_recall(spark, sf_dir):
    """How much of the exact lists the probed ones hold."""
    vectors = b.factors(spark, sf_dir)
    probed = topk.recommend_top_k(vectors, vectors, K, topk.Probe(clusters=3, min_size=2))
    return topk.recall(probed, topk.recommend_top_k(vectors, vectors, K))


@_query
def top_k_pruned(spark, sf_dir):
    """Exact lists over items of uneven length, from the products that the bound leaves."""
    recs = topk.top_k_by_norm(b.factors(spark, sf_dir), b.uneven_factors(spark, sf_dir), K)
    return _rounded(_entries(recs), "score", 4)


@_query
def top_k_pruned_blocks(spark, sf_dir):
    recs = topk.top_k_by_norm(
        b.factors(spark, sf_dir), b.uneven_factors(spark, sf_dir), K, max_item_bytes=0, block_bytes=32 << 10
    )
    return _rounded(_entries(recs), "score", 4)


@_query
def top_k_products(spark, sf_dir):
    """(users, pairs, products): pairs there are, and those that were scored."""
    users, items = b.factors(spark, sf_dir), b.uneven_factors(spark, sf_dir)
    recs = topk.top_k_by_norm(users, items, K, max_item_bytes=0, block_bytes=32 << 10)
    totals = recs.agg(F.count(F.lit(1)).alias("users"), F.sum("products").alias("products"))
    pairs = (F.col("users") * items.agg(F.count(F.lit(1))).scalar()).alias("pairs")
    return totals.select("users", pairs, "products")


@_query
def score_pairs(spark, sf_dir):
    """Every vector with another one."""
    vectors = b.factors(spark, sf_dir)
    return _rounded(topk.score_pairs(b.vector_pairs(spark, sf_dir), vectors, vectors), "score", 4)


@_query
def squared_error(spark, sf_dir):
    """Labels as ratings against the scores of the same pairs."""
    vectors = b.factors(spark, sf_dir)
    held_out = b.vector_pairs(spark, sf_dir)
    predicted = topk.score_pairs(held_out, vectors, vectors).withColumnRenamed("score", "prediction")
    return _rounded(factors.squared_error(held_out, predicted), "mse", 6)


@_query
def cluster_routes(spark, sf_dir):
    vectors = b.factors(spark, sf_dir)
    return topk.cluster_routes(vectors, vectors, topk.Probe(clusters=3, min_size=2))


@_query
def cluster_sizes(spark, sf_dir):
    return topk.cluster_sizes(b.factors(spark, sf_dir), above=2)


@_query
def scored_list_lines(spark, sf_dir):
    """Scored lists printed as text and read back."""
    vectors = b.factors(spark, sf_dir)
    recs = topk.recommend_top_k(vectors, vectors, K)
    named = F.transform(
        "items", lambda e: F.struct(e["item"].alias("mid"), e["score"].alias("score"))
    )
    text = recs.select(lists.scored_list_line(F.col("user"), named, digits=1).alias("line"))
    line = F.col("line")
    rows = text.select(
        lists.scored_list_owner(line).alias("owner"),
        F.posexplode(lists.scored_list_items(line)).alias("pos", "entry"),
    )
    return rows.select("owner", "pos", "entry.mid")


@_query
def decode_recommendations(spark, sf_dir):
    vectors = b.factors(spark, sf_dir)
    recs = topk.recommend_top_k(vectors, vectors, K)
    decoded = ids.decode_recommendations(recs, b.factor_ids(spark, sf_dir))
    return candidates.list_rows(decoded)


@_query
def decode_triples(spark, sf_dir):
    vectors = b.factors(spark, sf_dir)
    triples = _entries(topk.recommend_top_k(vectors, vectors, K)).drop("pos")
    return _rounded(ids.decode_triples(triples, b.factor_ids(spark, sf_dir)), "score", 4)


@_query
def shard_factors(spark, sf_dir):
    return factors.shard_by_hash(b.factors(spark, sf_dir)).select("id", "shard")


@_query
def shard_files(spark, sf_dir):
    """Shards written one directory each and read back by their list."""
    path = _new_path(spark)
    write_by(factors.shard_by_hash(b.factors(spark, sf_dir)), path, "shard")
    return read_shards(spark, path, range(100)).select("id", "shard")


@_query
def shard_kmeans(spark, sf_dir):
    vectors = b.factors(spark, sf_dir)
    sharded = factors.shard_by_cluster(vectors, factors.fit_clusters(vectors, k=10))
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


@_query
def train_recommend(spark, sf_dir):
    model = factors.train(_ratings(spark, sf_dir), SMALL_MODEL)
    return _entries(topk.recommend_top_k(model.userFactors, model.itemFactors, K))


@_query
def recommend_for_all(spark, sf_dir):
    model = factors.train(_ratings(spark, sf_dir), SMALL_MODEL)
    return _entries(factors.recommend_for_all(model, K))


@_query
def evaluate(spark, sf_dir):
    return factors.evaluate(materialise(_ratings(spark, sf_dir)), SMALL_MODEL)


@_query
def grid(spark, sf_dir):
    return factors.grid(
        materialise(_ratings(spark, sf_dir)), (4, 8), (0.04,), (2, 3), SMALL_MODEL
    )


@_query
def train_checks(spark, sf_dir):
    """What of a fitted model does not hang on the fit: its users and items, the length and the sign of its vectors."""
    model = factors.train(_ratings(spark, sf_dir), SMALL_MODEL)
    out = []
    for kind, vectors in (("user", model.userFactors), ("item", model.itemFactors)):
        found = vectors.agg(
            F.count_distinct("id").alias("vectors"),
            F.min(F.size("features")).alias("shortest"),
            F.max(F.size("features")).alias("longest"),
            F.bool_and(F.array_min("features") >= 0).alias("not_negative"),
        )
        out.append(found.select(F.lit(kind).alias("kind"), "*"))
    return out[0].unionByName(out[1])


@_query
def recommend_checks(spark, sf_dir):
    """Every user of a model has a full list of different items whose scores fall, as Spark's own routine has them."""
    model = factors.train(_ratings(spark, sf_dir), SMALL_MODEL)
    rows = _entries(factors.recommend_for_all(model, K))
    own = model.recommendForAllUsers(K).select("user", F.posexplode("recommendations").alias("pos", "entry"))
    own = own.select(F.col("user").cast("bigint").alias("user"), "pos", F.col("entry.rating").alias("rating"))
    before = F.lag("score").over(Window.partitionBy("user").orderBy("pos"))
    both = rows.withColumn("before", before).join(own, ["user", "pos"])
    return both.groupBy("user").agg(
        F.count_distinct("item").alias("items"),
        F.bool_and(F.coalesce(F.col("score") <= F.col("before"), F.lit(True))).alias("falling"),
        F.bool_and(F.abs(F.col("score") - F.col("rating")) < 1e-3).alias("as_sparks"),
    )


@_query
def evaluate_pairs(spark, sf_dir):
    """What of the evaluation does not hang on the fit."""
    return evaluate(spark, sf_dir).drop("mse")


@_query
def grid_pairs(spark, sf_dir):
    return grid(spark, sf_dir).drop("mse")


@_query
def shard_kmeans_checks(spark, sf_dir):
    """Every vector in one leaf, as many leaves as asked for, and a cost that more leaves only lower."""
    vectors = b.factors(spark, sf_dir)
    models = [factors.fit_clusters(vectors, k) for k in (2, 4, 10)]
    costs = [factors.training_cost(m) for m in models]
    sharded = factors.shard_by_cluster(vectors, models[-1])
    falling = all(x >= y for x, y in zip(costs, costs[1:], strict=False))
    return sharded.agg(
        F.count(F.lit(1)).alias("vectors"), F.count_distinct("id").alias("ids"), F.count_distinct("shard").alias("leaves")
    ).withColumn("falling", F.lit(falling))


@_query
def model_files(spark, sf_dir):
    return roundtrips.model_files(spark, sf_dir, materialise(_ratings(spark, sf_dir)), SMALL_MODEL)


for _form in (
    roundtrips.client_log_by_position,
    roundtrips.exposure_by_position,
    roundtrips.behaviour_of_two_paths,
    roundtrips.id_text,
    roundtrips.state_text,
    roundtrips.scored_list_text,
    roundtrips.factor_files,
    roundtrips.replaced_day,
    roundtrips.day_table,
    roundtrips.months_by_glob,
    roundtrips.export_kv_order,
    roundtrips.candidate_json_rows,
    roundtrips.candidate_json_rejects,
):
    _query(_form)


# --- candidates and state --------------------------------------------------


@_query
def list_rows(spark, sf_dir):
    return candidates.list_rows(b.candidates(spark, sf_dir))


@_query
def candidate_lines(spark, sf_dir):
    """Candidate lists printed as text and read back."""
    text = b.candidates(spark, sf_dir).select(
        F.concat_ws("\t", "uid", F.array_join("mids", ",")).alias("line")
    )
    read = text.select(
        lists.candidate_owner(F.col("line"), "\t").alias("uid"),
        lists.candidate_mids(F.col("line"), "\t").alias("mids"),
    )
    return candidates.list_rows(read)


@_query
def last_days_window(spark, sf_dir):
    recent = last_days(b.history(spark, sf_dir), "20010801", 30)
    return recent.withColumn("dt", F.col("dt").cast("string"))


@_query
def remove_seen(spark, sf_dir):
    left = candidates.remove_seen(b.candidates(spark, sf_dir), b.history(spark, sf_dir))
    return candidates.list_rows(left)


@_query
def seen_counters(spark, sf_dir):
    return candidates.seen_counters(b.candidates(spark, sf_dir), b.history(spark, sf_dir))


def _meta(spark, sf_dir):
    return item_meta_of(b.item_meta(spark, sf_dir), b.META_DAY)


@_query
def item_meta_day(spark, sf_dir):
    return _meta(spark, sf_dir)


@_query
def enrich(spark, sf_dir):
    lists_ = candidates.enrich(b.candidates(spark, sf_dir), _meta(spark, sf_dir), cap=30)
    rows = lists_.select(F.col("uid").alias("owner"), F.posexplode("items").alias("pos", "entry"))
    return rows.select("owner", "pos", "entry.*")


@_query
def candidate_json(spark, sf_dir):
    lists_ = candidates.enrich(b.candidates(spark, sf_dir), _meta(spark, sf_dir), cap=30)
    return lists_.select("uid", candidates.items_json(F.col("items")).alias("list"))


@_query
def merge_state(spark, sf_dir):
    return state.merge_state(b.new_lists(spark, sf_dir), b.base_state(spark, sf_dir))


@_query
def merge_state_counters(spark, sf_dir):
    return state.merge_state_counters(b.new_lists(spark, sf_dir), b.base_state(spark, sf_dir))


@_query
def merge_state_rejects(spark, sf_dir):
    return state.merge_state_rejects(b.new_lists(spark, sf_dir), b.spoilt_state(spark, sf_dir))


@_query
def nameless_rows(spark, sf_dir):
    base = b.nameless_state(spark, sf_dir)
    return state.nameless_rows(b.new_lists(spark, sf_dir), base)


@_query
def merge_state_nameless(spark, sf_dir):
    """The merge over a base of which every thirteenth row names no user."""
    return state.merge_state(b.new_lists(spark, sf_dir), b.nameless_state(spark, sf_dir))


@_query
def merge_state_spoilt_counters(spark, sf_dir):
    return state.merge_state_counters(b.new_lists(spark, sf_dir), b.spoilt_state(spark, sf_dir))


@_query
def export_kv_plan(spark, sf_dir):
    return state.export_plan(b.exported_state(spark, sf_dir))


@_query
def export_kv_plan_video(spark, sf_dir):
    return state.export_plan(b.exported_state(spark, sf_dir), parts=4)


@_query
def export_kv_files(spark, sf_dir):
    """The export written and read back."""
    path = _new_path(spark)
    state.export_kv(b.exported_state(spark, sf_dir), path)
    return spark.read.parquet(path).select("part", "key", "payload")


@_query
def daily_candidates(spark, sf_dir):
    """The whole chain, from events to the day's candidate table."""
    settings = daily.DailySettings(
        skip=5, pool_end=100, top_items=95, min_items=10, min_users=1, k=95, factorisation=SMALL_MODEL
    )
    return daily.todays_state(
        b.behaviour(spark, sf_dir),
        b.behaviour(spark, sf_dir).select("uid", "mid"),
        _event_item_meta(spark, sf_dir),
        b.base_state(spark, sf_dir),
        settings,
    )


@_query
def daily_state_sets(spark, sf_dir):
    """(uid, ttl, fresh, entries) of a day whose base holds some of today's users: all but the order in the lists."""
    settings = daily.DailySettings(
        skip=5, pool_end=100, top_items=95, min_items=10, min_users=1, k=95, factorisation=SMALL_MODEL
    )
    log = b.behaviour(spark, sf_dir)
    state_ = daily.todays_state(
        log, log.select("uid", "mid"), _event_item_meta(spark, sf_dir), b.members_state(spark, sf_dir), settings
    )
    fresh = F.startswith("list", F.lit("["))
    entries = F.coalesce(F.json_array_length(F.when(fresh, F.col("list"))), F.lit(0))
    return state_.select("uid", "ttl", fresh.alias("fresh"), entries.alias("entries"))


def _event_item_meta(spark, sf_dir):
    """Metadata of the items that events name."""
    return b.behaviour(spark, sf_dir).select(
        "mid", F.right("mid", F.lit(2)).alias("uid"), F.concat(F.lit("1034:"), "mid").alias("object_id")
    ).distinct()


# --- log reports -----------------------------------------------------------


@_query
def diversion_records(spark, sf_dir):
    return logstats.diversion_records(b.client_log(spark, sf_dir))


@_query
def diversion_counts(spark, sf_dir):
    return logstats.diversion_counts(diversion_records(spark, sf_dir))


@_query
def diversion_events(spark, sf_dir):
    return logstats.diversion_events(b.client_log(spark, sf_dir))


@_query
def daily_consume(spark, sf_dir):
    return logstats.daily_consume(b.client_log(spark, sf_dir))


@_query
def author_exposure(spark, sf_dir):
    return logstats.author_exposure(b.exposure(spark, sf_dir))


@_query
def tab_consumers(spark, sf_dir):
    return logstats.tab_consumers(b.client_log(spark, sf_dir))


@_query
def tab_consumers_ios(spark, sf_dir):
    return logstats.tab_consumers(b.client_log(spark, sf_dir), IOS_ONLY)


@_query
def tab_consumer_causes(spark, sf_dir):
    return logstats.tab_consumer_causes(b.client_log(spark, sf_dir))


@_query
def diversion_causes(spark, sf_dir):
    return logstats.diversion_causes(b.client_log(spark, sf_dir))


@_query
def find_users_causes(spark, sf_dir):
    return causes.cause_counts(b.client_log(spark, sf_dir), causes.find_users_rule())


@_query
def depth_causes(spark, sf_dir):
    return causes.cause_counts(b.client_log(spark, sf_dir), causes.depth_rule())


@_query
def source_causes(spark, sf_dir):
    return causes.cause_counts(b.client_log(spark, sf_dir), causes.source_rule())


@_query
def daily_consume_causes(spark, sf_dir):
    return causes.cause_counts(b.client_log(spark, sf_dir), causes.daily_consume_rule())


@_query
def exposure_causes(spark, sf_dir):
    return causes.exposure_causes(b.exposure(spark, sf_dir))


@_query
def report_run_counters(spark, sf_dir):
    """Every report written by one run, and what each left out, counted by the passes that wrote them."""
    path = _new_path(spark)
    counts = reports.run_reports(b.client_log(spark, sf_dir), b.exposure(spark, sf_dir), path)
    rows = [(report, cause, n) for report, own in counts.items() for cause, n in own.items() if n]
    return spark.createDataFrame(rows, "report string, cause string, n long")


@_query
def depth_report(spark, sf_dir):
    return logstats.depth_report(b.client_log(spark, sf_dir))


@_query
def depth_report_ios(spark, sf_dir):
    return logstats.depth_report(b.client_log(spark, sf_dir), IOS_ONLY)


@_query
def find_users(spark, sf_dir):
    return logstats.find_users(b.client_log(spark, sf_dir))


@_query
def source_report(spark, sf_dir):
    return logstats.source_report(b.client_log(spark, sf_dir))


# --- sets and gates --------------------------------------------------------


def _all_and_recent(spark, sf_dir):
    everyone = b.base_state(spark, sf_dir).select(F.col("uid").alias("id"))
    return everyone, b.new_lists(spark, sf_dir).select(F.col("uid").alias("id"))


@_query
def id_difference(spark, sf_dir):
    return sets.id_difference(*_all_and_recent(spark, sf_dir))


@_query
def id_coverage(spark, sf_dir):
    return sets.id_coverage(*_all_and_recent(spark, sf_dir))


@_query
def require_rows(spark, sf_dir):
    return quality.require_rows(item_action_counts(spark, sf_dir), 1)
