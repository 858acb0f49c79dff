"""Queries that write a form and read it back: text, positional columns, days, models, keyed files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from feedmill.functions import lists
from feedmill.operators import candidates, factors, ids, logstats, popularity, state, topk
from feedmill.plans import bindings as b
from feedmill.session import materialise, shared_dir
from feedmill.sources import readers, writers


def new_path(spark) -> str:
    return f"{shared_dir(spark).rstrip('/')}/feedmill-files-{uuid.uuid4().hex}"


def _by_position(df, positions: dict[str, int]):
    """The columns at their places among unnamed ones."""
    at = {place: name for name, place in positions.items()}
    return df.select(*[(F.col(at[k]) if k in at else F.lit("")).alias(f"_c{k}") for k in range(max(at) + 2)])


def client_log_by_position(spark, sf_dir):
    """Diversion records of a log stored without names, in parquet."""
    path = new_path(spark)
    _by_position(b.client_log(spark, sf_dir), readers.schemas.CLIENT_LOG_POSITIONS).write.parquet(path)
    return logstats.diversion_records(readers.read_client_log(spark, path))


def exposure_by_position(spark, sf_dir):
    """Items per author of an exposure log stored without names, in ORC."""
    path = new_path(spark)
    _by_position(b.exposure(spark, sf_dir), readers.schemas.EXPOSURE_POSITIONS).write.orc(path)
    return logstats.author_exposure(readers.read_exposure(spark, path, "orc"))


def behaviour_of_two_paths(spark, sf_dir):
    """The log in two folders, read as one list of paths."""
    log, paths = b.behaviour(spark, sf_dir), [new_path(spark), new_path(spark)]
    for path, own in zip(paths, (F.col("action") == "play", F.col("action") != "play"), strict=True):
        unused = F.lit("")
        part = log.where(own).select("uid", "action", unused.alias("c2"), "mid", unused.alias("c4"), "extend")
        writers.write_tab_text(part, path)
    return popularity.item_action_counts(readers.read_behaviour(spark, paths))


def id_text(spark, sf_dir):
    """Ids of both kinds as ``real<tab>number_kind`` lines, one folder each, and back."""
    numbered, path = materialise(ids.assign_ids(b.purchases(spark, sf_dir))), new_path(spark)
    read = []
    for kind in (ids.USER, ids.ITEM):
        own = numbered.where(F.col("kind") == kind)
        line = F.concat_ws("\t", "real_id", F.concat_ws("_", F.col("num_id").cast("string"), F.lit(kind)))
        writers.write_lines(own, line, f"{path}/{kind}")
        read.append(readers.read_id_list(spark, f"{path}/{kind}", kind))
    return read[0].unionByName(read[1])


def state_text(spark, sf_dir):
    """The state as text lines, a ttl on every eleventh row that is no number (here -1), and back."""
    path = new_path(spark)
    spoilt = b.base_state(spark, sf_dir).withColumn(
        "ttl", F.when(F.col("uid").cast("bigint") % 11 == 0, "soon").otherwise(F.col("ttl").cast("string"))
    )
    writers.write_tab_text(spoilt, path)
    return readers.read_state(spark, path).select("uid", "list", F.coalesce("ttl", F.lit(-1)).alias("ttl"))


def scored_list_text(spark, sf_dir):
    """Scored lists as text files and back; scores have a digit."""
    path, vectors = new_path(spark), b.factors(spark, sf_dir)
    recs = topk.recommend_top_k(vectors, vectors, 10)
    named = F.transform("items", lambda e: F.struct(e["item"].alias("mid"), e["score"].alias("score")))
    writers.write_lines(recs, lists.scored_list_line(F.col("user"), named, digits=1), path)
    read = readers.read_scored_lists(spark, path)
    rows = read.select("user", F.posexplode("items").alias("pos", "entry"))
    return rows.select("user", "pos", "entry.item")


def factor_files(spark, sf_dir):
    """Vectors written and read: their length, and that it was kept."""
    path = new_path(spark)
    b.factors(spark, sf_dir).write.parquet(path)
    read = readers.read_factors(spark, path)
    return read.select("id", F.size("features").alias("width"), F.element_at("features", 1).cast("double").alias("first"))


def replaced_day(spark, sf_dir):
    """Three days of state; the second is replaced by other rows, the others stay."""
    path, base = new_path(spark), b.base_state(spark, sf_dir)
    days = F.explode(F.array(*[F.lit(d) for d in ("20240101", "20240102", "20240103")])).alias("dt")
    writers.replace_day(base.select("*", days), path)
    writers.replace_day(base.where("ttl > 20").withColumn("list", F.lit("again")).withColumn("dt", F.lit("20240102")), path)
    read = spark.read.schema("uid string, list string, ttl int, dt string").parquet(path)
    return read.select("dt", "uid", F.coalesce("list", F.lit("")).alias("list"), "ttl")


def day_table(spark, sf_dir):
    """Two days appended to a catalogue table, and its state day bucketed by user."""
    name, base = f"feedmill_{uuid.uuid4().hex}", b.base_state(spark, sf_dir)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark)}'")
    try:
        writers.save_day_table(base.where("ttl <= 15").withColumn("dt", F.lit("20240101")), f"{name}.state")
        writers.save_day_table(base.where("ttl > 15").withColumn("dt", F.lit("20240102")), f"{name}.state")
        writers.save_state_day(base.withColumn("dt", F.lit("20240103")), f"{name}.bucketed", 4)
        both = spark.table(f"{name}.state").unionByName(spark.table(f"{name}.bucketed"))
        return materialise(both.select("dt", "uid", "ttl"))
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def months_by_glob(spark, sf_dir):
    """A history with a folder for each month, of which a pattern names three."""
    path, history = new_path(spark), b.history(spark, sf_dir)
    writers.write_by(history.withColumn("month", F.date_format("dt", "yyyyMM")), path, "month")
    return spark.read.parquet(f"{path}/month=20010[5-7]").select("uid", "mid", F.col("dt").cast("string").alias("dt"))


def model_files(spark, sf_dir, ratings, settings):
    """(kind, vectors, equal): a fitted model saved and loaded, its vectors compared with those in memory."""
    model, path = factors.train(ratings, settings), new_path(spark)
    writers.save_model(model, path)
    read = readers.load_model(path)
    out = []
    for kind in ("userFactors", "itemFactors"):
        own = getattr(model, kind).select("id", F.col("features").alias("own"))
        both = own.join(getattr(read, kind), "id", "full_outer")
        equal = F.coalesce(F.bool_and(F.col("own").eqNullSafe(F.col("features"))), F.lit(True)).alias("equal")
        out.append(both.agg(F.count("features").alias("vectors"), equal).select(F.lit(kind).alias("kind"), "vectors", "equal"))
    return out[0].unionByName(out[1])


def export_kv_order(spark, sf_dir):
    """(part, keys, smallest, largest, ascending, apart) of the exported files, by their rows' places in them.

    ``ascending``: in every file each key is above the one before; ``apart``: no two files of a part overlap.
    """
    path = new_path(spark)
    state.export_kv(b.exported_state(spark, sf_dir), path)
    read = spark.read.parquet(path).select(
        "part", "key", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    return state.export_order(read)


def candidate_json_rows(spark, sf_dir):
    """Stored lists as JSON, read back into entries; every thirteenth is cut short and gives none."""
    return candidates.json_entries(_stored_json(spark, sf_dir))


def candidate_json_rejects(spark, sf_dir):
    """The stored lists that cannot be read."""
    return candidates.json_rejects(_stored_json(spark, sf_dir)).select("uid", F.length("list").alias("characters"))


def _stored_json(spark, sf_dir):
    meta = readers.item_meta_of(b.item_meta(spark, sf_dir), b.META_DAY)
    found = candidates.enrich(b.candidates(spark, sf_dir), meta, cap=30)
    text = candidates.items_json(F.col("items"))
    cut = F.when(F.col("uid").cast("bigint") % 13 == 0, F.substring(text, 1, 20)).otherwise(text)
    path = new_path(spark)
    writers.write_tab_text(found.select("uid", cut.alias("list")), path)
    return readers.read_new_lists(spark, path)
