"""Mixing sources to target weights: repetition rates per source, hash-seeded copies per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.operators.ranking import global_rank
from feedmill.session import materialise

WEIGHTS = (5, 2, 1)
#: Words of the whole mix, as a share (numerator, denominator) of all words.
BUDGET = (3, 2)
#: A source is repeated this often at most.
MAX_REPEATS = 2
SEED = "mix"

_WORD = "[^\\x20\\x09-\\x0D]+"


def sized(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size and a draw in [0, 1) for every row.

    A NULL text has size 0.  The draw depends on the seed, the doc_id and the text alone, so it
    is the same in every run and for a retried task; equal rows draw the same.
    """
    text = F.coalesce("text", F.lit(""))
    code = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    return documents.select(
        "doc_id",
        "source",
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("size"),
        (F.conv(F.substring(code, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))).alias("draw"),
    )


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """source, source_size, target, where ``sizes`` has a source and a size.

    Sources take the weights in turn, by code point, NULL last.  Each round shares what is left of
    the budget by weight; sources that reach their cap stay there and leave the sharing.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = global_rank(totals, order, "_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    table = materialise(
        ranked.select("source", "source_size", weight.cast("long").alias("w"), (F.col("source_size") * MAX_REPEATS).alias("cap"))
    )
    up, down = BUDGET
    whole = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # Shares are w * left / (down * open_w); whole numbers until the last division.
    left, open_w, capped = up * whole, None, None
    while True:
        over = F.lit(False) if open_w is None else F.col("cap") * F.lit(down * open_w) <= F.col("w") * F.lit(left)
        caps, free, n = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0)),
            F.coalesce(F.sum(F.when(over, 1)), F.lit(0)),
        ).first()
        left, open_w = up * whole - down * caps, free
        if n == capped or not free:
            break
        capped = n
    share = (
        F.col("w") * F.lit(left).cast("double") / F.lit(down * open_w).cast("double") if open_w else F.col("cap").cast("double")
    )
    return table.select("source", "source_size", F.least(F.col("cap").cast("double"), share).alias("target"))


def repetition(documents: DataFrame, weights: Sequence[int] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and ``copies``, one row for each row of documents.

    A source's rate is its target over its size; a document gets floor(rate) copies and one more
    when its draw is below the fraction.  A source without words has rate 0.
    """
    rows = materialise(sized(documents, seed))
    targets = source_targets(rows, weights)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # The broadcast is Spark's choice, by the measured size of the table of sources.
    joined = rows.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    copies = F.floor(rate) + (F.col("draw") < rate - F.floor(rate)).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", "draw", copies.alias("copies"))


def mix(documents: DataFrame, weights: Sequence[int] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each document of ``documents`` as often as its copies, with its columns and ``copy`` from 0.

    Where ``documents`` has a column of that name, the number is left out.
    """
    sizes = sized(documents, seed)
    targets = source_targets(materialise(sizes.select("source", "size")), weights)
    named = targets.select(
        F.struct("source").alias("_key"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_rate"),
    )
    text = F.coalesce("text", F.lit(""))
    code = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    draw = F.conv(F.substring(code, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    rows = documents.withColumn("_draw", draw).join(named, F.struct("source") == F.col("_key"))
    copies = F.floor("_rate") + (F.col("_draw") < F.col("_rate") - F.floor("_rate")).cast("long")
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("copy")
    every = rows.where(copies > 0).select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), numbers)
    columns = [F.col(f"_row.`{c}`").alias(c) for c in documents.columns]
    return every.select(*columns, *(["copy"] if "copy" not in documents.columns else []))
