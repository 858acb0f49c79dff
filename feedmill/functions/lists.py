"""Text forms of ids, scored lists and candidate lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_num_id(text: Column) -> Column:
    """``123_uid`` -> 123."""
    return F.substring_index(text, "_", 1).try_cast("bigint")


def scored_list_owner(line: Column) -> Column:
    return F.substring_index(line, "_", 1)


def scored_list_items(line: Column) -> Column:
    """``u_m:s<tab>m:s`` -> array of (mid, score)."""
    body = F.get(F.split(line, "_"), F.lit(1))
    return F.transform(
        F.split(body, "\t"),
        lambda pair: F.struct(
            F.substring_index(pair, ":", 1).alias("mid"),
            F.get(F.split(pair, ":"), F.lit(1)).try_cast("double").alias("score"),
        ),
    )


def scored_list_line(owner: Column, items: Column, digits: int = 2) -> Column:
    """Inverse of the two above; ``items`` is an array of (mid, score)."""
    pairs = F.transform(
        items,
        lambda e: F.concat(
            e["mid"].cast("string"),
            F.lit(":"),
            F.format_string(f"%.{digits}f", F.round(e["score"].cast("double"), digits)),
        ),
    )
    return F.concat(owner.cast("string"), F.lit("_"), F.array_join(pairs, "\t"))


def candidate_owner(line: Column, sep: str) -> Column:
    return F.substring_index(line, sep, 1)


def candidate_mids(line: Column, sep: str) -> Column:
    """``u<sep>m,m`` -> array of mids; trailing empty entries are dropped."""
    body = F.regexp_replace(F.get(F.split(line, sep), F.lit(1)), ",+$", "")
    return F.when(body != "", F.split(body, ","))


def in_order(position: str, *fields: str) -> Column:
    """Aggregate: the group's fields as an array in order of position."""
    entry = F.struct(F.col(position), *[F.col(f) for f in fields])
    ordered = F.sort_array(F.collect_list(entry))
    if len(fields) == 1:
        return F.transform(ordered, lambda e: e[fields[0]])
    return F.transform(ordered, lambda e: F.struct(*[e[f].alias(f) for f in fields]))
