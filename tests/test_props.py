"""Property bags against a plain model of split-based parsing."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedmill.functions.props import FIRST, PAIR, REST, framed, prop, readable, repeats

KEYS = ["page", "index", "ind", "x"]
RULES = [FIRST, PAIR, REST]


def split(text, sep):
    """Split that drops trailing empty parts; no separator gives the text itself."""
    parts = text.split(sep)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model(bag, rule):
    """Dictionary of the bag, or None where it spoils the record."""
    found = {}
    for piece in split(bag, "|"):
        parts = split(piece, ":")
        if rule == FIRST:
            if len(parts) < 2:
                return None
            found[parts[0]] = parts[1]
        elif rule == PAIR:
            if len(parts) == 2:
                found[parts[0]] = parts[1]
            elif len(parts) == 1:
                found[parts[0]] = ""
        else:
            if not parts:
                return None
            found[parts[0]] = ":".join(parts[1:])
    return found


def key_count(bag, key):
    return sum(1 for piece in split(bag, "|") if (split(piece, ":") or [None])[0] == key)


def read_all(spark, bags):
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bags)], "i int, bag string")
    bag = F.col("bag")
    columns = [prop(bag, k, r).alias(f"{r}_{k}") for r in RULES for k in KEYS]
    columns += [readable(bag, r).alias(f"{r}_ok") for r in RULES]
    columns += [repeats(bag, "page").alias("twice")]
    out = rows.select("i", framed(bag).alias("bag")).select("i", *columns)
    return [r.asDict() for r in out.orderBy("i").collect()]


def check(bags, results):
    for bag, row in zip(bags, results):
        for rule in RULES:
            expected = model(bag, rule)
            # A bag of bars alone has no pairs: it may count as spoilt, it holds nothing.
            if set(bag) != {"|"}:
                assert row[f"{rule}_ok"] == (expected is not None), (bag, rule)
            if expected is not None:
                for key in KEYS:
                    assert row[f"{rule}_{key}"] == expected.get(key), (bag, rule, key)
        if model(bag, REST) is not None:
            assert row["twice"] == (key_count(bag, "page") > 1), bag


CASES = [
    "page:1|index:2",
    "page:1|page:2",
    "page|page",
    "page|index:3|page:4",
    "page:1:2:3|index::|x",
    "page::1|index:1",
    "index:a|index:b:c",
    "index:a|index:b:c|index",
    "index:a|",
    "index:a||page:1",
    "|index:a",
    ":|index:1",
    "::|index:1",
    "xindex:1|myindex:2",
    "index",
    "index:",
    "||",
    ":v|page:1",
    "ind:1|index:2",
]


def test_listed_bags(spark):
    check(CASES, read_all(spark, CASES))


_piece = st.one_of(
    st.builds("".join, st.tuples(st.sampled_from(KEYS), st.text(":v1", max_size=5))),
    st.text(":pagexi", max_size=4),
)
_bag = st.lists(_piece, min_size=1, max_size=6).map("|".join).filter(bool)


@settings(max_examples=5, deadline=None)
@given(bags=st.lists(_bag, min_size=150, max_size=300))
def test_any_bag(spark, bags):
    check(bags, read_all(spark, bags))


@pytest.mark.parametrize("rule", RULES)
def test_no_bag_gives_nothing(spark, rule):
    row = spark.createDataFrame([(None,)], "bag string").select(
        prop(framed(F.col("bag")), "page", rule).alias("v")
    )
    assert row.first().v is None
