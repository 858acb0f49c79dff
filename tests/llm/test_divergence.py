"""The audit against dictionaries and whole numbers."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from feedmill.llm import divergence as d

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, top=200):
    docs = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(TABLE)))) for _, text, lang, source, *_ in rows]
    found = []
    for lang in {x[0] for x in docs}:
        own = [x for x in docs if x[0] == lang]
        df, total = Counter(), Counter()
        counts = defaultdict(Counter)
        for _, source, words in own:
            df.update(words.keys())
            counts[source].update(words)
            total.update(words)
        kept = [t for t in df if df[t] >= least]
        v = len(kept)

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + v) for t in kept}

        p = {s: shares(x) for s, x in counts.items()}
        all_p = shares(total)

        def f(x, y):
            return (x - y) * (x - y) // y

        for s in counts:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            terms = [(-f(p[s][t], all_p[t]), t.encode()) for t in kept if counts[s][t] > 0 and p[s][t] > all_p[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                found += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(found)


def rows_of(seed, n=90):
    draw = random.Random(seed)
    words = [f"{draw.choice('abcdéñ')}{draw.choice('xyzß')}{k % 9 or ''}" for k in range(60)] + ["İ", "ÀB", "Ab", "　"]
    out = []
    for k in range(n):
        # One source has a third of the rows.
        source = "hot" if k % 3 == 0 else draw.choice(["a", "b", "ü", "", None, "a,b"])
        text = "".join(draw.choice(words) + draw.choice([" ", "1", "-", "\x7f", "[", "\n"]) for _ in range(draw.randrange(40)))
        out.append((k, text, draw.choice(["en", "en", "de", None]), source, 0))
    out += [(0, None, "fr", "alone", 1), (0, None, None, None, None), (7, "1 2 3", "en", "wordless", 0)]
    out += [(8, "word Word wörd " * 30_000, "en", "a", 0)] + [(9, "same text again", "en", "b", 0)] * 3
    return out


@pytest.mark.parametrize("limit", [d.STRIPE_COUNTS, 25])
def test_equals_dictionaries(spark, monkeypatch, limit):
    monkeypatch.setattr(d, "STRIPE_COUNTS", limit)
    monkeypatch.setattr(d.tk, "SLICE_BYTES", d.tk.SLICE_BYTES if limit > 100 else 300)
    rows = rows_of(3)
    for least, top in ((3, 200), (1, 4)):
        found = d.audit(spark.createDataFrame(rows, SCHEMA).repartition(5), least, top)
        assert sorted(tuple(r) for r in found.collect()) == brute(rows, least, top)


def test_other_columns_do_not_matter(spark):
    rows = rows_of(5, 25)
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("term", "documents", "sources", "counts", "p", "q", "item", "value", "rank"):
        docs = docs.selectExpr("*", f"doc_id AS `{name}`")
    assert sorted(tuple(r) for r in d.audit(docs).collect()) == brute(rows)


def test_nothing_to_compare(spark):
    assert d.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    # Groups without any kept term still have their pairs, at 0.
    rows = [(1, "x", "en", "a", 1), (2, None, "en", "b", 0)]
    assert sorted(tuple(r) for r in d.audit(spark.createDataFrame(rows, SCHEMA)).collect()) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_shares_are_exact_for_large_counts(spark):
    draw = random.Random(1)
    cases = [(n - 1, n) for n in (1, 2, 3, 10**15)] + [(draw.randrange(10**15), 9 * 10**15) for _ in range(50)] + [(draw.randrange(7), 7) for _ in range(7)]
    frame = spark.createDataFrame(cases, "n long, d long").selectExpr("n", "d", f"{d.share('n', 'd')} AS p")
    assert {tuple(r) for r in frame.collect()} == {(n, t, 1 + 10**9 * (n + 1) // t) for n, t in cases}


def test_stripes_go_on_over_batches():
    names = d._NAMES
    rows = [("en", t, 1, ["a", "b"], [k, 1]) for k, t in enumerate("ppqqqqr")]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True))], schema=pa.schema(
        [("lang", pa.string()), ("term", pa.string()), ("documents", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])) for r in rows]
    got = [r for b in d.merge(iter(batches), 2) for r in b.to_pylist()]
    assert [(r["term"], r["documents"], dict(zip(r["sources"], r["counts"], strict=True))) for r in got] == [
        ("p", 2, {"a": 1, "b": 2}), ("q", 4, {"a": 14, "b": 4}),
    ]
