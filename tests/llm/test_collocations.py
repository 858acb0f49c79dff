"""Collocations against counting in plain Python; the trie against a dictionary."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedmill.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top, longest):
    found = []
    by_lang = defaultdict(list)
    for _, text, lang, *_ in rows:
        by_lang["und" if lang is None else lang].append(text or "")
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for text in texts:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(TABLE)):
                words = re.findall(r"[^\x20\x09]+", piece)
                n += len(words)
                for m in range(1, longest + 1):
                    f.update(tuple(words[k : k + m]) for k in range(len(words) - m + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        inside = set()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                inside |= {p[k : k + m] for k in range(len(p) - m + 1) if candidates.get(p[k : k + m]) is not None and a >= f[p[k : k + m]]}
        kept = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def rows_of(seed, n=120):
    draw = random.Random(seed)
    words = ["the", "The", "of", "été", "ÉTÉ", "a", "b", "\x00x", "\x1fy", "z　z", "wörd"]
    out = []
    for k in range(n):
        parts = []
        for _ in range(draw.randrange(60)):
            parts.append(draw.choice(words))
            parts.append(draw.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "\x0c", "!?"]))
        out.append((k, "".join(parts), draw.choice(["en", "en", "de", None, "und", ""]), "s", 0))
    out += [(1, None, "en", None, None), (1, "", None, None, None), (2, "  \n.", "xx", "s", 1)]
    # A long text, a phrase that overlaps itself, copies that share an id.
    out += [(3, "round and round " * 4000, "en", "s", 0), (4, "go " * 500, "de", "s", 0)] + [(5, "a b the of a b", "en", "s", 0)] * 30
    return out


def table(spark, rows, parts=4):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize("limits", [{}, {"BURST": 3, "TRIE_ENTRIES": 20, "BUFFER_ENTRIES": 30, "CODE_ENTRIES": 40, "TRIE_WORDS": 6, "PIECE_BITS": 1 << 12}])
def test_equals_plain_counting(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(c, name, value)
    rows = rows_of(4)
    for min_count, top, longest in ((8, 2000, 5), (3, 7, 3)):
        found = c.collocations(table(spark, rows), min_count, top, longest)
        assert sorted(tuple(r) for r in found.collect()) == brute(rows, min_count, top, longest)


def test_other_columns_do_not_matter(spark):
    rows = rows_of(9, 30)
    docs = table(spark, rows)
    for name in ("n", "phrase", "words", "tokens", "code", "prefix", "a", "rank"):
        docs = docs.selectExpr("*", f"doc_id AS `{name}`")
    assert sorted(tuple(r) for r in c.collocations(docs, 5).collect()) == brute(rows, 5, 2000, 5)


def test_nothing_to_count(spark):
    for rows in ([], [(1, None, None, None, None)], [(1, "one two three", "en", "s", 3)]):
        assert c.collocations(spark.createDataFrame(rows, SCHEMA)).collect() == []


@pytest.mark.parametrize("burst", [1, 5, 1000])
def test_trie_keeps_all_counts(burst):
    draw = random.Random(2)
    trie, want, got = c.HatTrie(burst), Counter(), Counter()
    for step in range(4000):
        phrase = np.array([draw.randrange(5) for _ in range(draw.randrange(1, 6))], ">u4").tobytes()
        trie.add([phrase], [1])
        want[phrase] += 1
        if step % 700 == 699:
            for run in trie.take(trie.entries // 2):
                for p, n in run:
                    got[p] += n
                # A subtree goes whole: nothing with its first word is left.
                gone = {p[:4] for p, _ in run}
                assert type(trie.root) is c.Bucket or not gone & set(trie.root)
    for run in trie.take(0):
        for p, n in run:
            got[p] += n
    assert got == want and trie.entries == 0


def test_sieve_misses_nothing(spark):
    codes = np.random.default_rng(1).integers(0, 1 << 40, 5000)
    sieve = c.Sieve(c.sieve_of(spark.createDataFrame([(int(x),) for x in codes], "code long")))
    assert sieve.has(codes.astype(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 1 << 40, 20000).astype(np.uint64)
    assert sieve.has(others).mean() < 0.05


def test_runs_come_back_in_small_batches():
    counter = c._Counter("en")
    n = 3 * c.BATCH_ROWS + 5
    raw = counter.numbers([b"%d" % k for k in range(n)]).tobytes()
    counter.trie.add([raw[k : k + 4] for k in range(0, len(raw), 4)], [2] * n)
    batches = list(counter.runs(0))
    assert sum(b.num_rows for b in batches) == n and max(b.num_rows for b in batches) <= c.BATCH_ROWS
    assert sorted(p for b in batches for p in b.column("phrase").to_pylist()) == sorted(str(k) for k in range(n))


def test_settings_are_put_back(spark):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "parquet.page.size.row.check.min"]
    before = [spark.conf.get(k, None) for k in keys]
    c.frequent_phrases(table(spark, rows_of(4)), 8)
    assert [spark.conf.get(k, None) for k in keys] == before
