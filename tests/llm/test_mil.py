"""The classifier: passages and attention by hand, gradients, what it learns from, held-out accuracy."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedmill.llm import mil

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [None, "", " \n\t", "one", "Good words, in a line. And more.", "x " * 500, "A! B! C!\n" * 40, "été 12 ### $$$ a a a", "w" * 5000, "a b c d " * 16]


def test_passages_of_a_text_hang_on_it_alone():
    together = mil.passages(pa.array(TEXTS, pa.string()))
    assert (np.diff(together.first) >= 1).all()
    for k, text in enumerate(TEXTS):
        alone = mil.passages(pa.array([text], pa.string()))
        assert np.array_equal(alone.x, together.x[together.first[k] : together.first[k + 1]])
        assert len(alone.x) == max(1, -(-len((text or "").split()) // mil.PASSAGE))


def test_measures_by_hand():
    x = mil.passages(pa.array(["Ab CD! e1 e1\n### abcdefghijklmn,"])).x[0]
    got = dict(zip(mil.MEASURES, x.tolist(), strict=False))
    want = {
        "a symbol": 1 / 6, "no letter or digit": 1 / 6, "all capitals": 1 / 6, "capital first": 2 / 6, "ends a sentence": 1 / 6,
        "exclamation": 1 / 6, "comma or colon": 1 / 6, "a digit": 2 / 6, "one character": 0, "over twelve characters": 1 / 6,
        "equals the word before": 1 / 6, "equals the word before that": 0, "came before in the passage": 1 / 6, "opens a line": 2 / 6,
        "symbols a character": 3 / 27, "capitals a letter": 3 / 20, "letters a character": 20 / 27, "mean length": 27 / 6,
        "log words": np.log(7), "no words": 0,
    }
    assert got == pytest.approx(want, rel=1e-5)
    assert x[len(mil.MEASURES) :].sum() == pytest.approx(1, rel=1e-5)


def random_bags(seed=0, n=12):
    draw = np.random.default_rng(seed)
    sizes = draw.integers(1, 6, n)
    return draw.normal(size=(sizes.sum(), mil.FEATURES)), np.concatenate(([0], np.cumsum(sizes))), draw.integers(0, 2, n).astype(float)


def test_attention_by_hand():
    x, first, _ = random_bags()
    w = mil.start_weights()
    found = mil.forward(w, x, first)
    for k, (a, b) in enumerate(zip(first, first[1:], strict=False)):
        h = [np.tanh(row @ w["encode"] + w["shift"]) for row in x[a:b]]
        raw = [float((np.tanh(v @ w["tanh"]) / (1 + np.exp(-(v @ w["sigmoid"])))) @ w["attend"]) for v in h]
        weight = np.exp(raw) / np.exp(raw).sum()
        z = sum(p * v for p, v in zip(weight, h, strict=True))
        assert found.weight[a:b] == pytest.approx(weight)
        assert found.score[k] == pytest.approx(float(1 / (1 + np.exp(-(z @ w["out"] + w["bias"][0])))))


def test_gradients():
    x, first, label = random_bags(5)
    w = mil.start_weights(2)
    _, g = mil.gradients(w, x, first, label)
    draw = np.random.default_rng(1)
    for name in w:
        for _ in range(5):
            at = tuple(draw.integers(0, s) for s in w[name].shape)
            up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
            up[name][at] += 1e-6
            down[name][at] -= 1e-6
            slope = (mil.gradients(up, x, first, label)[0] - mil.gradients(down, x, first, label)[0]) / 2e-6
            assert g[name][at] == pytest.approx(slope, abs=1e-7)


def test_attention_finds_the_telling_passage():
    draw = np.random.default_rng(4)
    bags, labels = [], []
    for k in range(300):
        bag = draw.normal(size=(draw.integers(2, 9), mil.FEATURES)).astype(np.float32)
        if k % 2:
            bag[draw.integers(len(bag)), 0] = 6.0
        bags.append(bag)
        labels.append(k % 2)
    model = mil.fit(bags, labels)
    x = (np.concatenate(bags) - model.centre) / model.scale
    first = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    found = mil.forward(model.weights, x, first)
    assert ((found.score > 0.5) == np.array(labels)).mean() > 0.95
    hit = [int(found.weight[a:b].argmax()) == int(bag[:, 0].argmax()) for a, b, bag, y in zip(first, first[1:], bags, labels, strict=False) if y]
    assert np.mean(hit) > 0.9


def frame(spark, texts):
    return spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], SCHEMA)


def test_rows_out(spark):
    docs = frame(spark, TEXTS).unionByName(frame(spark, TEXTS[:3])).withColumn("score", F.lit("x")).withColumn("quality", F.lit(9))
    rows = mil.classify(docs, mil.fit([np.eye(2, mil.FEATURES, dtype=np.float32)] * 2, [0, 1])).collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and 0 < r.attention <= 1
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.n_passages == max(1, -(-len((TEXTS[r.doc_id] or "").split()) // mil.PASSAGE))
    assert mil.classify(docs.limit(0), mil.NEUTRAL).collect() == []
    unnamed = mil.classify(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")), mil.NEUTRAL).first()
    assert (unnamed.doc_id, unnamed.score, unnamed.held_out) == (None, 0.5, zlib.crc32(b"") % 5 == 0)


def test_labels_it_learns_from(spark):
    docs = frame(spark, ["good words here"] * 40)
    held = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 0]
    schema = "doc_id long, quality int, toxic int"
    # Held-out rows alone, other labels, no id: nothing to learn.
    for rows in ([(k, k % 2, 0) for k in held], [(1, 7, 0), (2, None, 0), (None, 1, 0)], [], [(1, 1, 0), (2, 1, 0)]):
        assert mil.train(docs, spark.createDataFrame(rows, schema)) is mil.NEUTRAL
    # The smallest of several labels of an id counts, so here all are 0.
    both = [(k, q, 0) for k in range(40) for q in (0, 1)]
    assert mil.train(docs, spark.createDataFrame(both, schema)) is mil.NEUTRAL


def test_training_is_bounded_by_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mil, "fit", lambda bags, labels: seen.append((len(bags), max(len(b) for b in bags))))
    free = next(k for k in range(9) if zlib.crc32(str(k).encode()) % 5)
    docs = spark.createDataFrame([(free, "w " * 64 * 500, "en", "s", 0)] * 30, SCHEMA)
    labels = spark.createDataFrame([(free, 1, 0)], "doc_id long, quality int, toxic int")
    mil.train(docs, labels, sample=7)
    assert seen == [(7, mil.TRAIN_PASSAGES)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{x}.parquet") for x in ("documents", "labels"))
    found = mil.classify(docs, mil.train(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert len(found) > 40
    assert (found["predicted"] == found["quality"]).mean() > 0.95
