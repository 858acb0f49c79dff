"""Queries against their SQL, and the pipeline against its stages by brute force."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from test_documents import contaminated_by_hand, dedup_by_hand, groups_by_hand
from test_models import base_by_hand

import corpus_pipeline
from feedmill.llm import mixing, quality, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(queries.registered()[name](spark, SF), connect(SF), queries.ORACLE[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registered()) == list(range(1, 14))


def by_hand(spark):
    """The stages one after the other on plain lists; the fitted model is taken as it is."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    share = {r["doc_id"]: r["content_share"] for r in quality.judge(docs, model).collect()}
    texts = []
    for k, r in sorted(rows.items()):
        n, _, _, _, repeated = base_by_hand(r["text"])
        if n >= 20 and 100 * repeated <= 30 * n and share[k] >= 0.5:
            texts.append((k, r["text"]))
    left = dedup_by_hand(texts)
    texts = [(k, left[k, t]) for k, t in texts if left[k, t].split()]
    _, group = groups_by_hand(texts, 5, 80)
    lowest = {}
    for (k, _), g in zip(texts, group, strict=True):
        lowest[g] = min(lowest.get(g, k), k)
    texts = [(k, t) for (k, t), g in zip(texts, group, strict=True) if lowest[g] == k]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [(k, t) for k, t in texts if not contaminated_by_hand(t, items)[3]]
    kept = spark.createDataFrame([(k, t, rows[k]["lang"], rows[k]["source"], len(t)) for k, t in texts], docs.schema)
    copies = {r["doc_id"]: r["copies"] for r in mixing.repetition(kept).collect()}
    return sorted((k, t, c) for k, t in texts for c in range(copies[k]))


def test_pipeline(spark):
    found = corpus_pipeline.run(spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert found.columns == [*documents.columns, "copy"]
    rows = found.collect()
    assert sorted((r["doc_id"], r["text"], r["copy"]) for r in rows) == by_hand(spark)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_stages_keep_columns_and_stand_odd_rows(spark):
    good = " ".join(f"word{k}" for k in range(60))
    odd = [(None, None), (None, good), (1, ""), (2, good), (2, good), (3, f"{good}\n{good} more\nlast line here\nend")]
    docs = spark.createDataFrame([(k, t, None, 5) for k, t in odd], "doc_id long, text string, source string, n_removed int")
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "source", "n_removed"], name
        assert stage(spark, empty, SF).count() == 0, name
    assert docs.where(F.col("doc_id") == 2).count() == 1
    assert corpus_pipeline.mixed(spark, docs, SF).columns[-1] == "copy"
