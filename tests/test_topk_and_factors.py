import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from feedmill.operators import factors, topk, topk_kernel

SCHEMA = "id int, features array<float>, cluster int"


def frame(spark, ids, matrix, clusters):
    return spark.createDataFrame(
        [(int(i), [float(x) for x in row], int(c)) for i, row, c in zip(ids, matrix, clusters)], SCHEMA
    )


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(3)
    # Small whole numbers: products are exact and tie often.
    users = draw.integers(-2, 3, (60, 6)).astype(float)
    items = draw.integers(-2, 3, (90, 6)).astype(float)
    user_ids, item_ids = draw.permutation(1000)[:60], draw.permutation(1000)[:90]
    user_clusters = draw.integers(0, 4, 60)
    item_clusters = np.where(np.arange(90) < 40, 0, draw.integers(1, 5, 90))
    return {
        "u": (user_ids, users, user_clusters),
        "i": (item_ids, items, item_clusters),
        "users": frame(spark, user_ids, users, user_clusters).repartition(3),
        "items": frame(spark, item_ids, items, item_clusters).repartition(3),
    }


def lists(df):
    return {r.user: [(e["item"], e["score"]) for e in r["items"]] for r in df.collect()}


def brute(user_side, item_side, k, allowed=lambda uc, ic: True):
    out = {}
    for uid, u, uc in zip(*user_side):
        scored = [(int(i), float(u @ v)) for i, v, ic in zip(*item_side) if allowed(uc, ic)]
        scored.sort(key=lambda p: (-p[1], p[0]))
        if scored:
            out[int(uid)] = scored[:k]
    return out


@pytest.mark.parametrize("k", [1, 7, 90, 200])
def test_exact_equals_brute_force(data, k):
    assert lists(topk.recommend_top_k(data["users"], data["items"], k)) == brute(data["u"], data["i"], k)


@pytest.mark.parametrize("k", [1, 7, 200])
def test_blocks_equal_brute_force(data, k):
    found = topk.recommend_top_k(data["users"], data["items"], k, max_item_bytes=0, block_bytes=800)
    assert lists(found) == brute(data["u"], data["i"], k)


@pytest.mark.parametrize("limits", [{}, {"max_item_bytes": 0, "block_bytes": 800}, {"max_item_bytes": 0, "block_bytes": 48}])
@pytest.mark.parametrize("k", [1, 7, 90, 200])
def test_order_of_length_equals_brute_force(data, k, limits):
    found = topk.top_k_by_norm(data["users"], data["items"], k, **limits).cache()
    assert lists(found) == brute(data["u"], data["i"], k)
    assert all(r.products >= min(k, 90) for r in found.collect())


def test_order_of_length_needs_fewer_products(spark):
    draw = np.random.default_rng(9)
    items = draw.standard_normal((4000, 8)) * (1 / (1 + np.arange(4000)))[:, None]
    users = draw.standard_normal((50, 8))
    users[7] = 0.0  # every score is equal, so nothing can be passed over
    ids = draw.permutation(4000)
    users_df, items_df = frame(spark, range(50), users, np.zeros(50)), frame(spark, ids, items, np.zeros(4000))
    want = lists(topk.recommend_top_k(users_df, items_df, 10))
    for limits in ({}, {"max_item_bytes": 0, "block_bytes": 64 * 500}):
        found = topk.top_k_by_norm(users_df, items_df, 10, **limits).cache()
        assert lists(found) == want
        products = {r.user: r.products for r in found.collect()}
        assert products.pop(7) == 4000
        assert sum(products.values()) < (0.6 if not limits else 0.2) * 49 * 4000


def test_order_of_length_with_empty_sides(spark):
    users = frame(spark, [1], [[1, 0]], [0])
    items = frame(spark, [1, 2], [[3, 1], [1, 2]], [0, 0])
    for limits in ({}, {"max_item_bytes": 0, "block_bytes": 16}):
        assert lists(topk.top_k_by_norm(users, items, 5, **limits)) == {1: [(1, 3.0), (2, 1.0)]}
        assert lists(topk.top_k_by_norm(users.limit(0), items, 5, **limits)) == {}
    assert lists(topk.top_k_by_norm(users, items.limit(0), 5)) == {}


def test_item_lists_are_views(data):
    ids, matrix, clusters = data["i"]
    order = np.argsort(clusters, kind="stable")
    shared = type("Shared", (), {"value": {"ids": ids[order], "clusters": clusters[order], "matrix": matrix[order]}})
    index = topk_kernel._index_of(shared)
    assert topk_kernel._index_of(shared) is index
    for c, part in index.items():
        assert np.shares_memory(part.features, shared.value["matrix"])
        assert sorted(part.ids) == sorted(ids[clusters == c])


def test_recall(spark):
    schema = "user long, items array<struct<item:long,score:double>>"
    exact = spark.createDataFrame([(1, [(1, 2.0), (2, 1.0)]), (2, [(5, 1.0)])], schema)
    found = spark.createDataFrame([(1, [(2, 1.0), (9, 0.5)])], schema)
    assert tuple(topk.recall(found, exact).first()) == (2, 3, 1, 1 / 3)
    assert tuple(topk.recall(found, exact.limit(0)).first()) == (0, 0, 0, None)


def expected_routes(data, clusters, above):
    _, um, uc = data["u"]
    _, im, ic = data["i"]
    routes = {}
    for c in set(uc):
        scored = [
            (-int(um[uc == c].mean(0) @ im[ic == t].mean(0)), t)
            for t in sorted(set(ic))
            if (ic == t).sum() > above
        ]
        routes[c] = [t for _, t in sorted(scored)[:clusters]]
    return routes


@pytest.mark.parametrize("limits", [{}, {"max_item_bytes": 0, "block_bytes": 800}])
@pytest.mark.parametrize("clusters, above", [(1, 0), (2, 12), (5, 0), (2, 1000)])
def test_probe_equals_brute_force(data, limits, clusters, above):
    routes = expected_routes(data, clusters, above)
    probe = topk.Probe(clusters, above)
    found = topk.recommend_top_k(data["users"], data["items"], 9, probe, **limits)
    assert lists(found) == brute(data["u"], data["i"], 9, lambda uc, ic: ic in routes[uc])


def test_fixture_rows_and_empty_sides(spark):
    users = frame(spark, [1, 2], [[1, 0], [0, 1]], [0, 0]).repartition(5)
    items = frame(spark, [1, 2, 3], [[3, 1], [1, 2], [0, 0]], [0, 0, 0])
    assert lists(topk.recommend_top_k(users, items, 2)) == {1: [(1, 3.0), (2, 1.0)], 2: [(2, 2.0), (1, 1.0)]}
    for limits in ({}, {"max_item_bytes": 0}):
        assert lists(topk.recommend_top_k(users, items.limit(0), 2, **limits)) == {}
        assert lists(topk.recommend_top_k(users.limit(0), items, 2, **limits)) == {}


def test_score_pairs(spark, data):
    ids, matrix, _ = data["u"]
    item_ids, item_matrix, _ = data["i"]
    pairs = [(int(u), int(item_ids[n % 90])) for n, u in enumerate(ids)] + [(-1, int(item_ids[0]))]
    found = topk.score_pairs(
        spark.createDataFrame(pairs, "user int, item int"), data["users"], data["items"]
    )
    at = {int(i): v for i, v in zip(item_ids, item_matrix)}
    want = {(int(u), p[1], float(v @ at[p[1]])) for (u, v), p in zip(zip(ids, matrix), pairs)}
    assert {tuple(r) for r in found.collect()} == want


@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e20])
@pytest.mark.parametrize("k", [1, 10, 64])
def test_kernel_ties_and_scales(scale, k):
    draw = np.random.default_rng(11)
    # Every item vector four times over, and neighbours that differ in the last digits only.
    base = draw.standard_normal((40, 33))
    close = base * (1 + 1e-12 * draw.integers(-3, 4, (40, 1)))
    matrix = np.concatenate([base, base, close, base, base]) * scale
    ids = draw.permutation(len(matrix))
    users = draw.standard_normal((70, 33)) * scale
    found = {}
    for batch in topk_kernel.best_lists(np.arange(70), users, topk_kernel.Items(ids, matrix), k, False):
        for user, entries in zip(batch.column("user").to_pylist(), batch.column("items").to_pylist()):
            found[user] = [e["item"] for e in entries]
    for user, u in enumerate(users):
        scores = np.einsum("ij,j->i", matrix, u)
        assert found[user] == list(ids[np.lexsort((ids, -scores))][:k])


def test_kernel_needs_no_package_on_the_workers(tmp_path):
    path = tmp_path / "kernel"
    path.write_bytes(cloudpickle.dumps(topk_kernel.block_scorer(3, False)))
    program = f"import pickle, sys; pickle.load(open({str(path)!r}, 'rb')); assert 'feedmill' not in sys.modules"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", program], cwd=tmp_path, env=env, check=True)


def test_cluster_sizes(data):
    found = {r.cluster: r.n for r in topk.cluster_sizes(data["items"], above=12).collect()}
    clusters = list(data["i"][2])
    assert found == {c: clusters.count(c) for c in set(clusters) if clusters.count(c) > 12}


def test_hash_shards_are_stable_and_complete(data):
    one = factors.shard_by_hash(data["items"], 7)
    two = factors.shard_by_hash(data["items"].repartition(11), 7)
    first = {r.id: r.shard for r in one.collect()}
    assert first == {r.id: r.shard for r in two.collect()}
    assert set(first.values()) <= set(range(7)) and len(first) == 90


def test_kmeans_shards(data):
    model = factors.fit_clusters(data["items"], k=4)
    shards = factors.shard_by_cluster(data["items"], model)
    assert shards.count() == 90 and shards.select("shard").distinct().count() <= 4
    assert factors.training_cost(model) >= 0


SMALL = factors.Settings(rank=4, iterations=2, blocks=2)


@pytest.fixture(scope="module")
def ratings(spark):
    draw = np.random.default_rng(9)
    rows = {(int(u), int(i)) for u, i in draw.integers(0, 30, (400, 2))}
    return spark.createDataFrame(
        [(u, i, float((u * i) % 7 + 1)) for u, i in sorted(rows)], "user int, item int, rating double"
    )


def test_training_is_non_negative_and_recommends(ratings, tmp_path):
    model = factors.train(ratings, SMALL)
    smallest = model.userFactors.select(F.array_min("features").alias("m")).agg(F.min("m")).first()[0]
    assert smallest >= 0
    ours = lists(topk.recommend_top_k(model.userFactors, model.itemFactors, 5))
    theirs = lists(factors.recommend_for_all(model, 5))
    assert set(ours) == set(theirs)
    for user, entries in ours.items():
        assert [s for _, s in entries] == pytest.approx([s for _, s in theirs[user]], abs=1e-4)

    from feedmill.sources.readers import load_model
    from feedmill.sources.writers import save_model

    save_model(model, str(tmp_path / "model"))
    assert load_model(str(tmp_path / "model")).rank == 4


def test_split_is_complete_and_stable(ratings):
    train, held = factors.split_ratings(ratings, 0.8)
    assert train.count() + held.count() == ratings.count()
    again, _ = factors.split_ratings(ratings.repartition(9), 0.8)
    assert sorted(map(tuple, train.collect())) == sorted(map(tuple, again.collect()))
    assert 0.7 < train.count() / ratings.count() < 0.9


def test_squared_error_skips_pairs_without_prediction(spark):
    held = spark.createDataFrame([(1, 1, 2.0), (1, 2, 5.0)], "user int, item int, rating double")
    predicted = spark.createDataFrame([(1, 1, 1.0), (9, 9, 1.0)], "user int, item int, prediction float")
    assert tuple(factors.squared_error(held, predicted).first()) == (1, 1.0)


def test_grid_has_a_row_per_combination(ratings):
    rows = factors.grid(ratings, (2, 3), (0.04,), (1, 2), SMALL).collect()
    assert sorted((r["rank"], r.iterations) for r in rows) == [(2, 1), (2, 2), (3, 1), (3, 2)]
    with pytest.raises(ValueError):
        factors.grid(ratings, (), (0.1,), (1,))


def test_blocks_do_not_multiply_with_the_rows(spark):
    for rows in (10, 2_000, 100_000, 600_000):
        per_block = topk.rows_per_block(rows, 512, 16 << 10)
        assert per_block * topk.BLOCKS >= rows
        assert per_block * 512 <= topk.BLOCK_BYTES
    # Memory comes first; and blocks asked for larger stay as they are.
    assert topk.rows_per_block(1 << 30, 512, 16 << 10) * 512 == topk.BLOCK_BYTES
    assert topk.rows_per_block(100, 512, 16 << 10) == 32


def test_lists_in_steps(monkeypatch):
    rng = np.random.default_rng(3)
    users, features = rng.integers(-3, 4, (37, 5)).astype(float), rng.integers(-3, 4, (211, 5)).astype(float)
    ids = rng.permutation(1000)[:211]
    products = users @ features.T
    expected = [sorted(zip((-p).tolist(), ids.tolist()))[:9] for p in products]
    for whole in (False, True):
        for step in (4, 32, 1000):
            monkeypatch.setattr(topk_kernel, "STEP_ITEMS", step)
            items = [topk_kernel.Items(ids[:50], features[:50]), topk_kernel.Items(ids[50:], features[50:])]
            found = [r for b in topk_kernel.best_lists(np.arange(37), users, items, 9, whole) for r in b.to_pylist()]
            assert [[(-e["score"], e["item"]) for e in r["items"]] for r in found] == expected
