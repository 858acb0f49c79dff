"""The matrix kernel of the top-k operator, as it runs inside the tasks.

It needs numpy and arrow only.  ``topk`` has it pickled by value, so that the
Python workers need no copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

LISTS = "user bigint, items array<struct<item:bigint,score:double>>"
TILE_CELLS = 4 << 20
#: Items scored at once; a list of more is passed in steps, each against the k-th scores so far.
STEP_ITEMS = 4096


def matrix(features: pa.Array) -> np.ndarray:
    """List column -> 2-d double array without per-row objects."""
    flat = features.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(features), len(flat) // max(1, len(features)))


def _best_k(
    rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int, n: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First ``k`` of each of ``n`` rows by (score down, id up)."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    starts = np.searchsorted(rows, np.arange(n))
    first = np.arange(len(rows)) - starts[rows] < k
    return rows[first], ids[first], scores[first]


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row, as a column."""
    at = scores.shape[1] - min(k, scores.shape[1])
    return np.partition(scores, at, axis=1)[:, at : at + 1]


class Items:
    """Item ids and features, ready to be scored."""

    def __init__(self, ids: np.ndarray, features: np.ndarray):
        self.ids = ids
        self.features = features
        self.rough = features.astype(np.float32)
        self.largest = float(np.sqrt((features * features).sum(axis=1).max())) if len(ids) else 0.0

    def cut(self, begin: int, end: int) -> Items:
        """A run of the items, without a copy."""
        part = object.__new__(Items)
        part.ids, part.features = self.ids[begin:end], self.features[begin:end]
        part.rough, part.largest = self.rough[begin:end], self.largest
        return part

    def contenders(self, users: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, column) of a superset of each user's ``k`` best items, or of those that reach the user's ``floor``.

        Products in single precision are off by at most the error bound of a
        dot product, so whatever lies that close to the k-th one stays in.
        """
        lengths = np.sqrt((users * users).sum(axis=1, keepdims=True)) * self.largest
        if lengths.max(initial=0.0) > 1e30:
            scores = users @ self.features.T
            bound = lengths * (users.shape[1] + 8) * 2.0**-52
        else:
            scores = users.astype(np.float32) @ self.rough.T
            bound = lengths * (users.shape[1] + 8) * 2.0**-23 + 1e-30
        if floor is not None:
            # Half of it covers the product, the rest the rounding of the floor.
            return np.nonzero(scores >= (floor[:, None] - 2 * bound).astype(scores.dtype))
        return np.nonzero(scores >= (_kth(scores, k) - 2 * bound).astype(scores.dtype))


def _scored(
    items: Items, users: np.ndarray, k: int, whole_products: bool, floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item id, score) of a superset of each user's ``k`` best items; with ``floor``, of those that reach it.

    Final scores are summed in double precision in one fixed order per pair:
    items with equal features tie exactly, and then the id decides.
    """
    if whole_products:
        # A product close to a whole number must not hang on the shape of the tile,
        # as a matrix product's last digit does: each pair is summed by itself.
        scores = np.trunc(np.einsum("ij,kj->ik", users, items.features))
        rows, cols = np.nonzero(scores >= (_kth(scores, k) if floor is None else floor[:, None]))
        return rows, items.ids[cols], scores[rows, cols]
    rows, cols = items.contenders(users, k, floor)
    exact = np.zeros(len(rows))
    ends = np.searchsorted(rows, np.arange(len(users) + 1))
    for row in np.flatnonzero(ends[1:] > ends[:-1]):
        some = slice(ends[row], ends[row + 1])
        exact[some] = np.einsum("ij,j->i", items.features[cols[some]], users[row])
    return rows, items.ids[cols], exact


def _kth_of(best: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, n: int) -> np.ndarray:
    """The k-th score of each row of ``best``, minus infinity where there are fewer."""
    kth = np.full(n, -np.inf)
    last = np.searchsorted(best[0], np.arange(n), "right") - 1
    full = np.bincount(best[0], minlength=n) >= k
    kth[full] = best[2][last[full]]
    return kth


def _entries(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int) -> pa.Array:
    """Lists of (item, score), one for each of ``n`` rows."""
    entries = pa.StructArray.from_arrays([pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], names=["item", "score"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)), entries)


def best_lists(
    user_ids: np.ndarray, user_matrix: np.ndarray, items: Items | list[Items], k: int, whole_products: bool
) -> Iterator[pa.RecordBatch]:
    """(user, items) batches over one or several lists of items, scoring a bounded number of cells at a time."""
    lists = [x for x in (items if isinstance(items, list) else [items]) if len(x.ids)]
    if not lists:
        return
    parts = [x.cut(a, a + STEP_ITEMS) for x in lists for a in range(0, len(x.ids), STEP_ITEMS)]
    step = max(1, TILE_CELLS // max(len(x.ids) for x in parts))
    for start in range(0, len(user_ids), step):
        tile = user_ids[start : start + step]
        users, n = user_matrix[start : start + step], len(tile)
        best, kth, new = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.full(n, -np.inf), []
        for at, part in enumerate(parts, 1):
            # An equal score may still win by its id.
            new.append(_scored(part, users, k, whole_products, kth if np.isfinite(kth).all() else None))
            # A k-th score that lags behind lets more through, but loses nothing.
            if at == len(parts) or sum(len(x[0]) for x in new) >= n * min(k, len(part.ids)):
                best = _best_k(*[np.concatenate(x) for x in zip(best, *new, strict=True)], k, n)
                kth, new = _kth_of(best, k, n), []
        yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int64()), _entries(*best, n)], names=["user", "items"])


def empty_lists() -> pa.Table:
    entry = pa.struct([("item", pa.int64()), ("score", pa.float64())])
    return pa.table({"user": pa.array([], pa.int64()), "items": pa.array([], pa.list_(entry))})


def columns(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, clusters and feature matrix of a batch or table."""
    features = batch.column("features")
    if isinstance(features, pa.ChunkedArray):
        features = features.combine_chunks()
    return (
        np.asarray(batch.column("id")),
        np.asarray(batch.column("cluster")),
        matrix(features),
    )


def _index_of(shared) -> dict[int, Items]:
    """Item lists by cluster, made once for each worker: ``shared`` broadcasts columns ordered by cluster."""
    held = shared.value
    if "index" not in held:
        items = Items(held["ids"], held["matrix"])
        names, starts = np.unique(held["clusters"], return_index=True)
        ends = np.append(starts, len(held["ids"]))[1:]
        held["index"] = {int(c): items.cut(a, b) for c, a, b in zip(names, starts, ends, strict=True)}
    return held["index"]


def shared_scorer(shared, routes: dict[int, list[int]], k: int, whole_products: bool) -> Callable:
    """Kernel over batches of users against an index of item lists that all tasks share.

    No item row is copied for a batch: a user cluster is scored against the lists that it probes where they lie.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index_of(shared)
        for batch in batches:
            user_ids, user_clusters, user_matrix = columns(batch)
            for cluster in np.unique(user_clusters):
                rows = np.flatnonzero(user_clusters == cluster)
                lists = [index[c] for c in routes.get(int(cluster), []) if c in index]
                yield from best_lists(user_ids[rows], user_matrix[rows], lists, k, whole_products)

    return score


# --- items in order of their length ----------------------------------------

NORM_STEP = 2048
NORM_LISTS = LISTS + ", products bigint, blocks int, features array<double>"


def _lengths(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix * matrix).sum(axis=1))


def norm_scorer(shared, tails: np.ndarray, sizes: np.ndarray, k: int, step: int = NORM_STEP) -> Callable:
    """Kernel over batches of users against items in order of length, the longest first.

    A user is done once length(user) * length(next item) lies below the k-th score.  ``tails`` has the largest
    length in each further block of items, ``sizes`` how many items these hold: ``blocks`` counts those that a
    user still has to meet, ``products`` the pairs scored for a user, those blocks included.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "steps" not in held:
            items = Items(held["ids"], held["matrix"])
            lengths = _lengths(items.features)
            steps = []
            for a in range(0, len(items.ids), step):
                part = items.cut(a, a + step)
                part.largest = float(lengths[a : a + step].max())
                steps.append(part)
            held["steps"] = steps
        before = np.concatenate(([0], np.cumsum(sizes)))
        for batch in batches:
            user_ids, _, user_matrix = columns(batch)
            size = max(1, TILE_CELLS // step)
            for start in range(0, len(user_ids), size):
                yield _by_length(user_ids[start : start + size], user_matrix[start : start + size], held["steps"], tails, before, k)

    return score


def _by_length(ids: np.ndarray, users: np.ndarray, steps: list[Items], tails: np.ndarray, before: np.ndarray, k: int) -> pa.RecordBatch:
    n = len(ids)
    # What rounding may add to a product of two lengths.
    reach = _lengths(users) * (1 + 1e-9)
    kth = np.full(n, -np.inf)
    products = np.zeros(n, np.int64)
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for items in steps:
        # An equal score may still win by its id.
        open_rows = np.flatnonzero(reach * items.largest >= kth)
        if not len(open_rows):
            break
        floor = kth[open_rows]
        rows, own, scores = _scored(items, users[open_rows], k, False, floor if np.isfinite(floor).all() else None)
        rows = open_rows[rows]
        better = scores >= kth[rows]
        new = (rows[better], own[better], scores[better])
        best = _best_k(*[np.concatenate(x) for x in zip(best, new, strict=True)], k, n)
        products[open_rows] += len(items.ids)
        kth = _kth_of(best, k, n)
    # Lengths of blocks only fall, so those in reach come first.
    blocks = (reach[:, None] * tails[None, :] >= kth[:, None]).sum(axis=1) if len(tails) else np.zeros(n, np.int64)
    flat = pa.array(users.ravel())
    features = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * users.shape[1]), flat)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), _entries(*best, n), pa.array(products + before[blocks]), pa.array(blocks.astype(np.int32)), features],
        names=["user", "items", "products", "blocks", "features"],
    )


def block_scorer(k: int, whole_products: bool) -> Callable:
    """Kernel over one block of users and one block of items."""

    def score(users: pa.Table, items: pa.Table) -> pa.Table:
        user_ids, _, user_matrix = columns(users)
        item_ids, _, item_matrix = columns(items)
        items_ = Items(item_ids, item_matrix)
        lists = list(best_lists(user_ids, user_matrix, items_, k, whole_products))
        return pa.Table.from_batches(lists) if lists else empty_lists()

    return score
