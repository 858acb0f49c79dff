"""N-gram Jaccard join: group counts of shingles as points of a tree of boxes.

The shingles of a document are hashed into groups; the counts of the groups are a point.  Two documents
share at most the sum over the groups of the smaller count, which bounds their overlap from above.

Upper levels of the tree: documents of similar size meet in a band, and the groups of a band are dealt
into blocks.  A linked pair differs in few counts, so in at least one block the two points agree in every
coordinate.  A cell holds the documents with one count vector in one block; no other pairs need a look.

Lower levels: a cell is cut into leaves with bounding boxes; leaves and then pairs are passed over when
the summed minima are too small, and what is left is verified on the shingle sets.  Pairs that earlier
links connect already are not looked at again, so a group of many copies is no square of its size: a first
round over the few cells that very close pairs share connects most copies, a second one over some of the
others connects groups of less close ones, and the third passes over all cells whose documents are connected
by then.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.llm import textkit as tk
from feedmill.llm.components import components
from feedmill.operators.joins import fits_broadcast
from feedmill.session import materialise, scratch, short_shuffles

#: Coordinates of a point (powers of two), coarser than the groups of a band: in the rounds that connect, and where
#: every pair that is left has to be told apart, for which the first are too coarse.
DIMENSIONS = 128
FINE_DIMENSIONS = 1024
#: Groups in a block, documents of a cell that meet in one task, and points under one bounding box.
#: With so many groups unrelated documents hardly ever have the same counts in a block that is not empty.
BLOCK_GROUPS = 1 << 20
LEAF = 512
BOX = 16
#: Blocks of at most so many documents are compared many at a time.
FEW = 24
STEP_PAIRS = 200_000
BAND_GROWTH = 1.25
#: Similarity whose cells the first round takes, and of how many cells the second round takes one.
CLOSE_PERCENT = 95
SOME_CELLS = 16
#: Parts in which the third round groups its cells one after the other, as all of them make by far the largest shuffle.
CELL_PARTS = 2
#: Bytes of text whose cells are made at once; every shingle takes part in some ten arrays then.
SIGN_BYTES = 1 << 19

_ODD = np.uint64(0xD6E8FEB86659FD93)
_OPEN = ["block", "rid", "leaf", "label"]
_SIGNED = "doc_id long, n long, key_a long, key_b long, point binary, close array<long>, cells array<long>"


class Bands:
    """Sizes by band, and how many blocks a band needs.

    Linked sets of a and b shingles differ in at most k = (1 - t)(a + b) / (1 + t) of them.  With k + 1 + spare
    blocks they agree in more than ``spare``, so empty blocks may be passed over by documents that have no more
    than ``spare`` of them.  ``spare`` is meant for the smallest sets that visit the band, which have the most.
    """

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH)))
        self.edges = np.array(edges, np.int64)
        blocks, spare = [], []
        for low, high in zip(edges, edges[1:], strict=False):
            need = (100 - percent) * 2 * (high - 1) // (100 + percent) + 1
            least = max(1, low * percent // 100)
            extra = 0
            for _ in range(12 if need > 1 else 0):
                expected = (need + extra) * np.exp(-least / (need + extra))
                extra = max(extra, int(np.ceil(expected + 3 * np.sqrt(expected) + 0.5)))
            blocks.append(need + extra)
            spare.append(extra)
        self.blocks, self.spare = (np.array(x, np.int64) for x in (blocks, spare))

    def of(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own band, and the last one that holds a set large enough to link with this size as the smaller."""
        own = np.searchsorted(self.edges, sizes, "right") - 1
        return own, np.searchsorted(self.edges, sizes * 100 // self.percent, "right") - 1


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle codes of all rows, and where each row's begin."""
    words = tk.Words(*tk.buffer_of(column), tk.IN_WHITE_WORD, lower=True)
    codes = words.hashes()
    code, at = tk.windows(codes, words.first, width)
    doc = np.searchsorted(words.first, at, "right") - 1
    # A row with fewer words has its whole sequence as one shingle.
    for short in range(1, width):
        rows = np.flatnonzero(words.count == short)
        if len(rows):
            whole = sum(codes[words.first[rows] + k] * np.uint64(2 * k + 3) for k in range(short))
            code = np.concatenate((code, tk.mix(whole + np.uint64(short))))
            doc = np.concatenate((doc, rows))
    order = np.argsort(code)
    if len(column) < 1 << 16:
        order = order[np.argsort(doc[order].astype(np.uint16), kind="stable")]
    else:
        order = order[np.argsort(doc[order], kind="stable")]
    code, doc = code[order], doc[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    return code[fresh], np.searchsorted(doc[fresh], np.arange(len(column) + 1))


def set_keys(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set; 0 for an empty one."""

    def summed(x: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
        return (total[first[1:]] - total[first[:-1]]).view(np.int64)

    return summed(tk.mix(codes)), summed(tk.mix(codes * _ODD + np.uint64(1)))


def points(codes: np.ndarray, first: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    rows = len(first) - 1
    doc = np.repeat(np.arange(rows), np.diff(first))
    at = doc * dimensions + (codes >> np.uint64(65 - dimensions.bit_length())).astype(np.int64)
    return np.bincount(at, minlength=rows * dimensions).astype(np.int32).reshape(rows, dimensions)


def packed(points: np.ndarray) -> pa.Array:
    """A byte for each coordinate, four where one of them needs it."""
    return pa.array([(p.astype(np.uint8) if p.max() < 256 else p).tobytes() for p in points], pa.binary())


def unpacked(column: pa.Array, dimensions: int = DIMENSIONS) -> np.ndarray:
    data, offsets = tk.buffer_of(column)
    width = np.diff(offsets)
    if (width == dimensions).all():
        return data.reshape(-1, dimensions)
    out = np.empty((len(width), dimensions), np.int32)
    out[width == dimensions] = data[np.repeat(width == dimensions, width)].reshape(-1, dimensions)
    wide = np.ascontiguousarray(data[np.repeat(width != dimensions, width)]).view(np.int32)
    out[width != dimensions] = wide.reshape(-1, dimensions)
    return out


def cells_of(codes: np.ndarray, first: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all rows, one after the other, and where each row's begin."""
    size = np.diff(first)
    rows = np.flatnonzero(size > 0)
    own, last = bands.of(size[rows])
    visits = last - own + 1
    row = np.repeat(rows, visits)
    band = np.repeat(own, visits) + np.arange(len(row)) - np.repeat(np.cumsum(visits) - visits, visits)
    blocks = bands.blocks[band]
    base = np.concatenate(([0], np.cumsum(blocks)))
    n = size[row]
    visit = np.repeat(np.arange(len(row)), n)
    element = np.arange(len(visit)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[row], n)
    code = tk.mix(codes[element] ^ _ODD)
    group = code % (blocks[visit] * BLOCK_GROUPS).astype(np.uint64)
    at = base[visit] + (group // np.uint64(BLOCK_GROUPS)).astype(np.int64)
    # Equal counts in all groups of a block give equal sums.
    sums = np.zeros(base[-1], np.uint64)
    np.add.at(sums, at, tk.mix(group * _ODD + np.uint64(7)))
    held = np.bincount(at, minlength=base[-1])
    of_visit = np.repeat(np.arange(len(row)), blocks)
    empty = held == 0
    many = np.add.reduceat(empty, base[:-1], dtype=np.int64) > bands.spare[band] if len(row) else np.zeros(0, bool)
    emitted = ~empty | many[of_visit]
    number = np.arange(base[-1]) - base[of_visit]
    place = (band[of_visit] << 32) + number
    cell = tk.mix(sums + tk.mix(place.astype(np.uint64) * _ODD))[emitted]
    return cell.view(np.int64), np.searchsorted(row[of_visit[emitted]], np.arange(len(size) + 1))


def sign(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, set size n, the set's name, its point and its cells, one row for each row of documents.

    ``close`` has the cells for a similarity of ``CLOSE_PERCENT``, ``cells`` those for ``percent``.
    """

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [max(percent, CLOSE_PERCENT), percent]
        bands = [Bands(x, 1 << 10) for x in levels]
        for part in tk.slices(batches, size=SIGN_BYTES):
            codes, first = shingle_sets(part.column("text"), width)
            size = np.diff(first)
            bands = [
                b if size.max(initial=0) * 100 // x < b.edges[-1] else Bands(x, int(size.max()) * 200 // x)
                for b, x in zip(bands, levels, strict=True)
            ]
            cells = [tk.list_array(pa.array(c), at) for c, at in (cells_of(codes, first, b) for b in bands)]
            keys = [pa.array(k) for k in set_keys(codes, first)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size), *keys, packed(points(codes, first)), *cells],
                names=["doc_id", "n", "key_a", "key_b", "point", "close", "cells"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(signed, _SIGNED).withColumn("row", F.monotonically_increasing_id())


def near(points: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (i < j) whose summed minima leave a link possible, and that bound, box by box.

    A bounding box holds points that are close in order of size; a pair of boxes is passed over when even the
    upper corners' minima are too small for the smallest sizes inside.
    """
    order = np.lexsort((*points.T[:4], sizes))
    p, s = points[order], sizes[order]
    starts = np.arange(0, len(order), BOX)
    high, least = np.maximum.reduceat(p, starts), s[starts]
    reach = (100 + percent) * 1
    for x in range(len(starts)):
        # 2 * overlap * 100 is at least 2 * t * (a + b) / (1 + t).
        corner = np.minimum(high[x], high[x:]).sum(1, dtype=np.int64)
        open_boxes = np.flatnonzero(corner * reach >= percent * (least[x] + least[x:])) + x
        a = np.arange(starts[x], min(starts[x] + BOX, len(order)))
        b = np.concatenate([np.arange(starts[y], min(starts[y] + BOX, len(order))) for y in open_boxes])
        bound = np.minimum(p[a][:, None, :], p[b][None, :, :]).sum(2, dtype=np.int64)
        fits = (bound * reach >= percent * (s[a][:, None] + s[b][None, :])) & (a[:, None] < b[None, :])
        i, j = np.nonzero(fits)
        one, two = order[a[i]], order[b[j]]
        yield np.minimum(one, two), np.maximum(one, two), bound[i, j]


def spanning_pairs(
    points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """A forest over the pairs of ``near`` that joins the labels, those with the smallest distance first."""
    found = list(near(points, sizes, percent))
    i, j, bound = (np.concatenate([x[k] for x in found]) for k in range(3))
    order = np.lexsort((j, i, sizes[i] + sizes[j] - 2 * bound))
    root = np.unique(labels, return_inverse=True)[1].tolist()
    number = max(root) + 1
    own, root = root, list(range(number))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
        x, y = top(own[a]), top(own[b])
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
            if len(out) == number - 1:
                break
    return out


def few_pairs(held: dict, cuts: np.ndarray, percent: int, spanning: bool) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (rows of ``held``) of all blocks with ``FEW`` documents or fewer.

    Those that pass the bound, of other labels and, in a block of two leaves, of other leaves; in the spanning
    round a forest of them, smallest distance first.
    """
    n, label, leaf, point = (held[c] for c in ("n", "label", "leaf", "point"))
    sizes, starts = np.diff(cuts), cuts[:-1]
    mixed = np.maximum.reduceat(leaf, starts) != np.minimum.reduceat(leaf, starts)
    found = []
    for k in range(2, FEW + 1):
        own = np.flatnonzero(sizes == k)
        one, two = np.triu_indices(k, 1)
        step = max(1, STEP_PAIRS * DIMENSIONS // (len(one) * point.shape[1]))
        for at in range(0, len(own), step):
            blocks = own[at : at + step]
            a, b = (starts[blocks][:, None] + one).ravel(), (starts[blocks][:, None] + two).ravel()
            block = np.repeat(blocks, len(one))
            open_pairs = (label[a] != label[b]) & ((leaf[a] != leaf[b]) | ~mixed[block])
            open_pairs &= np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * percent
            a, b, block = a[open_pairs], b[open_pairs], block[open_pairs]
            bound = np.minimum(point[a], point[b]).sum(1, dtype=np.int64)
            fits = bound * (100 + percent) >= percent * (n[a] + n[b])
            found.append((block[fits], n[a][fits] + n[b][fits] - 2 * bound[fits], a[fits], b[fits]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    block, distance, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    if not spanning:
        return a, b
    order = np.lexsort((b, a, distance, block))
    chosen, root, last = [], {}, -1

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for k in order.tolist():
        if block[k] != last:
            root, last = {}, block[k]
        x, y = top(int(label[a[k]])), top(int(label[b[k]]))
        if x != y:
            root[max(x, y)] = min(x, y)
            chosen.append(k)
    return a[chosen], b[chosen]


def _pair_rows(percent: int, spanning: bool, dimensions: int = DIMENSIONS, members: bool = False):
    """Candidate pairs of each block, or its ``members`` that have any; the rows of a block come one after the other."""

    def of_block(n: np.ndarray, point: np.ndarray, leaf: np.ndarray, label: np.ndarray):
        if spanning:
            pairs = np.array(spanning_pairs(point, n, label, percent), np.int64).reshape(-1, 2)
            return pairs[:, 0], pairs[:, 1]
        ones, twos = [], []
        across = leaf.min() != leaf.max()
        for i, j, _ in near(point, n, percent):
            open_pairs = (label[i] != label[j]) & ((leaf[i] != leaf[j]) | (not across))
            ones.append(i[open_pairs])
            twos.append(j[open_pairs])
        return np.concatenate(ones), np.concatenate(twos)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "rid", "n", "leaf", "label"]
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                own = {c: batch.column(c).to_numpy() for c in names}
                own["point"] = unpacked(batch.column("point"), dimensions)
                held = own if held is None else {c: np.concatenate((held[c], own[c])) for c in own}
                # The last block may go on in the next batch.
                stop = int(np.searchsorted(-(held["block"] != held["block"][-1]).astype(int), 0)) if len(held["block"]) else 0
            elif held is None:
                return
            else:
                stop = len(held["block"])
            if not stop:
                continue
            block = held["block"][:stop]
            cuts = np.concatenate(([0], np.flatnonzero(block[1:] != block[:-1]) + 1, [stop]))
            x, y = few_pairs({c: v[:stop] for c, v in held.items()}, cuts, percent, spanning)
            ones, twos = [x], [y]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if high - low > FEW:
                    x, y = of_block(*(held[c][low:high] for c in ("n", "point", "leaf", "label")))
                    ones.append(x + low)
                    twos.append(y + low)
            one, two = np.concatenate(ones), np.concatenate(twos)
            if members:
                at, names_out = np.unique(np.concatenate((one, two))), _OPEN
                columns = [held[c][at] for c in names_out]
            else:
                # A pair meets in many blocks.
                names_out = ["a", "b"]
                one, two = held["rid"][one], held["rid"][two]
                columns = np.unique(np.stack((np.minimum(one, two), np.maximum(one, two))), axis=1)
            held = {c: v[stop:] for c, v in held.items()}
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names_out)

    return rows


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def _blocks(members: DataFrame, points: DataFrame) -> DataFrame:
    blocks = members.join(_small(points), "rid").select("block", "rid", "n", "point", "leaf", "label")
    return blocks.repartition("block").sortWithinPartitions("block", "rid")


def _candidates(
    members: DataFrame, points: DataFrame, percent: int, spanning: bool, dimensions: int = DIMENSIONS
) -> DataFrame:
    return _blocks(members, points).mapInArrow(_pair_rows(percent, spanning, dimensions), "a long, b long").distinct()


def _open_members(members: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Members of blocks that have candidates there; never more rows than there are members."""
    rows = _pair_rows(percent, spanning=False, members=True)
    return _blocks(members, points).mapInArrow(rows, "block long, rid long, leaf int, label long")


def _fine(sets: DataFrame) -> DataFrame:
    """rid, set size and point in ``FINE_DIMENSIONS`` of every set."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("codes")
            first = codes.offsets.to_numpy()
            values = codes.values.to_numpy()[first[0] : first[-1]].view(np.uint64)
            fine = points(values, first - first[0], FINE_DIMENSIONS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.array(np.diff(first).astype(np.int64)), packed(fine)], names=["rid", "n", "point"]
            )

    # A class may come more than once, with the same set.
    return sets.mapInArrow(made, "rid long, n long, point binary").dropDuplicates(["rid"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that 100 * intersection >= percent * union makes links."""
    one = sets.select(F.col("rid").alias("a"), F.col("codes").alias("codes_a"))
    two = sets.select(F.col("rid").alias("b"), F.col("codes").alias("codes_b"))
    both = F.size(F.array_intersect("codes_a", "codes_b"))
    every = F.size("codes_a") + F.size("codes_b") - both
    return pairs.join(one, "a").join(two, "b").where(both * 100 >= every * percent).select("a", "b").distinct()


KEYS = ("key_a", "key_b", "n")


def linked_classes(documents: DataFrame, signed: DataFrame, width: int, percent: int) -> DataFrame:
    """Classes of equal sets (by ``KEYS``) with their smallest doc_id, and the label of their component.

    Links are all pairs of sets with a Jaccard similarity of at least ``percent`` / 100.  What the rounds write goes
    with them; only the classes stay.
    """
    with scratch(documents.sparkSession), short_shuffles(documents.sparkSession):
        return materialise(_linked(documents, signed, width, percent), outlive=1)


def _linked(documents: DataFrame, signed: DataFrame, width: int, percent: int) -> DataFrame:
    classes = materialise(
        signed.where("n > 0").groupBy(*KEYS).agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("rid"))
    )
    heads = signed.join(_small(classes.select("rid")), F.col("row") == F.col("rid"))
    points, links, labels = heads.select("rid", "n", "point"), None, None
    # Documents of a group meet in very many cells.  Some of these connect most of a group, after which the others
    # hold one label each and are passed over.
    some = F.filter("cells", lambda x: F.pmod(x, F.lit(SOME_CELLS)) == 0)
    for cells, parts in ((F.col("close"), 1), (some, 1), (F.col("cells"), CELL_PARTS)):
        members = _members(heads.select("rid", cells.alias("cells")), labels, parts)
        block = F.xxhash64("cell", "leaf").alias("block")
        tried = materialise(_candidates(members.select("*", block), points, percent, spanning=True))
        with scratch(documents.sparkSession):
            found = materialise(_verified(tried, _sets_of(_ends(tried), documents, classes, width), percent), outlive=1)
        links = found if links is None else links.unionByName(found)
        labels = components(links)

    # What is not connected yet meets in every cell, leaf by leaf.
    named = members.drop("label").join(labels, F.col("rid") == F.col("node"), "left")
    named = named.withColumn("label", F.coalesce("label", "rid"))
    mixed = named.groupBy("cell").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y")
    other = F.explode(F.sequence(F.lit(0), F.col("leaves") - 1)).alias("other")
    again = named.join(mixed.select("cell"), "cell").select("*", other)
    block = F.xxhash64("cell", F.least("leaf", "other"), F.greatest("leaf", "other")).alias("block")
    # All pairs within the bound are looked at now.  Those within the coarse one grow with the square of a group, so only
    # their documents are named, and fine points of these, from the sets themselves, tell the pairs apart.
    left = materialise(_open_members(again.select("*", block), points, percent))
    sets = _sets_of(left.select("rid").distinct(), documents, classes, width)
    fine = materialise(_fine(sets))
    rest = materialise(_candidates(left, fine, percent, False, FINE_DIMENSIONS))
    rest = rest.join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(materialise(_verified(rest, sets, percent)))
    labels = components(links)
    named = classes.join(labels, F.col("rid") == F.col("node"), "left")
    return named.select(*KEYS, "doc_id", F.coalesce("label", "rid").alias("label"))


def _shared(in_cells: DataFrame) -> DataFrame:
    """Cells of several labels, their number of documents and sums that name these."""
    return in_cells.groupBy("cell").agg(
        F.count(F.lit(1)).alias("m"), F.min("rid").alias("low"), F.sum(F.xxhash64("rid").cast("decimal(38,0)")).alias("held"),
        F.min("label").alias("x"), F.max("label").alias("y"),
    ).where("x != y")


def _members(cells: DataFrame, labels: DataFrame | None, parts: int = 1) -> DataFrame:
    """(cell, leaves, rid, label, leaf) of every cell with documents that are not connected yet.

    The cells are grouped in so many parts, of which only the shared ones stay.
    """
    if labels is None:
        named = cells.withColumn("label", F.col("rid"))
    else:
        named = cells.join(_small(labels), F.col("rid") == F.col("node"), "left")
        named = named.withColumn("label", F.coalesce("label", "rid"))
    in_cells = named.select("rid", "label", F.explode("cells").alias("cell"))
    if parts == 1:
        shared = _shared(in_cells)
    else:
        part = F.pmod("cell", F.lit(parts))
        shared = reduce(DataFrame.unionByName, [materialise(_shared(in_cells.where(part == k))) for k in range(parts)])
    # Cells with the same documents need one look.
    shared = shared.groupBy("m", "low", "held").agg(F.min("cell").alias("cell"))
    leaves = F.ceil(F.col("m") / LEAF).cast("int")
    members = in_cells.join(_small(materialise(shared.select("cell", leaves.alias("leaves")))), "cell")
    leaf = F.pmod(F.xxhash64("rid", "cell"), F.col("leaves")).cast("int")
    return materialise(members.select("cell", "leaves", "rid", "label", leaf.alias("leaf")))


def similar(documents: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id, one row for each row of documents.

    Links are all pairs of documents whose sets of ``width``-word shingles have a Jaccard similarity of at least
    ``percent`` / 100.  component_id is the smallest doc_id that links reach.  A document without words, or with a
    NULL text, links with nothing.  Rows without a doc_id link as others do, but name no component: where no
    document of a component has an id, it is NULL.
    """
    signed = materialise(sign(documents, width, percent))
    classes = linked_classes(documents, signed, width, percent)
    lowest = classes.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = classes.select(*KEYS, "label").join(lowest, "label").select(*KEYS, "component_id")
    alone = signed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    found = signed.where("n > 0").join(named, list(KEYS))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def keep_one(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents`` without near duplicates: of each component the document with the smallest doc_id.

    Rows with a doc_id go before rows without one.  Rows without words stay, as they resemble nothing.
    """
    with scratch(documents.sparkSession):
        signed = materialise(sign(documents, width, percent))
        classes = linked_classes(documents, signed, width, percent)
        rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *KEYS)
        chosen = classes.groupBy("label").agg(F.min(rank).alias("x"))
        chosen = chosen.select(*[F.col(f"x.{k}").alias(f"_{k}") for k in KEYS], F.col("x.doc_id").alias("_doc_id"))
        chosen = materialise(chosen, outlive=1)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            codes, first = shingle_sets(part.column("text"), width)
            key_a, key_b = set_keys(codes, first)
            columns = [part.column("row"), part.column("doc_id"), *map(pa.array, (key_a, key_b, np.diff(first)))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", *KEYS])

    whole = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").alias("text"),
    )
    schema = T.StructType([whole.schema["row"], *[T.StructField(c, T.LongType()) for c in ("doc_id", *KEYS)]])
    rows = whole.mapInArrow(named, schema)
    same = [F.col(k) == F.col(f"_{k}") for k in KEYS] + [F.col("doc_id").eqNullSafe(F.col("_doc_id"))]
    kept = rows.where("n > 0").join(chosen, same).dropDuplicates([*KEYS, "doc_id"]).select("row")
    kept = kept.unionByName(rows.where("n = 0").select("row"))
    return kept.select([F.col(f"row.`{c}`").alias(c) for c in documents.columns])


def _small(table: DataFrame) -> DataFrame:
    """The table, to be shared with all tasks when it is measured to be small; joined by its key otherwise."""
    return F.broadcast(table) if fits_broadcast(table) else table


def _ends(pairs: DataFrame) -> DataFrame:
    """rid of every class in a pair."""
    return pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct()


def _sets_of(rids: DataFrame, documents: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """rid and shingle codes of the classes ``rids``, read from the texts again.

    A class may come more than once, where rows repeat a doc_id.
    """
    wanted = materialise(classes.select("rid", "key_a", "key_b", "doc_id").join(rids, "rid", "left_semi"))
    ids = wanted.select(F.struct("doc_id").alias("_id")).distinct()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.join(_small(ids), F.struct("doc_id") == F.col("_id"), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            codes, first = shingle_sets(part.column("text"), width)
            key_a, key_b = set_keys(codes, first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key_a), pa.array(key_b), tk.list_array(pa.array(codes.view(np.int64)), first)],
                names=["key_a", "key_b", "codes"],
            )

    made = rows.select("text").mapInArrow(sets, "key_a long, key_b long, codes array<long>")
    return materialise(made.join(_small(wanted.select("rid", "key_a", "key_b")), ["key_a", "key_b"]).select("rid", "codes"))
