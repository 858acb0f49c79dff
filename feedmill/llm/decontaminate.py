"""Benchmark decontamination by a distributed positional inverted index.

The corpus is cut into segments of whole documents.  A segment numbers its
words through, with a gap after each document, and stores for every word the
list of its places.  A test phrase is found by taking its words from the rarest
on, moving each list back by the word's offset in the phrase, and intersecting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import textkit as tk
from feedmill.session import materialise

WINDOW = 13
#: A segment is closed once it has this many words; it bounds the memory of a task.
SEGMENT_WORDS = 1 << 21
#: The benchmark is matched in blocks of about this many words; each block is shared with all tasks.
BLOCK_WORDS = 250_000

_INDEX = pa.schema(
    [
        ("segment", pa.int64()),
        ("term", pa.int64()),
        ("n", pa.int32()),
        ("postings", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_codes", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
    ]
)
_INDEX_SQL = "segment long, term long, n int, postings binary, doc_ids array<long>, doc_codes array<long>, lengths array<int>"
_MATCH_SQL = (
    "segment long, ord int, item_id string, kind string, windows int, spans array<struct<start:int,end:int>>"
)


def _flush(segment: int, codes: list, counts: list, ids: list, texts: list) -> Iterator[pa.RecordBatch]:
    lengths = np.concatenate(counts).astype(np.int64)
    code = np.concatenate(codes)
    place = np.arange(len(code)) + np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(code, kind="stable")
    code, place = code[order], place[order]
    new = np.concatenate(([True], code[1:] != code[:-1])) if len(code) else np.zeros(0, bool)
    first = np.append(np.flatnonzero(new), len(code))
    delta = np.diff(place, prepend=0)
    delta[first[:-1]] = place[first[:-1]]
    data, offsets = tk.pack_varints(delta, first)
    terms = len(first) - 1
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([segment], pa.int64()),
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.int32()),
            pa.nulls(1, pa.binary()),
            tk.list_array(pa.concat_arrays(ids), [0, len(lengths)]),
            tk.list_array(pa.concat_arrays(texts), [0, len(lengths)]),
            tk.list_array(pa.array(lengths, pa.int32()), [0, len(lengths)]),
        ],
        schema=_INDEX,
    )
    for low in range(0, terms, 100_000):
        high = min(terms, low + 100_000)
        part = slice(low, high)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(high - low, segment)),
                pa.array(code[first[:-1]][part].view(np.int64)),
                pa.array(np.diff(first)[part], pa.int32()),
                tk.binary_array(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]),
                *(pa.nulls(high - low, pa.list_(pa.int64())) for _ in range(2)),
                pa.nulls(high - low, pa.list_(pa.int32())),
            ],
            schema=_INDEX,
        )


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    segment = TaskContext.get().partitionId() << 24
    codes, counts, ids, texts, held = [], [], [], [], 0
    for part in tk.slices(batches):
        words = tk.Words(*tk.buffer_of(part.column("text")), tk.IN_ALNUM_WORD, lower=True)
        codes.append(words.hashes())
        counts.append(words.count)
        ids.append(part.column("doc_id"))
        texts.append(part.column("doc_code"))
        held += len(words)
        if held >= SEGMENT_WORDS:
            yield from _flush(segment, codes, counts, ids, texts)
            codes, counts, ids, texts, held, segment = [], [], [], [], 0, segment + 1
    if ids:
        yield from _flush(segment, codes, counts, ids, texts)


def text_code(text: str = "text"):
    """With the doc_id, what a document of the index is known by."""
    return F.xxhash64(text)


def build_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the index of all documents: one directory row (term NULL) and the term rows of each segment.

    A NULL text has no words.  Rows that share a doc_id, or have none, stay documents of their own.
    """
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_code(text).alias("doc_code"), F.col(text).alias("text")
    )
    return materialise(rows.mapInArrow(_index_rows, _INDEX_SQL))


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tk.slices(batches):
        words = tk.Words(*tk.buffer_of(part.column("text")), tk.IN_ALNUM_WORD, lower=True)
        codes = pa.array(words.hashes().view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [part.column("item_id"), tk.list_array(codes, words.first)], names=["item_id", "terms"]
        )


def benchmark_terms(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Items with their words as codes.  Items without a word are left out; an item without id is named ''."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.col(text).alias("text"))
    items = rows.mapInArrow(_item_rows, "item_id string, terms array<long>")
    return materialise(items.where(F.size("terms") > 0).distinct())


def _near(places: np.ndarray, others: np.ndarray, slop: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest of ``others`` in its own document (``low`` to ``high``), the earlier of two, and
    whether it is within ``slop``."""
    right = np.searchsorted(others, places)
    left = right - 1
    far = np.iinfo(np.int64).max // 4
    after, before = others[np.minimum(right, len(others) - 1)], others[np.maximum(left, 0)]
    ahead = np.where((right < len(others)) & (after < high) & (after >= low), after - places, far)
    behind = np.where((left >= 0) & (before >= low) & (before < high), places - before, far)
    return np.where(ahead < behind, after, before), np.minimum(ahead, behind) <= slop


def phrase_starts(terms: np.ndarray, places_of, base: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the phrase starts, and the first and last word of each match; ``base`` has the documents' first places.

    Lists are intersected from the rarest term on, each moved back by its offset in the phrase.  With a slop, a
    start matches if every word, the rarest too, stands that far from its place or nearer, in one document; so
    matches do not hang on which word is the rarest.
    """
    lists = []
    for offset, term in enumerate(terms):
        places = places_of(term)
        if places is None:
            return (np.zeros(0, np.int64),) * 3
        lists.append((len(places), offset, places))
    lists.sort(key=lambda x: x[:2])
    anchors, offset = lists[0][2], lists[0][1]
    if slop:
        # A start and the document of its rarest word; near an edge two documents may share a start.
        doc = np.repeat(np.searchsorted(base, anchors, "right") - 1, 2 * slop + 1)
        starts = (anchors[:, None] - offset + np.arange(-slop, slop + 1)).ravel()
        pairs = np.unique(np.stack([doc, starts]), axis=1)
        doc, starts = pairs
    else:
        doc, starts, lists = np.searchsorted(base, anchors, "right") - 1, anchors - offset, lists[1:]
    low = high = anchors
    if slop:
        low, high = np.full(len(starts), np.iinfo(np.int64).max), np.full(len(starts), -1)
    for _, offset, places in lists:
        nearest, close = _near(starts + offset, places, slop, base[doc], base[doc + 1])
        starts, doc = starts[close], doc[close]
        low, high = np.minimum(low, nearest)[close], np.maximum(high, nearest)[close]
        if not len(starts):
            break
    if slop:
        # Documents may share a start, but not a place.
        order = np.argsort(low, kind="stable")
        starts, low, high = starts[order], low[order], high[order]
    return starts, low, high


def _matches(items: list, window: int, slop: int):
    def of_segment(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        is_directory = rows["lengths"].notna()
        directory = rows[is_directory]
        lengths = np.asarray(directory["lengths"].iloc[0], np.int64)
        base = np.concatenate(([0], np.cumsum(lengths + 1)))
        held = rows[~is_directory]
        raw = dict(zip(held["term"], held["postings"], strict=True))
        open_lists: dict[int, np.ndarray] = {}

        def places_of(term: int):
            if term not in raw:
                return None
            if term not in open_lists:
                open_lists[term] = np.cumsum(tk.unpack_varints(raw[term]))
            return open_lists[term]

        out = []
        for item_id, terms in items:
            width = min(window, len(terms))
            found = [phrase_starts(terms[i : i + width], places_of, base, slop) for i in range(len(terms) - width + 1)]
            hit = sum(len(x[0]) > 0 for x in found)
            if not hit:
                continue
            low, high = (np.concatenate([x[k] for x in found]) for k in (1, 2))
            order = np.argsort(low, kind="stable")
            # A match lies in one document, so the furthest end so far is never beyond it.
            low, high = low[order], np.maximum.accumulate(high[order] + 1)
            doc = np.searchsorted(base, low, "right") - 1
            fresh = np.concatenate(([True], (low[1:] > high[:-1]) | (doc[1:] != doc[:-1])))
            at = np.flatnonzero(fresh)
            ends = high[np.append(at[1:], len(high)) - 1]
            for k in np.unique(doc[at]):
                own = doc[at] == k
                spans = [
                    {"start": int(s), "end": int(e)}
                    for s, e in zip(low[at][own] - base[k], ends[own] - base[k], strict=True)
                ]
                out.append((key[0], int(k), item_id, "proximity" if slop else "phrase", int(hit), spans))
        return pd.DataFrame(out, columns=["segment", "ord", "item_id", "kind", "windows", "spans"])

    return of_segment


def find_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Documents (segment, ord) in which windows of an item occur, with the merged word spans.

    The items are a stated query set: they pass in blocks of bounded size, each against the whole index.
    """
    spark = index.sparkSession
    total = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_WORDS))
    found = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block)
        held = [(r["item_id"], np.array(r["terms"], np.int64)) for r in own.toLocalIterator()]
        terms = own.select(F.explode("terms").alias("term")).distinct()
        rows = index.join(F.broadcast(terms), "term", "left_semi").unionByName(index.where(F.col("term").isNull()))
        # pandas would turn a NULL among the terms into a float.
        rows = rows.select("segment", F.coalesce("term", F.lit(0)).cast("long").alias("term"), "postings", "lengths")
        part = rows.groupBy("segment").applyInPandas(_matches(held, window, slop), _MATCH_SQL)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], _MATCH_SQL)


def documents_of(index: DataFrame) -> DataFrame:
    """The documents of the index: segment, ord, doc_id, doc_code, n_words."""
    directory = index.where(F.col("term").isNull())
    pairs = directory.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_codes", "lengths")).alias("ord", "x"))
    return pairs.select(
        "segment",
        "ord",
        F.col("x.doc_ids").alias("doc_id"),
        F.col("x.doc_codes").alias("doc_code"),
        F.col("x.lengths").cast("long").alias("n_words"),
    )


def contamination(index: DataFrame, matches: DataFrame) -> DataFrame:
    """A row for each document: words inside matches, items matched, and the verdict (hit words are 5 % or more)."""
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    per_doc = matches.groupBy("segment", "ord").agg(
        spans.alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["reach"]))).alias("n"),
            F.greatest(a["reach"], s["end"]).alias("reach"),
        ),
        lambda a: a["n"],
    )
    hits = per_doc.select("segment", "ord", covered.alias("n_hit"), "items")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return documents_of(index).join(hits, ["segment", "ord"], "left").select(
        "doc_id",
        "doc_code",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Verdicts of all documents against a benchmark; see ``contamination``."""
    index = build_index(documents)
    return contamination(index, find_matches(index, benchmark_terms(benchmark), window))


def keep_clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, with all their columns."""
    found = decontaminate(documents, benchmark, window).where("contaminated")
    marks = found.select(F.struct("doc_id", "doc_code").alias("_mark")).distinct()
    own = F.struct(F.col("doc_id").cast("long"), text_code())
    return documents.join(marks, own == F.col("_mark"), "left_anti")
