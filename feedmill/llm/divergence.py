"""Source divergence audit: in-mapper stripes of terms, merged by key, from which divergences come.

A task folds whole documents into hash stripes: for each term of a lang its document frequency and its count by
source.  The stripes are columns keyed by the term's hash; when they outgrow their bound they are spilled.  The
shuffle brings the stripes of a term together in order, where they are merged one after the other.  The merged
stripes give the counts of all groups at once.

A term without a count in a group has the group's least share, the same for all such terms.  So pairs of sources
are compared on the terms that both have, and on a histogram of shares for the rest: no row is made for a zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm import textkit as tk
from feedmill.operators.ranking import top_per_key
from feedmill.session import materialise

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE_DIGITS = 9
#: Counts that a task holds before it spills its stripes, and rows of a batch.
STRIPE_COUNTS = 1_500_000
BATCH_ROWS = 20_000

# Letters and all that is not ASCII.
_IN_TERM = ((tk._BYTES | 32) >= 97) & ((tk._BYTES | 32) <= 122) | (tk._BYTES >= 0x80)
_STRIPES = "lang string, term string, documents long, sources array<string>, counts array<long>"
_NAMES = ["lang", "term", "documents", "sources", "counts"]


def _words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The given byte ranges as strings."""
    width = end - start
    offsets = np.concatenate(([0], np.cumsum(width)))
    own = data[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], width)]
    return pa.Array.from_buffers(pa.large_string(), len(width), [None, pa.py_buffer(offsets), pa.py_buffer(own)]).cast(pa.string())


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.int64)


def _begins(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


class _Stripes:
    """Counts of a task by (lang, term, source), and documents by the same, in columns; ``term`` points into ``names``."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.sources: dict[str, int] = {}
        self.names: list[pa.Array] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = self.terms = 0

    def fold(self, part: pa.RecordBatch) -> None:
        """Add the documents of a slice, texts whole.  Each counts once for the empty term of its lang."""
        lang, source = (
            np.array([own.setdefault(x, len(own)) for x in pc.fill_null(part.column(c), "").to_pylist()], np.int64)
            for c, own in (("lang", self.langs), ("source", self.sources))
        )
        words = tk.Words(*tk.buffer_of(part.column("text")), _IN_TERM, lower=True)
        codes, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        # Once for each document that has the word, then for each group of documents.
        pair, n = np.unique(words.doc * len(codes) + number, return_counts=True)
        doc, word = np.divmod(pair, max(1, len(codes)))
        self.names.append(_words(words.data, words.start[first], words.end[first]))
        self._add(lang[doc], codes[word], source[doc], n, np.ones(len(n), np.int64), self.terms + word)
        self.terms += len(codes)
        none = np.zeros(part.num_rows, np.int64)
        self.names.append(pa.array([""]))
        self._add(lang, none.astype(np.uint64), source, none, none + 1, none + self.terms)
        self.terms += 1
        if self.size > STRIPE_COUNTS:
            self._combine()

    def _add(self, *columns: np.ndarray) -> None:
        lang, code, source, n, documents, term = columns
        order = np.lexsort((source, code, lang))
        lang, code, source, n, documents, term = (x[order] for x in columns)
        at = _begins(lang, code, source)
        self.parts.append((lang[at], code[at], source[at], _sums(n, at), _sums(documents, at), term[at]))
        self.size += len(at)

    def _combine(self) -> None:
        columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
        self.parts, self.size = [], 0
        self._add(*columns)

    def spilled(self) -> Iterator[pa.RecordBatch]:
        """All stripes, which are forgotten."""
        if not self.parts:
            return
        self._combine()
        lang, code, source, n, documents, term = self.parts[0]
        at = _begins(lang, code)
        names = pa.chunked_array(self.names).combine_chunks()
        held = pa.RecordBatch.from_arrays(
            [
                pa.array(list(self.langs), pa.string()).take(pa.array(lang[at])),
                names.take(pa.array(term[at])),
                pa.array(_sums(documents, at)),
                tk.list_array(pa.array(list(self.sources), pa.string()).take(pa.array(source)), np.append(at, len(lang))),
                tk.list_array(pa.array(n), np.append(at, len(lang))),
            ],
            names=_NAMES,
        )
        self.__init__()
        for k in range(0, held.num_rows, BATCH_ROWS):
            yield held.slice(k, BATCH_ROWS)


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of a task's documents (lang, source, text).

    The stripe of the empty term names the sources of the lang that occur.  Within a task words are told apart by
    64-bit codes; what leaves it are the words.
    """
    held = _Stripes()
    for part in tk.slices(batches):
        held.fold(part)
        if held.size > STRIPE_COUNTS // 2:
            yield from held.spilled()
    yield from held.spilled()


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row for each run of equal (lang, term)."""
    lang, term, documents, sources, counts = batch.columns
    differs = np.zeros(len(lang), bool)
    differs[:1] = True
    if len(lang) > 1:
        for x in (lang, term):
            differs[1:] |= pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(differs)
    run = np.cumsum(differs) - 1
    named = sources.flatten().dictionary_encode()
    number, n = named.indices.to_numpy(), counts.flatten().to_numpy()
    key = np.repeat(run, sources.value_lengths().to_numpy()) * max(1, len(named.dictionary)) + number
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = _begins(key)
    offsets = np.searchsorted(key[first] // max(1, len(named.dictionary)), np.arange(len(at) + 1))
    return pa.RecordBatch.from_arrays(
        [
            lang.take(pa.array(at)), term.take(pa.array(at)), pa.array(_sums(documents.to_numpy(), at)),
            tk.list_array(named.dictionary.take(pa.array(number[order][first])), offsets), tk.list_array(pa.array(_sums(n, first)), offsets),
        ],
        names=_NAMES,
    )


def merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sum stripes that come in order of lang and term; those of fewer than ``least`` documents end here.

    The last stripe of a batch may go on in the next one.  It holds no more than its sources, however many
    stripes went into it.
    """
    open_stripe = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if open_stripe is not None:
            batch = pa.Table.from_batches([open_stripe, batch.cast(open_stripe.schema)]).combine_chunks().to_batches()[0]
        done = _merged(batch)
        open_stripe = done.slice(done.num_rows - 1)
        yield _enough(done.slice(0, done.num_rows - 1), least)
    if open_stripe is not None:
        yield _enough(open_stripe, least)


def _enough(stripes: pa.RecordBatch, least: int) -> pa.RecordBatch:
    return stripes.filter(pc.or_(pc.greater_equal(stripes.column("documents"), least), pc.equal(stripes.column("term"), "")))


def stripes(documents: DataFrame, least: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, documents, sources, counts) of every term in at least ``least`` documents of its lang.

    The empty term of each lang has all its sources, with counts of 0.  NULLs are empty; a row is a document.
    """
    text = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")]
    folded = documents.select(*text).mapInArrow(fold, _STRIPES)
    dealt = folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return materialise(dealt.mapInArrow(lambda batches: merge(batches, least), _STRIPES))


def share(count: str, total: str) -> str:
    """SQL of 1 + floor(10**9 * (count + 1) / total), count + 1 being at most total.

    Three digits at a time, so that totals up to 9 * 10**15 stay exact in 64 bits.
    """
    quotient, rest = "0L", f"({count} + 1L)"
    for _ in range(SCALE_DIGITS // 3):
        quotient = f"({quotient} * 1000L + ({rest} * 1000L) DIV {total})"
        rest = f"(({rest} * 1000L) % {total})"
    return f"1L + {quotient}"


def _f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) DIV ({q}))"


def audit(documents: DataFrame, least: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value and rank: how the word use of each source differs.

    Terms are runs of letters and of characters beyond ASCII, A-Z lowered; a lang keeps the V terms in at least
    ``least`` of its documents.  A group (lang, source), or a lang, with N occurrences of kept terms gives a term with
    count c the share p = 1 + floor(10**9 * (c + 1) / (N + V)), and f(p, q) = floor((p - q)**2 / q).  Part ``pair`` has
    each other source of the lang with the sum of f over all kept terms (0 without any), q being the other's share;
    part ``term`` the first ``top`` terms that the group has, with p above the lang's share q.  Ranks go by value
    descending, then item.  NULL text, lang and source are empty strings, rows are documents even if their ids
    repeat, and a lang with one source has no pairs.
    """
    found = stripes(documents, least)
    terms = found.where("term <> ''")
    groups = found.where("term = ''").select("lang", F.explode("sources").alias("source"))
    counts = terms.select("lang", "term", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("all_n"), F.inline(F.arrays_zip("sources", "counts")))
    counts = counts.withColumnsRenamed({"sources": "source", "counts": "n"})
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sized = groups.join(sums, ["lang", "source"], "left").fillna(0, ["total"])
    langs = sized.groupBy("lang").agg(F.sum("total").alias("all_total")).join(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left").fillna(0, ["v"])
    sized = sized.join(langs, "lang")
    least_share = F.expr(f"CASE WHEN v > 0 THEN {share('0L', '(total + v)')} ELSE 1L END").alias("p0")
    totals = materialise(sized.select("lang", "source", "v", (F.col("total") + F.col("v")).alias("d"), (F.col("all_total") + F.col("v")).alias("all_d"), least_share))

    shares = counts.join(totals, ["lang", "source"]).select(
        "lang", "source", "term", "p0", F.expr(share("n", "d")).alias("p"), F.expr(share("all_n", "all_d")).alias("q")
    )
    shares = materialise(shares)
    up = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    up = up.withColumn("group", F.struct("lang", "source"))
    # Of each group every task sends on its first rows only.
    order = [F.desc("value"), F.asc("item")]
    up = top_per_key(up, "group", order, top, "rank").select("lang", "source", "part", "item", "value", (F.col("rank") + 1).cast("int").alias("rank"))
    ordered = Window.partitionBy("lang", "source").orderBy(*order)
    pairs = _pairs(shares, totals).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ordered).alias("rank")
    )
    return pairs.unionByName(up)


def _pairs(shares: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum of f over all kept terms for every ordered pair of sources of a lang.

    With x0 and y0 for the shares of no count, sum f(x, y) = V f(x0, y0) + the terms that x has, each f(x, y0) -
    f(x0, y0), + those that y has, each f(x0, y) - f(x0, y0), + those that both have, each f(x, y) - f(x, y0) -
    f(x0, y) + f(x0, y0).
    """
    other = F.struct(F.col("source").alias("item"), F.col("p0").alias("q0"))
    others = totals.groupBy("lang").agg(F.collect_list(other).alias("others"))  # as many as there are result rows for one source
    reach = materialise(totals.join(others, "lang").select("lang", "source", "p0", "v", "others"))
    base = reach.select("lang", "source", "p0", "v", F.inline("others")).where("source <> item")
    base = base.select("lang", "source", "item", F.expr(f"v * {_f('p0', 'q0')}").alias("value"))

    seen = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    single = seen.join(reach, ["lang", "source"]).select("lang", "source", "p", "p0", "m", F.inline("others")).where("source <> item")
    own = single.select("lang", "source", "item", F.expr(f"m * ({_f('p', 'q0')} - {_f('p0', 'q0')})").alias("value"))
    turned = single.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.expr(f"m * ({_f('q0', 'p')} - {_f('q0', 'p0')})").alias("value"))

    # The shares of a term, one for each source that has it.
    held = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("held")).where(F.size("held") > 1)
    one = held.select("lang", "held", F.inline("held"))
    item = F.inline(F.transform("held", lambda x: F.struct(x["source"].alias("item"), x["p"].alias("q"), x["p0"].alias("q0"))))
    # Each two sources once, for both directions.
    both = one.select("lang", "source", "p", "p0", item).where("source < item")
    forth = f"{_f('p', 'q')} - {_f('p', 'q0')} - {_f('p0', 'q')} + {_f('p0', 'q0')}"
    back = f"{_f('q', 'p')} - {_f('q', 'p0')} - {_f('q0', 'p')} + {_f('q0', 'p0')}"
    both = both.groupBy("lang", "source", "item").agg(F.sum(F.expr(forth)).alias("forth"), F.sum(F.expr(back)).alias("back"))
    both = both.selectExpr("lang", "stack(2, source, item, forth, item, source, back) AS (source, item, value)")
    every = base.unionByName(own).unionByName(turned).unionByName(both)
    return every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
