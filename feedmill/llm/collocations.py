"""Phrase collocation mining: phrases counted in a HAT-trie, spilled as sorted runs, merged per prefix partition.

A task keeps a trie of word ids: containers that are hash tables burst into a level by the next word when they
grow, so a few levels suffice.  When the trie is full its largest subtrees are written out whole, in order of
their phrases, and the runs of all tasks are summed in partitions by the first two words of a phrase.

Only phrases that can be frequent enter the trie.  Three rounds over the coded texts find them: words, pairs of
frequent words, longer phrases all of whose pairs are frequent are counted by 40-bit codes, in arrays, without
their text.  A code counts for all its phrases and a phrase is no more frequent than its parts, so nothing that
counts is passed over.  What is left travels as bit tables of bounded size; a wrong hit costs an entry of the
trie, never a result.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import textkit as tk
from feedmill.operators.ranking import top_per_key
from feedmill.session import materialise

MIN_COUNT = 100
TOP = 2000
LONGEST = 5
#: Entries of a container before it bursts, of a trie before subtrees are spilled, and words with an id of their own.
BURST = 4096
TRIE_ENTRIES = 250_000
TRIE_WORDS = 250_000
#: Bits of the table of frequent phrases: some 16 for each, and never more than this (32 MB).
SIEVE_BITS = 1 << 28
PIECE_BITS = 1 << 21
#: Bytes of text that make a chunk.
CHUNK_BYTES = 5 << 18
#: Phrases of slices that a task gathers before they enter the trie, and words of a counting task beyond two for each core.
BUFFER_ENTRIES = 250_000
TASK_WORDS = 200_000_000
#: Codes that a task counts before it passes them on, and bits of a code.
CODE_ENTRIES = 750_000
CODE_BITS = 40
#: Texts and chunks that go to a task at once, and rows that come back: the JVM keeps them outside its heap.
TEXTS_AT_ONCE = 2000
CHUNKS_AT_ONCE = 6
BATCH_ROWS = 1 << 15

_BREAKS = np.isin(tk._BYTES, list(b".,;:!?\n\x0b\x0c\r"))
_IN_WORD = ~_BREAKS & (tk._BYTES != 0x20) & (tk._BYTES != 0x09)
_NOT_NEWLINE = tk._BYTES != 0x0A
_ID = 4


class Bucket(dict):
    """A container: the rest of a phrase (four bytes for each word id) to its count."""


class Branch(dict):
    """An inner node: a word id to the node below; ``own`` counts the phrase that ends here."""

    own = 0


class HatTrie:
    """Counts of phrases, given as packed word ids."""

    def __init__(self, burst: int = BURST):
        self.burst, self.root, self.entries = burst, Bucket(), 0

    def add(self, phrases: list[bytes], counts: list[int]) -> None:
        root = self.root
        for phrase, n in zip(phrases, counts, strict=True):
            node, at, above = root, 0, None
            while type(node) is Branch:
                if at == len(phrase):
                    self.entries += not node.own
                    node.own += n
                    break
                above, word = node, phrase[at : at + _ID]
                at += _ID
                node = above.get(word)
                if node is None:
                    node = above[word] = Bucket()
            else:
                rest = phrase[at:]
                if rest in node:
                    node[rest] += n
                    continue
                node[rest] = n
                self.entries += 1
                # A container of single words is as flat as a level below it would be.
                if len(node) > self.burst and len(rest) > _ID:
                    branch = self._burst(node)
                    if above is None:
                        root = self.root = branch
                    else:
                        above[word] = branch

    @staticmethod
    def _burst(bucket: Bucket) -> Branch:
        branch = Branch()
        for rest, n in bucket.items():
            if rest:
                below = branch.get(rest[:_ID])
                if below is None:
                    below = branch[rest[:_ID]] = Bucket()
                below[rest[_ID:]] = n
            else:
                branch.own = n
        return branch

    def take(self, entries: int) -> Iterator[list[tuple[bytes, int]]]:
        """Remove whole subtrees of the root, the largest first, until at most ``entries`` are left."""
        if type(self.root) is Bucket:
            run, self.root, self.entries = list(self.root.items()), Bucket(), 0
            if run:
                yield run
            return
        if self.root.own:
            self.entries -= 1
            yield [(b"", self.root.own)]
            self.root.own = 0
        sized = sorted(((_size(node), word) for word, node in self.root.items()), reverse=True)
        for size, word in sized:
            if self.entries <= entries:
                return
            self.entries -= size
            yield list(_phrases(self.root.pop(word), word))


def _size(node: Bucket | Branch) -> int:
    if type(node) is Bucket:
        return len(node)
    return bool(node.own) + sum(map(_size, node.values()))


def _phrases(node: Bucket | Branch, before: bytes) -> Iterator[tuple[bytes, int]]:
    if type(node) is Bucket:
        for rest, n in node.items():
            yield before + rest, n
        return
    if node.own:
        yield before, node.own
    for word, below in node.items():
        yield from _phrases(below, before + word)


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(at, BATCH_ROWS)


class _Counter:
    """The trie of a lang in one task, its words, and its runs."""

    def __init__(self, lang: str):
        self.lang, self.ids, self.names, self.trie = lang, {}, [], HatTrie()
        self.held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        self.size = 0

    def numbers(self, words: list[bytes]) -> np.ndarray:
        ids, names = self.ids, self.names
        out = np.empty(len(words), ">u4")
        for k, word in enumerate(words):
            found = ids.get(word)
            if found is None:
                found = ids[word] = len(names)
                names.append(word)
            out[k] = found
        return out

    def gather(self, length: int, codes: np.ndarray, shape: np.ndarray, counts: np.ndarray) -> None:
        """Hold the different phrases of a slice: their codes, word ids and counts."""
        self.held.setdefault(length, []).append((codes, shape, counts))
        self.size += len(codes)

    def settle(self) -> None:
        """Put what is held into the trie, each phrase once."""
        for length, parts in self.held.items():
            codes, shape, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            _, first, number = np.unique(codes, return_index=True, return_inverse=True)
            total = np.bincount(number, counts).astype(np.int64)
            raw, step = shape[first].astype(">u4").tobytes(), _ID * length
            self.trie.add([raw[k : k + step] for k in range(0, len(raw), step)], total.tolist())
        self.held, self.size = {}, 0

    def runs(self, entries: int) -> Iterator[pa.RecordBatch]:
        names = self.names
        for run in self.trie.take(entries):
            packed = np.frombuffer(b"".join([p for p, _ in run]), ">u4").tolist()
            rows, at = [], 0
            for phrase, n in run:
                end = at + len(phrase) // _ID
                rows.append((b" ".join([names[k] for k in packed[at:end]]), n))
                at = end
            rows.sort()
            yield from _cut(pa.RecordBatch.from_arrays(
                [
                    pa.array([self.lang] * len(rows), pa.string()),
                    pa.array([p for p, _ in rows], pa.binary()).cast(pa.string()),
                    pa.array([n for _, n in rows], pa.int64()),
                ],
                names=["lang", "phrase", "n"],
            ))


class Sieve:
    """A bit table of codes: two probes, no code is missed."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def places(codes: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        spread = tk.mix(codes)
        return spread & mask, (spread >> np.uint64(32)) & mask

    def has(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones(len(codes), bool)
        for at in self.places(codes, self.mask):
            out &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def sieve_of(codes: DataFrame) -> np.ndarray:
    """The bit table of all rows' ``code``, made in pieces; at most ``SIEVE_BITS`` come back."""
    size = 1 << 16
    wanted = min(SIEVE_BITS, 16 * codes.count())
    while size < wanted:
        size *= 2
    piece_bits = min(PIECE_BITS, size)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("code").to_numpy().view(np.uint64)
            at = np.concatenate(Sieve.places(own, np.uint64(size - 1))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // piece_bits), pa.array(at % piece_bits)], names=["piece", "at"])

    def made(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(piece_bits, np.uint8)
        bits[part["at"].to_numpy()] = 1
        return pd.DataFrame({"piece": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    # A piece has at most so many different places.
    places = codes.select("code").mapInArrow(placed, "piece long, at long").distinct()
    pieces = places.groupBy("piece").applyInPandas(made, "piece long, bits binary").collect()
    bits = np.zeros(size // 8, np.uint8)
    for row in pieces:
        begin = row["piece"] * piece_bits // 8
        bits[begin : begin + piece_bits // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _lang_code(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return tk.Words(raw, np.array([0, len(raw)]), np.ones(256, bool)).hashes().sum(dtype=np.uint64)


def _longer(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Code of a phrase with one more word."""
    return tk.mix(code * np.uint64(0xD6E8FEB86659FD93) + word)


def _short(code: np.ndarray) -> np.ndarray:
    return code >> np.uint64(64 - CODE_BITS)


def coded(documents: DataFrame) -> DataFrame:
    """(lang, n, words, tokens): texts of a slice as numbers of its words, from 1 on; 0 is the end of a piece.

    ``n`` counts the words.
    Within a slice (a few megabytes, or one text) words are told apart by 64-bit codes.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches, size=CHUNK_BYTES):
            langs = part.column("lang").dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = part.filter(pa.array(langs.indices.to_numpy() == k))
                words = tk.Words(*tk.buffer_of(own.column("text")), _IN_WORD, lower=True)
                if not len(words):
                    continue
                codes, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
                breaks = np.concatenate(([0], np.cumsum(_BREAKS[words.data])))[words.start]
                new = np.ones(len(words), bool)
                new[1:] = (breaks[1:] != breaks[:-1]) | (words.doc[1:] != words.doc[:-1])
                # A 0 goes in front of each piece.
                tokens = np.zeros(len(words) + int(new.sum()), np.uint32)
                tokens[np.arange(len(words)) + np.cumsum(new)] = inverse + 1
                raw = words.data.tobytes()
                names = b"\n".join([raw[s:e] for s, e in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)])
                kind = np.uint16 if len(codes) < 1 << 16 else np.uint32
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang]), pa.array([len(words)]), pa.array([names], pa.binary()),
                        pa.array([tokens.astype(kind).tobytes()], pa.binary()),
                    ],
                    names=["lang", "n", "words", "tokens"],
                )

    rows = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    with _few_rows_at_once(documents.sparkSession, TEXTS_AT_ONCE):
        return materialise(rows.mapInArrow(chunks, "lang string, n long, words binary, tokens binary"))


class _Slice:
    """A coded slice: ``tokens``, and a code for each of its numbers."""

    def __init__(self, row: dict):
        self.blob = row["words"]
        data = np.frombuffer(self.blob, np.uint8)
        codes = tk.Words(data, np.array([0, len(data)]), _NOT_NEWLINE).hashes()
        self.codes = np.concatenate((np.zeros(1, np.uint64), codes))
        kind = np.uint16 if len(codes) < 1 << 16 else np.uint32
        self.tokens = np.frombuffer(row["tokens"], kind)
        self.lang = _lang_code(row["lang"])

    def phrases(self, longest: int, sieves: list[Sieve]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places, codes) of the phrases of 1, 2 ... ``longest`` words, by the sieves as far as they go.

        The sieves hold words, pairs, and longer phrases.  A phrase is left out where its beginning, its last
        pair or, with all sieves given, the phrase itself is not in them.
        """
        tokens = self.tokens
        place = np.flatnonzero(tokens)
        word = _longer(np.full(len(self.codes), self.lang, np.uint64), self.codes)
        known = sieves[0].has(_short(word)) if sieves else None
        if known is not None:
            place = place[known[tokens[place]]]
        code = word[tokens[place]]
        yield 1, place, code
        good = np.zeros(len(tokens) + longest, bool)
        good[place] = True
        for length in range(2, longest + 1):
            # The phrase one word shorter begins here, and its last word begins what two words in a row may be.
            fits = good[place + (length - 1 if length == 2 else length - 2)]
            place, code = place[fits], code[fits]
            code = _longer(code, self.codes[tokens[place + length - 1]])
            if len(sieves) > min(length, 3) - 1:
                fits = sieves[min(length, 3) - 1].has(_short(code))
                place, code = place[fits], code[fits]
            yield length, place, code
            if length == 2:
                good[:] = False
                good[place] = True


@contextlib.contextmanager
def _few_rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of ``rows`` while a plan over texts or chunks runs, and pages of few chunks: a chunk has megabytes."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "parquet.page.size.row.check.min": "1"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _sieves(tables: list) -> list[Sieve]:
    return [Sieve(t.value) for t in tables]


def possible_codes(chunks: DataFrame, lengths: tuple[int, ...], tables: list, min_count: int) -> DataFrame:
    """(code): codes of the phrases of ``lengths`` words that have ``min_count`` occurrences together."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieves = _sieves(tables)
        parts, size = [], 0

        def combined() -> tuple[np.ndarray, np.ndarray]:
            codes, number = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            return codes, np.bincount(number, np.concatenate([n for _, n in parts])).astype(np.int64)

        def batch_of(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n)], names=["code", "n"])

        for batch in batches:
            for row in batch.to_pylist():
                for length, _, code in _Slice(row).phrases(max(lengths), sieves):
                    if length in lengths:
                        parts.append(np.unique(_short(code), return_counts=True))
                        size += len(parts[-1][0])
                if size > CODE_ENTRIES:
                    parts = [combined()]
                    size = len(parts[0][0])
                    if size > CODE_ENTRIES // 2:
                        yield from _cut(batch_of(*parts[0]))
                        parts, size = [], 0
        if parts:
            yield from _cut(batch_of(*combined()))

    rows = chunks.select("lang", "words", "tokens").mapInArrow(counted, "code long, n long")
    sums = rows.groupBy("code").agg(F.sum("n").alias("n"))
    with _few_rows_at_once(chunks.sparkSession, CHUNKS_AT_ONCE):
        return materialise(sums.where(F.col("n") >= min_count).select("code"))


def count_phrases(chunks: DataFrame, longest: int, tables: list) -> DataFrame:
    """(lang, phrase, n) of all phrases of up to ``longest`` words that the bit tables let through, joined by spaces."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieves = _sieves(tables)
        counters: dict[str, _Counter] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = counters.get(row["lang"])
                if own is None:
                    own = counters[row["lang"]] = _Counter(row["lang"])
                piece = _Slice(row)
                names = piece.blob.split(b"\n")
                words, told = np.zeros(len(piece.codes), ">u4"), np.zeros(len(piece.codes), bool)
                for length, place, code in piece.phrases(longest, sieves):
                    own_codes, first, count = np.unique(code, return_index=True, return_counts=True)
                    shape = piece.tokens[place[first][:, None] + np.arange(length)]
                    # Only words of counted phrases get an id.
                    fresh = np.unique(shape[~told[shape]])
                    words[fresh] = own.numbers([names[k - 1] for k in fresh.tolist()])
                    told[fresh] = True
                    own.gather(length, own_codes, words[shape], count)
                if sum(c.size for c in counters.values()) > BUFFER_ENTRIES:
                    for c in counters.values():
                        c.settle()
                if sum(c.trie.entries for c in counters.values()) > TRIE_ENTRIES:
                    for c in counters.values():
                        yield from c.runs(c.trie.entries // 2)
                if sum(len(c.names) for c in counters.values()) > TRIE_WORDS:
                    for c in counters.values():
                        c.settle()
                        yield from c.runs(0)
                    counters = {}
        for c in counters.values():
            c.settle()
            yield from c.runs(0)

    # A phrase leaves a task once, so tasks are large: two for each core, and more where they would get too long.
    words = chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks = max(2 * chunks.sparkSession.sparkContext.defaultParallelism, words // TASK_WORDS)
    runs = chunks.select("lang", "words", "tokens").coalesce(tasks).mapInArrow(counted, "lang string, phrase string, n long")
    prefix = F.substring_index("phrase", " ", 2).alias("prefix")
    dealt = runs.select("lang", prefix, "phrase", "n").repartition("lang", "prefix")
    merged = dealt.groupBy("lang", "prefix", "phrase").agg(F.sum("n").alias("n"))
    return merged.select("lang", "phrase", "n")


def frequent_phrases(documents: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of up to ``longest`` words found ``min_count`` times, and (lang, n) of all words."""
    chunks = coded(documents)
    context, tables = documents.sparkSession.sparkContext, []
    for lengths in [(1,), (2,), tuple(range(3, longest + 1))][: min(longest, 3)]:
        codes = possible_codes(chunks, lengths, tables, min_count)
        tables = [*tables, context.broadcast(sieve_of(codes))]  # each at most SIEVE_BITS
    with _few_rows_at_once(documents.sparkSession, CHUNKS_AT_ONCE):
        found = materialise(count_phrases(chunks, longest, tables).where(F.col("n") >= min_count))
    return found, chunks.groupBy("lang").agg(F.sum("n").alias("n"))


def _parts(size: int, longest: int):
    """(begin, length) of the contiguous parts of two words or more, the whole left out."""
    return [(k, m) for m in range(2, min(size, longest)) for k in range(size - m + 1)]


def collocations(
    documents: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, longest: int = LONGEST
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: of each lang the ``top`` phrases of two words or more, best first.

    Letters A-Z are lowered, texts split at ``. , ; : ! ?`` and line ends into pieces, and those at spaces and tabs
    into words.  A phrase found ``min_count`` times (a) is cut where floor(1000 * a * n / (l * r)) is least (the
    first such cut); it goes when a longer one that holds it is as frequent.  Rank 1 has the highest score, then the
    highest a, then the smallest phrase.  Rows count as they come, repeated ones too; a NULL text is empty, a NULL
    lang is ``und``.  Texts without words give nothing; without any frequent phrase there are no rows.
    """
    found, totals = frequent_phrases(documents, min_count, longest)
    every = found.withColumn("words", F.split("phrase", " "))
    candidates = every.where(F.size("words") > 1).withColumnRenamed("n", "a")

    def joined(begin, length):
        return F.array_join(F.slice("words", begin + 1, length), " ")

    def held(size):
        return F.array(*[joined(F.lit(k), F.lit(m)) for k, m in _parts(size, longest)])

    by_size = F.lit(None).cast("array<string>")
    for size in range(3, longest + 1):
        by_size = F.when(F.size("words") == size, held(size)).otherwise(by_size)
    inner = candidates.select("lang", F.col("a").alias("other"), F.explode(by_size).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("other").alias("other"))
    kept = candidates.join(inner, ["lang", "phrase"], "left").where(F.col("other").isNull() | (F.col("other") < F.col("a")))

    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(0), F.col("k")).alias("left"), joined(F.col("k"), F.size("words") - F.col("k")).alias("right"))
    counts = found.select("lang", F.col("phrase").alias("part"), "n")
    left = counts.select("lang", F.col("part").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("part").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    # a, n and 1000 * a have at most 19 digits, so the products are exact.
    score = F.expr("(CAST(1000 * a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    rows = best.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    ranked = top_per_key(rows, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top, "rank")
    rank = (F.col("rank") + 1).cast("long").alias("rank")
    return ranked.select("lang", rank, "phrase", "a", "l", "r", "n", "score")
