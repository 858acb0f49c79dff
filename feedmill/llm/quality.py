"""Quality rules: lines labelled content or boilerplate by a linear-chain conditional random field.

Each line is a set of binary features.  Viterbi decoding labels the lines of a document together,
and the share of its words on content lines decides whether it stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.llm import textkit as tk

#: About this many labelled documents fit the model, drawn by a hash of the id.
TRAIN_DOCUMENTS = 2000
ITERATIONS = 60
RIDGE = 1e-3
#: A document stays when this share of its words is on content lines.
CONTENT_SHARE = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8

FEATURES = (
    "one word", "two or three words", "up to ten words", "up to fifty words", "more words",
    "a symbol", "symbols on a fifth of the words", "symbols on half of the words",
    "half capitals", "nearly all capitals", "exclamation on half of the words",
    "ends a sentence", "digits are a fifth", "long words", "short words",
    "equals an earlier line", "a third repeats", "nearly all repeats", "a third equals the word before",
)
_SHIFT = np.arange(len(FEATURES))

_B = tk._BYTES
_SYMBOL = np.isin(_B, list(b"#*$%&|<>"))
_CAPITAL = (_B >= 65) & (_B <= 90)
_LETTER = _CAPITAL | ((_B >= 97) & (_B <= 122))
_DIGIT = (_B >= 48) & (_B <= 57)
_NOT_NEWLINE = _B != 0x0A

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Measured(NamedTuple):
    base: dict[str, np.ndarray]  # of each row
    bits: np.ndarray  # features of each line with a word
    words: np.ndarray  # words of each line
    first: np.ndarray  # lines before each row


def measure(column: pa.Array) -> Measured:
    data, offsets = tk.buffer_of(column)
    words = tk.Words(data, offsets, tk.IN_WHITE_WORD)
    codes = words.hashes()
    # Words of windows that occur twice or more in their text.
    code, at = tk.windows(codes, words.first, REPEAT_WINDOW)
    code = code ^ tk.mix(words.doc[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = at[order[np.append(same, False) | np.append(False, same)]] if len(code) else at
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + REPEAT_WINDOW, -1)
    repeats = np.cumsum(edge[:-1]) > 0
    line = tk.Words(data, offsets, _NOT_NEWLINE)
    word_at = np.searchsorted(words.start, np.append(line.start, len(data)))
    n = np.searchsorted(words.start, line.end) - word_at[:-1]
    keep = n > 0
    doc = line.doc[keep]
    key = line.hashes()[keep] ^ tk.mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order][1:] == key[order][:-1]

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (total[line.end] - total[line.start])[keep]

    chars = ~tk.IS_CONTINUATION[data] & tk.IN_WHITE_WORD[data]
    symbols = _SYMBOL[data]
    n_symbols, n = per_line(symbols), n[keep]
    letters, capitals, digits = per_line(_LETTER[data]), per_line(_CAPITAL[data]), per_line(_DIGIT[data])
    n_chars, shouts = per_line(chars), per_line(data == 0x21)
    rep = np.concatenate(([0], np.cumsum(repeats)))
    repeated = rep[word_at[:-1][keep] + n] - rep[word_at[:-1][keep]]
    twin = np.concatenate(([0], [0], np.cumsum(codes[1:] == codes[:-1])))[: len(codes) + 1]
    twins = twin[word_at[:-1][keep] + n] - twin[np.minimum(word_at[:-1][keep] + 1, len(codes))]
    last = words.end[word_at[:-1][keep] + n - 1] - 1
    flags = [
        n == 1, (n > 1) & (n < 4), (n > 3) & (n < 11), (n > 10) & (n < 51), n > 50,
        n_symbols > 0, n_symbols * 5 > n, n_symbols * 2 > n,
        capitals * 2 > letters, capitals * 10 > letters * 9, shouts * 2 > n,
        np.isin(data[last], list(b".!?")), digits * 5 > n_chars, n_chars > 12 * n, n_chars * 2 < 5 * n,
        again, repeated * 3 > n, repeated * 10 > n * 9, twins * 3 > n,
    ]
    bits = np.zeros(len(n), np.int32)
    for k, flag in enumerate(flags):
        bits |= flag.astype(np.int32) << k
    first = np.searchsorted(doc, np.arange(len(column) + 1))
    base = {
        "n_words": words.count.astype(np.int64),
        "word_chars": tk.counted(chars, offsets),
        "n_symbols": tk.counted(symbols, offsets),
        "n_dup_lines": tk.counted(again, first),
        "n_repeat_words": tk.counted(repeats, words.first),
    }
    return Measured(base, bits, n, first)


class Model(NamedTuple):
    """Log weights: of features and a constant for content, and of moving from one label to the next."""

    weights: np.ndarray
    bias: float
    move: np.ndarray

    def emissions(self, bits: np.ndarray) -> np.ndarray:
        table = (bits[:, None] >> _SHIFT) & 1
        return table @ self.weights + self.bias


def decode(emissions: list[float], move: np.ndarray) -> list[bool]:
    """Viterbi: the most likely labels of a chain, content where True; content wins a tie."""
    (bb, bc), (cb, cc) = move.tolist()
    boiler, content, back = 0.0, emissions[0], []
    for e in emissions[1:]:
        to_boiler, to_content = content + cb >= boiler + bb, content + cc >= boiler + bc
        back.append((to_boiler, to_content))
        boiler, content = (
            content + cb if to_boiler else boiler + bb,
            (content + cc if to_content else boiler + bc) + e,
        )
    label = content >= boiler
    labels = [label]
    for to_boiler, to_content in reversed(back):
        label = to_content if label else to_boiler
        labels.append(label)
    return labels[::-1]


def fit(chains: list[np.ndarray], labels: list[int], iterations: int = ITERATIONS) -> Model:
    """Maximum likelihood by gradient steps, all chains at once; a line has the label of its document."""
    order = sorted(range(len(chains)), key=lambda k: -len(chains[k]))
    chains, y = [chains[k] for k in order], np.array([labels[k] for k in order], float)
    length = np.array([len(c) for c in chains])
    steps = [int((length > t).sum()) for t in range(int(length[0]))]
    table = [((np.array([c[t] for c in chains[:n]])[:, None] >> _SHIFT) & 1).astype(float) for t, n in enumerate(steps)]
    size = len(FEATURES)
    theta = np.zeros(size + 5)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    total = float(length.sum())
    for step in range(1, iterations + 1):
        w, bias, move = theta[:size], theta[size], theta[size + 1 :].reshape(2, 2)
        forward = []
        for t, n in enumerate(steps):
            e = table[t] @ w + bias
            if t == 0:
                a = np.stack([np.zeros(n), e], 1)
            else:
                before = forward[-1][:n]
                a = np.logaddexp(before[:, :1] + move[0], before[:, 1:] + move[1])
                a[:, 1] += e
            forward.append(a)
        gradient = np.zeros_like(theta)
        behind = np.zeros((len(chains), 2))
        norm = np.concatenate([np.logaddexp(forward[k - 1][n:m, 0], forward[k - 1][n:m, 1]) for k, (m, n) in reversed(list(enumerate(zip(steps, [*steps[1:], 0], strict=True), 1)))])
        for t in range(len(steps) - 1, -1, -1):
            n = steps[t]
            p = np.exp(forward[t] + behind[:n] - norm[:n, None])[:, 1]
            off = y[:n] - p
            gradient[:size] += off @ table[t]
            gradient[size] += off.sum()
            if t:
                e = table[t] @ w + bias
                ahead = behind[:n] + np.stack([np.zeros(n), e], 1)
                pair = forward[t - 1][:n, :, None] + move + ahead[:, None, :]
                expected = np.exp(pair - norm[:n, None, None]).sum(0)
                seen = np.diag([(1 - y[:n]).sum(), y[:n].sum()])
                gradient[size + 1 :] += (seen - expected).ravel()
                behind[:n] = np.logaddexp(move[:, 0] + ahead[:, :1], move[:, 1] + ahead[:, 1:])
        gradient = gradient / total - RIDGE * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:size], float(theta[size]), theta[size + 1 :].reshape(2, 2))


#: Without labels of both kinds every line is content.
NEUTRAL = Model(np.zeros(len(FEATURES)), 1.0, np.zeros((2, 2)))


def train(documents: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCUMENTS) -> Model:
    """Fit on about ``sample`` labelled documents (doc_id, quality 0 or 1; others are left out)."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = max(1, -(-labels.count() // sample))
    drawn = known.where(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            m = measure(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("quality"), tk.list_array(pa.array(m.bits), m.first)], names=["quality", "bits"]
            )

    rows = documents.select("doc_id", "text").join(drawn.hint("broadcast"), "doc_id").select("text", "quality")
    held = [r for r in rows.mapInArrow(features, "quality int, bits array<int>").collect() if r["bits"]]
    held.sort(key=lambda r: (r["quality"], r["bits"]))
    if len({r["quality"] for r in held}) < 2:
        return NEUTRAL
    return fit([np.array(r["bits"], np.int32) for r in held], [r["quality"] for r in held])


def _judge(column: pa.Array, model: Model) -> dict[str, np.ndarray]:
    m = measure(column)
    emissions = model.emissions(m.bits)
    share = np.zeros(len(column))
    for k in range(len(column)):
        low, high = m.first[k], m.first[k + 1]
        if high > low:
            n = m.words[low:high]
            share[k] = n[np.array(decode(emissions[low:high].tolist(), model.move))].sum() / n.sum()
    base = m.base
    failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
    return base | {"base_failed": failed, "content_share": share, "kept": ~failed & (share >= CONTENT_SHARE)}


def judge(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, the measures, base_failed, content_share and kept, one row for each row of documents.

    A NULL text has no words, so it fails.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            out = _judge(part.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(x) for x in out.values())], names=["doc_id", *out]
            )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE)
    schema += ", base_failed boolean, content_share double, kept boolean"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judged, schema)


def keep_good(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` that are kept, with all their columns."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            yield part.filter(pa.array(_judge(part.column("text"), model)["kept"]))

    # Columns pass as they are, under names that cannot clash.
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in documents.schema])
    return documents.mapInArrow(kept, schema)


def labelled_lines(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, line (from 0, lines with a word), content, words."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            m = measure(part.column("text"))
            e = model.emissions(m.bits)
            content = [x for a, b in zip(m.first, m.first[1:], strict=False) if b > a for x in decode(e[a:b].tolist(), model.move)]
            doc = np.repeat(np.arange(part.num_rows), np.diff(m.first))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(doc)),
                    pa.array((np.arange(len(doc)) - m.first[doc]).astype(np.int32)),
                    pa.array(content, pa.bool_()),
                    pa.array(m.words.astype(np.int64)),
                ],
                names=["doc_id", "line", "content", "words"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lines, "doc_id long, line int, content boolean, words long")
