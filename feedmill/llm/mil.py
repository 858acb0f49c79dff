"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages.  Every passage is encoded, gated attention weighs the encodings, and the
weighted representation is scored.  The attention is learned from document labels alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import textkit as tk

#: Labelled rows that fit the model at most, drawn by a hash of the id, and passages of such a row it learns from.
TRAIN_DOCUMENTS = 4000
TRAIN_PASSAGES = 64
#: Words of a passage.
PASSAGE = 64
#: Buckets that words fall in by a hash, beside the measures of a passage.
BUCKETS = 32
WIDTH, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4
THRESHOLD = 0.3

_B = tk._BYTES
_CAPITAL = (_B >= 65) & (_B <= 90)
_LETTER = _CAPITAL | ((_B >= 97) & (_B <= 122)) | (_B >= 0x80)
_DIGIT = (_B >= 48) & (_B <= 57)
_SYMBOL = ~_LETTER & ~_DIGIT & ~np.isin(_B, list(b".,;:!?'\"()- \t\n\x0b\x0c\r"))
_STOP = np.isin(_B, list(b".!?"))

MEASURES = (
    "a symbol", "no letter or digit", "all capitals", "capital first", "ends a sentence", "exclamation", "comma or colon",
    "a digit", "one character", "over twelve characters", "equals the word before", "equals the word before that",
    "came before in the passage", "opens a line", "symbols a character", "capitals a letter", "letters a character",
    "mean length", "log words", "no words",
)
FEATURES = len(MEASURES) + BUCKETS


class Passages(NamedTuple):
    """Measures of all passages, one after the other, and where each row's begin; a row has at least one."""

    x: np.ndarray
    first: np.ndarray


def passages(column: pa.Array, size: int = PASSAGE) -> Passages:
    data, offsets = tk.buffer_of(column)
    words = tk.Words(data, offsets, tk.IN_WHITE_WORD)
    n = np.maximum(1, -(-words.count // size))
    first = np.concatenate(([0], np.cumsum(n)))
    x = np.zeros((first[-1], FEATURES), np.float32)
    x[first[:-1][words.count == 0], len(MEASURES) - 1] = 1
    if not len(words):
        return Passages(x, first)

    def per_word(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[words.end] - total[words.start]

    codes, doc = words.hashes(), words.doc
    place = np.arange(len(words)) - words.first[doc]
    passage = first[doc] + place // size
    starts = np.flatnonzero(place % size == 0)
    chars = per_word(~tk.IS_CONTINUATION[data])
    letters, capitals, digits, symbols = (per_word(f[data]) for f in (_LETTER, _CAPITAL, _DIGIT, _SYMBOL))
    last = data[words.end - 1]

    def equals(back: int) -> np.ndarray:
        same = np.zeros(len(words), bool)
        same[back:] = (codes[back:] == codes[:-back]) & (passage[back:] == passage[:-back])
        return same

    key = codes ^ tk.mix(passage.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(words), bool)
    again[order[1:]] = key[order][1:] == key[order][:-1]
    newline = np.concatenate(([0], np.cumsum(data == 0x0A)))[words.start]
    opens = np.ones(len(words), bool)
    opens[1:] = (newline[1:] != newline[:-1]) | (doc[1:] != doc[:-1])
    flags = [
        symbols > 0, letters + digits == 0, (capitals == letters) & (letters > 1), _CAPITAL[data[words.start]], _STOP[last],
        last == 0x21, np.isin(last, list(b",;:")), digits > 0, chars == 1, chars > 12, equals(1), equals(2), again, opens,
    ]
    held = np.diff(np.append(starts, len(words)))
    rows = passage[starts]

    def summed(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.float64), starts)

    for k, flag in enumerate(flags):
        x[rows, k] = summed(flag) / held
    all_chars, all_letters = summed(chars), summed(letters)
    k = len(flags)
    x[rows, k] = summed(symbols) / all_chars
    x[rows, k + 1] = summed(capitals) / np.maximum(all_letters, 1)
    x[rows, k + 2] = all_letters / np.maximum(summed(words.end - words.start), 1)
    x[rows, k + 3] = all_chars / held
    x[rows, k + 4] = np.log1p(held)
    bucket = passage * BUCKETS + (tk.mix(codes) >> np.uint64(32)).astype(np.int64) % BUCKETS
    spread = np.bincount(bucket, minlength=len(x) * BUCKETS).reshape(len(x), BUCKETS)
    x[:, len(MEASURES) :] = spread / np.maximum(spread.sum(1, keepdims=True), 1)
    return Passages(x, first)


def start_weights(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {
        "encode": (FEATURES, WIDTH), "shift": (WIDTH,), "tanh": (WIDTH, GATE), "sigmoid": (WIDTH, GATE), "attend": (GATE,),
        "out": (WIDTH,), "bias": (1,),
    }
    return {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in ("shift", "bias") else np.zeros(s) for k, s in shapes.items()}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class _Forward(NamedTuple):
    h: np.ndarray
    t: np.ndarray
    g: np.ndarray
    weight: np.ndarray
    z: np.ndarray
    score: np.ndarray


def forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> _Forward:
    """Encodings h, gates t and g, attention of each passage in its bag, representation and score of each bag."""
    h = np.tanh(x @ w["encode"] + w["shift"])
    t, g = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["sigmoid"])
    raw = (t * g) @ w["attend"]
    bag, n = first[:-1], np.diff(first)
    e = np.exp(raw - np.repeat(np.maximum.reduceat(raw, bag), n))
    weight = e / np.repeat(np.add.reduceat(e, bag), n)
    z = np.add.reduceat(h * weight[:, None], bag)
    return _Forward(h, t, g, weight, z, _sigmoid(z @ w["out"] + w["bias"]))


def gradients(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, label: np.ndarray):
    """Mean log loss of the bags, and its gradient for every weight."""
    f = forward(w, x, first)
    n = np.diff(first)
    p = np.clip(f.score, 1e-12, 1 - 1e-12)
    loss = float(-(label * np.log(p) + (1 - label) * np.log(1 - p)).mean())
    d = (f.score - label) / len(label)
    out = {"out": f.z.T @ d, "bias": np.array([d.sum()])}
    dz = np.repeat(d[:, None] * w["out"], n, 0)
    dh = dz * f.weight[:, None]
    dweight = (dz * f.h).sum(1)
    mean = np.repeat(np.add.reduceat(dweight * f.weight, first[:-1]), n)
    draw = f.weight * (dweight - mean)
    out["attend"] = (f.t * f.g).T @ draw
    dgate = draw[:, None] * w["attend"]
    dt, dg = dgate * f.g * (1 - f.t**2), dgate * f.t * f.g * (1 - f.g)
    out["tanh"], out["sigmoid"] = f.h.T @ dt, f.h.T @ dg
    dh += dt @ w["tanh"].T + dg @ w["sigmoid"].T
    dx = dh * (1 - f.h**2)
    out["encode"], out["shift"] = x.T @ dx, dx.sum(0)
    return loss, out


class Model(NamedTuple):
    """Weights, and what measures are centred and scaled by."""

    weights: dict[str, np.ndarray]
    centre: np.ndarray
    scale: np.ndarray

    def scores(self, column: pa.Array) -> np.ndarray:
        return self.attention(column)[1].score

    def attention(self, column: pa.Array) -> tuple[np.ndarray, _Forward]:
        """Where each row's passages begin, and all that the model makes of them."""
        found = passages(column)
        return found.first, forward(self.weights, (found.x - self.centre) / self.scale, found.first)


#: Without labels of both kinds there is nothing to tell apart: every score is 0.5.
NEUTRAL = Model({k: np.zeros_like(v) for k, v in start_weights().items()}, np.zeros(FEATURES), np.ones(FEATURES))


def fit(bags: list[np.ndarray], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Adam over batches of bags, from the same start in the same order every time."""
    if len(set(labels)) < 2:
        return NEUTRAL
    every = np.concatenate(bags).astype(np.float64)
    centre, scale = every.mean(0), every.std(0)
    scale = np.where(scale < 1e-6, 1.0, scale)
    bags = [(b - centre) / scale for b in bags]
    label = np.array(labels, float)
    w = start_weights()
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    rng, step = np.random.default_rng(3), 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        rate = RATE * (1 - epoch / epochs)
        for k in range(0, len(order), BATCH):
            own = order[k : k + BATCH]
            x = np.concatenate([bags[b] for b in own])
            first = np.concatenate(([0], np.cumsum([len(bags[b]) for b in own])))
            step += 1
            for name, d in gradients(w, x, first, label[own])[1].items():
                mean[name] = 0.9 * mean[name] + 0.1 * d
                square[name] = 0.999 * square[name] + 0.001 * d * d
                m, s = mean[name] / (1 - 0.9**step), square[name] / (1 - 0.999**step)
                w[name] = w[name] - rate * (m / (np.sqrt(s) + 1e-8) + DECAY * w[name])
    return Model(w, centre, scale)


def is_held_out(doc_id) -> F.Column:
    """The fold that no label is learned from; a row without doc_id counts as id ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(documents: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCUMENTS) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out fold, drawn by a hash of the id.

    Labels other than 0 and 1, and labels without doc_id, are left out; of several labels of an id the smallest
    counts.  Of a row with more than ``TRAIN_PASSAGES`` passages it learns from as many, spread over the row.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            found = passages(part.column("text"))
            rows = []
            for a, b in zip(found.first, found.first[1:], strict=False):
                rows.append(found.x[a + np.unique(np.linspace(0, b - a - 1, TRAIN_PASSAGES).astype(int))].tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("quality"), pa.array(rows, pa.binary())], names=["doc_id", "quality", "bag"]
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id")
    made = rows.select("doc_id", "quality", "text").mapInArrow(bags, "doc_id long, quality int, bag binary")
    # Ids may repeat, so the rows are counted once more.
    held = made.orderBy(F.xxhash64("doc_id"), "doc_id", "bag").limit(sample).collect()
    return fit([np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in held], [r["quality"] for r in held])


def classify(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages and attention, one row for each row of ``documents``.

    Scores come from the text alone.  An empty or NULL text is one passage without words.  ``attention`` is the
    largest weight of a passage.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            first, found = model.attention(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("held_out"), pa.array(found.score),
                    pa.array((found.score >= threshold).astype(np.int32)), pa.array(np.diff(first)),
                    pa.array(np.maximum.reduceat(found.weight, first[:-1])),
                ],
                names=["doc_id", "held_out", "score", "predicted", "n_passages", "attention"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", is_held_out(F.col("doc_id")).alias("held_out"))
    schema = "doc_id long, held_out boolean, score double, predicted int, n_passages long, attention double"
    return rows.mapInArrow(scored, schema)
