"""Line dedup over overlapping windows of three consecutive lines.

Windows found more than once keep their first place; the lines that later places cover are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.llm import textkit as tk
from feedmill.session import materialise

WINDOW = 3

_NOT_NEWLINE = tk._BYTES != 0x0A
_WINDOWS = "code_a long, code_b long, doc_id long, doc_code long, line int"


def _lines(part: pa.RecordBatch, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Codes of the lines with a word, and how many stand before each row."""
    data, offsets = tk.buffer_of(part.column(text))
    lines = tk.Words(data, offsets, _NOT_NEWLINE)
    worded = np.concatenate(([0], np.cumsum(tk.IN_WHITE_WORD[data], dtype=np.int64)))
    keep = worded[lines.end] > worded[lines.start]
    return lines.hashes()[keep], np.searchsorted(lines.doc[keep], np.arange(part.num_rows + 1))


def window_codes(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row for each window: its 128-bit code, its document (doc_id, doc_code) and its first line.

    Only lines with a word count; a text with fewer of them than a window has none.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            codes, first = _lines(part)
            code, at = tk.windows(codes, first, window)
            other, _ = tk.windows(tk.mix(codes + np.uint64(window)), first, window)
            doc = np.searchsorted(first, at, "right") - 1
            own = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(code.view(np.int64)),
                    pa.array(other.view(np.int64)),
                    part.column("doc_id").take(own),
                    part.column("doc_code").take(own),
                    pa.array((at - first[doc]).astype(np.int32)),
                ],
                names=["code_a", "code_b", "doc_id", "doc_code", "line"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _doc_code().alias("doc_code"), "text")
    return rows.mapInArrow(found, _WINDOWS)


def _doc_code():
    return F.xxhash64("text")


def later_windows(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, doc_code and ``lines``: the first lines of all windows that stand somewhere before.

    Places are ordered by doc_id (NULL last), then line.
    """
    windows = materialise(window_codes(documents, window))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "doc_code", "line")
    codes = ["code_a", "code_b"]
    repeated = windows.groupBy(*codes).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    # A window of very many documents makes one large key here; adaptive execution splits it.
    later = windows.join(repeated, codes).where(place > F.col("first"))
    return later.groupBy("doc_id", "doc_code").agg(F.collect_list("line").alias("lines"))


def uncovered(text: str, starts: list[int], window: int = WINDOW) -> tuple[str, int, int]:
    """The text without the lines that windows at ``starts`` cover; lines with a word, and removed ones.

    A line without a word goes with the line before it.
    """
    covered: set[int] = set()
    for start in starts:
        covered.update(range(start, start + window))
    kept, number = [], -1
    for line in text.split("\n"):
        number += bool(line.strip("\x20\t\n\x0b\x0c\r"))
        if max(number, 0) not in covered:
            kept.append(line)
    return "\n".join(kept), number + 1, len(covered)


def dedup_lines(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` with repeated lines removed from ``text``, and n_lines and n_removed.

    Rows that agree in doc_id and text are one document: they lose the same lines, and do not repeat
    each other.  A NULL text stays NULL.  Columns of ``documents`` keep their names and order.
    """
    marks = later_windows(documents, window).select(
        F.struct("doc_id", "doc_code").alias("_mark"), F.col("lines").alias("_starts")
    )
    own = F.struct(F.col("doc_id").cast("long"), _doc_code())
    joined = documents.join(marks, own == F.col("_mark"), "left").select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.col("text").alias("text"),
        F.col("_starts").alias("starts"),
    )

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            _, first = _lines(part)
            n_lines, removed = np.diff(first), np.zeros(part.num_rows, np.int64)
            texts = part.column("text")
            starts = part.column("starts")
            marked = np.flatnonzero(starts.is_valid().to_numpy(zero_copy_only=False))
            if len(marked):
                texts = texts.to_pylist()
                for k in marked:
                    texts[k], _, removed[k] = uncovered(texts[k], starts[int(k)].as_py(), window)
                texts = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), texts, pa.array(n_lines), pa.array(removed)],
                names=["row", "text", "n_lines", "n_removed"],
            )

    schema = T.StructType(
        [
            T.StructField("row", joined.schema["row"].dataType),
            T.StructField("text", T.StringType()),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )
    out = joined.mapInArrow(cleaned, schema)
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns]
    return out.select(*columns, *[c for c in ("n_lines", "n_removed") if c not in documents.columns])
