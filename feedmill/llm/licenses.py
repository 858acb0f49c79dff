"""License scan: winnowed fingerprints pick candidates, banded alignment measures them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import textkit as tk
from feedmill.llm.license_texts import TEMPLATES

#: Words of a fingerprint, and fingerprints of which the smallest is kept: runs of 5 equal words are never missed.
GRAM, WINNOW = 3, 3
#: Words by which an alignment may drift from its diagonal.
BAND = 8
#: A template is reported when this share of its words is matched.
COVERAGE = 0.8
MATCH, MISS, GAP = 2, -1, -1

_OUT = "doc_id long, matches array<struct<license:string,coverage:double,start:int,end:int>>"


def winnowed(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and their places: of every window of grams the smallest, with all ties; whole rows when shorter."""
    code, at = tk.windows(codes, first, GRAM)
    if not len(code):
        return code, at
    doc = np.searchsorted(first, at, "right") - 1
    n = len(code)
    chosen = np.zeros(n, bool)
    whole = np.ones(n, bool)
    for begin in range(n > 0 and WINNOW):  # windows that start at place p - begin
        low = np.full(n, np.uint64(2**64 - 1))
        inside = np.ones(n, bool)
        for k in range(WINNOW):
            shift = k - begin
            other = np.arange(n) + shift
            fits = (other >= 0) & (other < n)
            other = np.clip(other, 0, n - 1)
            fits &= doc[other] == doc
            inside &= fits
            low = np.minimum(low, np.where(fits, code[other], low))
        chosen |= inside & (code <= low)
        whole &= ~inside
    chosen |= whole
    return code[chosen], at[chosen]


class Index:
    """Word codes of the templates, and for each fingerprint where it stands in which of them."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = sorted(templates)
        column = pa.array([templates[n] for n in self.names], pa.string())
        words = tk.Words(*tk.buffer_of(column), tk.IN_ALNUM_WORD, lower=True)
        codes = words.hashes()
        self.codes = [codes[a:b] for a, b in zip(words.first, words.first[1:], strict=False)]
        postings = defaultdict(list)
        for code, at in zip(*winnowed(codes, words.first), strict=True):
            k = int(np.searchsorted(words.first, at, "right")) - 1
            postings[int(code)].append((k, int(at - words.first[k])))
        self.postings = dict(postings)
        self.known = np.array(sorted(self.postings), np.uint64)


def align(template: np.ndarray, text: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """Matched words, and first and last + 1 word in ``text``, of the best local alignment near a diagonal.

    Cell (i, j) of the band pairs template word i with text word i + diagonal + j - band.
    """
    m, width = len(template), 2 * band + 1
    ramp = np.arange(width)
    before = np.zeros(width, np.int64)
    table = np.zeros((m + 1, width), np.int64)
    hits = np.zeros((m + 1, width), bool)
    for i in range(m):
        at = i + diagonal + ramp - band
        fits = (at >= 0) & (at < len(text))
        same = fits & (text[np.clip(at, 0, max(len(text) - 1, 0))] == template[i])
        row = before + np.where(same, MATCH, MISS)
        row[:-1] = np.maximum(row[:-1], before[1:] + GAP)
        row = np.where(fits, np.maximum(row, 0), 0)
        row = np.maximum.accumulate(row - GAP * ramp) + GAP * ramp
        row = np.where(fits, np.maximum(row, 0), 0)
        table[i + 1], hits[i + 1], before = row, same, row
    i, j = np.unravel_index(np.argmax(table), table.shape)
    last, first, matched = None, None, 0
    while i > 0 and table[i, j] > 0:
        value = table[i, j]
        if hits[i, j] and value == table[i - 1, j] + MATCH:
            place = i - 1 + diagonal + j - band
            first, last = place, place if last is None else last
            matched, i = matched + 1, i - 1
        elif j + 1 < width and value == table[i - 1, j + 1] + GAP:
            i, j = i - 1, j + 1
        elif j and value == table[i, j - 1] + GAP:
            j -= 1
        else:
            i -= 1
    return (matched, int(first), int(last) + 1) if matched else (0, 0, 0)


def matches_in(index: Index, codes: np.ndarray, hits: list[tuple[int, int]], coverage: float) -> list[tuple]:
    """(license, coverage, first word, last word + 1); of overlapping matches the one with more matched words."""
    found = []
    by_template = defaultdict(set)
    for code, at in hits:
        for k, place in index.postings[code]:
            by_template[k].add(at - place)
    for k, diagonals in by_template.items():
        done = None
        for d in sorted(diagonals):
            if done is not None and d <= done + BAND:
                continue  # inside the band of the last alignment
            done = d
            matched, start, end = align(index.codes[k], codes, d + BAND // 2)
            if matched and matched >= coverage * len(index.codes[k]):
                found.append((matched, index.names[k], matched / len(index.codes[k]), start, end))
    found.sort(key=lambda x: (-x[0], -x[2], x[3], x[1]))
    kept: list[tuple] = []
    for _, name, share, start, end in found:
        if all(end <= s or e <= start for _, _, s, e in kept):
            kept.append((name, share, start, end))
    return sorted(kept, key=lambda x: (x[2], x[0]))


def find_licenses(
    documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE
) -> DataFrame:
    """doc_id and the licenses found with matched coverage and span, one row for each row of documents.

    Starts and ends count code points, ends are exclusive.  A NULL text has no words.
    """
    index = Index(templates)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct(
            [("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]
        )
        for part in tk.slices(batches):
            data, offsets = tk.buffer_of(part.column("text"))
            words = tk.Words(data, offsets, tk.IN_ALNUM_WORD, lower=True)
            codes = words.hashes()
            prints, at = winnowed(codes, words.first)
            known = np.isin(prints, index.known)
            prints, at = prints[known], at[known]
            doc = np.searchsorted(words.first, at, "right") - 1
            out: list[list] = [[] for _ in range(part.num_rows)]
            chars = np.concatenate(([0], np.cumsum(~tk.IS_CONTINUATION[data]))) if len(at) else None
            for k in np.unique(doc):
                own = doc == k
                low, high = words.first[k], words.first[k + 1]
                hits = [(int(c), int(p - low)) for c, p in zip(prints[own], at[own], strict=True)]
                base = chars[offsets[k]]
                for name, share, start, end in matches_in(index, codes[low:high], hits, coverage):
                    span = [int(chars[x] - base) for x in (words.start[low + start], words.end[low + end - 1])]
                    out[k].append({"license": name, "coverage": round(share, 4), "start": span[0], "end": span[1]})
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(out, pa.list_(kind))], names=["doc_id", "matches"]
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scanned, _OUT)
