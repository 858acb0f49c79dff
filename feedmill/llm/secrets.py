"""Secret scan: all rules in one deterministic automaton, one pass over the bytes of all texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.llm import textkit as tk
from feedmill.llm.automaton import Automaton, compile_rules

# The kinds in their order, with published token formats.
_NAME = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
RULES = {
    "assign": _NAME + "[A-Za-z0-9+/_.=-]+",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]{16,}",
    "github": "gh[oprsu]_[A-Za-z0-9]+",
    "slack": "xox[abprs]-[A-Za-z0-9-]+",
    "google": "AIza[A-Za-z0-9_-]+",
    "stripe": "[rs]k_live_[A-Za-z0-9]+",
    "jwt": "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+",
    "pem": "-----BEGIN [A-Z ]*PRIVATE KEY-----",
}
#: Shorter matches are dropped (of assign, shorter values).  Counted here and not in the rule, as counting overlapping starts multiplies states.
LEAST = {"assign": 12, "access": 18, "github": 40, "slack": 15, "google": 39, "stripe": 24, "jwt": 36}
KINDS = tuple(RULES)
_LANE_BYTES = 2048
#: Pieces of which so many or fewer are left are no longer read side by side.
_FEW_LANES = 64

_OUT = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"


class Rules:
    """The compiled rules; made once on the driver, then part of the task."""

    def __init__(self) -> None:
        self.anywhere = compile_rules(list(RULES.values()), anywhere=True)
        self.backward = compile_rules(list(RULES.values()), anywhere=True, backward=True)
        self.anchored = {kind: compile_rules([rule], anywhere=False) for kind, rule in RULES.items()}
        self.name = compile_rules([_NAME], anywhere=False)


def _lanes(data: np.ndarray, offsets: np.ndarray, resets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces no match can reach across: cut at texts, lines and, where they are long, at other resetting bytes."""
    cuts = np.unique(np.concatenate((offsets, np.flatnonzero(data == 0x0A) + 1)))
    long = np.flatnonzero(np.diff(cuts) > _LANE_BYTES)
    if len(long):
        at = np.flatnonzero(resets[data]) + 1
        more = [cuts]
        for k in long:
            own = at[np.searchsorted(at, cuts[k]) : np.searchsorted(at, cuts[k + 1])]
            wanted = np.searchsorted(own, np.arange(cuts[k] + _LANE_BYTES, cuts[k + 1], _LANE_BYTES))
            more.append(own[wanted[wanted < len(own)]])
        cuts = np.unique(np.concatenate(more))
    return cuts[:-1], cuts[1:]


def flagged(automaton: Automaton, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, end, rules) of the pieces in which a rule matches, in order."""
    # A byte resets if it leads to the start from everywhere, so nothing before it matters.
    resets = (automaton.step == 0).all(axis=0)
    start, end = _lanes(data, offsets, resets)
    order = np.argsort(start - end, kind="stable")
    begin, length = start[order], (end - start)[order]
    width = automaton.step.shape[0]
    table = automaton.step.astype(np.int32 if width * 256 < 1 << 31 else np.int64).ravel() * 256
    accept = automaton.accept[: width].astype(np.int32)
    state = np.zeros(len(begin), table.dtype)
    found = np.zeros(len(begin), np.int32)
    running = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), "right")
    together = int(np.searchsorted(-running, -_FEW_LANES, "right"))
    for k, n in enumerate(running[:together]):
        state[:n] = table[state[:n] + data[begin[:n] + k]]
        found[:n] |= accept[state[:n] >> 8]
    # What is left of a few long pieces is read one after the other.
    steps, accepted = automaton.rows()
    for x in range(int(running[together]) if together < len(running) else 0):
        now, rules = int(state[x]) >> 8, int(found[x])
        for byte in data[begin[x] + together : begin[x] + length[x]].tobytes():
            now = steps[now][byte]
            if accepted[now]:
                rules |= accepted[now]
        found[x] = rules
    for k in sorted(np.flatnonzero(found), key=lambda x: begin[x]):
        yield int(begin[k]), int(begin[k] + length[k]), int(found[k])


def spans_in(compiled: Rules, piece: bytes, rules: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, kind) by leftmost longest matches of each kind, one after the other without overlap.

    One pass from the end of the piece tells where matches begin, so that a match is read once from its own start
    and no start is tried in vain: the time grows with the piece, whatever it holds.
    """
    begins = compiled.backward.begins(piece)
    for number, kind in enumerate(KINDS):
        if not rules >> number & 1:
            continue
        done = 0
        for at, own in begins:
            if at < done or not own >> number & 1:
                continue
            done = compiled.anchored[kind].longest(piece, at)
            head = compiled.name.longest(piece, at) if kind == "assign" else at
            if done - head >= LEAST.get(kind, 0):
                yield at, done, number


def _scan(compiled: Rules, part: pa.RecordBatch) -> list[list[dict]]:
    """The spans of each row."""
    data, offsets = tk.buffer_of(part.column("text"))
    found: list[list] = [[] for _ in range(part.num_rows)]
    chars = None
    for start, end, rules in flagged(compiled.anywhere, data, offsets):
        if chars is None:
            chars = np.concatenate(([0], np.cumsum(~tk.IS_CONTINUATION[data])))
        row = int(np.searchsorted(offsets, start, "right")) - 1
        base = chars[offsets[row]]
        for s, e, number in spans_in(compiled, data[start:end].tobytes(), rules):
            found[row].append((int(chars[start + s] - base), number, int(chars[start + e] - base)))
    return [[{"kind": KINDS[n], "start": s, "end": e} for s, n, e in sorted(x)] for x in found]


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id and the spans found, by start, then kind; one row for each row of documents.

    Starts and ends count code points, ends are exclusive.  A NULL text is empty.
    """
    compiled = Rules()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for part in tk.slices(batches):
            spans = pa.array(_scan(compiled, part), kind)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), spans], names=["doc_id", "spans"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scanned, _OUT)


def redact(documents: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The rows of ``documents`` with every secret replaced; overlapping spans become one mark."""
    compiled = Rules()

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tk.slices(batches):
            place = part.schema.get_field_index("text")
            texts = part.column(place).to_pylist()
            for row, spans in enumerate(_scan(compiled, part)):
                for s, e in reversed(merged([(x["start"], x["end"]) for x in spans])):
                    texts[row] = texts[row][:s] + mark + texts[row][e:]
            yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return documents.mapInArrow(cleaned, documents.schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out
