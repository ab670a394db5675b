"""Packing by non-negative least squares over the histogram of piece lengths.

After Krell et al., "Efficient Sequence Packing without Cross-contamination" (2021): enumerate
combinations of at most three lengths that fill a window exactly, find repeat counts x >= 0 that
minimise the squared difference between A x and the histogram, round them to the nearest number that the pieces allow, and pack what
is left greedily.  A sequence is padded to the full window unless its length is a power of two,
so every power of two up to the window is a window to fill; long windows come first.

A document of T tokens is cut into full windows and one remainder; only lengths matter to the
plan, so the driver holds a histogram of at most ``window`` numbers and a plan whose size
is bounded by the lengths too.  Documents meet their place by rank among the pieces of their length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, word_bpe, worker


def combinations(present: np.ndarray, window: int, partners: int = 12, least: int = 64) -> list[tuple[int, ...]]:
    """Combinations of 2 or 3 present lengths whose sum is a power of two from least to window.

    All pairs; for triples, each length with up to ``partners`` second lengths spread evenly over
    those that leave a present third.
    """
    has = np.zeros(window + 1, dtype=bool)
    has[present] = True
    out = set()
    w = window
    while w >= least:
        low = present[present < w]
        for a in low[has[w - low]].tolist():
            if a <= w - a:
                out.add((w - a, a))
        for a in low.tolist():
            b = low[(low <= a) & (low < w - a)]
            c = w - a - b
            good = b[(c <= b) & has[c]]
            for k in good[np.linspace(0, len(good) - 1, min(partners, len(good))).astype(int)].tolist():
                out.add((a, k, w - a - k))
        w //= 2
    return sorted(out, key=lambda x: (-sum(x), x))


def repeat_counts(columns: list[tuple[int, ...]], target: np.ndarray, sweeps: int = 25) -> np.ndarray:
    """Non-negative least squares by cyclic coordinate descent: min |A x - target|, x >= 0.

    A column has a 1 for each use of a length, so a step costs at most three look-ups.
    """
    rest = target.astype(float).tolist()
    x = [0.0] * len(columns)
    parts = []
    for c in columns:
        need: dict[int, int] = {}
        for v in c:
            need[v] = need.get(v, 0) + 1
        parts.append((list(need.items()), sum(k * k for k in need.values())))
    for _ in range(sweeps):
        moved = 0.0
        for j, (need, norm) in enumerate(parts):
            slope = sum(k * rest[v] for v, k in need) / norm
            if slope < -x[j]:
                slope = -x[j]
            if slope:
                x[j] += slope
                for v, k in need:
                    rest[v] -= k * slope
                moved = max(moved, abs(slope))
        if moved < 0.25:
            break
    return np.array(x)


def plan(histogram: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of the pieces of a sequence, number of such sequences), all pieces used up."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], times: int) -> None:
        out.append((lengths, times))
        for v in lengths:
            left[v] -= times

    for w in (1 << k for k in range(window.bit_length())):
        if w <= window and left[w]:
            take((w,), int(left[w]))
    columns = combinations(np.flatnonzero(left), window)
    for lengths, x in zip(columns, repeat_counts(columns, left), strict=True):
        times = int(x + 0.5)
        for v in set(lengths):
            times = min(times, int(left[v]) // lengths.count(v))
        if times > 0:
            take(lengths, times)
    # What is left: best fit, the longest first, many equal sequences at a time.
    lengths = np.flatnonzero(left).tolist()
    while lengths:
        first = lengths[-1]
        mine, room = [first], window - first
        used = {first: 1}
        for v in reversed(lengths):
            while v <= room and left[v] > used.get(v, 0):
                mine.append(v)
                used[v] = used.get(v, 0) + 1
                room -= v
        times = min(int(left[v]) // k for v, k in used.items())
        take(tuple(mine), times)
        lengths = [v for v in lengths if left[v]]
    return out


def slots(planned: list[tuple[tuple[int, ...], int]], window: int) -> dict[str, np.ndarray]:
    """For each (length, first rank) in order: the sequence of that rank and the offset in it."""
    next_rank = [0] * (window + 1)
    rows, seq = [], 0
    for lengths, times in planned:
        offset = 0
        place: dict[int, list[int]] = {}
        for v in lengths:
            place.setdefault(v, []).append(offset)
            offset += v
        for v, offsets in place.items():
            for o in offsets:
                rows.append((v, next_rank[v], seq, o))
                next_rank[v] += times
        seq += times
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {"key": (cols[:, 0] << 48) | cols[:, 1], "rank": cols[:, 1], "seq": cols[:, 2], "offset": cols[:, 3]}


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, rank long"


def _cut(path: str, window: int, end_id: int):
    def run(batches):
        bpe, part = word_bpe.load(path), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        tail = np.array([end_id], dtype=np.uint32).tobytes()
        for batch in batches:
            docs = batch.column(0).to_pylist()
            rows = []
            for first, ids, at in bpe.encode(batch.column(1)):
                for i in range(len(at) - 1):
                    own = ids[at[i] : at[i + 1]]
                    total = len(own) + 1
                    for lo in range(0, total, window):
                        n = min(window, total - lo)
                        crc = zlib.crc32(np.ascontiguousarray(own[lo : lo + n]))
                        if lo + n == total:
                            crc = zlib.crc32(tail, crc)
                        rows.append((docs[first + i], lo, n, crc, total, part, int(seen[n])))
                        seen[n] += 1
            names = [c.split()[0] for c in _PIECES.split(", ")]
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def _place(table: dict[str, np.ndarray]):
    def run(batches):
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (2, 5))
            k = np.searchsorted(table["key"], (length << 48) | rank, side="right") - 1
            out = [batch.column(j) for j in range(5)]
            out += [pa.array(table["seq"][k] + rank - table["rank"][k]), pa.array(table["offset"][k])]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all documents and the sequences they fill.

    Returns ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, all long: the
    ids of a document (those of ``tokenizer``, a word-end BPE file, then ``end_id``) from start, put
    at offset in the sequence.  Offsets of a sequence leave no gap.  A null or empty text is the
    one id ``end_id``.  Rows are packed as they come: repeated rows and ids are packed again, null
    ids stay null, an empty table gives no pieces.  Other columns are ignored.

    Plan: one pass tokenises and writes the pieces (numbers only) with their rank among equal
    lengths of their partition; partitions' counts are summed in a window over (length,
    partition), a table without texts; the plan is looked up in sorted arrays.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = scratch.table(base.mapInArrow(worker.lean(_cut(tokenizer, window, end_id)), _PIECES), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most window rows
    before = counts.select("part", "length", F.expr("sum(n) over (partition by length order by part) - n").alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rank") + F.col("before")).alias("rank"))
    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranked.mapInArrow(worker.lean(_place(slots(plan(histogram, window), window))), kind)
