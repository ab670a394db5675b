"""Document fingerprints from locally consistent parsing.

Deterministic coin tossing (Cole and Vishkin, 1986; for strings Sahinalp and Vishkin, 1994, and
Mehlhorn, Sundar and Uhrig, 1997): equal neighbours are first joined to runs; a symbol is
then replaced, four times over, by the lowest bit in which it differs from its left neighbour
and that bit's value, until fewer than eight labels remain and neighbours still differ; a phrase
starts at each local maximum of the labels.  Whether it does depends on a few symbols around it
only, so equal substrings are cut alike in their interior wherever they stand.  A phrase's name is a
hash of its symbols, and names are the symbols of the next level.

A fingerprint keeps, in each of 64 bins, the least name of levels 2 and 3 that falls into it (one
permutation hashing; Li, Owen and Zhang, 2012), as 16 bits.  Likeness is the share of equal
bins among those that either fingerprint fills.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, worker
from millrace.llm.text_arrays import U, mix, powers

BINS = 64
SEGMENT = 1 << 19
LEVELS = 3
KEPT_LEVELS = (2, 3)
_EMPTY = np.uint64(2**64 - 1)
_LOW_BIT = np.array([8] + [(x & -x).bit_length() - 1 for x in range(1, 256)], dtype=np.uint8)


def _labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 (or a little more at a text's start), neighbours of a text distinct."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = symbols[first] ^ U(1)
    differ = symbols ^ left
    bit = np.bitwise_count((differ & (~differ + U(1))) - U(1))
    label = ((bit << 1) | ((symbols >> bit.astype(np.uint64)) & U(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(3):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ 1
        bit = _LOW_BIT[label ^ before]
        label = (bit << 1) | ((label >> bit) & 1)
    return label


def _runs(symbols: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs of equal symbols (new: where one begins) and a symbol for each."""
    runs = np.flatnonzero(new)
    return runs, _joined(symbols[runs], np.diff(np.append(runs, len(symbols))))


def _joined(symbols: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.where(length > 1, mix(symbols * U(0xD1342543DE82EF95) + length.astype(np.uint64)), symbols)


def _names(own: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the symbols of each phrase, wherever it stands."""
    up, down = powers(len(own) + 1)
    sums = np.zeros(len(own) + 1, dtype=np.uint64)
    np.cumsum(mix(own + U(0x632BE59BD9B4E019)) * up[: len(own)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def phrases(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of texts side by side, and the texts' offsets among them.

    Offsets are those of non-empty texts, and end with the number of symbols.
    """
    new = np.ones(len(symbols), dtype=bool)
    new[1:] = symbols[1:] != symbols[:-1]
    new[offsets[:-1]] = True
    runs, own = _runs(symbols, new)
    first = np.searchsorted(runs, offsets[:-1])
    label = _labels(own, first)
    top = np.zeros(len(own), dtype=bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    top[np.append(first[1:], len(own)) - 1] = False  # a text's last run has no right neighbour
    top[first] = True
    starts = np.flatnonzero(top)
    return _names(own, starts, np.append(starts[1:], len(own))), np.append(np.searchsorted(starts, first), len(starts))


class Parser:
    """``phrases`` of one text that comes in pieces: the same names, from a buffer that does not grow with it.

    A label depends on a run and the four before it, and a phrase's start on the labels of a run and
    its neighbours.  So the buffer begins ``CONTEXT`` runs before the phrase that is open, and a run
    waits until the next begins."""

    CONTEXT = 6

    def __init__(self):
        self.symbol, self.length = U(0), 0  # the run that may go on
        self.own = np.zeros(0, dtype=np.uint64)
        self.open = 0  # where in the buffer the open phrase starts

    def feed(self, symbols: np.ndarray, last: bool) -> np.ndarray:
        new = np.ones(len(symbols), dtype=bool)
        new[1:] = symbols[1:] != symbols[:-1]
        at = np.flatnonzero(new)
        kinds, lengths = symbols[at], np.diff(np.append(at, len(symbols)))
        if self.length and len(kinds) and kinds[0] == self.symbol:
            lengths[0] += self.length
        elif self.length:
            kinds, lengths = np.append(self.symbol, kinds), np.append(self.length, lengths)
        self.length = 0
        if len(kinds) and not last:
            self.symbol, self.length = kinds[-1], int(lengths[-1])
            kinds, lengths = kinds[:-1], lengths[:-1]
        own = self.own = np.concatenate([self.own, _joined(kinds, lengths)])
        if len(own) < 2 and not last:
            return own[:0]
        label = _labels(own, np.zeros(min(1, len(own)), dtype=np.int64))
        top = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
        starts = np.flatnonzero(top) + 1
        bounds = np.concatenate([[self.open], starts[starts > self.open], [len(own)] * (last and len(own) > 0)]).astype(np.int64)
        names = _names(own, bounds[:-1], bounds[1:])
        cut = max(0, int(bounds[-1]) - self.CONTEXT)
        self.own, self.open = own[cut:].copy(), int(bounds[-1]) - cut
        return names


def _least(least: np.ndarray, names: np.ndarray, level: int, docs: np.ndarray | int) -> None:
    if level in KEPT_LEVELS:
        tagged = mix(names + U(level))
        np.minimum.at(least, docs * BINS + (tagged >> U(58)).astype(np.int64), tagged)


def _symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)


def sketches(texts: list[str], segment: int = SEGMENT) -> np.ndarray:
    """Least names by text and bin.  Short texts are parsed side by side, longer ones than segment in pieces."""
    least = np.full(len(texts) * BINS, _EMPTY, dtype=np.uint64)
    for i, t in enumerate(texts):
        if len(t) > segment:
            parsers = [Parser() for _ in range(LEVELS)]
            for lo in range(0, len(t), segment):
                names = _symbols(t[lo : lo + segment])
                for level, parser in enumerate(parsers, 1):
                    names = parser.feed(names, lo + segment >= len(t))
                    _least(least, names, level, i)
    rest = [i for i, t in enumerate(texts) if 0 < len(t) <= segment]
    at = 0
    while at < len(rest):
        size, to = 0, at
        while to < len(rest) and (to == at or size + len(texts[rest[to]]) <= segment):
            size += len(texts[rest[to]])
            to += 1
        docs, at = np.array(rest[at:to]), to
        symbols = _symbols("".join([texts[i] for i in docs]))
        offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in docs])])
        for level in range(1, LEVELS + 1):
            symbols, offsets = phrases(symbols, offsets)
            _least(least, symbols, level, np.repeat(docs, np.diff(offsets)))
    return least.reshape(-1, BINS)


def write(least: np.ndarray) -> list[str]:
    """A fingerprint per row: four hexadecimal digits for a bin, or four dashes for an empty one."""
    digits = (mix(least.ravel()) & U(0xFFFF)).astype(">u2").tobytes().hex()
    filled = (least != _EMPTY).ravel()
    cells = np.frombuffer(digits.encode(), dtype="S4").copy()
    cells[~filled] = b"----"
    whole = cells.tobytes().decode()
    return [whole[i : i + 4 * BINS] for i in range(0, len(whole), 4 * BINS)]


def likeness(a: str, b: str) -> float:
    """Share of equal bins among those filled in either; of two empty fingerprints, 1."""
    x, y = ([f[i : i + 4] for i in range(0, len(f), 4)] for f in (a, b))
    filled = sum(p != "----" or q != "----" for p, q in zip(x, y, strict=True))
    return sum(p == q != "----" for p, q in zip(x, y, strict=True)) / filled if filled else 1.0


def _like(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    cut = lambda m: np.where(m == _EMPTY, -1, (mix(m) & U(0xFFFF)).astype(np.int64))
    x, y = cut(a), cut(b)
    filled = ((x >= 0) | (y >= 0)).sum(axis=1)
    equal = ((x == y) & (x >= 0)).sum(axis=1)
    return np.where(filled > 0, equal / np.maximum(filled, 1), 1.0)


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with a fingerprint of the whole text (null as empty); other columns pass through, a column of the
    result's name is replaced.  Rows are judged alone: repeated rows have equal fingerprints, an empty text
    one of empty bins, an empty table gives an empty result."""
    kind = docs.drop(name).withColumn(name, F.lit(""))

    def run(batches):
        for batch in batches:
            texts = [x or "" for x in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(write(sketches(texts)), pa.string())], [*batch.schema.names, name])

    return docs.drop(name).mapInArrow(worker.lean(run), kind.schema)


_KINDS = "kind int, part int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, text string"
_NAMES = [c.split()[0] for c in _KINDS.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pair_rows(ids: list, texts: list[str], own: np.ndarray, following: list[str], theirs: np.ndarray) -> list[tuple]:
    edited = [_edited(a, b) for a, b in zip(texts, following, strict=True)]
    after = sketches(edited)
    shas = [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    return list(zip(ids, map(len, texts), shas, write(own), write(after), _like(own, after).tolist(), _like(own, theirs).tolist(), strict=True))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(_TYPES), _TYPES, strict=True)], _NAMES)


def _along(batches):
    """Each row with the next of its partition; the first and the last row leave with their texts."""
    part, carry = TaskContext.get().partitionId(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
        own, out = sketches(texts), []
        if carry is None:
            out.append((1, part, ids[0], None, None, None, None, None, None, texts[0]))
        else:
            ids, texts, own = [carry[0], *ids], [carry[1], *texts], np.concatenate([carry[2], own])
        rows = _pair_rows(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:]) if len(ids) > 1 else []
        out += [(0, part, *r, None) for r in rows]
        carry = ids[-1], texts[-1], own[-1:]
        yield _batch(out)
    if carry is not None:
        yield _batch([(2, part, carry[0], None, None, None, None, None, None, carry[1])])


def _across(batches):
    for batch in batches:
        ids, texts, following = batch.column(0).to_pylist(), *([x or "" for x in batch.column(k).to_pylist()] for k in (1, 2))
        if ids:
            rows = _pair_rows(ids, texts, sketches(texts), following, sketches(following))
            yield _batch([(0, 0, *r, None) for r in rows])


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of an edit of it, with how alike they are.

    The edit replaces the last ``n_chars // 2`` code points by the first as many (or all) of the
    next text, in descending order of the id; after the last comes the first (of one row, itself).
    Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)``.  Null texts are empty.  Rows that share an id follow each other in an order
    that depends on their texts only; null ids come last.  Other columns are ignored; an empty
    table gives an empty result.

    Plan: texts are shuffled once, by range of the id, and each partition is read as a stream that
    holds one row back.  The first and last rows of partitions, two a partition, meet in a second,
    small step.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = base.withColumn("tie", F.xxhash64("text"))
    keys = [F.col("doc_id").desc_nulls_last(), F.col("tie").asc()]
    ordered = base.repartitionByRange(*keys).sortWithinPartitions(*keys, F.col("text").asc())
    done = scratch.table(ordered.select("doc_id", "text").mapInArrow(worker.lean(_along), _KINDS), "fingerprints")
    heads = done.filter("kind = 1").select(F.col("part").alias("head"), F.col("text").alias("following"))
    tails = done.filter("kind = 2").select("part", "doc_id", "text")
    # One row a partition: the next partition that has rows, or the first.
    parts = done.filter("kind = 1").select("part").selectExpr("part", "coalesce(lead(part) over (order by part), min(part) over ()) AS head")
    loose = tails.join(parts, "part").join(heads, "head").select("doc_id", "text", "following")
    whole = done.filter("kind = 0").unionByName(loose.mapInArrow(worker.lean(_across), _KINDS))
    return whole.drop("kind", "part", "text")
