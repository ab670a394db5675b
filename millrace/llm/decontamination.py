"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

A text's windows of an item's number of words get a SimHash (64 bits over weighted shingles;
Charikar, 2002) from a rolling sum over the text.  It is looked up in blocks of 16 bits (multi-index
hashing; Norouzi et al., 2012): each block is searched within its share of the radius, and
as the shares and the number of blocks add up to more than the radius, no item within it is missed, while
of unrelated items few come up.  Candidates within the radius are verified: the weight of
the item's shingles that stand in the window over that of all of them.

A window that holds no shingle of any item of its size cannot be verified and is not hashed; all
others are, at every place.  Items come to the tasks in blocks of bounded size, with weights
counted over all items.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import worker
from millrace.llm.text_arrays import PUNCT, U, shingles, words

_FILTER = 1 << 20
_KEY = 16  # bits of a block
_UNIT = 1 << 12  # weights are whole multiples of 1 / _UNIT, so that rolling sums are exact
_STRETCH = 2048  # windows hashed at once
_PROBES = 1 << 20  # cells looked at at once
#: Signs of the bits of a byte.
_SIGNS = np.array([[1 if x >> b & 1 else -1 for b in range(8)] for x in range(256)], dtype=np.int32)


def simhashes(hashes: np.ndarray, weights: np.ndarray, length: int) -> np.ndarray:
    """Of each run of length shingles: each bit, whether the shingles with the bit outweigh those without."""
    signs = _SIGNS[hashes.astype("<u8").view(np.uint8)].reshape(-1, 64) * weights[:, None]
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.int64)
    np.cumsum(signs, axis=0, out=sums[1:])
    return np.packbits(sums[length:] > sums[:-length], axis=1, bitorder="little").view("<u8").ravel()


def shares(radius: int) -> list[int]:
    """Bits within which each block is searched: prints within the radius lie within one of them."""
    blocks = 64 // _KEY
    return [(radius + 1 + b) // blocks - 1 for b in range(blocks)]


def flips(within: int) -> np.ndarray:
    """All keys of at most so many bits."""
    keys = np.arange(1 << _KEY, dtype=np.uint16)
    return keys[np.bitwise_count(keys) <= within] if within >= 0 else keys[:0]


class Cells(NamedTuple):
    """Of one block of bits: items by key."""

    shift: int
    start: np.ndarray
    count: np.ndarray
    items: np.ndarray


def _cells(prints: np.ndarray) -> list[Cells]:
    out = []
    for shift in range(0, 64, _KEY):
        keys = (prints >> U(shift)).astype(np.uint16)
        count = np.bincount(keys, minlength=1 << _KEY).astype(np.int32)
        out.append(Cells(shift, (np.cumsum(count) - count).astype(np.int32), count, np.argsort(keys, kind="stable")))
    return out


def within_radius(prints: np.ndarray, cells: list[Cells], item_prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All (index of a print, item) whose prints differ in at most radius bits, in order."""
    out = [np.zeros(0, dtype=np.int64)]
    n = len(item_prints)
    for c, share in zip(cells, shares(radius), strict=True):
        near = flips(share)
        keys = (prints >> U(c.shift)).astype(np.uint16)
        step = max(1, _PROBES // max(1, len(near)))
        for lo in range(0, len(keys), step):
            probe = keys[lo : lo + step, None] ^ near
            many = c.count[probe]
            at = np.nonzero(many)
            many, begin = many[at].astype(np.int64), c.start[probe[at]]
            items = c.items[np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
            which = np.repeat(at[0] + lo, many)
            ok = np.bitwise_count(prints[which] ^ item_prints[items]) <= radius
            out.append(which[ok] * n + items[ok])
    pairs = np.unique(np.concatenate(out))
    return pairs // max(n, 1), pairs % max(n, 1)


class Index(NamedTuple):
    """One block of items."""

    ids: list[int]
    sizes: np.ndarray  # words of each item
    shingles: list[np.ndarray]  # distinct, sorted
    width: np.ndarray  # words of an item's shingles
    prints: np.ndarray
    common: np.ndarray  # distinct hashes and their weights
    weight: np.ndarray
    first: np.ndarray  # of each such hash: where its numbers of words begin in lengths
    lengths: np.ndarray  # numbers of words of the items that have the hash
    top: int  # weight of a shingle that no item has, or one alone
    shared: np.ndarray | None  # with more blocks: hashes that several items of any block have, and their weights
    shared_weight: np.ndarray | None
    seen: np.ndarray
    cells: list[Cells]


class Counts(NamedTuple):
    """Of all items, where one block does not hold them."""

    items: int  # with words
    shared: np.ndarray  # hashes that two items or more have, sorted
    df: np.ndarray


def _with_words(column: pa.Array, width: int):
    """(row, number of words, shingles) of each text that has words."""
    for first, h, at, _, _ in words(column, PUNCT):
        for i in range(len(at) - 1):
            own = h[at[i] : at[i + 1]]
            if len(own):
                yield first + i, len(own), shingles(own, width)


def _weight(items: int, df: np.ndarray) -> np.ndarray:
    return np.rint(np.log1p(items / np.maximum(df, 1)) * _UNIT).astype(np.int32)


def _known(sorted_hashes: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of h are among the sorted hashes, and where."""
    at = np.searchsorted(sorted_hashes, h)
    ok = at < len(sorted_hashes)
    ok[ok] = sorted_hashes[at[ok]] == h[ok]
    return ok, at[ok]


def build_index(items: list[tuple[int, str]], radius: int, width: int = 5, counts: Counts | None = None) -> Index:
    """Items without words are left out.  Weights follow the counts; without them, these items are all."""
    rows = [(items[row][0], n, own) for row, n, own in _with_words(pa.array([t or "" for _, t in items], pa.string()), width)]
    ids, sizes, parts = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.int64), [r[2] for r in rows]
    distinct = [np.unique(p) for p in parts]
    flat = np.concatenate([*distinct, np.zeros(0, np.uint64)])
    common, df = np.unique(flat, return_counts=True)
    total = len(rows)
    if counts:
        total, df = counts.items, np.ones(len(common), dtype=np.int64)
        ok, at = _known(counts.shared, common)
        df[ok] = counts.df[at]
    weight = _weight(total, df)
    prints = np.array([simhashes(p, weight[np.searchsorted(common, p)], len(p))[0] for p in parts], dtype=np.uint64)
    pairs = np.unique(np.stack([np.searchsorted(common, flat), np.repeat(sizes, [len(d) for d in distinct])], axis=1), axis=0)
    first = np.searchsorted(pairs[:, 0], np.arange(len(common) + 1))
    seen = np.zeros(_FILTER, dtype=bool)
    seen[(common & U(_FILTER - 1)).astype(np.int64)] = True
    top = int(_weight(total, np.ones(1))[0])
    return Index(ids, sizes, distinct, np.minimum(sizes, width), prints, common, weight, first, pairs[:, 1], top, counts.shared if counts else None, _weight(total, counts.df) if counts else None, seen, _cells(prints))


def _windows(index: Index, at: np.ndarray, which: np.ndarray, k: int, width: int, n_runs: int):
    """(words of a window, first and last start) for stretches of windows that hold a shingle of an item of their size."""
    many = index.first[which + 1] - index.first[which]
    size = index.lengths[np.repeat(index.first[which] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
    at = np.repeat(at, many)
    for n in np.unique(size).tolist():
        if min(n, width) != k:
            continue
        own = at[size == n]
        last = max(0, n_runs - (n - k + 1))  # a text shorter than the item is one window
        lo, hi = np.clip(own - (n - k), 0, last), np.minimum(own, last)
        head = np.flatnonzero(np.append(True, lo[1:] > hi[:-1] + 1))
        for a, b in zip(lo[head].tolist(), hi[np.append(head[1:], len(hi)) - 1].tolist(), strict=True):
            for s in range(a, b + 1, _STRETCH):
                yield n, s, min(b, s + _STRETCH - 1)


def _find(index: Index, own: np.ndarray, width: int, radius: int, least: float) -> list[tuple[int, int, int, float]]:
    """(item, first word, distance, similarity) of the best window for each item in a text."""
    best: dict[int, tuple[int, int, float]] = {}
    for k in np.unique(index.width).tolist():
        if len(own) < k:
            continue
        runs = shingles(own, k)
        maybe = np.flatnonzero(index.seen[(runs & U(_FILTER - 1)).astype(np.int64)])
        ok, which = _known(index.common, runs[maybe])
        maybe = maybe[ok]
        if not len(maybe):
            continue
        weight = np.full(len(runs), index.top, dtype=np.int32)
        if index.shared is not None:  # what items of other blocks share weighs less as well
            ok, at = _known(index.shared, runs)
            weight[ok] = index.shared_weight[at]
        weight[maybe] = index.weight[which]
        for n, lo, hi in _windows(index, maybe, which, k, width, len(runs)):
            m = min(n - k + 1, len(runs))
            prints = simhashes(runs[lo : hi + m], weight[lo : hi + m], m)
            windows, items = within_radius(prints, index.cells, index.prints, radius)
            fit = index.sizes[items] == n
            for w, c in zip(windows[fit].tolist(), items[fit].tolist(), strict=True):
                theirs, s = index.shingles[c], lo + w
                mass = index.weight[np.searchsorted(index.common, theirs)]
                similarity = float(mass[np.isin(theirs, runs[s : s + m])].sum() / mass.sum())
                if similarity >= least and similarity > best.get(c, (0, 0, 0.0))[2]:
                    best[c] = (s, int(prints[w] ^ index.prints[c]).bit_count(), similarity)
    return [(c, *v) for c, v in best.items()]


def _hits(index: Index, width: int, radius: int, least: float, text_at: int):
    def each(batch):
        for first, h, at, _, _ in words(batch.column(text_at), PUNCT):
            for i in range(len(at) - 1):
                found = _find(index, h[at[i] : at[i + 1]], width, radius, least)
                if found:
                    yield first + i, found

    return each


def _counts(items: DataFrame, width: int) -> Counts:
    """One grouped table of shingle hashes; null stands for an item with words."""

    def run(batches):
        for batch in batches:
            for _, _, own in _with_words(batch.column(0), width):
                h = np.unique(own).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(h), pa.nulls(1, pa.int64())])], ["h"])

    df = items.select("t").mapInArrow(worker.lean(run), "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    got = df.filter("n > 1 OR h IS NULL").toArrow()
    null = got.column("h").is_null().to_numpy()
    h, n = got.column("h").fill_null(0).to_numpy()[~null].view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(h)
    return Counts(int(n[null].sum()), h[order], n[~null][order])


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, radius: int, width: int, block_bytes: int):
    """The items in as many blocks as their size asks for; each is fetched alone, and weighs by counts of all."""
    items = benchmark.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).filter("i IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    counts = _counts(items, width) if blocks > 1 else None
    for b in range(blocks):
        own = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b)
        index = build_index([(r.i, r.t) for r in own.orderBy("i").collect()], radius, width, counts)
        if index.ids:
            yield index


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", radius: int = 17, least: float = 0.8, width: int = 5, block_bytes: int = 8 << 20) -> DataFrame:
    """``(doc_id, item_id, first_word, n_words, distance, similarity)``: the best window for each
    item in each text that holds one.

    Words are lower-cased (A-Z) and end at ASCII marks and blanks.  Shingles are of ``width`` words
    (an item of fewer words: all of them).  Weights fall with the number of items of the whole
    benchmark that have a shingle; with more than one block, each holds the hashes that several items share.  Null texts and items hold nothing, items with a null id are left out, items
    without words match nothing.  Rows are judged alone, so repeated rows give repeated hits
    and no key can be hot.  Other columns are ignored.  A column of docs or benchmark that is named as
    one of the result is of no consequence, and an empty table gives an empty result.  The corpus is
    read once a block; a block's index leaves the driver's memory once its pass is planned.

    A match is lost only if its print lies farther than the radius; the tests and the README
    have the measured share.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = "doc_id long, item_id long, first_word long, n_words long, distance int, similarity double"
    names = [c.split()[0] for c in kind.split(", ")]
    types = [pa.int64()] * 4 + [pa.int32(), pa.float64()]
    out = docs.sparkSession.createDataFrame([], kind)
    for index in _blocks(benchmark, item_col, item_text_col, radius, width, block_bytes):
        each = _hits(index, width, radius, least, 1)

        def run(batches, index=index, each=each):
            for batch in batches:
                ids = batch.column(0)
                rows = [(ids[row].as_py(), index.ids[c], s, int(index.sizes[c]), d, x) for row, found in each(batch) for c, s, d, x in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, types, strict=True)], names)

        out = out.unionByName(base.mapInArrow(worker.lean(run), kind))
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", radius: int = 17, least: float = 0.8, width: int = 5, block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` without the rows that ``contaminated`` would name; columns pass through, and rows with
    null texts or ids, repeated rows and empty tables are treated as there."""
    for index in _blocks(benchmark, item_col, item_text_col, radius, width, block_bytes):
        each = _hits(index, width, radius, least, docs.columns.index(text_col))

        def run(batches, each=each):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[row for row, _ in each(batch)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(worker.lean(run), docs.schema)
    return docs
