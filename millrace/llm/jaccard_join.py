"""N-gram Jaccard join: blocks of a sparse document by n-gram product, exact for every pair.

1. One pass hashes each text's n-grams and reduces the set to a 128-bit key; texts with equal
   sets are one class from there on, so groups of copies cost one row each.
2. A linked text shares at least ``ceil(t * n)`` of its n n-grams with *some* other class.
   A quarter of the hash range is enough to refute that for nearly every text: the n-grams in
   the quarter that no other class has may not be more than ``n - ceil(t * n)``.  Only those
   hashes are shuffled (packed, at most two per n-gram and packet), and a common n-gram costs a
   reducer two entries a packet, not its frequency.
3. Texts that remain send all their n-grams.  Rarest first, ``n - ceil(t * n) + 1`` of them
   must hold one that a linked text shares (prefix filtering; Chaudhuri et al., ICDE 2006;
   Bayardo et al., WWW 2007).  Components over that prefix incidence are the blocks of the product.
   A component of more than ``most_tiles`` tiles, as chance may grow one in a large corpus, is
   taken apart again: its blocks are the postings of the prefix, each the texts of one n-gram.
4. A block is multiplied by its transpose in one task: postings add up overlap counts row by
   row, and pairs below the bound from their sizes are discarded.  A block of more than ``tile``
   texts is split, and each pair of its tiles is a task.
5. Links (a forest per task) are joined to components.

The number of tile pairs of one block grows with the square of its *different* texts over
``tile``; copies never count, and most components are small.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, worker
from millrace.llm.graph import connected_components
from millrace.llm.text_arrays import WHITE, U, mix, shingles, words

_QUARTER = U(3)
_STEP = 1 << 21
_HELD = 1 << 19


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, int, int]]:
    """(row, sorted distinct hashes, key, second key) of each text."""
    for first, hashes, at, _, _ in words(batch.column(1), WHITE):
        for i in range(len(at) - 1):
            own = np.unique(shingles(hashes[at[i] : at[i + 1]], width))
            other = mix(own ^ U(0x5851F42D4C957F2D))
            key = int(own.sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 + len(own)
            yield first + i, own, key & (2**64 - 1), int(np.bitwise_xor.reduce(other)) if len(own) else 0


def _signed(x: list[int]) -> pa.Array:
    return pa.array(np.array(x, dtype=np.uint64).view(np.int64))


def _sizes(width: int):
    def run(batches):
        for batch in batches:
            n, sub, k1, k2 = [], [], [], []
            for _, own, a, b in _sets(batch, width):
                n.append(len(own))
                sub.append(int(np.count_nonzero((own & _QUARTER) == 0)))
                k1.append(a)
                k2.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(sub, pa.int64()), _signed(k1), _signed(k2)], ["doc_id", "text_hash", "n", "sub", "k1", "k2"])

    return run


def _grouped(h: np.ndarray, cls: np.ndarray, flag: np.ndarray):
    """Distinct (hash, class), the flagged first; for each, its place among its hash's classes and whether there are more."""
    order = np.lexsort((~flag, cls, h))
    h, cls, flag = h[order], cls[order], flag[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])
    h, cls, flag = h[new], cls[new], flag[new]
    head = np.ones(len(h), dtype=bool)
    head[1:] = h[1:] != h[:-1]
    group = np.cumsum(head) - 1
    rank = np.arange(len(h)) - np.flatnonzero(head)[group]
    return h, cls, flag, rank, np.bincount(group)[group] > 1 if len(h) else head


def _tally(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(cls, return_counts=True)


def _entries(width: int, buckets: int):
    schema = pa.schema([("p", pa.int32()), ("h", pa.binary()), ("cls", pa.binary()), ("flag", pa.binary()), ("done", pa.binary()), ("count", pa.binary())])

    def flush(hs: list[np.ndarray], cs: list[np.ndarray], number: int) -> Iterator[pa.RecordBatch]:
        h, cls = np.concatenate(hs), np.concatenate(cs)
        h, cls, _, rank, shared = _grouped(h, cls, np.zeros(len(h), dtype=bool))
        done, count = _tally(cls[shared])
        send = rank < 2
        h, cls, shared = h[send], cls[send], shared[send]
        p = (mix(h) % U(buckets)).astype(np.int32)
        order = np.argsort(p, kind="stable")
        h, cls, shared, p = h[order], cls[order], shared[order], p[order]
        kinds, first = np.unique(p, return_index=True)
        cuts = [*first.tolist(), len(p)]
        rows = [(b, h[x:y].tobytes(), cls[x:y].tobytes(), shared[x:y].tobytes(), b"", b"") for b, x, y in zip(kinds.tolist(), cuts[:-1], cuts[1:], strict=True)]
        if len(done):
            rows.append(((number * 7919 + int(done[0] % U(buckets))) % buckets, b"", b"", b"", done.tobytes(), count.astype(np.int64).tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches):
        number, hs, cs, held = 0, [], [], 0
        for batch in batches:
            for _, own, key, _ in _sets(batch, width):
                part = own[(own & _QUARTER) == 0]
                hs.append(part)
                cs.append(np.full(len(part), key, dtype=np.uint64))
                held += len(part)
                if held >= _HELD:
                    yield from flush(hs, cs, number)
                    number, hs, cs, held = number + 1, [], [], 0
        if hs:
            yield from flush(hs, cs, number)

    return run


def _blob(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _shared(buckets: int):
    """Of one bucket: how many of its n-grams each class shares with another, packed by class."""

    def run(table: pa.Table) -> pa.Table:
        h, cls, flag, _, more = _grouped(_blob(table, "h", np.uint64), _blob(table, "cls", np.uint64), _blob(table, "flag", bool))
        own, n = _tally(cls[more & ~flag])
        cls = np.concatenate([own, _blob(table, "done", np.uint64)])
        count = np.concatenate([n.astype(np.int64), _blob(table, "count", np.int64)])
        q = (mix(cls) % U(buckets)).astype(np.int32)
        order = np.argsort(q, kind="stable")
        cls, count, q = cls[order], count[order], q[order]
        kinds, first = np.unique(q, return_index=True)
        cuts = [*first.tolist(), len(q)]
        cells = [(cls[a:b].tobytes(), count[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table({"q": pa.array(kinds, pa.int32()), "cls": pa.array([c for c, _ in cells], pa.binary()), "cnt": pa.array([c for _, c in cells], pa.binary())})

    return run


def _summed(table: pa.Table) -> pa.Table:
    cls, at = np.unique(_blob(table, "cls", np.uint64), return_inverse=True)
    count = np.zeros(len(cls), dtype=np.int64)
    np.add.at(count, at, _blob(table, "cnt", np.int64))
    return pa.table({"cls": cls.view(np.int64), "cnt": count})


def _full(width: int):
    def run(batches):
        for batch in batches:
            rows = [(own.view(np.int64), key) for _, own, key, _ in _sets(batch, width)]
            for lo in range(0, len(rows), 500):
                part = rows[lo : lo + 500]
                lists = pa.ListArray.from_arrays(np.cumsum([0] + [len(x[0]) for x in part]).astype(np.int32), pa.array(np.concatenate([x[0] for x in part])))
                yield pa.RecordBatch.from_arrays([_signed([x[1] for x in part]), lists], ["node", "hs"])

    return run


def block_links(ids: list[int], sides: list[int], sets: list[np.ndarray], num: int, den: int, cross: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links in a block: one product of the block and its transpose.

    With cross, only pairs of different sides are compared (side 0 with side 1).
    """
    size = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.lexsort((ids, size))
    ids, sides, sets, size = [ids[i] for i in order], np.array([sides[i] for i in order]), [sets[i] for i in order], size[order]
    flat = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), size)
    by = np.argsort(flat, kind="stable")
    flat, post = flat[by], doc[by]  # postings of an n-gram: ascending documents, hence sizes
    head = np.ones(len(flat), dtype=bool)
    head[1:] = flat[1:] != flat[:-1]
    starts = np.flatnonzero(head)
    term = np.cumsum(head) - 1
    freq = np.diff(np.append(starts, len(flat)))
    rows = np.empty(len(flat), dtype=np.int64)
    rows[by] = term
    edges = np.concatenate([[0], np.cumsum(size)])
    tree = np.arange(len(sets))  # the tree of the forest that each text is in
    links = []
    for i in range(1, len(sets)):
        own = rows[edges[i] : edges[i + 1]]
        own = own[freq[own] > 1]
        lo = int(np.searchsorted(size[:i], -(-num * size[i] // den)))  # smaller sets cannot reach the bound
        if lo >= i or len(own) * den < num * size[i]:
            continue
        many = freq[own]
        upto = np.cumsum(many)
        count, done = np.zeros(i - lo, dtype=np.int64), 0
        while done < len(own):  # a row of the product in bounded steps
            to = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + _STEP)))
            part = many[done:to]
            at = np.repeat(starts[own[done:to]] - (np.cumsum(part) - part), part) + np.arange(int(part.sum()))
            count += np.bincount(post[at], minlength=i)[lo:i]
            done = to
        fit = np.flatnonzero(den * count >= num * (size[i] + size[lo:i] - count)) + lo
        if cross:
            fit = fit[sides[fit] != sides[i]]
        other, at = np.unique(tree[fit], return_index=True)
        for b, j in zip(other.tolist(), fit[at].tolist(), strict=True):
            if b != tree[i]:
                tree[tree == b] = tree[i]
                links.append((ids[i], ids[j]))
    return links


def _products(num: int, den: int):
    """Rows come sorted by (component, n-gram or 0, a, b): each run of equal keys is one product."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        key, ids, sides, sets = None, [], [], []

        def close():
            if len(ids) > 1:
                links = block_links(ids, sides, sets, num, den, key[2] != key[3])
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], schema=schema)

        for batch in batches:
            own = batch.column(6)
            values, offsets = own.values.to_numpy(zero_copy_only=False).view(np.uint64), own.offsets.to_numpy()
            for i, row in enumerate(zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True)):
                if row[:4] != key:
                    yield from close()
                    key, ids, sides, sets = row[:4], [], [], []
                ids.append(row[4])
                sides.append(row[5])
                sets.append(values[offsets[i] : offsets[i + 1]].copy())
        yield from close()

    return run


def _components(base: DataFrame, sized: DataFrame, width: int, num: int, den: int, tile: int, most_tiles: int) -> DataFrame:
    """``(k1, k2, class_id, component, component_id)`` of each class of texts with equal sets; k1 names it in all steps between."""
    keys = ["k1", "k2"]
    classes = sized.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*keys).agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("sub").alias("sub"))
    total = sized.agg(F.sum("sub")).first()[0] or 0
    buckets = max(12, math.ceil(total / 400_000))
    cells = base.mapInArrow(worker.lean(_entries(width, buckets)), "p int, h binary, cls binary, flag binary, done binary, count binary")
    shared = cells.groupBy("p").applyInArrow(_shared(buckets), "q int, cls binary, cnt binary").groupBy("q").applyInArrow(_summed, "cls long, cnt long")
    slack = F.expr(f"n - ceil({num} * n / {den})")
    alive = classes.join(shared, classes.k1 == shared.cls, "left").filter(F.col("sub") - F.coalesce("cnt", F.lit(0)) <= slack)
    alive = scratch.table(alive.select("rep"), "alive").distinct()
    full = base.join(alive, base.doc_id == alive.rep, "left_semi").mapInArrow(worker.lean(_full(width)), "node long, hs array<long>")
    full = scratch.table(full.dropDuplicates(["node"]).filter(F.size("hs") > 0), "sets")
    cells = full.select("node", F.size("hs").alias("n"), F.explode("hs").alias("h"))
    common = cells.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    common = scratch.table(common, "common")
    held = cells.join(common, "h").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("s"))
    spare = F.expr(f"cast(n - ceil({num} * n / {den}) + 1 - (n - size(s)) as int)")  # of the prefix, what is left for shared n-grams
    prefix = held.withColumn("spare", spare).filter("spare > 0").select("node", F.explode(F.expr("slice(s, 1, spare)")).alias("x")).select("node", F.col("x.h").alias("h"))
    prefix = scratch.table(prefix, "prefix")
    lowest = scratch.table(prefix.groupBy("h").agg(F.min("node").alias("m"), F.count(F.lit(1)).alias("df")).filter("df > 1"), "lowest")
    near = prefix.join(lowest, "h").filter("node <> m").select(F.col("node").alias("u"), F.col("m").alias("v"))
    blocks = scratch.table(connected_components(near), "blocks")
    heft = F.greatest(F.count(F.lit(1)) / tile, F.sum("n") / (tile * 1000))  # texts, and n-grams: long texts fill a tile sooner
    sizes = full.select("node", F.size("hs").alias("n"))
    members = blocks.select("node", "component", F.lit(0).alias("h"))
    tiles = members.join(sizes, "node").groupBy("component", "h").agg(F.ceil(heft).cast("int").alias("tiles"))
    tiles = scratch.table(tiles, "tiles")
    wide = tiles.filter(F.col("tiles") > most_tiles).select("component")
    postings = prefix.join(blocks.join(wide, "component", "left_semi"), "node").join(lowest.select("h"), "h", "left_semi").select("node", "component", "h")
    postings = scratch.table(postings, "postings")
    split = scratch.table(postings.join(sizes, "node").groupBy("component", "h").agg(F.ceil(heft).cast("int").alias("tiles")), "split")
    whole = members.join(tiles.filter(F.col("tiles") <= most_tiles), ["component", "h"])
    parts = postings.join(split, ["component", "h"])
    placed = whole.unionByName(parts).withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    pairs = F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(F.expr("sequence(0, tiles - 1)"))
    placed = placed.select("component", "h", "node", "t", F.explode(pairs).alias("o")).select("component", "h", F.least("t", "o").alias("a"), F.greatest("t", "o").alias("b"), "node", F.when(F.col("t") <= F.col("o"), 0).otherwise(1).alias("side"))
    dealt = placed.join(full.select("node", "hs"), "node").select("component", "h", "a", "b", "node", "side", "hs").repartition("component", "h", "a", "b").sortWithinPartitions("component", "h", "a", "b", "node")
    links = dealt.mapInArrow(worker.lean(_products(num, den)), "u long, v long")
    found = connected_components(links)
    marked = classes.join(found, classes.k1 == found.node, "left").select(*keys, F.col("rep").alias("class_id"), F.coalesce("component", "k1").alias("component"))
    marked = scratch.table(marked, "marked")
    least = scratch.table(marked.groupBy("component").agg(F.min("class_id").alias("component_id")), "least")
    return marked.join(least, "component").select(*keys, "class_id", "component", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 80, den: int = 100, tile: int = 1024, most_tiles: int = 32) -> DataFrame:
    """``(doc_id, n_shingles, class_id, component_id, component, text_hash)`` (long), a row for each row of ``docs``.

    Two texts link when ``den * |A & B| >= num * |A | B|`` over their sets of ``width``-word
    n-grams (a shorter text: all its words as one; none: the empty set, linked with nothing).
    ``class_id`` is the smallest id with an equal set, ``component_id`` the smallest that links
    reach, itself included; ``component`` is a name of that group (null for a text that is linked with
    nothing by definition), ``text_hash`` the xxhash64 of the text, which tells rows of one id apart.  Ids are integers.
    Each row is judged by its text, whatever other rows share its id; a row with a null id is linked with nothing
    (ids and component null).  Null and blank texts have n_shingles 0.  Other columns are ignored; an empty table gives an empty result.

    What joins on an n-gram or on the key of a class is written first, so that both sides have a
    shuffle of their own and Spark can split a hot key.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = base.withColumn("text_hash", F.xxhash64("text"))
    sized = scratch.table(marked.mapInArrow(worker.lean(_sizes(width)), "doc_id long, text_hash long, n long, sub long, k1 long, k2 long"), "sizes")
    keys = ["k1", "k2"]
    with scratch.temporary(docs.sparkSession) as keep:
        named = keep(_components(base, sized, width, num, den, tile, most_tiles), "named")
    out = sized.join(named, keys, "left")
    known = F.col("doc_id").isNotNull()
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(known, F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(known & (F.col("n") > 0), F.col("component")).alias("component"),
        "text_hash",
    )
