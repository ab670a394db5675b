"""Quality classifier by importance resampling (Xie et al., DSIR, 2023).

Two hashed n-gram models, of the target (labelled good texts) and of the raw corpus (every
text), give each text the log ratio of its n-grams; a sample of size k without replacement,
in proportion to the ratio, is the k largest of ratio plus Gumbel noise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, worker
from millrace.llm.text_arrays import WHITE, U, mix, words

_FIT, _TEST = 0, 1


def _features(column: pa.Array, buckets: int):
    """(row, buckets of the words and word pairs) of each text."""
    for first, h, at, _, _ in words(column, WHITE):
        pair = mix(h[:-1] * U(3) + h[1:]) % U(buckets) if len(h) > 1 else h[:0]
        one, pair = (h % U(buckets)).astype(np.int64), pair.astype(np.int64)
        for i in range(len(at) - 1):
            a, b = at[i], at[i + 1]
            yield first + i, np.concatenate([one[a:b], pair[a : max(a, b - 1)]])


def _counts(buckets: int):
    """One row a partition: how often each bucket occurs in it."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, f in _features(batch.column(0), buckets):
                total += np.bincount(f, minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], ["counts"])

    return run


def corpus_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts; the driver gets one number a bucket."""
    parts = texts.mapInArrow(worker.lean(_counts(buckets)), "counts array<long>").select(F.posexplode("counts").alias("bucket", "n")).filter("n > 0")
    out = np.zeros(buckets, dtype=np.int64)
    with scratch.small_batches(texts.sparkSession):
        for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[r[0]] = r[1]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log p_target - log p_raw for each bucket, both with additive smoothing."""
    p = lambda c: np.log((c + smoothing) / (c.sum() + smoothing * len(c)))
    return p(target) - p(raw)


def _scores(ratio: np.ndarray, seed: int, temperature: float, id_at: int, text_at: int, whole: bool = True):
    """The columns up to text_at, or all, with the weight (log ratio over the root of the number of n-grams) and the Gumbel key."""

    def run(batches):
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for row, f in _features(batch.column(text_at), len(ratio)):
                if len(f):
                    weight[row] = ratio[f].sum() / np.sqrt(len(f))
            ids = np.array([x if x is not None else -1 for x in batch.column(id_at).to_pylist()], dtype=np.int64)
            u = (mix(ids.view(np.uint64) * U(0x9E3779B97F4A7C15) + U(seed)) >> U(11)).astype(np.float64)
            key = weight / temperature - np.log(-np.log((u + 0.5) / 2.0**53))
            n = batch.num_columns if whole else text_at
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(weight), pa.array(key)], [*batch.schema.names[:n], "log_weight", "gumbel_key"])

    return run


def largest_key(scored: DataFrame, k: int, column: str = "gumbel_key", bins: int = 2048) -> float:
    """The k-th largest value, exactly: bins are counted, and the one that holds it is cut again."""
    lo, hi, n = scored.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k <= 0:
        return float("inf")
    if k >= n:
        return lo
    above = 0
    while True:
        width = (hi - lo) / bins
        part = scored.filter((F.col(column) >= lo) & (F.col(column) <= hi))
        cell = F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
        cells = {r[0]: r[1:] for r in part.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)), F.min(column), F.max(column)).collect()}
        for c in sorted(cells, reverse=True):
            count, low, high = cells[c]
            if above + count >= k:
                lo, hi = low, high
                break
            above += count
        if lo == hi or above + count == k:
            return lo


def choose_threshold(good: np.ndarray, bad: np.ndarray, price: float = 4.0) -> float:
    """The weight that best parts held-out texts: rejected bad share minus price times rejected good share."""
    if not len(good) or not len(bad):
        return float(good.min()) if len(good) else float("-inf")
    cuts = np.unique(np.concatenate([good, bad]))
    gain = np.searchsorted(np.sort(bad), cuts) / len(bad) - price * np.searchsorted(np.sort(good), cuts) / len(good)
    return float(cuts[int(np.argmax(gain))])


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None, buckets: int = 1 << 16, most_labelled: int = 20_000, temperature: float = 0.05, seed: int = 17, whole_rows: bool = True) -> DataFrame:
    """The rows of ``docs`` that the sample keeps, with ``log_weight`` and ``gumbel_key``.

    ``labels(doc_id, quality)`` names good (1) and bad (0) texts.  At most ``most_labelled`` of
    them, those of the smallest hash of their id, are used: four fifths fit the target model,
    a fifth sets the threshold that counts how many texts of the corpus are as good as
    the target; that count is k unless k is given.  The raw model and the weights cover
    every text.  A low temperature draws nearly in order of weight, so clear cases
    do not hang on the noise.

    A null or blank text has weight 0.  Labels: of an id named twice, bad counts; null
    labels and ids are left out; without any labels k is all rows.  Rows with an equal key
    (repeated rows) stand or fall together.  Noise depends on the id alone, and null ids
    share one draw.  Columns named ``log_weight`` or ``gumbel_key`` are replaced; with
    whole_rows false only the id and those two come back, and no text is read again.
    """
    docs = docs.drop("log_weight", "gumbel_key")
    named = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    mixed = F.xxhash64(F.lit(seed), "doc_id")
    chosen = scratch.table(named.withColumn("h", mixed).orderBy("h", "doc_id").limit(most_labelled).select(F.col("doc_id").alias("__id"), "quality", F.when(F.pmod("h", F.lit(5)) == 0, _TEST).otherwise(_FIT).alias("part")), "labelled")
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fit = text.join(chosen.filter((F.col("part") == _FIT) & (F.col("quality") == 1)), text.doc_id == F.col("__id"), "left_semi")
    ratio = log_ratio(corpus_counts(fit.select("text"), buckets), corpus_counts(text.select("text"), buckets))
    light = scratch.table(text.mapInArrow(worker.lean(_scores(ratio, seed, temperature, 0, 1, whole=False)), "doc_id long, log_weight double, gumbel_key double"), "scored")
    if k is None:
        held = light.join(chosen.filter(F.col("part") == _TEST), light.doc_id == F.col("__id")).groupBy("doc_id", "quality").agg(F.max("log_weight").alias("w")).collect()  # at most most_labelled rows
        cut = choose_threshold(np.array([r.w for r in held if r.quality == 1]), np.array([r.w for r in held if r.quality != 1]))
        k = light.filter(F.col("log_weight") >= cut).count()
    least = largest_key(light, k)
    if not whole_rows:
        return light.filter(F.col("gumbel_key") >= least)
    kind = docs.withColumns({"log_weight": F.lit(0.0), "gumbel_key": F.lit(0.0)}).schema
    again = docs.mapInArrow(worker.lean(_scores(ratio, seed, temperature, docs.columns.index(id_col), docs.columns.index(text_col))), kind)
    return again.filter(F.col("gumbel_key") >= least)
