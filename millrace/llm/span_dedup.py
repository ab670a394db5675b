"""Substring dedup by hashing units: sentences within lines, grouped over the whole corpus.

A unit is a line, cut after runs of ``.``, ``!`` and ``?`` that a blank follows.  Its digest is taken from its
normalised words.  Of the units with one digest the earliest (by id, then offset) is kept; the
others are repeats.  Runs of neighbouring repeats with enough words in sum are removed, under
their offsets in the original text, so a short phrase that happens to recur stays; a text all of whose
units are repeats goes whole, however short.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, worker
from millrace.llm.text_arrays import PUNCT, U, mix, words

_ENDS = re.compile(r"(?:[.!?]+[ \t]+)|\n")


def units(text: str) -> list[int]:
    """Ends of the units of a text, in code points."""
    ends = [m.end() for m in _ENDS.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return ends


def _digests(batch: pa.RecordBatch):
    """For each row: starts, ends (code points), digests and word counts of its units that have words."""
    texts = [t or "" for t in batch.column(1).to_pylist()]
    for first, h, at, starts, _ in words(batch.column(1), PUNCT, places=True):
        for i in range(len(at) - 1):
            row, own = first + i, h[at[i] : at[i + 1]]
            if not len(own):
                continue
            text = texts[row]
            ends = units(text)
            begins = [0, *ends[:-1]]
            if text.isascii():
                cuts = np.array(begins)
            else:  # offsets of words are in bytes
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                lead = np.flatnonzero((data & 0xC0) != 0x80)
                cuts = lead[np.array(begins)]
            first_word = np.searchsorted(starts[at[i] : at[i + 1]], cuts)
            count = np.diff(np.append(first_word, len(own)))
            place = np.arange(len(own)) - np.repeat(first_word, count)
            mixed = mix(own + place.astype(np.uint64) * U(0xA24BAED4963EE407))
            sums = np.zeros(len(own) + 1, dtype=np.uint64)
            np.cumsum(mixed, out=sums[1:])
            ends_word = np.append(first_word[1:], len(own))
            digest = mix((sums[ends_word] - sums[first_word]) + count.astype(np.uint64) * U(0x9FB21C651E98DF25))
            yield row, np.array(begins), np.array(ends), digest, count


def _unit_rows(batches):
    names = ["digest", "doc_id", "text_hash", "of", "ord", "words", "start", "end"]
    for batch in batches:
        ids, marks, parts = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
        for row, begins, ends, digest, count in _digests(batch):
            if ids[row] is None:
                continue
            keep = np.flatnonzero(count)
            same = [np.full(len(keep), x, dtype=np.int64) for x in (ids[row], marks[row], len(keep))]
            parts.append((digest[keep].view(np.int64), *same, np.arange(len(keep)), count[keep], begins[keep], ends[keep]))
        columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(8)]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, kinds, strict=True)], names)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 25) -> DataFrame:
    """``(doc_id, start, end, n_words, kept_doc_id, kept_start, text_hash)`` (long): spans to remove, in code
    points of the original text, with the place of the earliest occurrence of their first unit.

    A span is a longest run of neighbouring units (those without words do not count) that all
    occurred earlier, with at least min_words words in sum, or that is all the text has.  Null and empty texts have no
    units, rows with a null id are left alone, rows that repeat an id and its text repeat nothing.
    Different texts under one id are texts of their own, in the order of ``text_hash`` (xxhash64 of
    the text), which tells whose span it is.  Other columns are ignored; an empty table has no spans.

    Plan: units without texts are grouped by digest with a minimum (combined before the shuffle),
    and digests that occur twice are joined back, in a join that Spark can split where one digest
    is hot; runs are found within one text.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    each = base.withColumn("text_hash", F.xxhash64("text")).mapInArrow(worker.lean(_unit_rows), "digest long, doc_id long, text_hash long, of int, ord int, words int, start int, end int")
    place = F.struct("doc_id", "text_hash", "start")
    first = each.groupBy("digest").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "least")
    first = scratch.table(first, "first")  # with a shuffle of its own, so that the join below can be split
    later = each.join(first, "digest").filter(place != F.col("least"))
    run = F.expr("ord - dense_rank() over (partition by doc_id, text_hash order by ord)")
    own = later.select("doc_id", "text_hash", "of", "ord", "words", "start", "end", "least").distinct().withColumn("run", run)
    spans = own.groupBy("doc_id", "text_hash", "run").agg(
        F.min("start").cast("long").alias("start"),
        F.max("end").cast("long").alias("end"),
        F.sum("words").alias("n_words"),
        F.min_by("least", "ord").alias("least"),
        (F.count(F.lit(1)) == F.max("of")).alias("whole"),
    )
    kept = [F.col("least.doc_id").alias("kept_doc_id"), F.col("least.start").cast("long").alias("kept_start")]
    return spans.filter((F.col("n_words") >= min_words) | F.col("whole")).select("doc_id", "start", "end", "n_words", *kept, "text_hash")


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the spans cut from ``text_col``, and ``removed`` (array of start and end in
    the original).  Rows without spans keep their text, null included; rows that repeat an id and its
    text are cut alike; a column ``removed`` is replaced."""
    by = spans.groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed"))
    out = docs.drop("removed").join(by, (F.col(id_col) == F.col("__doc")) & (F.xxhash64(F.col(text_col)) == F.col("__hash")), "left").drop("__doc", "__hash")
    edge = F.concat(F.array(F.lit(0).cast("long")), F.transform("removed", lambda s: s["end"]))
    until = F.concat(F.transform("removed", lambda s: s["start"]), F.array(F.char_length(F.col(text_col)).cast("long")))
    kept = F.zip_with(edge, until, lambda a, b: F.substring(F.col(text_col), (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(F.col("removed").isNull(), F.col(text_col)).otherwise(F.array_join(kept, ""))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return out.withColumn(text_col, text).withColumn("removed", F.coalesce("removed", none)).select(*[c for c in docs.columns if c != "removed"], "removed")
