"""Line dedup: drop lines whose normalised form stands in too many documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch

_BLANK = " \t\n\v\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(x: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    return F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(F.translate(x, _UPPER, _UPPER.lower()))


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased and nothing else."""
    return lower_ascii(F.btrim(line, F.lit(_BLANK)))


def line_digest(line: Column, min_chars: int) -> Column:
    """96 bits for the key of a line, null for a key of fewer than min_chars code points."""
    key = line_key(line)
    return F.when(F.char_length(key) >= min_chars, F.struct(F.xxhash64(key).alias("a"), F.hash(key).alias("b")))


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with ``text_col`` rid of common lines, and ``n_lines``, ``n_dropped`` (long).

    Lines end at ``\\n``; a null or empty text is one empty line, and becomes or stays the
    empty text.  Rows that share an id (null included) count as one document; each keeps its
    own row.  A key that occurs twice in a document counts once, so repeated rows do not make
    a line common.  An empty table gives an empty result.  Other columns pass through; one
    named ``n_lines`` or ``n_dropped`` is replaced.

    Plan: explode digests with their positions (no text is shuffled), count distinct documents per
    digest with a map-side sum, and keep the common ones; the positions that each text must lose
    come back in one array, joined on the id and a hash of the text, so rows of one id (or none) with
    different texts do not meet.  Both joins have a shuffle on each side, which Spark can split: that of
    a line that stands in a third of all documents, and that of a row repeated so often.
    """
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    mark = F.xxhash64(F.col(text_col))
    keys = F.posexplode(F.transform(lines, lambda x: line_digest(x, min_chars)))
    each = docs.select(F.col(id_col).alias("doc"), mark.alias("mark"), keys.alias("pos", "key")).filter("key IS NOT NULL")
    kept = docs.drop("n_lines", "n_dropped")
    doc, own, lost, split, stay = (scratch.unused(x, kept) for x in ("doc", "mark", "lost", "lines", "stay"))
    with scratch.temporary(docs.sparkSession) as keep:
        each = scratch.table(each.select("doc", "mark", "pos", "key.a", "key.b"), "lines")
        common = each.select("doc", "a", "b").distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("a", "b")
        common = scratch.table(common, "common")
        gone = each.join(common, ["a", "b"], "left_semi").groupBy("doc", "mark").agg(F.collect_set("pos").alias("lost"))
        gone = keep(gone.toDF(doc, own, lost), "lost")
    kept = kept.join(gone, F.col(id_col).eqNullSafe(F.col(doc)) & (mark == F.col(own)), "left").withColumn(split, lines)
    places = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.coalesce(lost, F.array().cast("array<int>")))
    kept = kept.withColumn(stay, places)
    text = F.array_join(F.transform(stay, lambda k: F.get(split, k)), "\n")
    return kept.withColumns(
        {
            text_col: F.when(F.col(lost).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(text),
            "n_lines": F.size(split).cast("long"),
            "n_dropped": (F.size(split) - F.size(stay)).cast("long"),
        }
    ).drop(doc, own, lost, split, stay)
