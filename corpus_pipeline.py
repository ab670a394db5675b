"""A corpus from raw documents to packed sequences: five stages, each an operator of ``millrace.llm``.

A stage takes the documents that its predecessor kept, and returns those that it keeps (the last:
pieces of sequences).  ``run`` writes each result as Parquet under the shared folder and reads it
again; what a stage wrote for itself on the way is deleted once its result is written.

All stages: rows are whole documents.  Null and empty texts, null ids, repeated ids and rows, ties, an
empty table and further columns of any name are dealt with as each stage says; none of them fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, importance, jaccard_join, line_dedup, packing, scratch
from millrace.llm.queries import tokenizer_path


def _apart(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns of these names under others, as an operator would replace them, and the way back."""
    away = {c: scratch.unused(f"{c}_", docs) for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(away), {new: c for c, new in away.items()}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go.  A null or blank text weighs 0, so it stays or goes with neutral texts; repeated
    rows have one weight and one draw by id and stand or fall together; without labels all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own, back = _apart(docs, "log_weight", "gumbel_key")
    return importance.resample(own, labels).select(own.columns).withColumnsRenamed(back)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Common lines go; ``n_chars``, where there is one, follows the text.  A null text becomes the empty text;
    rows of one id (null included) are one document when documents are counted; no row goes."""
    own, back = _apart(docs, "n_lines", "n_dropped")
    kept = line_dedup.drop_common_lines(own, min_docs=10, min_chars=1)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast("long"))
    return kept.select(own.columns).withColumnsRenamed(back)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays.  Null and blank texts and rows with a null
    id are linked with nothing and stay; of rows with equal id and text one stays; rows that share an id and
    differ in text are documents of their own (of two in one group that of the smaller hash stays)."""
    node, mark = scratch.unused("node", docs), scratch.unused("mark", docs)
    with scratch.temporary(spark) as keep:
        groups = jaccard_join.near_duplicates(docs, width=5, num=80, den=100).filter("doc_id IS NOT NULL")
        place = F.struct("doc_id", "text_hash")
        rows = scratch.table(groups.groupBy("doc_id", "text_hash", "component").agg(F.count(F.lit(1)).alias("n")), "rows")
        first = scratch.table(rows.filter("component IS NOT NULL").groupBy("component").agg(F.min(place).alias("first")), "first")
        told = rows.join(first, "component", "left").withColumn("stays", F.coalesce(F.col("first") == place, F.lit(True)))
        odd = told.filter("NOT stays OR n > 1")  # copies and repeated rows: the few that are not just kept
        odd = keep(odd.select(F.col("doc_id").alias(node), F.col("text_hash").alias(mark), "stays"), "odd")
    met = (F.col("doc_id") == F.col(node)) & (F.xxhash64("text") == F.col(mark))
    once = docs.filter("doc_id IS NOT NULL").join(odd.select(node, mark), met, "left_anti")
    again = docs.join(odd.filter("stays").select(node, mark), met, "left_semi").unionByName(docs.filter("doc_id IS NULL"))
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.  Null and empty texts hold none and stay; each row is judged by
    its text alone."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, packed: a null or empty text is the one id that ends a document, every row is
    packed, and null ids stay null."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark),
    ("packing", sequences),
]

#: The first, third, fourth and fifth stage have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; of what they wrote, the documents that the last one packs stay."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = scratch.new_path(spark, "stage")
        with scratch.temporary(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            scratch.delete(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
