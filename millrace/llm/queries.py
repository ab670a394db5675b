"""The operators of this subpackage on their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, importance, jaccard_join, language_id, license_scan, line_dedup, packing, phrase_fingerprint, scratch, span_dedup, warc

#: Base phrases of op5 and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return importance.resample(docs, labels, whole_rows=False)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), width=4, num=85, den=100)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan_licenses(docs, base=BASE_PHRASES)
    own = F.filter("detections", lambda d: d["base"])
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda d: d["label"]))), ",")
    starts = F.transform(own, lambda d: d["start"].cast("long"))
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])), F.lit(0))
    return found.select(
        "doc_id",
        "n_words",
        F.size(own).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(own).alias("base_labels"),
        labels(F.col("detections")).alias("labels"),
        (best / 5.0).alias("score"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.repeated_spans(_table(spark, sf_dir, "documents"))


#: The languages that op7 tells apart.
LANGUAGES = ["de", "en", "es", "fr"]
#: Documents whose language is given, on which op7 fits its text model: those of the smallest hash of their id.
MOST_LABELLED = 8000


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and documents, each under its own id; the text model is fitted on at most ``MOST_LABELLED`` documents."""
    docs, pages = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages")
    chosen = docs.select("doc_id", "lang").filter(F.col("lang").isin(LANGUAGES)).orderBy(F.xxhash64(F.lit(7), "doc_id")).limit(MOST_LABELLED).select("doc_id")
    model = language_id.train(docs.join(chosen, "doc_id", "left_semi"), LANGUAGES)
    own = language_id.identify(language_id.document_rows(docs), model, LANGUAGES)
    web = language_id.identify(language_id.page_rows(pages, LANGUAGES), model, LANGUAGES, html=True)
    none = F.lit(None).cast("long")
    rest = ["lang", "confidence", "text_lang", "declared", "address"]
    return own.select(F.col("id").alias("doc_id"), none.alias("page_id"), *rest).unionByName(web.select(none.alias("doc_id"), F.col("id").alias("page_id"), *rest))


def op8_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_fingerprint.edited_likeness(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.contaminated(docs, benchmark)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch.new_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_packing": op2_packing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_line_dedup": op4_line_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language_id": op7_language_id,
    "op8_phrase_fingerprints": op8_phrase_fingerprints,
    "op9_decontamination": op9_decontamination,
    "op10_warc": op10_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": r"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM doc
),
keyed AS (
  SELECT doc_id, line, pos,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM line
),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT doc_id, line, pos, k IN (SELECT k FROM common) AS lost FROM keyed)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE lost))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op10_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS keep FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM m
""",
}
