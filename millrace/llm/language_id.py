"""Language identification by Bayesian fusion of four kinds of evidence.

Text: hashed word models, with a bound on what a long text may say.  Declared
markup (``<html lang>``) and address (a path segment or a country suffix): channels whose
confusions are counted against the text's opinion.  Host: expected shares of the languages among
the *other* rows of the host, smoothed towards its domain, that towards its suffix, that towards the corpus
(Dirichlet smoothing level by level), all from grouped sums less the row's own share.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, worker
from millrace.llm.text_arrays import PUNCT, U, words

_MARK = re.compile(r"<(?:(!--)|(script|style|head)\b)?", re.I)
_CLOSED = {"!--": re.compile("-->")} | {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "head")}
_TAG = re.compile(">")
_ENTITY = re.compile(r"&#?\w+;")


def visible_text(html: str) -> str:
    """The text between tags, without scripts, styles, heads and comments, each piece apart.

    One of these that is not closed counts as a tag; a ``<`` without any later ``>`` is text.  Once a closing
    mark is not found it is not looked for again, so the time is linear.
    """
    out, at, open_ended = [], 0, set()
    for m in iter(lambda: _MARK.search(html, at), None):
        name = (m[1] or m[2] or "").lower()
        end = None
        if name and name not in open_ended:
            end = _CLOSED[name].search(html, m.end())
            if not end:
                open_ended.add(name)
        end = end or _TAG.search(html, m.end())
        if not end:
            break
        out.append(html[at : m.start()])
        at = end.end()
    out.append(html[at:])
    return _ENTITY.sub(" ", " ".join(out))


def _features(column: pa.Array, buckets: int):
    """(row, hashed words) per text."""
    for first, h, at, _, _ in words(column, PUNCT):
        one = (h % U(buckets)).astype(np.int64)
        for i in range(len(at) - 1):
            yield first + i, one[at[i] : at[i + 1]]


def train(sample: DataFrame, languages: list[str], buckets: int = 1 << 15, smoothing: float = 0.5) -> np.ndarray:
    """log p(bucket | language), from rows (text, lang); the driver gets a number a bucket and language."""

    def run(batches):
        total = np.zeros((len(languages), buckets), dtype=np.int64)
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for row, f in _features(batch.column(0), buckets):
                total[languages.index(langs[row])] += np.bincount(f, minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(languages)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.int64()))], ["l", "counts"])

    rows = sample.filter(F.col("lang").isin(languages)).select("text", "lang").mapInArrow(worker.lean(run), "l int, counts array<long>")
    sums = rows.select("l", F.posexplode("counts").alias("b", "n")).filter("n > 0").groupBy("l", "b").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), buckets))
    with scratch.small_batches(sample.sparkSession):
        for r in sums.collect():
            counts[r.l, r.b] = r.n
    return np.log((counts + smoothing) / (counts.sum(axis=1, keepdims=True) + smoothing * buckets))


def _text_evidence(model: np.ndarray, html: bool, bound: float):
    """Appends log-likelihoods by language, centred and scaled so that none exceeds the bound."""

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            if html:
                column = pa.array([visible_text(t or "") for t in column.to_pylist()], pa.string())
            out = np.zeros((batch.num_rows, len(model)))
            for row, f in _features(column, model.shape[1]):
                if len(f):
                    s = model[:, f].sum(axis=1)
                    out[row] = bound * np.tanh((s - s.max()) / bound)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(out.tolist(), pa.list_(pa.float64()))], [batch.schema.names[0], *batch.schema.names[2:], "evidence"])

    return run


def _softmax(x: Column) -> Column:
    e = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def identify(rows: DataFrame, model: np.ndarray, languages: list[str], html: bool = False, bound: float = 30.0, strength: float = 4.0) -> DataFrame:
    """``(id, lang, confidence, text_lang, declared, address)`` per row of ``rows(id, text, declared, address, host)``.

    ``declared`` and ``address`` are language codes or null (unknown codes count as null), host is
    a name or null.  A row with no evidence at all gets its prior's first language.  Null and
    empty texts say nothing.  Rows that repeat an id are judged alike, each by itself; they do
    count for one another in their host's prior.  Of languages that are equally likely the first is
    named.  Other columns are ignored; an empty table gives an empty result.

    Plan: one pass over the texts leaves numbers; confusions are two small tables on the
    driver (languages squared); priors come from sums by host, domain and suffix, combined before
    their shuffle.  The sums are written before they are joined back, so that a host (or a domain among
    hosts) that holds a third of the rows can be split.
    """
    n = len(languages)
    known = lambda c: F.when(F.lower(c).isin(languages), F.lower(c))
    base = rows.select("id", F.col("text").cast("string").alias("text"), known(F.col("declared")).alias("declared"), known(F.col("address")).alias("address"), F.coalesce("host", F.lit("")).alias("host"))
    seen = scratch.table(base.mapInArrow(worker.lean(_text_evidence(model, html, bound)), "id long, declared string, address string, host string, evidence array<double>"), "evidence")
    seen = seen.withColumn("p", _softmax(F.col("evidence")))
    mass = [F.sum(F.col("p")[k]).alias(f"m{k}") for k in range(n)]

    def channel(column: str) -> Column:
        """log p(code | language) as an array by language; of no code, zeros."""
        got = {r[0]: [r[k + 1] for k in range(n)] for r in seen.filter(F.col(column).isNotNull()).groupBy(column).agg(*mass).collect()}
        counts = np.array([got.get(c, [0.0] * n) for c in languages]) + np.eye(n) * 2 + 0.5
        logs = np.log(counts / counts.sum(axis=0, keepdims=True))
        out = F.array(*[F.lit(0.0)] * n)
        for k, c in enumerate(languages):
            out = F.when(F.col(column) == c, F.array(*[F.lit(float(x)) for x in logs[k]])).otherwise(out)
        return out

    both = [channel("declared"), channel("address")]
    parts = F.split("host", r"\.")
    suffix = F.element_at(parts, -1)
    domain = F.when(F.size(parts) > 1, F.concat_ws(".", F.element_at(F.slice(parts, F.size(parts) - 1, 1), 1), suffix)).otherwise(F.col("host"))
    sums = F.array(*mass)
    hosts = scratch.table(seen.groupBy("host").agg(sums.alias("host_sums")).withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    total = lambda: F.array(*[F.sum(F.col("host_sums")[k]) for k in range(n)])
    domains = scratch.table(hosts.groupBy("domain").agg(total().alias("domain_sums")), "domains")
    suffixes = scratch.table(hosts.groupBy("suffix").agg(total().alias("suffix_sums")), "suffixes")
    levels = scratch.table(hosts.join(domains, "domain").join(suffixes, "suffix").select("host", "host_sums", "domain_sums", "suffix_sums"), "levels")
    whole = [v or 0.0 for v in (hosts.agg(*[F.sum(F.col("host_sums")[k]) for k in range(n)]).first() or [])]

    def others(sums: Column) -> Column:
        return F.zip_with(sums, "p", lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def smoothed(sums: Column, above: Column, by: float) -> Column:
        """(counts + by * the shares above) over their sum."""
        summed = F.aggregate(sums, F.lit(by), lambda a, b: a + b)
        return F.zip_with(sums, above, lambda a, b: (a + by * b) / summed)

    out = seen.join(levels, "host")
    out = out.withColumn("prior", smoothed(others(F.array(*[F.lit(v) for v in whole])), F.array(*[F.lit(1.0 / n)] * n), float(n)))
    for level in ("suffix_sums", "domain_sums", "host_sums"):
        out = out.withColumn("own", others(F.col(level))).withColumn("prior", smoothed(F.col("own"), F.col("prior"), strength))
    add = lambda x, y: F.zip_with(x, y, lambda a, b: a + b)
    out = out.withColumn("score", add(add(F.col("evidence"), both[0]), add(both[1], F.transform("prior", lambda q: F.ln(q)))))
    out = out.withColumn("post", _softmax(F.col("score")))
    names = F.array(*[F.lit(x) for x in languages])
    top = lambda x: F.element_at(names, F.array_position(x, F.array_max(x)).cast("int"))
    told = F.exists("evidence", lambda v: v != 0)
    return out.select("id", top(F.col("post")).alias("lang"), F.array_max("post").alias("confidence"), F.when(told, top(F.col("p"))).alias("text_lang"), "declared", "address")


#: Country suffixes that speak for a language.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "uk": "en", "us": "en"}


def page_rows(pages: DataFrame, languages: list[str], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows for ``identify`` from web pages: markup, path segment or country suffix, and host."""
    url, html = F.col(url_col), F.col(html_col)
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    segment = F.regexp_extract(url, rf"^[a-zA-Z]+://[^/?#]+/(?:[^?#]*/)?({'|'.join(languages)})(?:[/?#]|$)", 1)
    suffix = F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv])
    tail = F.regexp_extract(host, r"\.([a-z]+)$", 1)
    address = F.coalesce(F.when(segment != "", segment), F.try_element_at(suffix, tail))
    declared = F.substring(F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-zA-Z]{2})", 1)), 1, 2)
    return pages.select(F.col(id_col).cast("long").alias("id"), html.alias("text"), F.when(declared != "", declared).alias("declared"), address.alias("address"), F.when(host != "", host).alias("host"))


def document_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Rows for ``identify`` from plain texts: their source is the host, nothing is declared."""
    none = F.lit(None).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), none.alias("declared"), none.alias("address"), F.col(host_col).alias("host"))
