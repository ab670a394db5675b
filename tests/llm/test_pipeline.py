"""The stages of the corpus pipeline, one after the other and each on awkward rows, against brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from millrace.llm import decontamination
from tests.llm.test_operators import brute_components, brute_lines, brute_resample, text_of

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {}
    for (name, stage), key in zip(P.STAGES, "abcde", strict=True):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        rows[key] = docs.collect()
        if key != "e":
            assert docs.columns == columns
        if key == "a":
            labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
            assert {r.doc_id for r in rows[key]} == {before[k][0] for k in brute_resample(spark, before, labels)}
            bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 0").collect()}
            good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
            kept = {r.doc_id for r in rows[key]}
            assert len(kept & good) > 0.9 * len(good) and len(kept & bad) < 0.5 * len(bad)
        if key == "b":
            assert sorted((r.doc_id, r.text) for r in rows[key]) == sorted((i, t) for i, _, _, t in brute_lines(before, 10, 1))
            assert all(r.n_chars == len(r.text) for r in rows[key])
        if key == "c":
            assert sorted(r.doc_id for r in rows[key]) == sorted(i for i, _, c in brute_components(before, 5, 80, 100) if i == c)
        if key == "d":
            held = {i for i, t in before for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if b.text in t}
            assert {i for i, _ in before} - {r.doc_id for r in rows[key]} >= held
        if key == "e":
            assert {r.doc_id for r in rows[key]} == {i for i, _ in before}
    assert decontamination.contaminated(spark.createDataFrame(rows["d"]), spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert P.run(spark, SF).count() == len(rows["e"])


NAMES = "doc_id long, text string, lang string, source string, n_chars long, node string, __id string, mark string, lines string, words string, n_lines string, log_weight string, h string"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and ids, common lines, clashing names."""
    base, item = text_of(60, 1), spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    near = " ".join([*base.split()[:59], "other"])
    rows = [(1, base), (2, base), (2, base), (3, near), (4, None), (5, ""), (5, ""), (6, " \n\t\n"), (7, text_of(20_000, 3)), (None, base), (None, base), (None, None), (8, "x" * 100_000), (9, base), (9, text_of(50, 5)), (10, f"{item} tail"), (None, item)]
    rows += [(20 + k, f"own {k} {text_of(30, 100 + k)}\nA common line") for k in range(12)]
    full = [(i, t, None if k % 3 else "en", None if k % 4 else "s", None if k % 5 else 7, *(f"{c}{k}" if k % 2 else None for c in "abcdefgh")) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, NAMES)


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def untouched(before, after, but=()):
    """The other columns of a row stay what they were."""
    names = [c for c in before.columns if c not in but]
    assert after.columns == before.columns
    known = {tuple(r[c] for c in names) for r in before.collect()}
    assert all(tuple(r[c] for c in names) in known for r in after.collect())


def test_quality_stage_on_awkward_rows(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
    got = P.quality(spark, awkward, SF)
    assert pairs(got) == Counter(rows[k] for k in brute_resample(spark, rows, labels))
    untouched(awkward, got)


def test_lines_stage_on_awkward_rows(spark, awkward):
    got = P.lines(spark, awkward, SF)
    assert pairs(got) == Counter((i, t) for i, _, _, t in brute_lines([(r.doc_id, r.text) for r in awkward.collect()], 10, 1))
    assert all(r.n_chars == len(r.text) for r in got.collect())
    untouched(awkward, got, ["text", "n_chars"])


def test_near_copies_stage_on_awkward_rows(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    hashes = {r.text: r.h for r in awkward.select("text", F.xxhash64("text").alias("h")).collect()}
    flat = sorted({(i, hashes[t], t or "") for i, t in rows if i is not None})
    numbers = brute_components([(k, t) for k, (_, _, t) in enumerate(flat)], 5, 80, 100)
    stay = {flat[k][:2] for k, _, c in numbers if k == c}
    want = Counter({(i, t): 1 for i, t in rows if i is None or (i, hashes[t]) in stay})
    got = P.near_copies(spark, awkward, SF)
    assert pairs(got) == want
    untouched(awkward, got)


def test_benchmark_stage_on_awkward_rows(spark, awkward):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    got = P.benchmark(spark, awkward, SF)
    assert pairs(got) == Counter((r.doc_id, r.text) for r in awkward.collect() if item not in (r.text or ""))
    untouched(awkward, got)


def test_sequences_stage_on_awkward_rows(spark, awkward):
    got = P.sequences(spark, awkward, SF).collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == Counter(r.doc_id for r in awkward.collect())
    assert all(r.doc_tokens == 1 for r in got if r.doc_id in (4, 5, 6))


def test_stages_on_an_empty_table(spark, awkward):
    for _, stage in P.STAGES:
        assert stage(spark, awkward.filter("false"), SF).count() == 0
