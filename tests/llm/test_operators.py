"""Operators against brute force on small tables, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import decontamination, graph, importance, jaccard_join, language_id, license_scan, line_dedup, packing, phrase_fingerprint, scratch, span_dedup, text_arrays, warc, word_bpe, worker
from millrace.llm.queries import BASE_PHRASES, tokenizer_path
from millrace.llm.text_arrays import PUNCT, WHITE, shingles, words

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RNG = np.random.default_rng(5)
WORDS = ["alpha", "Beta", "gamma,", "delta.", "été", "ñu", "eps", "zeta", "eta!", "theta"]


def text_of(n, seed=None):
    rng = np.random.default_rng(seed) if seed is not None else RNG
    return " ".join(f"{rng.choice(WORDS)}{rng.integers(40)}" for _ in range(n))


def fixture_rows():
    base = text_of(60, 1)
    near = base.split()
    near[30] = "changed"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "One\ttwo"), (9, text_of(300, 2)), (10, text_of(4000, 3)), (10, text_of(4000, 3)), (None, base), (11, "x" * 50_000), (12, base.upper())]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "c", "d") for i, t in fixture_rows()], "doc_id long, text string, component_id string, n_lines string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def test_words_of_segments_equal_a_plain_split():
    texts = ["Ab c", "", None, "é ü\tZ", "q" * 3_000_000 + " r s", ("w%d " * 5 % (1, 2, 3, 4, 5)) * 100_000]
    got = []
    for _, h, at, _, _ in words(pa.array(texts, pa.string()), WHITE):
        got += [h[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    table = {}
    for t, hashes in zip(texts, got, strict=True):
        own = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        assert len(own) == len(hashes)
        for w, x in zip(own, hashes, strict=True):
            assert table.setdefault(w, x) == x
    assert len(set(table.values())) == len(table)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="aB .,é1\n", max_size=20), max_size=6))
def test_words_offsets(texts):
    for first, _, at, starts, ends in words(pa.array(texts, pa.string()), PUNCT, places=True):
        for i in range(len(at) - 1):
            data = texts[first + i].encode()
            own = [data[a:b].decode().translate(LOWER) for a, b in zip(starts[at[i] : at[i + 1]], ends[at[i] : at[i + 1]], strict=True)]
            assert own == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[first + i].translate(LOWER))


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)] + [(9999, k) for k in range(2000, 2100)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def shingle_set(t, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(rows, width, num, den):
    sets = [(i, shingle_set(t, width)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), root(i)) for i, s in sets]


@pytest.mark.parametrize(("width", "num", "tile", "most_tiles"), [(4, 85, 1024, 32), (5, 80, 3, 32), (5, 80, 3, 1)])
def test_jaccard_join(spark, docs, width, num, tile, most_tiles):
    rng = np.random.default_rng(8)
    rows = fixture_rows()
    shared = text_of(400, 11)
    for g in range(12):  # near copies whose edits straddle the bound, within shared passages
        own = text_of(int(rng.integers(5, 90)), 100 + g).split()
        for c in range(7):
            w = list(own)
            for _ in range(int(rng.integers(0, 1 + len(w) // 12))):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(1000)}"
            rows.append((1000 + 10 * g + c, " ".join(w) + (" " + shared if g < 2 else "")))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), width=width, num=num, tile=tile, most_tiles=most_tiles)
    want = brute_components(rows, width, num, 100)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect() if r.doc_id is not None) == sorted(want)
    lost = [r for r in got.collect() if r.doc_id is None]
    assert len(lost) == 1 and lost[0].component_id is None


def test_jaccard_join_of_documents(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    got = jaccard_join.near_duplicates(table, width=4, num=85)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute_components(rows, 4, 85, 100))


def test_jaccard_join_of_nothing(empty):
    assert jaccard_join.near_duplicates(empty).count() == 0


def brute_lines(rows, min_docs, min_chars):
    key = lambda x: x.strip(" \t\n\v\f\r").translate(LOWER)
    seen = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                seen.setdefault(key(x), set()).add(i)
    common = {k for k, s in seen.items() if len(s) >= min_docs}
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if key(x) not in common]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(spark):
    rows = [(k, f"Head {k % 2}\nown {k}\n\nTail \n É") for k in range(12)] + [(20, None), (21, ""), (22, "own 3\r\nHEAD 1 "), (23, "\n\n"), (23, "\n\n"), (None, "tail \nx"), (24, "é\nÉ")]
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_dropped int")
    order = lambda x: tuple(str(v) for v in x)
    for min_docs, least in ((6, 1), (3, 3), (2, 0)):
        got = line_dedup.drop_common_lines(table, min_docs=min_docs, min_chars=least)
        assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=order) == sorted(brute_lines(rows, min_docs, least), key=order)
    assert line_dedup.drop_common_lines(table.filter("false")).count() == 0


def test_line_dedup_of_long_texts_and_shared_ids(spark):
    common = [f"common {k}" for k in range(3000)]
    rows = [(k, "\n".join(common)) for k in range(10)] + [(50, "\n".join(f"own {k}\ncommon {k % 3000}" for k in range(30_000)))]
    rows += [(None, f"null {k}\nCommon 7\nnull {k}") for k in range(40)] + [(None, "null 3\nCommon 7\nnull 3")] * 20
    table = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, lines string")
    out = line_dedup.drop_common_lines(table, min_docs=10)
    assert out.columns == ["doc_id", "text", "lines", "n_lines", "n_dropped"]
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=order) == sorted(brute_lines(rows, 10, 1), key=order)


def test_line_dedup_runs_no_python(docs):
    plan = line_dedup.drop_common_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


LICENCES = [
    (1, "Licensed under the Apache License, Version 2.0."),
    (2, "MIT License MIT license; mit   licensee"),
    (3, None),
    (4, ""),
    (5, "This work is licensed under the GNU General Public License, version 3."),
    (6, "SPDX-License-Identifier: MPL-2.0 or a general  public\nLICENSE"),
    (7, "é mit license " * 300),
    (8, "mit"),
    (9, "w " * 100 + "released under the terms of the GNU Lesser General Public License v2.1 " + "w " * 40 + "All rights reserved. " + "x " * 200 + "GPL"),
    (10, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    (11, "MIT LİCENSE mit licen\u017fe MIT \u212aLICENSE the MIT LICENSE"),
    (12, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    (12, "Apache License Apache License 2 Apache License, version 2.0 GNU GPL v3"),
    (None, "mit license"),
]


def brute_detections(text):
    """(start, end, label, priority) that stay, from the rules run over every word of the whole text."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    line, at = " " + " ".join(w) + " ", {}
    for k, m in enumerate(re.finditer(r"(?<= )(?=[^ ])", line)):
        at[m.start()] = k
    found = []
    for rank, r in enumerate(license_scan.rules()):
        if f" {r.keyword} " in line:
            p = re.compile(f"(?:{r.pattern})(?= )")
            for pos, k in at.items():
                if m := p.match(line, pos):
                    found.append((k, k + 1 + m[0].count(" "), r.label, r.priority, rank))
    better = lambda o, d: (o[3], o[1] - o[0], -o[4]) > (d[3], d[1] - d[0], -d[4])
    return sorted(d[:4] for d in found if not any(o[0] <= d[0] and o[1] >= d[1] and better(o, d) for o in found))


def test_license_scan(spark):
    table = spark.createDataFrame([(i, t, 0) for i, t in LICENCES], "doc_id long, text string, detections int")
    out = license_scan.scan_licenses(table, base=BASE_PHRASES)
    assert out.columns == ["doc_id", "text", "n_words", "detections"]
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert len(got) == len(LICENCES)
    for i, t in LICENCES:
        own = got[i, t]
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        assert own.n_words == len(w)
        want = sorted((j, j + len(p.split()), label) for p, label in BASE_PHRASES.items() for j in range(len(w)) if w[j : j + len(p.split())] == p.split())
        assert [(d.start, d.end, d.label) for d in own.detections if d.base] == want
        assert [(d.start, d.end, d.label, d.priority) for d in own.detections if not d.base] == brute_detections(t)
    labels = lambda i: {d.label for k, r in got.items() if k[0] == i for d in r.detections if not d.base}
    assert labels(1) == {"apache-2.0"} and labels(5) == {"gpl-3.0"} and "mpl-2.0" in labels(6) and labels(8) == set()
    assert labels(9) == {"lgpl-2.1", "proprietary", "gpl"} and labels(10) == {"mit"}
    plan = license_scan.scan_licenses(table)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
    assert license_scan.scan_licenses(table.filter("false")).count() == 0


def test_license_scan_of_segments(spark):
    """Matches at every distance from the edges of segments, and a megabyte of them."""
    lines = ["licensed under the terms of the mit license", "general public license version 3", "all rights reserved"]
    rows = [(k, "v " * k + " ".join(lines)) for k in range(100, 150)] + [(999, "apache license " * 40_000)]
    got = {r.doc_id: r.detections for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), base=BASE_PHRASES).collect()}
    for k, t in rows[:-1]:
        assert [(d.start, d.end, d.label, d.priority) for d in got[k] if not d.base] == brute_detections(t)
    assert len(got[999]) == 80_000


def extremes(pattern):
    """The shortest and a longest text of a pattern."""
    import re._parser as parser

    def of(items, most):
        out = ""
        for op, arg in items:
            op = str(op)
            if op == "LITERAL":
                out += chr(arg)
            elif op == "IN":
                out += chr(next(x[1] if str(x[0]) == "LITERAL" else ord("7") if str(x[0]) == "RANGE" else ord("q") for x in arg))
            elif op == "SUBPATTERN":
                out += of(arg[3], most)
            elif op == "BRANCH":
                out += (max if most else min)((of(x, most) for x in arg[1]), key=len)
            elif op == "MAX_REPEAT":
                lo, hi, own = arg
                out += of(own, most) * (min(int(hi), 200) if most and int(hi) < 1000 else lo)
            else:
                raise AssertionError(op)
        return out

    return of(parser.parse(pattern), False), of(parser.parse(pattern), True)


def test_license_rules():
    table = license_scan.rules()
    gates = license_scan.gate_words(sorted({r.keyword for r in table}))
    assert len(table) > 500
    for r in table:
        for text in extremes(r.pattern):
            assert re.fullmatch(r.pattern, text), r
            assert f" {r.keyword} " in f" {text} " and gates[r.keyword] in text.split(), (r, text)
            assert len(text.split()) <= license_scan.SPAN


def test_word_bpe_is_exact():
    own = word_bpe.WordBpe(tokenizer_path(), slots=1 << 12)
    texts = ["naïve İstanbul ΣΑΣ ﬁ été 中文 x y a\x1cb it's DON'T 123 ½", "<|endoftext|> a", "", None, "\t", text_of(3000, 4), "z" * 5000] + [text_of(40, s) for s in range(60)]
    got = []
    for _ in range(2):
        got = []
        for _, ids, at in own.encode(pa.array(texts, pa.string())):
            got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [own.own.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_packing(spark, docs, empty):
    own = word_bpe.WordBpe(tokenizer_path())
    rows = fixture_rows() + [(100 + k, text_of(int(n), k)) for k, n in enumerate(RNG.integers(1, 900, 120))]
    got = [r for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path(), window=1024).collect()]
    want = Counter()
    for i, t in rows:
        ids = np.array([*own.own.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for lo in range(0, len(ids), 1024):
            want[(i, lo, len(ids[lo : lo + 1024]), zlib.crc32(ids[lo : lo + 1024].tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    padded = sum(1024 - e for e in ends.values() if e & (e - 1))
    assert max(ends.values()) <= 1024 and padded < 0.05 * sum(ends.values())
    assert packing.pack(empty, tokenizer_path()).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.integers(1, 400), max_size=30))
def test_plans_use_every_piece(histogram):
    planned = packing.plan(histogram, 256)
    used = Counter()
    for lengths, times in planned:
        assert sum(lengths) <= 256 and times > 0
        for v in lengths:
            used[v] += times
    assert dict(used) == histogram


def test_warc(spark, tmp_path):
    big, small = "<html>" + "b" * 2000, "<html>s"
    rows = [(1, "http://a/", big), (2, "http://b/\nx", big), (3, "http://c/", small), (4, "http://d/", small), (5, None, None), (6, "http://e/", ""), (7, "http://f/", "é" * 600 + "\r\n\r\nWARC/1.1"), (2, "http://b/", big), (None, "http://n/", big)]
    rows += [(100 + k, f"http://h/{k}", f"<html><body>{text_of(300, k)}") for k in range(60)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, refers_to string")
    folder = f"file://{tmp_path}/warc"
    told = warc.write_archives(pages, folder, sample_bytes=20_000, dictionary_bytes=4096, roll_bytes=100_000)
    assert told.count() == len(rows)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(spark, folder).collect())
    last = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if len(data) >= 1000 and i is not None:
            last[data] = max(i, last.get(data, i))
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        keep = last.get(data, i)
        want[(i, len(data), hashlib.sha1(data).hexdigest(), "response" if i == keep else "revisit", None if i == keep else keep)] += 1
    assert got == want
    files = sorted((tmp_path / "warc").glob("*.warc.zst"))
    assert any(f.read_bytes()[:4] == bytes.fromhex("5d2a4d18") for f in files)
    (tmp_path / "warc" / "part-00000-999-0000.warc.zst").write_bytes(files[0].read_bytes())  # of a lost attempt
    assert warc.read_archives(spark, folder).count() == len(rows)
    warc.write_archives(pages.filter("false"), f"file://{tmp_path}/none")
    assert warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0


def test_fingerprints(spark, docs, empty):
    rows = [(i, t) for i, t in fixture_rows() if i is not None and i != 10]
    got = {r.doc_id: r for r in phrase_fingerprint.edited_likeness(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    down = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(down):
        t, following = t or "", down[(k + 1) % len(down)][1] or ""
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        a, b = phrase_fingerprint.write(phrase_fingerprint.sketches([t, edited]))
        assert (got[i].n_chars, got[i].fingerprint, got[i].edited_fingerprint) == (len(t), a, b)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].near_edited == pytest.approx(phrase_fingerprint.likeness(a, b))
        assert got[i].near_next == pytest.approx(phrase_fingerprint.likeness(a, got[down[(k + 1) % len(down)][0]].fingerprint))
    assert got[1].fingerprint == got[2].fingerprint
    assert phrase_fingerprint.edited_likeness(empty).count() == 0
    assert phrase_fingerprint.edited_likeness(docs).count() == docs.count()
    assert phrase_fingerprint.fingerprints(docs.drop("n_lines")).columns == ["doc_id", "text", "component_id", "fingerprint"]


def plain_phrases(symbols):
    """The phrases of one sequence as tuples, symbol by symbol."""
    runs = []
    for x in symbols:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    key = [x if n == 1 else (x, n) for x, n in runs]
    own = [int(phrase_fingerprint._joined(np.array([x], dtype=np.uint64), np.array([n]))[0]) for x, n in runs]
    label = own
    for step in range(4):
        left = [label[0] ^ 1, *label[:-1]]
        bit = [((a ^ b) & -(a ^ b)).bit_length() - 1 for a, b in zip(label, left, strict=True)]
        label = [2 * k + (a >> k & 1) for k, a in zip(bit, label, strict=True)]
    starts = [0] + [i for i in range(1, len(label) - 1) if label[i - 1] < label[i] > label[i + 1]]
    return [tuple(key[a:b]) for a, b in zip(starts, [*starts[1:], len(key)], strict=True)]


SEQUENCES = st.lists(st.tuples(st.integers(97, 104), st.integers(1, 3)), min_size=1, max_size=120).map(lambda x: "".join(chr(c) * n for c, n in x))


@settings(max_examples=60, deadline=None)
@given(SEQUENCES)
def test_phrases_against_a_plain_parse(text):
    names, offsets = phrase_fingerprint.phrases(phrase_fingerprint._symbols(text), np.array([0, len(text)]))
    want = plain_phrases([ord(c) for c in text])
    assert len(names) == len(want) == offsets[-1]
    by = {}
    assert all(by.setdefault(w, int(n)) == int(n) for w, n in zip(want, names, strict=True)) and len(set(by.values())) == len(by)


@settings(max_examples=60, deadline=None)
@given(SEQUENCES, st.integers(1, 40))
def test_a_text_in_pieces_is_parsed_as_a_whole(text, segment):
    own = phrase_fingerprint._symbols(text)
    parser = phrase_fingerprint.Parser()
    got = [parser.feed(own[lo : lo + segment], lo + segment >= len(own)) for lo in range(0, len(own), segment)]
    assert np.concatenate(got).tolist() == phrase_fingerprint.phrases(own, np.array([0, len(own)]))[0].tolist()
    assert (phrase_fingerprint.sketches([text, "", text], segment) == phrase_fingerprint.sketches([text, "", text])).all()


def test_long_texts_have_no_cuts():
    text = text_of(120_000, 77) + "z" * 700_000 + text_of(9_000, 78)
    assert len(text) > 2 * phrase_fingerprint.SEGMENT
    whole = phrase_fingerprint.sketches([text], len(text))
    assert (phrase_fingerprint.sketches([text]) == whole).all()
    names = lambda t, segment: {int(x) for p in [phrase_fingerprint.Parser()] for lo in range(0, len(t), segment) for x in p.feed(phrase_fingerprint._symbols(t[lo : lo + segment]), lo + segment >= len(t))}
    a, b = names(text, phrase_fingerprint.SEGMENT), names("shifted by a few: " + text, phrase_fingerprint.SEGMENT)
    assert len(a ^ b) < 12


def test_parsing_is_locally_consistent():
    one = text_of(400, 9)
    for shift in ("", "q", "qrs tu", "zz" * 40):
        text = (shift + one).encode("utf-32-le")
        symbols = np.frombuffer(text, dtype=np.uint32).astype(np.uint64)
        names, _ = phrase_fingerprint.phrases(symbols, np.array([0, len(symbols)]))
        if not shift:
            first = names.tolist()
        assert first[8:] == names.tolist()[-len(first) + 8 :]


def test_importance(spark, docs, empty):
    table = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    kept = {r.doc_id for r in importance.resample(table, labels, whole_rows=False).select("doc_id").collect()}
    named = labels.collect()
    share = lambda q: np.mean([r.doc_id in kept for r in named if r.quality == q])
    assert share(1) > 0.95 and share(0) < 0.25
    ranked = importance.resample(table, labels, k=1000, whole_rows=False).orderBy(F.desc("gumbel_key")).limit(100)
    assert importance.resample(table, labels, k=100).count() == 100 == ranked.count()
    none = labels.filter("false")
    assert importance.resample(docs, none).count() == docs.count()
    assert importance.resample(empty, none).count() == 0
    assert importance.resample(docs, none).columns == [*docs.columns, "log_weight", "gumbel_key"]


def brute_resample(spark, rows, labels, buckets=1 << 16, most=20_000, temperature=0.05, seed=17, k=None):
    """Places of the rows that stay: models, weights, threshold, draws and the k largest keys, one text at a time."""
    feats = []
    for _, t in rows:
        h = [int(x) for _, hs, _, _, _ in words(pa.array([t], pa.string()), WHITE) for x in hs]
        one = [x % buckets for x in h]
        two = [int(text_arrays.mix(np.array([(3 * a + b) % 2**64], dtype=np.uint64))[0]) % buckets for a, b in zip(h, h[1:], strict=False)]
        feats.append(one + two)
    named = {}
    for i, q in labels:
        if i is not None and q is not None:
            named[i] = min(q, named.get(i, q))
    order = spark.createDataFrame([(i,) for i in named], "doc_id long").select("doc_id", F.xxhash64(F.lit(seed), "doc_id").alias("h")).collect()
    chosen = sorted((r.h, r.doc_id) for r in order)[:most]
    test = {i for h, i in chosen if h % 5 == 0}
    fit = {i for h, i in chosen if h % 5 != 0 and named[i] == 1}
    target, raw = Counter(), Counter()
    for (i, _), f in zip(rows, feats, strict=True):
        raw.update(f)
        if i in fit:
            target.update(f)
    logs = lambda c: {b: np.log((c[b] + 1) / (sum(c.values()) + buckets)) for b in raw}
    p, q = logs(target), logs(raw)
    weight = [sum(p[b] - q[b] for b in f) / np.sqrt(len(f)) if f else 0.0 for f in feats]
    keys = []
    for (i, _), w in zip(rows, weight, strict=True):
        u = int(text_arrays.mix(np.array([((i if i is not None else -1) * 0x9E3779B97F4A7C15 + seed) % 2**64], dtype=np.uint64))[0]) >> 11
        keys.append(w / temperature - np.log(-np.log((u + 0.5) / 2.0**53)))
    if k is None:
        best = {}
        for (i, _), w in zip(rows, weight, strict=True):
            if i in test:
                best[i] = max(w, best.get(i, w))
        good, bad = ([w for i, w in best.items() if (named[i] == 1) == yes] for yes in (True, False))
        cut = min(good) if good and not bad else float("-inf")
        if good and bad:
            gain = lambda c: sum(w < c for w in bad) / len(bad) - 4 * sum(w < c for w in good) / len(good)
            cut = max(sorted(set(good + bad)), key=gain)
        k = sum(w >= cut - 1e-9 for w in weight)
    if k <= 0 or not rows:
        return []
    least = sorted(keys, reverse=True)[min(k, len(rows)) - 1]
    return [n for n, x in enumerate(keys) if x >= least - 1e-9]


def test_importance_against_brute_force(spark, docs):
    rows = fixture_rows() + [(100 + k, text_of(int(n), 500 + k)) for k, n in enumerate(np.random.default_rng(9).integers(1, 80, 60))]
    labels = [(i, int(i % 3 > 0)) for i in range(1, 160)] + [(101, 0), (None, 1), (110, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    for k, buckets in ((None, 1 << 16), (7, 1 << 10), (1000, 64)):
        want = Counter(rows[n] for n in brute_resample(spark, rows, labels, buckets, k=k))
        assert Counter((r.doc_id, r.text) for r in importance.resample(table, told, k=k, buckets=buckets).collect()) == want


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=1, max_size=50), st.integers(1, 60))
def test_largest_key(spark, values, k):
    got = importance.largest_key(spark.createDataFrame([(v,) for v in values], "gumbel_key double"), k, bins=3)
    assert got == sorted(values, reverse=True)[min(k, len(values)) - 1]


def test_decontamination(spark, docs, empty):
    items = [(1, text_of(30, 50)), (2, text_of(12, 51)), (3, None), (4, "!!"), (5, "tiny item"), (None, text_of(9, 52))]
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    one = items[0][1].split()
    edited = [*one[:3], "changed", *one[4:]]
    half = one[:15]
    rows = [(1, "lead in " + items[0][1].translate({v: k for k, v in LOWER.items()}) + " tail"), (2, text_of(50, 60) + "\n" + " ".join(edited) + " x"), (3, " ".join(half) + " " + text_of(30, 61)), (4, None), (5, ""), (6, items[1][1]), (6, items[1][1]), (7, "a tiny, item b"), (8, text_of(20_000, 62)), (None, items[0][1]), (9, items[3][1])]
    table = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, item_id string")
    for size in (8 << 20, 100):
        got = decontamination.contaminated(table, bench, block_bytes=size).collect()
        pairs = Counter((r.doc_id, r.item_id) for r in got)
        assert pairs == Counter([(1, 1), (2, 1), (6, 2), (6, 2), (7, 5), (None, 1)])
        assert {r.similarity for r in got if r.doc_id == 1} == {1.0}
        left = decontamination.without_contaminated(table, bench, block_bytes=size)
        assert left.columns == table.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 8, 9]
    assert decontamination.contaminated(empty, bench).count() == 0
    assert decontamination.without_contaminated(table, bench.filter("false")).count() == len(rows)


def test_decontamination_weighs_by_all_items(spark):
    common = [f"c{k}" for k in range(29)]
    items = [(i, " ".join([*[f"i{i}w{k}" for k in range(29)], *common])) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, " ".join([*t.split()[:29], *common[:12], *[f"x{i}y{k}" for k in range(17)]])) for i, t in items]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    whole, blocks = ({(r.doc_id, r.item_id): (r.first_word, r.n_words, r.distance, r.similarity) for r in decontamination.contaminated(table, bench, block_bytes=size).collect()} for size in (8 << 20, 5000))
    assert len(whole) > 30 and blocks == whole
    assert decontamination.without_contaminated(table, bench, block_bytes=5000).count() == 40 - len(whole)


def brute_matches(text, index, width, least):
    """{item: largest similarity} over all windows of the item's words."""
    own, out = [h[at[0] : at[-1]] for _, h, at, _, _ in words(pa.array([text]), PUNCT)][0], {}
    for c, i in enumerate(index.ids):
        k = int(index.width[c])
        mass = index.weight[np.searchsorted(index.common, index.shingles[c])]
        if len(own) >= k:
            runs = shingles(own, k)
            m = min(int(index.sizes[c]) - k + 1, len(runs))
            best = max(mass[np.isin(index.shingles[c], runs[s : s + m])].sum() / mass.sum() for s in range(len(runs) - m + 1))
            if best >= least:
                out[i] = best
    return out


def test_decontamination_against_brute_force():
    rng = np.random.default_rng(4)
    pool = [f"v{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(pool, int(rng.integers(1, 40))))) for k in range(40)]
    items += [(100 + k, items[k][1] + " and more of it") for k in range(20)]
    index = decontamination.build_index(items, 17)
    n, found = 0, 0
    for i, t in items:
        for edits in range(4):
            w = t.split()
            for _ in range(edits):
                w[int(rng.integers(len(w)))] = f"e{rng.integers(99)}"
            text = " ".join([*rng.choice(pool, int(rng.integers(0, 30))), *w, *rng.choice(pool, 20)])
            want = brute_matches(text, index, 5, 0.8)
            got = {index.ids[c]: x for c, _, _, x in decontamination._find(index, next(words(pa.array([text]), PUNCT))[1], 5, 17, 0.8)}
            all_of = {index.ids[c]: x for c, _, _, x in decontamination._find(index, next(words(pa.array([text]), PUNCT))[1], 5, 64, 0.8)}
            assert all_of == pytest.approx(want)  # with every print in reach, windows and verification are exact
            assert set(got) <= set(want)
            if not edits:
                assert i in got
            n, found = n + len(want), found + len(got)
    assert found > 0.95 * n > 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=20), st.lists(st.integers(0, 63), max_size=20), st.integers(0, 22))
def test_blocks_miss_no_print_within_the_radius(prints, bits, radius):
    items = np.array(prints, dtype=np.uint64)
    asked = np.array([x ^ sum(1 << b for b in set(bits[:k])) for k, x in enumerate(prints * 2)], dtype=np.uint64)
    got = decontamination.within_radius(asked, decontamination._cells(items), items, radius)
    want = [(a, b) for a, x in enumerate(asked.tolist()) for b, y in enumerate(prints) if (x ^ y).bit_count() <= radius]
    assert list(zip(*(g.tolist() for g in got), strict=True)) == want


def test_rolling_simhash_equals_one_window_at_a_time():
    rng = np.random.default_rng(6)
    h, w = rng.integers(0, 2**63, 300).astype(np.uint64) * np.uint64(3), rng.integers(1, 5000, 300).astype(np.int32)
    for m in (1, 7, 300):
        got = decontamination.simhashes(h, w, m)
        for s in (0, (300 - m) // 2, 300 - m):
            want = sum(1 << b for b in range(64) if sum(int(x) * (1 if int(y) >> b & 1 else -1) for x, y in zip(w[s : s + m], h[s : s + m], strict=True)) > 0)
            assert int(got[s]) == want


def test_decontamination_finds_every_exact_passage(spark):
    table, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    held = {(d.doc_id, b.item_id) for d in table.collect() for b in bench.collect() if b.text in (d.text or "")}
    assert held <= {(r.doc_id, r.item_id) for r in decontamination.contaminated(table, bench).collect()}


def brute_spans(rows, min_words, hashes):
    first, own = {}, []
    for i, h, t in sorted({(r[0], hashes[r[1]], r[1]) for r in rows if r[0] is not None and r[1]}):
        lo, k, mine = 0, 0, []
        for hi in span_dedup.units(t):
            w = tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t[lo:hi].translate(LOWER)))
            if w:
                first.setdefault(w, (i, h, lo))
                first[w] = min(first[w], (i, h, lo))
                mine.append(((i, h), k, lo, hi, w))
                k += 1
            lo = hi
        own += [(*m, len(mine)) for m in mine]
    out, run = [], []
    for key, k, lo, hi, w, of in [*own, (None, 0, 0, 0, (), 0)]:
        later = key is not None and first[w] != (*key, lo)
        if run and not (later and key == run[-1][0] and k == run[-1][1] + 1):
            if sum(len(r[4]) for r in run) >= min_words or len(run) == run[0][5]:
                kept = first[run[0][4]]
                out.append((run[0][0][0], run[0][2], run[-1][3], sum(len(r[4]) for r in run), kept[0], kept[2], run[0][0][1]))
            run = []
        if later:
            run.append((key, k, lo, hi, w, of))
    return sorted(out)


def test_span_dedup(spark, empty):
    passage = "Été one two three. Four five six! Seven\neight nine ten eleven twelve."
    rows = [(5, "Own start here. " + passage + " Own end."), (3, passage), (9, "Short one. " + passage + "\n" + passage), (11, "Own start here. nothing"), (12, None), (13, ""), (14, "..."), (3, passage), (None, passage)]
    rows += [(20 + k, text_of(40, k % 3)) for k in range(6)]
    rows += [(30, "Four five six!"), (31, "Four five six! Own tail."), (40, text_of(3000, 7)), (41, text_of(3000, 7))]
    table = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, start int")
    hashes = {r.text: r.h for r in table.select("text", F.xxhash64("text").alias("h")).collect()}
    for least in (1, 8, 20):
        got = span_dedup.repeated_spans(table, min_words=least)
        assert sorted(tuple(r) for r in got.collect()) == brute_spans(rows, least, hashes)
    cut = {r.doc_id: r for r in span_dedup.remove_spans(table, got.filter("false").unionByName(span_dedup.repeated_spans(table, min_words=8))).collect()}
    assert cut[5].text == "Own start here. Own end." and cut[3].text == passage and cut[12].text is None
    assert cut[30].text == "" and cut[31].text == "Four five six! Own tail." and cut[41].text == ""
    assert span_dedup.repeated_spans(empty).count() == 0


def test_span_dedup_of_ids_with_different_texts(spark):
    passage = " ".join(f"w{k}" for k in range(13)) + "."
    rows = [(1, passage), (2, passage), (2, "Zz yy xx. " + passage), (2, passage)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {r.text: r.h for r in table.select("text", F.xxhash64("text").alias("h")).collect()}
    got = span_dedup.repeated_spans(table, min_words=5)
    assert sorted(tuple(r) for r in got.collect()) == brute_spans(rows, 5, hashes)
    assert sorted(r.text for r in span_dedup.remove_spans(table, got).collect()) == ["", "", "Zz yy xx. ", passage]


def test_language_id(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    langs = ["de", "en", "es", "fr"]
    model = language_id.train(table.filter("doc_id % 2 = 0"), langs)
    held = {r.doc_id: r.lang for r in table.filter("doc_id % 2 = 1").collect()}
    got = {r.id: r.lang for r in language_id.identify(language_id.document_rows(table.filter("doc_id % 2 = 1")), model, langs).collect()}
    assert np.mean([got[i] == lang for i, lang in held.items()]) > 0.95
    pages = [(1, "http://x.example.com/fr/1", '<html lang="fr"><body></body>'), (2, "http://x.example.com/fr/2", None), (3, None, ""), (4, "not a url", '<HTML LANG=de><p>x'), (1, "http://x.example.com/fr/1", '<html lang="fr"><body></body>')]
    rows = language_id.page_rows(spark.createDataFrame(pages, "page_id long, url string, html string"), langs)
    told = {r.id: r for r in language_id.identify(rows, model, langs, html=True).collect()}
    assert told[1].lang == "fr" and told[4].declared == "de" and told[2].address == "fr" and len(told) == 4
    assert language_id.identify(rows.filter("false"), model, langs).count() == 0


def test_visible_text():
    cases = {
        "<p>one</p>two": " one two",
        "a<!-- x > y -->b": "a b",
        "a<!-- x > y": "a y",
        "<script>if (a < b) c</SCRIPT >t": " t",
        "<script>if (a > b": "if (a > b",
        "<Head><title>t</title></head>z<header>h": " z h",
        "1 < 2": "1 < 2",
        "": "",
        "q&amp;r": "q r",
    }
    for html, want in cases.items():
        assert language_id.visible_text(html).split() == want.split(), html
    for long in ("<!-- x" * 200_000, "<script>" * 200_000, "<" * 1_000_000, "<style><!--" * 100_000 + "tail"):
        language_id.visible_text(long)  # quadratic time would not end


def brute_languages(rows, model, languages, bound=30.0, strength=4.0):
    """(lang, confidence) by row: plain sums over the other rows of host, domain, suffix and corpus."""
    n, seen = len(languages), []
    for _, text, declared, address, host in rows:
        f = [int(h % np.uint64(model.shape[1])) for _, hs, _, _, _ in words(pa.array([text], pa.string()), PUNCT) for h in hs]
        s = model[:, f].sum(axis=1) if f else np.zeros(n)
        e = bound * np.tanh((s - s.max()) / bound)
        p = np.exp(e - e.max())
        host = host or ""
        parts = host.split(".")
        known = [x.lower() if x and x.lower() in languages else None for x in (declared, address)]
        seen.append((e, p / p.sum(), known, host, ".".join(parts[-2:]), parts[-1]))
    out = []
    for k, (e, _, known, *own) in enumerate(seen):
        prior = np.full(n, 1.0 / n)
        for at, by in ((None, n), (2, strength), (1, strength), (0, strength)):
            rest = sum((x[1] for j, x in enumerate(seen) if j != k and (at is None or x[3 + at] == own[at])), np.zeros(n))
            prior = (rest + by * prior) / (rest.sum() + by)
        score = e + np.log(prior)
        for c in (0, 1):
            counts = np.eye(n) * 2 + 0.5
            for x in seen:
                if x[2][c]:
                    counts[languages.index(x[2][c])] += x[1]
            if known[c]:
                score = score + np.log(counts / counts.sum(axis=0))[languages.index(known[c])]
        post = np.exp(score - score.max())
        post /= post.sum()
        out.append((languages[int(post.argmax())], post.max()))
    return out


def test_language_id_against_brute_force(spark, empty):
    langs = ["de", "en", "es", "fr"]
    table = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60)
    model = language_id.train(table, langs, buckets=512)
    hosts = ["a.x.de", "b.x.de", "x.de", "blog.example.com", "www.example.com", "lonely.org", None, ""]
    rng = np.random.default_rng(2)
    rows = [(k, r.text[: int(rng.integers(0, 80))], rng.choice(["de", "FR", "xx", None]), rng.choice(["es", None]), rng.choice(hosts)) for k, r in enumerate(table.collect())]
    rows += [(100, None, None, None, "alone.net"), (101, "", "de", None, "alone2.net"), (102, text_of(30_000, 5), None, None, None), (5, *rows[5][1:])]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "id long, text string, declared string, address string, host string, p string").repartition(3)
    got = {(r.id, r.lang, round(r.confidence, 9)) for r in language_id.identify(frame, model, langs).collect()}
    want = brute_languages(rows, model, langs)
    assert got == {(r[0], lang, round(float(x), 9)) for r, (lang, x) in zip(rows, want, strict=True)}
    assert language_id.identify(frame, model, langs).count() == len(rows)


def test_language_declared_late_in_a_page(spark):
    pages = [(1, "http://x.example.com/a", "<!-- " + "licence " * 400 + '--><html lang="fr"><body></body></html>'), (2, "http://x.example.com/b", " " * 30_000 + "<HTML class=x LANG=de><p>x"), (3, "http://x.example.com/c", "<!-- " + "x" * 3000 + "--><html><body></body></html>")]
    rows = language_id.page_rows(spark.createDataFrame(pages, "page_id long, url string, html string"), ["de", "en", "fr"])
    assert {r.id: r.declared for r in rows.collect()} == {1: "fr", 2: "de", 3: None}


def test_small_archives_have_a_dictionary():
    for n in (1, 3):
        records = [warc.record(i, f"http://x.example.com/{i}", b"<html>same words in all pages" * 9, None) for i in range(n)]
        writer = warc.Writer()
        for x in records:
            writer.add(x)
        data = writer.close()
        assert data[:4] == warc.DICTIONARY_MAGIC.to_bytes(4, "little")
        assert list(warc.read_archive(data)) == records


def test_scratch_tables_live_in_a_shared_folder(spark):
    assert scratch.new_path(spark, "t").startswith(scratch.checkpoint_root(spark))


def test_temporary_tables_of_one_run_leave_others_alone(spark):
    outer = scratch.table(spark.range(5), "outer")
    with scratch.temporary(spark):
        inner = scratch.table(spark.range(7), "inner")
        with scratch.temporary(spark):
            assert scratch.table(spark.range(3), "nested").count() == 3
        assert inner.count() == 7
    assert outer.count() == 5
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        inner.count()


def test_slices_keep_all_rows_in_order():
    texts = ["x" * int(n) for n in RNG.integers(0, 400_000, 60)] + ["y" * (5 << 20), None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["i", "t"])
    parts = list(worker.slices(iter([batch, batch.slice(0, 0)])))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(len(texts)))
    assert [x for p in parts for x in p.column(1).to_pylist()] == texts
    assert all(p.nbytes <= worker.SLICE or p.num_rows == 1 for p in parts)
