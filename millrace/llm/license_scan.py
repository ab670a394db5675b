"""License scan: ordered signature rules behind keyword gates, with containment suppression."""

from __future__ import annotations

import json
from collections import Counter
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch
from millrace.llm.license_signatures import BODIES
from millrace.llm.line_dedup import lower_ascii

#: Words that a match may have at most, and words whose detections are settled together.
SPAN = 64
OWN = 128


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str  # whole words; a rule is tried only where they stand
    pattern: str  # over lower-case words with one space between


#: Labels and the names under which texts cite the licences (as words).
NAMES = {
    "mit": ["mit license", "mit licence", "expat license"],
    "apache": ["apache license", "apache software license", "asl"],
    "gpl": ["gnu general public license", "general public license", "gnu gpl", "gpl"],
    "lgpl": ["gnu lesser general public license", "lesser general public license", "gnu lgpl", "lgpl"],
    "agpl": ["gnu affero general public license", "affero general public license", "gnu agpl", "agpl"],
    "bsd": ["bsd license", "berkeley software distribution license"],
    "mpl": ["mozilla public license", "mpl"],
    "epl": ["eclipse public license", "epl"],
    "cddl": ["common development and distribution license", "cddl"],
    "isc": ["isc license"],
    "zlib": ["zlib license", "zlib libpng license"],
    "boost": ["boost software license"],
    "unlicense": ["unlicense"],
    "wtfpl": ["do what the fuck you want to public license", "wtfpl"],
    "artistic": ["artistic license"],
    "cc-by": ["creative commons attribution", "cc by"],
    "cc-by-sa": ["creative commons attribution share alike", "creative commons attribution sharealike", "cc by sa"],
    "cc-by-nc": ["creative commons attribution noncommercial", "creative commons attribution non commercial", "cc by nc"],
    "cc0": ["creative commons zero", "cc0"],
    "gfdl": ["gnu free documentation license", "gfdl"],
    "ofl": ["sil open font license", "open font license"],
    "postgresql": ["postgresql license"],
    "psf": ["python software foundation license"],
    "ms-pl": ["microsoft public license"],
    "eupl": ["european union public licence", "european union public license", "eupl"],
}

#: Versions that are cited for a licence.
VERSIONS = {
    "apache": ["1.0", "1.1", "2.0"],
    "gpl": ["1.0", "2.0", "3.0"],
    "lgpl": ["2.0", "2.1", "3.0"],
    "agpl": ["1.0", "3.0"],
    "mpl": ["1.0", "1.1", "2.0"],
    "epl": ["1.0", "2.0"],
    "cddl": ["1.0", "1.1"],
    "boost": ["1.0"],
    "artistic": ["1.0", "2.0"],
    "cc-by": ["2.0", "3.0", "4.0"],
    "cc-by-sa": ["2.0", "3.0", "4.0"],
    "cc-by-nc": ["2.0", "3.0", "4.0"],
    "cc0": ["1.0"],
    "gfdl": ["1.1", "1.2", "1.3"],
    "ofl": ["1.0", "1.1"],
    "eupl": ["1.1", "1.2"],
}

_VERBS = "(?:licensed|released|distributed|published|available|provided|covered)"
_UNDER = f"{_VERBS} under (?:the )?(?:terms of (?:the )?)?"


def _version(v: str) -> str:
    """2.0 as "2 0", "2", "v2 0", "version 2" and so on."""
    major, minor = v.split(".")
    return f"(?:version |v )?v?{major}" + (f"(?: {minor})?" if minor == "0" else f" {minor}")


def rules() -> list[Rule]:
    """Every signature, in order: for each licence its names, notices, identifiers and versions, then those written
    by hand.  The longer of these are texts of licences, the others names of rarer ones."""
    out = []
    for label, names in NAMES.items():
        for name in names:
            out.append(Rule(label, 1, name, name))
            out.append(Rule(label, 2, name, _UNDER + name))
            for v in VERSIONS.get(label, []):
                out.append(Rule(f"{label}-{v}", 3, name, f"{name} {_version(v)}"))
                out.append(Rule(f"{label}-{v}", 4, name, f"{_UNDER}{name} {_version(v)}"))
        tag = label.replace("-", " ")
        out.append(Rule(label, 4, "spdx license identifier", f"spdx license identifier {tag}"))
        for v in VERSIONS.get(label, []):
            out.append(Rule(f"{label}-{v}", 5, "spdx license identifier", f"spdx license identifier {tag} {v.replace('.', ' ')}(?: (?:only|or later))?"))
    return out + [Rule(label, 5 if text.count(" ") >= 5 else 3, key, text) for label, key, text in BODIES]


#: Words that most texts have, which gate nothing if a keyword has another.
_COMMON = set("a all an and any are as at be by do for from in is it me my no not of on only or that the this to under use we what with you".split())


def gate_words(keywords: list[str]) -> dict[str, str]:
    """For each keyword one of its words, so that few words gate all."""
    words = {k: [w for w in k.split() if len(w) > 1 and w not in _COMMON] or k.split() for k in keywords}
    out: dict[str, str] = {}
    while len(out) < len(words):
        count = Counter(w for k, own in words.items() if k not in out for w in set(own))
        best = max(count, key=lambda w: (count[w], w))
        out |= {k: best for k, own in words.items() if k not in out and best in own}
    return out


def normalised_words(text: Column) -> Column:
    """The words, A-Z lower-cased, with one space between."""
    return F.btrim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _let(value: Column, f) -> Column:
    """f of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def over_places(pattern: str) -> str:
    """The pattern over words that carry their place (``word U+0001 place``): all its starts, as group 1."""
    return "(?<= )(?=((?:" + pattern.replace(" ", r"(?:\x01\d+ )") + r")\x01\d+) )"


def _places(marked: Column, pattern: Column) -> Column:
    """(start, end) in words, of each place where a match of the pattern starts."""
    start = lambda m: F.regexp_extract(m, r"\x01(\d+)", 1).cast("int")
    end = lambda m: F.substring_index(m, "\x01", -1).cast("int") + 1
    return F.transform(F.regexp_extract_all(marked, pattern, F.lit(1)), lambda m: F.struct(start(m).alias("start"), end(m).alias("end")))


_FOUND = "array<struct<start:int,end:int,label:string,priority:int,base:boolean,rank:int>>"
_KEPT = "array<struct<start:int,end:int,label:string,priority:int,base:boolean>>"


def scan_licenses(docs: DataFrame, text_col: str = "text", base: dict[str, str] | None = None, table: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``n_words`` (long) and ``detections``, an array of
    ``struct<start,end,label,priority,base>`` in order of place.

    Words are runs of characters other than ASCII marks, blanks and controls; starts and ends
    count words from 0, ends excluded.  A rule is tried at every word.  ``base`` (phrase to label) are rules
    that nothing suppresses and that suppress nothing.  Of the others, a detection goes if one of higher priority (or of the same and
    longer, or of the same length and named first) covers its whole interval.  A null or empty text has
    no words.  Rows do not touch each other, so repeated rows, empty tables and skew need no care;
    other columns pass through, and ``n_words`` or ``detections`` among them are replaced.

    Plan: one pass, no shuffle, no Python.  A look-up of the text's words among the gate words lets most
    texts skip the rules.  Others are taken in segments of ``OWN`` words, with ``SPAN`` words (no match has
    more) at both ends; what starts in a segment is settled there, so time is linear in the length of
    a text.  Words carry their places, so a match tells where it is.  Behind the gate, each rule has its own keyword.
    """
    table = rules() if table is None else table
    base = base or {}
    ranked = [(r, False) for r in table] + [(Rule(label, 1, phrase, phrase), True) for phrase, label in base.items()]
    gates = gate_words(sorted({r.keyword for r, _ in ranked}))
    told = [{"rank": i, "label": r.label, "priority": r.priority, "gate": gates[r.keyword], "keyword": f" {r.keyword} ", "pattern": over_places(r.pattern), "base": b} for i, (r, b) in enumerate(ranked)]
    # One text for Spark to fold into one literal, as building it of columns takes seconds.
    rows = F.from_json(F.lit(json.dumps(told)), "array<struct<rank:int,label:string,priority:int,gate:string,keyword:string,pattern:string,base:boolean>>")
    gate = F.array(*[F.lit(w) for w in sorted(set(gates.values()))])

    out = docs.drop("n_words", "detections")
    words, passed = scratch.unused("words", out), scratch.unused("passed", out)

    def of(rule: Column, marked: Column) -> Column:
        place = lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), rule["label"].alias("label"), rule["priority"].alias("priority"), rule["base"].alias("base"), rule["rank"].alias("rank"))
        return F.transform(_places(marked, rule["pattern"]), place)

    def stays(d: Column, found: Column) -> Column:
        covers = lambda o: reduce(lambda x, y: x & y, (~o["base"], o["start"] <= d["start"], o["end"] >= d["end"]))
        size = lambda x: x["end"] - x["start"]
        better = lambda o: (o["priority"] > d["priority"]) | ((o["priority"] == d["priority"]) & ((size(o) > size(d)) | ((size(o) == size(d)) & (o["rank"] < d["rank"]))))
        return d["base"] | ~F.exists(found, lambda o: covers(o) & better(o))

    def segment(k: Column) -> Column:
        first = F.greatest(k * OWN - SPAN, F.lit(0))
        own = F.slice(words, first + 1, OWN + 2 * SPAN)

        def search(part: Column) -> Column:
            plain = F.concat(F.lit(" "), F.array_join(part, " "), F.lit(" "))
            marked = F.concat(F.lit(" "), F.array_join(F.transform(part, lambda w, i: F.concat(w, F.lit("\x01"), (i + first).cast("string"))), " "), F.lit(" "))
            there = F.array_intersect(gate, part)
            live = lambda text, open_: F.filter(rows, lambda r: F.array_contains(open_, r["gate"]) & F.contains(text, r["keyword"]))
            found = lambda text, places, open_: F.flatten(F.transform(live(text, open_), lambda r: of(r, places)))
            kept = lambda f: F.filter(f, lambda d: (d["start"] >= k * OWN) & (d["start"] < (k + 1) * OWN) & stays(d, f))
            none = F.array().cast(_FOUND)
            both = lambda open_: F.when(F.size(open_) == 0, none).otherwise(_let(plain, lambda text: _let(marked, lambda places: _let(found(text, places, open_), kept))))
            return _let(there, both)

        return _let(own, search)

    out = out.withColumn(words, normalised_words(F.col(text_col)))
    out = out.withColumn(words, F.when(F.col(words) == "", F.array().cast("array<string>")).otherwise(F.split(words, " ")))
    out = out.withColumn("n_words", F.size(words).cast("long")).withColumn(passed, F.arrays_overlap(words, gate))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.col("n_words") - 1) / OWN).cast("int")), segment)
    order = lambda found: F.array_sort(F.transform(F.flatten(found), lambda d: F.struct(*[d[c].alias(c) for c in ("start", "end", "label", "priority", "base")])))
    return out.withColumn("detections", F.when(F.col(passed), order(parts)).otherwise(F.array().cast(_KEPT))).drop(words, passed)
