"""License scans by ordered signature rules, in built-in functions only.

Hundreds of regular expressions, each with a label, a priority, a weight and keywords. A text
runs a rule only if its words hold the rule's keywords (one set intersection per text, so that
texts without keywords run none). Every rule gives word intervals. Overlaps are resolved per
text: an interval inside another one goes; of one interval the better priority stays; where two
overlap in part, the better priority stays.

The rules read words with their places ("mit@4 license@5"), so that capture groups give places.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Base phrases (fixed values): words, label, the word that gates the search.
BASE = ((("cc", "by"), "cc-by", "cc"),
        (("general", "public", "license"), "gpl", "license"),
        (("all", "rights", "reserved"), "reserved", "reserved"))
BASE_WEIGHT = 0.9

#: License names: label, name (regular expressions of words), gating words, versions.
NAMES = (
    ("mit", "mit", ("mit",), ()),
    ("apache", "apache(?: software)?", ("apache",), ("1 0", "1 1", "2 0")),
    ("bsd", "bsd", ("bsd",), ("2 clause", "3 clause", "4 clause", "0 clause")),
    ("gpl", "gnu general public", ("gnu",), ("1 0", "2 0", "3 0", "2", "3")),
    ("gpl", "gpl", ("gpl",), ("1 0", "2 0", "3 0", "2", "3")),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", ("lesser", "library"), ("2 0", "2 1", "3 0", "3")),
    ("lgpl", "lgpl", ("lgpl",), ("2 0", "2 1", "3 0", "3")),
    ("agpl", "(?:gnu )?affero general public", ("affero",), ("1 0", "3 0", "3")),
    ("agpl", "agpl", ("agpl",), ("1 0", "3 0", "3")),
    ("mpl", "mozilla public", ("mozilla",), ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", ("mpl",), ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public", ("eclipse",), ("1 0", "2 0")),
    ("cddl", "common development and distribution", ("development",), ("1 0", "1 1")),
    ("eupl", "european union public", ("european",), ("1 0", "1 1", "1 2")),
    ("isc", "isc", ("isc",), ()),
    ("zlib", "zlib(?: libpng)?", ("zlib",), ()),
    ("boost", "boost software", ("boost",), ("1 0",)),
    ("artistic", "artistic", ("artistic",), ("1 0", "2 0")),
    ("python", "python software foundation", ("python",), ("2",)),
    ("unlicense", "(?:the )?unlicense", ("unlicense",), ()),
    ("wtfpl", "wtfpl", ("wtfpl",), ("2",)),
    ("cc-by-sa", "cc by sa", ("cc",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "cc by nc", ("cc",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "cc by nd", ("cc",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "cc by", ("cc",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "creative commons attribution", ("creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "creative commons attribution share(?: |)alike", ("creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "creative commons attribution non(?: |)commercial", ("creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "creative commons attribution no(?: |)deriv(?:ative)?s", ("creative",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc0", "cc0", ("cc0",), ("1 0",)),
    ("odbl", "open database", ("database",), ("1 0",)),
    ("ofl", "sil open font", ("sil",), ("1 0", "1 1")),
    ("epl", "epl", ("epl",), ("1 0", "2 0")),
    ("cddl", "cddl", ("cddl",), ("1 0", "1 1")),
    ("eupl", "eupl", ("eupl",), ("1 0", "1 1", "1 2")),
    ("bsd", "0bsd", ("0bsd",), ()),
    ("boost", "bsl", ("bsl",), ("1 0",)),
    ("python", "psf", ("psf",), ("2 0",)),
    ("odbl", "odbl", ("odbl",), ("1 0",)),
    ("ofl", "ofl", ("ofl",), ("1 0", "1 1")),
    ("cc-by-nc-sa", "cc by nc sa", ("cc",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "cc by nc nd", ("cc",), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "creative commons attribution non(?: |)commercial share(?: |)alike", ("creative",), ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", "creative commons attribution non(?: |)commercial no(?: |)deriv(?:ative)?s", ("creative",), ("2 0", "2 5", "3 0", "4 0")),
    ("sspl", "server side public", ("server",), ("1 0", "1")),
    ("sspl", "sspl", ("sspl",), ("1 0", "1")),
    ("ms-pl", "microsoft public", ("microsoft",), ()),
    ("ms-pl", "ms pl", ("ms",), ()),
    ("ms-rl", "microsoft reciprocal", ("reciprocal",), ()),
    ("elastic", "elastic", ("elastic",), ("1 0", "2 0")),
    ("x11", "x11", ("x11",), ()),
    ("openssl", "openssl", ("openssl",), ()),
    ("php", "php", ("php",), ("3 0", "3 01")),
    ("ruby", "ruby", ("ruby",), ()),
    ("postgresql", "postgresql", ("postgresql",), ()),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", ("ncsa",), ()),
    ("afl", "academic free", ("academic",), ("2 1", "3 0")),
    ("osl", "open software", ("open",), ("2 1", "3 0")),
    ("busl", "business source", ("business",), ("1 1",)),
    ("busl", "busl", ("busl",), ("1 1",)),
    ("cecill", "cecill", ("cecill",), ("1 0", "2 0", "2 1")),
    ("gfdl", "gnu free documentation", ("documentation",), ("1 1", "1 2", "1 3")),
    ("gfdl", "gfdl", ("gfdl",), ("1 1", "1 2", "1 3")),
    ("upl", "universal permissive", ("universal",), ("1 0",)),
    ("bsd-0", "zero clause bsd", ("bsd",), ()),
    ("qpl", "q public", ("q",), ("1 0",)),
    ("polyform", "polyform noncommercial", ("polyform",), ("1 0 0",)),
    ("blueoak", "blue oak model", ("oak",), ("1 0 0",)),
)
#: Short names that are no words: in a text about a license, "and mit" or "or gpl" names another one.
SHORT_NAMES = ("mit", "bsd", "gpl", "lgpl", "agpl", "mpl", "epl", "isc", "cddl", "eupl", "wtfpl", "cc0", "sspl", "ofl", "odbl")
#: How a text names a license: words around the name, the word of them that gates (none: the name's
#: word alone), priority (smaller is better), weight.
FRAMES = tuple(
    frame for spelling in ("license", "licence") for frame in (
        (f"licensed under the {{name}} {spelling}", "licensed", 1, 1.0),
        (f"released under the {{name}} {spelling}", "released", 1, 1.0),
        (f"distributed under the {{name}} {spelling}", "distributed", 1, 1.0),
        (f"under the terms of the {{name}} {spelling}", "terms", 1, 1.0),
        (f"subject to the {{name}} {spelling}", "subject", 1, 0.95),
        (f"{spelling} {{name}}", spelling, 3, 0.8),
        (f"{{name}} {spelling}", spelling, 3, 0.8))
) + (("licensed under {name}", "licensed", 2, 0.95), ("available under (?:the )?{name}", "available", 2, 0.9),
     ("licensed under the {name}", "licensed", 2, 0.95), ("under the {name}", "", 3, 0.8),
     ("spdx license identifier {name}", "spdx", 1, 1.0))
#: Texts that stand for a license without its name: label, words, gating word, priority, weight.
PHRASES = (
    ("mit", "permission is hereby granted free of charge to any person", "hereby", 1, 1.0),
    ("mit", "the software is provided as is without warranty of any kind", "warranty", 1, 0.9),
    ("bsd", "redistribution and use in source and binary forms", "redistribution", 1, 1.0),
    ("gpl", "either version [23] of the license or at your option any later version", "license", 1, 1.0),
    ("gpl", "general public license version [123]", "license", 1, 1.0),
    ("gpl", "general public license", "license", 4, 0.9),
    ("apache", "you may not use this file except in compliance with the license", "license", 1, 1.0),
    ("cc-by", "cc by", "cc", 4, 0.9),
    ("cc-by", "creative commons attribution", "creative", 4, 0.9),
    ("cc-by-sa", "creative commons attribution share(?: |)alike", "creative", 4, 0.9),
    ("cc-by-nc", "creative commons attribution non(?: |)commercial", "creative", 4, 0.9),
    ("cc-by-nd", "creative commons attribution no(?: |)deriv(?:ative)?s", "creative", 4, 0.9),
    ("reserved", "all rights reserved", "reserved", 4, 0.9),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright", 5, 0.5),
    ("public-domain", "(?:released|placed) (?:in|into|to) the public domain", "domain", 2, 0.9),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered", 1, 1.0),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission", 1, 1.0),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "organization", 1, 1.0),
    ("zlib", "this software is provided as is without any express or implied warranty", "warranty", 1, 0.9),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla", 1, 1.0),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lesser", 1, 1.0),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "gnu", 1, 1.0),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license", "affero", 1, 1.0),
    ("wtfpl", "do what the fuck you want to public license", "license", 1, 1.0),
    ("cc0", "creative commons zero", "creative", 2, 0.9),
    ("cc0", "no rights reserved", "reserved", 3, 0.8),
    ("unlicense", "unlicense", "unlicense", 4, 0.9),
    ("proprietary", "confidential and proprietary", "proprietary", 3, 0.7),
    ("proprietary", "unauthorized (?:copying|reproduction|distribution)", "unauthorized", 3, 0.7),
)


@dataclass(frozen=True)
class Signature:
    label: str
    words: str  # a regular expression of words, one space between words
    keywords: tuple[str, ...]  # words that a text must hold, all of them
    priority: int
    weight: float


def signatures() -> list[Signature]:
    """The ordered rules: every frame of every name, with and without each version, and phrases."""
    out = [Signature(label, words, (key,), p, w) for label, words, key, p, w in PHRASES]
    for label, name, keys, versions in NAMES:
        for key in keys:
            out += [Signature(label, f.format(name=name), (key, k) if k else (key,), p, w) for f, k, p, w in FRAMES]
            out += [Signature(label, words, (gate,), 1, 1.0) for words, gate in _version_tails(name, key, versions)]
            if name in SHORT_NAMES:
                out.append(Signature(label, f"dual licensed {name}", ("dual", key), 2, 0.95))
                # the second name of "licensed under the X or Y"
                out += [Signature(label, f"{word} {name}", (gate, key), 3, 0.8)
                        for word in ("and", "or") for gate in ("licensed", "spdx", "dual")]
    return out


def _version_tails(name: str, key: str, versions: tuple[str, ...]) -> list[tuple[str, str]]:
    """(words, gate) of a name with a version: "gpl 2 0", "gpl v2 0", "gpl license version 2 0". A
    version N.0 may be N, with a word or letter that tells it from other numbers ("apache v2",
    "apache license 2"). A name of one word may have the version in it ("gplv2", "gpl3")."""
    by_tail: dict[str, list[str]] = {}  # what follows the first number: the first numbers
    for v in versions:
        first, _, tail = v.partition(" ")
        by_tail.setdefault(tail, []).append(first)
    out = []
    for tail, firsts in by_tail.items():
        number = f"(?:{'|'.join(firsts)}) {tail}".strip()
        out += [(f"{name} v?{number}", key), (f"{name} (?:licen[sc]e|version|v) v?{number}", key),
                (f"{name} licen[sc]e (?:version|v) v?{number}", key)]
        if name == key:
            out += [(f"{name}{v}{x} {tail}".strip(), f"{name}{v}{x}") for x in firsts for v in ("", "v")]
    if short := [x for x in by_tail.get("0", []) if x not in versions]:
        number = f"(?:{'|'.join(short)})"
        out += [(f"{name} v{number}", key), (f"{name} (?:licen[sc]e|version|v) v?{number}", key),
                (f"{name} licen[sc]e (?:version|v) v?{number}", key)]
        if name == key:
            out += [(f"{name}{v}{x}", f"{name}{v}{x}") for x in short for v in ("", "v")]
    return out


def _word_choices(pattern: str) -> list[str]:
    """Word sequences a pattern stands for, each word a regular expression: optional and
    alternative groups that hold spaces are written out."""
    m = re.search(r"\(\?:([^()]*)\)(\??)", pattern)
    if not m:
        return [" ".join(pattern.split())]
    if " " not in m[0] and not m[2]:  # a choice inside one word
        head = pattern[:m.start()] + "\0" + m[1] + "\1"
        return [x.replace("\0", "(?:").replace("\1", ")")
                for x in _word_choices_keep(head, pattern[m.end():])]
    options = m[1].split("|") + ([""] if m[2] else [])
    return [y for o in options for y in _word_choices(pattern[:m.start()] + o + pattern[m.end():])]


def _word_choices_keep(head: str, tail: str) -> list[str]:
    return [" ".join((head + x).split()) if not x.startswith(" ") else head + " " + x.strip()
            for x in _tail(tail)]


def _tail(tail: str) -> list[str]:
    lead = " " if tail.startswith(" ") else ""
    return [lead + x for x in _word_choices(tail)]


def placed_patterns(rules: list[Signature]) -> list[tuple[str, Signature]]:
    """Patterns over "word@place" texts: group 1 the first word's place, group 2 the last word's."""
    out = {}
    for s in rules:
        for words in _word_choices(s.words):
            parts = words.split(" ")
            if len(parts) == 1:
                body = rf"{parts[0]}@(?=(\d+))(\d+)"
            else:
                body = " ".join([rf"{parts[0]}@(\d+)", *[rf"{p}@\d+" for p in parts[1:-1]], rf"{parts[-1]}@(\d+)"])
            out.setdefault((rf"(?<![^ ]){body}", s.label, s.keywords), (s, len(parts)))
    return [(k[0], s) for k, (s, _) in out.items()]


def longest(rules: list[Signature]) -> int:
    return max(len(w.split(" ")) for s in rules for w in _word_choices(s.words))


def scan(docs: DataFrame, rules: list[Signature] | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and
    detections (array of start, end, priority, label, weight: the intervals that stay).

    Null and empty texts have no words: counts 0, first_word and last_word null, labels '' and
    score 0. Repeated rows are scanned each on its own. Other columns are left behind. The
    score is the largest weight of a detection that stays or of a base phrase.
    """
    rules = signatures() if rules is None else rules
    patterns, reach = placed_patterns(rules), longest(rules)
    keys = sorted({k for s in rules for k in s.keywords} | {k for _, _, k in BASE})
    text = F.translate(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), UPPER, LOWER)
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.array_remove(F.split(text, NOT_WORD), "").alias("words"))
    gated = base.select("doc_id", F.size("words").alias("n"), F.array_intersect(
        "words", F.array(*map(F.lit, keys))).alias("keys"), "words")
    gated = gated.withColumn("words", F.when(F.size("keys") > 0, F.col("words")))  # others need no words

    def places(words: tuple[str, ...], key: str):
        same = " and ".join(f"words[i + {j}] = '{w}'" for j, w in enumerate(words))
        return F.expr(f"""if(array_contains(keys, '{key}') and n >= {len(words)},
            filter(sequence(0, n - {len(words)}), i -> {same}), cast(array() as array<int>))""")

    # one literal: the rules by their first keyword, so a text meets only rules of its own words
    by_word: dict[str, list] = {}
    for p, s in patterns:
        by_word.setdefault(s.keywords[0], []).append({
            "keywords": s.keywords[1:], "pattern": p, "priority": s.priority, "label": s.label, "weight": float(s.weight)})
    table = F.from_json(F.lit(json.dumps(by_word)), "map<string, array<struct<keywords: array<string>, pattern: string, "
                                                    "priority: int, label: string, weight: double>>>")
    own_rules = F.flatten(F.transform("keys", lambda k: F.coalesce(table[k], F.array().cast(
        "array<struct<keywords:array<string>,pattern:string,priority:int,label:string,weight:double>>"))))
    found = gated.select(
        "doc_id", "n", "words", *[places(w, k).alias(f"b{j}") for j, (w, _, k) in enumerate(BASE)],
        F.when(F.size("keys") > 0, F.filter(own_rules, lambda r: F.forall(
            r["keywords"], lambda k: F.array_contains("keys", k)))).alias("rules"))
    placed = found.withColumn("placed", F.when(F.size("rules") > 0, F.array_join(
        F.transform("words", lambda w, i: F.concat(w, F.lit("@"), i.cast("string"))), " "))).drop("words")

    def run(r):
        ends = F.arrays_zip(F.regexp_extract_all("placed", r["pattern"], F.lit(1)).alias("a"),
                            F.regexp_extract_all("placed", r["pattern"], F.lit(2)).alias("b"))
        # field order is the order of preference at one start: longest first, then priority
        return F.transform(ends, lambda z: F.struct(
            z["a"].cast("int").alias("start"), (-z["b"].cast("int")).alias("minus_end"),
            r["priority"].alias("priority"), r["label"].alias("label"), r["weight"].alias("weight")))

    hits = placed.withColumn("hits", F.when(F.size("rules") > 0, F.sort_array(F.flatten(
        F.transform("rules", run))))).drop("placed", "rules")
    # one interval per start stays; so any that overlaps another is among the `reach` before or after
    firsts = hits.withColumn("hits", F.expr(
        "filter(hits, (e, k) -> k = 0 or hits[k - 1].start != e.start)"))
    kept = firsts.withColumn("detections", F.expr(f"""
        transform(filter(hits, (d, k) -> not exists(
            slice(hits, greatest(1, k + 1 - {reach}), {2 * reach + 1}), e ->
                e.start <= -d.minus_end and d.start <= -e.minus_end
                and not (e.start = d.start)
                and ((e.start <= d.start and e.minus_end <= d.minus_end)
                     or (not (d.start <= e.start and d.minus_end <= e.minus_end)
                         and e.priority < d.priority)))),
            d -> named_struct('start', d.start, 'end', -d.minus_end, 'priority', d.priority,
                              'label', d.label, 'weight', d.weight))""")).drop("hits")
    names = F.filter(F.array(*[F.when(F.size(f"b{j}") > 0, F.lit(label))
                               for j, (_, label, _) in enumerate(BASE)]), lambda x: x.isNotNull())
    out = (kept.withColumn("starts", F.concat(*[F.col(f"b{j}") for j in range(len(BASE))]))
           .withColumn("base", F.array_sort(F.array_distinct(names))))
    own = F.coalesce(F.transform("detections", lambda d: d["label"]), F.array().cast("array<string>"))
    weight = F.coalesce(F.array_max(F.transform("detections", lambda d: d["weight"])), F.lit(0.0))
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_words"),
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        F.greatest(weight, F.when(F.size("starts") > 0, F.lit(BASE_WEIGHT)).otherwise(0.0)).alias("score"),
        "detections")
