"""License scan: sparse TF-IDF cosine to templates, then inheritance along directories.

A file's units are its whole text; its headers (comment blocks, where lines with and without comment marks
part, and paragraphs), with the marks left out; and statements: lines and sentences as they stand, and the
sentences and the first lines of headers, so wrapped ones and titles are found. A unit's vector has the count of a token times its inverse
document frequency among the templates (a token of no template weighs most and counts in the norm only).

There are two sets of templates, each with weights of its own: short statements, and the licenses' texts and
notices, whose weights count in how many of their sentences a token stands. A unit has the license of its
best template, if the cosine is STATEMENT or more (FILE for a whole text; of equal ones the first by name).
Per file the names of all its units are kept. Its own license is that of the license text that is all of the
file or of a header (TEXT or more), else the best one; a reservation of rights only where nothing else is said.

Texts, and then units, are scored only if they hold a word of telling(): of each template all words but some that
together have less of its length than the least score. What holds none of the others has a cosine below that with every
template, so nothing is lost. Only the tokens of those that do are dealt out, joined with the templates' weights, and added up by unit.
Templates that common words alone make up that far are held against other whole texts inside their rows.

A file is a license file if its name says so and it has a license, or if its whole text has a cosine of
FILE. Other files without a license take that of the license file in the nearest directory above (of
several the best, then the smallest path).

Defined cases: a null or empty text has no license of its own; a null path has no directory and inherits
nothing; rows that share a key are one file (all their units count, the smallest path); a null key is a key
of its own; of equal scores the first name counts; a text of any length is read whole, in time that follows its
length; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import settle, small

STATEMENT, FILE, TEXT = 0.7, 0.6, 0.85
BROADCAST_DIRECTORIES = 100_000

#: How licenses are stated.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal, public domain dedication"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("Proprietary", "All rights reserved"),
]
_GNU = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
#: The licenses' own notices and the heads of their texts.
NOTICES = [
    *[(f"GPL-{v}.0", _GNU.format("program", "General", v)) for v in (2, 3)],
    *[(f"LGPL-{v}", _GNU.format(what, "Lesser General", n)) for v, n in (("2.1", "2.1"), ("3.0", "3")) for what in ("library", "program")],
    ("AGPL-3.0", _GNU.format("program", "Affero General", 3)),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
]
_DISCLAIMED = (
    "{0} IS PROVIDED BY {1} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; "
    "OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
).format("THIS SOFTWARE", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS")
_BSD = (
    "Copyright (c). Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. {}"
)
#: Whole texts of short licenses.
TEXTS = [
    ("BSD-2-Clause", _BSD.format("") + _DISCLAIMED),
    ("BSD-3-Clause", _BSD.format("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. ") + _DISCLAIMED),
    ("MIT", "MIT License. Copyright (c). " + NOTICES[-1][1] + ": The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
     "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
     "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
     "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "ISC License. Copyright (c). Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
     "copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
     "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
     "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this "
     "software dedicate any and all copyright interest in the software to the public domain."),
]
#: Words that many texts have, of several languages. They only steer which words texts are looked through for: whatever they
#: are, no unit that reaches its least score is passed over.
COMMON = frozenset("the and of in to with that for is by are or do no this a on be as not it which from at an under".split())
#: Words that texts of one language often have, and telling ones of another: they count with a common word of that beside them.
PAIRED = frozenset(("mit",))
#: What a comment line begins with.
MARK = r"[ \t]*(?://+!?|/\*+!?|\*+/?|#+|--+|;+|%+|<!--|\"\"\")"
MARKS = rf"(?m)^(?:{MARK})?[ \t\r]*"
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
CUT = r"\n+|(?<=[.!?;])\s+"
LICENSE_NAME = r"(?i)^(licen[cs]e|copying|notice|unlicense)(\.[a-z]+)?$"


def _vectors(templates: list[tuple[str, str]], by_sentence: bool = False) -> tuple[list[tuple[int, str, dict[str, float]]], dict[str, float], float]:
    """The templates' unit vectors, the tokens' weights, and that of a token of no template. Documents, for the
    frequencies, are the templates, or their sentences."""
    counts = [(i, name, Counter(re.findall(TOKEN, text.lower()))) for i, (name, text) in enumerate(templates)]
    pieces = [set(re.findall(TOKEN, x.lower())) for _, text in templates for x in (re.split(CUT, text) if by_sentence else [text])]
    df, least = Counter(t for p in pieces for t in p), 0 if by_sentence else 1
    idf = {t: math.log((1 + len(pieces)) / (1 + n)) + least for t, n in df.items()}
    out = []
    for i, name, c in counts:
        raw = {t: n * idf[t] for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out.append((i, name, {t: x / norm for t, x in raw.items()}))
    return out, idf, math.log(1 + len(pieces)) + least


Vectors = list[tuple[int, str, dict[str, float]]]


def telling(vectors: Vectors, least: float) -> tuple[set[str], dict[str, set[str]], Vectors]:
    """(words, pairs, rest): whatever has a cosine of `least` or more with a template that is not in rest holds one of the words,
    or a word of pairs and one of those that it needs beside it; with one in rest, if it holds neither, it has it by COMMON and
    PAIRED words only. Of each template words are left out, common ones first, whose squares add up to less than that of `least`: by Cauchy and
    Schwarz these alone give no more than their length. A word of PAIRED needs one of the common ones that don't fit beside it."""
    out, pairs, rest, most = set(), {}, [], (least - 1e-5) ** 2  # scores are rounded to six places
    for template in vectors:
        v = template[2]
        common = sorted((t for t in v if t in COMMON), key=lambda t: (v[t], t))
        left = sum(v[t] ** 2 for t in common)
        if left >= most:
            out |= set(v) - COMMON
            rest.append(template)
            continue
        paired = [t for t in v if t in PAIRED and left + v[t] ** 2 >= most]
        if paired and v[paired[0]] ** 2 >= most:
            out |= set(v) - COMMON - PAIRED
            rest.append(template)
            continue
        if paired:
            beside, sum_ = set(), v[paired[0]] ** 2
            for t in common:
                sum_ += v[t] ** 2
                beside |= {t} if sum_ >= most else set()
            pairs[paired[0]] = pairs.get(paired[0], set()) | beside
            out |= set(v) - COMMON - {paired[0]}
            continue
        for t in sorted(set(v) - COMMON, key=lambda t: (t not in PAIRED, v[t], t)):
            if left + v[t] ** 2 < most:
                left += v[t] ** 2
            else:
                out.add(t)
    return out, pairs, rest


def _joined(told: list[tuple[set[str], dict[str, set[str]], Vectors]]) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for _, pairs, _ in told:
        for t, beside in pairs.items():
            out[t] = out.get(t, set()) | beside
    return out


def _holds(text: Column, words: set[str], pairs: dict[str, set[str]]) -> Column:
    """Whether a lower-case text holds one of the words, or a pair."""
    both = [text.rlike(_pattern([t])) & text.rlike(_pattern(sorted(beside))) for t, beside in sorted(pairs.items()) if beside and t not in words]
    return reduce(Column.__or__, both, text.rlike(_pattern(sorted(words))))


def _once(rows: DataFrame, name: str, value: Column, *kept: str | Column) -> DataFrame:
    """kept, and value under a name that no filter is rewritten across, so each row works it out once."""
    return rows.select(*kept, F.explode(F.array(value)).alias(name))


def _common_scores(files: DataFrame, k: int, of_set: tuple, rest: list) -> DataFrame:
    """key, path, kind, set, name and score of the whole texts that reach FILE with a template of rest; files hold no word of
    telling(), so of these templates they have COMMON and PAIRED words only. A text's tokens are sorted in its row, where equal ones stand
    side by side, so no token leaves it."""
    _, idf, other = of_set
    words = sorted({t for _, _, v in rest for t in v if t in COMMON | PAIRED})
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(f"({TOKEN})"), F.lit(1))
    rows = _once(files, "tokens", tokens, "key", "path")
    rows = _once(rows, "held", F.array_intersect(F.array(*map(F.lit, words)), "tokens"), "key", "path", "tokens")
    share = lambda v: reduce(Column.__add__, [F.when(F.array_contains("held", t), x * x).otherwise(0.0) for t, x in v.items() if t in COMMON | PAIRED], F.lit(0.0))
    rows = rows.filter(reduce(Column.__or__, [share(v) >= (FILE - 1e-5) ** 2 for _, _, v in rest]))
    rows = _once(rows, "tokens", F.array_sort("tokens"), "key", "path")
    starts = F.filter(F.sequence(F.lit(0), F.size("tokens") - 1), lambda i: ~F.get("tokens", i).eqNullSafe(F.get("tokens", i - 1)))
    rows = _once(rows, "starts", starts, "key", "path", "tokens")
    counts = F.transform("starts", lambda x, i: F.struct(F.get("tokens", x).alias("t"), (F.coalesce(F.get("starts", i + 1), F.size("tokens")) - x).cast("double").alias("n")))
    rows = _once(rows, "counts", counts, "key", "path")
    known = F.filter("counts", lambda c: c["t"].isin(*sorted(idf)))
    rows = _once(rows, "known", known, "key", "path", F.aggregate("counts", F.lit(0.0), lambda a, c: a + c["n"] * c["n"]).alias("all"))
    weight = F.create_map(*[F.lit(x) for t in sorted(idf) for x in (t, float(idf[t]))])
    total = F.aggregate("known", F.lit(0.0), lambda a, c: a + c["n"] * c["n"] * (F.pow(F.element_at(weight, c["t"]), F.lit(2.0)) - other * other))
    dots = []
    for _, name, v in rest:
        own = F.create_map(*[F.lit(x) for t in sorted(v) for x in (t, float(v[t] * idf[t]))])
        dots.append(F.struct(F.lit(name).alias("name"), F.aggregate("known", F.lit(0.0), lambda a, c: a + c["n"] * F.coalesce(F.try_element_at(own, c["t"]), F.lit(0.0))).alias("dot")))  # noqa: B023
    rows = rows.select("key", "path", F.sqrt(F.col("all") * other * other + total).alias("norm"), F.array(*dots).alias("dots"))
    best = F.array_min(F.transform("dots", lambda d: F.struct((-F.round(d["dot"] / F.col("norm"), 6)).alias("minus"), d["name"].alias("name"))))
    scored = rows.select("key", "path", F.lit("whole").alias("kind"), F.lit(k).alias("set"), best["name"].alias("name"), (-best["minus"]).alias("score"))
    return scored.filter(F.col("score") >= FILE)


def _scores(units: DataFrame, sets: list) -> DataFrame:
    """units (uid, kind, unit) with set, name and score of each set's best template, where that is enough."""
    spark = units.sparkSession
    words = [(t, k, idf[t], [(i, float(v[t] * idf[t])) for i, _, v in vectors if t in v]) for k, (vectors, idf, _) in enumerate(sets) for t in sorted(idf)]
    known = F.broadcast(spark.createDataFrame(words, "t string, set int, idf double, weights array<struct<template:int,x:double>>"))  # the templates' words
    names = F.broadcast(spark.createDataFrame([(k, i, name) for k, (vectors, _, _) in enumerate(sets) for i, name, _ in vectors], "set int, template int, name string"))
    tokens = F.regexp_extract_all(F.lower("unit"), F.lit(f"({TOKEN})"), F.lit(1))
    counts = settle(units.select("uid", F.explode(tokens).alias("t")).groupBy("uid", "t").agg(F.count("*").alias("n")))
    square = F.sum(F.col("n") * F.col("n"))
    whole = counts.groupBy("uid").agg(square.alias("all"))
    met = counts.join(known, "t")
    mine = met.groupBy("uid", "set").agg(F.sum(F.pow(F.col("n") * F.col("idf"), F.lit(2.0))).alias("mine"), square.alias("some"))
    dots = met.select("uid", "set", "n", F.explode("weights").alias("w")).groupBy("uid", "set", "w.template").agg(F.sum(F.col("n") * F.col("w.x")).alias("dot"))
    other = F.element_at(F.array(*[F.lit(o * o) for _, _, o in sets]), F.col("set") + 1)
    norm = F.sqrt(F.col("mine") + (F.col("all") - F.col("some")) * other)
    least = F.when(F.col("kind") == "whole", F.lit(FILE)).otherwise(F.lit(STATEMENT))
    scored = (
        dots.join(mine, ["uid", "set"]).join(whole, "uid").withColumn("score", F.round(F.col("dot") / norm, 6)).filter(F.col("score") >= min(STATEMENT, FILE))
        .join(names, ["set", "template"]).groupBy("uid", "set").agg(F.min(F.struct((-F.col("score")).alias("minus"), "name")).alias("b"))
    )
    return scored.join(units.drop("unit"), "uid").select("key", "path", "kind", "set", F.col("b.name").alias("name"), (-F.col("b.minus")).alias("score")).filter(F.col("score") >= least)


def _headers(text: Column) -> Column:
    """The blocks of a text: runs of lines with comment marks and without, and their paragraphs; marks left out."""
    # A form feed parts the blocks: where a line with a mark follows one without, and the other way round.
    parted = F.regexp_replace(text, rf"(?m)^((?!{MARK})[^\n]*\n)(?={MARK})", "$1\f")
    parted = F.regexp_replace(parted, rf"(?m)^(\f?{MARK}[^\n]*\n)(?!{MARK})", "$1\f")
    bare = F.regexp_replace(F.regexp_replace(parted, "\f", "\f\n"), MARKS, "")
    blocks = F.split(bare, "\f")
    return F.array_distinct(F.concat(blocks, F.split(bare, r"\n\s*\n|\f")))


def _pattern(tokens: list[str]) -> str:
    """Matches a text that holds one of the tokens; alternatives by their first letter, as there are many."""
    by: dict[str, list[str]] = {}
    for t in tokens:
        by.setdefault(t[0], []).append(re.escape(t[1:]))
    return r"(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(by.items())) + r")(?![a-z0-9])"


def scan(files: DataFrame, key: str, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """files has key, path and text. Per key: key, path, license, score, basis (own, inherited or none),
    from_path (the license file inherited from), licenses (all of its own, sorted, comma-joined)."""
    plain = files.select(F.col(key).alias("key"), "path", "text")
    long = NOTICES + TEXTS
    sets = [_vectors(templates)] if templates else [_vectors(TEMPLATES), _vectors(long, True)]
    statements, files_ = ([telling(vectors, least) for vectors, _, _ in sets] for least in (STATEMENT, FILE))
    # Of a unit that is no whole text, what common words alone state needs a template that is all of these.
    stated = set().union(*(words for words, _, _ in statements), *(v for *_, rest in statements for _, _, v in rest))
    whole = stated.union(*(words for words, _, _ in files_))
    states, is_one = _holds(F.lower("unit"), stated, _joined(statements)), _holds(F.lower("text"), whole, _joined(statements + files_))
    found = settle(plain.filter(is_one))
    apart = [_common_scores(plain.filter(~is_one), k, of_set, rest) for k, (of_set, (*_, rest)) in enumerate(zip(sets, files_, strict=True)) if rest]
    headers = found.select("key", "path", F.explode(_headers(F.col("text"))).alias("unit")).filter(states)
    lines = F.filter(F.split("unit", r"\s*\n\s*"), lambda x: x != "")
    titles = F.array(*[F.array_join(F.slice(lines, 1, n), " ") for n in (2, 3)])
    sentences = F.array_distinct(F.concat(titles, F.split(F.regexp_replace("unit", r"\s*\n\s*", " "), r"(?<=[.!?;:])\s+")))
    units = (
        headers.select("key", "path", F.lit("header").alias("kind"), "unit")
        .unionByName(headers.select("key", "path", F.lit("statement").alias("kind"), F.explode(sentences).alias("unit")))
        .unionByName(found.select("key", "path", F.lit("statement").alias("kind"), F.explode(F.split("text", CUT)).alias("unit")))
        .filter(states)
        .unionByName(found.select("key", "path", F.lit("whole").alias("kind"), F.col("text").alias("unit")))
    )
    hits = reduce(DataFrame.unionByName, apart, _scores(settle(units.withColumn("uid", F.monotonically_increasing_id())), sets))
    texts = sorted({name for name, _ in TEXTS})
    told = (F.col("set") == 1) & F.col("kind").isin("whole", "header") & (F.col("score") >= TEXT) & F.col("name").isin(*texts)
    hits = hits.withColumn("order", F.when(told, F.when(F.col("kind") == "whole", 0).otherwise(1)).when(F.col("name") == "Proprietary", 3).otherwise(2))
    best = F.struct(F.col("score").alias("score"), F.col("name").alias("name"))
    own = settle(
        hits.groupBy("key").agg(
            F.min("path").alias("at"),
            F.min(F.struct("order", (-F.col("score")).alias("score"), F.col("name").alias("name"))).alias("best"),
            F.max(F.when(F.col("kind") == "whole", best)).alias("whole"),
            F.array_join(F.array_sort(F.collect_set("name")), ",").alias("licenses"),
        ).select("key", "at", (-F.col("best.score")).alias("score"), F.col("best.name").alias("name"), "whole", "licenses")
    )
    named = F.element_at(F.split("at", "/"), -1).rlike(LICENSE_NAME)
    directory = F.regexp_replace("at", "/[^/]*$", "")
    shared = (
        own.filter("at is not null").filter(named | F.col("whole").isNotNull())
        .select(directory.alias("dir"), F.struct((-F.col("score")).alias("minus"), F.col("at").alias("path"), "name").alias("s"))
        .groupBy("dir").agg(F.min("s").alias("s")).select("dir", F.col("s.name").alias("dir_name"), F.col("s.path").alias("dir_path"), (-F.col("s.minus")).alias("dir_score"))
    )
    shared = settle(shared)
    shared = F.broadcast(shared) if small(shared, BROADCAST_DIRECTORIES) else shared

    every = plain.groupBy("key").agg(F.min("path").alias("path"))
    every = settle(
        every.alias("e").join(own.alias("o"), F.col("e.key").eqNullSafe(F.col("o.key")), "left").select("e.key", "path", "name", "score", "licenses")
    )
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    above = F.when(F.size(parts) > 1, above).otherwise(F.array().cast("array<string>"))
    lacking = every.filter("name is null and path is not null").select("key", F.posexplode(above).alias("depth", "dir"))
    nearest = lacking.join(shared, "dir").groupBy("key").agg(
        F.max_by(F.struct("dir_name", "dir_path", "dir_score"), "depth").alias("n")
    )
    return (
        every.alias("e").join(nearest.alias("n"), F.col("e.key").eqNullSafe(F.col("n.key")), "left")
        .select(
            F.col("e.key").alias(key),
            "path",
            F.coalesce("name", "n.n.dir_name").alias("license"),
            F.coalesce("score", "n.n.dir_score").alias("score"),
            F.when(F.col("name").isNotNull(), "own").when(F.col("n.n").isNotNull(), "inherited").otherwise("none").alias("basis"),
            F.col("n.n.dir_path").alias("from_path"),
            F.coalesce("licenses", F.lit("")).alias("licenses"),
        )
    )


def placed(documents: DataFrame) -> DataFrame:
    """Documents as files: doc_id, path (source/language/doc_id) and text."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.coalesce(F.col("doc_id").cast("string"), F.lit("_")))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), "text")
