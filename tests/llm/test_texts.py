"""Operators on documents against brute force, on small tables with awkward rows."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tracemill.llm import decontamination, fingerprints, licenses, mixing, neardup, quality, substrings

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, hashes string, n int"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(seed: int = 3, count: int = 90):
    """Copies, near copies, shared passages, repeats, empties, nulls, one long text; extra columns clash."""
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "Zug", "déjà", "ñu", "x1", "and", "qui"] + [f"w{i}" for i in range(300)]
    words = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    base, shared = [words(60) for _ in range(6)], [" ".join(words(30))]
    out = []
    for i in range(count):
        kind = rnd.random()
        if kind < 0.2:
            w = list(rnd.choice(base))
        elif kind < 0.45:
            w = list(rnd.choice(base))
            for _ in range(rnd.randint(1, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        elif kind < 0.6:
            w = words(rnd.randint(0, 30)) + shared + words(rnd.randint(0, 30))
        elif kind < 0.7:
            w = [rnd.choice(vocabulary)] * rnd.randint(1, 80)
        elif kind < 0.8:
            w = words(rnd.randint(0, 6))
        else:
            w = words(rnd.randint(5, 120))
        gaps = (" ", "\n", "\t") if kind < 0.45 else (" ", " ", " ", "\n", ". ", "\t")
        text = "".join(x + rnd.choice(gaps) for x in w)
        out.append((i * 3, text, "en", rnd.choice(("a", "b", None)), len(text), "s", "h", 1))
    out += [(1000, None, None, None, None, None, None, None), (1001, "", "en", "a", 0, None, None, 1), (1002, " \n ", "en", "b", 3, None, None, 1)]
    out.append((1003, " ".join(words(6000)), "en", "a", 1, None, None, 1))
    return out


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sets(rows):
    out = {}
    for r in rows:
        w = (r[1] or "").translate(LOW).encode().split()
        k = min(5, len(w))
        out[r[0]] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if k else set()
    return out


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_are_the_components_of_all_links(spark, table, rows, percent):
    own = sets(rows)
    parent = {i: i for i in own}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(own)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if own[a] and own[b] and 100 * len(own[a] & own[b]) >= percent * len(own[a] | own[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r.doc_id: r for r in neardup.near_duplicates(table, percent).collect()}
    assert len(got) == len(rows)
    assert {i: (len(own[i]), find(i), find(i) == i) for i in own} == {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()}
    assert any(find(i) != i for i in own)


def test_a_hot_bucket_of_near_texts_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "FEW", 2)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rnd = random.Random(12)
    base, rows = [f"b{i}" for i in range(120)], []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.randint(1, 7)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(40)}"
        rows.append((i, " ".join(w)))
    own, parent = sets(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in own:
        for b in range(a):
            if 100 * len(own[a] & own[b]) >= 85 * len(own[a] | own[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: find(i) for i in own} and 5 < len(set(got.values())) < 140


def test_register_estimates_follow_the_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    for overlap in (0, 300, 600, 900):
        pool = rng.integers(0, 2**63, 2000 - overlap).astype(np.uint64)
        a, b = neardup.registers(pool[:1000]), neardup.registers(pool[-1000:])
        est = neardup.estimate(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([1000]), np.array([1000]))[0]
        assert abs(est - overlap / (2000 - overlap)) < 0.16
    merged = np.maximum(neardup.registers(pool[:600]), neardup.registers(pool[600:]))
    assert (merged == neardup.registers(pool)).all()


@pytest.mark.parametrize("threshold", [0.85, 0.8])
def test_estimates_lose_no_more_than_bands(threshold):
    import numpy as np
    from math import lgamma

    m = neardup.M
    larger, smaller = (x.ravel() for x in np.meshgrid(np.arange(m + 1), np.arange(m + 1)))
    larger, smaller = larger[larger + smaller <= m], smaller[larger + smaller <= m]
    equal, log_b = m - larger - smaller, np.log(neardup.B)
    for nv in (1.0, 0.95, 0.9, threshold + 0.001):
        u = 1 / (1 + nv)
        up, down = (-np.log1p(-x * (neardup.B - 1) / neardup.B) / log_b for x in (u - (1 - u) * threshold, 1 - u - u * threshold))
        gamma = np.array([lgamma(i + 1) for i in range(m + 1)])
        chance = np.exp(gamma[m] - gamma[larger] - gamma[smaller] - gamma[equal] + larger * np.log(up) + smaller * np.log(down) + equal * np.log(1 - up - down))
        found = neardup.estimate(larger, smaller, np.full(len(larger), 1.0), np.full(len(larger), nv))
        bands = (1 - (1 - up - down) ** neardup.ROWS) ** neardup.BANDS
        assert chance.sum() == pytest.approx(1) and chance[found < neardup.least_estimate(threshold)].sum() <= bands


def removed(rows, length=50):
    first, texts = {}, {r[0]: (r[1] or "").encode() for r in rows}
    for i, b in texts.items():
        for j in range(len(b) - length + 1):
            w = b[j : j + length]
            first[w] = min(i, first.get(w, i))
    out = {}
    for i, b in texts.items():
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if first[b[j : j + length]] < i:
                gone[j : j + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeated_strings_go(table, rows, hot):
    got = substrings.remove_repeats(table, group_bytes=2500, bucket_contexts=200, hot=hot).collect()
    expected = removed(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected
    assert len(got) == len(rows) and any(x[1] for x in expected.values())


@pytest.mark.parametrize("hot", [4096, 1])
def test_equal_hashes_remove_nothing_by_themselves(rows, hot, monkeypatch):
    """All rounds of one process, with hashes of two bits for anchors, contexts and strings."""
    import numpy as np
    import pyarrow as pa

    from tracemill.llm import bytehash

    mixed = bytehash.mixed
    monkeypatch.setattr(bytehash, "mixed", lambda x: mixed(x) >> np.uint64(62) << np.uint64(62))
    bits, buckets = 20, 3
    groups = [pa.table([pa.array([r[0] for r in rows[g::2]]), pa.array([r[1] for r in rows[g::2]], pa.string())], ["doc_id", "text"]) for g in range(2)]
    keys = [(pa.scalar(g),) for g in range(2)]

    def by(column, tables, f):
        whole = pa.concat_tables(tables)
        return pa.concat_tables([f((pa.scalar(v),), whole.filter(pa.compute.equal(whole[column], v))) for v in sorted(set(whole[column].to_pylist()))])

    import pyarrow.compute  # noqa: F401

    flags = by("bucket", [substrings._requests(bits, buckets)(k, t) for k, t in zip(keys, groups)], lambda k, t: substrings._replies(k, t, hot))
    own = lambda table, g: table.filter(pa.compute.equal(table["grp"], g))
    masks = by("bucket", [substrings._contexts(bits, buckets)(k, t, own(flags, g)) for g, (k, t) in enumerate(zip(keys, groups))], substrings._sorted_bucket)
    got = {}
    for g, (k, t) in enumerate(zip(keys, groups)):
        both = pa.concat_tables([own(flags, g).append_column("masks", pa.nulls(own(flags, g).num_rows, pa.binary())), own(masks, g).append_column("flags", pa.nulls(own(masks, g).num_rows, pa.binary()))], promote_options="default")
        for r in substrings._results(bits, buckets, None)(k, t, both).to_pylist():
            got[r["doc_id"]] = (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
    assert got == removed(rows)


def test_clean_texts_keep_other_columns(table, rows):
    got = {r.doc_id: r for r in substrings.clean_texts(table).collect()}
    assert {i: (r.source, r.lang, r.hashes) for i, r in got.items()} == {r[0]: (r[3], r[2], r[6]) for r in rows}
    assert got[1000].text == "" and len(got[1003].text) == len(next(r[1] for r in rows if r[0] == 1003))


def test_equal_classes_are_equal_strings():
    import numpy as np

    from tracemill.llm.suffixes import equal_classes

    rnd = random.Random(9)
    text = np.frombuffer("".join(rnd.choice("ab") * rnd.randint(1, 40) for _ in range(120)).encode() * 2, np.uint8)
    starts = np.arange(len(text) - 50 + 1)
    classes = equal_classes(text, starts, 50)
    strings = [text[i : i + 50].tobytes() for i in starts]
    assert len(set(zip(classes.tolist(), strings))) == len(set(strings)) == len(set(classes.tolist()))


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def test_windows_of_items_are_hit(spark, table, rows):
    w3, w7 = word_list(rows[3][1]), word_list(rows[7][1])
    items = [(1, " ".join(w3[:25])), (2, " ".join(w7[5:15])), (3, " ".join(w7[2:6])), (4, "the"), (5, None), (6, "..."), (7, " ".join(w3[:25])), (7, " ".join(w3[:25])), (10, "never seen words here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, text in items:
        w = word_list(text)
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[j : j + n]), set()).add(str(i))
    expected = {}
    for r in rows:
        w, hit, found = word_list(r[1]), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if own := windows.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= own
        expected[r[0]] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    got = decontamination.decontaminate(table, bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == expected
    clean = decontamination.decontaminate(table, bench.filter("item_id < 0")).collect()
    assert {(r.doc_id, r.n_words, r.n_hit) for r in clean} == {(i, x[0], 0) for i, x in expected.items()}


def hashed(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def paragraphs(text):
    """The pieces of a text, by the module's words: sentences of lines, long ones cut after words that their hash tells."""
    out = set()
    for x in re.split(fingerprints.CUT, text, flags=re.A):
        x = x.strip(" ")
        if len(x) <= fingerprints.LONG:
            out |= {x} if x else set()
            continue
        held = []
        for w in re.findall(rf"\S{{1,{fingerprints.WORD}}}", x, flags=re.A):
            held.append(w)
            if hashed(w.encode()) % fingerprints.EVERY == 0 or len(w) == fingerprints.WORD:
                out.add(" ".join(held))
                held = []
        out |= {" ".join(held)} if held else set()
    return out


def peeled(fingerprint):
    """The digests that a written fingerprint holds, from the text alone."""
    head, *rest = fingerprint.split("-")
    width, cells, found = int(head, 16), {}, set()
    for x in rest:
        at, n, key, total = (int(y, 16) for y in x.split("."))
        cells[at] = [n, key, total]
    check = lambda d: hashed((1).to_bytes(4, "little"), hashed(d.to_bytes(8, "little")))
    while pure := [c[1] for c in cells.values() if c[0] == 1 and c[2] == check(c[1])]:
        d = pure[0]
        found.add(d)
        for p in range(3):
            n, key, total = cells[(d >> 16 * p) % width + p * width]
            cells[(d >> 16 * p) % width + p * width] = [n - 1, key ^ d, total ^ check(d)]
    assert not any(any(c) for c in cells.values())
    return found


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("widths", [fingerprints.WIDTHS, (0.05,), (0.05, 3.0)])
def test_sketches_tell_the_shared_paragraphs(table, rows, widths, monkeypatch):
    monkeypatch.setattr(fingerprints, "WIDTHS", widths)
    monkeypatch.setattr(fingerprints, "LEAST", 2 if len(widths) == 1 else 16)
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 20)
    by = sorted(rows, key=lambda r: -r[0])
    got = {r.doc_id: r for r in fingerprints.fingerprints(table).collect()}
    assert len(got) == len(rows)
    prints = {}
    for k, r in enumerate(by):
        text, after = r[1] or "", by[(k + 1) % len(by)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        x = got[r[0]]
        assert (x.n_chars, x.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = paragraphs(text), paragraphs(edited), paragraphs(after)
        assert x.near_edited == pytest.approx(likeness(a, b)) and x.near_next == pytest.approx(likeness(a, c))
        assert prints.setdefault(text, x.fingerprint) == x.fingerprint and prints.setdefault(edited, x.edited_fingerprint) == x.edited_fingerprint
        # From the written fingerprints alone.
        own, new = peeled(x.fingerprint), peeled(x.edited_fingerprint)
        assert own == {hashed(p.encode()) for p in a} and x.near_edited == pytest.approx(likeness(own, new))
        assert x.near_next == pytest.approx(likeness(own, peeled(got[by[(k + 1) % len(by)][0]].fingerprint)))


def test_one_line_texts_are_like_their_own_edit(spark):
    rnd = random.Random(8)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    lines = [" ".join(words(6) + rnd.choice(".!?") for _ in range(40)), " ".join(words(5) + "." for _ in range(30)), words(400), words(500), "".join(chr(0x4E00 + rnd.randrange(5000)) for _ in range(3000)), "Two. Short ones here. And.", ""]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    for i in range(len(lines) - 1):
        assert got[i].near_edited > 0.2 and got[i].near_next < 0.05
    assert got[len(lines) - 1].near_edited == 1.0


def test_mix_meets_targets(table, rows):
    got = mixing.mix(table).collect()
    assert len(got) == len(rows)
    again = sorted((r.doc_id, r.taken) for r in mixing.mix(table.repartition(5)).collect())
    assert again == sorted((r.doc_id, r.taken) for r in got)
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    total, names = sum(size.values()), sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    left, targets = dict(zip(names, (1, 2, 3))), {}
    caps = {n: 3 * sum(size[r[0]] for r in rows if r[3] == n) for n in names}
    while left:
        level = (total - sum(targets.values())) / sum(left.values())
        full = [n for n in left if caps[n] < left[n] * level]
        for n in full or list(left):
            targets[n] = caps[n] if full else left[n] * level
            del left[n]
    for n in names:
        own = [r for r in got if r.source == n]
        assert own[0].target == pytest.approx(targets[n])
        assert abs(sum(r.taken for r in own) - targets[n]) <= max(r.size for r in own) / 2 + 1e-6
        assert abs(sum(r.taken for r in own) - targets[n]) <= 0.02 * targets[n]
    assert all(r.size == size[r.doc_id] and r.taken <= 3 * r.size for r in got)


def test_quality_is_learnt_and_inputs_stay_out(spark, table):
    rnd = random.Random(2)
    good = ["the cat sat on a mat and looked at birds", "we went home late and slept until noon today"]
    rows = []
    for i in range(400):
        bad = rnd.random() < 0.4
        text = " ".join(rnd.choice(good).split()[: rnd.randint(4, 9)]) + "."
        rows.append((i, ("BUY!! " * rnd.randint(5, 30)) if bad else text * rnd.randint(1, 5), int(not bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert held and sum(got[r[0]].predicted == r[2] for r in held) / len(held) > 0.97
    import zlib

    assert all(got[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in rows)
    odd = quality.classify(table, labels).collect()
    assert len(odd) == table.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality.classify(table, labels.filter("false")).collect()} == {0.5}


def test_licenses_are_stated_or_inherited(spark):
    files = [
        (1, "p/LICENSE", "Released under the MIT License."), (2, "p/src/a.py", "print(1)"), (3, "p/src/deep/b.py", "# Licensed under the Apache License, Version 2.0.\nx = 1"),
        (4, "q/c.py", None), (5, "p/src/deep/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3."), (6, "p/src/deep/d.py", ""), (7, None, "All rights reserved. More text follows here."),
        (8, "q/long", "Nothing said. " * 400 + "Licensed under CC BY-NC 4.0. " + "Nothing said. " * 400), (9, "q/e", "the license of the version of the public is a work"),
    ]
    got = {r.id: (r.license, r.basis, r.from_path) for r in licenses.scan(spark.createDataFrame(files, "id long, path string, text string"), "id").collect()}
    assert got[1] == ("MIT", "own", None) and got[2] == ("MIT", "inherited", "p/LICENSE") and got[3][:2] == ("Apache-2.0", "own")
    assert got[4] == (None, "none", None) and got[6] == ("GPL-3.0", "inherited", "p/src/deep/LICENSE.txt") and got[7][:2] == ("Proprietary", "own")
    assert got[8][:2] == ("CC-BY-NC-4.0", "own") and got[9] == (None, "none", None)


def test_wrapped_headers_are_found(spark):
    code = "\n".join(f"x{i} = call{i}(y{i})" for i in range(300))
    gpl = "{0}This program is free software: you can redistribute it and/or modify\n{0}it under the terms of the GNU General Public License as published by\n{0}the Free Software Foundation, either version {1} of the License, or\n{0}(at your option) any later version.\n"
    bsd = "{0}Redistribution and use in source and binary forms, with or without\n{0}modification, are permitted provided that the following conditions are\n{0}met:\n"
    mit = "{0}Permission is hereby granted, free of charge, to any person\n{0}obtaining a copy of this software and associated\n{0}documentation files\n"
    texts = [(bsd.format("# ") + code, "BSD-3-Clause"), (gpl.format(" * ", 3) + code, "GPL-3.0"), (code + "\n" + gpl.format("// ", 2) + code, "GPL-2.0"), (mit.format("-- ") + code, "MIT"), (code, None)]
    files = [(i, f"p{i}/a.py", text) for i, (text, _) in enumerate(texts)]
    files += [(10, "q/LICENSE", bsd.format("") + "\n1. Redistributions of source code must retain the above copyright notice,\nthis list of conditions and the following disclaimer.\n"), (11, "q/b.py", code)]
    got = {r.id: (r.license, r.basis) for r in licenses.scan(spark.createDataFrame(files, "id long, path string, text string"), "id").collect()}
    assert [got[i][0] for i in range(len(texts))] == [name for _, name in texts]
    assert got[10] == ("BSD-3-Clause", "own") and got[11] == ("BSD-3-Clause", "inherited")


def test_licenses_are_scored_by_plain_tf_idf(spark):
    said = [("to any person obtaining a copy of this software", 0.705), ("Permission is hereby granted, free of charge, to any person", 0.732), ("This project is released under the MIT license", 0.720)]
    files = spark.createDataFrame([(i, f"p{i}/a", t) for i, (t, _) in enumerate(said)] + [(9, "q/a", "zzz " * 3000 + "the the license")], "id long, path string, text string")
    got = {r.id: r for r in licenses.scan(files, "id").collect()}
    assert got[9].license is None
    for i, (_, score) in enumerate(said):
        assert got[i].license == "MIT" and got[i].score == pytest.approx(score, abs=6e-4)


def test_scores_are_those_of_a_plain_discriminant(spark):
    """The densities written out with means, covariances, inverses and determinants of numpy."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choice(("A!", "bb", "the", "7,", "x|y", "Über", "z\n")) for _ in range(rnd.randint(0, 60))) + "?" * (i % 2 * rnd.randint(0, 9))) for i in range(200)] + [(5, "again"), (None, "none")]
    marks = [(i, i % 2) for i in range(120)] + [(7, 1), (8, 1), (8, 0), (9, 5)]
    x = quality.statistics(pa.array([r[1] for r in rows]))
    y = {i: {q for j, q in marks if j == i and q in (0, 1)} for i, _ in marks}
    learnt = {i: min(q) for i, q in y.items() if len(q) == 1 and __import__("zlib").crc32(str(i).encode()) % 3 != 1}
    own = [np.array([v for v, r in zip(x, rows) if learnt.get(r[0]) == k]) for k in (0, 1)]
    n = sum(map(len, own))
    cov = [np.cov(o.T, bias=True) for o in own]
    shared = sum(len(o) * c for o, c in zip(own, cov)) / n
    shared = (1 - quality.DIAGONAL) * shared + quality.DIAGONAL * np.diag(np.diag(shared)) + 1e-6 * np.eye(len(shared))
    density = []
    for o, c in zip(own, cov):
        w = max(quality.SHRINK, 1 - len(o) / (len(o) + quality.D))
        s = (1 - w) * c + w * shared
        d = x - o.mean(axis=0)
        density.append(np.log(len(o) / n) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    expected = 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, quality string, score double")
    got = quality.classify(docs, spark.createDataFrame(marks, "doc_id long, quality int")).collect()
    assert sorted((r.doc_id or -1, round(r.score, 5)) for r in got) == sorted((r[0] or -1, round(float(e), 5)) for r, e in zip(rows, expected))


def cosine(unit, vectors, idf, other):
    """The best score of a unit and its name, by TF-IDF written out."""
    import math
    from collections import Counter

    raw = {t: n * idf.get(t, other) for t, n in Counter(re.findall(licenses.TOKEN, unit.lower())).items()}
    norm = math.sqrt(sum(x * x for x in raw.values())) or 1
    return min((-round(sum(x * v.get(t, 0) for t, x in raw.items()) / norm, 6), n) for _, n, v in vectors)


SETS = [licenses._vectors(licenses.TEMPLATES), licenses._vectors(licenses.NOTICES + licenses.TEXTS, True)]


def test_no_unit_that_scores_is_passed_over():
    """Parts of templates, with other words, common and rare: whatever reaches a least score holds a telling word."""
    rnd, reached = random.Random(3), 0
    for _ in range(20_000):
        words = re.findall(licenses.TOKEN, rnd.choice(licenses.TEMPLATES + licenses.NOTICES + licenses.TEXTS)[1].lower())
        share = rnd.random()
        unit = " ".join([w for w in words if rnd.random() < share] + rnd.choices(["zzz", "qq", "the", "and"], k=rnd.randrange(3)))
        held = set(unit.split())
        for vectors, idf, other in SETS:
            score, name = cosine(unit, vectors, idf, other)
            for least in (licenses.STATEMENT, licenses.FILE):
                telling, pairs, rest = licenses.telling(vectors, least)
                if -score >= least:
                    reached += 1
                    paired = any(t in held and held & beside for t, beside in pairs.items())
                    assert held & telling or paired or name in {n for _, n, _ in rest} and least == licenses.FILE, unit
    assert reached > 2000 and not licenses.telling(SETS[0][0], licenses.STATEMENT)[2]


def test_scans_find_what_every_unit_scores(spark):
    """Texts of one statement each, among them those that few words state, against all templates written out."""
    rnd = random.Random(12)
    said = ["Released under the MIT.", "released under the mit terms", "This is free and released into the public domain.", "Universal, public domain dedication 1.0", "and are with or in that the and", "to and this for any with or is", "All reserved", "mit", "the mit", "mit under", "The MIT, the MIT.", "mit der das", ""]
    for _ in range(150):
        words = re.findall(licenses.TOKEN, rnd.choice(licenses.TEMPLATES + licenses.NOTICES)[1].lower())
        share = rnd.random()
        said.append(" ".join(w for w in words if rnd.random() < share))
    # Common words only, in all shares, at the edge of what a whole text needs.
    said += [" ".join(rnd.choices(sorted(licenses.COMMON & {"and", "are", "with", "or", "in", "that", "the", "to", "this", "for", "is"}), k=rnd.randint(3, 20))) for _ in range(150)]
    got = {r.id: r for r in licenses.scan(spark.createDataFrame([(i, f"p{i}/a", t) for i, t in enumerate(said)], "id long, path string, text string"), "id").collect()}
    found = 0
    for i, text in enumerate(said):
        best = [cosine(text, *s) for s in SETS]
        names = {n for score, n in best if -score >= licenses.FILE}
        assert set(filter(None, got[i].licenses.split(","))) == names, text
        found += bool(names)
    assert found > 80 and [got[i].license for i in range(4)] == ["MIT", "MIT", "Unlicense", "CC0-1.0"]


def test_scores_are_cosines_of_tf_idf(spark):
    import math
    from collections import Counter

    sets = [licenses._vectors(licenses.TEMPLATES), licenses._vectors(licenses.NOTICES + licenses.TEXTS, True)]
    rnd, units = random.Random(4), []
    for i in range(300):
        words = re.findall(licenses.TOKEN, rnd.choice(licenses.TEMPLATES + licenses.NOTICES + licenses.TEXTS)[1].lower())
        units.append((i, "k", "p", rnd.choice(("whole", "statement")), " ".join(w if rnd.random() < 0.8 else "zzz" for w in words)))
    expected = set()
    for i, _, _, kind, unit in units:
        for k, (vectors, idf, other) in enumerate(sets):
            raw = {t: n * idf.get(t, other) for t, n in Counter(unit.split()).items()}
            norm = math.sqrt(sum(x * x for x in raw.values()))
            score, name = min((-round(sum(x * v.get(t, 0) for t, x in raw.items()) / norm, 6), n) for _, n, v in vectors)
            if -score >= (licenses.FILE if kind == "whole" else licenses.STATEMENT):
                expected.add((i, k, name, kind))
    table = spark.createDataFrame([(*u[:1], str(u[0]), *u[2:]) for u in units], "uid long, key string, path string, kind string, unit string")
    assert {(int(r.key), r.set, r.name, r.kind) for r in licenses._scores(table, sets).collect()} == expected and expected


LICENSE_FILES = [
    ("BSD-2-Clause", licenses.TEXTS[0][1]), ("BSD-3-Clause", licenses.TEXTS[1][1]), ("MIT", licenses.TEXTS[2][1]), ("ISC", licenses.TEXTS[3][1]), ("Unlicense", licenses.TEXTS[4][1]),
    ("Apache-2.0", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n1. Definitions."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nEveryone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.\n\nPreamble"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\nEveryone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.\n\nPreamble"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nThis version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License."),
    ("MPL-2.0", "Mozilla Public License\nVersion 2.0\n\n1. Definitions\n\nThis Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.\n"),
]


def test_license_texts_have_their_own_names(spark):
    wrap = lambda t: re.sub(r"(.{60,75}) ", r"\1\n", t)
    files = [(i, f"p{i}/LICENSE", "Copyright (c) 2019, Jane Doe. All rights reserved.\n\n" * (i % 2) + wrap(text)) for i, (_, text) in enumerate(LICENSE_FILES)]
    files += [(100 + i, f"q{i}/x.c", "/*\n" + "".join(f" * {x}\n" for x in wrap(text).split("\n")) + " */\nint main() { return 0; }\n") for i, (_, text) in enumerate(LICENSE_FILES)]
    files += [(200 + i, f"p{i}/src/y.c", "int y;") for i in range(len(LICENSE_FILES))]
    got = {r.id: (r.license, r.basis) for r in licenses.scan(spark.createDataFrame(files, "id long, path string, text string"), "id").collect()}
    for i, (name, _) in enumerate(LICENSE_FILES):
        assert (got[i], got[100 + i], got[200 + i]) == ((name, "own"), (name, "own"), (name, "inherited"))


def test_empty_tables(spark, empty):
    bench, labels = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.mix(empty).count() == 0
    assert fingerprints.fingerprints(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0
    assert quality.classify(empty, labels).count() == 0
    assert decontamination.decontaminate(empty, bench).count() == 0
    assert neardup.near_duplicates(empty).count() == 0
    assert licenses.scan(licenses.placed(empty), "doc_id").count() == 0


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.component_id for r in neardup.near_duplicates(docs).orderBy(F.col("doc_id").asc_nulls_last()).collect()] == [1, 1, None, None]
    assert substrings.remove_repeats(docs).agg(F.sum("n_removed")).first()[0] == 0
    assert mixing.mix(docs).count() == 4 and fingerprints.fingerprints(docs).count() == 4
    bench = spark.createDataFrame([(1, "C d e")], "item_id long, text string")
    found = decontamination.decontaminate(docs, bench).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit) for r in found) == [(0, 0, 0), (0, 7, 3), (1, 7, 3), (1, 7, 3)]
    scored = quality.classify(docs, spark.createDataFrame([(1, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")).collect()
    assert len(scored) == 4 and {r.score for r in scored} == {1.0}
    assert sorted((r.doc_id or 0, r.license) for r in licenses.scan(licenses.placed(docs), "doc_id").collect()) == [(0, None), (1, None)]
