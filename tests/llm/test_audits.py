"""Host rules, source divergence and periodic runs against plain versions, on small tables with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracemill.llm import divergence, host_rules, runs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, host string, words string, value int, n int, windows string, rank string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents():
    rnd = random.Random(5)
    vocabulary = ["the", "The", "déjà", "ÑU", "x1", "#a|b", "über"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    words = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    out = []
    for i in range(160):
        w = words(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 2)):
            block = words(rnd.randint(1, 12))
            w += (block * 30)[: rnd.randint(1, 6 * len(block))] + words(rnd.randint(0, 9))
        gap = rnd.choice((" ", "\n", "\t", " \r\n"))
        text = gap.join(w) + rnd.choice(("", " ", "\n\n"))
        out.append((i, text, rnd.choice(("en", "de", None)), rnd.choice(("a", "b", "Ñ", None)), 1, "h", "w", 7, 8, "x", "r"))
    spam = " ".join(["buy now"] * 40)
    out += [(200 + i, spam if i % 8 else " ".join(words(30)), "en", "spam", 1, None, None, None, None, None, None) for i in range(40)]
    out += [(None, None, None, None, None, None, None, None, None, None, None), (None, " ".join("pqr" * 30), "en", "a", 1, None, None, 1, 1, None, None)]
    out += [(300, "", "xx", "lonely", 0, None, None, 1, 1, None, None), (301, "alone", "xx", "other", 0, None, None, 1, 1, None, None), (302, " \n\t ", "yy", "one", 0, None, None, 1, 1, None, None)]
    out += [(303, " ".join(words(9000)), "de", "b", 1, None, None, 1, 1, None, None), (304, " ".join(["z"] * 9000), "de", "b", 1, None, None, 1, 1, None, None)]
    return out + out[:20]


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_statistics(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {p for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_statistics_and_verdicts_of_hosts(table, rows):
    got = host_rules.judge(table).collect()
    expected = Counter((r[0], r[3], *plain_statistics(r[1])) for r in rows)
    assert Counter((r.doc_id, r.host, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.host != "spam")
    assert any(r.host == "spam" and not r.base_failed for r in got)
    assert {r.host for r in got if r.kept} >= {"a", "b", "Ñ", None}


def test_rates_are_shrunk_by_what_hosts_are_like(spark):
    rnd = random.Random(8)
    counts = {f"h{i}": (n := rnd.randint(1, 200), sum(rnd.random() < p for _ in range(n))) for i in range(60) for p in [rnd.betavariate(2, 8)]}
    rows = [(h, 10 if i < k else 100) for h, (n, k) in counts.items() for i in range(n)]
    found = spark.createDataFrame(rows, "host string, n_words long").withColumns({c: F.lit(0).cast("long") for c in ("n_repeat_words", "n_symbols", "n_dup_lines", "n_lines")})
    got = {r.host: r.rate for r in host_rules.host_rates(found.withColumn("word_chars", 5 * F.col("n_words"))).filter("rule = 'short'").collect()}
    mean = sum(k for _, k in counts.values()) / sum(n for n, _ in counts.values())
    for h, (n, k) in counts.items():
        assert min(mean, k / n) - 1e-9 <= got[h] <= max(mean, k / n) + 1e-9
    few, many = min(counts, key=lambda h: counts[h][0]), max(counts, key=lambda h: counts[h][0])
    pull = lambda h: abs(got[h] - mean) / max(1e-9, abs(counts[h][1] / counts[h][0] - mean))
    assert pull(few) < pull(many)
    # The prior's weight is that of about the ten documents which made the rates.
    n, k = counts[many]
    strength = (k - got[many] * n) / (got[many] - mean)
    assert 4 < strength < 25


def test_hosts_in_other_cases(spark, empty, table):
    assert host_rules.judge(empty).collect() == []
    one = host_rules.judge(table.filter("source = 'spam'")).collect()
    assert {round(r.host_rate, 9) for r in one} == {round(35 / 40, 9)}
    assert host_rules.judge(table, "host").filter("host is null").count() > 0


def plain_audit(rows):
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source, words = r[2] or "", r[3] or "", term.findall((r[1] or "").translate(low))
        groups[lang].add(source)
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]

        def p(own, kept=kept):
            n = sum(own[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (own[t] + 1) // n for t in kept}

        every = p(sum((counts[lang, s] for s in sources), Counter()))
        of = {s: p(counts[lang, s]) for s in sources}
        for s in sources:
            pair = [(x, sum((of[s][t] - of[x][t]) ** 2 // of[x][t] for t in kept)) for x in sources if x != s]
            terms = [(t, (of[s][t] - every[t]) ** 2 // every[t]) for t in kept if counts[lang, s][t] and of[s][t] > every[t]]
            for part, found in (("pair", pair), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found) if part == "pair" or i < 200]
    return sorted(out)


def test_divergences_are_exact(table, rows):
    expected = plain_audit(rows)
    assert sorted(map(tuple, divergence.audit(table).collect())) == expected
    assert {r[:2] for r in expected if r[0] == "xx"} == {("xx", "lonely"), ("xx", "other")}


def test_divergences_in_slices_blocks_and_by_shuffled_groups(table, rows, monkeypatch):
    for name, value in (("SLICE", 40), ("CELLS", 8), ("TERMS", 16), ("BROADCAST_GROUPS", 0)):
        monkeypatch.setattr(divergence, name, value)
    assert sorted(map(tuple, divergence.audit(table).collect())) == plain_audit(rows)


def test_divergences_of_many_sources(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(("ab", "cd", "ef", "gh", "ij", "kl")) for _ in range(6)), "en", f"s{i % 150}") for i in range(450)]
    got = divergence.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert sorted(map(tuple, got.collect())) == plain_audit(rows)


def test_divergences_of_nothing_and_of_ties(spark, empty):
    assert divergence.audit(empty).collect() == []
    rows = [(i, " ".join(f"t{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(300)) if i % 2 else "zz zz", "en", "ab"[i % 2]) for i in range(6)]
    got = divergence.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert sorted(map(tuple, got.collect())) == plain_audit(rows)


def test_shares_of_large_totals_are_exact(spark):
    rnd = random.Random(1)
    rows = [(a, b) for b in [rnd.randint(1, 9 * 10**15) for _ in range(50)] + [1, 2, 3] for a in (1, b, rnd.randint(1, b))]
    expected = [1 + 10**9 * a // b for a, b in rows]
    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", divergence.share(F.col("a"), F.col("b")).alias("p"))
    assert {(r.a, r.b, r.p) for r in df.collect()} == {(a, b, p) for (a, b), p in zip(rows, expected, strict=True)}
    a, b = np.array(rows).T
    assert divergence.shares(a, b).tolist() == expected


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(24, 3 * q):
                found.setdefault((s, i - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    n, planted = len(w), w
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        planted = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(planted)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (
        doc_id, n, len(found), *(top + (1000 * top[1] // top[2],) if top else (None,) * 4),
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(planted) if i not in gone).encode()).hexdigest(),
    )


def test_runs_of_documents(table, rows, empty):
    short = [r for r in rows if len(r[1] or "") < 9000]
    got = [tuple(r) for r in runs.periodic_runs(table).collect()]
    assert len(got) == len(rows)
    expected = Counter(plain_row(r[0], r[1]) for r in short)
    assert not expected - Counter(got)
    assert (304, 9000, 1, 0, 9000, 1, 9_000_000) in {r[:7] for r in got}
    assert sum(r[2] for r in expected) > 20 and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in short)
    assert runs.periodic_runs(empty).collect() == []


def test_runs_of_all_kinds_together():
    rnd = random.Random(4)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            k = rnd.choice((1, 2, 3, 5, 50))
            w = [b"%d" % rnd.randrange(k) for _ in range(rnd.randint(0, 60))]
            for _ in range(rnd.randint(0, 3)):
                block = [b"%d" % rnd.randrange(k) for _ in range(rnd.randint(1, 20))]
                w += (block * 6)[: rnd.randint(1, 6 * len(block))]
            texts.append(w + [b"%d" % rnd.randrange(k) for _ in range(rnd.randint(0, 30))])
        assert [[tuple(r) for r in x.tolist()] for x in runs.together(texts)] == [plain_runs(w) for w in texts]


def test_a_long_period_and_pieces_of_candidates(monkeypatch):
    monkeypatch.setattr(runs, "CANDIDATES", 64)
    rnd = random.Random(6)
    block = [b"%d" % rnd.randrange(10**6) for _ in range(5000)]
    assert runs.together([block * 3 + block[:7], [b"a"] * 5000, []])[0].tolist() == [[0, 15007, 5000]]
    assert runs.together([[b"a"] * 23, [b"a"] * 24, block * 2])[1].tolist() == [[0, 24, 1]]
