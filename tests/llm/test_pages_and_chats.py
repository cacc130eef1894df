import base64
import hashlib

from tracemill.llm import chat, html_text, warc


def test_conversations_read_back(spark):
    rows = [
        (1, 0, "system", "Be <s> brief"), (1, 1, "user", "a\\b [INST]"), (1, 2, "user", "again"), (1, 3, "assistant", "</s>[/INST] \\"), (1, 4, "assistant", "two"),
        (2, 0, "assistant", None), (2, 1, None, "x<|turn|>y"), (3, 0, "user", ""), (4, 5, "assistant", "late"), (4, 1, "[INST]", "odd role"), (5, 0, "user", "\\[INST]<\\s>é\n"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").unionByName(chat.trick_conversation(spark))
    formatted = chat.format_conversations(table)
    got = {r.conv_id: r for r in chat.digests(chat.read_back(formatted)).collect()}
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        x = got[conv]
        assert (x.n_turns, x.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (x.loss_chars, x.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    one = {r.conv_id: r.formatted for r in formatted.collect()}
    assert one[1].count("<s>") == 3 and one[1].count("<|turn|>") == 2 and one[-1].count("[INST]") == 2
    assert chat.format_conversations(table.filter("false")).count() == 0


def test_long_odd_and_repeated_conversations(spark):
    rows = [(1, i, ("user", "assistant")[i % 3 > 0], f"t{i} é</s>" * (i % 4), "x") for i in range(3000)] + [(2, 1, "user", "b", "x"), (2, 1, "user", "a", "x"), (2, 1, "assistant", "c", "x"), (2, 1, "user", "b", "x"), (None, None, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    got = {r.conv_id: r for r in chat.digests(chat.read_back(chat.format_conversations(table))).collect()}
    for conv in (1, 2, None):
        own = sorted((r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        loss = "".join(t for _, role, t in own if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for _, role, t in own)
        x = got[conv]
        assert (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_archives_round_trip(spark):
    pages = [(1, "http://a/ü?x y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u\r\nEvil: 1", None), (4, "u", ""), (5, "u", "x" * 300_000), (None, "u", "<p>é</p>"), (6, "u", "\r\n\r\nWARC/1.1\r\n")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    archives = warc.archive(table, archive_bytes=1000)
    got = {r.page_id: r for r in warc.read_archives(archives).collect()}
    digest = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    kinds = {1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None), 6: ("response", None), None: ("response", None)}
    for i, _, html in pages:
        x = got[i]
        assert (x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) == (len((html or "").encode()), digest(html or ""), *kinds[i])
    assert sum(r.records for r in archives.collect()) == len(pages)
    assert warc.read_archives(warc.archive(table.filter("false"))).count() == 0


def test_normaliser_takes_one_member_or_many(tmp_path):
    import gzip

    data = [warc.record(i, "u", b"p" * i, None) for i in range(50)]
    for name, packed in (("one", gzip.compress(b"".join(data))), ("many", b"".join(gzip.compress(x) for x in data))):
        (tmp_path / f"{name}.warc.gz").write_bytes(packed)
        target = str(tmp_path / "out" / f"{name}.warc.gz")
        assert warc.normalise(str(tmp_path / f"{name}.warc.gz"), target) == 50
        body = open(target, "rb").read()
        for line, record in zip(open(target + ".idx"), data, strict=True):
            offset, size, _ = line.split()
            assert gzip.decompress(body[int(offset) : int(offset) + int(size)]) == record


def test_blocks_are_labelled_on_held_out_pages():
    chain = html_text.learn(html_text.labelled_pages(150), epochs=6)
    test = html_text.labelled_pages(60, seed=1234)
    assert accuracy(chain, test) > 0.98


def accuracy(chain, pages):
    return sum(y == b.label for p in pages for y, b in zip(chain.decode(html_text.page_features(p)), p)) / sum(map(len, pages))


def test_wrappers_that_training_never_saw():
    """Every wrapper of the held-out pages has a name that is in no training page; their structure and text are all there is."""
    kept = lambda parts, k: tuple(x for i, x in enumerate(parts) if (i % 3 == 0) == k)
    parts = (html_text._MAIN, html_text._OTHER, html_text._COMMENTS)
    chain = html_text.learn(html_text.labelled_pages(200, 5, *[kept(p, False) for p in parts]), epochs=6)
    assert accuracy(chain, html_text.labelled_pages(60, 77, *[kept(p, True) for p in parts])) > 0.8


PAGES = [
    ('<p>One</p><svg class="i"/><p>Two</p><p>Three</p>', "One Two Three"), ("<p>One<svg><text>no</text></svg> two</p><template><p>no</p><template>no</template>no</template><p>Three</p>", "One two Three"),
    ("<p>One</p><iframe src=x><p>Two</p>", "One Two"), ("<p>One</p><iframe>no</iframe><p>Two</p>", "One Two"), ("<p>One</p><p><svg class=i></p><p>Two</p>", "One Two"), ("<title>no<p>One</p>", "no One"),
    ("<p>One</p></span></div></svg><p>Two</p>", "One Two"), ("<p>One<noscript><p>no</p></noscript></p><p>Two</p>", "One Two"), ("<p>One</p><script>no<p>no", "One"), ("<ul><li>One<li>Two<ul><li>Three</ul><li>Four</ul>", "One Two Three Four"),
    ("<table><tr><td>One<td>Two</table>", "One Two"), ("<p>One<svg><a>", "One"), ("a < b <3 c <p", "a < b <3 c"),
]


def test_nothing_else_is_dropped():
    for html, text in PAGES:
        assert " ".join(b.text for b in html_text.blocks(html)) == text, html


def test_reading_is_linear_in_depth():
    import time

    for one in ("<div class='c{}'>t", "<p class=x><span>t", "<svg/><i>t", "</b><a><b>t", "<iframe>t", "<li>t<p>"):
        took = []
        for n in (5_000, 40_000):
            html = "".join(one.format(i) for i in range(n))
            began = time.process_time()
            found = html_text.blocks(html)
            took.append(time.process_time() - began)
            assert sum(b.text.replace(" ", "").count("t") for b in found) == n
        assert took[1] < 40 * took[0] + 1, one


def test_main_text_only(spark):
    body = (
        '<nav><ul><li><a href="/x">Menu</a></ul></nav><header>Top</header><div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1>'
        "<p>One\n  two <b>three</b>.<p>Four&nbsp;&eacute;</p><script>var x = '</p>';</script><div class=\"ad\">Buy</div><p>End</article>"
        '<div class="comments"><div class="comment"><p>First!</p></div></div><form><label>Mail</label><input></form><footer>&copy; x</footer>'
    )
    rows = [(1, "u", f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"), (2, None, None), (3, "u", ""), (None, "u", "<p")]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "A & B One two three. Four é End" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == got[None].text == "" and got[2].n_chars == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string, text string, n_chars int")).count() == 0
    twice = spark.createDataFrame([(1, "u", rows[0][2], "x"), (1, "u", rows[0][2], "x")], "page_id long, url string, html string, text string")
    assert [r.text for r in html_text.extract(twice).collect()] == [got[1].text] * 2


NAMES = "ad ads advert sponsored promo banner sidebar notice cookie-notice newsletter related share".split()


def test_other_parts_within_an_article():
    chain = html_text.learn(html_text.labelled_pages(within=html_text.WITHIN))

    def read(html):
        page = html_text.blocks(html)
        return " ".join(b.text for b, y in zip(page, chain.decode(html_text.page_features(page)), strict=True) if y)

    for name in NAMES:
        for part in (f'<div class="{name}">Buy</div>', f'<div class="{name}"><p>Buy these now, all of them are cheap today.</p></div>', f'<aside class="{name}"><a href="/x">Buy</a></aside>'):
            html = f"<html><body><nav><ul><li><a href=/x>Menu</a></ul></nav><article><h1>Head</h1><p>One two three four.</p>{part}<p>Five six seven.</p></article><footer>&copy; x</footer></body></html>"
            assert read(html) == "Head One two three four. Five six seven.", part


def test_hidden_parts_hide_what_closes_paragraphs():
    for tag in sorted(html_text.HIDDEN_TAGS - {"head"}):
        for inner in ("<p>no</p>", "<li>no", "<h2>no</h2>"):
            assert [b.text for b in html_text.blocks(f"<p>One<{tag}>{inner}</{tag}></p><p>Two</p>")] == ["One", "Two"], (tag, inner)


def test_viterbi_finds_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    chain = html_text.Chain(rng.normal(size=(html_text.BUCKETS, 2)), rng.normal(size=(2, 2)))
    rows = [rng.integers(0, html_text.BUCKETS, 4).tolist() for _ in range(7)]
    s = chain.scores(rows)
    value = lambda path: sum(s[t, y] for t, y in enumerate(path)) + sum(chain.step[a, b] for a, b in zip(path, path[1:]))
    assert chain.decode(rows) == list(max(itertools.product((0, 1), repeat=7), key=value))
