"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page's visible text is cut where block elements begin or end. Each block has features of its ancestors
(tags, and the words of their class and id) and of its text (length, links, marks); the labels, main text
or not, form a chain. Weights are learnt on the driver from labelled pages, by default from PAGES pages
that labelled_pages writes by rule, and each page is decoded by Viterbi in its task.

Reading takes time that follows the page's length, however deep its elements nest: what is open is counted by
tag, mark and feature, and nothing walks the stack but to close elements.

Defined cases: null and empty html, and pages without main text, give an empty text; markup that is cut
off or wrongly nested is read as far as it goes; script and style end at their closing tag or with the page,
iframe, textarea and title only at a closing tag that is there; svg, template, noscript, object and select hide what
is in them until they or what is around them closes, and nothing if they close themselves; of two equally
likely labels a block is not main text; repeated rows and null ids are rows of their own; a null url stays null; an
empty table gives no rows; extra columns are not looked at; a page of any length is read whole.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages to learn from, and rounds over them.
PAGES, EPOCHS = 600, 15
#: Share of visits to a page, in training, that leave out the features of ancestors.
UNNAMED = 0.6
#: Share of an article's blocks after which a page to learn from has another part within the article: more than pages have, so
#: that every name of a part is met there.
WITHIN = 0.3
BUCKETS = 1 << 13

# Fixed values of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("head noscript object select svg template".split())
#: Whose content is not markup: those that end with the page if not before, and those that then are nothing.
RAW_TAGS, RAW_IF_CLOSED = frozenset("script style".split()), frozenset("iframe textarea title".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf block: its text, the hashed features of what it is in, its leaf tag, a hash of its ancestry, and the features of the
    innermost part of the page that it is in."""

    text: str
    inside: tuple[int, ...]
    leaf: str
    path: int
    near: tuple[int, ...] = ()
    linked: int = 0
    label: int | None = None
    #: In a labelled page: whether it is in another part within the main one.
    within: bool = False


def _hashed(name: str) -> int:
    return zlib.crc32(name.encode()) % BUCKETS


@dataclass
class _Open:
    tag: str
    inside: list[int]
    path: int
    near: list[int]


#: What is a part of a page by its tag, and else by having a class, id or role.
PARTS = frozenset("article aside dialog footer form header main nav section".split())
#: What is open within keeps a paragraph around it open.
_SCOPE = frozenset("article aside body div footer form header li main nav section table td ul ol".split()) | HIDDEN_TAGS
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    #: Where in the stack a tag is open, and how often a feature is.
    places: dict[str, list[int]] = field(default_factory=dict)
    inside: Counter = field(default_factory=Counter)
    hidden: int = 0
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self, said: str) -> None:
        if not self.hidden:
            self.parts.append(said)
            if self.places.get("a"):
                self.linked += len(said)

    def cut(self) -> None:
        """Ends the block of the text so far."""
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.stack[-1] if self.stack else _Open("", [], 0, [])
            # At most BUCKETS features, however deep.
            self.blocks.append(Block(text, tuple(self.inside), top.tag, top.path, tuple(top.near), self.linked))
        self.parts, self.linked = [], 0

    def open(self, tag: str, marks: list[str]) -> None:
        inside = [_hashed(f"in={tag}"), *(_hashed(f"mark={m}") for m in set(marks))]
        self.inside.update(inside)
        self.hidden += tag in HIDDEN_TAGS
        self.places.setdefault(tag, []).append(len(self.stack))
        top = self.stack[-1] if self.stack else _Open("", [], 0, [])
        near = [_hashed(f"near={x}") for x in ([tag] if tag in PARTS else []) + sorted(set(marks))] if marks or tag in PARTS else top.near
        self.stack.append(_Open(tag, inside, zlib.crc32(tag.encode(), top.path), near))

    def close(self, tag: str, down_to: frozenset[str] = frozenset()) -> None:
        """Closes the innermost such element and what is in it, if none of down_to is open within."""
        at = self.places.get(tag)
        if not at or any(self.places.get(t, [-1])[-1:] > at[-1:] for t in down_to):
            return
        for o in reversed(self.stack[at[-1] :]):
            self.places[o.tag].pop()
            self.hidden -= o.tag in HIDDEN_TAGS
            for x in o.inside:
                self.inside[x] -= 1
                if not self.inside[x]:
                    del self.inside[x]
            self.stack.pop()


def blocks(html: str) -> list[Block]:
    """The visible leaf blocks of a page, in page order."""
    r, at, n = _Reader(), 0, len(html)
    ends: dict[str, int] = {}
    while at < n:
        m = TOKEN.search(html, at)
        text = html[at : m.start() if m else n]
        if text:
            r.text(unescape(text))
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCK_TAGS:
            r.cut()
        if m[1]:
            r.close(tag)
            continue
        if tag == "br":
            r.text("\n")
        if tag in ("p", "li") or tag in _HEADINGS:
            r.close("p", _SCOPE)
        if tag == "li":
            r.close("li", frozenset(("ul", "ol")))
        if tag == "body":
            r.close("head")
        if (tag in RAW_TAGS or tag in RAW_IF_CLOSED) and ends.get(tag, at) < n:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            # That a tag is not closed any more is found once a page.
            ends[tag] = end.start() if end else n
            if end or tag in RAW_TAGS:
                at = end.end() if end else n
            continue
        if tag not in VOID_TAGS and tag not in RAW_IF_CLOSED and not m[3].rstrip().endswith("/"):
            r.open(tag, [w for x in ATTRIBUTE.findall(m[3]) for w in WORDS.findall("".join(x).lower())])
    r.cut()
    return r.blocks


def features(b: Block, before: Block | None, after: Block | None, i: int, n: int) -> list[int]:
    """Numbers of the features that a block has."""
    words = b.text.split(" ", 200)
    names = ["bias", f"leaf={b.leaf}", f"size={min(len(words), 199).bit_length()}", f"links={round(4 * b.linked / max(len(b.text), 1))}"]
    names += [f"end={b.text[-1] in '.!?:'}", f"sign={b.text[0] in '©®'}", f"place={0 if i == 0 else 2 if i == n - 1 else 1}"]
    for side, other in (("before", before), ("after", after)):
        names.append(f"{side}={'none' if other is None else other.path == b.path}")
    return [*b.inside, *b.near, *(_hashed(x) for x in names)]


def page_features(page: list[Block]) -> list[list[int]]:
    n = len(page)
    return [features(b, page[i - 1] if i else None, page[i + 1] if i + 1 < n else None, i, n) for i, b in enumerate(page)]


@dataclass
class Chain:
    """Weights of a feature for each label, and of each pair of labels in a row."""

    state: np.ndarray
    step: np.ndarray

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.state[x].sum(axis=0) for x in rows]).reshape(-1, 2)

    def decode(self, rows: list[list[int]]) -> list[int]:
        """Labels of the best path."""
        if not rows:
            return []
        s = self.scores(rows).tolist()
        (k00, k01), (k10, k11) = self.step.tolist()
        a, b, back = s[0][0], s[0][1], []
        for x, y in s[1:]:
            to0, to1 = (0 if a + k00 >= b + k10 else 1), (0 if a + k01 >= b + k11 else 1)
            back.append((to0, to1))
            a, b = max(a + k00, b + k10) + x, max(a + k01, b + k11) + y
        label = int(b > a)
        path = [label]
        for to in reversed(back):
            label = to[label]
            path.append(label)
        return path[::-1]

    def gradient(self, rows: list[list[int]], labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood: by block and label, and by pair of labels (forward and backward sums)."""
        s, n = self.scores(rows), len(rows)
        f, g = np.zeros((n, 2)), np.zeros((n, 2))
        f[0] = s[0]
        for t in range(1, n):
            f[t] = s[t] + np.logaddexp(f[t - 1, 0] + self.step[0], f[t - 1, 1] + self.step[1])
        for t in range(n - 2, -1, -1):
            x = g[t + 1] + s[t + 1]
            g[t] = np.logaddexp(self.step[:, 0] + x[0], self.step[:, 1] + x[1])
        whole = np.logaddexp(*f[-1])
        own = -np.exp(f + g - whole)
        own[np.arange(n), labels] += 1
        pairs = np.zeros((2, 2))
        for t in range(1, n):
            pairs -= np.exp(f[t - 1][:, None] + self.step + (s[t] + g[t])[None, :] - whole)
            pairs[labels[t - 1], labels[t]] += 1
        return own, pairs


def learn(pages: list[list[Block]], epochs: int = EPOCHS, rate: float = 1.0, decay: float = 1e-4) -> Chain:
    """Weights of highest penalised likelihood, by gradient steps page after page with falling rates."""
    chain = Chain(np.zeros((BUCKETS, 2)), np.zeros((2, 2)))
    seen = np.full((BUCKETS, 2), 1e-2), np.full((2, 2), 1e-2)
    data = [(p, page_features(p), [b.label for b in p]) for p in pages if p]
    order = random.Random(11)
    for _ in range(epochs):
        order.shuffle(data)
        for page, rows, labels in data:
            if order.random() < UNNAMED:  # as if its parts had names that were never seen, but those of parts within the main one
                main = [set(b.inside) for b in page if b.label]
                around = set.intersection(*main) if main else set()
                own = [[f for f in b.inside if f not in around] + [*b.near] if b.within else [] for b in page]
                rows = [x + row[len(b.inside) + len(b.near) :] for b, x, row in zip(page, own, rows, strict=True)]
            own, pairs = chain.gradient(rows, labels)
            sizes = [len(x) for x in rows]
            at = np.concatenate(rows)
            step = np.zeros((BUCKETS, 2))
            np.add.at(step, at, np.repeat(own, sizes, axis=0))
            used = np.unique(at)
            g = step[used] - decay * chain.state[used]
            seen[0][used] += g * g
            chain.state[used] += rate * g / np.sqrt(seen[0][used])
            seen[1][...] += pairs * pairs
            chain.step += rate * pairs / np.sqrt(seen[1])
    return chain


# ---- labelled pages

_SYLLABLES = "an be co da el fi go hu in jo ka le mi no or pa qu ra sen ti un ve wi ya zo ñe é ü".split()
_MAIN = ("article", "main", 'div class="content"', 'div class="post-body"', 'div id="main"', 'div class="entry-content"', 'section class="article-text"')
_OTHER = (
    "nav", "footer", "header", "aside", 'div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="sponsored"', 'div class="promo"', 'div class="banner"',
    'div class="menu"', 'div id="nav"', 'div class="sidebar"', 'div id="footer"', 'div id="header"', 'div class="cookie-notice"',
    'div class="notice"', 'div class="consent" role="dialog"', 'div class="related"', 'div class="share"', 'div class="social"', 'div class="newsletter"',
    'div class="breadcrumb"', 'div class="widget"', "form", 'form class="search"', 'div class="login"', 'div class="popup"',
)
_NEUTRAL = "box inner block wrap row col item module region".split()
_COMMENTS = ('div class="comments"', 'section id="comments"', 'div class="comment-list"', 'ol class="commentlist"', 'div class="replies comments"')


def labelled_pages(
    count: int = PAGES, seed: int = 7, main_parts: tuple[str, ...] = _MAIN, other_parts: tuple[str, ...] = _OTHER, comment_parts: tuple[str, ...] = _COMMENTS,
    within: float = 0.05,
) -> list[list[Block]]:
    """Pages written by rule, with labels: one main part of headings, paragraphs, lists and quotes, and
    other parts before, after and inside it. Words are drawn alike for all parts, so that what a part is,
    not what it says, makes the difference. The wrappers of parts are parameters, so that some can be held out."""
    rnd, pages = random.Random(seed), []

    def words(n: int) -> str:
        made = ["".join(rnd.choice(_SYLLABLES) for _ in range(rnd.randint(1, 4))) for _ in range(n)]
        kind = rnd.random()
        if kind < 0.1:
            return " ".join(w.upper() + "!!" for w in made)
        if kind < 0.15:
            return " ".join(w + "***" for w in made)
        return " ".join(made).capitalize() + ("." if rnd.random() < 0.7 else "")

    def size() -> int:
        return rnd.choice((1, 1, 2, 3, 5, 8, 13, 20, 40, 80))

    def wrap(part: str, inner: str) -> str:
        return f"<{part}>{inner}</{part.split()[0]}>"

    def named(part: str) -> str:
        """The part under some of its names, at times beside one that says nothing, and as another tag."""
        found = re.fullmatch(r'(\w+) (class|id)="([^"]*)"(.*)', part)
        if not found:
            return part
        tag, kind, names, rest = found.groups()
        names = rnd.sample(names.split(), rnd.randint(1, len(names.split()))) + ([rnd.choice(_NEUTRAL)] if rnd.random() < 0.3 else [])
        return f'{rnd.choice(("div", "section", "aside")) if tag == "div" and rnd.random() < 0.3 else tag} {kind}="{" ".join(names)}"{rest}'

    def other(within: bool = False) -> str:
        part, style = named(rnd.choice(other_parts)), rnd.uniform(0.3 if within else 0, 1)
        if style < 0.45:
            inner = wrap("ul", "".join(f'<li><a href="/x">{words(rnd.randint(1, 3))}</a></li>' for _ in range(rnd.randint(1, 7))))
        elif style < 0.7:
            inner = words(size())
        elif style < 0.8:
            inner = f"&copy; {words(rnd.randint(1, 4))} &middot; {words(size())}"
        else:
            inner = "".join(f"<p>{words(size())}</p>" for _ in range(rnd.randint(1, 3)))
        if part.startswith("form"):
            inner += f'<label>{words(2)}</label><input name="q"><button>{words(1)}</button>'
        return wrap(part, inner)

    def comments() -> str:
        return wrap(rnd.choice(comment_parts), "".join(f'<div class="comment"><p>{words(size())}</p></div>' for _ in range(rnd.randint(1, 4))))

    for _ in range(count):
        inner = [f"<h1>{words(rnd.randint(2, 10))}</h1>"] if rnd.random() < 0.8 else []
        for _ in range(rnd.randint(0, 9)):
            tag = rnd.choice(("p", "p", "p", "p", "p", "h2", "blockquote", "pre", "div"))
            text = words(size())
            inner.append(wrap(tag, f"<b>{text}</b>" if rnd.random() < 0.1 else text))
            if rnd.random() < 0.06:
                inner.append(wrap("ul", "".join(f"<li>{words(size())}</li>" for _ in range(rnd.randint(1, 4)))))
            if rnd.random() < within:
                inner.append("\x00" + other(True) + "\x01")
        if rnd.random() < 0.15:
            inner.append("\x00" + comments() + "\x01")
        main = wrap(rnd.choice(main_parts), "".join(inner)) if inner else ""
        if rnd.random() < 0.3 and main:
            main = wrap(rnd.choice(("main", "div", 'div id="page"', 'div class="wrapper"')), main)
        before = "".join(other() for _ in range(rnd.randint(0, 3)))
        after = (comments() if rnd.random() < 0.25 else "") + "".join(other() for _ in range(rnd.randint(0, 3)))
        pages.append(_labelled(before, 0) + _labelled(main, 1) + _labelled(after, 0))
    return pages


def _labelled(html: str, label: int) -> list[Block]:
    """Blocks of a part of a page; what stands between \\x00 and \\x01 is not main text."""
    out, other = [], False
    # The marks become blocks of their own, in the ancestry of the part.
    for b in blocks("<html><body>" + html.replace("\x00", "<hr><p>\x02</p>").replace("\x01", "<p>\x03</p>") + "</body></html>"):
        if b.text in ("\x02", "\x03"):
            other = b.text == "\x02"
            continue
        b.label, b.within = 0 if other else label, other
        out.append(b)
    return out


def extract(pages: DataFrame, examples: list[list[Block]] | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars. examples: labelled pages, by default those written by rule."""
    chain = learn(labelled_pages(within=WITHIN) if examples is None else examples)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html in batch.column("html"):
                page = blocks(html.as_py() or "")
                path = chain.decode(page_features(page))
                texts.append(" ".join(b.text for b, y in zip(page, path, strict=True) if y))
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = plain.mapInArrow(read, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
