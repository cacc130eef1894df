"""Suffix-array deduplication of long repeated byte strings, blockwise over the whole corpus.

Each byte goes that a string of LENGTH bytes covers which also starts in a document with a smaller
doc_id. Strings are bytes of the input, matches never cross documents, overlaps count.

A string's bucket is found from the string alone: among the hashes of its grams of GRAM bytes the least
(the leftmost of equal ones) is its anchor. So strings meet where their anchors are the same, each anchor
stands for a run of string starts, and what an anchor sees (its context) decides all strings of the run.

1. Documents are dealt to groups of bounded size, written once as a table in buckets of groups: the text is
   shuffled once, and all later rounds read it where it lies. A group sends each bucket the hashes of its
   distinct anchors, a few bits more than their number needs; however often a passage repeats, a group sends
   it once, so a hot passage costs a bucket one entry a group.
2. A bucket replies for each anchor whether another group may have it too. This only tells what to look at.
3. For such anchors, and those that two documents of the group have, the group sends the contexts' bytes. A
   bucket lays them out as one text and sorts the suffixes that start strings (suffixes.py: difference cover,
   one suffix bucket at a time), which gives the classes of equal strings, by their bytes. Contexts of an
   anchor that has very many are sent string by string, each to the bucket of its own hash, so that no bucket
   gets them all.
4. The replies mark the bytes to remove. Within a group, contexts count as the same if their bytes are.

Defined cases: a null text is empty; texts shorter than LENGTH keep everything; repeated rows and rows
that share a doc_id are rows of their own that do not remove each other's bytes; a null doc_id counts as
larger than any; rows are dealt to groups whatever their doc_id; a text of any length is one row of a group and
is read whole; extra columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash
from .storage import settle, shared_folder
from .suffixes import equal_classes

LENGTH, GRAM = 50, 24
SPAN = LENGTH - GRAM
#: Bytes of text of a group, and contexts of a bucket, on average.
GROUP_BYTES, BUCKET_CONTEXTS = 4 << 20, 300_000
#: Bytes of text of a file of the table of groups, on average.
FILE_BYTES = 64 << 20
#: Contexts of one anchor beyond which they are sent string by string.
HOT = 4096
SEND, MANY = 1, 2
#: Strings that are compared at a time.
STRINGS = 1 << 17
#: In place of the anchor's place: that a piece is a string of its own.
STRING = 255
#: Bits of an anchor's hash beyond those that tell all anchors apart by number.
SPARE = 8
_LAST = np.iinfo(np.int64).max


@dataclass
class Anchors:
    """The runs of string starts of a group; `cls` numbers their contexts in order of appearance."""

    data: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    row: np.ndarray
    grams: np.ndarray
    cls: np.ndarray
    first: np.ndarray
    gram: np.ndarray
    order: np.ndarray

    def context(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the contexts of runs k start and end: all the bytes that their strings can reach."""
        row, at = self.row[k], self.at[k]
        return np.maximum(at - SPAN, self.offsets[row]), np.minimum(at + LENGTH, self.offsets[row + 1])


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor position, first and last string start, hash of gram and of context, for each run."""
    n, rows = len(data), len(offsets) - 1
    parts: list[tuple[np.ndarray, ...]] = []
    for a in range(0, max(0, n - LENGTH + 1), bytehash.PIECE):
        b = min(n - LENGTH + 1, a + bytehash.PIECE)
        left, right = max(0, a - SPAN), min(n, b + SPAN + LENGTH)
        hashes = bytehash.Prefix(data[left:right])
        at = np.arange(a - left, b - left + SPAN)
        gram = bytehash.mixed(hashes.of(at, at + GRAM))
        least = (gram >> np.uint64(32) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)
        width = 1
        while width * 2 <= SPAN + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SPAN + 1 - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        valid = np.ones(b - a, dtype=bool)
        first, last = np.searchsorted(offsets, a, side="right") - 1, np.searchsorted(offsets, b, side="left")
        for e, s in zip(offsets[first + 1 : last + 1], offsets[first : last], strict=True):
            valid[max(s, e - LENGTH + 1, a) - a : max(0, min(e, b) - a)] = False
        starts = np.flatnonzero(valid)
        if not len(starts):
            continue
        anchor = (least[starts] & np.uint64(2**32 - 1)).astype(np.int64)
        edge = np.flatnonzero(np.diff(anchor)) + 1
        begin, end = np.concatenate(([0], edge)), np.concatenate((edge, [len(starts)])) - 1
        p = anchor[begin]
        where = np.searchsorted(offsets, p + a, side="right") - 1
        s = np.maximum(p + a - SPAN, offsets[where]) - left
        e = np.minimum(p + a + LENGTH, offsets[where + 1]) - left
        with np.errstate(over="ignore"):
            shape = (p + a - left - s).astype(np.uint64) * np.uint64(131) + (e - s).astype(np.uint64)
            seen = bytehash.mixed(hashes.of(s, e) + bytehash.mixed(shape + np.uint64(1)))
        parts.append((p + a, starts[begin] + a, starts[end] + a, gram[p], seen, where))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    at, low, high, gram, seen, where = (np.concatenate(x) for x in zip(*parts, strict=True))
    # A run that a piece's end cut is one run.
    new = np.concatenate(([True], at[1:] != at[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(at) - 1]))
    return at[new], low[new], high[last], gram[new], seen[new], where[new]


def anchors(table: pa.Table) -> Anchors:
    """The anchors of a group's documents, taken by doc_id. Contexts are one if their bytes are."""
    ids = table.column("doc_id").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    data, offsets = bytehash.texts(table.column("text").take(pa.array(order)))
    at, low, high, gram, seen, row = _runs(data, offsets)
    with np.errstate(over="ignore"):
        key = bytehash.mixed(gram * np.uint64(3) + seen)
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    by = np.argsort(first, kind="stable")
    place = np.empty(len(by), dtype=np.int64)
    place[by] = np.arange(len(by))
    own = Anchors(data, offsets, ids[order], at, low, high, row, gram, place[inverse], first[by], gram[first[by]], order)
    _part_unequal(own)
    return own


def _part_unequal(own: Anchors) -> None:
    """Gives runs whose context only hashes like their class's first one a class of their own bytes."""
    runs = np.flatnonzero(own.first[own.cls] != np.arange(len(own.at)))
    start, end = own.context(runs)
    other, other_end = own.context(own.first[own.cls[runs]])
    size = end - start
    differ = (size != other_end - other) | (own.at[runs] - start != own.at[own.first[own.cls[runs]]] - other)
    for o in range(SPAN + LENGTH):
        inside = np.flatnonzero((o < size) & ~differ)
        differ[inside] = own.data[start[inside] + o] != own.data[other[inside] + o]
    fresh: dict[tuple, int] = {}
    more = []
    for k, s, e in zip(runs[differ], start[differ], end[differ], strict=True):
        content = (own.cls[k], own.at[k] - s, own.data[s:e].tobytes())
        if content not in fresh:
            fresh[content] = len(own.first) + len(more)
            more.append(k)
        own.cls[k] = fresh[content]
    if more:
        own.first = np.concatenate((own.first, more))
        own.gram = np.concatenate((own.gram, own.grams[more]))


def _numbers(x: np.ndarray) -> bytes:
    """Integers that mostly rise by little, for the shuffle."""
    return zlib.compress(np.diff(x.astype(np.int64), prepend=np.int64(0)).tobytes(), 1)


def _from_numbers(x: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(x), np.int64))


def _by_bucket(hashes: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Indexes for each bucket, in rising order."""
    bucket = (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return [(int(bucket[x[0]]), x) for x in np.split(order, cuts) if len(x)]


def _hashes(gram: np.ndarray, bits: int) -> np.ndarray:
    return bytehash.mixed(gram) >> np.uint64(64 - bits)


def _bucket_of(hashes: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """By the upper bits, so that sorted hashes have sorted buckets."""
    upper = min(bits, 32)
    return (((hashes >> np.uint64(bits - upper)) * np.uint64(buckets)) >> np.uint64(upper)).astype(np.int64)


def _packed(rising: np.ndarray) -> bytes:
    """Rising numbers as steps of as many bytes as the largest needs."""
    steps = np.diff(rising, prepend=np.uint64(0))
    width = max(1, -(-int(steps[1:].max() if len(steps) > 1 else 0).bit_length() // 8))
    rest = steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(rising[0]).to_bytes(8, "little") + np.ascontiguousarray(rest).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    width, rest = packed[0], np.frombuffer(packed, np.uint8, offset=9).reshape(-1, packed[0])
    steps = np.zeros((len(rest), 8), np.uint8)
    steps[:, :width] = rest
    first = np.array([int.from_bytes(packed[1:9], "little")], np.uint64)
    return np.cumsum(np.concatenate((first, steps.view("<u8").ravel())), dtype=np.uint64)


def _asked(own: Anchors, bits: int, buckets: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """The group's distinct anchors: their hashes, rising, how many contexts each has, and the buckets' ranges."""
    hashes, counts = np.unique(_hashes(own.gram, bits), return_counts=True)
    bucket = _bucket_of(hashes, bits, buckets)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    return hashes, counts, [(int(bucket[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)] if len(hashes) else []


def _requests(bits: int, buckets: int):
    def requests(key: tuple, table: pa.Table) -> pa.Table:
        hashes, counts, ranges = _asked(anchors(table), bits, buckets)
        rows = [(bucket, key[0].as_py(), _packed(hashes[a:b]), zlib.compress(np.minimum(counts[a:b], 255).astype(np.uint8).tobytes(), 1)) for bucket, a, b in ranges]
        return _table(rows, ["bucket", "grp", "keys", "contexts"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])

    return requests


def _table(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _replies(key: tuple, table: pa.Table, hot: int) -> pa.Table:
    """A bucket's replies: for each anchor one byte of SEND, if several groups have it, and MANY contexts."""
    parts = [_unpacked(x.as_py()) for x in _scalars(table, "keys")]
    cuts = np.cumsum([len(x) for x in parts])
    _, which, groups = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    contexts = np.concatenate([np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in _scalars(table, "contexts")])
    total = np.bincount(which, weights=contexts)
    flags = (np.where(groups > 1, SEND, 0) | np.where(total > hot, MANY, 0)).astype(np.uint8)[which]
    grps = table.column("grp").to_pylist()
    rows = [(g, key[0].as_py(), zlib.compress(x.tobytes(), 1)) for g, x in zip(grps, np.split(flags, cuts[:-1]), strict=True)]
    return _table(rows, ["grp", "bucket", "flags"], [pa.int64(), pa.int64(), pa.binary()])


def _scalars(table: pa.Table, name: str) -> list:
    return list(table.column(name).combine_chunks())


def _flags(own: Anchors, got: dict[int, bytes], bits: int, buckets: int) -> np.ndarray:
    """For each context of the group whether its bytes are to be sent."""
    hashes, _, ranges = _asked(own, bits, buckets)
    flags = np.zeros(len(hashes), dtype=np.uint8)
    for bucket, a, b in ranges:
        flags[a:b] = np.frombuffer(zlib.decompress(got[bucket]), np.uint8)
    # Anchors that two documents of the group have; its documents are sorted, so the ends tell.
    which = np.searchsorted(hashes, _hashes(own.grams, bits))
    doc = own.ids[own.row]
    least, most = np.full(len(hashes), _LAST), np.full(len(hashes), np.iinfo(np.int64).min)
    np.minimum.at(least, which, doc)
    np.maximum.at(most, which, doc)
    flags[least < most] |= SEND
    return flags[np.searchsorted(hashes, _hashes(own.gram, bits))]


@dataclass
class Pieces:
    """Byte ranges of a group's text to sort: start, end, and the first and last string start in each."""

    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def _strings(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    rows = np.lib.stride_tricks.as_strided(data, shape=(len(data) - LENGTH + 1, LENGTH), strides=(1, 1))
    return np.ascontiguousarray(rows[at])


def _distinct(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the strings at `at`: where each distinct one is first, and which of these each is. Some are compared at a time, and
    then those that are left."""

    def unique(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, first, inverse = np.unique(_strings(data, places).view(np.dtype((np.void, LENGTH))).ravel(), return_index=True, return_inverse=True)
        return first, inverse

    firsts, inverses, left = [], [], 0
    for a in range(0, len(at), STRINGS):
        first, inverse = unique(at[a : a + STRINGS])
        firsts.append(first + a)
        inverses.append(inverse + left)
        left += len(first)
    firsts = np.concatenate(firsts)
    again, inverse = unique(at[firsts])
    return firsts[again], inverse[np.concatenate(inverses)]


def _pieces(own: Anchors, flags: np.ndarray) -> tuple[Pieces, np.ndarray, tuple[np.ndarray, ...]]:
    """The pieces to send; the contexts that are a piece each; and, of the others, for each string its
    context, its start and its piece."""
    plain = np.flatnonzero((flags & (SEND | MANY)) == SEND)
    runs = own.first[plain]
    start, end = own.context(runs)
    low, high, doc, anchor = own.low[runs], own.high[runs], own.ids[own.row[runs]], own.at[runs] - start
    hashes = bytehash.mixed(own.gram[plain])
    many = np.flatnonzero((flags & (SEND | MANY)) == (SEND | MANY))
    runs = own.first[many]
    counts = own.high[runs] - own.low[runs] + 1
    which = np.repeat(np.arange(len(many)), counts)
    at = own.low[runs][which] + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    if len(at):
        first, inverse = _distinct(own.data, at)
        whole = _strings(own.data, at[first])
        flat = bytehash.Prefix(whole.ravel())
        begins = np.arange(len(first)) * LENGTH
        digest = bytehash.mixed(flat.of(begins, begins + LENGTH))
        start = np.concatenate((start, at[first]))
        end = np.concatenate((end, at[first] + LENGTH))
        low, high = np.concatenate((low, at[first])), np.concatenate((high, at[first]))
        anchor = np.concatenate((anchor, np.full(len(first), STRING)))
        doc = np.concatenate((doc, own.ids[own.row[runs]][which[first]]))
        hashes = np.concatenate((hashes, digest))
        strings = many[which], at, len(plain) + inverse
    else:
        strings = many[which], at, at
    return Pieces(start, end, low, high, anchor, doc, hashes), plain, strings


def _take(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The ranges' bytes one after the other, some at a time: their places take eight times their own room."""
    ends = np.cumsum(end - start)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=data.dtype)
    a = 0
    while a < len(ends):
        done = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + bytehash.PIECE, side="right")))
        size = end[a:b] - start[a:b]
        shift = np.repeat(start[a:b] - (np.cumsum(size) - size), size)
        out[done : int(ends[b - 1])] = data[np.arange(len(shift)) + shift]
        a = b
    return out


def _by_bucket_name(replies: pa.Table, name: str) -> dict[int, bytes]:
    return {b: x for b, x in zip(replies.column("bucket").to_pylist(), replies.column(name).to_pylist(), strict=True) if x}


def _contexts(bits: int, buckets: int):
    def contexts(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["bucket", "grp", "bytes", "shape", "docs"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        if not docs.num_rows or not replies.num_rows:
            return _table([], names, types)
        own = anchors(docs)
        pieces, _, _ = _pieces(own, _flags(own, _by_bucket_name(replies, "flags"), bits, buckets))
        rows = []
        for bucket, x in _by_bucket(pieces.hash, buckets):
            s, e = pieces.start[x], pieces.end[x]
            shape = np.stack([e - s, pieces.low[x] - s, pieces.high[x] - s, pieces.anchor[x]], axis=1).astype(np.uint8)
            rows.append((bucket, key[0].as_py(), zlib.compress(_take(own.data, s, e).tobytes(), 1), shape.tobytes(), _numbers(pieces.doc[x])))
        return _table(rows, names, types)

    return contexts


def _alike(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of bytes, whose number a row divides by eight: one of each, and which one each row is."""
    words = rows.view("<u8")
    mixed = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(words.shape[1]):
            mixed = bytehash.mixed(mixed * np.uint64(3) + words[:, i])
    _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
    if not (words == words[first[which]]).all():
        _, first, which = np.unique(rows.view(np.dtype((np.void, rows.shape[1]))).ravel(), return_index=True, return_inverse=True)
    return first, which


def _sorted_bucket(key: tuple, table: pa.Table) -> pa.Table:
    """For each piece of a bucket a mask of its strings that a smaller doc_id has too.

    Pieces of the same bytes are one, that of the smallest doc_id, and all strings of its copies repeat. Of
    these, only pieces whose anchor has several go into the sort; the others' strings have no equals.
    """
    text = np.concatenate([np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in _scalars(table, "bytes")])
    parts = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, 4) for x in _scalars(table, "shape")]
    cuts, shape = np.cumsum([len(x) for x in parts]), np.concatenate(parts)
    docs = np.concatenate([_from_numbers(x.as_py()) for x in _scalars(table, "docs")])
    width = SPAN + LENGTH
    rows = np.zeros((len(shape), width + 4), np.uint8)
    rows[:, :width][np.arange(width) < shape[:, :1]] = text
    rows[:, width:] = shape
    first, which = _alike(rows)
    least = np.full(len(first), _LAST, dtype=np.int64)
    np.minimum.at(least, which, docs)
    size, low, high, anchor = shape[first].astype(np.int64).T
    every = (np.uint64(1) << (high - low + 1).astype(np.uint64)) - np.uint64(1)

    mask = np.zeros(len(first), np.uint64)
    plain = np.flatnonzero(anchor != STRING)
    if len(plain):
        gram = np.take_along_axis(rows[first[plain]], anchor[plain][:, None] + np.arange(GRAM), axis=1)
        _, of, many = np.unique(_alike(gram)[1], return_inverse=True, return_counts=True)
        plain = plain[many[of] > 1]
    if len(plain):
        size, low, counts = size[plain], low[plain], (high - low + 1)[plain]
        text = rows[first[plain]][:, :width][np.arange(width) < size[:, None]]
        piece = np.repeat(np.arange(len(plain)), counts)
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        classes = equal_classes(text, (np.cumsum(size) - size + low)[piece] + nth, LENGTH)
        earliest = np.full(classes.max() + 1, _LAST, dtype=np.int64)
        np.minimum.at(earliest, classes, least[plain][piece])
        repeated = least[plain][piece] > earliest[classes]
        mask[plain] = np.bincount(piece, weights=repeated * np.exp2(nth), minlength=len(plain)).astype(np.uint64)
    masks = np.where(docs > least[which], every[which], mask[which]).astype(np.uint32)
    grps = table.column("grp").to_pylist()
    rows = [(g, key[0].as_py(), zlib.compress(x.tobytes(), 1)) for g, x in zip(grps, np.split(masks, cuts[:-1]), strict=True)]
    return _table(rows, ["grp", "bucket", "masks"], [pa.int64(), pa.int64(), pa.binary()])


def _removed(own: Anchors, flags: np.ndarray, masks: dict[int, bytes], buckets: int) -> np.ndarray:
    """Which bytes of the group's text go."""
    edges = np.zeros(len(own.data) + 1, dtype=np.int32)

    def strike(low: np.ndarray, high: np.ndarray) -> None:
        np.add.at(edges, low, 1)
        np.add.at(edges, high + LENGTH, -1)

    doc, owner = own.ids[own.row], own.ids[own.row[own.first]]
    whole = doc > owner[own.cls]
    strike(own.low[whole], own.high[whole])
    pieces, plain, (context, at, which) = _pieces(own, flags)
    got = np.zeros(len(pieces.start), dtype=np.uint32)
    for bucket, x in _by_bucket(pieces.hash, buckets):
        got[x] = np.frombuffer(zlib.decompress(masks[bucket]), np.uint32)
    # Every run of the context's first document has the same strings.
    mask = np.zeros(len(own.first), dtype=np.uint32)
    mask[plain] = got[: len(plain)]
    runs = np.flatnonzero(~whole & (mask[own.cls] > 0))
    for o in range(SPAN + 1):
        hit = runs[(mask[own.cls[runs]] >> np.uint32(o)) & np.uint32(1) > 0]
        at_o = own.low[hit] + o
        strike(at_o, at_o)
    if len(at):
        string = (got[which] > 0) | (owner[context] > pieces.doc[which])
        shift, context = (at - own.low[own.first[context]])[string], context[string]
        order = np.argsort(context, kind="stable")
        context, shift = context[order], shift[order]
        runs = np.flatnonzero(~whole & np.isin(own.cls, context))
        a, b = np.searchsorted(context, own.cls[runs]), np.searchsorted(context, own.cls[runs], side="right")
        at_o = np.repeat(own.low[runs], b - a) + shift[np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())]
        strike(at_o, at_o)
    return np.cumsum(edges[:-1]) > 0


def _results(bits: int, buckets: int, carry: pa.Schema | None):
    """carry: other columns of the documents to return beside the text, in place of the digest."""

    def results(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return (RESULT if carry is None else pa.schema([*carry, ("text", pa.string())])).empty_table()
        own = anchors(docs)
        flags = _flags(own, _by_bucket_name(replies, "flags"), bits, buckets)
        masks = _by_bucket_name(replies, "masks")
        gone = _removed(own, flags, masks, buckets)
        begins = gone & ~np.concatenate(([False], gone[:-1])) if len(gone) else gone
        first = own.offsets[:-1][np.diff(own.offsets) > 0]
        if len(gone):
            begins[first] = gone[first]
        total, spans = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(begins)))
        a, b = own.offsets[:-1], own.offsets[1:]
        kept = [own.data[s:e][~gone[s:e]].tobytes() if total[e] > total[s] else own.data[s:e].tobytes() for s, e in zip(a, b, strict=True)]
        if carry is not None:
            texts = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
            rest = [docs.column(c).take(pa.array(own.order)).combine_chunks().cast(carry.field(c).type) for c in carry.names]
            return pa.table([*rest, texts], names=[*carry.names, "text"])
        return pa.table(
            [
                pa.array(own.ids, pa.int64(), mask=own.ids == _LAST),
                pa.array(b - a),
                pa.array(total[b] - total[a], pa.int64()),
                pa.array(spans[b] - spans[a], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                pa.array(kept, pa.binary()),
            ],
            schema=RESULT,
        )

    return results


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
)


def _replied(dealt: DataFrame, bits: int, buckets: int, hot: int) -> DataFrame:
    """All replies to the groups: of anchors (flags) and of pieces (masks)."""

    def replied(key: tuple, table: pa.Table) -> pa.Table:
        return _replies(key, table, hot)

    dealt = dealt.select("doc_id", "text", "grp")
    requests = dealt.groupBy("grp").applyInArrow(_requests(bits, buckets), "bucket long, grp long, keys binary, contexts binary")
    replies = settle(requests.groupBy("bucket").applyInArrow(replied, "grp long, bucket long, flags binary"))
    contexts = (
        dealt.groupBy("grp").cogroup(replies.groupBy("grp"))
        .applyInArrow(_contexts(bits, buckets), "bucket long, grp long, bytes binary, shape binary, docs binary")
    )
    masks = settle(contexts.groupBy("bucket").applyInArrow(_sorted_bucket, "grp long, bucket long, masks binary"))
    return replies.withColumn("masks", F.lit(None).cast("binary")).unionByName(masks.withColumn("flags", F.lit(None).cast("binary")))


def _dealt(documents: DataFrame, group_bytes: int, bucket_contexts: int) -> tuple[DataFrame, int, int]:
    """The documents with their group, as a table in buckets of groups; bits of an anchor's hash; buckets of anchors.

    Rows are dealt evenly, whatever their doc_id or text. At least as many table buckets as a shuffle has
    partitions, so that the planner keeps the table as it lies and brings the replies to it.
    """
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups, buckets = max(1, -(-size // group_bytes)), max(1, -(-2 * size // (SPAN * bucket_contexts)))
    bits = min(60, SPARE + max(8, (2 * size // SPAN).bit_length()))
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(groups, -(-size // FILE_BYTES)))
    dealt = documents.withColumn("grp", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)))
    name = f"tracemill_{uuid.uuid4().hex}"
    dealt.repartition(files, "grp").write.bucketBy(files, "grp").option("path", f"{shared_folder(spark)}/table").saveAsTable(name, format="parquet")
    return spark.table(name), bits, buckets


def remove_repeats(
    documents: DataFrame, group_bytes: int = GROUP_BYTES, bucket_contexts: int = BUCKET_CONTEXTS, hot: int = HOT
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt, bits, buckets = _dealt(plain, group_bytes, bucket_contexts)
    return dealt.groupBy("grp").cogroup(_replied(dealt, bits, buckets, hot).groupBy("grp")).applyInArrow(
        _results(bits, buckets, None), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def clean_texts(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with what is left of their texts; of a code point that lost some of its
    bytes the others go too."""
    from pyspark.sql.pandas.types import to_arrow_schema

    # Under names of their own, as columns of the input may have those used here.
    rest = [c for c in documents.columns if c not in ("doc_id", "text")]
    named = documents.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(rest)])
    dealt, bits, buckets = _dealt(named, GROUP_BYTES, BUCKET_CONTEXTS)
    carried = named.drop("text")
    found = dealt.groupBy("grp").cogroup(_replied(dealt, bits, buckets, HOT).groupBy("grp")).applyInArrow(
        _results(bits, buckets, to_arrow_schema(carried.schema)), carried.schema.add("text", "string")
    )
    back = {c: F.col(f"_{i}").alias(c) for i, c in enumerate(rest)}
    return found.select(*[back.get(c, F.col(c)) for c in documents.columns])
