"""Suffix-array dedup: bytes of long strings that an earlier document holds.

All occurrences of one 50-byte string must meet. So texts are cut, by their
content alone, into anchors: byte grams whose hash is the least in some
string's worth of grams. Every 50-byte string holds an anchor, the same one
wherever it stands; an anchor with the bytes up to 50 around it (its
neighbourhood) holds every such string.

1. Documents are stored in blocks. A block posts each neighbourhood that it
   holds once, however many of its documents do, with their smallest id.
   Partitions of the anchors' hashes answer: nothing (one document only);
   the smallest id of all, where every neighbourhood of the anchor is the
   same, a copy; or a number, where neighbourhoods differ.
2. One copy of each neighbourhood that differs goes to its partition. Those
   that share neither side's nearer half with another of their anchor share no
   string; of the others, the suffix array is made by induced sorting (``suffix.py``), and runs of
   suffixes with 50 bytes in common, by the permuted common prefixes, are the
   strings that neighbourhoods share; each takes the smallest document id of
   its run. An anchor with more different neighbourhoods than one sort should
   hold is not sorted: its 50-byte strings are dealt anew by their own hashes,
   each once a block with the block's smallest document, and partitions of
   these hashes answer the smallest of all.
3. Blocks drop the bytes of strings whose smallest id is below the document's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.jaccard import partition_bits
from quarry.llm.store import written
from quarry.llm.suffix import common_prefixes, suffix_array
from quarry.llm.vec import (buffer_of, expand, fold, mix, powers, prefix_hash, runs, span_hash, squeeze, steps,
                            text_slices)

LENGTH = 50
GRAM = 16
SIDE = LENGTH - GRAM
#: Grams of a string; the anchor is the least of as many.
WINDOW = SIDE + 1
ANCHOR_BITS = 46
COPY_BITS = 40
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 1 << 19
#: Different neighbourhoods of one anchor that are sorted together: a megabyte of them.
MOST_SORTED = (1 << 20) // (LENGTH + SIDE)
#: Bytes hashed at a time: their hashes stay in the cache of a core.
_SLICE = 1 << 17
#: Where ranges of the bytes of a string before its anchor begin.
_EDGES = (0, WINDOW // 2 + 1, WINDOW)
_LAST = 2 ** 63 - 1
_TOP = np.uint64(2 ** 64 - 1)


def _slide(x: np.ndarray, op) -> np.ndarray:
    """``op`` (minimum or maximum) over every WINDOW values, by windows of
    twice the length each time and two that overlap at the end."""
    n, out, width = len(x), x, 1
    while 2 * width <= WINDOW:
        out = op(out[:len(out) - width], out[width:])
        width *= 2
    rest = WINDOW - width
    return op(out[:n - WINDOW + 1], out[rest:rest + n - WINDOW + 1]) if rest else out


def anchors(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash of the gram, hash of the neighbourhood) of the anchors of
    all texts. Of equal least grams every one is an anchor."""
    n = len(buf)
    none = np.zeros(0, np.uint64)
    if n < LENGTH:
        return np.zeros(0, np.int64), none, none
    h = prefix_hash(buf)
    g = mix((h[GRAM:] - h[:-GRAM]) * powers(n + 1)[1][:n - GRAM + 1])  # span_hash of every gram
    text = np.zeros(n + 1, np.int32)
    text[ends[ends < n] + 1] = 1
    text = np.cumsum(text, dtype=np.int32)  # of each byte; a gap belongs to the text before it
    gap = np.zeros(n + 1, bool)
    gap[ends] = True
    m = n - GRAM + 1
    g[(text[GRAM - 1:n] != text[:m]) | gap[GRAM - 1:n]] = _TOP
    least = _slide(g, np.minimum)
    k = len(least)
    inside = (text[LENGTH - 1:LENGTH - 1 + k] == text[:k]) & ~gap[LENGTH - 1:LENGTH - 1 + k]
    least = np.where(inside, least, np.uint64(0))
    pad = np.zeros(WINDOW - 1, np.uint64)
    at = np.flatnonzero((g == _slide(np.concatenate([pad, least, pad]), np.maximum)[:m]) & (g != _TOP))
    row = text[at]
    lo, hi = np.maximum(at - SIDE, starts[row]), np.minimum(at + LENGTH, ends[row])
    # least values crowd near zero: hashed again, they spread over the partitions
    return at, mix(g[at]) >> np.uint64(64 - ANCHOR_BITS), span_hash(h, lo, hi) >> np.uint64(64 - COPY_BITS)


class _Text:
    """A stored block: document ids (null ones last of all) and their texts."""

    def __init__(self, meta: bytes, text: bytes):
        self.ids, null, size = expand(meta)
        self.null = null.astype(bool)
        self.order = np.where(self.null, _LAST, self.ids)
        size = size.astype(np.int64)
        self.buf = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8)
        self.starts = np.cumsum(size + 1) - size - 1
        self.ends = self.starts + size

    def slices(self) -> Iterator[tuple[int, int]]:
        a = 0
        while a < len(self.starts):
            b = max(a + 1, int(np.searchsorted(self.ends, self.starts[a] + _SLICE, side="right")))
            yield a, b
            a = b


_STORED = "block long, meta binary, text binary"


def store_blocks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, total = TaskContext.get().partitionId() << 32, [], 0
        press = zstandard.ZstdCompressor(level=3)

        def flush() -> pa.RecordBatch:
            ids = [x for p in parts for x in p[0]]
            meta = squeeze(np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids], np.uint8),
                           np.concatenate([p[1] for p in parts]).astype(np.uint64))
            text = press.compress(b"".join(p[2] for p in parts))
            parts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([meta], pa.binary()), pa.array([text], pa.binary())],
                names=["block", "meta", "text"])

        for batch in batches:
            for a, b in text_slices(batch["text"]):
                buf, starts, ends = buffer_of(batch["text"].slice(a, b - a))
                parts.append((batch["doc_id"].slice(a, b - a).to_pylist(), ends - starts, buf.tobytes()))
                total += len(buf)
                if total >= BLOCK_BYTES:
                    yield flush()
                    number, total = number + 1, 0
        if parts:
            yield flush()

    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return src.mapInArrow(run, _STORED)


@dataclass
class _Found:
    """A block's anchors in order of gram, neighbourhood and document order:
    ``place`` and the bytes ``left`` and ``right`` of it, ``own`` order of the
    document; ``head`` marks the first of equal neighbourhoods."""

    gram: np.ndarray
    copy: np.ndarray
    place: np.ndarray
    left: np.ndarray
    right: np.ndarray
    own: np.ndarray
    head: np.ndarray

    @staticmethod
    def of(t: _Text) -> _Found:
        place, gram, copy = [], [], []
        for a, b in t.slices():
            base = t.starts[a]
            at, g, c = anchors(t.buf[base:t.ends[b - 1] + 1], t.starts[a:b] - base, t.ends[a:b] - base)
            place.append(at + base)
            gram.append(g)
            copy.append(c)
        place, gram, copy = np.concatenate(place), np.concatenate(gram), np.concatenate(copy)
        row = np.searchsorted(t.starts, place, side="right") - 1
        left = np.minimum(place - t.starts[row], SIDE)
        right = np.minimum(t.ends[row] - place, LENGTH)
        own = t.order[row]
        order = np.flatnonzero(left + right >= LENGTH)  # others hold no string
        # one number holds the gram and the copy's first bits; only equal ones need the rest
        key = gram[order] << np.uint64(64 - ANCHOR_BITS) | copy[order] >> np.uint64(COPY_BITS + ANCHOR_BITS - 64)
        by_key = np.argsort(key)
        order, key = order[by_key], key[by_key]
        equal = np.append(key[1:] == key[:-1], False)[:len(key)]
        equal[1:] |= equal[:-1].copy()
        at = np.flatnonzero(equal)
        some = order[at]
        order[at] = some[np.lexsort((own[some], copy[some], key[at]))]
        gram, copy = gram[order], copy[order]
        head = np.ones(len(gram), bool)
        head[1:] = (gram[1:] != gram[:-1]) | (copy[1:] != copy[:-1])
        return _Found(gram, copy, place[order], left[order], right[order], own[order], head)


_ROWS = "kind int, p int, block long, data binary"
#: kinds of rows: a partition's answer to a block and what it knows of its numbered
#: neighbourhoods; a block's bytes to drop, places that wait for the sorting, a copy of a
#: neighbourhood, and the numbers it wants; the answer to that; strings of anchors that are
#: not sorted, with the places they come from, and their smallest documents
_TELL, _INFO, _DROP, _WAIT, _SEND, _WANT, _HELD, _STRINGS, _PLACES, _LEAST = range(10)


def _table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                    names=[c.split()[0] for c in _ROWS.split(", ")])


def _cuts(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, begin, end) of each run."""
    begin = runs(sorted_values)
    return [(int(sorted_values[a]), a, b) for a, b in zip(begin, np.append(begin[1:], len(sorted_values)))]


def _ask(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, meta, text in zip(batch["block"].to_pylist(), batch["meta"], batch["text"]):
                f = _Found.of(_Text(meta.as_py(), text.as_py()))
                first = np.flatnonzero(f.head)
                if not len(first):
                    continue
                last = np.append(first[1:], len(f.head)) - 1
                least, several = f.own[first], (f.own[last] > f.own[first]).astype(np.uint8)
                gram, copy = f.gram[first], f.copy[first]
                rows = [(0, p, number, squeeze(steps(gram[a:b]), copy[a:b], least[a:b], several[a:b]))
                        for p, a, b in _cuts(gram >> np.uint64(ANCHOR_BITS - bits))]
                yield from _table(rows).to_batches()
    return run


def _tell(most: int):
    def run(table: pa.Table) -> pa.Table:
        p, blocks = table["p"][0].as_py(), table["block"].to_pylist()
        parts = [expand(d.as_py()) for d in table["data"]]
        cut = np.cumsum([len(x[0]) for x in parts])[:-1]
        gram = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
        copy, least, several = (np.concatenate([x[i] for x in parts]) for i in (1, 2, 3))
        del parts
        order = np.lexsort((least, copy, gram))
        gram, copy, least, several = gram[order], copy[order], least[order], several[order]
        begin = runs(gram)
        size = np.diff(np.append(begin, len(gram)))
        low, high = np.minimum.reduceat(least, begin), np.maximum.reduceat(least, begin)
        live = (low < high) | np.maximum.reduceat(several, begin).astype(bool)
        head = np.ones(len(gram), bool)
        head[1:] = (gram[1:] != gram[:-1]) | (copy[1:] != copy[:-1])
        different = np.add.reduceat(head.astype(np.int64), begin)
        code = np.repeat(np.where(live & (different > 1), np.where(different > most, 3, 2), live.astype(np.int64)), size).astype(np.uint8)
        in_mixed = code == 2
        number = np.cumsum(head & in_mixed) - 1  # of each neighbourhood that differs from others of its anchor
        value = np.where(in_mixed, 2 * number + head, np.repeat(low, size))  # odd: this block sends it
        back_code, back_value = np.empty_like(code), np.empty_like(value)
        back_code[order], back_value[order] = code, value
        rows = [(_TELL, p, b, squeeze(c, v[c > 0])) for b, c, v in
                zip(blocks, np.split(back_code, cut), np.split(back_value, cut))]
        own = np.flatnonzero(head & in_mixed)
        group = np.repeat(np.arange(len(size)), size)[own]
        rows.append((_INFO, p, None, squeeze(np.diff(group, prepend=group[:1]).astype(np.uint32), least[own])))
        return _table(rows)
    return run


def _ranges(start: np.ndarray, end: np.ndarray) -> bytes:
    """Byte ranges, overlapping ones put together."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    end = end[np.append(first[1:], len(new)) - 1] if len(new) else end
    return squeeze(np.diff(start[first], prepend=0).astype(np.uint32), (end - start[first]).astype(np.uint32))


def _local(bits: int):
    def run(mine: pa.Table, told: pa.Table) -> pa.Table:
        if not len(told):
            return _table([])
        number = mine["block"][0].as_py()
        t = _Text(mine["meta"][0].as_py(), mine["text"][0].as_py())
        f = _Found.of(t)
        got = [expand(d) for _, d in sorted(zip(told["p"].to_pylist(), told["data"].to_pylist()))]
        code = np.concatenate([x[0] for x in got])
        value = np.zeros(len(code), np.int64)
        value[code > 0] = np.concatenate([x[1] for x in got])
        which = np.cumsum(f.head) - 1
        code_of, value_of = code[which], value[which]
        rows = []
        gone = (code_of == 1) & (f.own > value_of)
        if gone.any():
            rows.append((_DROP, None, number, _ranges((f.place - f.left)[gone], (f.place + f.right)[gone])))
        at = np.flatnonzero(code_of == 2)
        part = (f.gram[at] >> np.uint64(ANCHOR_BITS - bits)).astype(np.int64)
        for p, a, b in _cuts(part):
            x = at[a:b]
            name = value_of[x] >> 1
            # the places wait here, in order of number
            order = np.argsort(name, kind="stable")
            x, name = x[order], name[order]
            rows.append((_WAIT, p, number, squeeze(np.diff(name, prepend=0).astype(np.uint32), f.place[x].astype(np.uint32),
                                                   f.left[x].astype(np.uint8), f.right[x].astype(np.uint8))))
            rows.append((_WANT, p, number, squeeze(np.diff(np.unique(name), prepend=0).astype(np.uint32))))
            y = x[f.head[x] & (value_of[x] & 1 == 1)]
            if len(y):
                size = f.left[y] + f.right[y]
                flat = t.buf[np.arange(size.sum()) + np.repeat((f.place - f.left)[y] - (np.cumsum(size) - size), size)]
                rows.append((_SEND, p, number, squeeze((value_of[y] >> 1).astype(np.uint32), f.left[y].astype(np.uint8),
                                                       f.right[y].astype(np.uint8), flat)))
        at = np.flatnonzero(code_of == 3)
        if len(at):
            at = at[np.argsort(f.place[at], kind="stable")]
            places = f.place[at], f.left[at], f.right[at]
            rows.append((_PLACES, None, number, squeeze(np.diff(places[0], prepend=0).astype(np.uint32),
                                                        places[1].astype(np.uint8), places[2].astype(np.uint8))))
            (first, second, least), _, _ = _strings(t, *places)
            rows += [(_STRINGS, p, number, squeeze(steps(first[a:b]), second[a:b], least[a:b]))
                     for p, a, b in _cuts(first >> np.uint64(64 - bits) if bits else np.zeros(len(first), np.uint64))]
        return _table(rows)
    return run


def _strings(t: _Text, place: np.ndarray, left: np.ndarray, right: np.ndarray):
    """((hash, other hash, smallest document) of the different strings of
    these neighbourhoods in order of hash, and for every string of every
    neighbourhood, which of them it is and where it starts)."""
    count = left + right - LENGTH + 1
    start = np.arange(count.sum()) + np.repeat(place - left - (np.cumsum(count) - count), count)
    start = np.unique(start)  # neighbourhoods overlap
    first, second = np.empty(len(start), np.uint64), np.empty(len(start), np.uint32)
    for a, b in t.slices():
        x, y = np.searchsorted(start, (t.starts[a], t.ends[b - 1]))
        if x < y:  # other slices are not hashed
            h = prefix_hash(t.buf[t.starts[a]:t.ends[b - 1]])
            at = start[x:y] - t.starts[a]
            half, end = at + LENGTH // 2, at + LENGTH
            first[x:y] = span_hash(h, at, end)
            second[x:y] = fold(span_hash(h, at, half), span_hash(h, half, end)) >> np.uint64(32)
    own = t.order[np.searchsorted(t.starts, start, side="right") - 1]
    order = np.lexsort((own, second, first))
    first, second = first[order], second[order]
    head = np.ones(len(order), bool)
    head[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(head) - 1
    return (first[head], second[head], own[order][head]), which, start


def _least(table: pa.Table) -> pa.Table:
    """The smallest document of every string, for each block that has it."""
    blocks = table["block"].to_pylist()
    parts = [expand(d.as_py()) for d in table["data"]]
    cut = np.cumsum([len(x[0]) for x in parts])[:-1]
    first = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
    second, least = (np.concatenate([x[i] for x in parts]) for i in (1, 2))
    order = np.lexsort((least, second, first))
    head = np.ones(len(order), bool)
    head[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
    begin = np.flatnonzero(head)
    answer = np.empty(len(order), np.int64)
    answer[order] = np.repeat(least[order][begin], np.diff(np.append(begin, len(order))))
    p = table["p"][0].as_py()
    return _table([(_LEAST, p, b, squeeze(x)) for b, x in zip(blocks, np.split(answer, cut))])


def smallest_holder(flat: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each start in ``flat`` (neighbourhoods end to end) of a string of
    LENGTH bytes within its neighbourhood, the smallest ``doc`` of the
    neighbourhoods that hold the string; others get the largest number."""
    end = np.cumsum(size)
    which = np.repeat(np.arange(len(size)), size)
    s = np.zeros(len(flat) + len(size) + 1, np.int32)
    place = np.arange(len(flat)) + which
    s[place] = flat.astype(np.int32) + 2
    s[end + np.arange(len(size))] = 1
    sa = suffix_array(s, 258, LENGTH)
    starts = np.flatnonzero(np.arange(len(flat)) + LENGTH <= end[which])
    # only where a string begins can one be held in common
    common = np.zeros(len(s), np.int64)
    common[place[starts]] = common_prefixes(s, sa, LENGTH, place[starts], exact=False)
    holder = np.full(len(s), _LAST)
    holder[place[starts]] = doc[which[starts]]
    begin = np.flatnonzero(common[sa] < LENGTH)
    least = np.minimum.reduceat(holder[sa], begin)
    shared = np.empty(len(s), np.int64)
    shared[sa] = np.repeat(least, np.diff(np.append(begin, len(s))))
    out = np.full(len(flat), _LAST)
    out[starts] = shared[place[starts]]
    return out


def may_share(flat: np.ndarray, group: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which neighbourhoods (end to end in ``flat``, in order of group, with
    ``left`` bytes before the anchor's place and ``right`` from there) may hold
    a string that another of their group holds: a string that starts from ``a``
    to ``b`` - 1 bytes before the anchor has all that starts ``a`` bytes before
    it and ends where one that starts ``b`` - 1 bytes before it does."""
    out, place = np.zeros(len(group), bool), np.cumsum(left + right) - right
    for a, b in zip(_EDGES, _EDGES[1:]):
        before, after = a, LENGTH - b + 1
        at = np.flatnonzero((left >= before) & (right >= after))
        start, key, x = place[at] - before, np.empty(len(at), np.uint64), 0
        while x < len(at):
            y = max(x + 1, int(np.searchsorted(start, start[x] + _SLICE)))
            h, own = prefix_hash(flat[start[x]:start[y - 1] + before + after]), start[x:y] - start[x]
            key[x:y] = fold(group[at[x:y]].astype(np.uint64), span_hash(h, own, own + before + after))
            x = y
        order = np.argsort(key)
        key = key[order]
        twice = np.append(key[1:] == key[:-1], False)[:len(at)]
        twice[1:] |= twice[:-1].copy()
        out[at[order[twice]]] = True
    return out


def _sorted_holders(flat: np.ndarray, group: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """:func:`smallest_holder` over whole groups, some at a time."""
    end, holder, a = np.cumsum(size), np.empty(len(flat), np.int64), 0
    while a < len(size):
        b = int(np.searchsorted(end, end[a] - size[a] + SHARD_BYTES, side="right"))
        b = int(np.searchsorted(group, group[min(max(b - 1, a), len(size) - 1)], side="right"))
        x, y = end[a] - size[a], end[b - 1]
        holder[x:y] = smallest_holder(flat[x:y], size[a:b], doc[a:b])
        a = b
    return holder


def _answer(table: pa.Table) -> pa.Table:
    """Sort a partition's neighbourhoods; for each block that wants some, the
    smallest holder of every string of them."""
    kinds = table["kind"].to_pylist()
    rows = {k: [(b, d.as_py()) for x, b, d in zip(kinds, table["block"].to_pylist(), table["data"]) if x == k]
            for k in (_INFO, _SEND, _WANT)}
    step, doc = expand(rows[_INFO][0][1]) if rows[_INFO] else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    if not len(doc):
        return _table([])
    group, left, right = np.cumsum(step, dtype=np.int64), *np.zeros((2, len(doc)), np.int64)
    sent = [expand(d) for _, d in rows[_SEND]]
    for v, m, n, _ in sent:
        left[v], right[v] = m, n
    size = left + right
    end = np.cumsum(size)
    flat = np.zeros(int(end[-1]), np.uint8)
    for v, _, _, text in sent:
        n = size[v]
        flat[np.arange(n.sum()) + np.repeat((end - size)[v] - (np.cumsum(n) - n), n)] = text
    del sent
    some = may_share(flat, group, left, right)
    inside = np.repeat(some, size)
    holder = np.repeat(doc, size)  # of the others, their own document
    holder[inside] = _sorted_holders(flat[inside], group[some], size[some], doc[some])
    out, p = [], table["p"][0].as_py()
    for block, data in rows[_WANT]:
        v = np.cumsum(expand(data)[0], dtype=np.int64)
        n = size[v] - LENGTH + 1
        out.append((_HELD, p, block, squeeze(n.astype(np.uint8), holder[
            np.arange(n.sum()) + np.repeat((end - size)[v] - (np.cumsum(n) - n), n)])))
    return _table(out)


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _shared_ranges(t: _Text, wait: bytes, held: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges that waiting places drop: strings a smaller id holds."""
    step, place, left, right = expand(wait)
    n, holder = expand(held)
    place, left = place.astype(np.int64), left.astype(np.int64)
    name = np.cumsum(step, dtype=np.int64)
    which = np.cumsum(np.append(0, name[1:] != name[:-1]))  # the wanted numbers, in order
    begin = np.cumsum(n.astype(np.int64)) - n
    own = t.order[np.searchsorted(t.starts, place, side="right") - 1]
    starts = np.arange(WINDOW)
    ok = starts < n[which][:, None]
    gone = ok & (holder[np.minimum(begin[which][:, None] + starts, max(len(holder) - 1, 0))] < own[:, None])
    edge = np.diff(gone.astype(np.int8), axis=1, prepend=0, append=0)
    row, x = np.nonzero(edge == 1)
    _, y = np.nonzero(edge == -1)
    base = (place - left)[row]
    return base + x, base + y - 1 + LENGTH


def _finish(mine: pa.Table, rows: pa.Table) -> pa.Table:
    t = _Text(mine["meta"][0].as_py(), mine["text"][0].as_py())
    start, end = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    of = {k: {} for k in (_DROP, _WAIT, _HELD, _PLACES, _LEAST)}
    for kind, p, d in zip(rows["kind"].to_pylist(), rows["p"].to_pylist(), rows["data"]):
        of[kind][p] = d
    for d in of[_DROP].values():
        step, n = expand(d.as_py())
        start.append(np.cumsum(step, dtype=np.int64))
        end.append(start[-1] + n)
    for p, d in of[_WAIT].items():
        a, b = _shared_ranges(t, d.as_py(), of[_HELD][p].as_py())
        start.append(a)
        end.append(b)
    for d in of[_PLACES].values():
        step, left, right = (x.astype(np.int64) for x in expand(d.as_py()))
        _, which, begin = _strings(t, np.cumsum(step), left, right)
        least = np.concatenate([expand(of[_LEAST][p].as_py())[0] for p in sorted(of[_LEAST])])
        gone = begin[least[which] < t.order[np.searchsorted(t.starts, begin, side="right") - 1]]
        start.append(gone)
        end.append(gone + LENGTH)
    mark = np.bincount(np.concatenate(start), minlength=len(t.buf) + 1).astype(np.int32)
    mark -= np.bincount(np.concatenate(end), minlength=len(t.buf) + 1).astype(np.int32)
    gone = np.cumsum(mark[:-1], dtype=np.int32) > 0
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    total = np.concatenate([[0], np.cumsum(gone)])
    begun = np.concatenate([[0], np.cumsum(first)])
    removed = total[t.ends] - total[t.starts]
    raw = t.buf.tobytes()
    digest = [hashlib.sha256(raw[a:b] if not r else t.buf[a:b][~gone[a:b]].tobytes()).hexdigest()
              for a, b, r in zip(t.starts, t.ends, removed)]
    return pa.table([pa.array(t.ids, pa.int64(), mask=t.null), pa.array(t.ends - t.starts), pa.array(removed),
                     pa.array(begun[t.ends] - begun[t.starts]), pa.array(digest)],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs) and kept_sha256, the digest of the bytes left.

    Removed is every UTF-8 byte covered by a 50-byte string that also starts
    in a document with a smaller doc_id; strings never cross documents, and
    all are judged on the input. A null or empty text has no bytes; a null id
    is larger than all others; rows of equal id take nothing from each other;
    an empty table gives an empty result; other columns are not read.
    Neighbourhoods are told apart by 86 bits of hash, the strings that they
    share by sorting; strings of an anchor with over MOST_SORTED different
    neighbourhoods by 96 bits of hash.
    """
    stored = written(store_blocks(docs), "repeat-blocks")
    size = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    bits = partition_bits(size, 1.6e7)
    told = written(stored.mapInArrow(_ask(bits), _ROWS).groupBy("p").applyInArrow(_tell(MOST_SORTED), _ROWS), "repeat-anchors")
    kind = F.col("kind")
    local = written(stored.groupBy("block").cogroup(told.filter(kind == _TELL).groupBy("block"))
                    .applyInArrow(_local(bits), _ROWS), "repeat-places")
    held = (told.filter(kind == _INFO).unionByName(local.filter(kind.isin(_SEND, _WANT)))
            .groupBy("p").applyInArrow(_answer, _ROWS))
    least = local.filter(kind == _STRINGS).groupBy("p").applyInArrow(_least, _ROWS)
    rows = local.filter(kind.isin(_DROP, _WAIT, _PLACES)).unionByName(held).unionByName(least)
    return stored.groupBy("block").cogroup(rows.groupBy("block")).applyInArrow(_finish, SCHEMA)
