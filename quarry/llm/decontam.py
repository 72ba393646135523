"""Benchmark decontamination: word pair seeds, then Smith-Waterman.

The benchmark is taken in blocks of bounded size. A pair is two neighbouring
words of an item; a document holds it if they stand there side by side or
with one word between. Any alignment that scores enough holds so many pairs
of its item (:func:`quota`) that some of them are in every choice of pairs
that leaves out fewer: an item's seeds are all but its most frequent ones,
which one pass over the documents counts. So no copy is lost, however often
an item is copied and whatever an edit leaves of it. A second pass joins
documents to items on seed hits, takes the places where enough of them are
close together, and aligns the words around with the item's words. The local
alignment score, as a share of the score of a full copy, decides; word
edits, insertions and cuts lower it gradually. Items of under five words have
too few pairs to tell an edited copy by; they are found as whole sequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.vec import LOWER, buffer_of, fold, prefix_hash, runs, span_hash, text_slices, window_hash

#: Words from one of a pair to the other, in a document.
STEPS = (1, 2)
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
MIN_ITEM_WORDS = 5
#: Words of the benchmark that the driver and every task hold at a time.
BLOCK_WORDS = 1_000_000
_ALIGN_CELLS = 1 << 20

_PART = np.zeros(256, bool)
_PART[48:58] = _PART[65:91] = _PART[97:123] = True
_PART[128:] = True


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(word hashes, row of each word, rows): runs of ASCII letters and digits
    and of non-ASCII characters, A-Z lower-cased."""
    buf, starts, _ = buffer_of(texts)
    if not len(buf):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), len(starts)
    edge = np.diff(_PART[buf].astype(np.int8), prepend=0, append=0)
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return (span_hash(prefix_hash(LOWER[buf]), a, b), np.searchsorted(starts, a, side="right") - 1, len(starts))


def pairs_of(words: np.ndarray, row: np.ndarray, step: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, word positions) of the words ``step`` apart that lie within one text."""
    inside = np.flatnonzero(row[:-step] == row[step:])
    return fold(words[inside], words[inside + step]), inside


def quota(size: np.ndarray, min_score: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, hits, reach) for items of ``size`` words: how many of an item's
    pairs any alignment scoring ``min_score`` holds, how many of them are
    asked for, and the most words of a document that it covers.

    Of c item words in an alignment u are unmatched, and i words are put in
    between; 2(c - u) - u - i is at least the score T. Matched neighbours
    number c - 1 - 2u at least, of which at most i / 2 have two or more words
    between them. What is left is least at T / 2 - 1 - u / 2 with u at most
    (2n - T) / 3, which is (2T - n) / 3 - 1: a third of the item at half of a
    full score. At lower scores no number is certain and one is asked for."""
    least = np.ceil(MATCH * size * min_score - 1e-9).astype(np.int64)
    pairs = np.maximum(1, -((size + 3 - 2 * least) // 3))
    return pairs, (pairs + 2) // 3, np.maximum(3 * size - least, 1)


@dataclass
class Items:
    """A block of benchmark items: words end to end, and their pairs in order
    of hash (``gram``) with the item and place of each."""

    item_id: list
    words: np.ndarray
    first: np.ndarray
    size: np.ndarray
    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    #: for items of under MIN_ITEM_WORDS words: their number of words, hashes in order, items
    short: list[tuple[int, np.ndarray, np.ndarray]]

    @staticmethod
    def of(ids: list, texts: list) -> Items:
        words, row, n = words_of(pa.array(texts, pa.string()))
        size = np.bincount(row, minlength=n)
        first = np.cumsum(size) - size
        g, at = pairs_of(words, row)
        long_enough = size[row[at]] >= MIN_ITEM_WORDS
        g, at = g[long_enough], at[long_enough]
        order = np.argsort(g, kind="stable")
        g, at = g[order], at[order]
        short = []
        for k in range(1, MIN_ITEM_WORDS):
            which = np.flatnonzero(size == k)
            if len(which):
                h = window_hash(words, k)[first[which]]
                by_hash = np.argsort(h, kind="stable")
                short.append((k, h[by_hash], which[by_hash]))
        return Items(ids, words, first, size, g, row[at], at - first[row[at]], short)

    def seeds(self, counts: np.ndarray, min_score: float) -> Items:
        """Only the pairs that are seeds, given how often each one occurs: so
        many of an item's rarest that an alignment's pairs can't be all others."""
        order = np.lexsort((self.gram, counts, self.item))
        rank = np.empty(len(order), np.int64)
        sorted_items = self.item[order]
        begin = runs(sorted_items)
        rank[order] = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
        pairs, hits, _ = quota(self.size, min_score)
        keep = (rank < (self.size - 1 - pairs + hits)[self.item]) & (counts > 0)
        return Items(self.item_id, self.words, self.first, self.size,
                     self.gram[keep], self.item[keep], self.place[keep], self.short)


def _known(grams: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """A table over the leading bits of hashes that tells most others apart."""
    bits = min(max(16, int(len(grams)).bit_length() + 4), 26)
    shift = np.uint64(64 - bits)
    table = np.zeros(1 << bits, bool)
    table[grams >> shift] = True
    return table, shift


def occurrences(docs: DataFrame, items: Items) -> np.ndarray:
    """How often documents hold each pair of the block (aligned with ``items.gram``)."""
    known = np.unique(items.gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        table, shift = _known(known)
        for batch in batches:
            for a, b in text_slices(batch["text"]):
                words, row, _ = words_of(batch["text"].slice(a, b - a))
                for step in STEPS:
                    g, _ = pairs_of(words, row, step)
                    g = g[table[g >> shift]]
                    where = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    total += np.bincount(where[known[where] == g], minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["gram", "n"])

    out = np.zeros(len(known), np.int64)
    if len(known):
        got = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
        out[got["gram"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out[np.searchsorted(known, items.gram)]


def align(windows: np.ndarray, filled: np.ndarray, items: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best Smith-Waterman score of each row pair and the window column where
    it ends. Rows are padded; ``filled`` and ``sizes`` give their lengths. A
    row of the matrix needs one pass: with linear gaps, the best way to come
    from the left is a running maximum of ``cell - GAP * column``."""
    n, w = windows.shape
    column = np.arange(w, dtype=np.int32)
    real = column[None, :] < filled[:, None]
    above = np.zeros((n, w), np.int32)
    best = np.zeros(n, np.int32)
    end = np.zeros(n, np.int64)
    for i in range(items.shape[1]):
        same = (windows == items[:, i:i + 1]) & real & (i < sizes)[:, None]
        diagonal = np.zeros((n, w), np.int32)
        diagonal[:, 1:] = above[:, :-1]
        here = np.maximum(diagonal + np.where(same, MATCH, MISMATCH), above + GAP)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here - GAP * column, axis=1) + GAP * column
        here[(i >= sizes)] = 0
        top = here.argmax(axis=1)
        value = here[np.arange(n), top]
        better = value > best
        best[better], end[better] = value[better], top[better]
        above = here
    return best, end


def find(texts: pa.Array, seeds: Items, min_score: float, alone: bool = False) -> tuple[np.ndarray, ...]:
    """(row, item index, score, first word, end word, seed hits) of the pairs
    at or over ``min_score``, the best alignment of each. Short items give
    their first whole copy and the number of copies; with ``alone`` only
    where the text has no other words."""
    words, row, _ = words_of(texts)
    return tuple(np.concatenate(x) for x in zip(_aligned(words, row, seeds, min_score), _whole(words, row, seeds, alone)))


def _whole(words: np.ndarray, row: np.ndarray, seeds: Items, alone: bool) -> tuple[np.ndarray, ...]:
    """Copies of short items."""
    found = [np.zeros((5, 0), np.int64)]
    for k, known, which in seeds.short:
        h = window_hash(words, k)
        at = np.flatnonzero(row[:len(h)] == row[k - 1:k - 1 + len(h)])
        if alone:
            size = np.bincount(row)
            at = at[size[row[at]] == k]
        lo, hi = np.searchsorted(known, h[at]), np.searchsorted(known, h[at], side="right")
        count = hi - lo
        item = which[np.arange(count.sum()) + np.repeat(lo - (np.cumsum(count) - count), count)]
        at = np.repeat(at, count)
        order = np.lexsort((at, item, row[at]))
        at, item = at[order], item[order]
        head = runs(row[at] * len(seeds.size) + item)
        first = at[head] - np.searchsorted(row, row[at[head]])
        found.append(np.stack([row[at[head]], item[head], first, first + k, np.diff(np.append(head, len(at)))]))
    doc, item, first, stop, hits = np.concatenate(found, axis=1)
    return doc, item, np.ones(len(doc)), first, stop, hits


def _aligned(words: np.ndarray, row: np.ndarray, seeds: Items, min_score: float) -> tuple[np.ndarray, ...]:
    empty = tuple(np.zeros(0, t) for t in (np.int64, np.int64, float, np.int64, np.int64, np.int64))
    table, shift = _known(seeds.gram)
    found = []
    for step in STEPS:
        g, at = pairs_of(words, row, step)
        maybe = np.flatnonzero(table[g >> shift])
        g, at = g[maybe], at[maybe]
        lo, hi = np.searchsorted(seeds.gram, g), np.searchsorted(seeds.gram, g, side="right")
        count = hi - lo
        which = np.arange(count.sum()) + np.repeat(lo - (np.cumsum(count) - count), count)
        found.append((np.repeat(at, count), seeds.item[which]))
    at, item = (np.concatenate(x) for x in zip(*found))
    if not len(at):
        return empty
    order = np.lexsort((at, item, row[at]))
    at, item = at[order], item[order]
    _, asked, reach = quota(seeds.size, min_score)
    # a hit counts if it and the next ones asked for are no further apart than an alignment reaches
    pair = row[at] * len(seeds.size) + item
    other = np.arange(len(at)) + asked[item] - 1
    last = np.minimum(other, len(at) - 1)
    full = (other < len(at)) & (pair[last] == pair) & (at[last] - at < reach[item])
    cover = np.zeros(len(at) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(full), 1)
    np.add.at(cover, last[full] + 1, -1)
    live = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    at, item, pair = at[live], item[live], pair[live]
    if not len(at):
        return empty
    doc = row[at]
    # a new group of hits where the pair changes or no alignment reaches over the gap
    jump = np.ones(len(at), bool)
    jump[1:] = (pair[1:] != pair[:-1]) | (at[1:] - at[:-1] >= reach[item[1:]])
    begin = np.flatnonzero(jump)
    hits = np.diff(np.append(begin, len(at)))
    last = begin + hits - 1
    doc, item = doc[begin], item[begin]
    size = seeds.size[item]
    text_first = np.searchsorted(row, doc)
    text_end = np.searchsorted(row, doc, side="right")
    a = np.maximum(at[begin] - reach[item], text_first)
    b = np.minimum(at[last] + 1 + reach[item], text_end)
    best, first, stop = np.zeros(len(a)), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    by_width = np.argsort(b - a, kind="stable")
    k = 0
    while k < len(by_width):
        m = k + 1
        while m < len(by_width) and (m + 1 - k) * int((b - a)[by_width[m]]) <= _ALIGN_CELLS:
            m += 1
        part = by_width[k:m]
        k = m
        w, s = int((b - a)[part].max()), int(size[part].max())
        win = words[np.minimum(a[part, None] + np.arange(w), len(words) - 1)]
        its = seeds.words[np.minimum(seeds.first[item[part], None] + np.arange(s), len(seeds.words) - 1)]
        score, end = align(win, (b - a)[part], its, size[part])
        best[part] = score / (MATCH * size[part])
        stop[part] = a[part] + end + 1
        good = np.flatnonzero(best[part] >= min_score)
        for i in good:  # where it begins: the same alignment read backwards from its end
            p = part[i]
            back, where = align(words[a[p]:stop[p]][None, ::-1], np.array([stop[p] - a[p]]),
                                seeds.words[seeds.first[item[p]]:seeds.first[item[p]] + size[p]][None, ::-1],
                                np.array([size[p]]))
            first[p] = stop[p] - where[0] - 1
    ok = np.flatnonzero(best >= min_score)
    ok = ok[np.lexsort((first[ok], -best[ok], item[ok], doc[ok]))]
    if not len(ok):
        return empty
    pair = doc[ok] * len(seeds.size) + item[ok]
    head = runs(pair)
    total = np.add.reduceat(hits[ok], head)
    ok = ok[head]
    base = text_first[ok]
    return doc[ok], item[ok], best[ok], first[ok] - base, stop[ok] - base, total


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The benchmark in blocks of about ``block_words`` words. Block numbers
    come from hash buckets sized by the measured total, so nothing but one
    block is ever on the driver. Null texts and items of under five words
    are no evidence and match nothing."""
    src = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"),
                           F.coalesce(benchmark["text"].cast("string"), F.lit("")).alias("text"))
    total = src.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    count = 1 + total // (2 * block_words)
    for i in range(count):
        part = src if count == 1 else src.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i)
        rows = part.orderBy("item_id", "text").collect()
        if rows:
            yield Items.of([r["item_id"] for r in rows], [r["text"] for r in rows])


SCHEMA = "doc_id long, item_id long, score double, first_word long, end_word long, n_seeds long"


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document row and benchmark item it holds a copy of, exact
    or edited: the alignment's share of a full copy's score, the words
    ``first_word`` to ``end_word`` (exclusive) of the document that it
    covers, and the seed hits behind it. An item of one to four words is
    found only whole and unchanged (score 1, n_seeds its number of copies).

    A null or empty text holds nothing; a null doc_id stays null; repeated
    document rows each give their rows; repeated items match each; equal
    scores go to the earliest place; an empty table on either side gives an
    empty result; other columns are not read.
    """
    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    out = None
    for items in blocks(benchmark):
        seeds = items.seeds(occurrences(src, items), min_score)
        found = src.mapInArrow(_matcher(seeds, min_score), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else src.sparkSession.createDataFrame([], SCHEMA)


def _matcher(seeds: Items, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.array(seeds.item_id, pa.int64())
        for batch in batches:
            for a, b in text_slices(batch["text"]):
                doc, item, *rest = find(batch["text"].slice(a, b - a), seeds, min_score)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(doc + a)), ids.take(pa.array(item)), *map(pa.array, rest)],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])
    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all their columns, that hold no copy of an item;
    decided row by row in the scan, so ids may be null or repeated. A phrase
    of one to four words condemns a document only if it has no other words.
    Null and empty texts stay; without documents or items nothing changes."""
    text = docs.columns.index("text")
    # by position: names may hold dots, which the engine's Arrow map does not take
    out = docs.select(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    schema = out.schema
    for items in blocks(benchmark):
        seeds = items.seeds(occurrences(docs, items), min_score)

        def run(batches: Iterator[pa.RecordBatch], seeds: Items = seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in text_slices(batch.column(text)):
                    part = batch.slice(a, b - a)
                    keep = np.ones(b - a, bool)
                    keep[find(part.column(text), seeds, min_score, alone=True)[0]] = False
                    yield part.filter(pa.array(keep))
        out = out.mapInArrow(run, schema)
    return out.toDF(*docs.columns)
