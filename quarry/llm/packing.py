"""Best-fit packing of tokenised documents into fixed-length sequences.

Texts become token ids in the scan's tasks; only lengths go further. The
plan is made on the histogram of lengths, which the capacity bounds:
lengths over a third of the capacity share a sequence at most two at a time
and are matched greedily (the longest with the longest that still fits);
shorter ones then go, longest first, into the smallest gap that takes them.
Pieces of one length are interchangeable, so a plan line says which ranks
of a length go where, and every piece finds its place by its rank.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.store import written
from quarry.llm.vec import (LOWER, buffer_of, mix, prefix_hash, runs, span_hash, text_slices, word_spans)

CAPACITY = 4096
END_ID = 1
BUCKET_ROWS = 20_000
_SLICE = 2 << 20
_KNOWN_WORDS = 1 << 20

# Byte classes of the quick path: 0 other printable ASCII, 1 letters (ASCII,
# and the two bytes of the letters U+00C0 to U+00FF), 2 digits, 3 anything
# whose words the tokenizer takes whole.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[33:127] = 0
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[48:58] = 2
_CLASS[39] = 3
_CLASS[9:14] = _CLASS[32] = 4


class WordTokens:
    """Ids of texts under a BPE file with word ends, lower case and no white
    space (``word_bpe_49k.json``), from cached ids of units.

    A unit is a run of letters, one digit or a run of other printable
    characters inside a word; words with apostrophes, control characters or
    characters beyond U+00FF are units as a whole and go through the file's
    own normaliser and splitter. Every token that ends a unit of the quick
    path ends in the word-end mark, which is how many units come apart again
    after one call.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.quick = Tokenizer.from_file(path)
        self.quick.normalizer = None
        self.quick.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, units: list[bytes], whole: np.ndarray) -> None:
        sizes = np.zeros(len(units), np.int64)
        begin = np.zeros(len(units), np.int64)
        parts, filled = [self.ids], len(self.ids)
        easy = np.flatnonzero(~whole)
        for a in range(0, len(easy), 2000):
            part = easy[a:a + 2000]
            text = b" ".join([units[i] for i in part]).decode()
            ids = np.array(self.quick.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                raise ValueError("a unit did not come back as one run of tokens")
            sizes[part] = np.diff(stops, prepend=0)
            begin[part] = filled + stops - sizes[part]
            parts.append(ids)
            filled += len(ids)
        hard = np.flatnonzero(whole)
        texts = [units[i].decode() for i in hard]
        for i, e in zip(hard, self.whole.encode_batch_fast(texts, add_special_tokens=False)):
            parts.append(np.array(e.ids, np.uint32))
            sizes[i], begin[i] = len(e.ids), filled
            filled += len(e.ids)
        self.ids = np.concatenate(parts)
        k = np.concatenate([self.keys, keys])
        order = np.argsort(k)
        self.keys = k[order]
        self.at = np.concatenate([self.at, begin])[order]
        self.size = np.concatenate([self.size, sizes])[order]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        buf, starts, _ = buffer_of(texts)
        n = len(starts)
        if len(buf) == 0:
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        cls = _CLASS[buf]
        lead = buf == 0xC3
        nxt = np.append(buf[1:], 0)
        latin = lead & (nxt >= 0x80) & (nxt <= 0xBF) & (nxt != 0x97) & (nxt != 0xB7)
        cls[latin] = 1
        cls[np.flatnonzero(latin) + 1] = 1
        low = LOWER[buf]
        # upper-case letters U+00C0 to U+00DE lie 0x20 below their lower case; sharp s has none
        second = np.flatnonzero(latin) + 1
        up = second[(buf[second] <= 0x9E)]
        low[up] += 0x20
        ws, we = word_spans(buf)
        marks = np.flatnonzero(cls == 3)
        for token in self.special:  # their strings are one token each wherever they stand
            found = [m.start() for m in re.finditer(re.escape(token), buf.tobytes())]
            marks = np.append(marks, np.array(found, np.int64))
        hit = np.unique(np.searchsorted(ws, marks, side="right") - 1).astype(np.int64)
        label = cls
        if len(hit):
            label = cls.copy()
            label[np.arange((we - ws)[hit].sum()) + np.repeat(
                ws[hit] - np.cumsum((we - ws)[hit]) + (we - ws)[hit], (we - ws)[hit])] = 5
        kept_whole = label == 5
        edge = np.empty(len(label), bool)
        edge[0] = True
        np.not_equal(label[1:], label[:-1], out=edge[1:])
        edge |= label == 2  # every digit on its own
        at = np.flatnonzero(edge)
        end = np.append(at[1:], len(buf))
        real = label[at] != 4
        at, end = at[real], end[real]
        whole = label[at] == 5
        # whole words keep their own bytes: lower-casing them is the tokenizer's work
        src = np.where(kept_whole, buf, low)
        key = span_hash(prefix_hash(src), at, end)
        key = np.where(whole, mix(key), key)
        order = np.argsort(key)
        first = runs(key[order])
        uniq = key[order][first]
        where = np.searchsorted(self.keys, uniq)
        known = np.zeros(len(uniq), bool)
        if len(self.keys):
            known = self.keys[np.minimum(where, len(self.keys) - 1)] == uniq
        new = order[first][~known]
        if len(new):
            data = src.tobytes()
            if len(self.keys) + len(new) > _KNOWN_WORDS:
                self._reset()
                new = order[first]
            self._learn(key[new], [data[a:b] for a, b in zip(at[new], end[new])], whole[new])
        slot = np.searchsorted(self.keys, uniq)
        inverse = np.empty(len(key), np.int64)
        inverse[order] = np.repeat(slot, np.diff(np.append(first, len(key))))
        sizes = self.size[inverse]
        stop = np.cumsum(sizes)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.at[inverse] - (stop - sizes), sizes)]
        doc = np.searchsorted(starts, at, side="right") - 1
        return ids, np.bincount(doc, sizes, minlength=n).astype(np.int64)


_loaded: dict[str, WordTokens] = {}


def _tokens(path: str) -> WordTokens:
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def default_tokenizer() -> str:
    """Place of the public vocabulary file, on the machine that asks."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids and
    end id, cut every ``capacity`` ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokens(tokenizer or default_tokenizer())
        for batch in batches:
            for a, b in text_slices(batch["text"], _SLICE):
                ids, sizes = tok.encode(batch["text"].slice(a, b - a))
                row, piece, start, length, crc = [], [], [], [], []
                at = 0
                for i, size in enumerate(sizes):
                    mine = np.append(ids[at:at + size], np.uint32(END_ID)).astype("<u4")
                    at += size
                    for k in range(0, len(mine), capacity):
                        cut = mine[k:k + capacity]
                        row.append(a + i)
                        piece.append(k // capacity)
                        start.append(k)
                        length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Plan lines ``(length, first rank, ranks, first sequence, per sequence,
    offset)``: rank r of that length, ``k = r - first rank``, goes to sequence
    ``first + k // per`` at ``offset + (k % per) * length``."""
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    lines: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences) with that gap
    order: list[int] = []  # gaps in use, ascending
    sequences = 0

    def put(length: int, first: int, n: int, per: int, offset: int) -> None:
        lines.append((length, rank[length], n, first, per, offset))
        rank[length] += n
        left[length] -= n

    def gap(size: int, first: int, n: int) -> None:
        if size > 0 and n > 0:
            if size not in gaps:
                bisect.insort(order, size)
            gaps.setdefault(size, []).append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        k = bisect.bisect_right(large, capacity - a) - 1
        while k >= 0 and left[large[k]] - (large[k] == a) <= 0:
            k -= 1
        if k < 0:
            n = left[a]
            put(a, sequences, n, 1, 0)
            gap(capacity - a, sequences, n)
        else:
            b = large[k]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            put(a, sequences, n, 1, 0)
            put(b, sequences, n, 1, a)
            gap(capacity - a - b, sequences, n)
        sequences += n
        large = [x for x in large if left[x]]
    for a in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[a]:
            k = bisect.bisect_left(order, a)
            if k == len(order):
                per = capacity // a
                n = -(-left[a] // per)
                gap(capacity, sequences, n)
                sequences += n
                continue
            g = order[k]
            first, n = gaps[g].pop()
            if not gaps[g]:
                del gaps[g]
                order.pop(k)
            per = g // a
            full = min(n, left[a] // per)
            offset = capacity - g
            if full:
                put(a, first, full * per, per, offset)
                gap(g - per * a, first, full)
            some = left[a] if full < n else 0
            if some:
                put(a, first + full, some, some, offset)
                gap(g - some * a, first + full, 1)
            gap(g, first + full + (some > 0), n - full - (some > 0))
    return np.array(lines, np.int64).reshape(-1, 6)


def ranked(parts: DataFrame) -> DataFrame:
    """``parts`` with ``rank``, 0, 1, ... within each length. Ranks are dealt
    in hash buckets of bounded size with offsets from the buckets' counts, so
    the pieces of one length never meet in one task."""
    total = parts.agg(F.count(F.lit(1))).first()[0]
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(1 + total // BUCKET_ROWS))
    parts = parts.withColumn("_b", bucket)
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = (parts.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
            .select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o")))
    own = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32")
    return (parts.join(base, ["length", "_b"])
            .withColumn("rank", F.col("_o") + F.row_number().over(own) - 1).drop("_b", "_o"))


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A null or empty text is its end id alone; a null id stays null; repeated
    rows are packed each; an empty table gives an empty result; other columns
    are not read. Only the histogram of lengths (at most ``capacity`` rows)
    and the plan made from it pass through the driver.
    """
    parts = written(pieces(docs, capacity, tokenizer), "pieces")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    lines = plan(counts, capacity)
    lines = lines[np.lexsort((lines[:, 1], lines[:, 0]))]
    key = lines[:, 0] << 44 | lines[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, r = (b[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            line = lines[np.searchsorted(key, n << 44 | r, side="right") - 1] if len(n) else lines[:0]
            k = r - line[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(b[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(line[:, 3] + k // line[:, 4]), pa.array(line[:, 5] + k % line[:, 4] * n)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
