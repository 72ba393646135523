"""Katz backoff language model, trained and evaluated where the data lies.

Documents become blocks of token numbers with a block's own vocabulary,
stored once. Blocks post their distinct words and word pairs with training
counts to hash partitions, which answer with the counts over everything, and
choose one owner block for each pair. From counts of counts come the
Good-Turing discounts. Owners sum, for each history, what its seen words
hold of the lower order; partitions add these up to backoff weights that
make every history's probabilities sum to exactly one; with them each block
scores its documents, seen pairs by their discounted count and others by
recursion to the lower order.

The count tables are partitioned by hash throughout: no task and never the
driver holds the model, and all that moves grows with the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.jaccard import HASH_BITS, partition_bits
from quarry.llm.store import written
from quarry.llm.vec import (LOWER, buffer_of, expand, fold, prefix_hash, runs, span_hash, squeeze, steps, text_slices,
                            word_spans)

#: Counts up to this one are discounted.
MAX_DISCOUNT = 5
BLOCK_TOKENS = 2_000_000
END, START = np.uint64(1), np.uint64(2)
_DROP = np.uint64(64 - HASH_BITS)


def held_out(doc_id: int | None) -> bool:
    """Whether the id's text has a CRC-32 of remainder 2 by 7 (a null id: no)."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


# --- blocks ---------------------------------------------------------------------------

@dataclass
class Block:
    """Tokens of some documents: ``vocab`` are the sorted hashes of the
    block's words (with END), ``tokens`` positions in it, document by
    document; ``ids``, ``held`` and ``sizes`` describe the documents."""

    ids: np.ndarray
    null: np.ndarray
    held: np.ndarray
    sizes: np.ndarray
    vocab: np.ndarray
    tokens: np.ndarray

    def pack(self) -> bytes:
        # numbers by falling frequency compress best
        count = np.bincount(self.tokens, minlength=len(self.vocab))
        by = np.argsort(-count, kind="stable")
        number = np.empty(len(by), np.uint32)
        number[by] = np.arange(len(by), dtype=np.uint32)
        return squeeze(self.ids, self.null, self.held, self.sizes.astype(np.uint32), steps(self.vocab), number,
                       number[self.tokens])

    @staticmethod
    def unpack(data: bytes) -> Block:
        ids, null, held, sizes, vocab, number, tokens = expand(data)
        place = np.empty(len(number), np.int64)
        place[number] = np.arange(len(number))
        return Block(ids, null, held, sizes.astype(np.int64), np.cumsum(vocab, dtype=np.uint64), place[tokens])

    def pairs(self) -> Pairs:
        """The distinct (history, word) pairs."""
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        first = np.cumsum(self.sizes) - self.sizes
        before[first] = len(self.vocab)  # the start of a text
        code = before * (len(self.vocab) + 1) + self.tokens
        order = np.argsort(code)
        begin = runs(code[order])
        inverse = np.empty(len(code), np.int64)
        inverse[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(code))))
        code = code[order[begin]]
        history, word = code // (len(self.vocab) + 1), code % (len(self.vocab) + 1)
        names = np.append(self.vocab, START)
        key = fold(names[history], self.vocab[word]) >> _DROP
        return Pairs(history, word, key, inverse)

    def train(self) -> np.ndarray:
        """1.0 for training tokens, else 0.0."""
        return np.repeat(1.0 - self.held, self.sizes)


@dataclass
class Pairs:
    history: np.ndarray
    word: np.ndarray
    key: np.ndarray
    inverse: np.ndarray


def block_of(parts: list[tuple]) -> Block:
    ids, null, held, sizes, words = (np.concatenate([p[i] for p in parts]) for i in range(5))
    order = np.argsort(words)
    begin = runs(words[order])
    tokens = np.empty(len(words), np.int64)
    tokens[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(words))))
    return Block(ids, null, held, sizes, words[order[begin]], tokens)


def tokens_of(ids: pa.Array, texts: pa.Array) -> tuple:
    """(ids, null ids, held out, tokens per text, token hashes): lower-cased
    words, then one END for each text."""
    buf, starts, _ = buffer_of(texts)
    ws, we = word_spans(buf)
    word = span_hash(prefix_hash(LOWER[buf]), ws, we) >> _DROP
    sizes = np.bincount(np.searchsorted(starts, ws, side="right") - 1, minlength=len(texts)).astype(np.int64) + 1
    out = np.empty(len(word) + len(texts), np.uint64)
    end = np.zeros(len(out), bool)
    end[np.cumsum(sizes) - 1] = True
    out[end], out[~end] = END, word
    plain = ids.to_pylist()
    return (np.array([x or 0 for x in plain], np.int64), np.array([x is None for x in plain], np.uint8),
            np.array([held_out(x) for x in plain], np.uint8), sizes, out)


def blocks(docs: DataFrame) -> DataFrame:
    """(block, data) with every document's tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, n = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            data = block_of(parts).pack()
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([data], pa.binary())],
                                              names=["block", "data"])

        for batch in batches:
            for a, b in text_slices(batch["text"]):
                parts.append(tokens_of(batch["doc_id"].slice(a, b - a), batch["text"].slice(a, b - a)))
                n += len(parts[-1][-1])
                if n >= BLOCK_TOKENS:
                    yield flush()
                    number, n = number + 1, 0
        if parts:
            yield flush()

    src = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return src.mapInArrow(run, "block long, data binary")


def dealt(keys: np.ndarray, bits: int, *values: np.ndarray) -> dict[int, tuple[np.ndarray, ...]]:
    """partition -> (keys in order, their values), by the keys' leading bits."""
    order = np.argsort(keys)
    keys = keys[order]
    part = (keys >> np.uint64(HASH_BITS - bits)).astype(np.int64)
    begin = runs(part)
    return {int(part[a]): (keys[a:b], *(v[order[a:b]] for v in values))
            for a, b in zip(begin, np.append(begin[1:], len(part)))}


# --- counts ---------------------------------------------------------------------------

_STATS = [f"n{i}" for i in range(1, MAX_DISCOUNT + 2)] + [f"u{i}" for i in range(1, MAX_DISCOUNT + 2)] + ["v", "n"]
_ASK = "p int, block long, pairs binary, words binary"
_TOLD = "block long, p int, pairs binary, words binary, " + ", ".join(f"{c} long" for c in _STATS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    cols = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, (_, t) in enumerate(cols)],
                                      names=[c for c, _ in cols])


def _ask_counts(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch["block"].to_pylist(), batch["data"]):
                block = Block.unpack(data.as_py())
                pairs, train = block.pairs(), block.train()
                p = dealt(pairs.key, bits, np.bincount(pairs.inverse, train, len(pairs.key)).astype(np.uint32))
                w = dealt(block.vocab, bits, np.bincount(block.tokens, train, len(block.vocab)).astype(np.uint32))
                none = (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
                rows = []
                for k in sorted(p.keys() | w.keys()):
                    (pk, pc), (wk, wc) = p.get(k, none), w.get(k, none)
                    rows.append((k, number, squeeze(steps(pk), pc), squeeze(steps(wk), wc)))
                yield _batch(rows, _ASK)
    return run


def _total(parts: list[list[np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each part's keys (as steps) and counts: their totals times two, plus one in
    the first part that has the key; and the totals of the distinct keys."""
    size = [len(k) for k, _ in parts]
    key = np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _ in parts])
    count = np.concatenate([c for _, c in parts]).astype(np.int64)
    order = np.argsort(key, kind="stable")
    begin = runs(key[order])
    total = np.add.reduceat(count[order], begin) if len(begin) else np.zeros(0, np.int64)
    out = np.empty(len(key), np.uint64)
    out[order] = 2 * np.repeat(total, np.diff(np.append(begin, len(key)))).astype(np.uint64)
    out[order[begin]] += np.uint64(1)
    return np.split(out, np.cumsum(size)[:-1]), total


def _tell_counts(table: pa.Table) -> pa.Table:
    numbers = table["block"].to_pylist()
    pairs, n = _total([expand(d.as_py()) for d in table["pairs"]])
    words, u = _total([expand(d.as_py()) for d in table["words"]])
    p = table["p"][0].as_py()
    stats = [int((n == i).sum()) for i in range(1, MAX_DISCOUNT + 2)] + [
        int((u == i).sum()) for i in range(1, MAX_DISCOUNT + 2)] + [int((u > 0).sum()), int(u.sum())]
    rows = [(b, p, squeeze(x), squeeze(y), *[None] * len(stats)) for b, x, y in zip(numbers, pairs, words)]
    return pa.Table.from_batches([_batch([*rows, (None, p, None, None, *stats)], _TOLD)])


# --- the model ------------------------------------------------------------------------

def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """Good-Turing discounts of counts 0 (unused) to MAX_DISCOUNT; where the
    estimate is not between 0 and 1, as with few data, half an event is
    taken off instead."""
    n = [0, *counts_of_counts]
    d = np.ones(MAX_DISCOUNT + 1)
    k = MAX_DISCOUNT
    common = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        x = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0.0
        d[r] = x if 0 < x < 1 else 1 - 0.5 / r
    return d


@dataclass
class Model:
    """What all tasks know: totals and discounts (a few numbers)."""

    tokens: int
    types: int
    texts: int
    pair: np.ndarray
    word: np.ndarray
    unknown: float
    scale: float

    @staticmethod
    def of(n: list[int], u: list[int], types: int, tokens: int, texts: int) -> Model:
        d = discounts(u)
        # mass that the discounts free, for the one unknown word
        free = sum((1 - d[i]) * i * u[i - 1] for i in range(1, MAX_DISCOUNT + 1)) / tokens if tokens else 1.0
        scale = 1.0
        if free <= 0:  # no rare word: one more event makes room
            scale, free = tokens / (tokens + 1), 1 / (tokens + 1)
        return Model(tokens, types, texts, discounts(n), d, free, scale)

    def lower(self, count: np.ndarray) -> np.ndarray:
        """Probability of words by their training count."""
        cut = self.word[np.minimum(count, MAX_DISCOUNT)] * (count <= MAX_DISCOUNT) + (count > MAX_DISCOUNT)
        return np.where(count > 0, self.scale * cut * count / max(self.tokens, 1), self.unknown)

    def seen(self, count: np.ndarray, of: np.ndarray, full: np.ndarray) -> np.ndarray:
        """Probability of pairs seen ``count`` times after a history seen
        ``of`` times; ``full`` where the history frees no mass otherwise."""
        cut = self.pair[np.minimum(count, MAX_DISCOUNT)] * (count <= MAX_DISCOUNT) + (count > MAX_DISCOUNT)
        return cut * count / np.maximum(of + full, 1)


_NAMED = [f"c{i}" for i in range(1, MAX_DISCOUNT + 1)]
_ASK_H = "p int, block long, data binary"


def _answers(table: pa.Table, column: str) -> np.ndarray:
    """A block's answers from all partitions, in order of key."""
    parts = sorted(zip(table["p"].to_pylist(), table[column]), key=lambda x: x[0])
    got = [expand(d.as_py())[0] for _, d in parts]
    return np.concatenate(got) if got else np.zeros(0, np.uint64)


def _counted(mine: pa.Table, told: pa.Table) -> tuple[Block, Pairs, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block with the counts of its words, histories and pairs, and which pairs it owns."""
    block = Block.unpack(mine["data"][0].as_py())
    pairs = block.pairs()
    words = (_answers(told, "words") >> np.uint64(1)).astype(np.int64)
    flat = _answers(told, "pairs")
    answer = np.empty(len(flat), np.uint64)
    answer[np.argsort(pairs.key)] = flat
    return block, pairs, words, (answer >> np.uint64(1)).astype(np.int64), (answer & np.uint64(1)).astype(bool), answer


def _ask_weights(model: Model, bits: int):
    def run(mine: pa.Table, told: pa.Table) -> pa.Table:
        block, pairs, words, count, own, _ = _counted(mine, told)
        names = np.append(block.vocab, START)
        of = np.append(words, model.texts)
        use = own & (count > 0)
        lower = np.bincount(pairs.history[use], model.lower(words[pairs.word[use]]), len(names))
        named = [np.bincount(pairs.history[use & (count == i)], minlength=len(names)).astype(np.uint32)
                 for i in range(1, MAX_DISCOUNT + 1)]
        some = np.flatnonzero(of > 0)
        rows = [(p, mine["block"][0].as_py(), squeeze(steps(k), *v))
                for p, (k, *v) in dealt(names[some], bits, of[some].astype(np.uint32), lower[some],
                                        *(c[some] for c in named)).items()]
        return pa.Table.from_batches([_batch(rows, _ASK_H)])
    return run


def _tell_weights(model: Model):
    def run(table: pa.Table) -> pa.Table:
        parts = [expand(d.as_py()) for d in table["data"]]
        size = [len(x[0]) for x in parts]
        key = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
        order = np.argsort(key, kind="stable")
        begin = runs(key[order])
        of = np.concatenate([x[1] for x in parts])[order[begin]].astype(float)
        add = lambda i: np.add.reduceat(np.concatenate([x[i] for x in parts]).astype(float)[order], begin)
        lower = np.minimum(add(2), 1 - model.unknown)
        free = sum((1 - model.pair[i]) * i * add(2 + i) for i in range(1, MAX_DISCOUNT + 1))
        full = free <= 0
        # minus: this history's probabilities are over one event more
        weight = np.where(full, -1 / (of + 1), free / of) / (1 - lower)
        out = np.empty(len(key))
        out[order] = np.repeat(weight, np.diff(np.append(begin, len(key))))
        p = table["p"][0].as_py()
        rows = [(p, b, squeeze(x)) for b, x in zip(table["block"].to_pylist(), np.split(out, np.cumsum(size)[:-1]))]
        return pa.Table.from_batches([_batch(rows, _ASK_H)])
    return run


SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def probabilities(model: Model, block: Block, pairs: Pairs, words: np.ndarray, count: np.ndarray,
                  weight: np.ndarray) -> np.ndarray:
    """log10 probability of the block's distinct pairs. ``weight`` is each
    history's backoff weight (1 for an unseen one)."""
    of = np.append(words, model.texts)[pairs.history]
    w = weight[pairs.history]
    seen = model.seen(count, of, w < 0)
    return np.log10(np.where(count > 0, seen, np.abs(w) * model.lower(words[pairs.word])))


def _score(model: Model):
    def run(mine: pa.Table, told: pa.Table) -> pa.Table:
        counts = told.filter(pa.compute.is_valid(told["words"]))
        weights = told.filter(pa.compute.is_valid(told["data"]))
        block, pairs, words, count, _, _ = _counted(mine, counts)
        names = np.append(block.vocab, START)
        some = np.flatnonzero(np.append(words, model.texts) > 0)
        weight = np.ones(len(names))
        weight[some[np.argsort(names[some])]] = _answers(weights, "data")
        log = probabilities(model, block, pairs, words, count, weight)
        doc = np.repeat(np.arange(len(block.sizes)), block.sizes)
        n = len(block.sizes)
        base = np.log10((words + 1) / (model.tokens + model.types + 1))
        cols = [pa.array(block.ids, pa.int64(), mask=block.null.astype(bool)), pa.array(block.held.astype(bool)),
                pa.array(block.sizes), pa.array(np.bincount(doc, words[block.tokens] > 0, n).astype(np.int64)),
                pa.array(np.full(n, model.tokens)), pa.array(np.bincount(doc, base[block.tokens], n)),
                pa.array(np.bincount(doc, log[pairs.inverse], n))]
        return pa.table(dict(zip([c.split()[0] for c in SCHEMA.split(", ")], cols)))
    return run


def language_model_scores(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score and score, the model's log10 probability of the
    whole text. The model learns from the rows that are not held out.

    Tokens are the words between white space with A-Z lower-cased, then one
    end. A null or empty text is its end alone; a null id is not held out;
    repeated rows count and are scored each; with nothing to learn from,
    every probability is one unknown word's, 1; an empty table gives an empty
    result; other columns are not read. Words are told apart by 52-bit
    hashes. A word never seen in training is the one unknown word.
    """
    stored = written(blocks(docs), "katz-blocks")
    size = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    bits = partition_bits(size, 2e7)
    told = written(stored.mapInArrow(_ask_counts(bits), _ASK).groupBy("p").applyInArrow(_tell_counts, _TOLD),
                   "katz-counts")
    s = told.filter("block is null").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _STATS]).first()
    texts = docs.filter(~F.coalesce(F.pmod(F.crc32(docs["doc_id"].cast("long").cast("string")), F.lit(7)) == 2,
                                    F.lit(False))).count()
    model = Model.of([s[f"n{i}"] for i in range(1, MAX_DISCOUNT + 2)], [s[f"u{i}"] for i in range(1, MAX_DISCOUNT + 2)],
                     s["v"], s["n"], texts)
    told = told.filter("block is not null").select("block", "p", "pairs", "words")
    weights = (stored.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_ask_weights(model, bits), _ASK_H)
               .groupBy("p").applyInArrow(_tell_weights(model), _ASK_H))
    answers = told.withColumn("data", F.lit(None).cast("binary")).unionByName(
        weights.select("block", "p", F.lit(None).cast("binary").alias("pairs"),
                       F.lit(None).cast("binary").alias("words"), "data"))
    return stored.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(model), SCHEMA)
