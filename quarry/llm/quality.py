"""Quality rules: fixed base rules, then gradient-boosted trees over document
statistics, flattened into numpy node arrays and scored in whole batches.

The trees are fitted by logistic boosting on histograms of a bounded sample
of labelled rows (``max_fit_rows``, lowest hash of the id first, so the same
rows at any partitioning). Chosen statistics carry a monotone constraint: a
split on one is only allowed when its children's values run in the allowed
direction, and children inherit value bounds, so the score can never rise
with, say, the share of repeated words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.store import written
from quarry.llm.vec import (SPACE, buffer_of, fold, mix, prefix_hash, runs, span_hash, text_slices, window_hash,
                            word_spans)

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: statistic -> allowed direction of the score in it (0: free)
STATISTICS = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "alpha_share": 0, "upper_share": 0, "digit_share": 0, "punct_share": 0, "distinct_share": 0,
    "words_per_line": 0, "top_word_share": 0,
}
REPEAT_WORDS = 8


def _class_sums(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[ends] - total[starts]


def statistics_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts and the trees' statistics of every text."""
    buf, starts, ends = buffer_of(texts)
    n = len(starts)
    h = prefix_hash(buf)
    ws, we = word_spans(buf)
    word = span_hash(h, ws, we)
    doc = np.searchsorted(starts, ws, side="right") - 1
    code = (buf & 0xC0) != 0x80  # first byte of a code point
    in_word = code & ~SPACE[buf]
    n_words = np.bincount(doc, minlength=n)
    word_chars = _class_sums(in_word, starts, ends)
    symbols = _class_sums(SYMBOLS[buf], starts, ends)

    # lines of a text that hold a word and equal an earlier line of it
    cut = np.unique(np.concatenate([np.flatnonzero(buf == 10), ends]))
    ls = np.concatenate([[0], cut[:-1] + 1])[:len(cut)]
    le = cut
    with_word = np.searchsorted(ws, le) > np.searchsorted(ws, ls)
    ls, le = ls[with_word], le[with_word]
    ldoc = np.searchsorted(starts, ls, side="right") - 1
    key = fold(span_hash(h, ls, le), mix(ldoc.astype(np.uint64)) ^ (le - ls).astype(np.uint64))
    order = np.argsort(key, kind="stable")
    again = np.ones(len(key), bool)
    again[runs(key[order])] = False
    dup_lines = np.bincount(ldoc[order[again]], minlength=n)
    n_lines = np.bincount(ldoc, minlength=n)

    # words covered by an 8-word window that occurs twice or more in its text
    repeat = np.zeros(n, np.int64)
    win = window_hash(word, REPEAT_WORDS)
    if len(win):
        d = doc[:len(win)]
        inside = d == doc[REPEAT_WORDS - 1:]
        at = np.flatnonzero(inside)
        key = fold(win[at], mix(d[at].astype(np.uint64)))
        order = np.argsort(key)
        ks = key[order]
        first = runs(ks)
        size = np.diff(np.concatenate([first, [len(ks)]]))
        hit = at[order[np.repeat(size > 1, size)]]
        cover = np.zeros(len(word) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + REPEAT_WORDS, -1)
        repeat = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)

    # distinct words and the share of the most frequent one
    key = fold(word, mix(doc.astype(np.uint64)))
    order = np.argsort(key)
    first = runs(key[order])
    size = np.diff(np.concatenate([first, [len(key)]]))
    fdoc = doc[order[first]] if len(key) else doc
    distinct = np.bincount(fdoc, minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, fdoc, size)

    letters = ((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 128) & code
    w, c = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
        "n_repeat_words": repeat,
        "log_words": np.log1p(n_words), "mean_word": word_chars / w, "symbol_share": symbols / c,
        "dup_line_share": dup_lines / np.maximum(n_lines, 1), "repeat_share": repeat / w,
        "alpha_share": _class_sums(letters, starts, ends) / c,
        "upper_share": _class_sums((buf >= 65) & (buf <= 90), starts, ends) / c,
        "digit_share": _class_sums((buf >= 48) & (buf <= 57), starts, ends) / c,
        "punct_share": _class_sums(np.isin(buf, np.frombuffer(b".,;:!?'\"()-", np.uint8)), starts, ends) / c,
        "distinct_share": distinct / w, "words_per_line": n_words / np.maximum(n_lines, 1),
        "top_word_share": top / w,
    }


@dataclass
class Trees:
    """Boosted trees as node arrays: node i tests ``x[feature[i]] <= cut[i]``
    and goes to ``left[i]`` or ``right[i]``; a leaf has feature -1."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality for every row of ``x``; all rows and all
        trees go down one level at a time."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                go = x[rows, np.maximum(f, 0)] <= self.cut[at]
                at = np.where(f < 0, at, np.where(go, self.left[at], self.right[at]))
            out += self.value[at]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, directions: np.ndarray, n_trees: int = 60, depth: int = 3,
              bins: int = 32, rate: float = 0.2, l2: float = 1.0, min_rows: int = 10) -> Trees:
    """Logistic gradient boosting on quantile histograms with monotone
    constraints. Without two classes the trees are empty and the score is the
    log odds of the classes (0 with no rows)."""
    pos, neg = float(np.sum(y)), float(len(y) - np.sum(y))
    start = float(np.log((pos + 1) / (neg + 1)))
    nodes: list[list[float]] = []  # feature, cut, left, right, value
    roots: list[int] = []
    if pos and neg:
        cuts = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        raw = np.full(len(y), start)

        def grow(idx: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
            gs, hs = g[idx].sum(), h[idx].sum()
            me = len(nodes)
            nodes.append([-1, 0.0, -1, -1, rate * float(np.clip(gs / (hs + l2), low, high))])
            if level == depth or len(idx) < 2 * min_rows:
                return me
            best = (1e-6, -1, 0, 0.0, 0.0)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[idx, j]
                gl = np.cumsum(np.bincount(b, g[idx], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[idx], len(c) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                vl = np.clip(gl / (hl + l2), low, high)
                vr = np.clip((gs - gl) / (hs - hl + l2), low, high)
                gain = gl ** 2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs ** 2 / (hs + l2)
                ok = (nl >= min_rows) & (len(idx) - nl >= min_rows)
                if directions[j]:
                    ok &= directions[j] * (vr - vl) >= 0
                gain = np.where(ok, gain, -1.0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k, float(vl[k]), float(vr[k]))
            _, j, k, vl, vr = best
            if j < 0:
                return me
            mid = (vl + vr) / 2
            d = directions[j]
            go = binned[idx, j] <= k
            nodes[me][0], nodes[me][1] = j, float(cuts[j][k])
            nodes[me][2] = grow(idx[go], g, h, level + 1, mid if d < 0 else low, mid if d > 0 else high)
            nodes[me][3] = grow(idx[~go], g, h, level + 1, mid if d > 0 else low, mid if d < 0 else high)
            return me

        everyone = np.arange(len(y))
        for _ in range(n_trees):
            p = 1 / (1 + np.exp(-raw))
            first = len(nodes)
            roots.append(grow(everyone, y - p, p * (1 - p), 0, -np.inf, np.inf))
            tree = _arrays(start, [first], nodes, depth)
            raw += tree.score(x) - start
    return _arrays(start, roots, nodes, depth)


def _arrays(start: float, roots: list[int], nodes: list[list[float]], depth: int) -> Trees:
    a = np.array(nodes or [[-1, 0, -1, -1, 0.0]], float)
    return Trees(start, np.array(roots, np.int64), a[:, 0].astype(np.int64), a[:, 1], a[:, 2].astype(np.int64),
                 a[:, 3].astype(np.int64), a[:, 4], depth)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of base counts and statistics per row, in the scan's tasks."""
    names = [*BASE, *STATISTICS]
    schema = "doc_id long, " + ", ".join(f"{c} {'long' if c in BASE else 'double'}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch["text"]):
                s = statistics_of(batch["text"].slice(a, b - a))
                cols = [pa.array(s[c], pa.int64() if c in BASE else pa.float64()) for c in names]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), *cols], names=["doc_id", *names])

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, schema)


def fit(stats: DataFrame, labels: DataFrame, max_fit_rows: int = 20_000, label_col: str = "quality") -> Trees:
    """Trees from at most ``max_fit_rows`` labelled documents (those whose id
    hashes lowest). Rows with a null id or label are left out; an id with
    several labels counts with its lowest."""
    lab = (labels.select(labels["doc_id"].cast("long").alias("_id"), labels[label_col].cast("int").alias("_y"))
           .dropna().groupBy("_id").agg(F.min("_y").alias("_y")))
    # rows far beyond the bound are left out by their hash before any task sorts them
    share = 1.2 * max_fit_rows / max(1, lab.count())
    if share < 1:
        lab = lab.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * share))
    one = stats.dropDuplicates(["doc_id"])
    rows = (lab.join(one, lab["_id"] == one["doc_id"]).select("_y", "doc_id", *STATISTICS)
            .orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)), "doc_id").limit(max_fit_rows).toPandas())
    x = rows[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS))
    return fit_trees(x, (rows["_y"].to_numpy(int) > 0).astype(float), np.array(list(STATISTICS.values())))


def score(stats: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """Base counts, ``base_failed``, the trees' probability and ``kept``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in STATISTICS], axis=1)
            p = 1 / (1 + np.exp(-trees.score(x)))
            words = batch["n_words"].to_numpy(zero_copy_only=False)
            failed = (words < 20) | (100 * batch["n_repeat_words"].to_numpy(zero_copy_only=False) > 30 * words)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("doc_id", *BASE)), pa.array(failed), pa.array(~failed & (p >= threshold)),
                 pa.array(p)], names=["doc_id", *BASE, "base_failed", "kept", "probability"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE)
    return stats.mapInArrow(run, schema + ", base_failed boolean, kept boolean, probability double")


def quality_rules(docs: DataFrame, labels: DataFrame, max_fit_rows: int = 20_000,
                  threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: base counts, ``base_failed``, ``kept``
    and the trees' ``probability``.

    A null or empty text has no words and fails the base rules; a null id
    stays null; repeated rows each give their row; an empty table gives an
    empty result; without labels the trees are empty and only the base rules
    decide (a probability of exactly one half is kept). Statistics are
    written once to the shared folder, so fitting and scoring read numbers
    and not the texts again.
    """
    stats = written(document_statistics(docs), "quality")
    return score(stats, fit(stats, labels, max_fit_rows), threshold)
