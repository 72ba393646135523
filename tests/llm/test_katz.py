import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import tuples
from quarry.llm import katz, vec


class Brute:
    """The same model in dictionaries."""

    def __init__(self, rows):
        self.rows = [(i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, self.tokens(t)) for i, t in rows]
        self.uni, self.bi, self.texts = Counter(), Counter(), 0
        for _, held, w in self.rows:
            if not held:
                self.texts += 1
                self.uni.update(w)
                self.bi.update(zip(["<s>", *w], w))
        self.n = sum(self.uni.values())
        c, u = Counter(self.bi.values()), Counter(self.uni.values())
        self.d2, self.d1 = (katz.discounts([x[i] for i in range(1, 7)]) for x in (c, u))
        self.free = sum((1 - self.d1[i]) * i * u[i] for i in range(1, 6)) / self.n if self.n else 1.0
        self.scale = 1.0
        if self.free <= 0:
            self.scale, self.free = self.n / (self.n + 1), 1 / (self.n + 1)
        after = defaultdict(list)
        for (h, w), k in self.bi.items():
            after[h].append((w, k))
        self.weight = {}
        for h, seen in after.items():
            free = sum((1 - self.d2[k]) * k for _, k in seen if k <= 5)
            of = self.of(h)
            self.weight[h] = ((free / of if free > 0 else 1 / (of + 1)) / (1 - sum(self.lower(w) for w, _ in seen)), free <= 0)

    @staticmethod
    def tokens(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")), None]

    def of(self, h):
        return self.texts if h == "<s>" else self.uni[h]

    def lower(self, w):
        k = self.uni[w]
        return self.scale * (self.d1[k] if k <= 5 else 1) * k / self.n if k else self.free

    def p(self, w, h):
        if h not in self.weight:
            return self.lower(w)
        k, (weight, full) = self.bi[h, w], self.weight[h]
        return (self.d2[k] if k <= 5 else 1) * k / (self.of(h) + full) if k else weight * self.lower(w)

    def out(self):
        v = len(self.uni)
        return sorted(((i, held, len(w), sum(self.uni[x] > 0 for x in w), self.n,
                        sum(math.log10((self.uni[x] + 1) / (self.n + v + 1)) for x in w),
                        sum(math.log10(self.p(x, h)) for x, h in zip(w, ["<s>", *w]))) for i, held, w in self.rows),
                      key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def same(got, want):
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


def corpus(n):
    rng = random.Random(n)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(3000)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("block", [2_000_000, 50])
def test_scores_equal_the_dictionaries(spark, monkeypatch, block):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", block)
    rows = corpus(200) + [(None, "w1 W1 w2"), (7, "w1"), (7, "w1"), (300, None), (301, " \t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(tuples(katz.language_model_scores(docs)), Brute(rows).out())


def test_hostile_and_small(spark, hostile, no_documents):
    same(tuples(katz.language_model_scores(hostile)), Brute([(r.doc_id, r.text) for r in hostile.collect()]).out())
    assert katz.language_model_scores(no_documents).count() == 0
    held = next(i for i in range(100) if katz.held_out(i))
    only = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    assert tuple(katz.language_model_scores(only).first()) == (held, True, 3, 0, 0, 0.0, 0.0)


@given(st.lists(st.text(alphabet="abc ", max_size=12), max_size=30))
@settings(max_examples=150, deadline=None)
def test_every_history_sums_to_one(texts):
    model = Brute(list(enumerate(texts)))
    for h in [*model.weight, "never"]:
        assert abs(sum(model.p(w, h) for w in [*model.uni, "\0unknown"]) - 1) < 1e-9


@given(st.lists(st.integers(0, 50), min_size=6, max_size=6))
def test_discounts_are_shares(counts):
    d = katz.discounts(counts)
    assert ((d[1:] > 0) & (d[1:] < 1)).all()


def test_squeeze_round_trip():
    arrays = [np.array([3, 1, 2 ** 63], np.uint64), np.zeros(0, np.uint32), np.array([1.5, -2.0]), np.array([-1, 5])]
    for a, b in zip(arrays, vec.expand(vec.squeeze(*arrays))):
        assert a.dtype == b.dtype and (a == b).all()
