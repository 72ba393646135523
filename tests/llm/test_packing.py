import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import packing

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

ODD = ["don't stop 'sabc it's", "ÀÉÎ ÿßØ×÷ naïve", "a\x1cb c\x00d", "日本語 テスト", "<|endoftext|> hi<|startoftext|>x", "école É",
       "x y z", "1234 56a7b", "İstanbul ΑΣ ς", "", " \n\t", None, "😀👍🏽 ok!", "foo_bar--baz...", "ſt K Å",
       "́a", "½ ² ٣ x", "AÑõ", "a​b", "<|ENDOFTEXT|>", "''s 've'LL"]


@pytest.fixture(scope="module")
def tools():
    path = packing.default_tokenizer()
    return packing.WordTokens(path), tokenizers.Tokenizer.from_file(path)


def ids_of(tools, texts):
    ids, n = tools[0].encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []


def test_cached_units_equal_the_tokenizer(tools):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aB'é ÀßÇ1 2.,-\n\x01́日😀×|<>&ñ sS") for _ in range(rng.randint(0, 40))) for _ in range(800)]
    want = [tools[1].encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids_of(tools, texts) == want
    assert ids_of(tools, texts[::-1]) == want[::-1]


def packed(lengths, capacity):
    counts = {}
    for n in lengths:
        counts[n] = counts.get(n, 0) + 1
    fill, rank = {}, {}
    for n, first, ranks, sequence, per, offset in packing.plan(counts, capacity).tolist():
        assert first == rank.get(n, 0)
        rank[n] = first + ranks
        for k in range(ranks):
            fill.setdefault(sequence + k // per, []).append((offset + k % per * n, n))
    assert rank == counts
    for parts in fill.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= capacity
    return fill


@given(st.lists(st.integers(1, 60), max_size=80))
@settings(max_examples=300, deadline=None)
def test_plan_is_gapless_and_near_the_bound(lengths):
    fill = packed(lengths, 60)
    assert sorted(fill) == list(range(len(fill)))
    assert len(fill) <= 1.5 * max(1, -(-sum(lengths) // 60)) + 1
    large = [n for n in lengths if 3 * n > 60]
    assert all(sum(3 * n > 60 for _, n in parts) <= 2 for parts in fill.values())
    if len(large) == len(lengths):  # as many pairs as any matching has
        left, pairs = sorted(large), 0
        while len(left) > 1:
            if left[0] + left[-1] <= 60:
                left, pairs = left[1:-1], pairs + 1
            else:
                left.pop()
        assert len(fill) == len(large) - pairs


def test_pieces_come_back(spark, hostile, no_documents, tools):
    out = packing.pack(hostile, capacity=64).collect()
    want = {}
    for r in hostile.collect():
        ids = tools[1].encode(r.text or "", add_special_tokens=False).ids + [packing.END_ID]
        cuts = [ids[k:k + 64] for k in range(0, len(ids), 64)]
        for i, cut in enumerate(cuts):
            key = (r.doc_id, i, i * 64, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got = {}
    for r in out:
        key = (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
    assert got == want
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    assert packing.pack(no_documents).count() == 0
