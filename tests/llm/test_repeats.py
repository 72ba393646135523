import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import tuples
from quarry.llm import repeats, suffix


def brute(rows):
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for j in range(len(b) - 49):
            s = b[j:j + 50]
            first[s] = min(first.get(s, key(i)), key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for j in range(len(b) - 49):
            if first[b[j:j + 50]] < key(i):
                gone[j:j + 50] = [True] * 50
        out.append((i, len(b), sum(gone), sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone)),
                    hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


@given(st.lists(st.integers(1, 4), max_size=70), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_suffix_array_and_common_prefixes(text, times):
    s = text * times + [0]
    sa = suffix.suffix_array(np.array(s, np.int32), 5).tolist()
    assert sa == sorted(range(len(s)), key=lambda i: s[i:])
    common = suffix.common_prefixes(np.array(s, np.int32), np.array(sa), 9)
    for a, b in zip(sa, sa[1:]):
        n = 0
        while n < 9 and a + n < len(s) and b + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        assert common[b] == n


def test_names_beyond_the_alphabet_are_digits(monkeypatch):
    monkeypatch.setattr(suffix, "MAX_ALPHABET", 3)
    monkeypatch.setattr(suffix, "SHORT", 2)
    rng = random.Random(6)
    for _ in range(150):
        s = [rng.randint(1, rng.choice([2, 9])) for _ in range(rng.randint(1, 90))] * rng.randint(1, 4) + [0]
        got = suffix.suffix_array(np.array(s, np.int32), 10).tolist()
        assert got == sorted(range(len(s)), key=lambda i: s[i:])
        some = suffix.suffix_array(np.array(s, np.int32), 10, 5).tolist()
        assert sorted(some) == sorted(got) and [s[i:i + 5] for i in some] == [s[i:i + 5] for i in got]


@pytest.mark.parametrize("block,shard,most", [(8 << 20, 2 << 20, 10_000), (3000, 400, 10_000), (3000, 400, 3), (8 << 20, 400, 1)])
def test_removed_bytes_equal_all_strings(spark, monkeypatch, block, shard, most):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "MOST_SORTED", most)
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
    rng = random.Random(block)
    base = ["".join(rng.choice("abé") for _ in range(400)) for _ in range(4)]
    rows = []
    for i in range(160):
        t = ""
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5:
                t += "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 120)))
            else:
                x = rng.randint(0, 390)
                t += rng.choice(base)[x:x + rng.randint(1, 200)]
        rows.append((rng.choice([i, i, i, None, 7]), rng.choice([t, t, t, t, None, "a" * rng.randint(0, 200)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert tuples(repeats.remove_repeats(docs)) == brute(rows)


def test_hostile_rows(spark, hostile, no_documents):
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    assert tuples(repeats.remove_repeats(hostile)) == brute(rows)
    assert repeats.remove_repeats(no_documents).count() == 0


def test_a_phrase_in_every_document_between_different_text(spark, monkeypatch):
    """Its anchor has as many neighbourhoods as there are documents; some
    share more than the phrase."""
    monkeypatch.setattr(repeats, "MOST_SORTED", 100)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 50_000)
    rng = random.Random(9)
    rows = []
    for i in range(3_000):
        a, b = ("".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(2))
        if i % 7 == 0:
            a = rows[i // 2][1][:60] if i else a
        rows.append((i, a + "cookies help us." + b[:rng.choice([5, 30, 60])]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert tuples(repeats.remove_repeats(docs)) == brute(rows)


def test_sift_keeps_every_neighbourhood_that_shares_a_string():
    rng = random.Random(3)
    word = lambda n: bytes(rng.choice(b"ab") for _ in range(n))
    gram, rows = b"0123456789abcdef", []
    for group in range(40):
        for _ in range(rng.randint(1, 5)):
            a, b = word(rng.randint(0, 34)), word(rng.randint(0, 34))
            if rows and rows[-1][0] == group and rng.random() < 0.7:
                n = rng.randint(0, 34)  # n bytes before the gram and the rest after it, at times one fewer
                n, m = n, 34 - n - rng.randint(0, 1)
                a, b = a[n:] + rows[-1][1][max(0, len(rows[-1][1]) - n):], rows[-1][2][:m] + b[m:]
            rows.append((group, a[-34:], b[:34]))
    rows = [r for r in rows if len(r[1]) + len(r[2]) >= 34]
    text = [a + gram + b for _, a, b in rows]
    strings = [{(g, t[i:i + 50]) for i in range(len(t) - 49)} for (g, _, _), t in zip(rows, text)]
    shares = [any(x & y for j, y in enumerate(strings) if j != i) for i, x in enumerate(strings)]
    kept = repeats.may_share(np.frombuffer(b"".join(text), np.uint8), np.array([r[0] for r in rows]),
                             np.array([len(r[1]) for r in rows]), np.array([16 + len(r[2]) for r in rows]))
    assert sum(shares) > 20 and all(k for k, x in zip(kept, shares) if x)
    assert not kept.all()


def test_only_slices_that_hold_dealt_strings_are_hashed(monkeypatch):
    rng = random.Random(4)
    texts = [bytes(rng.choice(b"abcdef ") for _ in range(900)) for _ in range(400)]
    meta = repeats.squeeze(np.arange(400), np.zeros(400, np.uint8), np.full(400, 900, np.uint64))
    t = repeats._Text(meta, repeats.zstandard.ZstdCompressor().compress(b"".join(x + b" " for x in texts)))
    hashed, one = [], repeats.prefix_hash
    monkeypatch.setattr(repeats, "_SLICE", 9000)
    monkeypatch.setattr(repeats, "prefix_hash", lambda x: hashed.append(len(x)) or one(x))
    place = t.starts[[5, 7, 300]] + 100
    (_, _, least), which, start = repeats._strings(t, place, np.full(3, 34), np.full(3, 50))
    assert len(start) == 3 * 35 and least[which].tolist() == np.repeat([5, 7, 300], 35).tolist()
    assert sum(hashed) <= 2 * 9000
