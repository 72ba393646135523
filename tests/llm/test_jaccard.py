import random
import re

import numpy as np
import pytest

from llm_helpers import tuples
from quarry.llm import jaccard
from quarry.llm.components import components


def sets_of(rows):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        out.append((i, {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if both and 100 * both >= 75 * len(sets[a][1] | sets[b][1]):
                parent[find(a)] = find(b)
    out = []
    for x, (i, s) in enumerate(sets):
        ids = [sets[y][0] for y in range(len(sets)) if find(y) == find(x) and sets[y][0] is not None]
        out.append((i, len(s), min(ids) if ids and s else i))
    return sorted(out, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return words


@pytest.mark.parametrize("shard_rows,block", [(4000, 1_500_000), (7, 150)])
def test_components_equal_all_pairs(spark, monkeypatch, shard_rows, block):
    monkeypatch.setattr(jaccard, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(jaccard, "_BLOCK", block)
    rng = random.Random(4)
    rows, i = [], 0
    shared = [f"s{x}" for x in range(40)]
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 90))]
        for _ in range(rng.randint(1, 12)):
            t = edited(rng, base, rng.randint(0, max(1, len(base) // 40)))
            rows.append((i, " ".join(t + (shared if rng.random() < 0.3 else []))))
            i += 1
    rows += [(i, "a b"), (i + 1, "A  b"), (i + 2, "a b c"), (i + 3, ""), (i + 4, None), (i + 5, " \t"), (i, "a b")]
    rows += [(i + 10 + x, " ".join(edited(rng, shared, 1))) for x in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert tuples(jaccard.jaccard_components(docs)) == brute(rows)


def test_tree_links_connect_what_all_pairs_connect():
    rng = random.Random(9)
    for _ in range(60):
        m = rng.randint(2, 14)
        weights = {c: rng.randint(1, 4) for c in range(12)}
        sets = [[(c, w) for c, w in weights.items() if rng.random() < 0.8] for _ in range(m)]
        sizes = [max(1, sum(w for _, w in s) + rng.randint(0, 2)) for s in sets]
        flat = [(i, c, w) for i, s in enumerate(sets) for c, w in s]
        links = jaccard.tree_links(np.array(sizes), *(np.array([f[j] for f in flat], np.int64) for j in range(3)))

        def closure(pairs):
            parent = list(range(m))
            find = lambda x: x if parent[x] == x else find(parent[x])
            for a, b in pairs:
                parent[find(a)] = find(b)
            return [[find(a) == find(b) for a in range(m)] for b in range(m)]

        def over(a, b):
            both = sum(w for c, w in sets[a] if (c, w) in sets[b])
            return 100 * both >= 75 * (sizes[a] + sizes[b] - both)

        every = [(a, b) for a in range(m) for b in range(a) if over(a, b)]
        assert all(over(a, b) for a, b in links)
        assert closure(links) == closure(every)


def test_hostile_rows(spark, hostile, no_documents):
    out = tuples(jaccard.jaccard_components(hostile))
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    assert out == brute(rows)
    assert jaccard.jaccard_components(no_documents).count() == 0


def test_one_row_of_each_group_stays(spark, hostile):
    left = jaccard.without_near_copies(hostile)
    assert left.columns == hostile.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 2, 3, 5, 7, 8, 9] and ids.count(None) == 1


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    out = dict(tuples(components(spark.createDataFrame(edges, "a long, b long"))))
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
