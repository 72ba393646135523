import random

import numpy as np

from quarry.llm import decontam

ITEMS = "item_id long, text string"


def words(rng, n, size=3000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def score_of(a, b):
    best, up = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, up[j - 1] + (2 if x == y else -1), up[j] - 1, row[-1] - 1))
        best, up = max(best, *row), row
    return best


def test_alignment_equals_the_table():
    rng = np.random.default_rng(1)
    n = 200
    a, b = rng.integers(0, 4, (n, 14)).astype(np.uint64), rng.integers(0, 4, (n, 9)).astype(np.uint64)
    la, lb = rng.integers(1, 15, n), rng.integers(1, 10, n)
    got, _ = decontam.align(a, la, b, lb)
    assert got.tolist() == [score_of(a[i, :la[i]].tolist(), b[i, :lb[i]].tolist()) for i in range(n)]


def test_copies_edits_and_clean(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, rng.randint(20, 40)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "one two three"), (3, items[3][1])]

    def around(part):
        return " ".join(words(rng, 30) + part + words(rng, 30))

    def edited(text):
        w = text.split()
        for _ in range(len(w) // 8):
            w[rng.randrange(len(w))] = "changed"
        w.insert(len(w) // 2, "inserted")
        return w

    rows = [(i, around(t.split())) for i, t in items[:12]] + [(100 + i, around(edited(t))) for i, t in items[:12]]
    rows += [(200 + i, around([])) for i in range(40)] + [(300, None), (301, ""), (302, "one two three")]
    rows += [(None, around(items[0][1].upper().split())), (7, rows[7][1]),
             (400, " ".join(items[1][1].split() + words(rng, 40) + items[2][1].split()))]
    rows += [(500 + i, around(items[5][1].split())) for i in range(60)]  # a passage in very many documents
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as item", "2 as score")
    bench = spark.createDataFrame(items, ITEMS)
    out = decontam.contaminated(docs, bench).collect()
    pairs = {(r.doc_id, r.item_id) for r in out}
    want = ({(i, i) for i in range(12)} | {(100 + i, i) for i in range(12)} | {(None, 0), (400, 1), (400, 2)}
            | {(500 + i, 5) for i in range(60)} | {(302, 52)})
    assert pairs == want
    spans = {(r.doc_id, r.item_id): (r.first_word, r.end_word, r.score) for r in out}
    assert spans[0, 0] == (30, 30 + len(items[0][1].split()), 1.0)
    assert spans[400, 2][1] == len(rows[[r[0] for r in rows].index(400)][1].split())
    left = decontam.without_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted([*range(200, 240), 300, 301])
    # the same in several blocks of the benchmark
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 300)
    again = decontam.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in again} == want


def test_hostile_and_empty(spark, hostile, no_documents):
    bench = spark.createDataFrame([(1, "same row twice over and over again")], ITEMS)
    assert sorted((r.doc_id, r.score) for r in decontam.contaminated(hostile, bench).collect()) == [(7, 1.0), (7, 1.0)]
    assert decontam.without_contaminated(hostile, bench).count() == hostile.count() - 2
    assert decontam.contaminated(no_documents, bench).count() == 0
    assert decontam.contaminated(hostile, bench.limit(0)).count() == 0
    assert decontam.without_contaminated(hostile, bench.limit(0)).count() == hostile.count()


def test_edited_copies_of_frequent_items_equal_brute_force(spark):
    rng = random.Random(7)
    items = [words(rng, n, 400) for n in (24, 5, 6, 9, 31, 40)]

    def edited(w, rate):
        out = []
        for x in w:
            kind = rng.random()
            if kind < rate:
                out += rng.choice([["changed"], [], [x, "put"], [x, "put", "in"]])
            else:
                out.append(x)
        return out

    base = items[0]
    texts = [base] * 50 + [[("changed" if i in (3, 8, 13, 18) else x) for i, x in enumerate(base)]]
    texts += [[("changed" if i % 3 == 2 else x) for i, x in enumerate(base)]] * 8  # no trigram is left
    texts += [[y for x in base for y in (x, "put")]] * 8  # no two words side by side
    texts += [w for w in items[1:] for _ in range(20)]
    texts += [edited(w, rate) for w in items for rate in (0.1, 0.2, 0.3, 0.4, 0.6) for _ in range(6)]
    texts += [w[:len(w) // 2 + 1] for w in items]
    texts = [words(rng, 12, 400) + t + words(rng, 12, 400) for t in texts]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], ITEMS)
    want = {}
    for i, t in enumerate(texts):
        for j, w in enumerate(items):
            score = score_of(t, w) / (2 * len(w))
            if score >= 0.5:
                want[i, j] = score
    got = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, bench).collect()}
    assert got == want
    assert sum(s < 0.9 for s in want.values()) > 60
    left = {r.doc_id for r in decontam.without_contaminated(docs, bench).collect()}
    assert left == set(range(len(texts))) - {i for i, _ in want}


def test_short_items_are_found_whole(spark):
    items = [(1, "zeta"), (2, "alpha beta"), (3, "gamma delta epsilon"), (4, "eins zwei drei vier"), (5, "alpha beta"), (6, "...")]
    rows = [(10, "A zeta here, and Zeta there."), (11, "an alpha, beta"), (12, "alpha between beta"), (13, "gamma delta epsilon"),
            (14, "gamma delta"), (15, "x eins zwei drei vier y"), (16, "eins zwei drei"), (17, "alpha"), (18, "beta zeta"), (None, None)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    out = {(r.doc_id, r.item_id): (r.score, r.first_word, r.end_word, r.n_seeds) for r in decontam.contaminated(docs, bench).collect()}
    assert out == {(10, 1): (1.0, 1, 2, 2), (11, 2): (1.0, 1, 3, 1), (11, 5): (1.0, 1, 3, 1), (13, 3): (1.0, 0, 3, 1),
                   (15, 4): (1.0, 1, 5, 1), (18, 1): (1.0, 1, 2, 1)}
    left = decontam.without_contaminated(docs, bench).collect()
    assert [r.doc_id for r in left] == [10, 11, 12, 14, 15, 16, 17, 18, None]
