import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quarry.llm import quality


def base_of(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
    mark = [False] * len(w)
    for j in range(len(w) - 7):
        if c[tuple(w[j:j + 8])] > 1:
            mark[j:j + 8] = [True] * 8
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, sum(mark)


def test_base_counts():
    rng = random.Random(3)
    texts = [None, "", "\n\n", "a\r\na\r\na", "é# 日本\né# 日本"] + [
        "".join(rng.choice(["a ", "b ", "\n", "é# ", "c\t"]) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    got = quality.statistics_of(pa.array(texts, pa.string()))
    assert [tuple(int(got[c][i]) for c in quality.BASE) for i in range(len(texts))] == [base_of(t) for t in texts]


def test_trees_learn_and_keep_their_directions():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 3))
    y = ((x[:, 0] < 0.6) & (x[:, 1] > 0.3) ^ (rng.random(1500) < 0.05)).astype(float)
    trees = quality.fit_trees(x, y, np.array([-1, 1, 0]))
    assert ((trees.score(x) >= 0) == (y > 0)).mean() > 0.9
    for j, direction in ((0, -1), (1, 1)):
        for row in x[:40]:
            line = np.repeat(row[None], 50, axis=0)
            line[:, j] = np.linspace(0, 1, 50)
            assert (direction * np.diff(trees.score(line)) >= -1e-12).all()


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(2)
    x = rng.random((200, 4))
    trees = quality.fit_trees(x, (x[:, 2] > 0.5).astype(float), np.zeros(4))

    def walk(row):
        total = trees.start
        for node in trees.roots:
            while trees.feature[node] >= 0:
                node = trees.left[node] if row[trees.feature[node]] <= trees.cut[node] else trees.right[node]
            total += trees.value[node]
        return total

    assert np.allclose(trees.score(x), [walk(r) for r in x])


def test_rows_and_held_out_accuracy(spark, hostile, no_documents):
    rng = random.Random(5)
    good = [" ".join(rng.choice(["the", "sea", "was", "calm", "and", "wide", "under", "stars"]) for _ in range(60)) for _ in range(120)]
    bad = [" ".join(rng.choice(["a***", "b%%%", "c$$$", "d###"]) + str(rng.random()) for _ in range(60)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120)) for i, _ in rows if i % 2] + [(None, 1), (3, None), (1, 1)],
                                   "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.quality_rules(docs, labels, max_fit_rows=60).collect()}
    assert all(out[i].kept == (i < 120) for i, _ in rows if i % 2 == 0)
    for i, t in rows[::17]:
        assert tuple(out[i][c] for c in quality.BASE) == base_of(t)
    none = labels.filter("false")
    odd = quality.quality_rules(hostile, none).collect()
    assert len(odd) == hostile.count()
    assert all(r.kept == (not r.base_failed) for r in odd)
    assert all(r.base_failed for r in odd if r.doc_id in (1, 2, 3, 8))
    assert quality.quality_rules(no_documents, none).count() == 0
