import random

import numpy as np
import pytest

from quarry.llm import language

WORDS = {"en": ["the", "thing", "and", "other", "with"], "de": ["und", "schön", "nicht", "über", "heit"],
         "fr": ["être", "leur", "très", "avec", "que"]}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"


def say(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture
def corpus(spark):
    rng = random.Random(1)
    docs = [(i, say(rng, x, 30), x, f"s{i % 3}", 1) for i, x in enumerate(["en", "de", "fr"] * 30)]
    docs += [(200, say(rng, "de", 30), "en", "s1", 1), (201, say(rng, "fr", 25), None, None, 1),
             (202, "12345 !!! ***", "en", "s0", 1), (203, None, "en", "s0", 1), (204, "th", "de", "s0", 1)]
    pages = [(i, f"http://h{i % 4}.example.com/{x}/p", f'<html lang="{x}"><style>und</style><p>{say(rng, x, 20)}</p>')
             for i, x in enumerate(["en", "de", "fr"] * 8)]
    pages += [(90, None, None), (91, "https://www.seite.de", "<p>" + say(rng, "de", 20)), (92, "nonsense", "<p></p>")]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(pages, PAGES)


def test_text_declaration_suffix_and_host(corpus):
    docs, pages = corpus
    found = language.identify(language.evidence_of_documents(docs).unionByName(language.evidence_of_pages(pages)))
    out = {(r.kind, r.id): r for r in found.collect()}
    assert len(out) == docs.count() + pages.count()
    for i in range(90):
        assert (out["document", i].language, out["document", i].kept) == (["en", "de", "fr"][i % 3], True)
    assert out["document", 200].language == "de" and out["document", 200].declared == "en"
    assert out["document", 201].language == "fr"
    for i in (202, 203):
        assert out["document", i].language is None and not out["document", i].kept
    assert out["page", 91].language == "de"
    assert not out["page", 90].kept and not out["page", 92].kept


def test_smoothing_goes_host_domain_everything(spark):
    rows = [("document", i, "en" if i < 8 else "de", "", "h1" if i < 9 else "h2", "d", [0.0, 0.0], 3,
             "en" if i < 8 else "de") for i in range(10)]
    scored = spark.createDataFrame(rows, "kind string, id long, declared string, suffix string, host string, domain string, "
                                         "ll array<double>, n long, best string")
    out = {r.id: r for r in language.fuse(scored.withColumn("declared", scored["suffix"]), ["de", "en"]).collect()}
    whole = [(2 + 1) / 12, (8 + 1) / 12]
    domain = [(c + 50 * w) / 60 for c, w in zip((2, 8), whole)]
    host = [(c + 20 * d) / 21 for c, d in zip((1, 0), domain)]
    assert out[9].posterior == pytest.approx(max(host) / sum(host))


def test_stage_keeps_rows_and_columns(corpus, hostile, spark):
    docs, pages = corpus
    left = language.with_language(docs, pages)
    assert left.columns == docs.columns
    rows = {r.doc_id: r.lang for r in left.collect()}
    assert rows[200] == "de" and 202 not in rows and 203 not in rows and all(i in rows for i in range(90))
    odd = language.with_language(hostile, pages)
    assert odd.columns == hostile.columns
    ids = [r.doc_id for r in odd.collect()]
    assert ids.count(7) == 2 and None in ids and 1 not in ids and 2 not in ids


def test_nothing_declared_and_empty(spark, no_documents, corpus):
    undeclared = spark.createDataFrame([(1, "the thing", None, None, 1)], DOCS)
    out = language.identify(language.evidence_of_documents(undeclared)).collect()
    assert [(r.id, r.language, r.kept) for r in out] == [(1, None, False)]
    assert language.with_language(no_documents, corpus[1].limit(0)).count() == 0


def test_every_declared_language_counts(spark):
    rng = random.Random(3)
    odd = {f"{a}{b}": [chr(0x0900 + 40 * i + rng.randrange(40)) * 2 + chr(0x0900 + 40 * i + rng.randrange(40)) for _ in range(8)]
           for i, (a, b) in enumerate((a, b) for a in "qxyz" for b in "abcdefghijklmnopqr")}
    rows = [(i, say(rng, "en", 25), "en", "s", 1) for i in range(2500)]
    rows += [(5000 + i, " ".join(rng.choice(w) for _ in range(30)), x, "s", 1) for i, (x, w) in enumerate(list(odd.items()) * 2)]
    rows += [(9000, say(rng, "en", 30), "zz", "s", 1)]  # declared by mistake
    docs = spark.createDataFrame(rows, DOCS)
    pages = spark.createDataFrame([], PAGES)
    left = {r.doc_id: r.lang for r in language.with_language(docs, pages).collect()}
    assert left == {r[0]: r[2] for r in rows} | {9000: "en"}


def test_likelihoods_equal_the_table():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 4, (6, language.CELLS)) * (rng.random((6, language.CELLS)) < np.array([[.9, .5, .01, .1, .0, .3]]).T)
    lang, cell = np.nonzero(counts)
    likely = language.Likelihoods(6, (lang, cell, counts[lang, cell]))
    assert len(likely.dense) == 3 and len(likely.sparse) == 3
    row = np.sort(rng.integers(0, 900, 200_000))
    at = rng.integers(0, language.CELLS, 200_000)
    logp = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * language.CELLS))
    want = np.stack([np.bincount(row, logp[j, at], minlength=900) for j in range(6)], axis=1)
    assert np.allclose(likely(at, row, 900), want, rtol=1e-5)
