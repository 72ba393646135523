"""Language ID by Bayesian evidence fusion.

Evidence of a row: its text, the language its markup or record declares, the
suffix of its address, and its host. Text likelihoods come from byte-trigram
counts of every declared language over all rows. With each row's best
language by text alone, grouped counts then give, per language, how often
each declaration and each suffix goes with it, and how languages are spread
over each host, its domain and everything; a host's prior is smoothed toward
its domain's, and that toward the global one. The posterior multiplies the
(tempered) text likelihood, declaration, suffix and host prior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.store import boxed, unboxed, written
from quarry.llm.vec import buffer_of, text_slices
from quarry.operators.joins import join_split

#: Trigrams are hashed into this many cells.
CELLS = 1 << 14
#: A language with counts in at most this many cells is kept as a list of them.
SPARSE_CELLS = CELLS // 8
#: Languages up to which what goes with declarations is sent to every task.
_BROADCAST_LANGUAGES = 512
_FLUSH_LANGUAGES = 64
_SCORES = 4 << 20
#: Trigrams of a text overlap, so their likelihood counts as this much evidence.
TEMPER = 1 / 8
SMOOTH_HOST, SMOOTH_DOMAIN, SMOOTH_GLOBAL = 20.0, 50.0, 1.0
MIN_POSTERIOR = 0.5

_CELL_1 = (np.arange(256, dtype=np.uint32) * np.uint32(0x9E3779B1))
_CELL_2 = (np.arange(256, dtype=np.uint32) * np.uint32(0x85EBCA77))
_CELL_3 = (np.arange(256, dtype=np.uint32) * np.uint32(0xC2B2AE3D))
_LETTERS = np.zeros(256, np.uint8)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[_LETTERS == 0] = 32


def evidence_of_documents(docs: DataFrame, name: Column | None = None) -> DataFrame:
    """(kind, id, text, declared, suffix, host, domain) of ``documents``:
    the record's lang is the declaration, its source the host. ``name`` is
    the id if not doc_id."""
    return docs.select(
        F.lit("document").alias("kind"), (docs["doc_id"].cast("long") if name is None else name).alias("id"), docs["text"].cast("string").alias("text"),
        _code(docs["lang"]).alias("declared"), F.lit("").alias("suffix"),
        F.coalesce(docs["source"].cast("string"), F.lit("")).alias("host"), F.lit("").alias("domain"))


def evidence_of_pages(pages: DataFrame) -> DataFrame:
    """The same of ``pages``: html lang, the first path part or else the last
    label of the address, its host, and the host's last three labels."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    url = F.lower(F.coalesce(pages["url"].cast("string"), F.lit("")))
    host = F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1)
    path = F.regexp_extract(url, r"^[a-z]+://[^/]+/([a-z]{2})(?:[/?#]|$)", 1)
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]+;", " ")
    return pages.select(
        F.lit("page").alias("kind"), pages["page_id"].cast("long").alias("id"), text.alias("text"),
        _code(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1)).alias("declared"),
        F.when(path != "", path).otherwise(F.regexp_extract(host, r"\.([a-z]+)$", 1)).alias("suffix"),
        host.alias("host"), F.regexp_extract(host, r"((?:[^.]+\.){0,2}[^.]+)$", 1).alias("domain"))


def _code(c: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(c.cast("string")), r"^\s*([a-z]{2,3})", 1), F.lit(""))


def languages_of(evidence: DataFrame) -> list[str]:
    """Every declared code, in order, however rare: codes have two or three
    letters, so they are at most 18,278."""
    rows = evidence.filter(F.col("declared") != "").select("declared").distinct().collect()
    return sorted(r["declared"] for r in rows)


def trigram_cells(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cell, row) of every byte trigram of the lower-cased letters, runs of
    other characters taken as one space."""
    buf, starts, _ = buffer_of(texts)
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _LETTERS[buf]
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    at = np.flatnonzero(keep)
    low = low[at]
    cell = (_CELL_1[low[:-2]] ^ _CELL_2[low[1:-1]] ^ _CELL_3[low[2:]]) if len(low) > 2 else np.zeros(0, np.uint32)
    row = np.searchsorted(starts, at, side="right") - 1
    own = row[:len(cell)] == row[2:]
    return ((cell[own] * np.uint32(0x27D4EB2F)) >> np.uint32(18)).astype(np.int64), row[:len(cell)][own]


def trigram_counts(evidence: DataFrame, languages: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language index, cell, count) of the cells over all rows that declare
    a language; cells without a count are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, n in total.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(lang * CELLS + at), pa.array(n[at])], names=["cell", "n"])
            total.clear()

        for batch in batches:
            code = np.array([index.get(x, -1) for x in batch["declared"].to_pylist()], np.int64)
            for a, b in text_slices(batch["text"]):
                cell, row = trigram_cells(batch["text"].slice(a, b - a))
                some, local = np.unique(code[a:b], return_inverse=True)
                lang = local[row]
                for k in range(0, len(some), _FLUSH_LANGUAGES):
                    now = some[k:k + _FLUSH_LANGUAGES]
                    here = (lang >= k) & (lang < k + len(now))
                    n = np.bincount((lang[here] - k) * CELLS + cell[here], minlength=len(now) * CELLS).reshape(-1, CELLS)
                    for i, x in enumerate(now.tolist()):
                        if x >= 0:
                            total[x] = total[x] + n[i] if x in total else n[i].copy()
                    if len(total) > _FLUSH_LANGUAGES:
                        yield from flush()
        yield from flush()

    index = {x: i for i, x in enumerate(languages)}
    if not languages:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    rows = (evidence.select("text", "declared").mapInArrow(run, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
    at = rows["cell"].to_numpy(np.int64)
    return at // CELLS, at % CELLS, rows["n"].to_numpy(np.int64)


class Likelihoods:
    """log P(cell | language) with half a count for every cell. Languages with
    counts in many cells are columns of a table; for the others only cells
    with counts are listed, as what they add to a cell without."""

    def __init__(self, k: int, counts: tuple[np.ndarray, np.ndarray, np.ndarray]):
        lang, cell, n = counts
        total = np.bincount(lang, n, minlength=k) + 0.5 * CELLS
        filled = np.bincount(lang, minlength=k)
        self.k = k
        self.none = np.log(0.5 / total)
        self.dense, self.sparse = np.flatnonzero(filled > SPARSE_CELLS), np.flatnonzero(filled <= SPARSE_CELLS)
        place = np.zeros(k, np.int64)
        place[self.dense], place[self.sparse] = np.arange(len(self.dense)), np.arange(len(self.sparse))
        many = filled[lang] > SPARSE_CELLS
        table = np.full((CELLS, len(self.dense)), 0.5)
        table[cell[many], place[lang[many]]] += n[many]
        self.table = np.log(table / total[self.dense]).astype(np.float32)
        order = np.flatnonzero(~many)
        order = order[np.argsort(cell[order], kind="stable")]
        self.begin = np.searchsorted(cell[order], np.arange(CELLS + 1))
        self.which = place[lang[order]].astype(np.int32)
        self.more = np.log(n[order] * 2.0 + 1).astype(np.float32)

    def __call__(self, cell: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Log likelihoods (rows x languages) of texts, given the cells of each."""
        out = np.zeros((rows, self.k))
        for j, lang in enumerate(self.dense):
            out[:, lang] = np.bincount(row, self.table[cell, j], minlength=rows)
        if len(self.sparse):
            out[:, self.sparse] = np.bincount(row, minlength=rows)[:, None] * self.none[self.sparse]
            hit = np.flatnonzero(self.begin[cell + 1] > self.begin[cell])
            for k in range(0, len(hit), 1 << 16):
                at = hit[k:k + (1 << 16)]
                size = self.begin[cell[at] + 1] - self.begin[cell[at]]
                where = np.arange(size.sum()) + np.repeat(self.begin[cell[at]] - (np.cumsum(size) - size), size)
                first = row[at[0]]
                to = (np.repeat(row[at], size) - first) * len(self.sparse) + self.which[where]
                new = np.bincount(to, self.more[where], minlength=(row[at[-1]] - first + 1) * len(self.sparse))
                out[first:row[at[-1]] + 1, self.sparse] += new.reshape(-1, len(self.sparse))
        return out


def text_scores(evidence: DataFrame, languages: list[str], counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """``evidence`` without its text, with ``ll`` (log likelihood of the text
    under every language), ``n`` trigrams and ``best`` language by text."""
    k = len(languages)
    likely = Likelihoods(k, counts)
    most = max(1, _SCORES // max(1, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = ((c, min(c + most, b)) for a, b in text_slices(batch["text"]) for c in range(a, b, most))
            for a, b in pieces:
                part = batch.slice(a, b - a)
                cell, row = trigram_cells(part["text"])
                ll = likely(cell, row, b - a)
                n = np.bincount(row, minlength=b - a)
                best = ll.argmax(axis=1) if k else np.zeros(b - a, np.int64)
                names = [languages[i] if m else "" for i, m in zip(best, n)] if k else [""] * (b - a)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * k, pa.int32()), pa.array(ll.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in ("kind", "id", "declared", "suffix", "host", "domain")), lists,
                     pa.array(n), pa.array(names, pa.string())],
                    names=["kind", "id", "declared", "suffix", "host", "domain", "ll", "n", "best"])

    return evidence.select("kind", "id", "text", "declared", "suffix", "host", "domain").mapInArrow(
        run, "kind string, id long, declared string, suffix string, host string, domain string, "
             "ll array<double>, n long, best string")


def _counts(tally: DataFrame, keys: list[str], languages: Column, name: str) -> DataFrame:
    """One row per key: rows per language by text, in the order of languages;
    ``tally`` has the number of rows per key and best language."""
    found = tally.groupBy(*keys, "best").agg(F.sum("n").cast("double").alias("n")).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("_m"))
    return found.select(*keys, F.transform(languages, lambda x: F.coalesce(F.try_element_at("_m", x), F.lit(0.0))).alias(name))


def _shares(own: Column, above: Column, weight: float) -> Column:
    """``own`` counts smoothed toward the shares ``above``."""
    total = F.aggregate(own, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(own, above, lambda c, p: (c + weight * p) / (total + weight))


def fuse(scored: DataFrame, languages: list[str], min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """(kind, id, language, posterior, text_language, declared, kept)."""
    k = len(languages)
    names = F.array(*[F.lit(x) for x in languages])
    whole = {r["best"]: r["n"] for r in scored.groupBy("best").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = [whole.get(x, 0) for x in languages]
    globe = [(n + SMOOTH_GLOBAL) / (sum(whole) + SMOOTH_GLOBAL * k) for n in whole]
    tally = scored.groupBy("host", "domain", "best").agg(F.count(F.lit(1)).alias("n"))
    hosts = _counts(tally, ["host", "domain"], names, "_host")
    domains = _counts(tally, ["domain"], names, "_domain")
    priors = hosts.join(domains, "domain").select(
        "host", "domain",
        _shares(F.col("_host"), _shares(F.col("_domain"), F.array(*[F.lit(g) for g in globe]), SMOOTH_DOMAIN),
                SMOOTH_HOST).alias("_prior"))
    totals = F.array(*[F.lit(float(n)) for n in whole])

    def given(column: str, name: str) -> DataFrame:
        # P(value | language) with half a row for every pair; no value is no evidence
        likely = F.zip_with(F.col("_n"), totals, lambda c, t: F.log((c + 0.5) / (t + 0.5 * k)))
        none = F.array_repeat(F.lit(0.0), k)
        counted = scored.groupBy(column, "best").agg(F.count(F.lit(1)).alias("n"))
        return _counts(counted, [column], names, "_n").select(
            column, F.when(F.col(column) == "", none).otherwise(likely).alias(name))

    # a host or suffix may hold a third of all rows: their rows are dealt over several tasks;
    # declarations are sent to every task unless there are very many languages
    joined = join_split(given("suffix", "_suffix"), join_split(priors, scored, ["host", "domain"]), "suffix")
    declared = given("declared", "_declared")
    joined = (joined.join(F.broadcast(declared), "declared") if k <= _BROADCAST_LANGUAGES
              else join_split(declared, joined, "declared"))
    log_post = F.zip_with(
        F.zip_with("ll", "_prior", lambda t, p: t * TEMPER + F.log(p)),
        F.zip_with("_declared", "_suffix", lambda a, b: a + b), lambda a, b: a + b)
    mass = F.aggregate(F.col("_lp"), F.lit(0.0), lambda s, x: s + F.exp(x - F.col("_top")))
    best = F.element_at(names, F.array_position(F.col("_lp"), F.col("_top")).cast("int"))
    some = F.col("n") > 0
    text_fits = F.array_max("ll") >= F.col("n") * F.lit(float(np.log(1 / CELLS)))
    return (joined.withColumn("_lp", log_post).withColumn("_top", F.array_max("_lp"))
            .select("kind", "id", F.when(some, best).alias("language"),
                    F.when(some, 1 / mass).otherwise(0.0).alias("posterior"),
                    F.when(some, F.col("best")).alias("text_language"), "declared",
                    (some & text_fits & (1 / mass >= min_posterior)).alias("kept")))


def identify(evidence: DataFrame, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """One row per row of ``evidence``: its language, the posterior, and
    whether it is ``kept``: a text with letters, likelier under its best
    language than as evenly spread trigrams, and a posterior of at least
    ``min_posterior``.

    A null or empty text, or one without a letter trigram, has no language
    and is rejected; a null or unknown declaration, suffix or host is no
    evidence against any language; a null id stays null; repeated rows each
    give their row; of equally likely languages the first by code wins; if
    nothing declares a language, or the table is empty, no row has one.
    """
    languages = languages_of(evidence)
    scored = written(text_scores(evidence, languages, trigram_counts(evidence, languages)), "language")
    if not languages:
        return scored.select("kind", "id", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"),
                             F.lit(None).cast("string").alias("text_language"), "declared", F.lit(False).alias("kept"))
    return fuse(scored, languages, min_posterior)


def with_language(docs: DataFrame, pages: DataFrame, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """The rows of ``docs`` that :func:`identify` keeps, all columns, with
    ``lang`` set to the language found; ``pages`` are further evidence. Rows
    are told apart by a hash of what is known of them, so ids may be null or
    repeated."""
    name = F.xxhash64(docs["doc_id"].cast("long"), docs["text"], docs["lang"], docs["source"])
    found = identify(evidence_of_documents(docs, name).unionByName(evidence_of_pages(pages)), min_posterior)
    kept = (found.filter("kind = 'document' and kept").groupBy("id").agg(F.min("language").alias("language"))
            .withColumnRenamed("id", "key"))
    return unboxed(boxed(docs, name).join(kept, "key"), docs.columns, lang=F.col("language"))
