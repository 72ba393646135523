"""Secret scan: fixed patterns plus sliding-window Shannon entropy per
character class, with an allow list.

Base kinds are found leftmost and without overlap, each kind on its own.
The entropy kind looks at candidate strings (runs of token characters of at
least a window's length), decides each run's character class, slides a
windows over it with counts updated by one character in and one out, and
merges the windows over the class's threshold into spans. Runs on the allow
list, placeholders, and spans already inside a base span, add nothing; what
stands beside a placeholder is looked at on its own.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.vec import text_slices

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Whole runs of lower-case hex digits, without the short ones.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: class -> (characters of a run, windows, bits per character that a window must reach)
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), (20,), 3.0),
    ("base36", re.compile(r"[0-9a-z]+|[0-9A-Z]+"), (20,), 3.6),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), (20, 24), 4.0),
)
#: Plain words, also joined by - _ /. A word long enough for a window is one
#: only if no window of it reaches more bits than words do.
WORDS = re.compile(r"(?:[A-Z]?[a-z]*|[A-Z]*)(?:[-_/=+](?:[A-Z]?[a-z]*|[A-Z]*|[0-9]{1,4}))*")
LONG_WORD, WORD_BITS = re.compile(r"[A-Za-z]{20,}"), 4.0
#: Other runs that look random and are none: numbers and UUIDs.
ALLOW = (
    re.compile(r"[0-9]+"),
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),
)
#: Placeholders and counting sequences. They are no secret, but what stands
#: beside them, in a run of any length, may be one.
PLACEHOLDER = re.compile(r"example|placeholder|changeme|dummy|x{4,}|0123456789|abcdefgh", re.ASCII | re.IGNORECASE)
#: The example key of public documentation, as a whole run.
DOCUMENTED = re.compile(r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY")
ORDER = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}
SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
          "spans string, n_entropy long")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, code points, end exclusive."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], ORDER[s[2]]))


def window_spans(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged windows of ``run`` whose Shannon entropy is at least ``bits``.

    With counts c of a window of w characters the entropy is
    ``log2 w - sum(c log2 c) / w``; a step changes two counts."""
    clog = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts = dict.fromkeys(run, 0)
    total = 0.0
    spans: list[list[int]] = []
    most = (math.log2(window) - bits) * window + 1e-9
    for i, ch in enumerate(run):
        if i >= window:
            c = counts[run[i - window]]
            total += clog[c - 1] - clog[c]
            counts[run[i - window]] = c - 1
        c = counts[ch]
        total += clog[c + 1] - clog[c]
        counts[ch] = c + 1
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1][1] = i + 1
            else:
                spans.append([start, i + 1])
    return [(a, b) for a, b in spans]


def stretches(run: str) -> Iterator[tuple[int, int]]:
    """Parts of ``run`` that are left beside its placeholders, without what
    joins them to these."""
    if DOCUMENTED.fullmatch(run):
        return
    at = 0
    for m in PLACEHOLDER.finditer(run):
        a, b = m.span()
        while a > at and run[a - 1] in "/_=-":
            a -= 1
        while b < len(run) and run[b] in "/_=-":
            b += 1
        if at < a:
            yield at, a
        at = max(at, b)
    if at < len(run):
        yield at, len(run)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def random_spans(run: str) -> list[tuple[int, int]]:
    """Spans of high entropy of a run without placeholders."""
    if any(p.fullmatch(run) for p in ALLOW):
        return []
    if WORDS.fullmatch(run):
        return [(m.start() + a, m.start() + b) for m in LONG_WORD.finditer(run)
                for a, b in window_spans(m.group(), 20, WORD_BITS)]
    for _, chars, windows, bits in CLASSES:
        if chars.fullmatch(run):
            return merged([x for w in windows if len(run) >= w for x in window_spans(run, w, bits)])
    return []


def entropy_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of high entropy outside the base spans."""
    out = []
    for m in CANDIDATE.finditer(text):
        for x, y in stretches(m.group()):
            at = m.start() + x
            out += [(at + a, at + b, "entropy") for a, b in random_spans(m.group()[x:y])
                    if not any(s <= at + a and at + b <= e for s, e, _ in base)]
    return out


def join_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(text: str | None) -> tuple:
    """(n_assign, n_access, n_hex, base_sha256, spans, n_entropy) of one text."""
    text = text or ""
    base = base_spans(text)
    found = entropy_spans(text, base)
    every = sorted(base + found, key=lambda s: (s[0], ORDER[s[2]], s[1]))
    kinds = [k for _, _, k in base]
    return (kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
            hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(every), len(found))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts per base kind, the digest of the
    base spans, and all spans as ``kind:start:end`` in order of start.

    A null or empty text has no spans (digest of the empty string); a null
    id stays null; repeated rows each give their row; an empty table gives
    an empty result; other columns are not read. Texts are scanned whole, in
    the scan's own tasks, without a shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch["text"], 8 << 20):
                part = batch.slice(a, b - a)
                rows = zip(*(scan(t) for t in part["text"].to_pylist()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *(pa.array(c, k) for c, k in zip(rows, kinds))], names=NAMES)

    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return src.mapInArrow(run, SCHEMA)
