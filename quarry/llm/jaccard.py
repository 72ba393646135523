"""N-gram Jaccard join: documents whose sets of word shingles overlap enough.

1. Every document's set is hashed in the scan's tasks. What repeats within
   a block of documents is known there; one hash for each distinct shingle of
   a block is dealt by hash to find what blocks have in common. A document
   with too few shingles that occur elsewhere can have no partner and is done.
2. Of the rest, one document for each distinct set is gathered in blocks that
   are written once. Blocks post how many documents hold a shingle and a sum
   that names them; the totals come back. Shingles that occur in exactly the
   same documents are one weighted symbol from here on, so copies cost a few
   symbols each and not their texts, and a shingle of very many documents
   costs a row for each block.
3. Symbols are ordered rarest first over all sets. Two sets that link share
   a symbol among the first ones of each (those whose loss would leave too
   little), so the documents of such a symbol form a shard. Small shards are
   dealt to buckets, and a document goes once to each bucket.
4. In a bucket, sets that shards connect are stored in a prefix tree, which
   is walked once for all sets at a time: a node adds its symbols' weights to
   the overlaps of all sets that hold them, and a set leaves a subtree when
   the weight that remains on either side cannot reach the threshold, or when
   all of the subtree is in its component. Links are closed to components by
   star steps.

Shards over ``SHARD_ROWS`` documents are cut into blocks and worked on by
pairs of blocks, so no task holds more than two blocks of one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.store import boxed, unboxed, written
from quarry.llm.vec import (LOWER, SLICE_BYTES, buffer_of, expand, fold, mix, prefix_hash, runs, span_hash, squeeze, steps,
                            text_slices, window_hash, word_spans)

WORDS = 5
#: A link: PERCENT * union <= 100 * intersection.
PERCENT = 75
SHARD_ROWS = 4000
HASH_BITS = 52
#: Bits of a hash beside its partition's that decide whether a shingle may occur
#: elsewhere. A partition gets about a million, so one in fifty is taken to by chance,
#: at any size; that only lets a few more documents through to the exact steps.
KEPT_BITS = 26
_BLOCK = 1_500_000
_MAX_ROWS = (1 << (64 - HASH_BITS)) - 1


def shingles(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash of HASH_BITS bits) of the distinct shingles of each text,
    in order of row and hash; at most _MAX_ROWS texts."""
    buf, starts, _ = buffer_of(texts)
    ws, we = word_spans(buf)
    word = span_hash(prefix_hash(LOWER[buf]), ws, we)
    row = np.searchsorted(starts, ws, side="right") - 1
    win = window_hash(word, n)
    at = np.flatnonzero(row[:len(win)] == row[n - 1:][:len(win)])
    value, rows = win[at], row[at]
    size = np.bincount(row, minlength=len(starts))
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        # the whole sequence as one shingle; its length is part of it
        first = np.searchsorted(row, short)
        whole = mix(size[short].astype(np.uint64))
        for i in range(n - 1):
            more = i < size[short]
            whole[more] = fold(whole[more], word[first[more] + i])
        value, rows = np.append(value, whole), np.append(rows, short)
    key = np.sort(rows.astype(np.uint64) << np.uint64(HASH_BITS) | value >> np.uint64(64 - HASH_BITS))
    key = key[runs(key)]
    return (key >> np.uint64(HASH_BITS)).astype(np.int64), key & np.uint64((1 << HASH_BITS) - 1)


def row_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    for a, b in text_slices(texts, SLICE_BYTES):
        for c in range(a, b, _MAX_ROWS):
            yield c, min(b, c + _MAX_ROWS)


def pack_block(values: np.ndarray, rows: np.ndarray) -> bytes:
    """Ascending values and their row numbers, as compressed byte planes of
    the values' steps and of the rows."""
    step = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    row = rows.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(step + row)


def unpack_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(raw) // 12
    step = np.ascontiguousarray(raw[:8 * n].reshape(8, n).T).view("<u8").ravel()
    row = np.ascontiguousarray(raw[8 * n:].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(step, dtype=np.uint64), row.astype(np.int64)


def dealt_blocks(value: np.ndarray, row: np.ndarray, bits: int, keep_bits: int) -> Iterator[tuple[int, bytes]]:
    """(partition, block) of ascending values: partition by the leading
    ``bits``, of the rest the next ``keep_bits``."""
    rest = HASH_BITS - bits
    part = (value >> np.uint64(rest)).astype(np.int64)
    value = (value & np.uint64((1 << rest) - 1)) >> np.uint64(max(0, rest - keep_bits))
    begin = runs(part)
    for a, b in zip(begin, np.append(begin[1:], len(part))):
        yield int(part[a]), pack_block(value[a:b], row[a:b])


def partition_bits(amount: float, each: float) -> int:
    """log2 of how many partitions of about ``each`` hold ``amount``."""
    return int(np.clip(np.ceil(np.log2(max(1.0, amount / each))), 4, 20))


def _keyed(docs: DataFrame) -> DataFrame:
    # identical rows share the key, and everything that is found for it
    doc_id, text = docs["doc_id"].cast("long"), F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(F.xxhash64(doc_id, text).alias("k"), doc_id.alias("doc_id"), text.alias("text"))


SKETCH = "block long, row int, k long, doc_id long, n long, s1 long, s2 long, here long, p int, data binary"
#: Row number of an entry whose documents are counted already.
_COUNTED = (1 << 32) - 1


def sketch(docs: DataFrame, bits: int) -> DataFrame:
    """Two kinds of rows: one a document (p is null) with its set's size, two
    order-free hashes of the set and how many of its shingles another
    document of the block has; and the blocks' distinct shingles."""
    names = [c.split()[0] for c in SKETCH.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.int32(), pa.binary()]

    def table(height: int, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[c], t) if c in cols else pa.nulls(height, t) for c, t in zip(names, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        sets: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            size, s1, s2 = (np.concatenate([x[i] for x in sets]) for i in (0, 1, 2))
            value = np.concatenate([x[3] for x in sets])
            row = np.repeat(np.arange(len(size)), size)
            order = np.argsort(value)
            value, row = value[order], row[order]
            begin = runs(value)
            times = np.diff(np.append(begin, len(value)))
            here = np.bincount(row[np.repeat(times > 1, times)], minlength=len(size))
            value, row = value[begin], np.where(times > 1, _COUNTED, row[begin])
            known = pa.concat_tables([pa.table([x[0], x[1]], names=["k", "doc_id"]) for x in ids]).combine_chunks()
            yield table(len(size), block=np.full(len(size), block), row=np.arange(len(size)),
                        k=known["k"].combine_chunks(), doc_id=known["doc_id"].combine_chunks(), n=size, s1=s1, s2=s2, here=here)
            parts = list(dealt_blocks(value, row, bits, KEPT_BITS))
            yield table(len(parts), block=[block] * len(parts), p=[p for p, _ in parts], data=[d for _, d in parts])
            ids.clear()
            sets.clear()

        for batch in batches:
            for a, b in row_slices(batch["text"]):
                part = batch.slice(a, b - a)
                row, value = shingles(part["text"])
                size = np.bincount(row, minlength=b - a)
                end = np.cumsum(size)
                sums = []
                for salt in (1, 2):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(value + np.uint64(salt << 60)), dtype=np.uint64)])
                    sums.append((total[end] - total[end - size]).view(np.int64))
                ids.append((part["k"], part["doc_id"]))
                sets.append((size, *sums, value))
                n += len(value)
                if n >= _BLOCK:
                    yield from flush()
                    block, n = block + 1, 0
        if ids:
            yield from flush()

    return docs.mapInArrow(run, SKETCH)


def shared_counts(sketches: DataFrame) -> DataFrame:
    """(block, row, shared): how many of a document's shingles occur in
    another block too, beside those counted in its own (or collide with one
    on the bits kept; too many is harmless)."""
    def reduce(table: pa.Table) -> pa.Table:
        blocks = table["block"].to_pylist()
        found = [unpack_block(d.as_py()) for d in table["data"]]
        value = np.concatenate([v for v, _ in found])
        which = np.repeat(np.arange(len(found)), [len(v) for v, _ in found])
        row = np.concatenate([r for _, r in found])
        order = np.argsort(value)
        begin = runs(value[order])
        size = np.diff(np.append(begin, len(value)))
        counted = np.maximum.reduceat(row[order], begin) == _COUNTED if len(begin) else np.zeros(0, bool)
        hit = order[np.repeat((size > 1) | counted, size)]
        hit = hit[row[hit] != _COUNTED]
        out = []
        for i, block in enumerate(blocks):
            counts = np.bincount(row[hit[which[hit] == i]])
            if len(counts):
                out.append((block, counts.astype("<u4").tobytes()))
        return pa.table({"block": pa.array([b for b, _ in out], pa.int64()),
                         "counts": pa.array([c for _, c in out], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(c.as_py(), "<u4") for c in table["counts"]]
        out = np.zeros(max(map(len, parts)), np.int64)
        for p in parts:
            out[:len(p)] += p
        some = np.flatnonzero(out)
        return pa.table({"block": pa.array(np.full(len(some), table["block"][0].as_py()), pa.int64()),
                         "row": pa.array(some, pa.int32()), "shared": pa.array(out[some], pa.int64())})

    return (sketches.filter("p is not null").select("p", "block", "data")
            .groupBy("p").applyInArrow(reduce, "block long, counts binary")
            .groupBy("block").applyInArrow(total, "block long, row int, shared long"))


_SETS = "k long, n long, set array<struct<df: bigint, symbol: bigint, weight: bigint>>"


def weighted_symbols(reps: DataFrame, bits: int) -> DataFrame:
    """(k, n, set) for every row of ``reps`` (k, text) that shares a shingle:
    the groups of its shingles that occur in exactly the same df > 1 sets,
    each a symbol with the number of shingles as weight."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, n = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            k, size, value = (np.concatenate([x[i] for x in parts]) for i in range(3))
            row = np.repeat(np.arange(len(size)), size)
            order = np.argsort(value, kind="stable")
            data = squeeze(k, size, steps(value[order]), row[order].astype(np.uint32))
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data], pa.binary())],
                                              names=["block", "data"])

        for batch in batches:
            for a, b in row_slices(batch["text"]):
                row, value = shingles(batch["text"].slice(a, b - a))
                parts.append((batch["k"].slice(a, b - a).to_numpy(zero_copy_only=False),
                              np.bincount(row, minlength=b - a), value))
                n += len(value)
                if n >= _BLOCK:
                    yield flush()
                    block, n = block + 1, 0
        if parts:
            yield flush()

    def read(data: bytes) -> tuple[np.ndarray, ...]:
        k, size, step, row = expand(data)
        value = np.cumsum(step, dtype=np.uint64)
        return k, size, row.astype(np.int64), value, runs(value)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, data in zip(batch["block"].to_pylist(), batch["data"]):
                k, _, row, value, begin = read(data.as_py())
                if not len(value):
                    continue
                held = np.add.reduceat(mix(k.view(np.uint64))[row], begin)
                count = np.diff(np.append(begin, len(value))).astype(np.uint32)
                value = value[begin]
                part = (value >> np.uint64(HASH_BITS - bits)).astype(np.int64)
                cut = runs(part)
                out += [(int(part[a]), number, squeeze(steps(value[a:b]), held[a:b], count[a:b]))
                        for a, b in zip(cut, np.append(cut[1:], len(part)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary()))],
                names=["p", "block", "data"])

    def tell(table: pa.Table) -> pa.Table:
        parts = [expand(d.as_py()) for d in table["data"]]
        value = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
        held, count = np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts]).astype(np.int64)
        order = np.argsort(value, kind="stable")
        begin = runs(value[order])
        size = np.diff(np.append(begin, len(value)))
        df = np.add.reduceat(count[order], begin)
        name = mix(np.add.reduceat(held[order], begin) + df.astype(np.uint64))
        names, dfs = np.empty(len(value), np.uint64), np.empty(len(value), np.uint32)
        names[order], dfs[order] = np.repeat(np.where(df > 1, name, 0), size), np.repeat(df, size)
        cut = np.cumsum([len(x[0]) for x in parts])[:-1]
        return pa.table({"block": table["block"], "p": table["p"],
                         "data": pa.array([squeeze(a, b) for a, b in zip(np.split(names, cut), np.split(dfs, cut))], pa.binary())})

    def join(mine: pa.Table, told: pa.Table) -> pa.Table:
        k, size, row, value, begin = read(mine["data"][0].as_py())
        got = [expand(d) for _, d in sorted(zip(told["p"].to_pylist(), told["data"].to_pylist()))]
        name = np.concatenate([x[0] for x in got]) if got else np.zeros(0, np.uint64)
        df = np.concatenate([x[1] for x in got]).astype(np.int64) if got else np.zeros(0, np.int64)
        each = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(value))))
        keep = df[each] > 1
        each, row = each[keep], row[keep]
        order = np.lexsort((name[each], row))
        each, row = each[order], row[order]
        head = np.ones(len(each), bool)
        head[1:] = (row[1:] != row[:-1]) | (name[each[1:]] != name[each[:-1]])
        first = np.flatnonzero(head)
        weight = np.diff(np.append(first, len(each)))
        row, each = row[first], each[first]
        here, at = np.unique(row, return_index=True)
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(at, len(row)), pa.int32()),
            pa.StructArray.from_arrays([pa.array(df[each]), pa.array(name[each].view(np.int64)), pa.array(weight, pa.int64())],
                                       names=["df", "symbol", "weight"]))
        return pa.table({"k": pa.array(k[here], pa.int64()), "n": pa.array(size[here], pa.int64()), "set": lists})

    stored = written(reps.mapInArrow(gather, "block long, data binary"), "jaccard-sets")
    told = stored.mapInArrow(ask, "p int, block long, data binary").groupBy("p").applyInArrow(
        tell, "block long, p int, data binary")
    return stored.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(join, _SETS)


def tree_links(size: np.ndarray, owner: np.ndarray, symbol: np.ndarray, weight: np.ndarray,
               percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of rows that link, enough of them to connect every two rows that
    all links connect. Row ``owner[i]`` holds ``symbol[i]`` of ``weight[i]``
    (the same in all rows); ``size`` are the whole sets' sizes, what no other
    row holds included."""
    m = len(size)
    _, name, share = np.unique(symbol, return_inverse=True, return_counts=True)
    keep = share[name] > 1
    rank = np.empty(len(share), np.int64)
    rank[np.argsort(-share, kind="stable")] = np.arange(len(share))
    owner, weight, symbol = owner[keep], weight[keep], rank[name[keep]]
    order = np.lexsort((symbol, owner))
    owner, weight, symbol = owner[order], weight[order], symbol[order]
    begin = np.searchsorted(owner, np.arange(m + 1))
    path = [symbol[a:b].tolist() for a, b in zip(begin, begin[1:])]
    rows = np.array(sorted(range(m), key=path.__getitem__), np.int64)  # the tree: equal starts are neighbours
    place = np.empty(m, np.int64)
    place[rows] = np.arange(m)
    done = np.concatenate([[0], np.cumsum(weight)])
    total = done[begin[1:]] - done[begin[:-1]]
    width = len(share) + 1
    code = owner * width + symbol
    by = np.argsort(symbol, kind="stable")
    holder, held = owner[by], weight[by].astype(float)
    post = np.searchsorted(symbol[by], np.arange(width + 1))
    label = np.arange(m)
    links: list[tuple[int, int]] = []
    both = 100 + percent

    def added(symbols: list[int]) -> np.ndarray:
        """Weight that each row holds of some symbols."""
        if not symbols:
            return np.zeros(m)
        first, last = post[symbols], post[np.array(symbols) + 1]
        n = last - first
        at = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        return np.bincount(holder[at], held[at], m)

    def leaf(y: int, overlap: np.ndarray, active: np.ndarray) -> None:
        active = active[(place[active] > place[y]) & (label[active] != label[y])]
        found = active[both * overlap[active] >= percent * (size[active] + size[y])]
        for group in np.unique(label[found]):
            links.append((int(y), int(found[label[found] == group][0])))
            label[label == group] = label[y]

    stack = [(0, m, 0, np.zeros(m), np.arange(m))]
    while stack:
        lo, hi, depth, overlap, active = stack.pop()
        here = rows[lo:hi]
        active = active[place[active] >= lo]
        if (label[here] == label[here[0]]).all():
            active = active[label[active] != label[here[0]]]
        if not len(active):
            continue
        first, last = path[rows[lo]], path[rows[hi - 1]]
        if hi - lo == 1:
            leaf(rows[lo], overlap + added(first[depth:]), active)
            continue
        end = depth
        while end < min(len(first), len(last)) and first[end] == last[end]:
            end += 1
        if end > depth:
            overlap = overlap + added(first[depth:end])
        rest = total[here].max() - (done[begin[rows[lo]] + end] - done[begin[rows[lo]]])
        if end:
            after = np.searchsorted(code, active * width + first[end - 1], side="right")
            rest = np.minimum(rest, done[begin[active + 1]] - done[after])
        active = active[both * (overlap[active] + rest) >= percent * (size[active] + size[here].min())]
        at = lo
        while at < hi and len(path[rows[at]]) == end:  # sets that end here
            leaf(rows[at], overlap, active)
            at += 1
        while at < hi:
            to, nxt = at + 1, path[rows[at]][end]
            while to < hi and path[rows[to]][end] == nxt:
                to += 1
            stack.append((at, to, end, overlap, active))
            at = to
    return links


def prefix_symbols(symbols: list[tuple[int, int, int]], n: int, percent: int = PERCENT) -> list[int]:
    """Of a set's (df, symbol, weight), rarest first, those that cannot all
    be missed by a partner: they go on until what remains falls short of
    ``percent`` of the set."""
    left = sum(w for _, _, w in symbols)
    out = []
    for _, symbol, weight in sorted(symbols):
        if 100 * left < percent * n:
            break
        out.append(symbol)
        left -= weight
    return out


def _parts(rows: list[list[int]]) -> list[list[int]]:
    """Rows that shared shards connect, by row number; single ones left out."""
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    seen: dict[int, int] = {}
    for x, shards in enumerate(rows):
        for s in shards:
            parent[find(x)] = find(seen.setdefault(s, x))
    out: dict[int, list[int]] = {}
    for x in range(len(rows)):
        out.setdefault(find(x), []).append(x)
    return [p for p in out.values() if len(p) > 1]


def _link_shards(prefixes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) sets that the shards of ``prefixes`` (k, shard) link. A shard
    over SHARD_ROWS sets is cut into blocks by hash and every pair of blocks
    is a task of its own; the others go to buckets."""
    size = prefixes.groupBy("shard").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    total = size.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("m")).first()
    sets_n = sets.count()
    # so many that a bucket has about 10 * SHARD_ROWS memberships at most
    buckets = int(np.clip(max(sets_n // SHARD_ROWS, total["n"] // (10 * SHARD_ROWS)), 1, max(1, total["m"])))
    member = prefixes.join(size, "shard").withColumn(
        "_blocks", F.ceil(F.col("_n") / F.lit(SHARD_ROWS)).cast("int"))
    bucket = F.pmod(F.xxhash64("shard", F.lit(3)), F.lit(buckets))
    small = member.filter("_blocks = 1").groupBy("k", bucket.alias("group")).agg(F.collect_list("shard").alias("shards"))
    i = F.pmod(F.xxhash64("k"), F.col("_blocks")).cast("int")
    large = (member.filter("_blocks > 1")
             .select("k", "shard", i.alias("_i"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_j"))
             .select("k", F.struct("shard", F.least("_i", "_j").alias("i"), F.greatest("_i", "_j").alias("j")).alias("g"),
                     F.array("shard").alias("shards")))
    kind = "struct<shard: bigint, i: int, j: int>"
    dealt = (small.select("k", F.struct(F.col("group").alias("shard"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
                          .cast(kind).alias("g"), "shards")
             .unionByName(large.select("k", F.col("g").cast(kind).alias("g"), "shards"))
             .join(sets, "k"))

    def walk(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        k, n = table["k"].to_numpy(), table["n"].to_numpy()
        lists = table["set"].chunk(0) if table["set"].num_chunks else pa.array([], table["set"].type)
        count = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        owner = np.repeat(np.arange(len(k)), count)
        symbol, weight = flat.field("symbol").to_numpy(), flat.field("weight").to_numpy()
        first = np.cumsum(count) - count
        a, b = [], []
        for part in _parts(table["shards"].to_pylist()):
            rows = np.array(part)
            at = np.arange(count[rows].sum()) + np.repeat(first[rows] - (np.cumsum(count[rows]) - count[rows]), count[rows])
            local = np.repeat(np.arange(len(rows)), count[rows])
            for x, y in tree_links(n[rows], local, symbol[at], weight[at], percent):
                a.append(k[rows[x]])
                b.append(k[rows[y]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.select("g.shard", "g.i", "g.j", "k", "n", "set", "shards").groupBy("shard", "i", "j").applyInArrow(
        walk, "a long, b long")


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(k, doc_id, n, end, component) for every row: its key, its set's size,
    the label of its group (null if nothing can link with it) and the
    smallest doc_id of the group."""
    keyed = _keyed(docs)
    size = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    sketches = written(sketch(keyed, partition_bits(size, 8e6)), "jaccard")
    rows = sketches.filter("p is null").select("block", "row", "k", "doc_id", "n", "s1", "s2", "here")
    shared = shared_counts(sketches).withColumnsRenamed({"block": "_b", "row": "_r"})
    alive = written(
        rows.join(shared, (rows["block"] == shared["_b"]) & (rows["row"] == shared["_r"]), "left")
        .filter((F.col("n") > 0) & (100 * (F.col("here") + F.coalesce("shared", F.lit(0))) >= percent * F.col("n")))
        .select("k", "doc_id", "n", "s1", "s2"), "alive")
    # one row for each distinct set
    classes = written(alive.groupBy("s1", "s2", "n").agg(F.min("k").alias("rep"), F.min("doc_id").alias("least")),
                      "classes")
    reps = classes.select("rep", "n")
    tokens = reps.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    # both sides are shuffled at any size: the sets grow with the documents
    texts = (keyed.join(reps.select(F.col("rep").alias("k")).hint("merge"), "k", "left_semi").dropDuplicates(["k"])
             .select("k", "text"))
    sets = written(weighted_symbols(texts, partition_bits(tokens, 1e6)), "sets")

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, shard = [], []
            for key, n, s in zip(batch["k"].to_pylist(), batch["n"].to_pylist(), batch["set"].to_pylist()):
                found = prefix_symbols([(x["df"], x["symbol"], x["weight"]) for x in s], n, percent)
                k += [key] * len(found)
                shard += found
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(shard, pa.int64())], names=["k", "shard"])

    prefixes = written(sets.mapInArrow(prefix, "k long, shard long"), "prefixes")
    roots = components(_link_shards(prefixes, sets, percent))
    two = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("s1").alias("_1"), F.col("s2").alias("_2"), F.col("n").alias("_n"), "least",
        F.coalesce("root", "rep").alias("end"))
    ids = two.groupBy("end").agg(F.min("least").alias("component")).join(two.drop("least"), "end").select(
        "_1", "_2", "_n", "end", "component")
    return (rows.join(ids, (rows["s1"] == ids["_1"]) & (rows["s2"] == ids["_2"]) & (rows["n"] == ids["_n"])
                      & (rows["n"] > 0), "left")
            .select("k", "doc_id", "n", "end", "component"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles (size of its set of
    distinct 5-word shingles) and component_id, the smallest doc_id that
    links reach from it, its own included. ``percent`` is at least 1.

    A null or empty text, or one of white space, has an empty set and links
    with nothing; under five words the whole sequence is the one shingle, so
    equal short texts link. Rows with a null id take part and give null only
    if no row of their component has an id. Repeated rows link with each
    other. An empty table gives an empty result; other columns are not read.
    Shingles are compared by 52-bit hashes.
    """
    return groups(docs, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs``, all columns, with one row of each group of near-duplicates:
    the one of the smallest doc_id (a null id counts as smallest)."""
    found = written(groups(docs, percent).filter("end is not null"), "groups")
    first = found.groupBy("end").agg(F.min(F.struct("doc_id", "k")).alias("_first"))
    mark = written(found.join(first, "end").groupBy(F.col("k").alias("key")).agg(
        F.min(F.col("_first")["k"] != F.col("k")).alias("gone"), F.count(F.lit(1)).alias("n")), "marks")
    key = F.xxhash64(docs["doc_id"].cast("long"), F.coalesce(docs["text"].cast("string"), F.lit("")))
    left = boxed(docs, key).join(mark, "key", "left").filter(~F.coalesce("gone", F.lit(False)))
    if not mark.filter("n > 1 and not gone").isEmpty():  # identical rows: one of them
        again = Window.partitionBy("key").orderBy("n")
        left = left.withColumn("at", F.row_number().over(again)).filter("n is null or at = 1")
    return unboxed(left, docs.columns)
