"""Document fingerprints by a threshold-scaled sketch, in DataFrame functions only.

Every shingle of five words has a 64-bit hash, and a document's sketch is the
set of all its hashes below a fixed fraction of the hash range. The fraction
is the same for all documents, so a sketch grows with its document, the
sketch of a union is the union of the sketches, and the share of one sketch
found in another estimates containment however unequal the two documents are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.store import written

SHINGLE_WORDS = 5
#: Share of all hashes that a sketch retains.
FRACTION = 1 / 4
_SPACE = " \t\n\x0b\f\r"
_HASHES = "array<bigint>"


def word_hashes(text: Column) -> Column:
    """Hashes of a text's lower-case words ``[^\\x20\\x09-\\x0D]+``, in order;
    none for a null text."""
    body = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(_SPACE))
    words = F.filter(F.split(body, "[ \\t-\\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def sketch(words: Column, fraction: float = FRACTION, size: int = SHINGLE_WORDS) -> Column:
    """Sorted distinct hashes, below ``fraction`` of the range, of the runs of
    ``size`` words; fewer words are one shingle as a whole, none have none.
    ``words`` must be a column of the frame (it is read once a word)."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be above 0 and at most 1")
    starts = F.slice(words, 1, F.greatest(F.size(words) - (size - 1), F.lit(0)))
    shingles = F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)]))
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast(_HASHES))
    every = F.when(F.size(words) >= size, shingles).otherwise(whole)
    last = -(2 ** 63) + int(fraction * 2 ** 64) - 1
    return F.sort_array(F.array_distinct(F.filter(every, lambda h: h <= F.lit(last).cast("long"))))


def whole_hash(words: Column) -> Column:
    return F.xxhash64(F.size(words), words)


def merged(sketches: Column) -> Column:
    """Aggregate: the sketch of all documents of a group together."""
    return F.sort_array(F.array_distinct(F.flatten(F.collect_set(sketches))))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; null for an empty sketch."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, a_whole: Column, b: Column, b_whole: Column) -> Column:
    """Estimated Jaccard similarity of two documents' shingle sets, 0 to 1.
    Equal word sequences are 1; where neither sketch holds a hash, others
    are 0."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(a_whole == b_whole, 1.0).when(union == 0, 0.0).otherwise(both / union)


def _hex(h: Column) -> Column:
    return F.lpad(F.lower(F.hex(h)), 16, "0")


def fingerprint(hashes: Column, whole: Column) -> Column:
    """The hash of the word sequence, then the retained hashes, in hex."""
    return F.concat(_hex(whole), F.array_join(F.transform(hashes, _hex), ""))


KEY = ["missing", "key", "tie"]


def _keyed(docs: DataFrame) -> DataFrame:
    """(missing, key, tie, text): the first three order the documents and are
    never null; ``tie`` tells rows of one id, or without one, apart."""
    doc_id, text = docs["doc_id"].cast("long"), F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(doc_id.isNull().alias("missing"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("key"),
                       F.xxhash64(text).alias("tie"), text.alias("text"))


def followers(rows: DataFrame) -> DataFrame:
    """(missing, key, tie, to, half): every document and the key of the one
    before it, whose edited text ends with at most ``half`` code points of
    this one; the first document comes after the last.

    Only keys and lengths are sorted, in ranges; a range is written under its
    number, and of each range only the last document meets the next range.
    """
    spark = rows.sparkSession
    ids = rows.select(*KEY, F.expr("length(text) div 2").alias("half")).distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(ids.repartitionByRange(parts, *KEY).withColumn("part", F.spark_partition_id()), "followers")
    last = ranged.groupBy("part").agg(F.max(F.struct(*KEY, "half")).alias("last"))  # a row a partition
    order = Window.orderBy("part")
    end = F.last("last").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = last.select("part", F.coalesce(F.lag("last").over(order), end).alias("before"))
    own = F.lag(F.struct(*KEY, "half")).over(Window.partitionBy("part").orderBy(*KEY))
    return (ranged.withColumn("own", own).join(F.broadcast(before), "part")
            .withColumn("to", F.coalesce("own", "before")).select(*KEY, "to", F.col("to.half").alias("half")))


def document_fingerprints(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every text, of its edited text (the second half
    replaced by the beginning of the next document), and their likeness.

    A row for each row of ``docs``: doc_id, text, edited_text, n_chars,
    hashes and edited_hashes (the sketches), fingerprint and
    edited_fingerprint, near_edited and near_next (see :func:`likeness`),
    in_edited and in_next (estimated share of the text's shingles that the
    edited text, the next document has; null where the sketch is empty).

    A null text is empty; a text of up to one code point is its own edited
    text. Documents follow each other by doc_id, a missing one last; rows of
    one id are ordered by a hash of their texts, and rows that repeat id and
    text count as one document in this order but are all returned. A single
    document is followed by itself. An empty table gives an empty result;
    other columns are not read.
    """
    # both joins read the same columns of ``rows``, so the texts are shuffled once; hashing a text
    # again where it meets its follower takes less than shuffling its sketch with it
    rows, words = _keyed(docs), F.col("words")
    sent = (rows.join(followers(rows), KEY)
            .withColumn("words", word_hashes(F.col("text")))
            .select(*[F.col("to").getField(k).alias(k) for k in KEY],
                    F.struct(F.substring("text", F.lit(1), F.col("half")).alias("beginning"),
                             sketch(words, fraction).alias("hashes"), whole_hash(words).alias("whole")).alias("next"))
            .groupBy(*KEY).agg(F.any_value("next").alias("next")))
    n, half = F.length("text"), F.expr("length(text) div 2")
    both = (rows.join(sent, KEY)
            .withColumn("edited_text", F.concat(F.substring("text", F.lit(1), n - half), F.col("next.beginning")))
            .withColumn("words", word_hashes(F.col("text"))).withColumn("edited_words", word_hashes(F.col("edited_text")))
            .withColumns({"hashes": sketch(words, fraction), "whole": whole_hash(words),
                          "edited_hashes": sketch(F.col("edited_words"), fraction), "edited_whole": whole_hash(F.col("edited_words"))}))
    h, e, x = F.col("hashes"), F.col("edited_hashes"), F.col("next.hashes")
    return both.select(
        F.when(~F.col("missing"), F.col("key")).alias("doc_id"), "text", "edited_text", n.cast("long").alias("n_chars"),
        "hashes", "edited_hashes",
        fingerprint(h, F.col("whole")).alias("fingerprint"), fingerprint(e, F.col("edited_whole")).alias("edited_fingerprint"),
        likeness(h, F.col("whole"), e, F.col("edited_whole")).alias("near_edited"),
        likeness(h, F.col("whole"), x, F.col("next.whole")).alias("near_next"),
        containment(h, e).alias("in_edited"), containment(h, x).alias("in_next"))
