"""Operator 6: document fingerprints from prefix polynomial hashes.

For a batch of texts, two arrays hold the polynomial hash of every prefix
modulo 2**31 - 1, for two bases.  Any span's hash is a difference of two
entries, so span equality takes constant time and the longest common
extension of two places a binary search.  A fingerprint is the length, the
whole text's hash, and for each of ``BINS`` classes of span hashes the least one,
once among all spans of ``SPAN`` code points and once among every ``SPAN``-th
with its place; likeness is the larger of the two Dice shares estimated from
the classes that agree (the second one also tells how much of a text that
repeats itself stayed in place).

Defined results: a null or empty text has no spans and the fingerprint of the
empty text; two empty texts have likeness 1, an empty and a non-empty one 0;
a text shorter than ``SPAN`` is one span; documents with equal ids follow
each other by text, null ids come last; a single document is followed by
itself; repeated rows each count.  Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import ship_package, slices, table, texts_of
from estuary.llm.shingles import mix

MODULUS = np.uint64((1 << 31) - 1)
BASES = (1_000_003, 20_011_001)
SPAN = 8
BINS = 128


def reduced(x: np.ndarray) -> np.ndarray:
    """Values below 2**62 modulo 2**31 - 1."""
    x = (x & MODULUS) + (x >> np.uint64(31))
    x = (x & MODULUS) + (x >> np.uint64(31))
    return np.where(x >= MODULUS, x - MODULUS, x)


_POWERS: dict[int, np.ndarray] = {}


def modular_powers(base: int, n: int) -> np.ndarray:
    """Powers 0 .. n - 1 of a base, doubling the known stretch."""
    known = _POWERS.get(base, np.ones(1, dtype=np.uint64))
    while len(known) < n:
        step = np.uint64(pow(base, len(known), int(MODULUS)))
        known = np.concatenate([known, reduced(known * step)])
    _POWERS[base] = known
    return known[:n]


class PrefixHashes:
    """Prefix hashes of the texts of a batch, laid end to end."""

    def __init__(self, texts: list[str]):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.parts = []
        for base in BASES:
            power = modular_powers(base, len(code) + 1)
            inverse = modular_powers(pow(base, -1, int(MODULUS)), len(code) + 1)
            total = np.zeros(len(code) + 1, dtype=np.uint64)
            np.cumsum(reduced(code * power[:len(code)]), out=total[1:])
            self.parts.append((reduced(total), inverse))

    def span(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of flat spans."""
        halves = [reduced((total[end] + MODULUS - total[begin]) * inverse[begin]) for total, inverse in self.parts]
        return halves[0] << np.uint64(31) | halves[1]

    def common_extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest common extension from each pair of flat places, up to ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.span(a, a + middle) == self.span(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def sketches(self) -> np.ndarray:
        """Least value of each class for each text, as 16 bits; 0 where a class is empty."""
        moving = np.where(self.sizes > 0, np.maximum(self.sizes - SPAN + 1, 1), 0)
        return np.hstack([self._sketch(moving, 1, False), self._sketch(-(-self.sizes // SPAN), SPAN, True)])

    def _sketch(self, count: np.ndarray, step: int, placed: bool) -> np.ndarray:
        empty = np.iinfo(np.uint64).max
        out = np.full(len(self.sizes) * BINS, empty, dtype=np.uint64)
        doc = np.repeat(np.arange(len(self.sizes)), count)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        begin = place * step + self.starts[doc]
        value = self.span(begin, np.minimum(begin + SPAN, (self.starts + self.sizes)[doc]))
        value = mix(value ^ mix(place.astype(np.uint64)) if placed else value)
        np.minimum.at(out, doc * BINS + (value >> np.uint64(57)).astype(np.int64), value)
        small = (mix(out) % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
        return np.where(out == empty, np.uint16(0), small).reshape(-1, BINS)


def fingerprints(hashes: PrefixHashes, sketches: np.ndarray) -> list[str]:
    whole = hashes.span(hashes.starts, hashes.starts + hashes.sizes)
    return [f"{n:x}-{h:016x}-{s.tobytes().hex()}" for n, h, s in zip(hashes.sizes.tolist(), whole.tolist(), sketches.astype(">u2"))]


def likeness(first: list[str], second: list[str]) -> np.ndarray:
    """Likeness of fingerprints, pair by pair, from 0 to 1; 1 if they are equal."""
    def sketch(prints: list[str]) -> np.ndarray:
        return np.frombuffer(bytes.fromhex("".join(p.rpartition("-")[2] for p in prints)), dtype=">u2").reshape(-1, 2, BINS)

    a, b = sketch(first), sketch(second)
    either = ((a > 0) | (b > 0)).sum(axis=2)
    jaccard = (((a == b) & (a > 0)).sum(axis=2) / np.maximum(either, 1)).max(axis=1)
    same = np.array([x == y for x, y in zip(first, second)], dtype=bool)
    return np.where(same, 1.0, 2 * jaccard / (1 + jaccard))


def in_order(docs: DataFrame) -> DataFrame:
    """(bucket, tail, doc_id, text): documents by descending id in buckets, each closed by its successor's text.

    Buckets are ranges between quantiles of the id.  What follows a bucket is
    the first document of the next one (of the first one, after the last): a
    row a bucket, found by its id, so texts are dealt once and nothing is
    sorted in one task.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 100 * n).alias("q")).first().q if n > 1 else None
    marks = sorted(set(marks or []))
    place = F.size(F.filter(F.array(*(F.lit(m).cast("long") for m in marks)), lambda m: m <= F.col("doc_id"))) if marks else F.lit(0)
    placed = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(place).cast("int"))
    heads = placed.groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy(F.desc("bucket")).collect()  # a row a bucket
    before = [heads[k - 1].bucket for k in range(len(heads))]  # the first one closes the last
    if not heads:
        return placed.select("bucket", F.lit(0).alias("tail"), "doc_id", "text")
    rows = spark.createDataFrame([(h.head, b) for h, b in zip(heads, before)], "head long, closes int")
    closing = docs.join(F.broadcast(rows), F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("closes").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))  # the bucket's own order: null is empty
    return placed.select("bucket", F.lit(0).alias("tail"), "doc_id", "text").union(
        closing.select(F.col("closes").alias("bucket"), F.lit(1), F.lit(None).cast("long"), "text"))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness; see ``op6_fingerprints``."""
    ship_package(docs.sparkSession)

    def described(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows of all texts but the last, which only follows."""
        own = PrefixHashes(texts)
        sketches = own.sketches()
        prints = fingerprints(own, sketches)
        edited = [t[:len(t) - len(t) // 3] + after[:len(t) // 3] for t, after in zip(texts, texts[1:])]
        both = PrefixHashes(texts[:-1] + edited)
        m = len(edited)
        changed = PrefixHashes(edited)
        edited_prints = fingerprints(changed, changed.sketches())
        prefix = both.common_extension(both.starts[:m], both.starts[m:], np.minimum(both.sizes[:m], both.sizes[m:]))
        columns = [
            pa.array(ids, type=pa.int64()), pa.array(own.sizes[:m]),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], type=pa.string()),
            pa.array(prints[:m], type=pa.string()), pa.array(edited_prints, type=pa.string()),
            pa.array(likeness(prints[:m], edited_prints)), pa.array(likeness(prints[:m], prints[1:])), pa.array(prefix)]
        return pa.RecordBatch.from_arrays(columns, names=[
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "shared_prefix"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = [], []  # documents at hand; the last waits for its successor
        for batch in slices(batches, "text", 1 << 20):
            for doc_id, tail, text in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), texts_of(batch)):
                texts.append(text)
                if tail:
                    if ids:
                        yield described(ids, texts)
                    ids, texts = [], []
                else:
                    ids.append(doc_id)
            if len(ids) > 1:
                yield described(ids[:-1], texts)
                ids, texts = ids[-1:], texts[-1:]

    rows = in_order(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "tail", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    return ordered.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                   "near_edited double, near_next double, shared_prefix bigint")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edited text ends in the start of the next document's text (descending id, after the last the first)."""
    return with_edits(table(spark, sf_dir, "documents"))
