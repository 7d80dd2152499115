"""Operator 5: repeated byte strings by sparse distributed prefix doubling.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts
earlier.  Sorting a rank pair for every byte of the corpus in every round
would move many times the corpus, so the rounds work on synchronised
positions: each string's *anchor* is the leftmost least-hashed ``SEED``-byte
gram inside it, so equal strings have equal anchors at equal offsets, and the
starts that share an anchor are neighbours, its *block*.  Spark sorts
(rank, next rank, position) rows in three rounds at growing lengths:

1. blocks, by the anchor gram and then by all bytes of the block's strings:
   a block equal to an earlier one goes whole; one whose gram is unique holds
   no repeat; what differs under a shared gram is ranked anew,
2. pieces of ``PIECE`` neighbouring starts, by the bytes that all their
   strings share (``LENGTH - PIECE + 1``) and then by the margins around,
3. single strings, by those shared bytes and their part of the margins.

Only rows not yet unique and not yet settled enter the next round.  Rows that
repeat inside a slice of a task are settled there, before any shuffle; grams
seen in more than a thousandth of a sample's blocks are also dealt by their
context, so no frequent passage ends in one task (the sample steers the
dealing only).  Ranks are 64-bit hashes of the bytes they stand for, compared
together with the rest of their row.

Defined results: a null or empty text has no bytes and stays so; texts
shorter than ``LENGTH`` never lose a byte; rows with a null id come first,
told apart by their text; rows that repeat an id are one document (none is
earlier than another, and what goes in one goes in all); an empty table gives
no rows.  Columns other than id and text are passed on or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from estuary.llm.common import bytes_of, drop_kept, fresh, ship_package, slices, stored, table
from estuary.llm.shingles import mix, powers

LENGTH = 100
SEED = 16
PIECE = 8
#: One document in so many tells which grams are dealt by context too.
SAMPLE = 64
SALTS = 64
RANKED = "kind int, key bigint, c1 bigint, c2 bigint, rid bigint, pos bigint"
SETTLED, OPEN = 0, 1


class Spans:
    """Hashes of any span of one flat byte array, from prefix sums modulo 2**64."""

    def __init__(self, texts: list[bytes]):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        power, self.inverse = powers(len(self.data) + 1)
        self.sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((self.data + np.uint64(1)) * power[:len(self.data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def blocks(spans: Spans, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of every block, and the hashes of all grams."""
    n, width = len(spans.data), length - seed + 1
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none, np.zeros(0, dtype=np.uint64)
    at = np.arange(n - seed + 1)
    grams = mix((spans.sums[seed:] - spans.sums[:-seed]) * spans.inverse[:len(at)])
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(anchor))
    inside = spans.ends[np.searchsorted(spans.ends, start, side="right")] - start >= length
    start, anchor = start[inside], anchor[inside]
    if not len(start):
        return none, none, none, grams
    first = np.ones(len(start), dtype=bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    edge = np.flatnonzero(first)
    return anchor[edge], start[edge], start[np.append(edge[1:], len(start)) - 1], grams


def settle(key: np.ndarray, c1: np.ndarray, c2: np.ndarray, rid: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of each class's first row, and of its later rows, within a slice."""
    name = mix(mix(key.view(np.uint64) ^ mix(c1.view(np.uint64))) + c2.view(np.uint64))
    order = np.lexsort((pos, rid, name))
    head = np.ones(len(order), dtype=bool)
    head[1:] = name[order[1:]] != name[order[:-1]]
    lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = (rid[order] != rid[lead]) | (pos[order] != pos[lead])
    return order[head], order[later]


def ranked_batch(kind: int, key, c1, c2, rid, pos) -> pa.RecordBatch:
    columns = [np.full(len(rid), kind, dtype=np.int32), *(np.asarray(x).astype(np.int64, copy=False) for x in (key, c1, c2, rid, pos))]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["kind", "key", "c1", "c2", "rid", "pos"])


def settled_rows(rid: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Byte ranges that go, overlapping ones of a document merged."""
    order = np.lexsort((begin, rid))
    rid, begin, end = rid[order], begin[order], end[order]
    new = np.ones(len(rid), dtype=bool)
    # within a document all ranges of a round differ little in length, so ends ascend but for a few
    new[1:] = (rid[1:] != rid[:-1]) | (begin[1:] > end[:-1])
    edge = np.flatnonzero(new)
    last = np.maximum.reduceat(end, edge) if len(edge) else end[:0]
    return ranked_batch(SETTLED, mix(rid[edge].view(np.uint64)).view(np.int64), begin[edge], last, rid[edge], begin[edge])


def _settled_block(rid, pos):
    low = (pos >> 14) - (pos >> 7 & 127)
    return settled_rows(rid, low, low + (pos & 127) + LENGTH)


def _settled_piece(rid, pos):
    start = (pos >> 6) - PIECE
    return settled_rows(rid, start + (pos >> 3 & 7), start + (pos & 7) + LENGTH)


def _settled_string(rid, pos):
    return settled_rows(rid, pos, pos + LENGTH)


def block_rows(rows: DataFrame) -> DataFrame:
    """Round 1 input: a row for each block, but those settled in their slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in slices(batches, "text", 1 << 20):
            spans = Spans(bytes_of(batch))
            anchor, low, high, grams = blocks(spans, LENGTH, SEED)
            if not len(anchor):
                continue
            doc = np.searchsorted(spans.ends, low, side="right")
            rid = batch.column(0).to_numpy(zero_copy_only=False)[doc]
            base = (spans.ends - spans.sizes)[doc]
            key, context = grams[anchor].view(np.int64), spans.hash(low, high + LENGTH).view(np.int64)
            pos = anchor - base << 14 | anchor - low << 7 | high - low
            nothing = np.zeros(len(pos), dtype=np.int64)
            first, later = settle(key, context, nothing, rid, pos)
            yield ranked_batch(OPEN, key[first], context[first], nothing[first], rid[first], pos[first])
            if len(later):
                yield _settled_block(rid[later], pos[later])

    return rows.mapInArrow(run, RANKED)


def piece_rows(rows: DataFrame) -> DataFrame:
    """Round 2 input, from documents with the blocks that stayed open (``open``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            spans = Spans(bytes_of(batch))
            lists = batch.column(2)
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            packed = lists.flatten().to_numpy(zero_copy_only=False)
            size, base = spans.sizes[doc], (spans.ends - spans.sizes)[doc]
            anchor = packed >> 14
            low = anchor - (packed >> 7 & 127)
            high = low + (packed & 127)
            fits = high + LENGTH <= size  # else another text under the same id
            doc, base, anchor, low, high = (x[fits] for x in (doc, base, anchor, low, high))
            if not len(doc):
                continue
            j0, j1 = (low - anchor) // PIECE, (high - anchor) // PIECE
            n = j1 - j0 + 1
            unit = np.repeat(np.arange(len(n)), n)
            start = (anchor + j0 * PIECE)[unit] + PIECE * (np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n))
            t0 = np.maximum(low[unit] - start, 0)
            t1 = np.minimum(high[unit] - start, PIECE - 1)
            begin = base[unit] + start
            key = spans.hash(begin + PIECE - 1, begin + LENGTH).view(np.int64)
            left, right = np.zeros(len(unit), dtype=np.int64), np.zeros(len(unit), dtype=np.int64)
            top = len(spans.data) - 1
            for k in range(PIECE - 1):  # the margins' bytes, 0 where no string of the piece has them
                left |= np.where(k >= t0, spans.data[np.clip(begin + k, 0, top)].astype(np.int64) << 8 * k, 0)
                right |= np.where(k < t1, spans.data[np.clip(begin + LENGTH + k, 0, top)].astype(np.int64) << 8 * k, 0)
            right |= (t0 << 3 | t1) << 56
            rid = batch.column(0).to_numpy(zero_copy_only=False)[doc][unit]
            pos = start + PIECE << 6 | t0 << 3 | t1
            first, later = settle(key, left, right, rid, pos)
            yield ranked_batch(OPEN, key[first], left[first], right[first], rid[first], pos[first])
            if len(later):
                yield _settled_piece(rid[later], pos[later])

    return rows.mapInArrow(run, RANKED)


def string_rows(pieces: DataFrame) -> DataFrame:
    """Round 3 input: the single strings of pieces that stayed open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, c1, c2, rid, pos = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 6))
            t0, t1, start = pos >> 3 & 7, pos & 7, (pos >> 6) - PIECE
            n = t1 - t0 + 1
            row = np.repeat(np.arange(len(n)), n)
            t = t0[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            left = c1[row] >> 8 * t << 8 * t
            right = (c2[row] & (np.int64(1) << 8 * t) - 1) | t << 56
            mine, ids, at = key[row], rid[row], start[row] + t
            first, later = settle(mine, left, right, ids, at)
            yield ranked_batch(OPEN, mine[first], left[first], right[first], ids[first], at[first])
            if len(later):
                yield _settled_string(ids[later], at[later])

    return pieces.mapInArrow(run, RANKED)


def rerank(rows: DataFrame, settled, hot: list[int], last: bool) -> DataFrame:
    """Sort a round's rows and settle them.

    The first row of each class (key, c1, c2) in document order stays; later
    ones are settled.  First rows stay open where their key has several
    classes.  The sort streams: no class or key is held in memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy = np.array(sorted(hot), dtype=np.int64)
        lead, opened = None, False  # the first row of the class at hand; whether it was handed on
        for batch in batches:
            kind, *columns = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            if not kind.all():
                yield ranked_batch(SETTLED, *(c[kind == SETTLED] for c in columns))
                columns = [c[kind == OPEN] for c in columns]
            if not len(columns[0]):
                continue
            carried = lead is not None
            if carried:
                columns = [np.concatenate([[x], c]) for x, c in zip(lead, columns)]
            key, c1, c2, rid, pos = columns
            head = np.ones(len(key), dtype=bool)
            head[1:] = (key[1:] != key[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
            first = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
            later = (rid != rid[first]) | (pos != pos[first])
            if later.any():
                yield settled(rid[later], pos[later])
            lead = [c[first[-1]] for c in columns]
            if last:
                continue
            heads = np.flatnonzero(head)
            k = key[heads]
            several = np.isin(k, heavy)
            several[1:] |= k[1:] == k[:-1]
            several[:-1] |= k[:-1] == k[1:]
            due = several.copy()
            if carried and opened:
                due[0] = False
            if due.any():
                yield ranked_batch(OPEN, *(c[heads[due]] for c in columns))
            opened = bool(several[-1]) or (carried and opened and len(heads) == 1)
    salt = F.when(F.col("key").isin(hot), F.pmod(F.xxhash64("c1", "c2"), F.lit(SALTS))).otherwise(F.lit(0)) if hot else F.lit(0)
    dealt = rows.repartition("key", salt).sortWithinPartitions("key", "c1", "c2", "rid", "pos")
    return dealt.mapInArrow(run, RANKED)


def frequent_keys(rows: DataFrame) -> list[int]:
    """Keys of more than a thousandth of the rows, so fewer than a thousand."""
    counts = stored(rows.where(F.col("kind") == OPEN).groupBy("key").agg(F.count(F.lit(1)).alias("n")), "gram_counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r.key for r in counts.where((F.col("n") > total / 1000) & (F.col("n") > 1)).select("key").collect()]


def row_ids(id_col: str, text_col: str):
    """The id; for a null one, a negative number made of the text."""
    return F.coalesce(F.col(id_col).cast("long"), -1 - F.xxhash64(text_col).bitwiseAND(F.lit((1 << 62) - 1)))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, begin, end): byte ranges covered by strings that start earlier too; they may overlap."""
    ship_package(docs.sparkSession)
    rows = docs.select(row_ids(id_col, text_col).alias("rid"), F.col(text_col).alias("text")).where("text is not null")
    hot = frequent_keys(block_rows(rows.where(F.pmod(F.xxhash64("rid"), F.lit(SAMPLE)) == 0)))
    one = stored(rerank(block_rows(rows), _settled_block, hot, last=False), "blocks")
    left = one.where(F.col("kind") == OPEN).groupBy("rid").agg(F.collect_list("pos").alias("open"))
    two = stored(rerank(piece_rows(rows.join(left, "rid")), _settled_piece, [], last=False), "pieces")
    three = stored(rerank(string_rows(two.where(F.col("kind") == OPEN)), _settled_string, [], last=True), "strings")
    spans = [x.where(F.col("kind") == SETTLED).select("rid", F.col("c1").alias("begin"), F.col("c2").alias("end")) for x in (one, two, three)]
    return spans[0].union(spans[1]).union(spans[2])


def _cut(docs: DataFrame, id_col: str, text_col: str, schema: StructType, rows) -> DataFrame:
    """``docs`` mapped by ``rows(batch, texts, masks)``; a mask tells the bytes that go, None where all stay."""
    columns = docs.columns
    rid, spans = fresh("_rid", columns), fresh("_spans", columns)
    found = repeated_spans(docs, id_col, text_col).groupBy(F.col("rid").alias(rid)).agg(
        F.flatten(F.collect_list(F.array("begin", "end"))).alias(spans))
    joined = docs.withColumn(rid, row_ids(id_col, text_col)).join(found, rid, "left").select(*columns, spans)

    def mask(size: int, edges: list[int]) -> np.ndarray:
        depth = np.zeros(size + 1, dtype=np.int32)
        pairs = np.minimum(np.array(edges), size)
        np.add.at(depth, pairs[::2], 1)
        np.add.at(depth, pairs[1::2], -1)
        return np.cumsum(depth[:-1]) > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = bytes_of(batch, text_col)
            masks = [mask(len(t), e) if e else None for t, e in zip(texts, batch.column(batch.num_columns - 1).to_pylist())]
            yield rows(batch.select(columns), texts, masks)

    return joined.mapInArrow(run, schema)


def kept_bytes(text: bytes, gone: np.ndarray | None) -> bytes:
    return text if gone is None else np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes.

    Column names that clash get a trailing underscore.
    """
    added = [fresh(c, docs.columns) for c in ("n_bytes", "n_removed", "n_spans", "kept")]
    kinds = (LongType(), LongType(), LongType(), BinaryType())

    def rows(batch: pa.RecordBatch, texts: list[bytes], masks: list) -> pa.RecordBatch:
        runs = [0 if m is None else int(np.count_nonzero(np.diff(np.concatenate([[False], m]).view(np.int8)) == 1)) for m in masks]
        counts = [[len(t) for t in texts], [0 if m is None else int(m.sum()) for m in masks], runs]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(x, type=pa.int64()) for x in counts), pa.array(map(kept_bytes, texts, masks), type=pa.binary())],
            names=[*batch.schema.names, *added])

    schema = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(added, kinds))])
    return _cut(docs, id_col, text_col, schema, rows)


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with their texts cut; characters of which a byte went go whole, null texts stay null."""
    place = docs.columns.index(text_col)

    def rows(batch: pa.RecordBatch, texts: list[bytes], masks: list) -> pa.RecordBatch:
        old = batch.column(place)
        new = [kept_bytes(t, m).decode("utf-8", "ignore") if ok else None for t, m, ok in zip(texts, masks, old.is_valid().to_pylist())]
        return batch.set_column(place, text_col, pa.array(new, type=old.type))

    return _cut(docs, id_col, text_col, docs.schema, rows)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
