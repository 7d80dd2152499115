"""Operator 10: packing documents into windows by non-negative least squares.

A document's ids are cut into full windows and one rest; the histogram of
piece lengths (at most ``window`` bins, counted over all documents) goes to
the driver.  There, shallow combinations of lengths that fill a window
exactly are enumerated, their repeat counts are solved against the histogram
by non-negative least squares and rounded, and what is left is packed
greedily, cutting a piece where nothing fits a gap.  The plan is a table of
runs whose size depends on the window alone; each piece finds its place in it
by its number among the pieces of its length, so no group of pieces ever
meets in one task.

Defined results: a null or empty text is a document of its end id only;
repeated rows are packed as often as they occur; an empty table gives no
rows; a sequence is padded only if it is not full, and only the very last may
be (less than a window of padding in all).  Only the id and text columns are
read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estuary.llm.common import slices, stored, table, texts_of
from estuary.llm.encoding import library_encoder

WINDOW = 1024
END_ID = 0
#: Columns that the last least-squares round keeps for each length.
COLUMNS_PER_LENGTH = 2


def combinations(window: int, lengths: np.ndarray) -> np.ndarray:
    """All pairs and triples of the given lengths that fill the window, padded with 0."""
    have = np.zeros(window + 1, dtype=bool)
    have[lengths] = True
    found = []
    for a in lengths.tolist():
        if have[window - a] and a <= window - a:
            found.append(np.array([[a, window - a, 0]]))
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        b = b[have[window - a - b]]
        if len(b):
            found.append(np.stack([np.full(len(b), a), b, window - a - b], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)


def repeat_counts(columns: np.ndarray, histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative least squares of repeats against the histogram.

    Multiplicative updates keep every repeat non-negative; between rounds the
    smaller half of the columns goes, down to a few for each length, so that
    the mass gathers on columns whose counts survive rounding.
    """
    size, target = len(histogram), histogram.astype(float)
    target[0] = 0
    least = COLUMNS_PER_LENGTH * max(1, np.count_nonzero(target))
    x = np.min(np.where(columns > 0, target[columns], np.inf), axis=1) / 2 if len(columns) else np.zeros(0)
    while len(columns):
        last = len(columns) <= least
        want = np.where(columns > 0, target[columns], 0).sum(axis=1)
        for _ in range(300 if last else 40):
            held = np.bincount(columns.ravel(), weights=np.repeat(x, columns.shape[1]), minlength=size)
            held[0] = 0
            x = x * want / (np.where(columns > 0, held[columns], 0).sum(axis=1) + 1e-12)
        if last:
            break
        keep = np.sort(np.argsort(-x, kind="stable")[:max(least, len(x) // 2)])
        columns, x = columns[keep], x[keep]
    return columns, x


class Plan:
    """Runs of equal-length pieces and where they go.

    A record says: pieces ``idx0 .. idx0 + count`` of length ``origin`` put
    their ids from ``part`` on, ``size`` of them, into sequences ``seq0 ..``
    at ``offset``.
    """

    def __init__(self, window: int, histogram: np.ndarray):
        self.window, self.records, self.sequences = window, [], 0
        self.left = histogram.astype(np.int64).copy()
        self.left[0] = 0
        self.runs = defaultdict(list)
        for n in np.flatnonzero(self.left).tolist():
            self.runs[n].append((n, 0, int(self.left[n]), 0))

    def _take(self, length: int, count: int) -> list[tuple[int, int, int, int]]:
        self.left[length] -= count
        out = []
        while count:
            origin, idx0, n, part = self.runs[length].pop()
            if n > count:
                self.runs[length].append((origin, idx0 + count, n - count, part))
                n = count
            out.append((origin, idx0, n, part))
            count -= n
        return out

    def fill(self, lengths: list[int], times: int, cut: tuple[int, int] | None = None) -> None:
        """``times`` sequences of these lengths, then the first ``cut[1]`` ids of pieces of length ``cut[0]``."""
        offset = 0
        for length, size in [*((n, n) for n in lengths), *([cut] if cut else [])]:
            seq = self.sequences
            for origin, idx0, n, part in self._take(length, times):
                self.records.append((origin, idx0, n, part, size, seq, offset))
                seq += n
                if size < length:
                    self.runs[length - size].append((origin, idx0, n, part + size))
                    self.left[length - size] += n
            offset += size
        self.sequences += times

    def greedy(self) -> None:
        """Longest first, then the longest that fits, then a cut piece."""
        while self.left.any():
            lengths = [int(np.flatnonzero(self.left)[-1])]
            times, gap = int(self.left[lengths[0]]), self.window - lengths[0]
            cut = None
            while gap:
                used = np.bincount(lengths, minlength=len(self.left))
                free = self.left // (used + 1)
                fits = np.flatnonzero(free[:gap + 1])
                if len(fits):
                    lengths.append(int(fits[-1]))
                    times = min(times, int(free[fits[-1]]), *(int(self.left[n] // lengths.count(n)) for n in set(lengths)))
                    gap -= lengths[-1]
                    continue
                longer = np.flatnonzero(free)
                if len(longer):
                    cut = int(longer[-1]), gap
                    times = min(times, int(free[longer[-1]]))
                elif times > 1 and lengths.count(lengths[0]) * times <= self.left[lengths[0]] and len(set(lengths)) == 1:
                    # only pieces of this length are left: they fill each other's gaps
                    times = max(1, times // 2)
                    continue
                break
            self.fill(lengths, times, cut)

    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of atomic runs, their slices of ``order``, and the records."""
        records = np.array(self.records, dtype=np.int64).reshape(-1, 7)
        keys, begins, order = [], [], []
        for length in np.unique(records[:, 0]).tolist():
            mine = np.flatnonzero(records[:, 0] == length)
            idx0, idx1 = records[mine, 1], records[mine, 1] + records[mine, 2]
            edges = np.unique(np.concatenate([idx0, idx1]))
            members = [[] for _ in edges]
            for k, a, b in zip(mine.tolist(), np.searchsorted(edges, idx0).tolist(), np.searchsorted(edges, idx1).tolist()):
                for j in range(a, b):
                    members[j].append(k)
            for edge, found in zip(edges.tolist(), members):
                keys.append(length << 44 | edge)
                begins.append(len(order))
                order += sorted(found, key=lambda k: records[k, 3])
        return np.array(keys, dtype=np.int64), np.array([*begins, len(order)]), np.array(order, dtype=np.int64), records


def make_plan(histogram: np.ndarray, window: int) -> Plan:
    plan = Plan(window, histogram)
    if plan.left[window]:
        plan.fill([window], int(plan.left[window]))
    lengths = np.flatnonzero(plan.left)
    columns, x = repeat_counts(combinations(window, lengths), plan.left)
    for k in np.argsort(-x, kind="stable").tolist():
        parts = [int(n) for n in columns[k] if n]
        times = min(int(np.rint(x[k])), *(int(plan.left[n] // parts.count(n)) for n in parts))
        if times > 0:
            plan.fill(parts, times)
    plan.greedy()
    return plan


def pieces_of(docs: DataFrame, vocabulary: str, window: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Full windows and rests, numbered by length within each part of the input.

    Ids are packed in two bytes where the vocabulary allows it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, counts = library_encoder(vocabulary), TaskContext.get().partitionId(), np.zeros(window + 1, dtype=np.int64)
        for batch in slices(batches, "text"):
            ids = batch.column(0).to_pylist()
            rows: dict[str, list] = defaultdict(list)
            for doc_id, raw in zip(ids, encoder.encode(texts_of(batch))):
                tokens = np.append(np.frombuffer(raw, dtype="<u4"), np.uint32(end_id))
                narrow = tokens.astype("<u2") if tokens.max() < 1 << 16 else tokens
                for start in range(0, len(tokens), window):
                    piece = narrow[start:start + window]
                    rows["doc_id"].append(doc_id)
                    rows["start"].append(start)
                    rows["length"].append(len(piece))
                    rows["doc_tokens"].append(len(tokens))
                    rows["idx"].append(counts[len(piece)])
                    rows["ids"].append(piece.tobytes())
                    counts[len(piece)] += 1
            if ids:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(rows["ids"]), part, dtype=np.int32)), pa.array(rows["doc_id"], type=pa.int64()),
                    pa.array(rows["start"], type=pa.int64()), pa.array(rows["length"], type=pa.int32()),
                    pa.array(rows["doc_tokens"], type=pa.int64()), pa.array(rows["idx"], type=pa.int64()),
                    pa.array(rows["ids"], type=pa.binary())],
                    names=["part", "doc_id", "start", "length", "doc_tokens", "idx", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "part int, doc_id bigint, start bigint, length int, doc_tokens bigint, idx bigint, ids binary")


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with their ids (little-endian uint32), sequence and offset; each id lies in exactly one piece."""
    pieces = stored(pieces_of(docs, vocabulary, window, end_id, id_col, text_col), "pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    histogram = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most `window` rows
        histogram[length] = n
    keys, begins, order, records = make_plan(histogram, window).index()
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("part").alias("p"), F.col("length").alias("l"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, (pieces.part == bases.p) & (pieces.length == bases.l)).select(
        "doc_id", "start", "length", "doc_tokens", (F.col("base") + F.col("idx")).alias("idx"), "ids")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, idx = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 4))
            run = np.searchsorted(keys, length << 44 | idx, side="right") - 1
            n = begins[run + 1] - begins[run]
            row = np.repeat(np.arange(len(run)), n)
            rec = records[order[np.repeat(begins[run] - (np.cumsum(n) - n), n) + np.arange(len(row))]]
            raw, sizes = batch.column(5).to_pylist(), rec[:, 4]
            ids = [np.frombuffer(x, dtype="<u2" if len(x) == 2 * k else "<u4") for x, k in zip(raw, length.tolist())]
            out = [ids[r][a:a + s].astype("<u4").tobytes() for r, a, s in zip(row.tolist(), rec[:, 3].tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), pa.array(batch.column(1).to_numpy(zero_copy_only=False)[row] + rec[:, 3]),
                pa.array(sizes), batch.column(3).take(pa.array(row)), pa.array(rec[:, 5] + idx[row] - rec[:, 1]),
                pa.array(rec[:, 6]), pa.array(out, type=pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return numbered.mapInArrow(place, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
                                      "offset bigint, ids binary")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    rows = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
