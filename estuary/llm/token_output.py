"""Operator 1: token ids as Parquet list columns for selective reads.

Files hold one row per document in ascending (doc_id, text) order, nulls
first, over range partitions: ``part`` (the range), ``doc_id``,
``local_start`` (ids before the row in its range), ``n_tokens`` and
``token_ids`` (list of int).  Row groups and pages are bounded, the v2 writer
delta-encodes what its dictionaries cannot hold, and the page indexes that
Parquet writes let a reader with a filter on ``doc_id`` fetch only the pages
it needs; a read of the metadata columns never touches ``token_ids``.

Defined results: a null text is empty and holds only the end id; repeated
rows are stored as often as they occur; null ids come first; an empty table
gives files without rows.  Only the id and text columns are read, so further
columns, whatever their names, have no effect.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import list_column, scratch_path, slices, table, texts_of
from estuary.llm.encoding import library_encoder

END_ID = 2
FILE_SCHEMA = "part int, doc_id bigint, local_start bigint, n_tokens int, token_ids array<int>"
#: Row groups of 32 MB and pages of 64 kB: small enough for selective reads,
#: large enough that a scan stays sequential.
WRITER = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "2000",
}


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write the files under ``path``.

    Texts are dealt by id range before they are encoded, so the range
    sampling pass costs a scan and each text is encoded once.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = library_encoder(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text"):
            ids = [x + end for x in encoder.encode(texts_of(batch))]
            lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            starts = before + np.cumsum(lengths) - lengths
            before += int(lengths.sum())
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(ids), part, dtype=np.int32)), batch.column(0), pa.array(starts),
                pa.array(lengths.astype(np.int32)),
                list_column(np.frombuffer(b"".join(ids), dtype="<i4"), lengths, pa.int32()),
            ], names=["part", "doc_id", "local_start", "n_tokens", "token_ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, FILE_SCHEMA).write.options(**WRITER).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files with ``start``, the ids before them in all files.

    One row per file range meets in the small running sum; the sums are
    joined back by range, so the token lists are neither sorted nor dealt.
    """
    from pyspark.sql import Window

    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    ends = files.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ends.select(F.col("part").alias("p"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # a row per range, as many as shuffle partitions when the files were written
    return (files.join(F.broadcast(bases), files.part == bases.p)
            .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "token_ids"))


def with_crc(rows: DataFrame, ids: str = "token_ids", name: str = "ids_crc32") -> DataFrame:
    """Unsigned crc32 of a list column's ids as little-endian uint32."""
    keep = [c for c in rows.columns if c != ids]

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False).tobytes()
            ends = 4 * np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            at, sums = 0, []
            for end in ends.tolist():
                sums.append(zlib.crc32(flat[at:end]))
                at = end
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(sums, type=pa.int64())],
                names=[*keep, name])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(crc, ", ".join(f"{c} {kinds[c]}" for c in keep) + f", {name} bigint")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return with_crc(read_token_files(spark, path)).select(
        "doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
