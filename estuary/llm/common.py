"""Helpers shared by the operators: inputs, shared scratch tables, Arrow columns."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to the Python workers, once per application.

    Workers then import the operators' helpers wherever they run, and keep
    their caches between tasks.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="estuary-code-"), "estuary_llm.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


_KEPT: dict[str, Callable[[], None]] = {}


def keeps(owner: str, clear: Callable[[], None]) -> None:
    """Name what a worker keeps between the tasks of one operator, and how to drop it."""
    _KEPT[owner] = clear


def drop_kept(but: str = "") -> None:
    """Drop what this worker keeps of other operators; called where a task of another one begins.

    Workers are used again by later stages, whose memory it would take.
    """
    for owner, clear in _KEPT.items():
        if owner != but:
            clear()
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir).

    Only where it is unset, as in local tests, a folder of our own is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="estuary-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with a replicated copy: an executor lost later costs
    nothing, and a join over the result sees plain scans, so AQE can split
    its skewed partitions.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each stay near ``max_bytes``."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.cumsum(np.array([0 if x is None else x for x in pc.binary_length(column).to_pylist()] or [0], dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + max_bytes, side="right")))
            yield batch.slice(start, min(end, batch.num_rows) - start)
            start = end


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column; null counts as empty."""
    return [x if x is not None else "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def bytes_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The text column as UTF-8; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def fresh(name: str, columns: list[str]) -> str:
    """A column name that no column has, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
