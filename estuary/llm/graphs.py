"""Connected components by contraction, for the deduplication operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estuary.llm.common import ship_package, stored

#: Links that one task contracts to the end.  Rounds over so few would each cost
#: the driver some ten jobs, and their plans and task reports its memory.
FEW = 2_000


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, p): the root of each node over all links (u, v) of the task."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, type=pa.int64()), pa.array([find(x) for x in nodes], type=pa.int64())], names=["u", "p"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the links (u, v).

    Each round contracts every node into the neighbour of least random rank
    and rewires the links, so the links left shrink by a constant factor on
    average whatever the shape of the graph; no component ever meets in one
    task, and a hub is only the target of a partial minimum.  The last links,
    ``FEW`` at most whatever the input, are contracted at once.
    """
    ship_package(edges.sparkSession)
    rest = stored(edges.where("u <> v").select("u", "v").distinct(), "links")
    maps: list[DataFrame] = []
    while n := rest.count():
        if n <= FEW:
            maps.append(stored(rest.repartition(1).mapInArrow(_roots, "u bigint, p bigint"), "parents"))
            break
        rank = F.xxhash64("v", F.lit(len(maps)))
        both = rest.select("u", "v").union(rest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.struct(rank.alias("r"), F.col("v").alias("v"))).alias("m"))
        own = F.xxhash64("u", F.lit(len(maps)))
        parent = stored(least.select("u", F.when((F.col("m.r") < own) | ((F.col("m.r") == own) & (F.col("m.v") < F.col("u"))), F.col("m.v"))
                                     .otherwise(F.col("u")).alias("p")), "parents")
        maps.append(parent)
        left = rest.join(parent.select("u", F.col("p").alias("pu")), "u")
        moved = left.join(parent.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v")
        rest = stored(moved.where("pu <> pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "links")
    if not maps:
        return rest.select(F.col("u").alias("node"), F.col("v").alias("component"))
    label = maps[0].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for m in maps[1:]:
        label = label.join(m.select(F.col("u").alias("root"), "p"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))
    label = stored(label, "roots")
    smallest = stored(label.groupBy("root").agg(F.min("node").alias("component")), "smallest")
    return label.join(smallest, "root").select("node", "component")
