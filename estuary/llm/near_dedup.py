"""Operator 4: near-duplicate groups by MinHash with tensored banding.

Two groups of ``side`` small collections of ``ROWS`` minhashes each are drawn;
every pair with one collection from either group is the key of a table, so
``side**2`` tables of ``2 * ROWS`` rows cost only ``2 * side * ROWS``
minhashes.  Texts of equal shingle sets are one class from the start.  Tables
link each class to the smallest class of its bucket; the components of these
links are blocks that hold every candidate pair.  Blocks are cut into cells
of about ``CELL`` classes, and each pair of cells is compared on full sets in
a task of its own: a bucket of any size spreads over tasks of bounded size,
and all its pairs are verified without becoming rows.  The verified links,
one spanning forest for each task, are contracted to the final groups.

``side`` is the least for which a pair at the threshold meets in a table with
probability ``MEET`` under independent hashes (12 at 80 percent, where 0.9994 of
12,000 pairs met), near 1 well beyond it; op 4 takes 8 at 85 percent (0.9990 of
12,000 pairs).  Pairs that meet in a block by way of others are verified too.

Defined results: a null text, or one without words, has the empty set, is
linked with nothing and is its own component; where an id repeats, each row
takes the group of its own text; rows with a null id are grouped like others, and
a group without any id has the component null, all its rows kept.
Only the id and text columns are read, others are passed on by ``keep_one``; texts of
any length are taken whole, ties in size of a group go to the smaller id, and
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import bytes_of, drop_kept, fresh, list_column, ship_package, slices, stored, table
from estuary.llm.graphs import components
from estuary.llm.shingles import WORDS, mix, shingle_sets

PERCENT = 85
ROWS, MEET = 3, 0.9993
ROUND = 6
CELL = 192


def side_for(percent: int) -> int:
    """Collections in a group: both groups must have one that a pair at the threshold shares."""
    if percent <= 0:
        raise ValueError("the threshold must be above 0 percent")
    if percent >= 100:
        return 1
    return math.ceil(math.log(1 - math.sqrt(MEET)) / math.log(1 - (percent / 100) ** ROWS))


def _hash_family(side: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the minhash functions, from a fixed rule."""
    seeds = mix(np.arange(1, 4 * side * ROWS + 1, dtype=np.uint64))
    return seeds[::2] | np.uint64(1), seeds[1::2]


def half_keys(sets: list[np.ndarray], side: int) -> np.ndarray:
    """A row of ``2 * side`` half keys for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    a, b = _hash_family(side)
    halves = np.empty((len(sets), 2 * side), dtype=np.uint64)
    for k in range(2 * side):
        key = np.full(len(sets), k, dtype=np.uint64)
        for j in range(k * ROWS, (k + 1) * ROWS):
            value = flat * a[j] + b[j]
            value ^= value >> np.uint64(32)
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + np.minimum.reduceat(value, starts))
        halves[:, k] = key
    return halves


def signatures(docs: DataFrame, side: int, words: int = WORDS) -> DataFrame:
    """(doc_id, mark, n_shingles, set1, set2, halves) of (doc_id, text, mark): a 128-bit set hash and the half keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept("shingles")
        for batch in slices(batches, "text", 1 << 19):
            sets = shingle_sets(bytes_of(batch), words)
            full = [k for k, s in enumerate(sets) if len(s)]
            halves, lengths = np.zeros((0, 2 * side), dtype=np.uint64), np.zeros(len(sets), dtype=np.int64)
            if full:
                halves = half_keys([sets[k] for k in full], side)
                lengths[full] = 2 * side
            sums = [pa.array(np.array([mix(s + np.uint64(salt)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64))
                    for salt in (0x51, 0xA7C3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.array([len(s) for s in sets], dtype=np.int64)), *sums,
                 list_column(halves.view(np.int64).ravel(), lengths, pa.int64())],
                names=["doc_id", "mark", "n_shingles", "set1", "set2", "halves"])

    return docs.mapInArrow(run, "doc_id bigint, mark bigint, n_shingles bigint, set1 bigint, set2 bigint, halves array<bigint>")


def candidate_links(classes: DataFrame, side: int) -> DataFrame:
    """Links (u, v) of each class to the smallest class of each of its buckets.

    The tables are made in rounds of ``ROUND`` collections of the first group
    at most, whose links are written: fewer rows are under way at a time."""
    rounds, found = math.ceil(side / ROUND), None
    for k in range(rounds):
        firsts = range(side * k // rounds, side * (k + 1) // rounds)
        keys = classes.select("rep", F.explode(F.expr(
            f"flatten(transform(sequence({firsts[0]}, {firsts[-1]}), i -> transform(sequence(0, {side - 1}),"
            f" j -> xxhash64(halves[i], halves[{side} + j], i * {side} + j))))")).alias("key"))
        heads = keys.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("tail")).where("head <> tail")
        links = stored(keys.join(heads.select("key", "head"), "key").where("rep <> head").select(
            F.col("rep").alias("u"), F.col("head").alias("v")).distinct(), "candidates")
        found = links if found is None else found.unionByName(links)
    return found


def cells(blocks: DataFrame, cell: int = CELL) -> DataFrame:
    """(block, lo, hi, own, node): each class in every pair of cells of its block that holds its own."""
    sizes = stored(blocks.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("n")), "block_sizes")
    own = F.pmod(F.xxhash64("node"), F.col("n")).cast("int")
    dealt = blocks.join(sizes, "component").select(F.col("component").alias("block"), "node", own.alias("own"), "n")
    return dealt.select("block", "node", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")).select(
        "block", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node")


def intersections(sets: list[np.ndarray], slab: int = 4096) -> np.ndarray:
    """Matrix of intersection sizes, over shingles that two sets or more hold."""
    m, owner = len(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.ones(len(flat), dtype=bool)
    np.not_equal(flat[1:], flat[:-1], out=fresh[1:])
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column)[column] > 1
    owner = owner[shared]
    column = np.cumsum(fresh[shared]) - 1
    out = np.zeros((m, m), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, slab):
        a, b = np.searchsorted(column, [start, start + slab])
        part = np.zeros((m, slab), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        out += part @ part.T
    return out


def spanning(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that join two groups not yet joined."""
    parent, kept = list(range(n)), []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs.tolist():
        a, b = find(i), find(j)
        if a != b:
            parent[a] = b
            kept.append((i, j))
    return kept


def verified_links(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (u, v) whose full sets reach the threshold, from (block, lo, hi, own, node, shingles)."""
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        sets = [np.asarray(s, dtype=np.int64) for s in unit["shingles"]]
        sizes, node, own = np.array([len(s) for s in sets]), unit["node"].to_numpy(), unit["own"].to_numpy()
        both = intersections(sets)
        both = both.astype(np.int64)  # the counts are exact, their products in single precision are not
        linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
        if unit["lo"].iat[0] != unit["hi"].iat[0]:
            linked &= own[:, None] != own[None, :]
        pairs = np.argwhere(np.triu(linked, 1))
        kept = np.array(spanning(len(sets), pairs), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": node[kept[:, 0]], "v": node[kept[:, 1]]}).astype("int64")

    return members.groupBy("block", "lo", "hi").applyInPandas(run, "u bigint, v bigint")


def with_sets(docs: DataFrame, nodes: DataFrame, words: int = WORDS) -> DataFrame:
    """(node, shingles), from rows (doc_id, text, mark) and (node, doc_id, mark) of one document for each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept("shingles")
        for batch in slices(batches, "text", 1 << 19):
            sets = shingle_sets(bytes_of(batch), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), list_column(np.concatenate([*sets, np.zeros(0, dtype=np.uint64)]).view(np.int64),
                                              np.array([len(s) for s in sets], dtype=np.int64), pa.int64())],
                names=["node", "shingles"])

    at = nodes.select("node", F.col("doc_id").alias("at"), F.col("mark").alias("seen"))
    found = docs.join(at, F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("mark") == F.col("seen")))
    return found.select("node", "text").dropDuplicates(["node"]).mapInArrow(run, "node bigint, shingles array<bigint>")


def grouped(docs: DataFrame, percent: int, words: int, id_col: str, text_col: str, side: int | None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, n_shingles, set1, set2) of every row, and (set1, set2, best) of every set.

    ``mark`` is the text's hash, ``best`` the (nil, doc_id, mark) of the
    least document of the set's group: ids before null, then by id and mark.
    Sets are numbered when they are written, so nodes do not depend on ids.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    side = side or side_for(percent)
    signed = stored(signatures(rows, side, words), "signatures")
    place = F.struct(F.col("doc_id").isNull().alias("nil"), "doc_id", "mark")
    # a class's half keys are equal in all its rows
    classes = stored(signed.where("n_shingles > 0").groupBy("set1", "set2").agg(F.min(place).alias("first"), F.first("halves").alias("halves"))
                     .withColumn("rep", F.monotonically_increasing_id()), "classes")
    blocks = stored(components(candidate_links(classes, side)), "blocks")
    units = stored(cells(blocks), "cells")
    nodes = classes.select(F.col("rep").alias("node"), "first.doc_id", "first.mark").join(blocks.select("node"), "node")
    links = stored(verified_links(units.join(with_sets(rows, nodes, words), "node"), percent), "verified")
    label = components(links)
    joined = stored(classes.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "set1", "set2", "first", F.coalesce("component", "rep").alias("component")), "groups")
    best = joined.groupBy("component").agg(F.min("first").alias("best"))
    return signed.drop("halves"), stored(joined.join(best, "component").select("set1", "set2", "best"), "best")


def near_groups(docs: DataFrame, percent: int = PERCENT, words: int = WORDS,
                id_col: str = "doc_id", text_col: str = "text", side: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    signed, groups = grouped(docs, percent, words, id_col, text_col, side)
    found = signed.join(groups, ["set1", "set2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("best.doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT, words: int = WORDS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, with one document left of every group.

    A document is an id and its text.  The one of least id stays (a null id
    only where the group has no other; texts of one id by their hash), in one
    row.  Another text under the same id is judged on its own.  Rows without
    words are in no group: one of each id and text stays.
    """
    signed, groups = grouped(docs, percent, words, id_col, text_col, None)
    mark, at, seen = (fresh(c, docs.columns) for c in ("_mark", "_kept_id", "_kept_mark"))
    stay = groups.select(F.col("best.doc_id").alias(at), F.col("best.mark").alias(seen))
    bare = signed.where("n_shingles = 0").select(F.col("doc_id").alias(at), F.col("mark").alias(seen))
    kept = stored(stay.unionByName(bare).distinct(), "near_kept")
    marked = docs.withColumn(mark, F.xxhash64(text_col))
    left = marked.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(at)) & (F.col(mark) == F.col(seen)), "left_semi")
    return left.dropDuplicates([id_col, mark]).drop(mark)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), percent=85, side=8)


#: A-Z are lowered by hand: lower() would change other letters too.
OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words),
parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM parts a JOIN parts b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.v), s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(min(r.v), s.doc_id)) AS kept
FROM sets s LEFT JOIN reach r ON r.u = s.doc_id
GROUP BY s.doc_id, s.s
"""
