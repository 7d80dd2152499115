"""Operator 11: Merkle manifest of a table, with a proof for every row.

Rows are leaves; the leaves of a group (a language) make a tree, and the
groups' roots make the tree above.  Nodes are cut into superblocks of
``1 << height`` consecutive ones.  The climb reduces each superblock to its
root, and the roots are the nodes of the next round, so a group of any size
takes a few rounds of small tasks.  The descent brings every superblock the
outer nodes that its rows' proofs need: nodes and outer nodes are cogrouped
by superblock, where the local tree is reduced, local and outer siblings are
joined and claimed leaves are folded up to the root.  Texts are read once, by
the JVM's SHA-256; only digests and ids are dealt.

Digests are lowercase hex; a node is the SHA-256 of its children's digests as
text.  While a level has several nodes, every two consecutive ones make one
above; a last one alone makes one too.  A proof is ``sides``, a letter for
each level from the leaf up (``l``: sibling on the left, ``r``: on the right,
``-``: none), and ``siblings``, their digests in that order.

Defined results: a null in any column is the field ``-``, so null and empty
differ; a null group is a group of its own, before all others; null ids come
first, and rows of one id are ordered by leaf, so equal rows have leaves side
by side; an empty text is a field of length 0, a text of any length is hashed
whole; an empty table gives no rows.  Only the columns of ``fields`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import ship_package, stored, table
from estuary.llm.ordered import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEIGHT = 11
NODE = "tree string, pos bigint, node string, n bigint"
PATH = "sides string, siblings string, subroot string, root string"


def field(value: Column) -> Column:
    """A value's length in bytes and its text, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(nodes: list[str], height: int) -> list[list[str]]:
    """``height`` levels above the nodes, these first."""
    out = [nodes]
    for _ in range(height):
        low = out[-1]
        out.append([digest("".join(low[i:i + 2])) for i in range(0, len(low), 2)])
    return out


def local_height(n: int, height: int) -> int:
    """Levels of a superblock in a round of ``n`` nodes."""
    return height if n > 1 << height else (n - 1).bit_length()


def local_path(tree: list[list[str]], i: int) -> tuple[str, str]:
    """Sides and siblings of node ``i`` up to the superblock's root."""
    sides, siblings = [], []
    for level in tree[:-1]:
        other = i ^ 1
        if other < len(level):
            sides.append("l" if other < i else "r")
            siblings.append(level[other])
        else:
            sides.append("-")
        i >>= 1
    return "".join(sides), "".join(siblings)


def fold(node: str, sides: str, siblings: str) -> str:
    """The root that a leaf and its proof give."""
    at = 0
    for side in sides:
        if side == "-":
            node = digest(node)
        else:
            other = siblings[at:at + 64]
            at += 64
            node = digest(other + node if side == "l" else node + other)
    return node


def climb(nodes: DataFrame, height: int = HEIGHT) -> tuple[list[DataFrame], DataFrame]:
    """The rounds' nodes (tree, pos, node, n, ...), and (tree, node, round) for the trees' roots."""
    def reduced(block: pd.DataFrame) -> pd.DataFrame:
        n = int(block["n"].iat[0])
        top = levels(block.sort_values("pos")["node"].tolist(), local_height(n, height))[-1][0]
        return pd.DataFrame({"tree": [block["tree"].iat[0]], "pos": [int(block["pos"].iat[0]) >> height],
                             "node": [top], "n": [-(-n >> height)]})

    rounds, roots = [nodes], None
    while True:
        cut = rounds[-1].select("tree", "pos", "node", "n")
        above = stored(cut.groupBy("tree", F.shiftright("pos", height).alias("block")).applyInPandas(reduced, NODE), "merkle_nodes")
        done = above.where("n = 1").select("tree", "node", F.lit(len(rounds) - 1).alias("round"))
        roots = done if roots is None else roots.unionByName(done)
        more = above.where("n > 1")
        if more.isEmpty():
            return rounds, roots
        rounds.append(more)


def joined(block: pd.DataFrame, outer: pd.DataFrame, height: int) -> pd.DataFrame:
    """A superblock's nodes with whole proofs: local siblings, then the outer ones."""
    if not len(block):  # a tree without nodes in this round has no proofs here
        return block.assign(sides=[], siblings=[], subroot=[], root=[])
    block = block.sort_values("pos")
    tree = levels(block["node"].tolist(), local_height(int(block["n"].iat[0]), height))
    up = outer.iloc[0]
    paths = [local_path(tree, i) for i in range(len(block))]
    return block.assign(sides=[s + up["sides"] for s, _ in paths], siblings=[x + up["siblings"] for _, x in paths],
                        subroot=up["subroot"], root=up["root"])


def descend(rounds: list[DataFrame], outer: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The first round's nodes with proofs, from (tree, round, sides, siblings, subroot, root) of the trees' roots.

    Where nodes have a ``claim``, ``folded_root`` is the root it leads to, or that of the node itself if it is null.
    """
    claimed = "claim" in rounds[0].columns

    def run(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        full = joined(block, above, height)
        if not claimed or "claim" not in full:
            return full.drop(columns=["block", "n"])
        folded = [fold(c or x, s, p) for c, x, s, p in zip(full["claim"], full["node"], full["sides"], full["siblings"])]
        return full.assign(folded_root=folded).drop(columns=["block", "n", "claim"])

    from_above = None
    for r in reversed(range(len(rounds))):
        here = outer.where(F.col("round") == r).select("tree", F.lit(0).cast("long").alias("block"), *PATH.replace(" string", "").split(", "))
        if from_above is not None:
            here = here.unionByName(from_above)
        nodes = rounds[r].withColumn("block", F.shiftright("pos", height))
        kept = [c for c in rounds[r].columns if c not in ("n", "claim")]
        types = dict(rounds[r].dtypes)
        schema = ", ".join([*(f"{c} {types[c]}" for c in kept), PATH] + (["folded_root string"] if claimed and r == 0 else []))
        full = nodes.groupBy("tree", "block").cogroup(here.groupBy("tree", "block")).applyInPandas(run, schema)
        if r == 0:
            return full
        from_above = stored(full.select("tree", F.col("pos").alias("block"), "sides", "siblings", "subroot", "root"), "merkle_outer")
    raise AssertionError("a tree has a round")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
             claims: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """(id, leaf, subroot, root, sides, siblings, folded_root) for every row.

    ``claims`` replaces values of some fields: ``folded_root`` is the root
    that the row with those values and the proof of the stored row lead to.
    Nothing but the stored rows enters leaves, roots and proofs.
    """
    ship_package(docs.sparkSession)
    claims = claims or {}
    values = [F.col(c) for c in fields]
    other = leaf([claims.get(c, F.col(c)) for c in fields])
    touched = F.lit(False)
    for c, value in claims.items():
        touched = touched | ~value.eqNullSafe(F.col(c))
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))  # a null sorts first
    rows = stored(docs.select(group.alias("tree"), F.col(id_col).alias("id"), leaf(values).alias("node"),
                              F.when(touched, other).alias("claim"), F.monotonically_increasing_id().alias("tie")), "merkle_leaves")
    # equal rows in any number have leaves that need no order: the tie only lets them spread over tasks
    leaves = stored(numbered(rows, "tree", ["id", "node", "tie"], "merkle_sorted").drop("tie"), "merkle_numbered")
    rounds, tops = climb(leaves, height)
    tops = stored(tops, "merkle_tops")
    subroots = stored(numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node", "round"), "tree", ["of"], "merkle_groups"),
                      "merkle_subroots")
    upper, top = climb(subroots.select("tree", "pos", "node", "n", "of", F.col("round").alias("started")), height)
    start = top.select("tree", "round", F.lit("").alias("sides"), F.lit("").alias("siblings"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    outer = stored(descend(upper, start, height).select(F.col("of").alias("tree"), F.col("started").alias("round"), "sides", "siblings",
                                                F.col("node").alias("subroot"), "root"), "merkle_outer")
    return descend(rounds, outer, height).select("id", F.col("node").alias("leaf"), "subroot", "root", "sides", "siblings", "folded_root")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = F.col("n_chars").cast("decimal(20,0)") + F.when(hit, 1).otherwise(0)
    found = manifest(docs, claims={"n_chars": more})
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda r, b: list_reduce(list_prepend(xor(r, b), CAST(range(8) AS BIGINT[])),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _row(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(n_chars if f == "n_chars" else f) for f in FIELDS) + ")"


#: Trees bottom-up by recursion; every proof is read off the levels, every claim folded along its proof.
OP11_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT *, {_CRC} % 7 = 0 AS hit FROM documents),
hashed AS (
  SELECT doc_id, lang, {_row('n_chars')} AS leaf, {_row('(CAST(n_chars AS HUGEINT) + CASE WHEN coalesce(hit, false) THEN 1 ELSE 0 END)')} AS claim
  FROM marked),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
nodes AS (
  SELECT lang, 0 AS level, pos, n, leaf AS node FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n),
subroots AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, pos, n, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM upper WHERE n > 1 GROUP BY level, pos // 2, n),
steps AS (
  SELECT l.lang, l.pos AS slot, w.level AS step, w.pos % 2 AS odd, s.node AS other
  FROM leaves l JOIN nodes w ON w.lang IS NOT DISTINCT FROM l.lang AND w.n > 1 AND w.pos = l.pos >> w.level
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = w.level AND s.pos = xor(w.pos, 1)
  UNION ALL
  SELECT l.lang, l.pos, 1000 + w.level, w.pos % 2, s.node
  FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN upper w ON w.n > 1 AND w.pos = r.pos >> w.level
  LEFT JOIN upper s ON s.level = w.level AND s.pos = xor(w.pos, 1)),
proofs AS (
  SELECT lang, slot, list({{'odd': odd, 'other': coalesce(other, '')}} ORDER BY step) AS path FROM steps GROUP BY lang, slot),
folded AS (
  SELECT l.*, r.subroot, u.node AS root, sha256(coalesce(array_to_string(list_transform(p.path, lambda x: x.other), ''), '')) AS proof_sha256,
         coalesce(list_reduce(list_prepend({{'odd': CAST(0 AS BIGINT), 'other': l.claim}}, p.path),
           lambda a, x: {{'odd': CAST(0 AS BIGINT), 'other': sha256(CASE WHEN x.odd = 1 THEN x.other || a.other ELSE a.other || x.other END)}}).other, l.claim) AS folded_root
  FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN upper u ON u.n = 1
  LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.slot = l.pos)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
