"""Operator 13: the trie of conversation prefixes, by adaptive radix trees.

A turn (role, text) becomes a 16-byte id, the leading bytes of a SHA-256, and a
conversation the string of its turns' big-endian ids.  Conversations are
put in the order of these strings and cut into blocks of ``BLOCK``; each block
builds an adaptive radix tree (nodes of 4, 16, 48 or 256 children that grow as
needed, edges that hold whole runs of bytes).  Byte depths that are
multiples of 16 are turns and give the trie's nodes, also those inside an edge.

In that order all members of a node stand side by side.  A block is handed
the last conversation before it and the first behind it, so it knows which
of its nodes go on in other blocks: those on the stretch it shares with a
neighbour.  All other nodes are finished in the block.  The shared ones, at
most two paths a block, are added up over the blocks by a digest of their
prefix, and their subtree sums are made by doubling over the ancestors.  So a
first turn in a third of all conversations, or a conversation in any number
of copies, spreads over blocks of one size.

A conversation is one row: 20 bytes a turn, whatever the texts hold.

Defined results: null role or text is empty; turns come in ascending order,
null first, equal ones by id; rows with a null conversation id belong to no
conversation and are left out; equal rows are turns of their own; negative
ids keep the sign in the remainder; an empty table gives no rows; a text of any
length is one turn; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.llm.common import ship_package, stored, table
from estuary.llm.ordered import numbered

WIDTH, BLOCK = 16, 2048
WORD = r"[^\x20\x09-\x0D]+"
NODE = ("key binary, parent binary, shared boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
        "n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, block bigint, ends string")


class Layout:
    """Children of a radix node by their first byte: 4, 16 or 48 sorted ones, then a table of 256."""

    __slots__ = ("room", "first", "kids")

    def __init__(self) -> None:
        self.room, self.first, self.kids = 4, bytearray(), []

    def get(self, byte: int) -> Node | None:
        if self.room == 256:
            return self.kids[byte]
        at = self.first.find(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, node: Node) -> None:
        """Add or replace; a full layout moves to the next size."""
        if self.room == 256:
            self.kids[byte] = node
            return
        at = self.first.find(byte)
        if at >= 0:
            self.kids[at] = node
        elif len(self.kids) < self.room:
            at = sum(b < byte for b in self.first)
            self.first.insert(at, byte)
            self.kids.insert(at, node)
        else:
            self.room = {4: 16, 16: 48, 48: 256}[self.room]
            if self.room == 256:
                wide: list = [None] * 256
                for b, kid in zip(self.first, self.kids):
                    wide[b] = kid
                self.first, self.kids = bytearray(), wide
            self.put(byte, node)

    def __iter__(self) -> Iterator[Node]:
        return (kid for kid in self.kids if kid is not None)


class Node:
    """The bytes ``[start, stop)`` of ``key``, the members below and those that end here."""

    __slots__ = ("key", "start", "stop", "layout", "member", "ends", "above", "size", "least", "children", "tops", "leaves", "saved")

    def __init__(self, key: bytes, start: int, stop: int, member: int) -> None:
        self.key, self.start, self.stop, self.member = key, start, stop, member
        self.layout: Layout | None = None
        self.ends: list[int] = []


def common(a: bytes, b: bytes, start: int, stop: int) -> int:
    """The first place from ``start`` on where a and b differ, ``stop`` at most."""
    if a[start:stop] == b[start:stop]:
        return stop
    low, high = start, stop
    while high - low > 1:
        half = (low + high) // 2
        if a[low:half] == b[low:half]:
            low = half
        else:
            high = half
    return low


def insert(root: Node, key: bytes, member: int) -> None:
    node = root
    while True:
        if len(key) == node.stop:
            node.ends.append(member)
            return
        node.layout = node.layout or Layout()
        byte = key[node.stop]
        kid = node.layout.get(byte)
        if kid is None:
            kid = Node(key, node.stop, len(key), member)
            kid.ends.append(member)
            node.layout.put(byte, kid)
            return
        split = common(key, kid.key, kid.start, min(len(key), kid.stop))
        if split < kid.stop:
            above = Node(key, kid.start, split, member)
            above.layout = Layout()
            above.layout.put(kid.key[split], kid)
            kid.start = split
            node.layout.put(byte, above)
            kid = above
        node = kid


def radix_tree(keys: list[bytes]) -> Node:
    """The tree of all keys, whose members are their places in the list."""
    root = Node(b"", 0, 0, 0)
    for member, key in enumerate(keys):
        insert(root, key, member)
    return root


def turns_of(node: Node) -> range:
    """Depths, in turns, at the turn-aligned bytes of the node's edge; the root is depth 0."""
    return range(node.start // WIDTH + 1, node.stop // WIDTH + 1) if node.stop else range(1)


def summed(root: Node, ids: list[int], words: list[list[int]]) -> list[Node]:
    """The radix nodes, parents first, with members, smallest id, turn children, leaves and saved words below."""
    order = [root]
    root.above = None
    for node in order:
        for kid in node.layout or ():
            kid.above = node if turns_of(node) else node.above
            order.append(kid)
    for node in reversed(order):
        kids = list(node.layout or ())
        node.size = len(node.ends) + sum(k.size for k in kids)
        node.least = min([ids[m] for m in node.ends] + [k.least for k in kids])
        node.children = sum(k.tops for k in kids)
        node.leaves, node.saved = sum(k.leaves for k in kids), sum(k.saved for k in kids)
        node.tops = node.children
        if turns := turns_of(node):
            node.tops, node.leaves = 1, node.leaves if node.children else 1
            node.saved += (node.size - 1) * sum(words[node.member][d - 1] for d in turns if d)
    return order


def shared_turns(a: bytes | None, b: bytes) -> int:
    """Turns that both sequences begin with; -1 without a neighbour, as the root is shared with any."""
    return -1 if a is None else common(a, b, 0, min(len(a), len(b))) // WIDTH


def prefix_keys(key: bytes, depth: int) -> list[bytes]:
    """Digests of the prefixes of 0 to ``depth`` turns."""
    running, out = sha256(), []
    for d in range(depth + 1):
        out.append(running.digest())
        running.update(key[d * WIDTH:(d + 1) * WIDTH])
    return out


def block_nodes(block: int, ids: list[int], keys: list[bytes], words: list[list[int]],
                before: bytes | None, behind: bytes | None) -> list[tuple]:
    """Rows of ``NODE`` for a block of sorted sequences between its neighbours.

    A shared node's row holds what this block knows: its own members and
    ends, and the children, leaves and savings below children that are not
    shared themselves.
    """
    sides = [(keys[0], shared_turns(before, keys[0])), (keys[-1], shared_turns(behind, keys[-1]))]
    digests = [prefix_keys(key, depth) for key, depth in sides]

    def shared(key: bytes, depth: int) -> bytes | None:
        for (edge, most), known in zip(sides, digests):
            if depth <= most and edge[:depth * WIDTH] == key[:depth * WIDTH]:
                return known[depth]
        return None

    rows, open_below = [], {}
    deepest = max(most for _, most in sides)
    for node in reversed(summed(radix_tree(keys), ids, words)):
        turns, saved = turns_of(node), node.saved
        # from the last turn of the edge up: its savings are those of the edge without the turns above it
        for d in turns:
            own = (node.size - 1) * words[node.member][d - 1] if d else 0
            children = node.children if d == turns[-1] else 1
            leaves, total, saved = node.leaves, saved, saved - own
            key = shared(node.key, d) if d <= deepest else None
            parent = shared(node.key, d - 1) if 0 < d <= deepest + 1 else None
            ends = [ids[m] for m in node.ends] if d * WIDTH == node.stop else []
            text = ",".join(map(str, ends))
            if key is None:
                up = None if not d else node.least if d > turns[0] else node.above.least
                rows.append((None, parent, False, node.least, d, up, node.size, children, leaves, total, None, block,
                             sha256(text.encode()).hexdigest()))
            else:
                rows.append((key, parent, True, node.least, d, None, node.size, children, leaves if children else 0, total - own,
                             words[node.member][d - 1] if d else 0, block, text))
                if parent is not None:
                    below = open_below.setdefault(parent, [0, 0, 0])
                    for k, x in enumerate((1, leaves, total)):
                        below[k] += x
    out = []
    for row in rows:
        if row[2] and row[0] in open_below:
            n, leaves, saved = open_below[row[0]]
            row = (*row[:7], row[7] - n, row[8] - leaves, row[9] - saved, *row[10:])
        out.append(row)
    return out


_ARROW = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("shared", pa.bool_()), *(
    (c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "block")),
    ("ends", pa.string())])


def nodes_in_blocks(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of ``NODE``, each block's own, from (conv_id, seq, words)."""
    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        edge = part.column("edge").to_pylist()
        keys, ids, words = (part.column(c).to_pylist() for c in ("seq", "conv_id", "words"))
        own = [k for k, e in enumerate(edge) if not e]
        before = next((keys[k] for k, e in enumerate(edge) if e < 0), None)
        behind = next((keys[k] for k, e in enumerate(edge) if e > 0), None)
        rows = block_nodes(part.column("block")[0].as_py(), [ids[k] for k in own], [keys[k] for k in own], [words[k] for k in own], before, behind)
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    placed = numbered(sequences.withColumn("_all", F.lit(0)), "_all", ["seq", "conv_id"], "trie_order")
    at = F.floor(F.col("pos") / block)
    first, last = F.col("pos") % block == 0, F.col("pos") % block == block - 1

    def copy(shift: int) -> Column:
        return F.struct((at + shift).alias("block"), F.lit(-shift).alias("edge"))

    copies = F.array_compact(F.array(copy(0), F.when(first & (F.col("pos") > 0), copy(-1)),
                                     F.when(last & (F.col("pos") + 1 < F.col("n")), copy(1))))
    return placed.select("pos", "conv_id", "seq", "words", F.explode(copies).alias("c")).select(
        "pos", "conv_id", "seq", "words", "c.block", "c.edge").groupBy("block").applyInArrow(run, NODE)


def ends_digests(parts: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, block, ends): the texts of a node's blocks, hashed one after another in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, sha256()
        for batch in batches:
            keys, digests = [], []
            for key, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        digests.append(state.hexdigest())
                    now, state = key, sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])

    dealt = parts.where("ends <> ''").repartition("key").sortWithinPartitions("key", "block")
    return dealt.select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, n_leaves, saved_tokens) over all nodes below (key, parent, depth, n_leaves, saved_tokens).

    Each round a node hands what it has gathered to its ancestor at twice the
    distance, so the depth of the trie takes its logarithm in rounds.
    """
    rest = nodes.select("key", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    reach, depth = 1, nodes.agg(F.max("depth")).first()[0] or 0
    while reach <= depth:
        given = rest.where("up is not null").groupBy(F.col("up").alias("to")).agg(F.sum("n_leaves").alias("more"), F.sum("saved_tokens").alias("also"))
        above = rest.select(F.col("key").alias("of"), F.col("up").alias("next"))
        grown = rest.join(given, F.col("key") == F.col("to"), "left").join(above, F.col("up") == F.col("of"), "left")
        rest = stored(grown.select("key", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("more", F.lit(0))).alias("n_leaves"),
                                   (F.col("saved_tokens") + F.coalesce("also", F.lit(0))).alias("saved_tokens")), "trie_sums")
        reach *= 2
    return rest.select("key", "n_leaves", "saved_tokens")


def prefix_trie(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node of the trie of (conv_id, seq, words), see ``sequences_of``."""
    ship_package(sequences.sparkSession)
    found = stored(nodes_in_blocks(sequences, block), "trie_nodes")
    parts = found.where("shared")
    whole = stored(parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.first("words").alias("words")), "trie_shared")
    kids = whole.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("more"))
    whole = stored(whole.join(kids, F.col("key") == F.col("of"), "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
                   .withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
                   .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).drop("of", "more", "words"), "trie_whole")
    sums = subtree_sums(whole)
    above = whole.select(F.col("key").alias("of"), F.col("conv_id").alias("up"))
    nothing = sha256(b"").hexdigest()
    shared = (whole.drop("n_leaves", "saved_tokens").join(sums, "key").join(ends_digests(parts.select("key", "block", "ends")), "key", "left")
              .join(above, F.col("parent") == F.col("of"), "left"))
    shared = shared.withColumn("parent_conv_id", F.col("up")).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    closed = found.where("not shared").withColumnRenamed("ends", "ends_sha256")
    under = closed.where("parent is not null").drop("parent_conv_id").join(above, F.col("parent") == F.col("of")).withColumnRenamed("up", "parent_conv_id")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return closed.where("parent is null").select(names).unionByName(under.select(names)).unionByName(shared.select(names))


def conversations_of(table_: DataFrame) -> DataFrame:
    """(conv_id, turns): an array of (id in hex, words) in turn order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the role's length keeps (role, text) apart from any other cut of the same letters
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    turns = table_.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("given"), "turn", digest.alias("id"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"))
    return turns.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda x: F.struct(x["id"], x["words"])).alias("turns"))


def branched(conversations: DataFrame, every: int, most: int) -> DataFrame:
    """Conversations that begin with the first turns of their group's head.

    Conversation c takes ``crc32(c) % most`` turns of conversation c - c %
    ``every`` and goes on with its own turns after as many.
    """
    own = stored(conversations, "conversations")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    heads = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most - 1).alias("head"))
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("head_id"), "left")
    start = F.slice(F.coalesce("head", F.array().cast(dict(own.dtypes)["turns"])), F.lit(1), h)
    return both.select("conv_id", F.concat(start, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def sequences_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, words): the turns' ids in one string of bytes, and their words."""
    ids = F.unhex(F.array_join(F.transform("turns", lambda x: x["id"]), ""))
    return conversations.select("conv_id", ids.alias("seq"), F.transform("turns", lambda x: x["words"]).alias("words"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(sequences_of(branched(conversations_of(table(spark, sf_dir, "conversations")), 20, 4)))


_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda r, b: list_reduce(list_prepend(xor(r, b), CAST(range(8) AS BIGINT[])),
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""

#: A node is named by its list of turns; subtrees are all prefixes' descendants.
OP13_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
         len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'t': t, 'words': words}} ORDER BY turn NULLS FIRST, t) AS ts FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(h.ts, [])[:o.h], o.ts[o.h + 1:]) AS ts
  FROM (SELECT *, {_CRC} % 4 AS h FROM own) o LEFT JOIN own h ON h.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (
  SELECT conv_id, ts, d, md5(array_to_string(list_transform(ts[:d], lambda x: x.t), '')) || d AS node,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(ts[:d - 1], lambda x: x.t), '')) || (d - 1) END AS up
  FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, up, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN ts[d].words ELSE 0 END) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(ts) = d), '')) AS ends_sha256
  FROM prefixes GROUP BY node, up, d),
kids AS (SELECT up AS node, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT p.node, sum((n.n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.d <= n.depth LEFT JOIN kids k ON k.node = n.node
  GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN nodes u ON u.node = n.up LEFT JOIN kids k ON k.node = n.node
"""
