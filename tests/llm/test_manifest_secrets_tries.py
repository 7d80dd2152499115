"""Operators 11 to 13 against brute force, and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from estuary.llm import merkle, prefix_trie, secret_scan
from estuary.llm.ordered import numbered
from estuary.llm.text_spans import matches, outside, running

# ------------------------------------------------------------------ positions


def test_positions_in_a_hot_group(spark):
    rnd = random.Random(2)
    rows = [("a" if k % 3 else f"g{rnd.randrange(5)}", rnd.randrange(40) if k % 11 else None, k) for k in range(900)]
    df = spark.createDataFrame(rows, "g string, x long, id long").repartition(7)
    got = {r["id"]: (r["pos"], r["n"]) for r in numbered(df, "g", ["x", "id"], "test").collect()}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        assert [got[r[2]] for r in own] == [(k, len(own)) for k in range(len(own))]


# ------------------------------------------------------------------ manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def hash_row(row):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def brute_manifest(rows, more):
    """{row number: (leaf, subroot, root, proof, folded root)}; rows are (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[r[2]].append(k)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))

    def climb(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def path(tree, i):
        for level in tree[:-1]:
            yield i % 2, (level[i ^ 1] if i ^ 1 < len(level) else None)
            i //= 2

    trees, place = {}, {}
    for g in order:
        own = sorted(groups[g], key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, hash_row(rows[k])))
        trees[g] = climb([hash_row(rows[k]) for k in own])
        place |= {k: i for i, k in enumerate(own)}
    top = climb([trees[g][-1][0] for g in order])
    out = {}
    for k, r in enumerate(rows):
        steps = [*path(trees[r[2]], place[k]), *path(top, order.index(r[2]))]
        node = hash_row((*r[:3], r[3] + more(r[0]) if r[3] is not None else None, r[4]))
        for odd, other in steps:
            node = h(node) if other is None else h(other, node) if odd else h(node, other)
        out[k] = (hash_row(r), trees[r[2]][-1][0], top[-1][0], h(*(o for _, o in steps if o)), node)
    return out


@pytest.mark.parametrize("height", [1, 2, merkle.HEIGHT])
def test_manifest_equals_brute_force(spark, height):
    rnd = random.Random(5)
    langs = [None, "", "en", "en", "en", "é", "z"]
    rows = [(rnd.choice([None, *range(60)]) if k % 5 else k, rnd.choice([None, "web"]), langs[k % 7] if k % 3 else "en",
             rnd.choice([None, 7, 2 ** 63 - 1]), rnd.choice([None, "", "a:b", "ü" * 9, "long " * 3000])) for k in range(83)]
    rows += rows[:9]  # repeated rows
    hit = lambda i: int(i is not None and zlib.crc32(str(i).encode()) % 7 == 0)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, node string, pos int, claim string")
    more = F.col("n_chars").cast("decimal(20,0)") + F.when(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False)), 1).otherwise(0)
    found = merkle.manifest(df.repartition(5), claims={"n_chars": more}, height=height)
    got = Counter(tuple(r) for r in found.select("id", "leaf", "subroot", "root", F.sha2("siblings", 256), "folded_root").collect())
    assert got == Counter((rows[k][0], *v) for k, v in brute_manifest(rows, hit).items())
    for r in found.limit(20).collect():
        assert r["root"] == merkle.fold(r["leaf"], r["sides"], r["siblings"])


def test_manifest_of_one_row_and_of_none(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = merkle.manifest(spark.createDataFrame([(7, None, None, None, None)], schema)).collect()
    leaf = h("1:7", "-", "-", "-", "-")
    assert [tuple(r) for r in one] == [(7, leaf, leaf, leaf, "", "", leaf)]
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0


# ------------------------------------------------------------------ spans

def test_running_values_of_long_arrays(spark):
    rnd = random.Random(3)
    for n in (0, 1, 64, 65, 4097, 20000):
        xs = [rnd.randrange(-9, 9) for _ in range(n)]
        row = spark.createDataFrame([(xs,)], "x array<int>").select(
            running(F.col("x"), lambda a, x: a + x, 0).alias("s"), running(F.col("x"), F.greatest, -100).alias("m")).first()
        total, most = 0, -100
        for x, s, m in zip(xs, row["s"], row["m"], strict=True):
            total, most = total + x, max(most, x)
            assert (s, m) == (total, most)


def test_spans_and_overlaps(spark):
    rnd = random.Random(4)
    texts = ["", "aa", *("".join(rnd.choice("ab 1é\U0001f600") for _ in range(rnd.randrange(200))) for _ in range(60)), "ab1 " * 30000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(matches(F.col("t"), "[ab]++").alias("x"), matches(F.col("t"), "b[1 ]").alias("y"))
    for t, r in zip(texts, df.select("x", "y", outside(F.col("x"), F.col("y")).alias("z")).collect()):
        spans = lambda p: [(m.start(), m.end(), m.group()) for m in re.finditer(p, t)]
        assert [tuple(a) for a in r["x"]] == spans("[ab]+")
        cuts = spans("b[1 ]")
        if len(t) < 1000:
            assert [tuple(a) for a in r["z"]] == [a for a in spans("[ab]+") if not any(a[0] < e and s < a[1] for s, e, _ in cuts)]
        else:
            assert r["z"] == []


# ------------------------------------------------------------------ secrets

BASE = {"assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile("[0-9a-f]+"), 0, 24)}
RUN = "[A-Za-z0-9+/_.=-]"


def base_of(text):
    return [(k, m.start(), m.end(), m.group(g)) for k, (p, g, least) in BASE.items() for m in p.finditer(text) if len(m.group(g)) >= least]


def free_runs(text, least, base):
    return [(m.start(), m.end(), m.group()) for m in re.finditer(f"{RUN}{{{least},}}", text)
            if not any(m.start() < e and s < m.end() for _, s, e, _ in base)]


def brute_secrets(texts):
    counts = {True: Counter(), False: Counter()}
    for t in texts:
        base = base_of(t)
        for label, runs in ((True, [v for *_, v in base]), (False, [v for *_, v in free_runs(t, secret_scan.MIN_SAMPLE, base) if len(v) < secret_scan.MIN_RUN])):
            for run in runs:
                counts[label].update(zip("\0" + run, run))
    totals, alone = ({label: Counter() for label in counts} for _ in range(2))
    for label, c in counts.items():
        for (a, b), n in c.items():
            totals[label][a] += n
            alone[label][b] += n
    size, prior = len(secret_scan.SYMBOLS), secret_scan.PRIOR

    def bits(run):
        out = 0.0
        for a, b in zip("\0" + run, run):
            p, q = ((counts[x][a, b] + prior * ((alone[x][b] + 1) / (alone[x].total() + size))) / (totals[x][a] + prior) for x in (True, False))
            out += math.log2(p) - math.log2(q)
        return out

    return [(base_of(t), [(s, e) for s, e, v in free_runs(t, secret_scan.MIN_RUN, base_of(t)) if bits(v) >= secret_scan.MIN_BITS]) for t in texts]


def secret_texts():
    rnd = random.Random(11)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randrange(3, 20))) for _ in range(300)]
    key = lambda n, a="0123456789abcdefABCDEFGHIJKLMNOPQRSTUVWXYZ+/": "".join(rnd.choice(a) for _ in range(n))
    out = [None, "", "password:", "token = '", "TOKEN==x PassWord=a1b2c3", "api_key\"  :  \"Zz9+/_.=-x", "apikey=12345 secret=password=abcdef",
           "AKIA" + "A" * 15, "AKIA" + "B2" * 20 + "akia", "f" * 23 + " " + "0a" * 12, "é" + "ab" * 12 + "é", "-" * 40 + " ......................"]
    for k in range(400):
        t = " ".join(rnd.choice(words) for _ in range(rnd.randrange(4, 60)))
        if k % 4 == 0:
            t += rnd.choice([" password: ", " token='", ' "api_key": "', " Secret = "]) + key(rnd.choice([4, 6, 20, 40]))
        if k % 5 == 0:
            t = key(32, "0123456789abcdef") + "\n" + t
        if k % 7 == 0:
            t += "  " + key(rnd.choice([12, 24, 48])) + ", end"
        out.append(t)
    return [*out, out[-1], "verylongwords " * 3000 + key(30000)]


def test_secrets_equal_brute_force(spark):
    texts = secret_texts()
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, t string, assign int").repartition(3)
    found = secret_scan.detect(df, secret_scan.train(secret_scan.labelled_samples(df)))
    got = {r["id"]: r for r in found.select("*", secret_scan.written(*secret_scan.KINDS, "markov").alias("all")).collect()}
    want = brute_secrets([t or "" for t in texts])
    caught = 0
    for k, (base, extra) in enumerate(want):
        for kind in secret_scan.KINDS:
            assert [tuple(s) for s in got[k][kind]] == [(s, e) for n, s, e, _ in base if n == kind], (k, kind)
        assert [tuple(s) for s in got[k]["markov"]] == extra, k
        order = (*secret_scan.KINDS, "markov")
        spans = sorted([(s, order.index(n), e) for n, s, e, _ in base] + [(s, 3, e) for s, e in extra])
        assert got[k]["all"] == ",".join(f"{order[n]}:{s}:{e}" for s, n, e in spans)
        caught += len(extra)
    assert caught > 20  # bare keys that no pattern finds


def test_bare_keys_are_told_from_words(spark):
    """Held-out: random strings that no pattern finds, against identifiers, both unseen in training."""
    rnd = random.Random(8)
    parts = ["user", "account", "profile", "handler", "index", "value", "request", "config", "stream", "writer", "buffer", "session"]
    name = lambda least=3: rnd.choice(["_", "-", ".", "/"]).join(rnd.choice(parts) for _ in range(rnd.randrange(least, 2 * least)))
    key = lambda: "".join(rnd.choice(secret_scan.SYMBOLS[:62]) for _ in range(rnd.randrange(24, 40)))
    train = spark.createDataFrame([(f"{name(1)} {name(2)} token={key()} {name(2)}",) for _ in range(400)], "text string")
    model = secret_scan.train(secret_scan.labelled_samples(train))
    df = spark.createDataFrame([(k, f"see {name() if k % 2 else key()} there") for k in range(400)], "doc_id long, text string")
    found = {r["id"]: len(r["markov"]) for r in secret_scan.detect(df, model).collect()}
    assert sum(found[k] for k in range(0, 400, 2)) >= 196 and sum(found[k] for k in range(1, 400, 2)) <= 4


def test_secrets_of_no_row_and_without_samples(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = secret_scan.train(secret_scan.labelled_samples(empty))
    assert set(model) == {0.0} and secret_scan.detect(empty, model).count() == 0


# ------------------------------------------------------------------ tries

def brute_trie(sequences):
    """Rows of the trie of {conv_id: [(turn id, words), ...]}."""
    nodes = defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            nodes[tuple(seq[:d])].append(c)
    kids = defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
    out = []

    def sums(p):
        own = (len(nodes[p]) - 1) * (p[-1][1] if p else 0)
        below = [sums(k) for k in kids[p]]
        leaves, saved = sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)
        ends = ",".join(str(c) for c in sorted(nodes[p]) if len(sequences[c]) == len(p))
        out.append((min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if sequences:
        sums(())
    return sorted(out, key=lambda r: r[:2])


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=lambda r: r[:2])


def random_conversations(n, seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(-30, n):
        turns = rnd.choice([1, 2, 2, 3, 5, 30]) if c % 3 else 4
        for t in range(turns):
            said = (rnd.choice([None, "user", "a"]), rnd.choice([None, "", "hi there", "x  y\tz", "ok"])) if c % 3 else ("system", f"turn {t}")
            rows.append((c, None if t == 1 and c % 4 == 0 else t * 2, *said))
    return rows + [(None, 0, "user", "of no one"), *rows[:5]]


def brute_sequences(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            word = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            turns[c].append((t is not None, t or 0, word, len(re.findall(r"[^\x20\x09-\x0D]+", text))))
    return {c: [x[2:] for x in sorted(ts)] for c, ts in turns.items()}


@pytest.mark.parametrize("block", [1, 3, prefix_trie.BLOCK])
def test_trie_equals_brute_force(spark, block):
    rows = random_conversations(120, 6)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, seq string, words int").repartition(4)
    whole = brute_sequences(rows)
    got = prefix_trie.prefix_trie(prefix_trie.sequences_of(prefix_trie.conversations_of(df)), block)
    assert trie_rows(got) == brute_trie(whole)
    crc = lambda c: zlib.crc32(str(c).encode()) % 4
    head = lambda c: c - int(math.fmod(c, 20))
    rebuilt = {c: whole.get(head(c), [])[:crc(c)] + s[crc(c):] for c, s in whole.items()}
    assert [] in rebuilt.values() or any(len(s) < len(whole[c]) for c, s in rebuilt.items())
    got = prefix_trie.prefix_trie(prefix_trie.sequences_of(prefix_trie.branched(prefix_trie.conversations_of(df), 20, 4)), block)
    assert trie_rows(got) == brute_trie(rebuilt)


def test_trie_of_nothing_of_one_and_of_turnless(spark):
    schema = "conv_id long, turns array<struct<id:string,words:int>>"
    trie = lambda rows: prefix_trie.prefix_trie(prefix_trie.sequences_of(spark.createDataFrame(rows, schema)))
    assert trie([]).count() == 0
    ends = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert trie_rows(trie([(9, []), (4, [])])) == [(4, 0, None, 2, 0, 1, 0, ends("4,9"))]


def test_radix_tree_grows_through_all_layouts():
    keys = sorted(bytes([a]) + bytes(15) + (bytes([b]) * 16 if b else b"") for a in range(256) for b in (0, 7))
    root = prefix_trie.radix_tree(keys)
    assert root.layout.room == 256 and sum(1 for _ in root.layout) == 256
    four = prefix_trie.radix_tree([bytes([a]) * 16 for a in range(17)])
    assert four.layout.room == 48 and [k.key[0] for k in four.layout] == list(range(17))
    path = prefix_trie.radix_tree([bytes(160)])  # one edge over ten turns
    assert [list(prefix_trie.turns_of(k)) for k in path.layout] == [list(range(1, 11))]


def test_turn_ids_that_share_leading_bytes(spark):
    ids = ["00" * 15 + f"{k:02x}" for k in range(40)] + ["01" + "00" * 15]
    rnd = random.Random(7)
    seqs = {c: [(rnd.choice(ids), 2) for _ in range(rnd.randrange(4))] for c in range(200)}
    seqs = {c: [(i, ids.index(i)) for i, _ in s] for c, s in seqs.items()}
    df = spark.createDataFrame([(c, [(i, w) for i, w in s]) for c, s in seqs.items()], "conv_id long, turns array<struct<id:string,words:int>>")
    assert trie_rows(prefix_trie.prefix_trie(prefix_trie.sequences_of(df), 16)) == brute_trie(seqs)
