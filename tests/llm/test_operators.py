"""The operators against brute force, and on odd inputs.

Odd inputs: nulls in any column, empty and long texts, ties and repeated
rows, empty tables, and further columns with clashing names.
"""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from estuary.llm import bpe, fingerprints, licenses, near_dedup, neighbours, packing, pii, suffix_dedup, token_output, toxicity
from estuary.llm.common import scratch_path, stored
from estuary.llm.graphs import components
from estuary.llm.shingles import shingle_sets

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [(None, None), (None, "mail a@b.cc now"), (None, "mail a@b.cc now"), (1, ""), (1, ""), (2, None), (3, "a b c"), (3, "a b c"),
       (4, "long word " * 4000), (5, "x" * 9000), (6, "é漢\U0001f600 \n\n  end "), (7, "<|endoftext|> I'll go"), (8, "a b c")]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns named like the operators' own."""
    rows = [(*r, "k", 1, [1], 2.0) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, rid int, _spans array<int>, score double").repartition(3)


@pytest.fixture(scope="module")
def mixed(spark):
    """Copies, near copies, shared passages, repeated stretches and loners."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(3, 160))) for _ in range(30)]
    rows = []
    for i in range(150):
        w = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 9])):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        text = " ".join(w)
        if i % 7 == 0:
            text = base[0] + " " + text.upper()
        if i % 11 == 0:
            text = "ab" * rnd.randrange(20, 200)
        rows.append((i * 13 % 151, text))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows


def by_id(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def brute_components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


# ---------------------------------------------------------------- tokens, BPE

def samples():
    rnd = random.Random(9)
    alphabet = list("ab eE'st  \n\t\x1c\u0107\u00e9\u00df\u00a0\u3000\u6f2212!.-\U0001f600\u03a3\u03c2\x85\u0130") + [
        "<|endoftext|>", "'ll", " the", "<|startoftext|>"]
    return ["", "   ", "aaaaaaaaa", *("".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(1500))]


def test_numpy_bpe_equals_library():
    own, library = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    texts = samples()
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in bpe.worker_bpe(BYTE)[1].encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [own.decode(np.array(i, dtype=np.int64)).decode() for i in got] == [library.decode(i, skip_special_tokens=False) for i in got] == texts


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_equal_whole_texts(path):
    from estuary.llm.encoding import library_encoder

    texts = samples()
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in library_encoder(path).encode(texts)]
    assert got == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_new_words_are_encoded_together(path, monkeypatch):
    from estuary.llm import encoding

    rnd = random.Random(5)
    words = ["".join(rnd.choice("etaoinshrdluEA\u00e9\u00df\u00c4") for _ in range(rnd.randrange(1, 12))) for _ in range(800)]
    texts = [" ".join(words), ", ".join(words) + ".", " ".join(w + rnd.choice(["!", "###", "&&&.", ");", "'s", "\u0301,"]) for w in words[:99]),
             "\n".join(words[:99]) + "\n", "a\n\n\nb,\n c\td.\r\ne\n", "\nfoo\n-bar:\nfoo<|endoftext|>, x,<|endoftext|>\ny\u0130, \u00b5."]
    monkeypatch.setattr(encoding, "_LIBRARY", {})
    encoder = encoding.library_encoder(path)
    new, alone = encoder.encode_new.__self__, []
    singly = new._singly
    monkeypatch.setattr(new, "_singly", lambda pieces: (alone.extend(pieces), singly(pieces))[1])
    assert encoder.encode(texts[:1]) and len(alone) < 10
    assert encoder.encode(texts[:2]) and len(alone) < 10  # the words with commas hold known words
    monkeypatch.setattr(encoding, "MAX_PIECES", 300)
    monkeypatch.setattr(encoding, "MAX_MARKS", 2)
    library = Tokenizer.from_file(path)
    for some in (texts, *([x] for x in texts), texts):
        got = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode(some)]
        assert got == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_are_looked_up_once_a_slice(path):
    from estuary.llm.encoding import library_encoder

    class Counted(dict):
        asked = 0

        def get(self, key):
            Counted.asked += 1
            return super().get(key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    encoder = library_encoder(path)
    encoder.rests = Counted(encoder.rests)
    texts = ["the cat, the dog\n" + "and the mouse " * 2000] * 9 + ["a\0b \0 the cat\0", "\0", " "]
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode(texts)]
    assert got == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert Counted.asked < 100
    encoder.rests = dict(encoder.rests)
    assert encoder.encode([]) == []


def test_token_files(spark, odd):
    path = scratch_path(spark, "test")
    token_output.write_token_files(odd, path, WORD)
    rows = sorted(token_output.with_crc(token_output.read_token_files(spark, path)).collect(), key=lambda r: r.start)
    library, at = Tokenizer.from_file(WORD), 0
    ordered = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for row, (doc_id, text) in zip(rows, ordered, strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    few = token_output.read_token_files(spark, path).where("doc_id = 4").select("doc_id", "n_tokens")
    assert few.count() == 1


def test_bpe_round_trip(odd):
    rows = bpe.decode(bpe.encode(odd, BYTE), BYTE).collect()
    assert sorted((r.doc_id or 0, r.text) for r in rows) == sorted((d or 0, t or "") for d, t in ODD)
    assert bpe.coded(odd.where("false"), BYTE, bpe.DIGESTS).count() == 0


# ---------------------------------------------------------------- packing

@pytest.mark.parametrize("bins", [1, 2, 5, 300, 1024])
def test_plan_places_every_id_once(bins):
    rnd = random.Random(bins)
    histogram = np.zeros(1025, dtype=np.int64)
    for _ in range(bins):
        histogram[rnd.randrange(1, 1025)] += rnd.choice([1, 2, 1000, 100000])
    plan = packing.make_plan(histogram, 1024)
    records = plan.index()[3]
    total = int((histogram * np.arange(1025)).sum())
    assert (records[:, 2] * records[:, 4]).sum() == total
    assert plan.sequences == -(-total // 1024)  # at most the last is not full


def test_packing_covers_documents(odd):
    rows = packing.pack(odd, BYTE, window=64).collect()
    library = Tokenizer.from_file(BYTE)
    want = defaultdict(int)
    for _, text in ODD:
        for k, token in enumerate([*library.encode(text or "", add_special_tokens=False).ids, 0]):
            want[k, token] += 1
    got, places = defaultdict(int), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length
        places[r.sequence_id].append((r.offset, r.length))
        for k, token in enumerate(ids):
            got[r.start + k, token] += 1
    assert got == want
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(odd.where("false"), BYTE).count() == 0


# ---------------------------------------------------------------- near duplicates

def test_near_groups_equal_brute_force(mixed):
    frame, rows = mixed

    def shingles(text):
        w = [x for x in re.split(r"[ \t-\r]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if x]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    label = brute_components(ids, links)
    assert any(len(sets[a] ^ sets[b]) for a, b in links)
    assert by_id(near_dedup.near_groups(frame), "doc_id", "n_shingles", "component_id", "kept") == [
        (d, len(sets[d]), label[d], label[d] == d) for d in ids]


def test_near_groups_odd(odd):
    rows = near_dedup.near_groups(odd).collect()
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.n_shingles, (r.component_id is not None, r.component_id or 0), r.kept) for r in rows)
    assert len(got) == len(ODD)
    one = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert one[8].component_id == 3 and not one[8].kept and one[3].kept
    assert one[1].n_shingles == 0 and one[1].component_id == 1 and one[2].kept
    assert all(r.kept for r in rows if r.doc_id is None)
    assert near_dedup.near_groups(odd.where("false")).count() == 0


def test_cells_compare_every_pair(spark):
    """A block larger than a cell: each pair of members meets in one unit."""
    blocks = spark.range(50).select(F.lit(0).cast("long").alias("component"), F.col("id").alias("node"))
    met = defaultdict(int)
    units = defaultdict(list)
    for r in near_dedup.cells(blocks, cell=8).collect():
        units[r.block, r.lo, r.hi].append(r)
    for (_, lo, hi), members in units.items():
        for a in members:
            for b in members:
                if a.node < b.node and (lo == hi or a.own != b.own):
                    met[a.node, b.node] += 1
    assert set(met) == {(a, b) for a in range(50) for b in range(a + 1, 50)} and set(met.values()) == {1}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(300, 300 + i) for i in range(1, 50)] + [(900, 901), (901, 900), (902, 902)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = brute_components({x for e in links for x in e if e[0] != e[1]}, links[:-1])
    assert got == want


@pytest.mark.parametrize("few", [0, 60])
def test_components_by_rounds_and_at_once(spark, monkeypatch, few):
    from estuary.llm import graphs

    at_once = []
    monkeypatch.setattr(graphs, "FEW", few)
    monkeypatch.setattr(graphs, "stored", lambda df, name: (at_once.append("MapInArrow" in df._jdf.queryExecution().toString()), stored(df, name))[1])
    links = [(i, i + 1) for i in range(200)] + [(300 + i, 300) for i in range(1, 50)] + [(900, 901), (901, 900), (902, 902)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == brute_components({x for e in links for x in e if e[0] != e[1]}, links[:-1])
    assert sum(at_once) == (few > 0)
    assert components(spark.createDataFrame([(3, 3)], "u long, v long")).collect() == []


def test_shingle_sets_short_and_empty():
    a, b, c, d, e = shingle_sets([b"One two", b"one  TWO\n", b"", b"one two three four five", b" \t "])
    assert a.tolist() == b.tolist() and len(a) == 1 and len(c) == 0 and len(d) == 1 and len(e) == 0


# ---------------------------------------------------------------- repeated strings

def brute_repeats(rows, length=100):
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        data = text.encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - length + 1):
            if data[i:i + length] in seen:
                gone[i:i + length] = True
            else:
                seen.add(data[i:i + length])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), runs, np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()))
    return out


def test_repeats_equal_brute_force(mixed):
    frame, rows = mixed
    got = by_id(suffix_dedup.without_repeats(frame).withColumn("kept", F.col("kept").cast("binary")), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    want = brute_repeats(rows)
    assert sum(r[2] for r in want) > 1000
    assert [(*r[:4], bytes(r[4])) for r in got] == want


@pytest.mark.parametrize("seed", range(2))
def test_repeats_in_small_alphabets(spark, seed):
    rnd = random.Random(seed)
    base = "".join(rnd.choice("abcé\n") for _ in range(900))
    rows = []
    for d in range(60):
        a = rnd.randrange(700)
        rows.append((d, rnd.choice([base[a:a + rnd.randrange(50, 300)], "ab" * rnd.randrange(30, 200),
                                    "".join(rnd.choice("ab") for _ in range(90)) * 3, base[:300].replace("b", "c", 2)])))
    got = by_id(suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)), "doc_id", "n_removed", "n_spans")
    assert got == [(r[0], r[2], r[3]) for r in brute_repeats(rows)]


def test_repeats_odd(odd):
    out = suffix_dedup.without_repeats(odd)
    assert out.columns == [*odd.columns, "n_bytes", "n_removed", "n_spans", "kept_"]
    rows = out.collect()
    assert len(rows) == len(ODD)
    assert {r.n_removed for r in rows if r.doc_id == 5} == {8999}  # every string but the first starts earlier too
    assert all(r.n_bytes == len((r.text or "").encode()) for r in rows)
    cut = suffix_dedup.cut_texts(odd).collect()
    assert [r.text for r in cut if r.doc_id == 2] == [None]
    assert suffix_dedup.without_repeats(odd.where("false")).count() == 0


# ---------------------------------------------------------------- personal data

REGEX = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(text):
    def fits(kind, v):
        d = re.sub("[^0-9]", "", v)
        if kind == "ip":
            return all(int(x) <= 255 for x in v.split("."))
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            return 13 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
        return kind != "phone" or 9 <= len(d) <= 15

    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if fits(k, m.group())] for k, p in REGEX.items()}


def test_base_spans_equal_regex(spark):
    rnd = random.Random(2)
    parts = ["a", "b.c", "@", "x@y.z", "_", "1", "12", "255", "256", ".", "-", " ", "+", "(", "4111 1111-11111111", "5500000000000004",
             "+1 (555) 123-4567", "é", "\U0001f600", "10.0.0.1", "00", "\n"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(40)))) for i in range(800)]
    rows += [(5000, "a@b." + "c." * 20000), (5001, "1" * 50000), (5002, "+1" + "(" * 50000), (5003, "a" * 90000 + "@"), (5004, "1-" * 30000 + "9")]
    found = pii.detect(spark.createDataFrame(rows, "doc_id long, text string"))
    for r, (_, text) in zip(sorted(found.collect(), key=lambda r: r.id), rows, strict=True):
        want = brute_pii(text)
        assert {k: [tuple(x) for x in r[k]] for k in pii.KINDS} == want, text[:80]


def test_disclosing_terms(spark):
    rows = [(i, f"call Zebulon today at z.ebulon@mail.org number {i}x") for i in range(3)] + [(10 + i, f"today nothing of note at number {i}") for i in range(40)]
    out = pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).where("size(email) > 0").collect()
    assert len(out) == 3 and all([rows[0][1][s:e] for s, e in r.term] == ["call", "Zebulon"] for r in out if r.id == 0)
    texts = [r.text for r in pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id = 0").collect()]
    assert texts == ["[TERM] [TERM] today at [EMAIL] number 0x"]


def terms_by_id(spark, rows):
    text = dict(rows)
    out = pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.id: [text[r.id][s:e] for s, e in r.term] for r in out}


def test_disclosing_terms_far_off_and_alone(spark):
    """A term 2,000 words from its entity counts, and is found where the entity is not."""
    far = "plain words here " * 700
    rows = [(i, f"Zebulon wrote. {far} mail q@x.org") for i in range(3)] + [(3, f"{far} q@x.org {far} zebulon"), (4, "ask Zebulon, or zebulon again")]
    rows += [(10 + i, "ask plain words here wrote mail again or") for i in range(60)]
    got = terms_by_id(spark, rows)
    assert all("Zebulon" in got[i] for i in range(3)) and got[3] == ["zebulon"] and got[4] == ["Zebulon", "zebulon"]
    assert all(not got[10 + i] for i in range(60))


def test_disclosing_terms_of_any_length(spark):
    rows = [(i, f"{name} at {address}") for i, (name, address) in enumerate(
        [("Ann", "a1@x.org"), ("Li", "b1@y.org"), ("\u91d1\u79c0", "c1@z.org"), ("7734ab", "d1@v.org")] * 2)]
    got = terms_by_id(spark, rows + [(100 + i, "nothing of note") for i in range(60)])
    assert [got[i] for i in range(8)] == [["Ann"], ["Li"], ["\u91d1\u79c0"], ["7734ab"]] * 2


def test_disclosing_terms_of_a_hot_entity(spark):
    """An entity in a third of the rows: a term beside it alone is found, a word spread evenly is not."""
    rows = [(i, f"{'Quorl' if i < 8 else 'and'} sent {'even' if i % 2 else 'odd'} mail x@y.org") for i in range(20)]
    rows += [(100 + i, f"sent and {'even' if i % 2 else 'odd'} mail") for i in range(40)]
    got = terms_by_id(spark, rows)
    assert all(got[i] == (["Quorl"] if i < 8 else []) for i in range(20)) and not any(got[100 + i] for i in range(40))


def test_pii_odd(odd):
    rows = pii.sanitised(odd).collect()
    assert len(rows) == len(ODD) and [r.text for r in rows if r.doc_id == 2] == [None]
    assert sum("[EMAIL]" in (r.text or "") for r in rows) == 2
    assert pii.sanitised(odd).columns == odd.columns
    assert pii.detect(odd.where("false")).count() == 0


# ---------------------------------------------------------------- fingerprints

def test_prefix_hashes_answer_spans():
    texts = ["abcabcabd", "", "xabcabcq"]
    h = fingerprints.PrefixHashes(texts)
    at = lambda k, i: np.array([h.starts[k] + i])
    assert h.span(at(0, 0), at(0, 3)) == h.span(at(2, 4), at(2, 7))
    assert h.common_extension(at(0, 0), at(0, 3), np.array([6])).tolist() == [5]
    assert h.common_extension(at(0, 0), at(2, 1), np.array([7])).tolist() == [6]


def test_edits_equal_brute_force(mixed, odd):
    frame, rows = mixed
    ordered = sorted(rows, reverse=True)
    after = [t for _, t in ordered[1:]] + [ordered[0][1]]
    want = sorted((d, len(t), hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest()) for (d, t), n in zip(ordered, after))
    out = fingerprints.with_edits(frame)
    assert by_id(out, "doc_id", "n_chars", "edited_sha256") == want
    text = dict(rows)
    prints = defaultdict(set)
    for r in out.collect():
        prints[text[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_next <= 1 and (r.fingerprint != r.edited_fingerprint or r.near_edited == 1)
    assert all(len(p) == 1 for p in prints.values()) and len({p for s in prints.values() for p in s}) == len(prints)
    assert fingerprints.with_edits(odd).count() == len(ODD)
    assert fingerprints.with_edits(odd.where("false")).count() == 0
    alone = fingerprints.with_edits(odd.where("doc_id = 5")).collect()
    assert [(r.near_edited, r.near_next) for r in alone] == [(1.0, 1.0)]


# ---------------------------------------------------------------- licences

def test_licences_equal_exact_containment(spark, odd):
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        t = rnd.choice(licenses.TEMPLATES)[1].split()
        if rnd.random() < 0.7 and len(t) > 12:
            t[rnd.randrange(len(t))] = "zz"
        w = [rnd.choice("abcdefgh") for _ in range(rnd.randrange(60))]
        j = rnd.randrange(len(w) + 1)
        rows.append((i, " ".join(w[:j] + t + w[j:])))

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    known = [(k, shingles(t)) for k, (_, t) in enumerate(licenses.TEMPLATES)]
    want = sorted((i, k, len(s), len(s & shingles(t))) for i, t in rows for k, s in known if len(s & shingles(t)) >= 0.8 * len(s))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(licenses.scan(frame), "doc_id", "template", "n_template", "n_found") == want
    assert licenses.scan(odd).count() == 0 and licenses.scan(odd.where("false")).count() == 0


PUBLISHED = [
    ("""MIT License\n\nCopyright (c) 2021 Jane Doe\n\nPermission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including""", {"MIT"}),
    ("""Copyright 2020 The Authors\n\nLicensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in
compliance with the License.\nYou may obtain a copy of the License at""", {"Apache-2.0"}),
    ("""This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.""", {"GPL-3.0"}),
    ("""This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.""", {"GPL-2.0"}),
    ("""This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.""", {"LGPL-2.1"}),
    ("""it under the terms of the GNU Affero General Public License as\npublished by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.""", {"AGPL-3.0"}),
    ("Some prose of no matter. Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
    ("This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy", {"CC-BY-SA-4.0"}),
    ("""Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that
the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES\nWHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF\nOR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""", {"ISC"}),
    ("A public license of the general kind, version 3, was never granted to any person.", set()),
]


def test_published_licences(spark):
    """Published notices in their own lines; and a body found within other prose, by its own number."""
    bodies = [k for k in range(len(licenses.TEMPLATES)) if len(licenses.TEMPLATES[k][1]) > 5000]
    rows = [(i, t) for i, (t, _) in enumerate(PUBLISHED)] + [(1000 + k, "before it " * 40 + licenses.TEMPLATES[k][1] + " after it" * 40) for k in bodies]
    found, numbers = defaultdict(set), defaultdict(set)
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r.doc_id].add(r.license)
        numbers[r.doc_id].add(r.template)
    assert [found[i] for i in range(len(PUBLISHED))] == [want for _, want in PUBLISHED]
    assert {licenses.TEMPLATES[k][0] for k in bodies} >= {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0"}
    assert all(k in numbers[1000 + k] for k in bodies)


# ---------------------------------------------------------------- nearest neighbours

def test_neighbours_recall_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16))
    x[700:1100] = x[700]  # one vector in 400 copies
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(3000, None), (3001, [0.0] * 16), (3020, [float("nan")] * 16), (3040, [None] * 16), (3060, [1.0]), (None, rows[0][1]), (0, rows[0][1])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for r in sorted(neighbours.nearest(frame, frame.where("vec_id % 20 = 0")).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for q in range(0, 1500, 20):
        score = [sum(a * b for a, b in zip(x[q], y)) for y in x]
        best = sorted((i for i in range(1500) if i != q), key=lambda i: (-score[i], i))[:20]
        assert len(got[q]) == 20 and all(abs(s - score[i]) < 1e-12 for i, s in got[q])
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
        hits, total = hits + len(set(best) & {i for i, _ in got[q]}), total + 20
    assert hits / total >= 0.9 and set(got) == set(range(0, 1500, 20))
    assert neighbours.nearest(frame.where("false"), frame).count() == 0


# ---------------------------------------------------------------- toxicity

def test_toxicity_tolerates_inserted_characters():
    rnd = random.Random(3)
    syllables = ["th", "er", "on", "an", "re", "in", "ed", "es", "or", "ti"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 4)))
    text = lambda bad: " ".join([word() for _ in range(60)] + bad) + "."
    texts = [text([]) for _ in range(120)] + [text([rnd.choice(["blockhead", "numpty", "wazzock"])]) for _ in range(60)]
    model = toxicity.fit(texts, [0] * 120 + [1] * 60)
    scorer = toxicity.Scorer(model)
    clean = scorer.scores([text([]) for _ in range(60)])
    bad = scorer.scores([text([w]) for w in ["BLOCKHEAD!!", "bl-ockhead", "blockkhead", "numpty", "wazz.ock", "w a z z o c k"] * 5])
    assert (clean < toxicity.THRESHOLD).mean() > 0.95 and (bad >= toxicity.THRESHOLD).mean() > 0.8
    assert scorer.scores(["", "   "]).max() < 0.1


def test_toxicity_trains_outside_the_driver(spark, monkeypatch):
    import os

    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: (os.getpid(), texts, labels))
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9)] + [(3, "text 3"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, toxic int")
    pid, texts, known = toxicity.train(docs, labels)
    learned = [i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert pid != os.getpid() and texts == [f"text {i}" for i in learned] and known == [i % 2 for i in learned]


def test_toxicity_odd(spark, odd):
    labels = spark.createDataFrame([(4, 0), (4, None), (5, 1), (None, 1), (77, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    rows = toxicity.score_documents(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert toxicity.train(odd, labels.where("false")) is None
    assert {r.score for r in toxicity.score_documents(odd, None).collect()} == {0.0}
    assert toxicity.keep_clean(odd, None).count() == len(ODD)
