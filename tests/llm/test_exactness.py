"""Cases that tell an exact operator 4, 6 or 9 from a nearly exact one."""

import numpy as np

from estuary.llm import fingerprints, near_dedup, toxicity
from estuary.llm.shingles import shingle_sets


def thue_morse(n):
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_of_equal_length_have_different_hashes(spark):
    one, other = thue_morse(4096)
    sets = shingle_sets([one.encode(), other.encode(), one.encode()])
    assert sets[0][0] != sets[1][0] and sets[0][0] == sets[2][0]
    docs = spark.createDataFrame([(1, one), (2, other), (3, one)], "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dedup.near_groups(docs).collect()}
    assert got == {1: (1, True), 2: (2, True), 3: (1, False)}


def test_edits_do_not_depend_on_partitions(spark):
    rows = [(k // 2, None if k % 2 else f"text number {k} " * 9) for k in range(80)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("1", "4", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        found.append(sorted(map(tuple, fingerprints.with_edits(docs).collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


def test_second_insult_counts_beside_any_number_of_spellings():
    margins = {"scum": 4.0, "toad": 3.0, "hello": -2.0}
    look = lambda w: margins[toxicity.plain(w)]
    spellings = ["scum", "Scum", "SCUM", "sCum", "scUm", "scuM", "SCum", "scum!", "scum.", "(scum)", "'scum'"]
    assert toxicity.Scorer.top(["hello", *spellings, "toad"], look) == (4.0, 3.0)
    assert toxicity.Scorer.top(["scum", "Scum"], look) == (4.0, toxicity.EMPTY_MARGIN)
    assert toxicity.Scorer.top([], look) == (toxicity.EMPTY_MARGIN, toxicity.EMPTY_MARGIN)


def naive_features(word):
    """Gapped subsequences of three characters of the marked word, each occurrence by itself."""
    w, out, square = "<" + word + ">", {}, 0.0
    for i in range(len(w)):
        for j in range(i + 1, len(w)):
            for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                gain = toxicity.DECAY ** (k - i - 2)
                out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0.0) + gain
                square += gain * gain
    return out, np.sqrt(max(square, 1e-9))


def test_kernel_equals_naive_subsequences():
    words = ["scum", "s-c-u-m".replace("-", "x"), "toad", "a", "ab", "scummyscum", "hello", "mucs"]
    marks = ["scum", "toadstool", "b"]
    got = toxicity.kernel(words, marks)
    for a, row in zip(words, got):
        for b, value in zip(marks, row):
            (fa, na), (fb, nb) = naive_features(a), naive_features(b)
            assert abs(float(value) - sum(v * fb.get(x, 0.0) for x, v in fa.items()) / (na * nb)) < 2e-3  # half precision


def test_term_counts_equal_sql(spark):
    """Telling terms against the same counts in SQL, with words that are common, rare, beside one entity and beside several."""
    import random

    import duckdb
    from pyspark.sql import functions as F

    from estuary.llm import pii
    rnd = random.Random(12)
    common, rare = [f"word{k}" for k in range(30)], [f"Name{k}" for k in range(40)]
    rows = []
    for k in range(300):
        words = [rnd.choice(common) for _ in range(12)]
        if k % 3 == 0:
            e = rnd.randrange(12)
            words += [f"user{e}@x.org", rare[e], rnd.choice(rare), "the" if e < 3 else "and"]
        elif k % 7 == 0:
            words += [rnd.choice(rare), "and"]
        rnd.shuffle(words)
        rows.append((k, " ".join(words)))
    rows += rows[:4]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = pii.found_in(docs, "doc_id", "text").cache()
    names = {r["h"]: r["w"] for r in docs.select(F.explode(F.split("text", " ")).alias("w")).select("w", F.xxhash64(F.lower("w")).alias("h")).distinct().collect()}
    got = {names[r[0]] for r in pii.telling_terms(docs, found, "text").collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE d (n BIGINT, w VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", [(n, w) for n, (_, t) in enumerate(rows) for w in set(t.split())])
    want = con.execute(f"""
      WITH e AS (SELECT n, w AS entity FROM d WHERE contains(w, '@')), t AS (SELECT n, w FROM d WHERE NOT contains(w, '@')),
      ne AS (SELECT entity, count(*) AS ne FROM e GROUP BY 1), nt AS (SELECT w, count(*) AS nt FROM t GROUP BY 1),
      both_ AS (SELECT w, entity, count(*) AS nte FROM e JOIN t USING (n) GROUP BY 1, 2)
      SELECT DISTINCT w FROM both_ JOIN ne USING (entity) JOIN nt USING (w)
      WHERE nte >= {pii.MIN_SUPPORT} AND nte >= {pii.MIN_SHARE} * nt
        AND log2(nte * {len(rows)}.0 / (nt * ne)) >= {pii.MIN_PART} * log2({len(rows)}.0 / ne)
        AND nte * log2(nte * {len(rows)}.0 / (nt * ne)) >= {pii.MIN_SUPPORT * pii.MIN_BITS}""").fetchall()
    assert got == {w for w, in want} and len(got) > 3


def test_places_of_terms_in_a_long_text(spark):
    """Megabytes of text in time that grows with its length."""
    import time

    from estuary.llm import pii
    texts = [("Quorl wrote " + "plain words " * n) + "mail q@x.org" for n in (20_000, 200_000)]
    seconds = []
    for t in texts:
        docs = spark.createDataFrame([(1, t), (2, t), *((k, "plain words mail wrote") for k in range(3, 30))], "doc_id long, text string")
        start = time.time()
        spans = {r["id"]: [tuple(s) for s in r["term"]] for r in pii.detect(docs).where("id < 3").collect()}
        seconds.append(time.time() - start)
        assert spans == {1: [(0, 5)], 2: [(0, 5)]}
    assert seconds[1] < 20 * seconds[0] + 60
