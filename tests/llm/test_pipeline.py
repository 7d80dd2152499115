"""The pipeline's stages on the given documents and on odd ones."""

import corpus_pipeline
from estuary.llm import near_dedup, packing
from estuary.llm.common import stored

SF = "/root/testdata/sf0.001"
ROWS = [(None, None), (1, ""), (1, ""), (2, "a b c d e f g " * 30), (3, "a b c d e f g " * 30), (None, "mail me at a@b.cc"),
        (None, "mail me at a@b.cc"), (4, "\u00e9" * 500), (5, "\u00e9" * 500 + "x"), (6, "word " * 40000)]


def through(spark, docs):
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stored(stage(spark, docs, SF), name)
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    return sizes, docs


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "personal_data", "packing"]


def test_odd_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(*r, "z", 1, 2.0, "h") for r in ROWS], "doc_id long, text string, kept string, rid int, _spans double, h string")
    sizes, packed = through(spark, docs)
    assert sizes[0] == len(ROWS)  # none is toxic
    assert sizes[1] == 7  # repeated rows, the copy of 2, and none else go
    assert sizes[2] == sizes[3] == 7
    rows = packed.collect()
    assert {r.doc_id for r in rows} == {None, 1, 2, 4, 5, 6}
    assert sum(r.length for r in rows if r.doc_id == 1) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert through(spark, docs)[0] == [0] * 5


def test_run_equals_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _, packed = through(spark, docs)
    ran = corpus_pipeline.run(spark, SF)
    key = ("doc_id", "start", "length", "doc_tokens")
    assert sorted(map(tuple, ran.select(*key).collect())) == sorted(map(tuple, packed.select(*key).collect()))
    total = packing.WINDOW * (ran.selectExpr("max(sequence_id) + 1").first()[0])
    assert total - ran.selectExpr("sum(length)").first()[0] < packing.WINDOW


def test_near_duplicates_from_four_fifths(spark):
    """Pairs of similarity 0.80 to 0.85 leave one text; a pair just below 0.80 stays."""
    def pair(k, shared, own):
        same = [f"w{k}x{i}" for i in range(shared + 4)]
        return [(2 * k, " ".join(same + [f"a{k}x{i}" for i in range(own)])), (2 * k + 1, " ".join(same + [f"b{k}x{i}" for i in range(own)]))]

    # `shared` common shingles and `own` further ones on either side: shared / (shared + 2 own)
    rows = [r for k in range(1, 200) for r in pair(k, 80, 10 if k % 2 else 8)] + pair(500, 79, 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()}
    assert kept >= {*(2 * k for k in range(1, 200)), 1000, 1001}
    missed = {i for i in kept if i % 2} - {1001}
    assert len(missed) <= 2  # tables miss one pair in a thousand; with 0.85 all 199 stayed
    assert near_dedup.side_for(80) == 12


def test_near_duplicates_keep_every_text(spark):
    """Texts that share an id are judged each on its own; a null id leaves where its text has another id."""
    a, b, c, e = (" ".join(f"{k}{i}" for i in range(12)) for k in "abce")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, e), (None, a), (None, "d " * 9), (None, "d " * 9), (8, ""), (8, ""), (8, None), (9, "!")]
    for parts in (1, 4):
        docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, m int").repartition(parts)
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
        assert kept.columns == docs.columns
        want = [(1, a), (5, b), (7, c), (7, e), (None, "d " * 9), (8, ""), (8, None), (9, "!")]
        assert sorted((tuple(r)[:2] for r in kept.collect()), key=repr) == sorted(want, key=repr)
