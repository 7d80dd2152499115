"""Chemistry, catch and length operators on literal rows."""

import pytest
from pyspark.sql import functions as F

from estuary.config import ALL_HAULS
from estuary.operators import catch, hydro, lengths, physical
from estuary.plans import pipeline
from estuary.sources import schemas
from tests.conftest import frame, haul


def test_hydro_summary_duplicate_surface_and_zone_sd(spark):
    fld = frame(spark, schemas.HAULS, [haul("TBM2005A001", zone="A"), haul("TBM2005A002", zone="A"),
                                       haul("TBM2005A003", zone=None), haul("TBM2005A004", zone=None)])
    hyd = frame(spark, schemas.HYDRO, [
        dict(reference="TBM2005A001", depth=0.2, temperature=20.0, salinity=30.0, dissolvedO2=5.0),
        dict(reference="TBM2005A001", depth=0.2, temperature=22.0, salinity=32.0, dissolvedO2=6.0),
        dict(reference="TBM2005A002", depth=1.0, temperature=None, salinity=None, dissolvedO2=7.0),
        dict(reference="TBM2005A003", depth=1.0, temperature=21.0, salinity=None, dissolvedO2=None),
        dict(reference="TBM2005A004", depth=0.2, temperature=None, salinity=20.0, dissolvedO2=4.0)])
    out = hydro.hydro_summary(hyd, fld).collect()
    rows = sorted((r["reference"], r["temp_surf"], r["salinity"], r["sal_sd"]) for r in out)
    # haul 1 fans out over its two surface rows; haul 2 has no usable reading (dropped);
    # zone A: two copies of mean 31 -> sd 0; NULL zone: one non-null salinity -> sd NULL
    assert rows == [("TBM2005A001", 20.0, 31.0, 0.0), ("TBM2005A001", 22.0, 31.0, 0.0),
                    ("TBM2005A003", None, None, None), ("TBM2005A004", None, 20.0, None)]


def count_row(ref, rid, sc="a", code="8835440102", number=10.0, st=None, sl=1.0, cells=2.0):
    return dict(reference=ref, Species_record_id=rid, SC=sc, NODCCODE=code, Number=number,
                Splittype=st, Splitlevel=sl, Cells=cells)


def test_catch_rows_keys_expansion_and_lumping(spark):
    counts = frame(spark, schemas.COUNTS, [
        count_row("TBM2005A001", 1, sc=None, sl=2.0),
        count_row("TBM2005A001", 2, st=3.0, sl=2.0, cells=3.0),
        count_row("TBM2005A001", 3, st=2.0, sl=1.0, cells=None),
        count_row("TBM2005A001", 4, st=3.0, sl=1.0, cells=0.0),
        count_row("JXM2005A002", 5, code="8805020302"),
        count_row("TBM2005A001", 6, code="8805020302"),
        count_row("TBM2005A001", 7, code="61890213 01"),
        count_row("TBM2005A001", 8, code=None, sl=None)])
    got = {r["species_record_id"]: (r["bio_reference"], r["species"], r["number"])
           for r in catch.catch_rows(counts).collect()}
    assert got[1] == ("TBM2005A001NA2", "8835440102", 10.0)
    assert got[2][2] == pytest.approx(10 * 9 / 3)
    assert got[3][2] == pytest.approx(10 * 2 / 1)          # split type 2: one cell
    assert got[4][2] is None                                # zero cells
    assert got[5][1] == "8805020302"                        # not lumped in JX
    assert got[6][1] == "8805020300"
    assert got[7][1] == "6189021300"                        # blanks removed, then lumped
    assert got[8][:2] == ("TBM2005A001ANA", None)


def test_catch_totals_sum_null_is_zero(spark):
    counts = frame(spark, schemas.COUNTS, [count_row("TBM2005A001", 1, number=None),
                                           count_row("TBM2005A001", 2, number=None)])
    out = catch.catch_totals(catch.catch_rows(counts)).collect()
    assert [(r["n"], r["reference"]) for r in out] == [(0.0, "TBM2005A001")]


def test_lengths_metamorphic_and_null_species(spark):
    counts = frame(spark, schemas.COUNTS, [
        count_row("TBM2005A001", 1), count_row("TBM2005A001", 2, code=None),
        count_row("TBM2005A001", 3, number=0.0)])
    lens = frame(spark, schemas.LENGTHS, [
        dict(reference="TBM2005A001", species_record_id=str(rid), length_record_id=str(k), length=ln)
        for rid, k, ln in [(1, 1, "20"), (1, 2, "20"), (1, 3, "21"), (1, 4, "."),
                           (2, 1, "30"), (3, 1, "40")]])
    rows = catch.catch_rows(counts)
    matched = lengths.lengths_matched(rows, lengths.length_rows(lens))
    ds = lengths.length_dataset(lengths.length_frequency(matched))
    assert ds.agg(F.sum("count")).collect()[0][0] == matched.count() == 4
    com = catch.catch_totals(rows)
    final = lengths.lengths_in(ds, com)
    got = sorted((r["species"] or "", r["sl"], r["count"], r["nl"]) for r in final.collect())
    assert got == [("", 30.0, 1, 1), ("8835440102", 20.0, 2, 3), ("8835440102", 21.0, 1, 3)]


def test_keys_with_their_end_in_front_come_back(spark):
    from estuary.functions.rsem import tail_first, tail_last
    texts = ["", "7", "ABCDEFG", "ABCDEFGH", "ABCDEFGHI", "TBM2005A001", "äöü-ñ€-Küste-01", "  ", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    for n in (8, 10):
        turned = df.withColumn("t", F.expr(tail_first("x", n))).withColumn("b", F.expr(tail_last("t", n)))
        rows = turned.collect()
        assert [r["b"] for r in rows] == texts
        assert len({r["t"] for r in rows}) == len(texts)
        assert all(len(r["t"]) == len(r["x"]) for r in rows if r["x"] is not None)
    assert df.where("x = 'TBM2005A001'").select(F.expr(tail_first("x", 8))).collect()[0][0] == "2005A001TBM"


def test_length_pairs_of_odd_keys(spark):
    """Short, empty and missing keys of hauls, and one that is not kept."""
    refs = ["TBM2005A001", "TBM2005A002", "7", "", None]
    counts = frame(spark, schemas.COUNTS, [count_row(r, 1) for r in refs] + [count_row("7", 2, code=None)])
    lens = frame(spark, schemas.LENGTHS, [
        dict(reference=r, species_record_id=str(rid), length_record_id="1", length="20")
        for r, rid in [(r, 1) for r in refs] + [("7", 2)]])
    rows = catch.catch_rows(counts)
    keys = spark.createDataFrame([("TBM2005A001",), ("7",), ("",), (None,)], "reference string")
    com = catch.catch_totals(rows)
    got = lengths.kept_length_dataset(rows, lens, keys, com).collect()
    assert sorted((r["bio_reference"], r["species"] or "", r["nl"], r["count"]) for r in got) == [
        ("7A1", "", 1, 1), ("7A1", "8835440102", 1, 1), ("A1", "8835440102", 1, 1),
        ("TBM2005A001A1", "8835440102", 1, 1)]
    matched = lengths.lengths_matched(rows, lengths.length_rows(lens)).collect()
    assert sorted(r["reference"] for r in matched) == sorted([r for r in refs if r is not None] + ["7"])


def test_kept_lengths_equal_the_operators_one_by_one(spark):
    """Repeated rows and ids, missing and odd ids, hauls written in small letters, records that share a pair."""
    refs = ["TBM2005A001", "tbm2005a001", "TBM2005A002", "TBM2005A003", "7", "", "abc", "ABC", None]
    counts = frame(spark, schemas.COUNTS, [
        count_row(r, rid, code=code, number=n) for r in refs
        for rid, code, n in [(1, "8835440102", 10.0), (2, "8835440102", 3.0), (2, "8835440102", 3.0), (3, None, 1.0),
                             (4, "8747010401", 0.0), (5, "8747010401", None), (None, "8835440102", 2.0), (0, "9998000000", 1.0)]])
    lens = frame(spark, schemas.LENGTHS, [
        dict(reference=r, species_record_id=rid, length_record_id=str(k), length=ln) for r in refs
        for k, (rid, ln) in enumerate([("1", "20"), ("1.0", "20"), (" 1 ", "21"), ("1", "x"), ("2", "20"), ("2", "2e1"), ("2", "-0"),
                                       ("2", "0"), ("3", "30"), ("4", "20"), ("5", "20"), (None, "20"), ("", "20"), ("-", "20"),
                                       ("-0", "22"), ("1.5", "20"), ("1e20", "20"), ("NaN", "20")])])
    keys = spark.createDataFrame([("TBM2005A001",), ("tbm2005a001",), ("TBM2005A002",), ("7",), ("",), ("abc",), ("ABC",), ("ABC",), (None,)],
                                 "reference string")
    rows = catch.catch_rows(counts)
    com = pipeline.com_pairs(keys, rows, keys).where("bio_reference IS NULL OR bio_reference NOT LIKE 'TBM2005A002%'")

    matched = physical.restrict(lengths.lengths_matched(rows, lengths.length_rows(lens)), keys)
    freq = matched.groupBy("reference", "bio_reference", "species", "sl").agg(F.count("*").alias("count"))
    total = freq.groupBy("bio_reference", "species").agg(F.sum("count").alias("nl"))
    joined = freq.alias("f").join(total.alias("t"), F.expr("f.bio_reference = t.bio_reference AND f.species <=> t.species"))
    wanted = lengths.lengths_in(joined.selectExpr("f.bio_reference", "f.species", "nl", "count", "sl"), com).collect()
    got = lengths.kept_length_dataset(rows, lens, keys, com).collect()
    text = lambda found: sorted(tuple(map(str, r)) for r in found)
    assert text(got) == text(wanted)
    # two hauls share a sample key: their counts stay apart, the number measured is of both
    one = sorted((r["sl"], r["count"], r["nl"]) for r in got if r["bio_reference"] == "ABCA1" and r["species"] == "8835440102")
    assert one == [(0.0, 4, 22), (0.0, 4, 22), (20.0, 6, 22), (20.0, 6, 22), (21.0, 1, 22), (21.0, 1, 22)]
    assert {r["bio_reference"] for r in got} == {"TBM2005A001A1", "7A1", "A1", "ABCA1"}
