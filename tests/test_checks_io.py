"""QA tables, enrichment and sources/sinks."""

import os

from pyspark.sql import functions as F

from estuary.config import ALL_HAULS, DEFAULT
from estuary.functions import lookups as L
from estuary.operators import checks, enrich
from estuary.sources import io, schemas
from tests.conftest import frame, haul


def test_labels_unknown_is_null(spark):
    df = spark.createDataFrame([(19, 1), (2, 12), (None, 13)], "gr int, month int")
    got = [tuple(r) for r in df.select(L.gear_label("gr"), L.month_label("month")).collect()]
    assert got == [("offshr sn - shr strat", "Jan"), (None, "Dec"), (None, None)]


def test_bay_and_type_names(spark):
    df = spark.createDataFrame([("tb", "m"), ("ZZ", None)], "bay string, type string")
    got = [tuple(r) for r in df.select(L.bay_name("bay"), L.type_name("type")).collect()]
    assert got == [("Tampa Bay", "stratified-random sampling"), (None, None)]


def test_project_groups(spark):
    df = spark.createDataFrame([("AR", None, "AS"), (None, "AR", None), ("WI", None, None),
                                (None, None, None)], "Project_1 string, Project_2 string, Project_3 string")
    got = [r[0] for r in df.select(checks.project_group()).collect()]
    assert got == ["Stratified-random sampling", "River Study", "Inshore - West Florida Shelf", "Other"]


def test_names_join_null_species(spark):
    com = spark.createDataFrame([("r1", None, 1.0), ("r1", "8835440102", 2.0)],
                                "reference string, species string, number double")
    spp = spark.createDataFrame([(None, "Unknown"), ("8835440102", "Species A")],
                                "species string, scientificname string")
    got = sorted((r["species"] or "", r["scientificname"]) for r in checks.with_names(com, spp).collect())
    assert got == [("", "Unknown"), ("8835440102", "Species A")]


def test_samples_summary_counts_hauls_once(spark):
    chck = spark.createDataFrame([("r1", 20, 2005, 5, "a"), ("r1", 20, 2005, 5, "b"),
                                  ("r2", 20, 2005, 5, "a"), ("r3", 2, 2005, 5, "a"),
                                  ("r4", 5, 2005, 5, "a")],
                                 "reference string, gr int, year int, month int, species string")
    got = sorted((r["gr_label"] or "", r["n_collections"]) for r in checks.samples_summary(chck).collect())
    assert got == [("", 2), ("offshr sn - off strat", 2)]     # gears 2 and 5 share the NULL label


def test_preview_is_total_order_nulls_last(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3)], "k string, v int")
    got = [r["k"] for r in checks.preview(df, ["k"], n=2).collect()]
    assert got == ["a", "b"]


def test_first_row_per_haul_then_filter(spark):
    df = spark.createDataFrame([("r1", "B1", "s2", None), ("r1", "B1", "s1", 5.0),
                                ("r2", None, None, None), ("r2", "B2", None, None)],
                               "reference string, bio_reference string, species string, TBNI_Score double")
    got = sorted((r["reference"], r["bio_reference"]) for r in enrich.missing_index(df).collect())
    assert got == [("r2", "B2")]                                # r1's first row has a score


def test_csv_round_trip_with_na(spark, tmpdir_path):
    df = frame(spark, schemas.HAULS, [haul("TBM2005A001", zone=None), haul("TBM2005A002")])
    path = f"{tmpdir_path}/out.csv"
    io.write_survey_csv(df, path)
    back = io.read_survey_csv(spark, path, schemas.HAULS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    text = "".join(open(os.path.join(path, f)).read() for f in os.listdir(path) if f.endswith(".csv"))
    assert ",NA," in text


def test_load_dir_extension_any_case(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/d")
    data = "reference,bay,type,year\nTBM2005A001,TB,M,2005\n"
    for name in ("one.CSV", "two.csv", "skip.txt"):
        open(f"{tmpdir_path}/d/{name}", "w").write(data)
    out = io.load_dir(spark, f"{tmpdir_path}/d", "csv", "reference string, bay string, type string, year int")
    assert out.count() == 2 and out.where(F.col("year") == 2005).count() == 2


def test_append_years_fills_missing_columns(spark):
    df = frame(spark, schemas.HAULS, [haul("TBM1997A001"), haul("TBM2005A002")])
    prev = df.where(F.col("year") < 2000).drop("TotalShoreCover")
    cur = df.where(F.col("year") >= 2000)
    out = io.append_years(prev, cur)
    assert out.count() == 2 and out.where(F.col("TotalShoreCover").isNull()).count() == 1
    assert io.append_years(prev, cur, include_prev=False).count() == 1


def test_output_name():
    assert io.output_name(DEFAULT, "c") == "tbm_c.csv"


def test_load_tables_over_several_year_folders(spark, tmpdir_path):
    old = frame(spark, schemas.HAULS, [haul("TBM1997A001")]).drop("TotalShoreCover")
    new = frame(spark, schemas.HAULS, [haul("TBM2005A002"), haul("TBM2005A003")])
    old.write.parquet(f"{tmpdir_path}/prev/physical_master.parquet")
    new.write.parquet(f"{tmpdir_path}/cur/physical_master.parquet")
    t = io.load_tables(spark, [f"{tmpdir_path}/prev", f"{tmpdir_path}/cur"], names=["hauls"])
    h = t["hauls"]
    assert h.count() == 3
    assert h.where(F.col("TotalShoreCover").isNull()).count() == 1
