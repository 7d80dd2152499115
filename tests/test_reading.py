"""Reading and writing by column name, and numbers in texts."""

import pytest
from pyspark.sql import functions as F

from estuary.config import ALL_HAULS, DEFAULT
from estuary.functions.rsem import num
from estuary.operators import physical, shore
from estuary.plans import pipeline
from estuary.sources import fixtures, io, schemas

SF = "/root/testdata/sf0.001"


def text_file(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_csv_columns_are_found_by_name(spark, tmpdir_path):
    for year, header, row in (("a", "reference,depth,salinity,temperature,dissolvedO2,note", "r1,0.2,30,20,5,x"),
                              ("b", "note,dissolvedO2,temperature,salinity,depth,reference", "y,5,20,30,0.2,r2")):
        text_file(spark, f"{tmpdir_path}/{year}/hydrolab.csv", [header, row])
    t = io.load_tables(spark, [f"{tmpdir_path}/a", f"{tmpdir_path}/b"], fmt="csv", names=["hydro"])["hydro"]
    assert t.columns == [*schemas.HYDRO.names, "note"]
    assert sorted(map(tuple, t.collect())) == [("r1", 0.2, 20.0, 30.0, 5.0, "x"), ("r2", 0.2, 20.0, 30.0, 5.0, "y")]


def test_csv_missing_column_is_an_error_and_lost_values_are_counted(spark, tmpdir_path):
    text_file(spark, f"{tmpdir_path}/h.csv", ["reference,depth,temperature,salinity,dissolvedO2", "r1,bad,20,NA,5", "r2,,NaN,1,2"])
    raw = io.read_survey_csv(spark, f"{tmpdir_path}/h.csv")
    assert io.unreadable(raw, schemas.HYDRO).first().asDict() == {"reference": 0, "depth": 1, "temperature": 1, "salinity": 0, "dissolvedO2": 0}
    assert [tuple(r) for r in io.typed(raw, schemas.HYDRO).orderBy("reference").collect()] == [("r1", None, 20.0, None, 5.0), ("r2", None, None, 1.0, 2.0)]
    with pytest.raises(ValueError, match="depth"):
        io.typed(raw.drop("depth"), schemas.HYDRO)


def test_empty_text_survives_csv(spark, tmpdir_path):
    df = spark.createDataFrame([("a", ""), ("b", None), ("c", "x,\"y")], "k string, v string")
    io.write_survey_csv(df, f"{tmpdir_path}/t.csv")
    assert sorted(map(tuple, io.read_survey_csv(spark, f"{tmpdir_path}/t.csv").collect())) == [("a", ""), ("b", None), ("c", "x,\"y")]


def test_parquet_float_depth_still_is_surface(spark, tmpdir_path):
    spark.sql("SELECT 'r' AS reference, CAST(0.2 AS FLOAT) AS depth, 1 AS temperature, '3' AS salinity, 4D AS dissolvedO2").write.parquet(f"{tmpdir_path}/h.parquet")
    t = io.read_table(spark, f"{tmpdir_path}/h.parquet", schemas.HYDRO)
    assert [f.dataType for f in t.schema] == [f.dataType for f in schemas.HYDRO] and t.where("depth = 0.2D").count() == 1


def test_outputs_do_not_depend_on_the_format(spark, tmpdir_path):
    tables = dict(fixtures.survey_tables(spark, SF))
    tables["counts"] = tables["counts"].withColumn("NODCCODE", F.when(F.col("NODCCODE").startswith("87"), "").otherwise(F.col("NODCCODE")))
    csv = pipeline.write_outputs(spark, tables, ALL_HAULS, f"{tmpdir_path}/c", fmt="csv")
    parquet = pipeline.write_outputs(spark, tables, ALL_HAULS, f"{tmpdir_path}/p", fmt="parquet")
    for a, b in zip(sorted(csv), sorted(parquet)):
        x, y = io.read_survey_csv(spark, csv[a]), spark.read.parquet(parquet[b])
        texts = y.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in y.columns))
        assert x.columns == y.columns and x.exceptAll(texts).count() == texts.exceptAll(x).count() == 0, a


def test_texts_that_are_no_number(spark):
    df = spark.createDataFrame([(x,) for x in ("NaN", "Infinity", "-inf", "20d", "5f", " 7 ", "1e2", ".", "", None, "-3.5")], "x string")
    assert [r[0] for r in df.select(num("x")).collect()] == [None] * 5 + [7.0, 100.0, None, None, None, -3.5]


def test_share_rounds_ties_to_even(spark):
    df = spark.createDataFrame([("TBM200500000001", 9.0, 16.0), ("TBM200500000001", 11.0, 16.0)], "reference string, w double, t double")
    assert [r[0] for r in df.select(shore.share("w", "t")).collect()] == [0.562, 0.688]


@pytest.mark.parametrize("change, years", [
    ({"first_year": 2000, "last_year": None}, [2005, 2030]), ({"first_year": None, "last_year": 2004}, [1999]),
    ({"first_year": 2006, "last_year": 2001}, []), ({"projects": ()}, []), ({"zones": ()}, []), ({}, [1999, 2005, 2030])])
def test_selection_parameters(spark, change, years):
    rows = [("A", y, "AM", None, None) for y in (1999, 2005, 2030)]
    df = spark.createDataFrame(rows, "zone string, year int, Project_1 string, Project_2 string, Project_3 string")
    cfg = ALL_HAULS.with_(**change)
    assert sorted(r.year for r in physical.select_hauls(df, cfg).collect()) == years


def test_empty_gear_list_keeps_nothing(spark):
    df = spark.createDataFrame([(20,)], "gr int")
    assert physical.keep_gears(df, ALL_HAULS.with_(gears=(-1, -1))).count() == 0


def test_project_filter_reaches_the_scan(spark, tmpdir_path):
    fixtures.survey_tables(spark, SF)["hauls"].write.parquet(f"{tmpdir_path}/hauls.parquet")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        df = physical.select_hauls(io.read_table(spark, f"{tmpdir_path}/hauls.parquet"), DEFAULT)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert all(c in pushed for c in ("Project_1", "Project_2", "Project_3", "year", "bay", "zone"))
