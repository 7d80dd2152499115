"""Golden counts of the fixtures with every lineitem row kept, counted by DuckDB over the oracle stages, sf0.01."""

import os

import pytest
from pyspark.sql import functions as F

from estuary.config import ALL_HAULS, DEFAULT
from estuary.operators import bottom, checks, physical, shore, vegetation
from estuary.plans import pipeline
from estuary.sources import fixtures

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def tables(spark):
    return fixtures.survey_tables(spark, SF)


def per_haul(df, col):
    rows = df.select("reference", col).distinct().groupBy(col).count().collect()
    return {r[col]: r["count"] for r in rows}


def test_default_selection(tables):
    a = pipeline.run_analysis(tables, DEFAULT)
    assert a.fld.count() == 222 and a.fld.where(F.col("effort").isNotNull()).count() == 222
    assert a.com.count() == 797 and a.com.select("reference").distinct().count() == 222
    assert a.len.count() == 1571
    chck = pipeline.checked(a.com, tables["species_codes"])
    assert checks.missing_number_or_effort(chck).count() == 2
    assert checks.samples_summary(chck).count() == 31
    assert checks.fish_by_gear_month(checks.fish_rows(chck)).count() == 147


def test_all_hauls(tables):
    a = pipeline.run_analysis(tables, ALL_HAULS)
    assert a.fld.count() == 15000 and a.fld.where(F.col("effort").isNotNull()).count() == 12750
    assert a.totals.count() == 47174
    assert a.com.count() == 55883 and a.len.count() == 101326
    chck = pipeline.checked(a.com, tables["species_codes"])
    assert checks.missing_number_or_effort(chck).count() == 8518
    hab = pipeline.habitat_summary(tables, ALL_HAULS)
    assert hab.count() == 14651


def test_all_hauls_distributions(tables):
    fld = physical.physical_master(tables["hauls"], ALL_HAULS)
    gr = {r["gr"]: r["count"] for r in fld.groupBy("gr").count().collect()}
    assert gr[20] == 3750 and gr[207] == 1500 and gr[None] == 1500
    assert all(gr[g] == 750 for g in (2, 5, 22, 23, 153, 160, 170, 180, 300, 350, 436))
    keys = physical.retained_keys(fld)
    # FIXTURES.md counts these over each component summary (a haul without
    # rows for a component is absent there, NULL in the combined table)
    b = bottom.bottom_summary(tables["habitat"], tables["codes"], keys)
    assert per_haul(b, "bottom") == {
        "Mud": 1156, "MudSan": 930, "MudSanStr": 737, "MudSanStrUnk": 560, "MudStr": 870,
        "MudUnk": 907, "San": 1198, "SanStr": 910, "SanStrUnk": 708, "Str": 1161,
        "StrUnk": 909, "Unk": 1157, None: 2249}
    v = vegetation.vegetation_summary(tables["habitat"], tables["codes"], fld, keys)
    assert per_haul(v, "bveg") == {
        "Alg": 462, "AlgNon": 143, "Non": 2728, "SAV": 4420, "SAVAlg": 2240, "SAVAlgNon": 411,
        "SAVNon": 1036, None: 2223}
    assert per_haul(v, "DominantVeg") == {
        "Algae": 1359, "Halodule": 1359, "None": 2897, "Ruppia": 1305, "SAV": 5587, "Thalassia": 1156}
    sh = shore.shore_summary(tables["habitat"], tables["codes"], fld, keys)
    assert per_haul(sh, "shore") == {
        "Ter": 1285, "Str": 3498, "StrTer": 2370, "Eme": 1293, "EmeTer": 820, "EmeStr": 2296,
        "EmeStrTer": 1608}


def test_enrichment_default(tables):
    com = pipeline.run_analysis(tables, DEFAULT).com
    enr = pipeline.run_enrichment(com, tables["index"], tables["seagrass"])
    assert enr["index_check"].count() == 17
    assert enr["seagrass_check"].count() == 37
    assert enr["export"].select("reference").distinct().count() == 170
