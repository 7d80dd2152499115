"""Haul selection, gear groups, effort, slope (P1-P9) on literal rows."""

import pytest
from pyspark.sql import functions as F

from estuary.config import ALL_HAULS, DEFAULT
from estuary.operators import physical
from estuary.sources import schemas
from tests.conftest import frame, haul

# (gear, stratum) -> expected group with the literal (first-match) mapping
GEAR_CASES = [
    (1, "A", 2), (2, "A", 2), (5, "A", 5), (11, "A", 20), (13, "A", 20), (20, "A", 20),
    (20, "S", 20), (21, "A", 20), (29, "A", 20), (100, "A", 20), (107, "A", 20), (108, "A", None),
    (12, "A", 22), (28, "A", 22), (10, "A", 23), (23, "A", 23), (153, "A", 153), (154, "A", 153),
    (155, "A", 160), (159, "A", 160), (170, "A", 170), (431, "A", 170), (180, "A", 180),
    (204, "A", 207), (209, "A", 207), (403, "A", 207), (406, "A", 207), (407, "A", None),
    (409, "A", 207), (410, "A", 207), (300, "A", 300), (306, "A", 300), (350, "A", 350),
    (354, "A", 350), (436, "A", 436), (999, "A", None), (None, "A", None),
]


def test_gear_groups_literal(spark):
    df = spark.createDataFrame([(g, s) for g, s, _ in GEAR_CASES], "gear int, stratum string")
    got = [r[0] for r in df.select(physical.gear_group("gear", "stratum")).collect()]
    assert got == [e for _, _, e in GEAR_CASES]


def test_gear_group_split_shore_stratum(spark):
    df = spark.createDataFrame([(20, "S"), (20, "A"), (20, None), (21, "S")], "gear int, stratum string")
    got = [r[0] for r in df.select(physical.gear_group("gear", "stratum", True)).collect()]
    assert got == [19, 20, 20, 20]


def test_effort_and_slope(spark):
    rows = [haul("TBM2005A001", gear=1), haul("TBM2005A002", gear=204, soakhr=2.0, soakmin=30.0),
            haul("TBM2005A003", gear=300, dist_tow=0.5), haul("TBM2005A004", gear=153),
            haul("TBM2005A005", gear=20, startdepth=2.0, wng_dpth=0.5)]
    fld = physical.physical_master(frame(spark, schemas.HAULS, rows), ALL_HAULS)
    got = {r["reference"]: (r["gr"], r["effort"], r["slope"]) for r in fld.collect()}
    assert got["TBM2005A001"][:2] == (2, pytest.approx(0.3117))
    assert got["TBM2005A002"][:2] == (207, 2.5)
    assert got["TBM2005A003"][:2] == (300, pytest.approx(0.5 * 4 * 1853 / 100))
    assert got["TBM2005A003"][2] == pytest.approx(0.5)          # |start - end|
    assert got["TBM2005A004"][1] is None                         # blocknet: no effort
    assert got["TBM2005A005"] == (20, 1.4, 1.5)


def test_selection_default(spark):
    rows = [haul("TBM2005A001"), haul("TBM2005A002", bay="tb"), haul("TBM2005A003", zone=None),
            haul("TBM2005A004", zone="Z1"), haul("TBM1998A005", year=1998),
            haul("TBM2005A006", Project_1=None, Project_3="XX"),
            haul("TBM2005A007", Project_1="WI"), haul("CHM2005A008", bay="CH"),
            haul("TBD2005A009", type="D"), haul("TBM2005A010", gear=1),
            haul("TBM2005A011", gear=20, stratum="S")]
    fld = physical.physical_master(frame(spark, schemas.HAULS, rows), DEFAULT)
    got = sorted(r[0] for r in fld.select("reference").collect())
    assert got == ["TBM2005A001", "TBM2005A002", "TBM2005A006", "TBM2005A011"]


def test_zone_key_prints_na(spark):
    df = frame(spark, schemas.HAULS, [haul("TBM2005A001", zone=None), haul("TBM2005A002")])
    got = [r[0] for r in df.select(physical.zone_key("bay", "zone")).orderBy("reference").collect()]
    assert got == ["TBNA", "TBA"]


def test_selection_pushes_filters_to_scan(spark, tmpdir_path):
    rows = [haul(f"TBM2005A{i:03d}") for i in range(10)]
    path = f"{tmpdir_path}/hauls.parquet"
    frame(spark, schemas.HAULS, rows).write.parquet(path)
    fld = physical.select_hauls(spark.read.parquet(path), DEFAULT)
    plan = fld._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan
    for col in ("bay", "type", "year", "zone"):
        assert col in plan.split("PushedFilters")[1].split("\n")[0].split(", ReadSchema")[0]
