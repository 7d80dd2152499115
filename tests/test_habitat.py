"""Bottom, vegetation, shore and the fused habitat pass on literal rows."""

import pytest
from pyspark.sql import functions as F

from estuary.config import ALL_HAULS
from estuary.operators import bottom, habitat, physical, shore, vegetation
from estuary.sources import schemas
from tests.conftest import frame, haul


def hab_row(ref, rid, bt=None, bv=None, bvr=None, st=None, sr=None, inund=None, over=None):
    return dict(reference=ref, habitat_record_id=str(rid), bottomtype=bt, bottomveg=bv,
                BottomVegRatio=bvr, shoretype=st, ShoreTypeRatio=sr, Inund=inund, Over=over)


def by_ref(df, *cols):
    return {r["reference"]: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("flags,label", [
    ((1, 1, 1, 1), "MudSanStrUnk"), ((1, 1, 0, 1), None), ((1, 0, 1, 1), None),
    ((0, 1, 0, 1), None), ((0, 0, 0, 0), None), ((0, 0, 1, 1), "StrUnk"), ((1, 0, 0, 0), "Mud"),
])
def test_bottom_labels(spark, flags, label):
    df = spark.createDataFrame([flags], "bmud int, bsan int, bstr int, bunk int")
    assert df.select(bottom.bottom_label()).collect()[0][0] == label


def test_bottom_summary_lowercase_flags(spark, codes):
    hab = frame(spark, schemas.HABITAT, [
        hab_row("TBM2005A001", 1, bt="M"), hab_row("TBM2005A001", 2, bt="M"),
        hab_row("TBM2005A001", 3, bt="U"), hab_row("TBM2005A002", 1, bt="N"),
        hab_row("TBM2005A003", 1, bt="X"), hab_row("TBM2005A004", 1, bt="O"),
        hab_row("TBM2005A004", 2, bt="S")])
    got = by_ref(bottom.bottom_summary(hab, codes), "bmud", "bsan", "bstr", "bunk", "bottom")
    assert got == {"TBM2005A001": (1, 0, 0, 1, "MudUnk"),
                   "TBM2005A003": (0, 0, 0, 0, None),      # code without category: row kept, no flag
                   "TBM2005A004": (0, 1, 1, 0, "SanStr")}


@pytest.mark.parametrize("pattern,label", [
    ((5, 0, 0, 0), "Man"), ((0, 5, 0, 0), "Eme"), ((0, 0, 5, 0), "Str"), ((0, 0, 0, 5), "Ter"),
    ((0, 0, 0, 0), "Non"), ((5, 5, 0, 0), "ManEme"), ((5, 0, 5, 0), "ManStr"),
    ((5, 0, 0, 5), "ManTer"), ((5, 5, 5, 0), "ManEmeStr"), ((5, 0, 5, 5), "ManStrTer"),
    ((5, 5, 0, 5), "ManEmeTer"), ((5, 5, 5, 5), "ManEmeStrTer"), ((0, 5, 5, 0), "EmeStr"),
    ((0, 5, 0, 5), "EmeTer"), ((0, 5, 5, 5), "EmeStrTer"), ((0, 0, 5, 5), "StrTer"),
])
def test_all_sixteen_shore_labels(spark, pattern, label):
    df = spark.createDataFrame([tuple(float(x) for x in pattern)], "Man double, Eme double, Str double, Ter double")
    assert df.select(shore.shore_label()).collect()[0][0] == label


def test_shore_manmade_is_structure_other_man_category_is_man(spark, codes):
    refs = ["TBM2005A001", "TBM2005A002"]
    fld = frame(spark, schemas.HAULS, [haul(r) for r in refs])
    hab = frame(spark, schemas.HABITAT, [
        hab_row("TBM2005A001", 1, st="SW", sr="4"),
        hab_row("TBM2005A002", 1, st="MA", sr="15"), hab_row("TBM2005A002", 2, st="SP", sr="2")])
    got = by_ref(shore.shore_summary(hab, codes, fld), "Man", "Str", "Eme", "shore")
    assert got["TBM2005A001"] == (0.0, 4.0, 0.0, "Str")
    assert got["TBM2005A002"] == (10.0, 0.0, 2.0, "ManEme")     # capped at 10


def test_shore_shares_and_percent_year_cutoff(spark, codes):
    fld = frame(spark, schemas.HAULS, [haul("TBM2005A001", TotalShoreCover="50"),
                                       haul("TBM2000A002", TotalShoreCover="50")])
    hab = frame(spark, schemas.HABITAT, [
        hab_row("TBM2005A001", 1, st="MG", sr="3", inund="YES", over="NO"),
        hab_row("TBM2005A001", 2, st="OY", sr=None, inund="11", over="10"),
        hab_row("TBM2000A002", 1, st="MG", sr="3", inund="YES", over="YES")])
    cats = shore.shore_categories(shore.shore_rows(hab), codes)
    got = by_ref(shore.shore_percents(shore.shore_shares(cats), fld), "ovr_wtf", "ind_wtf", "ovr_per")
    # ratios 3 and 0.1 (missing ratio); inundated: first only; overhanging: second only
    assert got["TBM2005A001"] == (round(0.1 / 3.1, 3), round(3 / 3.1, 3), pytest.approx(50 * round(0.1 / 3.1, 3)))
    assert got["TBM2000A002"] == (None, None, None)


def veg_fixture(spark):
    refs = [f"TBM2005A00{i}" for i in range(1, 7)]
    fld = frame(spark, schemas.HAULS, [
        haul(refs[0], bottomvegcover="101"), haul(refs[1], bottomvegcover="-9"),
        haul(refs[2], bottomvegcover="80"), haul(refs[3], bottomvegcover="."),
        haul(refs[4], bottomvegcover="-9"), haul(refs[5], bottomvegcover="60")])
    hab = frame(spark, schemas.HABITAT, [
        hab_row(refs[0], 1, bv="TH", bvr="8"), hab_row(refs[0], 2, bv="AM", bvr="0.5"),
        hab_row(refs[1], 1, bv="UN"), hab_row(refs[1], 2, bv="NO"),
        hab_row(refs[2], 1, bv="MX", bvr="9"), hab_row(refs[2], 2, bv="HA", bvr="2"),
        hab_row(refs[3], 1, bv="HE", bvr="7"),
        hab_row(refs[4], 1, bv="SM", bvr=None),
        hab_row(refs[5], 1, bv="HA", bvr="101")])
    return fld, hab, refs


def test_vegetation_summary_rules(spark, codes):
    fld, hab, refs = veg_fixture(spark)
    got = by_ref(vegetation.vegetation_summary(hab, codes, fld),
                 "SAV", "Alg", "Non", "HA", "TH", "RU", "bveg", "DominantVeg")
    # 101 cover -> 1 for weighting; TH 8 -> 8/10*1; algae 0.5 -> presence 1 -> 0.1
    assert got[refs[0]] == (0.0, 0.1, 0.0, 0.0, 0.8, 0.0, "SAVAlg", "Thalassia")
    # only "none" (UN -> NO on record 1; NO on record 2 dropped); cover -9 -> 0; Non reset
    assert got[refs[1]] == (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, "Non", "None")
    # "Mixed" dominant takes the class
    assert got[refs[2]][6:] == ("SAV", "SAV")
    # unreadable cover: weights NULL, class NULL, Non NULL (ifelse on NULL); Halophila pooled
    assert got[refs[3]] == (None, None, None, None, None, None, None, "Halophila spp.")
    # missing ratio -> 0.1 -> presence 1; negative cover with vegetation -> 1; mixed seagrass -> SAV
    assert got[refs[4]] == (0.1, 0.0, 0.0, 0.0, 0.0, 0.0, "SAV", "SAV")
    # 101 ratio -> presence 1 (the 101 rule)
    assert got[refs[5]][3] == pytest.approx(6.0)


def test_fused_pass_equals_separate_components(spark, codes):
    fld, hab, refs = veg_fixture(spark)
    hab = hab.unionByName(frame(spark, schemas.HABITAT, [
        hab_row(refs[0], 3, bt="M", st="SW", sr="2", inund="1", over="YES"),
        hab_row("TBM2005A099", 1, bt="S")]))
    fld = fld.unionByName(frame(spark, schemas.HAULS, [haul("TBM2005A099")]))
    fused = habitat.habitat_combined(hab, codes, fld)
    b = bottom.bottom_summary(hab, codes)
    v = vegetation.vegetation_summary(hab, codes, fld)
    s = shore.shore_summary(hab, codes, fld).drop("TotalShoreCover")
    p = shore.shore_percents(shore.shore_shares(shore.shore_categories(shore.shore_rows(hab), codes)), fld)
    sep = (b.join(v, "reference", "full").join(s, "reference", "full")
            .join(p.select("reference", "ovr_per", "ind_per"), "reference", "full")
            .select(*habitat.COMBINED_COLUMNS))
    assert sorted(map(tuple, fused.collect()), key=repr) == sorted(map(tuple, sep.collect()), key=repr)


def test_fused_habitat_is_one_aggregate(spark, codes):
    fld, hab, _ = veg_fixture(spark)
    plan = habitat.habitat_combined(hab, codes, fld)._jdf.queryExecution().executedPlan().toString()
    # the only windows rank the code list
    assert "FullOuter" not in plan and all("[code#" in line for line in plan.split("\n") if "Window" in line)
