"""Property tests: helpers against brute-force Python on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estuary.functions import lookups as L
from estuary.functions import rsem
from estuary.operators import physical, shore

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

maybe_int = st.one_of(st.none(), st.integers(-3, 3))
maybe_code = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "ab", ""]))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), maybe_code, st.integers(0, 1000)), min_size=1, max_size=40))
def test_first_of_group_matches_sorted(spark, rows):
    df = spark.createDataFrame(rows, "g int, k string, v int")
    agg = df.groupBy("g").agg(rsem.first_of_group(rsem.asc_nulls_last("k") + [F.col("v")],
                                                  F.struct("k", "v")).alias("f"))
    got = {r["g"]: (r["f"]["k"], r["f"]["v"]) for r in agg.collect()}
    want = {}
    for g, k, v in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or "", r[2])):
        want.setdefault(g, (k, v))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), maybe_int, maybe_code), min_size=1, max_size=40))
def test_r_semantics_match_python(spark, rows):
    df = spark.createDataFrame(rows, "g int, x int, p string")
    out = df.select(rsem.r_ifelse(F.col("x") > 0, F.lit("pos"), F.lit("neg")).alias("ife"),
                    rsem.in_set("p", ["a", "b"]).alias("ins")).collect()
    for (g, x, p), r in zip(rows, out):
        assert r["ife"] == (None if x is None else ("pos" if x > 0 else "neg"))
        assert r["ins"] == (p in ("a", "b"))
    sums = dict(df.groupBy("g").agg(rsem.sum0("x").alias("s")).collect())
    for g in {r[0] for r in rows}:
        assert sums[g] == float(sum(x for gg, x, _ in rows if gg == g and x is not None))


def _gear_group(gear, stratum, split):
    if gear is None:
        return None
    if split and gear == L.SHORE_STRATUM_GEAR and stratum == L.SHORE_STRATUM:
        return L.SHORE_STRATUM_GROUP
    for group, members, ranges in L.GEAR_GROUPS:
        if gear in members or any(lo <= gear <= hi for lo, hi in ranges):
            return group
    return None


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 450)),
                          st.sampled_from(["S", "A", None])), min_size=1, max_size=60),
       st.booleans())
def test_gear_group_sql_matches_table(spark, rows, split):
    df = spark.createDataFrame(rows, "gear int, stratum string")
    got = [r[0] for r in df.select(physical.gear_group("gear", "stratum", split)).collect()]
    assert got == [_gear_group(g, s, split) for g, s in rows]


@SETTINGS
@given(st.lists(st.tuples(*[st.sampled_from([0.0, 0.5, 3.0, 12.0])] * 4), min_size=1, max_size=40))
def test_shore_label_matches_pattern_table(spark, rows):
    df = spark.createDataFrame(rows, "Man double, Eme double, Str double, Ter double")
    got = [r[0] for r in df.select(shore.shore_label()).collect()]
    table = dict(shore.SHORE_LABELS)
    assert got == [table[tuple(int(v > 0) for v in r)] for r in rows]
