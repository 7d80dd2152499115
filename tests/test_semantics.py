"""R / dplyr value semantics on literal rows."""

from pyspark.sql import functions as F

from estuary.functions import rsem


def one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_r_ifelse_null_condition_is_null(spark):
    df = spark.createDataFrame([(None,), (1.0,), (5.0,)], "x double")
    got = one(df, rsem.r_ifelse(F.col("x") > 2, F.lit("big"), F.lit("small")))
    assert got == [None, "small", "big"]


def test_in_set_never_null(spark):
    df = spark.createDataFrame([(None,), ("AM",), ("ZZ",)], "p string")
    assert one(df, rsem.in_set("p", ["AM"])) == [False, True, False]
    assert one(df, rsem.not_in_set("p", ["AM"])) == [True, False, True]


def test_sum0_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0)], "k string, x double")
    got = dict(df.groupBy("k").agg(rsem.sum0("x").alias("s")).collect())
    assert got == {"a": 0.0, "b": 2.0}


def test_num_is_try_cast(spark):
    df = spark.createDataFrame([("12",), (".",), ("",), (None,), (" 5",)], "s string")
    assert one(df, rsem.num("s")) == [12.0, None, None, None, 5.0]


def test_paste0_prints_na_and_whole_numbers(spark):
    df = spark.createDataFrame([("TB", None, 2.0), ("TB", "a", 2.5), ("TB", "b", None)],
                               "r string, sc string, lvl double")
    got = one(df, rsem.paste0("r", "sc", rsem.num_text("lvl")))
    assert got == ["TBNA2", "TBa2.5", "TBbNA"]


def test_keep_existing_is_case_sensitive_and_ordered(spark):
    df = spark.createDataFrame([(1, 2, 3)], "TotalShoreCover int, b int, a int")
    out = rsem.keep_existing(df, ["a", "totalshorecover", "TotalShoreCover", "missing", "b", "a"])
    assert out.columns == ["a", "TotalShoreCover", "b"]


def test_first_of_group_orders_nulls_last(spark):
    df = spark.createDataFrame([("r", None, "x"), ("r", "b", "y"), ("r", "a", "z"), ("s", None, "w")],
                               "ref string, k string, v string")
    agg = df.groupBy("ref").agg(rsem.first_of_group(rsem.asc_nulls_last("k"), F.struct("v")).alias("f"))
    got = {r["ref"]: r["f"]["v"] for r in agg.collect()}
    assert got == {"r": "z", "s": "w"}


def test_first_of_group_is_a_plain_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    agg = df.groupBy("g").agg(rsem.first_of_group([-F.col("v")], F.struct("v")).alias("f"))
    assert sorted(r["f"]["v"] for r in agg.collect()) == [97, 98, 99]
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_null_safe_join_matches_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("A", 2)], "zone string, v int")
    b = spark.createDataFrame([(None, 10.0), ("A", 20.0)], "zone string, sd double")
    b = b.withColumnRenamed("zone", "z2")
    out = a.join(b, a["zone"].eqNullSafe(b["z2"]), "left").select("v", "sd").collect()
    assert sorted(tuple(r) for r in out) == [(1, 10.0), (2, 20.0)]


def test_round_doubles_only_touches_doubles(spark):
    df = spark.createDataFrame([(1.23456789, "x", 3)], "d double, s string, i int")
    r = rsem.round_doubles(df, 3).collect()[0]
    assert r["d"] == 1.235 and r["s"] == "x" and r["i"] == 3
