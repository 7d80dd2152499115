"""What the survey plans hold and compute once tables are too large to broadcast."""

import re

import pytest

from estuary.functions import rsem
from estuary.operators import enrich
from estuary.plans.registry import REGISTRY


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("survey"))
    orders = spark.range(40).selectExpr(
        "id AS o_orderkey", "id * 7 AS o_custkey", "CASE WHEN id % 3 = 0 THEN 'P' ELSE 'O' END AS o_orderstatus",
        "CAST(id AS DOUBLE) AS o_totalprice", "timestamp_ntz'1998-01-01 00:00:00' + make_dt_interval(CAST(id AS INT)) AS o_orderdate")
    lines = spark.range(160).selectExpr(
        "id % 40 AS l_orderkey", "id * 11 AS l_partkey", "id * 13 AS l_suppkey", "CAST(id DIV 40 AS INT) + 1 AS l_linenumber",
        "CAST(id AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice", "id / 1000D AS l_discount", "id / 2000D AS l_tax",
        "'A' AS l_returnflag", "'O' AS l_linestatus", "timestamp'1998-01-01 00:00:00' AS l_shipdate")
    orders.write.parquet(f"{root}/orders.parquet")
    lines.write.parquet(f"{root}/lineitem.parquet")
    return root


@pytest.fixture
def shuffled(spark):
    """Joins as at size: nothing small enough to broadcast, the whole plan known beforehand."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["com_keep", "hab_combined", "enr_export_all"])
def test_generated_methods_are_short_enough_for_the_jit(shuffled, tables, name):
    mode = shuffled._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = REGISTRY[name](shuffled, tables)._jdf.queryExecution().explainString(mode)
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000


def test_first_rows_compute_their_input_once(shuffled, tmp_path):
    shuffled.createDataFrame([("r1", "b", None, 1)], "reference string, bio_reference string, TBNI_Score double, x int").write.parquet(f"{tmp_path}/t")
    plan = enrich.missing_index(shuffled.read.parquet(f"{tmp_path}/t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_first_rows_among_equal_and_scored_ones(spark):
    rows = [("r1", "b", "s", None, 1), ("r1", "b", "s", None, 1), ("r1", "a", "s", None, 2), ("r2", "a", "s", 1.0, 3), ("r2", "a", "t", None, 4),
            (None, "a", "s", None, 5), (None, None, "s", 2.0, 6), ("r3", "a", "s", 1.0, 7), ("r3", "a", "s", None, 8)]
    df = spark.createDataFrame(rows, "reference string, bio_reference string, species string, TBNI_Score double, x int").repartition(4)
    got = sorted((r["reference"], r["x"]) for r in enrich.missing_index(df).collect())
    assert got == [("r1", 2), ("r3", 8)]


@pytest.mark.parametrize("name", ["veg_pivot", "veg_sums", "shore_pivot", "shore_sums"])
def test_kept_hauls_are_chosen_after_the_sums(shuffled, tables, name):
    plan = REGISTRY[name](shuffled, tables)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("LeftSemi"):]
    assert "Aggregate [reference" in below and "pivotfirst" not in plan.lower()


def test_pivot_fills_and_keeps_unlisted_keys(spark):
    df = spark.createDataFrame([("r1", "A", 1.0), ("r1", "B", 2.0), ("r2", None, 3.0), ("r3", "C", 4.0), ("r4", "B", None)], "k string, n string, v double")
    got = {r["k"]: (r["A"], r["B"]) for r in rsem.pivot_fill(df, "k", "n", "v", ["A", "B"]).collect()}
    assert got == {"r1": (1.0, 2.0), "r2": (0.0, 0.0), "r3": (0.0, 0.0), "r4": (0.0, 0.0)}
