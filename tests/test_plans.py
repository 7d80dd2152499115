"""Plan shape of the pipelines: the properties that matter at scale."""

import re

import pytest

from estuary.config import ALL_HAULS, DEFAULT
from estuary.operators import vegetation
from estuary.plans import pipeline
from estuary.sources import fixtures

SF = "/root/testdata/sf0.001"


def executed(df):
    df.collect()                     # runs this QueryExecution: the final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark):
    return fixtures.survey_tables(spark, SF)


def test_no_cartesian_no_nested_loop_no_window(spark, tables):
    a = pipeline.run_analysis(tables, ALL_HAULS)
    for df in (a.com, a.len):
        plan = executed(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "FullOuter"):
            assert bad not in plan
    # the only window is the bounded per-sample nl sum over aggregated lengths
    # (the fixtures number lineitem's rows within an order, before any operator)
    # beside the ranks of the code list and the merging of a zone's few weights
    assert all(re.search(r"l_orderkey|\[code#|\[zone#", line) for line in executed(a.com).split("\n") if "Window [" in line)


def stored_tables(spark, tables, path):
    from estuary.sources import io, schemas
    for name, df in tables.items():
        df.write.parquet(f"{path}/{schemas.TABLES[name][0]}.parquet")
    return io.load_tables(spark, path)


def final_plan(df):
    """The final adaptive plan."""
    df.collect()
    return re.sub(r"(?ms)^\+- == Initial Plan ==.*", "", df._jdf.queryExecution().executedPlan().toString())


def test_building_a_plan_starts_no_job(spark, tables, tmpdir_path):
    t = stored_tables(spark, tables, tmpdir_path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        a = pipeline.run_analysis(t, ALL_HAULS)
        pipeline.run_checks(a.com, t["species_codes"])
        pipeline.run_enrichment(a.com, t["index"], t["seagrass"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(tracker.getJobIdsForGroup("build")) == []


def test_dictionary_is_joined_map_side_while_it_is_small(spark, tables, tmpdir_path):
    t = stored_tables(spark, tables, tmpdir_path)
    plan = executed(pipeline.habitat_summary(t, ALL_HAULS))
    for key in ("[bottomtype", "[v_code", "[shoretype"):
        assert f"BroadcastHashJoin {key}" in plan
    # the habitat table is never shuffled on a dictionary key
    for key in ("hashpartitioning(b_code", "hashpartitioning(vd_code", "hashpartitioning(s_code",
                "hashpartitioning(bottomtype", "hashpartitioning(shoretype"):
        assert key not in plan


def test_oversized_dictionary_gives_the_same_rows_by_shuffle(spark, tables):
    """A code list beyond the threshold is not broadcast; further codes change nothing."""
    more = spark.sql("SELECT f AS fieldname, concat('q', id) AS code, repeat('long ', 40) AS description, 'None' AS category "
                     "FROM range(30000) LATERAL VIEW explode(array('BottomType', 'BottomVeg', 'ShoreType')) x AS f")
    long = {**tables, "codes": tables["codes"].unionByName(more)}
    def rounded(row):
        return tuple(round(x, 9) if isinstance(x, float) else x for x in row)

    want = sorted((rounded(r) for r in pipeline.habitat_summary(tables, ALL_HAULS).collect()), key=repr)
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "100k")
    try:
        df = pipeline.habitat_summary(long, ALL_HAULS)
        assert sorted((rounded(r) for r in df.collect()), key=repr) == want
        assert "SortMergeJoin [bottomtype" in executed(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")


def test_habitat_pass_is_a_hash_aggregate(spark, tables, tmpdir_path):
    t = stored_tables(spark, tables, tmpdir_path)
    a = pipeline.run_analysis(t, ALL_HAULS)
    for df in (pipeline.habitat_summary(t, ALL_HAULS), a.com, vegetation.veg_dominant(vegetation.veg_rows(t["habitat"]), t["codes"])):
        assert "SortAggregate" not in final_plan(df)


def test_readings_are_scanned_twice_at_most(spark, tables, tmpdir_path):
    t = stored_tables(spark, tables, tmpdir_path)
    scans = [x for x in final_plan(pipeline.run_analysis(t, ALL_HAULS).com).split("\n") if "FileScan" in x and "salinity:double" in x]
    assert len(scans) == 2


def test_lengths_are_dealt_by_the_pair_once(spark, tables, tmpdir_path):
    t = stored_tables(spark, tables, tmpdir_path)
    plan = final_plan(pipeline.run_analysis(t, ALL_HAULS).len)
    by_pair = re.findall(r"Exchange hashpartitioning\(_sample#\d+, _species#\d+, \d+\)", plan)
    assert len(set(by_pair)) == 2           # the frequencies once, the pairs once
    assert "coalesce(bio_reference" not in "".join(re.findall(r"Exchange.*", plan))


def test_length_plan_sorts_by_the_ends_of_keys(spark, tables):
    """Keys of hauls begin alike: sorted as they are, nearly every comparison looks two rows up."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pipeline.run_analysis(tables, ALL_HAULS).len._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sorts = re.findall(r"Sort \[(\w+)#", plan)
    assert "reference" not in sorts and {"_haul", "_sample"} <= set(sorts)


def shuffled_plan(spark, df):
    """The final adaptive plan of ``df()`` with every join shuffled."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    kept = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "-1")
    try:
        return final_plan(df())
    finally:
        for n, v in zip(names, kept):
            spark.conf.set(n, v)


def test_length_plan_shuffles_each_table_once(spark, tables, tmpdir_path):
    """Match and pairs share the catch records; the frequencies are dealt by the pair only."""
    t = stored_tables(spark, tables, tmpdir_path)
    plan = shuffled_plan(spark, lambda: pipeline.run_analysis(t, ALL_HAULS).len)
    exchanges = sorted(re.sub(r"#\d+", "", x) for x in re.findall(r"\+- Exchange hashpartitioning\((.*), \d+\), ENSURE", plan))
    # hauls, kept hauls and catch; catch and lengths; frequencies and pairs
    assert exchanges == ["_haul"] * 3 + ["_haul, _record"] * 2 + ["_sample, _species"] * 2
    for name in ("biology_counts", "biology_lengths"):
        assert len([x for x in plan.split("\n") if "FileScan" in x and name in x]) == 1, name


def test_lines_are_shuffled_once_for_catch_and_lengths(spark, tables):
    plan = shuffled_plan(spark, lambda: pipeline.run_analysis(tables, ALL_HAULS).len)
    assert len([x for x in plan.split("\n") if "FileScan" in x and "lineitem.parquet" in x]) == 1


def test_missing_scores_are_picked_over_few_columns(spark, tables, tmpdir_path):
    t = stored_tables(spark, tables, tmpdir_path)
    a = pipeline.run_analysis(t, ALL_HAULS)
    plan = final_plan(pipeline.run_enrichment(a.com, t["index"], t["seagrass"])["index_check"])
    picks = [x for x in plan.split("\n") if "Aggregate" in x and "_has" in x]
    assert picks and not any("DominantVeg" in x or "Scientificname" in x for x in picks)


def test_aggregates_are_partial_before_shuffle(spark, tables):
    plan = executed(pipeline.run_analysis(tables, DEFAULT).com)
    # every exchange on the aggregation side is fed by a partial aggregate
    assert plan.count("partial_") >= 3


def test_zone_sd_is_joined_by_its_size_at_run_time(spark, tables):
    """Without a static estimate the zone table is broadcast once its size is known; hauls are read where they lie."""
    from estuary.operators import hydro, physical
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fld = physical.physical_master(tables["hauls"], ALL_HAULS)
        plan = executed(hydro.hydro_summary(tables["hydro"], fld))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin [coalesce(zone" in plan and "SortMergeJoin [coalesce(zone" not in plan


def test_key_restriction_moves_below_aggregates_when_small(spark, tables):
    """Per-haul aggregates are written aggregate-then-restrict; with a
    broadcastable key set Catalyst filters the rows before aggregating,
    otherwise it pre-aggregates before any shuffle."""
    df = pipeline.run_analysis(tables, DEFAULT).com
    lines = [l.strip(" :+-") for l in df._jdf.queryExecution().optimizedPlan().toString().split("\n")]
    lines = [l for l in lines if not l.startswith(("Project", "Filter")) and "collect_list" not in l]
    # habitat, hydrolab means, catch totals: no semi join waits for an aggregate
    assert not any(a.startswith("Join LeftSemi") and b.startswith("Aggregate [") for a, b in zip(lines, lines[1:]))
    assert sum(x.startswith("Join LeftSemi") for x in lines) >= 3


def test_key_restriction_stays_above_aggregates_when_large(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = pipeline.run_analysis(tables, ALL_HAULS).com
        lines = [l.strip(" :+-") for l in df._jdf.queryExecution().optimizedPlan().toString().split("\n")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [l for l in lines if not l.startswith(("Project", "Filter"))]
    above = sum(1 for a, b in zip(lines, lines[1:])
                if a.startswith("Join LeftSemi") and b.startswith("Aggregate ["))
    assert above >= 3         # habitat, hydrolab means, catch totals aggregate first
