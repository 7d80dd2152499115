"""Summarise the executed (adaptive, final) plans of the headline outputs.

Usage: python tests/plan_report.py [sf_dir] [--no-static-broadcast]
Prints, per output: shuffle exchanges (with keys), join strategies and
aggregate kinds, read from ``explain`` output after the query ran.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summary(df) -> dict:
    df.collect()  # the plan of this very DataFrame is the final one only after it ran
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    ex = Counter(re.sub(r"#\d+", "", m) for m in re.findall(r"Exchange hashpartitioning\(([^)]*?\)?[^)]*)\)", plan))
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", plan))
    aggs = Counter(re.findall(r"\b(HashAggregate|SortAggregate|ObjectHashAggregate)\(", plan))
    return {"exchanges": dict(ex), "joins": dict(joins), "aggregates": dict(aggs),
            "local_reads": plan.count("AQEShuffleRead local"), "windows": plan.count("Window [")}


def main(argv):
    sf_dir = next((a for a in argv[1:] if a.startswith("/")), "/root/testdata/sf0.01")
    from estuary.config import ALL_HAULS, DEFAULT
    from estuary.plans import pipeline
    from estuary.session import survey_session
    from estuary.sources import fixtures
    spark = survey_session(master="local[8]", shuffle_partitions=16)
    tables = fixtures.survey_tables(spark, sf_dir)
    import tempfile
    d = tempfile.mkdtemp(prefix="plan-report-")
    for k, v in tables.items():
        v.write.parquet(f"{d}/{k}")
    tables = {k: spark.read.parquet(f"{d}/{k}") for k in tables}
    if "--no-static-broadcast" in argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for cfg_name, cfg in (("default", DEFAULT), ("all", ALL_HAULS)):
        a = pipeline.run_analysis(tables, cfg)
        for out in ("com", "len"):
            print(f"{out}[{cfg_name}]", summary(getattr(a, out)))
    print("hab_combined[all]", summary(pipeline.habitat_summary(tables, ALL_HAULS)))


if __name__ == "__main__":
    main(sys.argv)
