"""Command line: run the whole survey analysis and write every output.

    python -m estuary --tables DIR --out DIR [--bay tb] [--type m]
        [--years 1999 2023] [--projects AM XX] [--gears 20 19]
        [--max-zone Z | --zones A B ...]
        [--all-hauls] [--split-shore-stratum] [--include-enrichment]
        [--format csv|parquet] [--input-format parquet|csv] [--skip TABLE ...]
        [--extra PATH ...]

Inputs are the survey tables under ``--tables`` (see
``estuary.sources.schemas.TABLES`` for the file names); the index and
seagrass tables are optional and enable the enrichment outputs.  ``-`` for a
year leaves that end of the range open.  Values that a column's type cannot
hold are counted while the tables are read, and reported.
"""

from __future__ import annotations

import argparse
import json
import os

from estuary.config import ALL_HAULS, DEFAULT
from estuary.plans import pipeline
from estuary.session import survey_session
from estuary.sources import io, schemas


def build_config(a: argparse.Namespace):
    cfg = ALL_HAULS if a.all_hauls else DEFAULT
    kw = {}
    if a.bay is not None:
        kw["bay"] = a.bay
    if a.type is not None:
        kw["sampling_type"] = a.type
    if a.years:
        kw["first_year"], kw["last_year"] = a.years
    if a.projects:
        kw["projects"] = tuple(a.projects)
    if a.gears:
        kw["gears"] = tuple(a.gears)
    if a.max_zone is not None:
        kw["max_zone"] = a.max_zone
    if a.zones is not None:
        kw["zones"] = tuple(a.zones)
    kw["split_shore_stratum"] = a.split_shore_stratum
    kw["include_enrichment"] = a.include_enrichment
    return cfg.with_(**kw)


def main(argv=None) -> dict[str, str]:
    p = argparse.ArgumentParser(prog="estuary", description=__doc__.split("\n")[0])
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--input-format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--bay")
    p.add_argument("--type")
    p.add_argument("--years", nargs=2, type=lambda y: None if y == "-" else int(y), metavar=("FIRST", "LAST"))
    p.add_argument("--projects", nargs="+")
    p.add_argument("--gears", nargs="+", type=int)
    zone = p.add_mutually_exclusive_group()
    zone.add_argument("--max-zone")
    zone.add_argument("--zones", nargs="+")
    p.add_argument("--all-hauls", action="store_true")
    p.add_argument("--split-shore-stratum", action="store_true")
    p.add_argument("--include-enrichment", action="store_true")
    p.add_argument("--skip", nargs="+", default=[], choices=sorted(schemas.TABLES),
                   help="tables not to load (e.g. index seagrass when absent)")
    p.add_argument("--extra", nargs="+", default=[], metavar="PATH",
                   help="further tables keyed by reference (e.g. weather) to join to the hauls")
    a = p.parse_args(argv)
    cfg = build_config(a)
    spark = survey_session("estuary")
    fmt = a.input_format
    if missing := [n for n in schemas.REQUIRED_TABLES if n in a.skip]:
        p.error(f"required tables cannot be skipped: {', '.join(missing)}")
    # local roots: load what exists; remote roots (scheme://): everything
    # not skipped (existence is not checked from the driver)
    present = [n for n, (stem, _) in schemas.TABLES.items() if n not in a.skip
               and ("://" in a.tables or os.path.exists(f"{a.tables.rstrip('/')}/{stem}.{fmt}"))]
    if missing := [schemas.TABLES[n][0] for n in schemas.REQUIRED_TABLES if n not in present]:
        p.error(f"required tables are missing under {a.tables}: " + ", ".join(f"{stem}.{fmt}" for stem in missing))
    lost: io.Lost = {}
    tables = io.load_tables(spark, a.tables, fmt=fmt, names=present, lost=lost)
    extra = [io.read_table(spark, path, fmt=fmt) for path in a.extra]
    paths = pipeline.write_outputs(spark, tables, cfg, a.out, fmt=a.format, extra=extra, lost=lost)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
