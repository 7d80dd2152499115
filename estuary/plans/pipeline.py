"""The survey pipelines (Z1-Z4) as lazy DataFrame graphs.

Only the ``write_*`` functions run over the data; building a plan starts no job.
``run_analysis`` returns DataFrames whose plans Catalyst optimises as a
whole: filters reach the parquet scans, every per-haul table is keyed and
partitioned on ``reference`` and the combine step is a chain of left joins
on that one key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.config import EXPORT_VARS, SurveyConfig
from estuary.operators import catch, checks, combine, enrich, habitat, hydro, lengths, physical
from estuary.sources import io


# The names under which the outputs are known.
OUTPUT_NAMES = {"samples_summary": "check_samples_summary", "fish_by_gear_month": "check_fish_by_gear_month",
                "fish_by_project": "check_fish_by_project", "index_check": "tbni_check",
                "seagrass_check": "sg_chk", "export": "phy_tbni_sgrs"}


@dataclass
class Analysis:
    fld: DataFrame        # selected hauls with physical variables
    keys: DataFrame       # kept haul keys
    rows: DataFrame       # cleaned catch rows
    totals: DataFrame     # catch totals per sample x species
    com: DataFrame        # combined table (export projection)
    len: DataFrame        # length table restricted to pairs in ``com``


def combined_full(tables: dict[str, DataFrame], cfg: SurveyConfig,
                  extra: Sequence[DataFrame] = ()) -> tuple[DataFrame, dict]:
    """M1 with every column (before the export projection).

    ``extra``: further tables keyed by ``reference`` (weather, say), joined
    to the hauls; columns that a haul already has are left out."""
    fld = physical.physical_master(tables["hauls"], cfg)
    keys = physical.retained_keys(fld)
    hyd = hydro.hydro_rows(tables["hydro"], fld, keys).drop("n_usable")
    rows = catch.catch_rows(tables["counts"], keys)
    # per-haul aggregates are computed, then restricted to the kept hauls:
    # Catalyst pushes the semi join below the aggregate when the key set can
    # be broadcast, and otherwise aggregates (partially, map-side) first
    totals = physical.restrict(catch.catch_totals(catch.catch_rows(tables["counts"])), keys)
    # habitat aggregates are joined straight onto the hauls; the R9 columns
    # are derived in place from the haul's own cover texts (saves a join)
    hab_agg = habitat.habitat_aggregate(habitat.classified_rows(tables["habitat"], tables["codes"]), tables["codes"], keys)
    df = combine.left_chain(fld, [hab_agg])
    df = habitat.habitat_columns(df)
    df = combine.combine(df, None, hyd, totals, extra)
    return df, {"fld": fld, "keys": keys, "rows": rows, "totals": totals}


def com_pairs(fld: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The (bio_reference, species) pairs of the combined table, from all catch rows.

    The combined table is ``fld`` left-joined with per-haul habitat and
    chemistry (which can only repeat rows) and the catch totals (which add
    the pairs), so its pair set equals that of ``fld`` left-joined with the
    totals alone.  The length filter semi-joins against this, which keeps
    habitat and chemistry out of the length plan.  Rows are restricted first, by
    the plan that the length match begins with (``catch.kept_records``); totals
    and join take the partitioning by haul that it leaves."""
    kept = catch.kept_records(rows, keys).withColumn("bio_reference", F.expr(catch.sample_sql()))
    totals = catch.catch_totals(kept, physical.HAUL)
    hauls = physical.by_haul(fld.select("reference"))
    return combine.left_chain(hauls, [totals], physical.HAUL).select("bio_reference", "species")


def pair_repeats(com: DataFrame) -> DataFrame:
    """(sample, species) pairs that the combined table holds more than
    once; a haul with several surface readings repeats all its pairs."""
    return com.groupBy("bio_reference", "species").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def run_analysis(tables: dict[str, DataFrame], cfg: SurveyConfig,
                 extra: Sequence[DataFrame] = ()) -> Analysis:
    """The combined table, with the columns of ``extra`` after the export ones, and the length table."""
    full, parts = combined_full(tables, cfg, extra)
    com = combine.keep_export(full, [*EXPORT_VARS, *(c for x in extra for c in x.columns)])
    rows = catch.catch_rows(tables["counts"])
    lens = lengths.kept_length_dataset(rows, tables["lengths"], parts["keys"],
                                       com_pairs(parts["fld"], rows, parts["keys"]))
    return Analysis(fld=parts["fld"], keys=parts["keys"], rows=parts["rows"],
                    totals=parts["totals"], com=com, len=lens)


def checked(com: DataFrame, species_codes: DataFrame) -> DataFrame:
    """K1-K2: the combined table with scientific names."""
    return checks.with_names(com, checks.species_lookup(species_codes))


def run_checks(com: DataFrame, species_codes: DataFrame) -> dict[str, DataFrame]:
    """The QA tables."""
    chck = checked(com, species_codes)
    fish = checks.fish_rows(chck)
    gm = checks.fish_by_gear_month(fish)
    pj = checks.fish_by_project(fish)
    return {
        "check_combined_data": chck,
        "missing": checks.missing_number_or_effort(chck),
        "samples_summary": checks.samples_summary(chck),
        "fish_by_gear_month": gm,
        "fish_by_project": pj,
        "fish_by_gear_month_top50": checks.preview(gm, checks.GEAR_MONTH_ORDER),
        "fish_by_project_top50": checks.preview(pj, checks.PROJECT_ORDER),
    }


def run_enrichment(fld2: DataFrame, index: DataFrame, seagrass: DataFrame,
                   include_enrichment: bool = False) -> dict[str, DataFrame]:
    """Z3: index / seagrass checks and the enriched export."""
    joined = enrich.enrich(fld2, index, seagrass)
    return {
        "joined": joined,
        "index_check": enrich.missing_index(joined),
        "seagrass_check": enrich.missing_seagrass(joined),
        "export": enrich.enrichment_export(enrich.complete_cases(joined), include_enrichment),
    }


def habitat_summary(tables: dict[str, DataFrame], cfg: SurveyConfig) -> DataFrame:
    """The combined habitat table of the selected hauls."""
    fld = physical.physical_master(tables["hauls"], cfg)
    return habitat.habitat_combined(tables["habitat"], tables["codes"], fld,
                                    physical.retained_keys(fld))


def write_outputs(spark: SparkSession, tables: dict[str, DataFrame], cfg: SurveyConfig,
                  out_dir: str, fmt: str = "csv", extra: Sequence[DataFrame] = (),
                  lost: io.Lost | None = None) -> dict[str, str]:
    """Run Z1 - Z3 and write every output table.

    With ``lost``, the observations ``load_tables`` left, the values that
    reading lost are written as ``lost_values`` (table_name, column_name, n).

    ``com`` is written first, always as parquet too, and read back from
    there for the length filter and the QA tables: a lost executor later
    re-reads the written table instead of recomputing the whole analysis,
    and the other outputs do not depend on the export format.  Writes are
    overwrite-mode, so a retried job is idempotent."""
    a = run_analysis(tables, cfg, extra)
    paths = {}

    def write(df, name):
        path = f"{out_dir.rstrip('/')}/{name}"
        if fmt == "csv":
            io.write_survey_csv(df, path)
        else:
            io.write_table(df, path)
        paths[name] = path
        return path

    com_path = f"{out_dir.rstrip('/')}/{io.output_name(cfg, 'c', 'parquet')}"
    io.write_table(a.com, com_path)
    com = spark.read.parquet(com_path)
    if fmt == "csv":
        write(com, io.output_name(cfg, "c", fmt))
    else:
        paths[io.output_name(cfg, "c", fmt)] = com_path
    lens = lengths.kept_length_dataset(catch.catch_rows(tables["counts"]), tables["lengths"], a.keys, com)
    write(lens, io.output_name(cfg, "l", fmt))
    for name, df in run_checks(com, tables["species_codes"]).items():
        if name.endswith("top50"):
            continue
        write(df, OUTPUT_NAMES.get(name, name))
    enriched = "index" in tables and "seagrass" in tables
    if enriched:
        enr = run_enrichment(com, tables["index"], tables["seagrass"], cfg.include_enrichment)
        for name in ("index_check", "seagrass_check", "export"):
            write(enr[name], OUTPUT_NAMES[name])
    if lost is not None:
        # index and seagrass are read together or not at all
        read = {n: seen for n, seen in lost.items() if n in tables and (enriched or n not in ("index", "seagrass"))}
        rows = [(t, c, n) for t, counts in io.lost_values(read).items() for c, n in counts.items()]
        write(spark.createDataFrame(rows, "table_name string, column_name string, n bigint"), "lost_values")
    return paths
