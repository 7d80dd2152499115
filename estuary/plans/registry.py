"""Registered queries: one per operator / pipeline output, over the fixture views.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Operator
queries run with every haul retained (``ALL_HAULS``) so all branches and
the whole tables are exercised; the ``pipe_*`` queries also run the
reference's own selection (``DEFAULT``).  Doubles are rounded to 6 decimals
for the cross-engine comparison only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estuary.config import ALL_HAULS, DEFAULT, SurveyConfig
from estuary.functions import lookups as L
from estuary.functions.rsem import round_doubles
from estuary.operators import (bottom, catch, checks, combine, enrich, hydro, lengths, physical,
                               shore, vegetation)
from estuary.plans import pipeline
from estuary.sources import fixtures, io

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(fixtures.survey_tables(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


def _fld(t, cfg: SurveyConfig = ALL_HAULS) -> DataFrame:
    return physical.physical_master(t["hauls"], cfg)


def _keys(t, cfg: SurveyConfig = ALL_HAULS) -> DataFrame:
    return physical.retained_keys(_fld(t, cfg))


# ---------------------------------------------------------------- physical
@query("phys_select")
def q_phys_select(t):
    return physical.select_hauls(t["hauls"], DEFAULT)


SELECT_FROM = ALL_HAULS.with_(first_year=1995)
SELECT_UNTIL = ALL_HAULS.with_(last_year=1997)
SELECT_ZONES = ALL_HAULS.with_(zones=("A", "C", "Z1"))


@query("phys_select_from")
def q_phys_select_from(t):
    """A year range that is open at its end."""
    return physical.select_hauls(t["hauls"], SELECT_FROM)


@query("phys_select_until")
def q_phys_select_until(t):
    """A year range that is open at its start."""
    return physical.select_hauls(t["hauls"], SELECT_UNTIL)


@query("phys_select_zones")
def q_phys_select_zones(t):
    """A list of zones, one of them beyond the default limit."""
    return physical.select_hauls(t["hauls"], SELECT_ZONES)


@query("hyd_restrict_all")
def q_hyd_restrict_all(t):
    """Every haul's readings: the twin of ``hyd_restrict`` over the whole table."""
    fld = physical.physical_master(t["hauls"], ALL_HAULS)
    return physical.restrict(t["hydro"], physical.retained_keys(fld))


@query("phys_gear_group")
def q_phys_gear_group(t):
    return t["hauls"].select("reference", "gear", "stratum",
                             physical.gear_group("gear", "stratum").alias("gr"))


@query("phys_gear_group_split")
def q_phys_gear_group_split(t):
    return t["hauls"].select("reference", "gear", "stratum",
                             physical.gear_group("gear", "stratum", True).alias("gr"))


@query("phys_effort")
def q_phys_effort(t):
    return _fld(t).select("reference", "gr", "soakhr", "soakmin", "dist_tow", "effort")


@query("phys_zone_key")
def q_phys_zone_key(t):
    return t["hauls"].select("reference", "bay", "zone", physical.zone_key("bay", "zone").alias("z"))


@query("phys_slope")
def q_phys_slope(t):
    return _fld(t).select("reference", "gr", "startdepth", "wng_dpth", "enddepth", "slope")


@query("phys_master")
def q_phys_master(t):
    return _fld(t, DEFAULT)


@query("phys_master_all")
def q_phys_master_all(t):
    return _fld(t)


@query("phys_retained")
def q_phys_retained(t):
    return _keys(t, DEFAULT)


# ---------------------------------------------------------------- hydrolab
@query("hyd_restrict")
def q_hyd_restrict(t):
    return physical.restrict(t["hydro"], _keys(t, DEFAULT))


def _hyd(t):
    return physical.restrict(t["hydro"], _keys(t))


@query("hyd_mean")
def q_hyd_mean(t):
    return hydro.hydro_mean(_hyd(t))


@query("hyd_surface")
def q_hyd_surface(t):
    return hydro.hydro_surface(_hyd(t))


def _hz(t):
    h = _hyd(t)
    return hydro.hydro_with_zone(hydro.hydro_mean(h), hydro.hydro_surface(h), _fld(t))


@query("hyd_zone")
def q_hyd_zone(t):
    return _hz(t)


@query("hyd_zone_sd")
def q_hyd_zone_sd(t):
    return hydro.zone_salinity_sd(hydro.chemistry_columns(hydro.haul_chemistry(_hyd(t))).where("n_usable > 0"), _fld(t))


@query("hyd_summary")
def q_hyd_summary(t):
    fld = _fld(t)
    return hydro.hydro_summary(t["hydro"], fld, physical.retained_keys(fld))


# ---------------------------------------------------------------- bottom
def _bcat(t):
    return bottom.bottom_categories(bottom.bottom_rows(t["habitat"], _keys(t)), t["codes"])


@query("hab_bottom_rows")
def q_hab_bottom_rows(t):
    return bottom.bottom_rows(t["habitat"], _keys(t))


@query("hab_bottom_cat")
def q_hab_bottom_cat(t):
    return _bcat(t)


@query("hab_bottom_first")
def q_hab_bottom_first(t):
    return bottom.bottom_first(_bcat(t))


@query("hab_bottom_pivot")
def q_hab_bottom_pivot(t):
    return bottom.bottom_pivot(_bcat(t))


@query("hab_bottom_label")
def q_hab_bottom_label(t):
    return bottom.bottom_summary(t["habitat"], t["codes"], _keys(t))


# ---------------------------------------------------------------- vegetation
def _vcat(t):
    return vegetation.veg_categories(vegetation.veg_rows(t["habitat"], _keys(t)), t["codes"])


@query("veg_cover")
def q_veg_cover(t):
    return vegetation.veg_cover(_fld(t))


@query("veg_rows")
def q_veg_rows(t):
    return vegetation.veg_rows(t["habitat"], _keys(t))


@query("veg_cat")
def q_veg_cat(t):
    return _vcat(t)


@query("veg_dominant")
def q_veg_dominant(t):
    return vegetation.veg_dominant(vegetation.veg_rows(t["habitat"], _keys(t)), t["codes"])


def _vsums(t):
    """Sums first, then the kept hauls: what is dealt by haul and sorted is one row
    per haul x category, not every habitat row."""
    return physical.restrict(vegetation.veg_sums(vegetation.veg_categories(vegetation.veg_rows(t["habitat"]), t["codes"])), _keys(t))


@query("veg_sums")
def q_veg_sums(t):
    return _vsums(t)


@query("veg_pivot")
def q_veg_pivot(t):
    return vegetation.veg_pivot(_vsums(t))


def _vwide(t, upto):
    fld = _fld(t)
    return vegetation.finish(vegetation.veg_wide(t["habitat"], t["codes"], fld,
                                                 physical.retained_keys(fld)), upto)


@query("veg_floor")
def q_veg_floor(t):
    return _vwide(t, "floor")


@query("veg_cover_impute")
def q_veg_cover_impute(t):
    return _vwide(t, "impute")


@query("veg_weighted")
def q_veg_weighted(t):
    return _vwide(t, "weight")


@query("veg_class")
def q_veg_class(t):
    return _vwide(t, "class")


@query("veg_dominant_clean")
def q_veg_dominant_clean(t):
    return _vwide(t, "final")


@query("veg_summary")
def q_veg_summary(t):
    fld = _fld(t)
    return vegetation.vegetation_summary(t["habitat"], t["codes"], fld, physical.retained_keys(fld))


# ---------------------------------------------------------------- shore
def _scat(t):
    return shore.shore_categories(shore.shore_rows(t["habitat"], _keys(t)), t["codes"])


@query("shore_cover")
def q_shore_cover(t):
    return shore.shore_cover(_fld(t))


@query("shore_rows")
def q_shore_rows(t):
    return shore.shore_rows(t["habitat"], _keys(t))


@query("shore_cat")
def q_shore_cat(t):
    return _scat(t)


@query("shore_shares")
def q_shore_shares(t):
    return shore.shore_shares(_scat(t))


@query("shore_percents")
def q_shore_percents(t):
    return shore.shore_percents(shore.shore_shares(_scat(t)), _fld(t))


def _ssums(t):
    return physical.restrict(shore.shore_sums(shore.shore_categories(shore.shore_rows(t["habitat"]), t["codes"])), _keys(t))


@query("shore_sums")
def q_shore_sums(t):
    return _ssums(t)


@query("shore_pivot")
def q_shore_pivot(t):
    return shore.shore_pivot(_ssums(t))


@query("shore_label")
def q_shore_label(t):
    fld = _fld(t)
    return shore.shore_summary(t["habitat"], t["codes"], fld, physical.retained_keys(fld))


@query("hab_combined")
def q_hab_combined(t):
    return pipeline.habitat_summary(t, ALL_HAULS)


@query("hab_combined_default")
def q_hab_combined_default(t):
    return pipeline.habitat_summary(t, DEFAULT)


# ---------------------------------------------------------------- catch
def _counts(t):
    return physical.restrict(t["counts"], _keys(t))


@query("bio_key")
def q_bio_key(t):
    return _counts(t).select("reference", "SC", "Splitlevel",
                             catch.bio_reference("reference", "SC", "Splitlevel").alias("bio_reference"))


@query("bio_taxa")
def q_bio_taxa(t):
    df = _counts(t).select("reference", "Species_record_id", "NODCCODE",
                           catch.clean_code("NODCCODE").alias("taxon_code"))
    return df.withColumns(catch.taxon_levels("taxon_code"))


@query("bio_expand")
def q_bio_expand(t):
    return _counts(t).select("reference", "Species_record_id", "Number", "Splittype", "Splitlevel",
                             "Cells", catch.expand_count("Number", "Splittype", "Splitlevel", "Cells")
                             .alias("number_expanded"))


@query("bio_lump")
def q_bio_lump(t):
    return catch.catch_taxa(t["counts"], _keys(t)).select("reference", "Species_record_id", "genus",
                                                          "bay", "species")


@query("bio_rows")
def q_bio_rows(t):
    return catch.catch_rows(t["counts"], _keys(t))


@query("bio_totals")
def q_bio_totals(t):
    return catch.catch_totals(catch.catch_rows(t["counts"], _keys(t)))


# ---------------------------------------------------------------- lengths
def _rows(t):
    return catch.catch_rows(t["counts"], _keys(t))


@query("len_rows")
def q_len_rows(t):
    return lengths.length_rows(t["lengths"])


@query("len_matched")
def q_len_matched(t):
    return lengths.lengths_matched(_rows(t), lengths.length_rows(t["lengths"]))


def _freq(t):
    return lengths.length_frequency(lengths.lengths_matched(_rows(t), lengths.length_rows(t["lengths"])))


@query("len_freq")
def q_len_freq(t):
    return _freq(t)


@query("len_nl")
def q_len_nl(t):
    return lengths.n_measured(_freq(t))


@query("len_dataset")
def q_len_dataset(t):
    return lengths.length_dataset(_freq(t))


# ---------------------------------------------------------------- combined
@query("com_full")
def q_com_full(t):
    return pipeline.combined_full(t, ALL_HAULS)[0]


@query("com_cover")
def q_com_cover(t):
    return _fld(t).select("reference", combine.cap_cover_code("bottomvegcover").alias("bottomvegcover"))


@query("com_keep")
def q_com_keep(t):
    return combine.keep_export(pipeline.combined_full(t, ALL_HAULS)[0])


@query("com_extra")
def q_com_extra(t):
    """The combined table with a further haul table."""
    weather = t["hauls"].select("reference", (F.col("year") % 7).cast("double").alias("wind"))
    return pipeline.run_analysis(t, ALL_HAULS, extra=[weather]).com


@query("com_pair_repeats")
def q_com_pair_repeats(t):
    return pipeline.pair_repeats(pipeline.run_analysis(t, ALL_HAULS).com)


@query("pipe_com")
def q_pipe_com(t):
    return pipeline.run_analysis(t, DEFAULT).com


@query("pipe_len")
def q_pipe_len(t):
    return pipeline.run_analysis(t, DEFAULT).len


@query("len_final")
def q_len_final(t):
    return pipeline.run_analysis(t, ALL_HAULS).len


# ---------------------------------------------------------------- checks
def _chck(t, cfg=ALL_HAULS):
    return pipeline.checked(pipeline.run_analysis(t, cfg).com, t["species_codes"])


@query("qa_named")
def q_qa_named(t):
    return _chck(t)


@query("qa_missing")
def q_qa_missing(t):
    return checks.missing_number_or_effort(_chck(t))


@query("qa_labels")
def q_qa_labels(t):
    return checks.with_labels(_fld(t)).select("reference", "gr", "month", "gr_label", "month_label")


@query("qa_bay_names")
def q_qa_bay_names(t):
    return t["hauls"].select("reference", "bay", "type", L.bay_name("bay").alias("bay_name"),
                             L.type_name("type").alias("type_name"))


@query("qa_samples")
def q_qa_samples(t):
    return checks.samples_summary(_chck(t))


@query("qa_samples_default")
def q_qa_samples_default(t):
    return checks.samples_summary(_chck(t, DEFAULT))


@query("qa_project_group")
def q_qa_project_group(t):
    return checks.fish_rows(_chck(t))


@query("qa_fish_gear_month")
def q_qa_fish_gear_month(t):
    return checks.fish_by_gear_month(checks.fish_rows(_chck(t)))


@query("qa_fish_project")
def q_qa_fish_project(t):
    return checks.fish_by_project(checks.fish_rows(_chck(t)))


@query("qa_top50")
def q_qa_top50(t):
    return checks.preview(checks.fish_by_gear_month(checks.fish_rows(_chck(t))),
                          checks.GEAR_MONTH_ORDER)


@query("qa_top50_project")
def q_qa_top50_project(t):
    return checks.preview(checks.fish_by_project(checks.fish_rows(_chck(t))), checks.PROJECT_ORDER)


# ---------------------------------------------------------------- enrichment
def _enr(t):
    return enrich.enrich(pipeline.run_analysis(t, ALL_HAULS).com, t["index"], t["seagrass"])


@query("enr_join")
def q_enr_join(t):
    return _enr(t)


@query("enr_missing_index")
def q_enr_missing_index(t):
    return enrich.missing_index(_enr(t))


@query("enr_missing_sg")
def q_enr_missing_sg(t):
    return enrich.missing_seagrass(_enr(t))


@query("enr_complete")
def q_enr_complete(t):
    return enrich.complete_cases(_enr(t))


@query("enr_export")
def q_enr_export(t):
    return enrich.enrichment_export(enrich.complete_cases(_enr(t)))


@query("enr_export_all")
def q_enr_export_all(t):
    return enrich.enrichment_export(enrich.complete_cases(_enr(t)), include_enrichment=True)


# ---------------------------------------------------------------- sources
@query("append_years")
def q_append_years(t):
    h = t["hauls"]
    prev = h.where(F.col("year") < 1998).drop("TotalShoreCover")
    cur = h.where(F.col("year") >= 1998)
    return io.append_years(prev, cur)
