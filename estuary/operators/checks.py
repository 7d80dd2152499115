"""Data-quality tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.functions import lookups as L
from estuary.functions.rsem import ColumnOrName, c, in_set, keep_existing

MISSING_COLUMNS = ["reference", "historic_reference", "gr", "effort", "number", "cf"]


def species_lookup(species_codes: DataFrame) -> DataFrame:
    """K1: distinct (species, scientificname) on the 10-character code."""
    return (species_codes.select(F.substring("NODCCODE", 1, 10).alias("species"),
                                 F.col("Scientificname").alias("scientificname"))
                         .distinct())


def with_names(com: DataFrame, spp: DataFrame) -> DataFrame:
    """K2: attach scientific names (null-safe on species; a code with two
    names fans out, as a left join does).  The size of the name table in
    bytes, measured at run time if need be, decides how it is joined."""
    s = spp.withColumnRenamed("species", "_sp")
    return com.join(s, com["species"].eqNullSafe(s["_sp"]), "left").drop("_sp")


def missing_number_or_effort(chck: DataFrame) -> DataFrame:
    """K3: rows with no number or no effort (existing report columns only)."""
    return keep_existing(chck.where(F.col("number").isNull() | F.col("effort").isNull()),
                         MISSING_COLUMNS)


def project_group(p1: ColumnOrName = "Project_1", p2: ColumnOrName = "Project_2",
                  p3: ColumnOrName = "Project_3") -> Column:
    """K7: project group from any of the three project codes (first match wins)."""
    ps = [c(p1), c(p2), c(p3)]
    expr = None
    for codes, label in L.PROJECT_GROUPS:
        cond = in_set(ps[0], codes) | in_set(ps[1], codes) | in_set(ps[2], codes)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(L.PROJECT_OTHER))


def with_labels(df: DataFrame) -> DataFrame:
    """K4: gear and month labels (unknown codes -> NULL)."""
    return df.withColumns({"gr_label": L.gear_label("gr"), "month_label": L.month_label("month")})


def samples_summary(chck: DataFrame) -> DataFrame:
    """K6: collections per gear label x year x month label.

    A haul counts once: first the (label, year, month, haul) keys are made
    distinct, then counted -- two partial-aggregating stages instead of a
    per-haul window, so no group is ever gathered into one task."""
    per_haul = with_labels(chck).select("gr_label", "year", "month_label", "reference").distinct()
    return per_haul.groupBy("gr_label", "year", "month_label").agg(
        F.count(F.lit(1)).alias("n_collections"))


def fish_rows(chck: DataFrame) -> DataFrame:
    """K7: catch rows other than the "no fish" code, labelled, with project group."""
    df = chck.where(F.col("species") != L.NO_FISH_CODE)
    return with_labels(df).withColumn("px", project_group())


def fish_by_gear_month(fish: DataFrame) -> DataFrame:
    """K8: fish per gear label x year x month label x scientific name."""
    return fish.groupBy("gr_label", "year", "month_label", "scientificname").agg(
        F.coalesce(F.sum("number"), F.lit(0.0)).alias("total_number"))


def fish_by_project(fish: DataFrame) -> DataFrame:
    """K9: fish per project group x year x scientific name."""
    return fish.groupBy("px", "year", "scientificname").agg(
        F.coalesce(F.sum("number"), F.lit(0.0)).alias("total_number"))


def preview(df: DataFrame, order: list[str], n: int = 50) -> DataFrame:
    """First ``n`` rows in ``order`` (NULLs last).  ``orderBy().limit()``
    plans as TakeOrderedAndProject: each task keeps its own top n, only
    those reach the final merge."""
    return df.orderBy(*[F.col(o).asc_nulls_last() for o in order]).limit(n)


GEAR_MONTH_ORDER = ["gr_label", "year", "scientificname", "month_label"]
PROJECT_ORDER = ["px", "scientificname", "year"]
