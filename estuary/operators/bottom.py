"""Habitat: bottom type per haul."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.functions import lookups as L
from estuary.functions.rsem import label_at, names_sql, num, q, sql_lit
from estuary.operators.codes import BOTTOM_FIELD, codes_for
from estuary.operators.physical import restrict

# Bottom presence flags, and the bottom label for each flag
# combination (bmud, bsan, bstr, bunk) in matching order.  Four of the 16
# combinations have no label and give NULL.
BOTTOM_FLAGS = ["bmud", "bsan", "bstr", "bunk"]
BOTTOM_LABELS = [
    ((1, 1, 1, 1), "MudSanStrUnk"),
    ((1, 1, 1, 0), "MudSanStr"),
    ((1, 1, 0, 0), "MudSan"),
    ((1, 0, 1, 0), "MudStr"),
    ((1, 0, 0, 1), "MudUnk"),
    ((1, 0, 0, 0), "Mud"),
    ((0, 1, 0, 0), "San"),
    ((0, 1, 1, 0), "SanStr"),
    ((0, 1, 1, 1), "SanStrUnk"),
    ((0, 0, 1, 0), "Str"),
    ((0, 0, 1, 1), "StrUnk"),
    ((0, 0, 0, 1), "Unk"),
]


def bottom_valid_sql(code: str) -> str:
    return f"({code} IS NOT NULL AND {code} NOT IN ({names_sql(L.BOTTOM_DROP)}))"


def bottom_valid(code: str) -> Column:
    """Usable bottom code: present and not a placeholder."""
    return F.expr(bottom_valid_sql(q(code)))


def bottom_category_sql(code: str, category: str) -> str:
    return (f"CASE WHEN {code} = {sql_lit(L.BOTTOM_UNKNOWN)} THEN 'bUnk' "
            f"ELSE concat('b', coalesce(substring({category}, 1, 3), 'NA')) END")


def bottom_category(code: str, category: str) -> Column:
    """'b' + first three letters of the category ("bNA" without one); code 'U' -> bUnk."""
    return F.expr(bottom_category_sql(q(code), q(category)))


def bottom_rows(hab: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """B2: kept habitat rows with a usable bottom code; record id as number."""
    df = hab if keys is None else restrict(hab, keys)
    return (df.where(bottom_valid("bottomtype"))
              .select("reference", num("habitat_record_id").alias("habitat_record_id"),
                      F.col("bottomtype").alias("code")))


def bottom_categories(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Category per row; record id reversed into a rank 6..1."""
    df = rows.join(codes_for(codes, BOTTOM_FIELD), "code", "left")
    rid = F.col("habitat_record_id")
    rank = (F.when(rid == 1, 6.0).when(rid == 2, 5.0).when(rid == 3, 4.0)
             .when(rid == 4, 3.0).when(rid == 5, 2.0).when(rid >= 6, 1.0).otherwise(rid))
    return df.select("reference", rank.alias("habitat_record_id"), "code", "description",
                     "category", bottom_category("code", "category").alias("bottom_cat"))


def bottom_first(cats: DataFrame) -> DataFrame:
    """One row per (haul, category) with k = 1 (the first code in code order)."""
    return (cats.groupBy("reference", "bottom_cat")
                .agg(F.min("code").alias("code"))
                .withColumn("k", F.lit(1)))


def bottom_flag_aggs(valid: str | None = None, cat: str = "bottom_cat") -> list[Column]:
    """Per-haul presence flags as conditional aggregates (one pass, no pivot job).

    Flags match the category case-insensitively (bMud -> bmud), whatever the
    letter case the code dictionary stores.  ``valid`` names a boolean
    column restricting the rows that count."""
    guard = f"{q(valid)} AND " if valid else ""
    return [F.expr(f"max(CASE WHEN {guard}lower({q(cat)}) = '{f}' THEN 1 ELSE 0 END)").alias(f)
            for f in BOTTOM_FLAGS]


def bottom_pivot(cats: DataFrame) -> DataFrame:
    """Presence pivot, one row per haul, absent flags filled with 0."""
    return cats.groupBy("reference").agg(*bottom_flag_aggs())


def bottom_label(bmud: str = "bmud", bsan: str = "bsan", bstr: str = "bstr",
                 bunk: str = "bunk") -> Column:
    """Bottom label from the four flags (NULL for unlabelled combinations)."""
    flags = [q(bmud), q(bsan), q(bstr), q(bunk)]
    return label_at(flags, [f"{f} IN (0, 1)" for f in flags], dict(BOTTOM_LABELS))


def bottom_summary(hab: DataFrame, codes: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(reference, bmud, bsan, bstr, bunk, bottom) for hauls with a bottom code."""
    piv = bottom_pivot(bottom_categories(bottom_rows(hab, keys), codes))
    return piv.select("reference", *BOTTOM_FLAGS, bottom_label().alias("bottom"))
