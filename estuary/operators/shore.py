"""Habitat: shoreline per haul."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.functions import lookups as L
from estuary.functions.rsem import label_at, names_sql, num, num_sql, pivot_fill, q, sql_lit
from estuary.operators.codes import SHORE_FIELD, codes_for
from estuary.operators.physical import restrict

# Shore categories (pivot columns) and the shore label for
# each presence pattern (Man, Eme, Str, Ter) in matching order.
SHORE_CATS = ["Man", "Ter", "Str", "Eme"]
RATIO_SUM = "DECIMAL(38, 12)"
SHORE_LABELS = [
    ((1, 0, 0, 0), "Man"),
    ((0, 1, 0, 0), "Eme"),
    ((0, 0, 1, 0), "Str"),
    ((0, 0, 0, 1), "Ter"),
    ((0, 0, 0, 0), "Non"),
    ((1, 1, 0, 0), "ManEme"),
    ((1, 0, 1, 0), "ManStr"),
    ((1, 0, 0, 1), "ManTer"),
    ((1, 1, 1, 0), "ManEmeStr"),
    ((1, 0, 1, 1), "ManStrTer"),
    ((1, 1, 0, 1), "ManEmeTer"),
    ((1, 1, 1, 1), "ManEmeStrTer"),
    ((0, 1, 1, 0), "EmeStr"),
    ((0, 1, 0, 1), "EmeTer"),
    ((0, 1, 1, 1), "EmeStrTer"),
    ((0, 0, 1, 1), "StrTer"),
]


def shore_cover(fld: DataFrame) -> DataFrame:
    """(reference, TotalShoreCover) as a number."""
    return fld.select("reference", num("TotalShoreCover").alias("TotalShoreCover"))


def shore_valid_sql(code: str) -> str:
    return f"({code} IS NOT NULL AND {code} NOT IN ({names_sql(L.SHORE_DROP)}))"


def shore_valid(code: str) -> Column:
    return F.expr(shore_valid_sql(q(code)))


def shore_ratio_sql(code: str, ratio: str) -> str:
    return (f"CASE WHEN {code} <> {sql_lit(L.VEG_NONE)} AND ({ratio} IS NULL OR {ratio} = 0) "
            f"THEN 0.1D ELSE {ratio} END")


def yes_no_sql(x: str) -> str:
    """'1'..'10' or 'YES' -> 'YES', anything else (NULL included) -> 'NO'."""
    return f"CASE WHEN {x} IN ({names_sql(L.YES_VALUES)}) THEN 'YES' ELSE 'NO' END"


def yes_no(x: str) -> Column:
    return F.expr(yes_no_sql(q(x)))


def shore_rows(hab: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """R2: cleaned shore rows."""
    df = hab if keys is None else restrict(hab, keys)
    df = df.where(shore_valid("shoretype"))
    extra = ["level"] if "level" in df.columns else []
    return df.select("reference", num("habitat_record_id").alias("habitat_record_id"),
                     F.col("shoretype").alias("code"),
                     F.expr(shore_ratio_sql("shoretype", num_sql("ShoreTypeRatio")))
                      .alias("ShoreTypeRatio"),
                     yes_no("Inund").alias("Inund"), yes_no("Over").alias("Over"), *extra)


def shore_cat_sql(category: str) -> str:
    return (f"CASE WHEN {category} IS NULL THEN NULL WHEN {category} = {sql_lit(L.MANMADE)} "
            f"THEN 'Str' ELSE substring({category}, 1, 3) END")


def shore_cat(category: str) -> Column:
    """First three letters of the category; man-made shores count as structure."""
    return F.expr(shore_cat_sql(q(category)))


def shore_categories(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Category, overhang / inundation flags and their ratio weights."""
    df = rows.join(codes_for(codes, SHORE_FIELD), "code", "left")
    inr = F.when(F.col("Inund") == "YES", 1.0).otherwise(0.0)
    ovr = F.when(F.col("Over") == "YES", 1.0).otherwise(0.0)
    df = df.withColumns({"shore_cat": shore_cat("category"), "inr": inr, "ovr": ovr})
    return df.withColumns({"ovr_wt": F.col("ovr") * F.col("ShoreTypeRatio"),
                           "ind_wt": F.col("inr") * F.col("ShoreTypeRatio")})


def ref_year_sql(reference: str = "reference") -> str:
    """Survey year from characters 4-7 of the haul key."""
    return num_sql(f"substring({q(reference)}, 4, 4)")


def share_sql(weighted: str, total: str, reference: str = "reference", year: str | None = None) -> str:
    y = year or ref_year_sql(reference)
    return (f"CASE WHEN {y} IS NULL OR {y} < {L.SHARE_FIRST_YEAR} THEN CAST(NULL AS DOUBLE) "
            f"ELSE bround(try_divide({weighted}, {total}), 3) END")


def share(weighted: str, total: str, reference: str = "reference") -> Column:
    """Weighted share, 3 decimals with ties to even; NULL before the first year shares were recorded."""
    return F.expr(share_sql(q(weighted), q(total), reference))


def percent_sql(cover: str, share_expr: str, reference: str = "reference", year: str | None = None) -> str:
    return (f"CASE WHEN {year or ref_year_sql(reference)} >= {L.SHARE_FIRST_YEAR} "
            f"THEN {cover} * {share_expr} ELSE CAST(NULL AS DOUBLE) END")


def percent(cover: str, share_col: str, reference: str = "reference") -> Column:
    return F.expr(percent_sql(q(cover), q(share_col), reference))


def share_aggs(valid: str | None, ratio: str, ovr_wt: str, ind_wt: str,
               prefix: str = "") -> list[Column]:
    """Sums of the ratios and of their weighted parts, as decimals: the order in which rows
    meet cannot move a share across the third decimal."""
    guard = (lambda x: f"CASE WHEN {q(valid)} THEN {q(x)} END") if valid else q
    return [F.expr(f"CAST(coalesce(sum(try_cast({guard(x)} AS {RATIO_SUM})), 0) AS DOUBLE)").alias(prefix + name)
            for x, name in ((ratio, "str"), (ovr_wt, "ovr_wt1"), (ind_wt, "ind_wt1"))]


def shore_shares(cats: DataFrame) -> DataFrame:
    """(reference, ovr_wtf, ind_wtf): overhanging / inundated share per haul."""
    agg = cats.groupBy("reference").agg(*share_aggs(None, "ShoreTypeRatio", "ovr_wt", "ind_wt"))
    return agg.select("reference", share("ovr_wt1", "str").alias("ovr_wtf"),
                      share("ind_wt1", "str").alias("ind_wtf"))


def shore_percents(shares: DataFrame, fld: DataFrame) -> DataFrame:
    """Shares times total shore cover, from the first share year on."""
    df = shares.join(shore_cover(fld), "reference", "left")
    return df.select("reference", "ovr_wtf", "ind_wtf",
                     percent("TotalShoreCover", "ovr_wtf").alias("ovr_per"),
                     percent("TotalShoreCover", "ind_wtf").alias("ind_per"))


def shore_sums(cats: DataFrame) -> DataFrame:
    """Summed ratio per haul x category."""
    return (cats.groupBy("reference", "shore_cat")
                .agg(F.coalesce(F.sum("ShoreTypeRatio"), F.lit(0.0)).alias("count")))


def shore_pivot(sums: DataFrame) -> DataFrame:
    """Wide table Man / Ter / Str / Eme, absent cells 0."""
    return pivot_fill(sums, "reference", "shore_cat", "count", SHORE_CATS)


def shore_sum_aggs(valid: str | None, cat: str, ratio: str) -> list[Column]:
    """R6+R7 fused: per-haul category sums as conditional aggregates."""
    guard = f"{q(valid)} AND " if valid else ""
    return [F.expr(f"coalesce(sum(CASE WHEN {guard}{q(cat)} = '{k}' THEN {q(ratio)} END), 0.0D)").alias(k)
            for k in SHORE_CATS]


def cap(x: str) -> Column:
    v = q(x)
    return F.expr(f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} > {L.SHORE_CAP}D THEN {L.SHORE_CAP}D ELSE {v} END")


def shore_label(Man: str = "Man", Eme: str = "Eme", Str: str = "Str", Ter: str = "Ter") -> Column:
    """16-way shore label from category presence."""
    cols = [q(Man), q(Eme), q(Str), q(Ter)]
    return label_at([f"CAST({x} > 0 AS INT)" for x in cols], [f"{x} >= 0" for x in cols], dict(SHORE_LABELS))


def shore_labelled(wide: DataFrame, fld: DataFrame) -> DataFrame:
    """R8 on a wide table: cap at 10, label, attach total shore cover."""
    df = wide.join(shore_cover(fld), "reference", "left")
    df = df.withColumns({k: cap(k) for k in SHORE_CATS})
    return df.select("reference", *SHORE_CATS, shore_label().alias("shore"), "TotalShoreCover")


def shore_summary(hab: DataFrame, codes: DataFrame, fld: DataFrame,
                  keys: DataFrame | None = None) -> DataFrame:
    """(reference, Man, Ter, Str, Eme, shore, TotalShoreCover)."""
    cats = shore_categories(shore_rows(hab, keys), codes)
    wide = cats.groupBy("reference").agg(*shore_sum_aggs(None, "shore_cat", "ShoreTypeRatio"))
    return shore_labelled(wide, fld)
