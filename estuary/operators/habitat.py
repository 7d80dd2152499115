"""Habitat per haul: bottom, vegetation and shore from ONE aggregate.

Each habitat row carries a bottom code, a vegetation code and a shore code.
Instead of three filtered copies of the table, each aggregated (and
pivoted) on its own and then full-joined, every row is classified once for
all three components and a single ``groupBy(reference)`` computes all
per-haul quantities with conditional aggregates.  One shuffle of partially
aggregated rows replaces five aggregates and three full outer joins; a haul
with very many habitat rows is combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.functions.rsem import num_sql, q
from estuary.operators import bottom as B
from estuary.operators import shore as S
from estuary.operators import vegetation as V
from estuary.operators.codes import BOTTOM_FIELD, SHORE_FIELD, VEG_FIELD, code_rank, codes_for, ranked_codes
from estuary.operators.physical import restrict

COMBINED_COLUMNS = ["reference", *B.BOTTOM_FLAGS, "bottom",
                    "SAV", "Alg", "Non", "HA", "TH", "RU", "bveg", "DominantVeg",
                    "Man", "Ter", "Str", "Eme", "shore", "ovr_per", "ind_per"]

# internal names of the cover columns used for weighting (kept apart from
# the haul's own ``bottomvegcover`` / ``TotalShoreCover``)
VEG_COVER, SHORE_COVER, SHARE_YEAR = "_veg_cover", "_shore_cover", "_share_year"


def _dict(codes: DataFrame, field: str, prefix: str) -> DataFrame:
    d = ranked_codes(codes, field) if field == VEG_FIELD else codes_for(codes, field)
    return d.selectExpr(*[f"{x} AS {prefix}{x}" for x in d.columns])


def classified_rows(hab: DataFrame, codes: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Every habitat row classified for all three components.

    Three left joins with the code dictionary: a map-side pipeline with no
    shuffle while the dictionary is under the broadcast threshold."""
    df = hab if keys is None else restrict(hab, keys)
    vcode = V.veg_code_sql("bottomveg")
    df = df.select(
        "reference", "bottomtype", "shoretype",
        F.expr(vcode).alias("v_code"),
        F.expr(f"{V.veg_valid_sql('bottomveg')} AND coalesce("
               f"{V.veg_keep_sql(num_sql('habitat_record_id'), vcode)}, false)").alias("v_valid"),
        F.expr(num_sql("BottomVegRatio")).alias("v_raw_ratio"),
        F.expr(num_sql("ShoreTypeRatio")).alias("s_raw_ratio"),
        F.expr(S.yes_no_sql("Inund")).alias("s_inund"), F.expr(S.yes_no_sql("`Over`")).alias("s_over"))
    bd, vd, sd = (_dict(codes, BOTTOM_FIELD, "b_"), _dict(codes, VEG_FIELD, "vd_"),
                  _dict(codes, SHORE_FIELD, "s_"))
    df = df.join(bd, df["bottomtype"] == bd["b_code"], "left")
    df = df.join(vd, df["v_code"] == vd["vd_code"], "left")
    df = df.join(sd, df["shoretype"] == sd["s_code"], "left")
    df = df.withColumns({"v_ratio": F.expr(f"CASE WHEN v_valid THEN {V.veg_ratio_sql('v_code', 'v_raw_ratio')} END"),
                         "s_ratio": F.expr(S.shore_ratio_sql("shoretype", "s_raw_ratio"))})
    df = V.with_dominant_code(df, "v_ratio", code_rank("v_code", "vd_rank", ranked_codes(codes, VEG_FIELD)), "v_top")
    return df.select(
        "reference", "v_valid",
        F.expr(B.bottom_valid_sql("bottomtype")).alias("b_valid"),
        F.expr(B.bottom_category_sql("bottomtype", "b_category")).alias("b_cat"),
        "v_ratio", "v_top",
        F.expr(V.veg_cat_sql("v_code", "vd_category")).alias("v_cat"),
        F.expr(S.shore_valid_sql("shoretype")).alias("s_valid"),
        "s_ratio",
        F.expr(S.shore_cat_sql("s_category")).alias("s_cat"),
        F.expr("CASE WHEN s_over = 'YES' THEN 1.0D ELSE 0.0D END * s_ratio").alias("s_ovr_wt"),
        F.expr("CASE WHEN s_inund = 'YES' THEN 1.0D ELSE 0.0D END * s_ratio").alias("s_ind_wt"),
    )


def habitat_aggregate(rows: DataFrame, codes: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """All per-haul habitat aggregates in one ``groupBy(reference)``.

    Rows with no usable code in any component contribute nothing and are
    dropped before the shuffle; a haul left without rows reads as NULL
    habitat either way (absent here, or present with every component
    flagged missing).

    With ``keys`` only their hauls remain: the semi join stands right on the
    aggregate, below which Catalyst moves it when the keys can be broadcast."""
    rows = rows.where("b_valid OR v_valid OR s_valid")
    found = rows.groupBy("reference").agg(
        F.expr("max(CAST(b_valid AS INT))").alias("_has_bottom"),
        F.expr("max(CAST(v_valid AS INT))").alias("_has_veg"),
        F.expr("max(CAST(s_valid AS INT))").alias("_has_shore"),
        *B.bottom_flag_aggs("b_valid", "b_cat"),
        *V.veg_sum_aggs("v_valid", "v_cat", "v_ratio"),
        V.dominant_agg("v_top").alias("_top"),
        *S.share_aggs("s_valid", "s_ratio", "s_ovr_wt", "s_ind_wt", prefix="_s_"),
        *S.shore_sum_aggs("s_valid", "s_cat", "s_ratio"),
    )
    return habitat_labels(V.dominant_names(found if keys is None else restrict(found, keys), "_top", codes))


def _present(flag: str, cols: list[str]) -> dict[str, Column]:
    """``cols`` of a component, NULL for a haul without a usable row for it (as after a full join)."""
    return {k: F.expr(f"CASE WHEN {flag} = 1 THEN {q(k)} END") for k in cols}


def habitat_labels(agg: DataFrame) -> DataFrame:
    """The bottom and shore columns, which need nothing of the haul.

    Made here, before the aggregates meet the hauls: with all of the habitat
    arithmetic behind one join its generated method was 21 kB long, and the JIT
    leaves methods over 8 kB to the interpreter."""
    df = agg.withColumns({"bottom": B.bottom_label(), **{k: S.cap(k) for k in S.SHORE_CATS}})
    df = df.withColumn("shore", S.shore_label())
    return df.withColumns({**_present("_has_bottom", [*B.BOTTOM_FLAGS, "bottom"]), **_present("_has_shore", [*S.SHORE_CATS, "shore"])})


def habitat_columns(df: DataFrame, veg_cover_raw: str = "bottomvegcover",
                    shore_cover_raw: str = "TotalShoreCover") -> DataFrame:
    """Turn the aggregates into the R9 columns, given the haul's raw cover texts.

    Components a haul has no usable row for are NULL (as after a full join).
    The haul's own cover columns are left untouched.  Each stage is one
    projection (later stages read earlier results, as sequential R mutate
    lines do)."""
    df = df.withColumns({VEG_COVER: F.expr(num_sql(q(veg_cover_raw))),
                         SHORE_COVER: F.expr(num_sql(q(shore_cover_raw))),
                         SHARE_YEAR: F.expr(S.ref_year_sql())})
    df = V.finish(df.withColumn(VEG_COVER, F.expr(V.full_cover_sql(VEG_COVER))), cover=VEG_COVER)
    ovr = S.share_sql("_s_ovr_wt1", "_s_str", year=SHARE_YEAR)
    ind = S.share_sql("_s_ind_wt1", "_s_str", year=SHARE_YEAR)
    df = df.withColumns({"ovr_per": F.expr(S.percent_sql(SHORE_COVER, ovr, year=SHARE_YEAR)),
                         "ind_per": F.expr(S.percent_sql(SHORE_COVER, ind, year=SHARE_YEAR))})
    df = df.withColumns({**_present("_has_veg", [*V.VEG_CATS, "bveg", "DominantVeg"]), **_present("_has_shore", ["ovr_per", "ind_per"])})
    internal = [x for x in df.columns if x.startswith("_")]
    return df.drop(*internal)


def habitat_combined(hab: DataFrame, codes: DataFrame, fld: DataFrame,
                     keys: DataFrame | None = None) -> DataFrame:
    """One row per haul with any usable bottom, vegetation or shore row."""
    # restrict the rows first: the component filter below would sit between
    # a later semi join and the aggregate and keep Catalyst from moving it
    agg = habitat_aggregate(classified_rows(hab, codes, keys), codes)
    agg = agg.where((F.col("_has_bottom") == 1) | (F.col("_has_veg") == 1) | (F.col("_has_shore") == 1))
    covers = fld.select("reference", F.col("bottomvegcover").alias("_raw_vc"),
                        F.col("TotalShoreCover").alias("_raw_sc"))
    df = agg.join(covers, "reference", "left")
    return habitat_columns(df, "_raw_vc", "_raw_sc").select(*COMBINED_COLUMNS)
