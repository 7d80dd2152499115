"""Habitat: bottom vegetation per haul."""

from __future__ import annotations

import struct
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.functions import lookups as L
from estuary.functions.rsem import case_expr, names_sql, num, num_sql, pivot_fill, q, sql_lit, with_order_code
from estuary.operators.codes import VEG_FIELD, code_rank, codes_for, ranked_codes
from estuary.operators.physical import restrict

# Vegetation categories (pivot columns, export order) and the
# ones that count as "vegetation present" for the cover rules.
VEG_CATS = ["SAV", "Alg", "Non", "HA", "TH", "RU"]
VEG_PRESENT = ["SAV", "Alg", "TH", "HA", "RU"]
DOMINANT_MIN_RATIO = 5.0
_RANKS = 1 << 32
_MIN_ORDER = struct.unpack("q", struct.pack("d", DOMINANT_MIN_RATIO))[0]  # its ``with_order_code``


def veg_cover(fld: DataFrame) -> DataFrame:
    """V1: (reference, bottomvegcover) as a number, the 101 code counted as 1."""
    return fld.select("reference", cover_for_weights("bottomvegcover").alias("bottomvegcover"))


def cover_for_weights(x: str) -> Column:
    return F.expr(full_cover_sql(num_sql(q(x))))


def full_cover_sql(v: str) -> str:
    return f"CASE WHEN {v} = {L.COVER_FULL_CODE} THEN 1.0D ELSE {v} END"


def veg_valid_sql(code: str) -> str:
    return f"({code} IS NOT NULL AND {code} NOT IN ({names_sql(L.VEG_DROP)}))"


def veg_valid(code: str) -> Column:
    return F.expr(veg_valid_sql(q(code)))


def veg_code_sql(code: str) -> str:
    """Unknown vegetation (UN) is recorded as none (NO)."""
    return f"CASE WHEN {code} = {sql_lit(L.VEG_UNKNOWN)} THEN {sql_lit(L.VEG_NONE)} ELSE {code} END"


def veg_code(code: str) -> Column:
    return F.expr(veg_code_sql(q(code)))


def veg_ratio_sql(code: str, ratio: str) -> str:
    """No vegetation counts 10; a missing or zero ratio counts 0.1."""
    no = sql_lit(L.VEG_NONE)
    return (f"CASE WHEN {code} = {no} THEN 10.0D "
            f"WHEN {code} <> {no} AND ({ratio} IS NULL OR {ratio} = 0) THEN 0.1D ELSE {ratio} END")


def veg_ratio(code: str, ratio: str) -> Column:
    return F.expr(veg_ratio_sql(q(code), q(ratio)))


def veg_keep_sql(rid: str, code: str) -> str:
    """'No vegetation' is only kept on the first habitat record (3-valued, as R filters)."""
    return f"NOT ({rid} >= 2 AND {code} = {sql_lit(L.VEG_NONE)})"


def veg_rows(hab: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """V2: cleaned vegetation rows (reference, code, BottomVegRatio)."""
    df = hab if keys is None else restrict(hab, keys)
    df = df.where(veg_valid("bottomveg")).select(
        "reference", veg_code("bottomveg").alias("code"),
        num("habitat_record_id").alias("rid"), num("BottomVegRatio").alias("ratio"))
    df = df.where(F.expr(veg_keep_sql("rid", "code")))
    return df.select("reference", "code", veg_ratio("code", "ratio").alias("BottomVegRatio"))


def veg_cat_sql(code: str, category: str) -> str:
    return (f"CASE WHEN {code} IN ({names_sql(L.VEG_SPECIES_CODES)}) THEN {code} "
            f"ELSE substring({category}, 1, 3) END")


def veg_cat(code: str, category: str) -> Column:
    """First three letters of the category; the three seagrass species keep their code."""
    return F.expr(veg_cat_sql(q(code), q(category)))


def veg_categories(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """V3: rows with description, category and ``bveg_cat``."""
    df = rows.join(codes_for(codes, VEG_FIELD), "code", "left")
    return df.withColumn("bveg_cat", veg_cat("code", "category"))


def with_dominant_code(df: DataFrame, ratio: str, rank: Column, name: str) -> DataFrame:
    """V4's order as one number: the greatest is the row first by (ratio desc, code asc).

    A number, unlike a row of texts, is a hash aggregate's buffer, so the
    pick costs no sort of the habitat rows and is combined map-side.
    """
    df = with_order_code(df, ratio, "_order").withColumn("_rank", rank)
    code = F.col("_order").cast("decimal(20,0)") * F.lit(_RANKS) + (F.lit(_RANKS - 1) - F.col("_rank"))
    return df.withColumn(name, code.cast("decimal(38,0)")).drop("_order", "_rank")


def dominant_agg(code: str, where: str | None = None) -> Column:
    return F.expr(f"max(CASE WHEN {q(where)} THEN {q(code)} END)" if where else f"max({q(code)})")


def dominant_names(df: DataFrame, top: str, codes: DataFrame) -> DataFrame:
    """V4: ``DominantVeg`` for ``top``, the greatest ``with_dominant_code`` of each row: its
    description when the ratio exceeds 5 (NULL for a code that is not listed), else "SAV"."""
    ranked = ranked_codes(codes, VEG_FIELD).select(F.col("rank").alias("_dom_rank"), F.col("description").alias("_dom_name"))
    rank = F.lit(_RANKS - 1) - F.pmod(F.col(top), F.lit(_RANKS).cast("decimal(38,0)")).cast("bigint")
    least = F.lit(Decimal((_MIN_ORDER + 1) * _RANKS))
    df = df.join(ranked, rank == F.col("_dom_rank"), "left")
    name = F.when(F.col(top) >= least, F.col("_dom_name")).when(F.col(top).isNotNull(), F.lit("SAV"))
    return df.withColumn("DominantVeg", name).drop(top, "_dom_rank", "_dom_name")


def veg_ranked(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """V3 with ``top``, each row's place in V4's order."""
    ranked = ranked_codes(codes, VEG_FIELD)
    df = rows.join(ranked, "code", "left").withColumn("bveg_cat", veg_cat("code", "category"))
    return with_dominant_code(df, "BottomVegRatio", code_rank("code", "rank", ranked), "top")


def veg_dominant(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """V4: (reference, DominantVeg) of the vegetation rows."""
    tops = veg_ranked(rows, codes).groupBy("reference").agg(dominant_agg("top").alias("top"))
    return dominant_names(tops, "top", codes)


def veg_sums(cats: DataFrame) -> DataFrame:
    """V5: summed ratio per haul x category (a NULL category is its own group)."""
    return (cats.groupBy("reference", "bveg_cat")
                .agg(F.coalesce(F.sum("BottomVegRatio"), F.lit(0.0)).alias("k")))


def veg_pivot(sums: DataFrame) -> DataFrame:
    """V6-V7: wide table, one column per category, absent cells 0."""
    return pivot_fill(sums, "reference", "bveg_cat", "k", VEG_CATS)


def veg_sum_aggs(valid: str | None, cat: str, ratio: str) -> list[Column]:
    """V5+V6 fused: per-haul category sums as conditional aggregates."""
    guard = f"{q(valid)} AND " if valid else ""
    return [F.expr(f"coalesce(sum(CASE WHEN {guard}{q(cat)} = '{k}' THEN {q(ratio)} END), 0.0D)").alias(k)
            for k in VEG_CATS]


def presence_floor(x: str) -> Column:
    """V8: ratios in (0, 1) and the 101 code count as presence (1)."""
    v = q(x)
    return F.expr(f"CASE WHEN ({v} > 0 AND {v} < 1) OR {v} = {L.COVER_FULL_CODE} THEN 1.0D ELSE {v} END")


def impute_cover(cover: str, present: list[str]) -> Column:
    """V9: a negative cover becomes 1 when any vegetation is present, 0 when none."""
    cv = q(cover)
    anyp = f"greatest({', '.join(map(q, present))}) > 0" if len(present) > 1 else f"{q(present[0])} > 0"
    nonep = " AND ".join(f"{q(p)} = 0" for p in present)
    return F.expr(f"CASE WHEN {cv} < 0 AND ({anyp}) THEN 1.0D "
                  f"WHEN {cv} < 0 AND {nonep} THEN 0.0D ELSE {cv} END")


def veg_class(SAV="SAV", Alg="Alg", Non="Non", TH="TH", HA="HA", RU="RU") -> Column:
    """Vegetation class of the haul (8 rules, first match wins)."""
    sav, alg, non, th, ha, ru = (q(x) for x in (SAV, Alg, Non, TH, HA, RU))
    seagrass = [sav, th, ha, ru]
    # the place of (algae, none) among 00, 01, 10, 11; arrays keep the generated method short
    at = f"CASE WHEN {alg} >= 0 AND {non} >= 0 THEN CAST({alg} > 0 AS INT) * 2 + CAST({non} > 0 AS INT) END"
    return case_expr([
        (f"greatest({', '.join(seagrass)}) > 0", f"get(array('SAV', 'SAVNon', 'SAVAlg', 'SAVAlgNon'), {at})"),
        (" AND ".join(f"{x} = 0" for x in seagrass), f"get(array('Non', 'Non', 'Alg', 'AlgNon'), {at})"),
        (f"({' OR '.join(f'{x} = 0' for x in seagrass)}) AND {alg} > 0 AND {non} > 0", "'AlgNon'"),
    ], "CAST(NULL AS STRING)")


def clean_dominant(dom: str, bveg: str) -> Column:
    """V13: "Mixed" takes the class; algae, Halophila and mixed seagrass names are pooled."""
    d = q(dom)
    pooled = {n: to for names, to in ((L.SEAGRASS_NAMES, "SAV"), (L.HALOPHILA_NAMES, "Halophila spp."), (L.ALGAE_NAMES, "Algae")) for n in names}
    names = ", ".join(f"{sql_lit(n)}, {sql_lit(to)}" for n, to in pooled.items())
    return F.expr(f"CASE WHEN {d} = {sql_lit(L.MIXED)} THEN {q(bveg)} ELSE coalesce(try_element_at(map({names}), {d}), {d}) END")


# The finishing stages, applied in order: each stage reads the previous
# stage's results (later R mutate lines see earlier ones).  Each is one
# ``withColumns`` so shared sub-expressions are computed once per stage.
def stage_floor(df: DataFrame) -> DataFrame:
    return df.withColumns({k: presence_floor(k) for k in VEG_PRESENT})


def stage_impute(df: DataFrame, cover: str = "bottomvegcover") -> DataFrame:
    return df.withColumn(cover, impute_cover(cover, VEG_PRESENT))


def stage_weight(df: DataFrame, cover: str = "bottomvegcover") -> DataFrame:
    return df.withColumns({k: F.expr(f"{q(k)} / 10.0D * {q(cover)}") for k in VEG_CATS})


def stage_class(df: DataFrame) -> DataFrame:
    return df.withColumn("bveg", veg_class())


def stage_final(df: DataFrame) -> DataFrame:
    return df.withColumns({
        # ifelse(bveg == "Non", 0, Non): a NULL class gives NULL
        "Non": F.expr("CASE WHEN bveg IS NULL THEN NULL WHEN bveg = 'Non' THEN 0.0D ELSE Non END"),
        "DominantVeg": clean_dominant("DominantVeg", "bveg"),
    })


FINISH_STAGES = [("floor", stage_floor), ("impute", stage_impute), ("weight", stage_weight),
                 ("class", stage_class), ("final", stage_final)]


def finish(df: DataFrame, upto: str = "final", cover: str = "bottomvegcover") -> DataFrame:
    """Apply V8..V13 up to and including stage ``upto``."""
    for name, fn in FINISH_STAGES:
        df = fn(df, cover) if name in ("impute", "weight") else fn(df)
        if name == upto:
            break
    return df


def veg_wide(hab: DataFrame, codes: DataFrame, fld: DataFrame,
             keys: DataFrame | None = None) -> DataFrame:
    """V2-V7: per haul category sums, cover for weighting and dominant name.

    One aggregate over the vegetation rows yields the six sums and the
    dominant row together; the cover is one left join on ``reference``."""
    agg = veg_ranked(veg_rows(hab, keys), codes).groupBy("reference").agg(
        *veg_sum_aggs(None, "bveg_cat", "BottomVegRatio"), dominant_agg("top").alias("top"))
    return dominant_names(agg, "top", codes).join(veg_cover(fld), "reference", "left")


def vegetation_summary(hab: DataFrame, codes: DataFrame, fld: DataFrame,
                       keys: DataFrame | None = None) -> DataFrame:
    """(reference, SAV, Alg, Non, HA, TH, RU, bveg, DominantVeg)."""
    df = finish(veg_wide(hab, codes, fld, keys))
    return df.select("reference", *VEG_CATS, "bveg", "DominantVeg")
