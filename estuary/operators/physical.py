"""Haul selection and physical variables (gear group, effort, zone key, slope)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.config import SurveyConfig
from estuary.functions import lookups as L
from estuary.functions.rsem import ColumnOrName, case_expr, paste0, q, sql_lit, tail_first


def _both_cases(code: str) -> list[str]:
    return sorted({code, code.lower(), code.upper()})


def _in(col: str, values) -> str:
    """``col %in% values`` as a filter term; an empty set keeps no row."""
    values = list(values)
    return f"{q(col)} IN ({', '.join(sql_lit(v) for v in values)})" if values else "false"


def selection_predicate(cfg: SurveyConfig) -> Column | None:
    """Bay, type, year, project and zone filters as one conjunction.

    Written as plain comparisons / IN lists on stored columns so Catalyst
    pushes every term into the parquet scan (``upper(bay) = ...`` would not
    push; ``bay IN ('tb', 'TB')`` does).  A filter drops NULL and FALSE
    alike, so a missing project code is simply not in the set.  A year range
    may be open at either end; reversed years and empty sets keep no row.
    """
    terms: list[str] = []
    if cfg.bay is not None:
        terms.append(_in("bay", _both_cases(cfg.bay)))
    if cfg.sampling_type is not None:
        terms.append(_in("type", _both_cases(cfg.sampling_type)))
    if cfg.first_year is not None:
        terms.append(f"year >= {sql_lit(cfg.first_year)}")
    if cfg.last_year is not None:
        terms.append(f"year <= {sql_lit(cfg.last_year)}")
    if cfg.project_set is not None:
        ps = cfg.project_set
        terms.append("(" + " OR ".join(_in(p, ps) for p in ("Project_1", "Project_2", "Project_3")) + ")")
    if cfg.zones is not None:
        terms.append(_in("zone", cfg.zones))
    elif cfg.max_zone is not None:
        terms.append(f"zone <= {sql_lit(cfg.max_zone)}")
    return F.expr(" AND ".join(terms)) if terms else None


def select_hauls(hauls: DataFrame, cfg: SurveyConfig) -> DataFrame:
    """Keep the hauls of the configured bay, type, years, projects and zones."""
    pred = selection_predicate(cfg)
    return hauls if pred is None else hauls.where(pred)


def gear_group(gear: str = "gear", stratum: str = "stratum",
               split_shore_stratum: bool = False) -> Column:
    """Combine gear codes into gear groups (INT; NULL when unknown).

    With ``split_shore_stratum`` a gear-20 haul in stratum 'S' becomes group
    19 (beach stratum); otherwise the first matching group (20) wins.
    """
    g, s = q(gear), q(stratum)
    branches = []
    shore = (f"{g} = {L.SHORE_STRATUM_GEAR} AND {s} = '{L.SHORE_STRATUM}'", str(L.SHORE_STRATUM_GROUP))
    if split_shore_stratum:
        branches.append(shore)
    for group, members, ranges in L.GEAR_GROUPS:
        terms = []
        if members:
            terms.append(f"{g} IN ({', '.join(map(str, members))})")
        terms += [f"({g} >= {lo} AND {g} <= {hi})" for lo, hi in ranges]
        branches.append((" OR ".join(terms), str(group)))
    return case_expr(branches).cast("int")


def effort_100m2(gr: str = "gr", soakhr: str = "soakhr", soakmin: str = "soakmin",
                 dist_tow: str = "dist_tow") -> Column:
    """Sampling effort in 100 m2 (gillnets: soak hours; trawls: tow area)."""
    g = q(gr)
    branches = [(f"{g} IN ({', '.join(map(str, groups))})", f"CAST({value!r} AS DOUBLE)")
                for groups, value in L.EFFORT_CONSTANT.items()]
    branches.append((f"{g} = {L.GILLNET_GROUP}", f"{q(soakhr)} + {q(soakmin)} / 60.0D"))
    branches.append((f"{g} = {L.TRAWL_GROUP}",
                     f"({q(dist_tow)} * {L.TRAWL_WIDTH_M} * {L.METRES_PER_NAUTICAL_MILE}) / 100.0D"))
    return case_expr(branches).cast("double")


def zone_key(bay: ColumnOrName, zone: ColumnOrName) -> Column:
    """P5: zone identifier = bay + zone (NULL parts print as "NA")."""
    return paste0(bay, zone)


def depth_slope(gr: str = "gr", startdepth: str = "startdepth", wng_dpth: str = "wng_dpth",
                enddepth: str = "enddepth") -> Column:
    """|start depth - wing depth| for seines, |start - end| for trawls."""
    g = q(gr)
    return case_expr([
        (f"{g} IN ({', '.join(map(str, L.SLOPE_WING_GROUPS))})", f"abs({q(startdepth)} - {q(wng_dpth)})"),
        (f"{g} = {L.TRAWL_GROUP}", f"abs({q(startdepth)} - {q(enddepth)})"),
    ]).cast("double")


def with_physical_vars(hauls: DataFrame, split_shore_stratum: bool = False) -> DataFrame:
    """P3-P6 as new columns ``gr``, ``effort``, ``z``, ``slope`` (narrow, no shuffle)."""
    df = hauls.withColumn("gr", gear_group("gear", "stratum", split_shore_stratum))
    return df.withColumns({
        "effort": effort_100m2("gr", "soakhr", "soakmin", "dist_tow"),
        "z": zone_key("bay", "zone"),
        "slope": depth_slope("gr", "startdepth", "wng_dpth", "enddepth"),
    })


def keep_gears(df: DataFrame, cfg: SurveyConfig) -> DataFrame:
    """Keep configured gear groups (NULL group never kept)."""
    gears = cfg.valid_gears
    return df if gears is None else df.where(F.expr(_in("gr", gears)))


def physical_master(hauls: DataFrame, cfg: SurveyConfig) -> DataFrame:
    """Selected hauls with gear group, effort, zone key and slope."""
    df = with_physical_vars(select_hauls(hauls, cfg), cfg.split_shore_stratum)
    return keep_gears(df, cfg)


def retained_keys(fld: DataFrame) -> DataFrame:
    """The kept haul keys, used as the right side of ``left_semi`` joins.

    No ``distinct``: a semi join only tests existence, so duplicates cost
    nothing and a separate de-duplicating shuffle is avoided.
    """
    return fld.select("reference")


# The haul key with its end, the haul's number, in front: for tables that are sorted by it.
HAUL, HAUL_TAIL = "_haul", 8


def by_haul(df: DataFrame) -> DataFrame:
    """``df`` with ``_haul``, the haul key with its end in front (``tail_first``), in place of ``reference``."""
    return df.withColumn(HAUL, F.expr(tail_first("reference", HAUL_TAIL))).drop("reference")


def restrict(df: DataFrame, keys: DataFrame, key: str = "reference") -> DataFrame:
    """Key-set reduction (H1 and friends): rows of ``df`` whose haul was kept.

    A ``left_semi`` join: never fans out.  The planner broadcasts ``keys``
    when its measured size is under the broadcast threshold (AQE re-checks
    at run time) and falls back to a shuffled join otherwise; a hot haul in
    a shuffled join is split by AQE's skew-join handling.
    """
    return df.join(keys, key, "left_semi")
