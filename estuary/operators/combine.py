"""Combination of the per-haul tables at haul x species grain (M1-M4)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.config import EXPORT_VARS
from estuary.functions import lookups as L
from estuary.functions.rsem import ColumnOrName, drop_clashing, keep_existing, num, r_ifelse

DROPPED = ["ovr_per", "ind_per", "n"]
COVER_OUTPUT_CODE = 51


def cap_cover_code(x: ColumnOrName) -> Column:
    """M2: the 101 cover code is reported as 51 in the combined table."""
    v = num(x)
    return r_ifelse(v == L.COVER_FULL_CODE, F.lit(float(COVER_OUTPUT_CODE)), v)


def left_chain(base: DataFrame, parts: Iterable[DataFrame], key: str = "reference") -> DataFrame:
    """Left-join each part on ``key``; a part's columns already present are dropped.

    All joins share one key, so Spark hash-partitions each input on it once
    and the partitioning flows through the chain (parts already partitioned
    on ``key`` by their own aggregate are not exchanged again)."""
    df = base
    for p in parts:
        df = df.join(drop_clashing(p, df, [key]), key, "left")
    return df


def combine(fld: DataFrame, hab: DataFrame | None, hyd: DataFrame, totals: DataFrame,
            extra: Iterable[DataFrame] = ()) -> DataFrame:
    """M1-M2, M4: hauls, habitat, chemistry, optional extras, catch totals.

    ``hab=None`` when the habitat columns were already derived on ``fld``."""
    parts = [p for p in (hab, hyd, *extra, totals) if p is not None]
    df = left_chain(fld, parts)
    df = df.withColumns({"number": F.col("n"), "bottomvegcover": cap_cover_code("bottomvegcover")})
    return df.drop(*[x for x in DROPPED if x in df.columns])


def keep_export(df: DataFrame, names: Iterable[str] = EXPORT_VARS) -> DataFrame:
    """M3: the export variables that exist, in list order."""
    return keep_existing(df, names)
