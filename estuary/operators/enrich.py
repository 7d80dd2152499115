"""Nekton-index and seagrass enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estuary.config import EXPORT_VARS, INDEX_KEEP, SEAGRASS_KEEP
from estuary.functions.rsem import asc_nulls_last, drop_clashing, keep_existing, q

SEAGRASS_CHECK = ["reference", "latitude", "longitude", "year", "sgyear", "acres", "mngacre",
                  "FLUCCSCODE", "month", "gear", "TB_seg", "TBEP_seg", "season", "TBNI_Score",
                  "areas"]
# row order inside a haul when one row per haul is reported; a haul with
# several surface readings holds each of its pairs once for each of them
ROW_ORDER = ["bio_reference", "species", "temp_surf", "sal_surf", "do2_surf"]


def enrich(fld: DataFrame, index: DataFrame, seagrass: DataFrame) -> DataFrame:
    """Rows left-joined with the nekton index and seagrass areas on ``reference``."""
    df = fld.join(drop_clashing(index, fld, ["reference"]), "reference", "left")
    return df.join(drop_clashing(seagrass, df, ["reference"]), "reference", "left")


def hauls_first_without(df: DataFrame, test: str, order: list[str] | None = None) -> DataFrame:
    """The first row (by ``order``, NULLs last) of every haul whose first row has no ``test`` value.

    One aggregate picks the whole row: the least of (order key, has a value, hash),
    with the row itself carried only where it lacks a value, as no other row can be
    reported.  Its input is computed once, and where the rows are already dealt by
    haul, as after the joins, nothing is dealt again.  Rows of one place differ in no
    ordering column; the one of least hash stays.  Rows without a haul are not reported."""
    order = [o for o in (order or ROW_ORDER) if o in df.columns]
    cols = [F.col(q(c)) for c in df.columns]
    lacks = F.col(q(test)).isNull()
    place = F.struct(*(F.struct(*(k.alias(f"k{i}") for i, k in enumerate(asc_nulls_last(o)))).alias(o) for o in order),
                     (~lacks).alias("_has"), F.when(lacks, F.xxhash64(*cols)).alias("_hash"))
    first = df.where(F.col("reference").isNotNull()).groupBy("reference").agg(F.min_by(F.when(lacks, F.struct(*cols)), place).alias("_row"))
    return first.where(F.col("_row").isNotNull()).select(*(F.col("_row").getField(c).alias(c) for c in df.columns))


def missing_index(df: DataFrame) -> DataFrame:
    """Hauls whose first row has no index score."""
    return hauls_first_without(df, "TBNI_Score")


def missing_seagrass(df: DataFrame) -> DataFrame:
    """Hauls whose first row has no seagrass year (check columns that exist)."""
    return keep_existing(hauls_first_without(df, "sgyear"), SEAGRASS_CHECK)


def complete_cases(df: DataFrame, cols=("TBNI_Score", "sgyear")) -> DataFrame:
    """Rows with an index score and a seagrass year."""
    cond = None
    for x in cols:
        t = F.col(x).isNotNull()
        cond = t if cond is None else cond & t
    return df.where(cond)


def enrichment_export(df: DataFrame, include_enrichment: bool = False) -> DataFrame:
    """E5: export projection; optionally with the seagrass and index columns."""
    names = EXPORT_VARS + (SEAGRASS_KEEP + INDEX_KEEP if include_enrichment else [])
    return keep_existing(df, names)
