"""Water chemistry per haul: means, surface readings, zone salinity SD."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estuary.operators.physical import restrict

SURFACE_DEPTH = 0.2


def hydro_mean(hyd: DataFrame) -> DataFrame:
    """H2: mean temperature, salinity, DO per haul over rows that have a
    temperature or a salinity.  Hash aggregate with map-side partial
    aggregation, so a haul with very many readings is combined before the
    shuffle."""
    return (hyd.where(F.col("temperature").isNotNull() | F.col("salinity").isNotNull())
               .groupBy("reference")
               .agg(F.avg("temperature").alias("temperature"),
                    F.avg("salinity").alias("salinity"),
                    F.avg("dissolvedO2").alias("dissolvedO2")))


def hydro_surface(hyd: DataFrame, depth: float = SURFACE_DEPTH) -> DataFrame:
    """H3: the surface reading(s) of each haul, renamed."""
    return (hyd.where(F.col("depth") == F.lit(depth).cast("double"))
               .select("reference",
                       F.col("temperature").alias("temp_surf"),
                       F.col("salinity").alias("sal_surf"),
                       F.col("dissolvedO2").alias("do2_surf")))


def hydro_with_zone(mean: DataFrame, surf: DataFrame, fld: DataFrame) -> DataFrame:
    """H4: means + surface values + the haul's zone.  Two left joins on
    ``reference``: ``mean`` is already hash-partitioned on it by its
    aggregate, so only ``surf`` and the zone column are exchanged."""
    return (mean.join(surf, "reference", "left")
                .join(fld.select("reference", "zone"), "reference", "left"))


def haul_chemistry(hyd: DataFrame, keys: DataFrame | None = None, depth: float = SURFACE_DEPTH) -> DataFrame:
    """Everything that is asked of a haul's readings in one aggregate, for the hauls of ``keys``.

    (reference, chem): the means of temperature, salinity and oxygen over the
    usable readings, the number of usable and of surface readings.  They
    travel as one array, so a query that uses them twice asks for the same
    columns twice, and Spark makes one scan and one exchange serve both.
    """
    usable = F.col("temperature").isNotNull() | F.col("salinity").isNotNull()
    parts = hyd.groupBy("reference").agg(
        F.avg("temperature").alias("t"), F.avg("salinity").alias("s"), F.avg(F.when(usable, F.col("dissolvedO2"))).alias("o"),
        F.count_if(usable).alias("n"), F.count_if(F.col("depth") == F.lit(depth).cast("double")).alias("k"))
    if keys is not None:
        parts = restrict(parts, keys)
    counts = [F.col(c).cast("double") for c in ("n", "k")]
    return parts.select("reference", F.concat(F.array("t", "s"), F.array("o", *counts)).alias("chem"))


def chemistry_columns(chem: DataFrame) -> DataFrame:
    """``haul_chemistry`` unpacked: the means, ``n_usable`` and ``n_surface`` of every haul."""
    at = [F.get("chem", F.lit(k)) for k in range(5)]
    return chem.select("reference", at[0].alias("temperature"), at[1].alias("salinity"), at[2].alias("dissolvedO2"),
                       at[3].cast("bigint").alias("n_usable"), at[4].cast("bigint").alias("n_surface"))


def zone_salinity_sd(chem: DataFrame, fld: DataFrame) -> DataFrame:
    """H5: sample SD of haul-mean salinity per zone (a NULL zone is a group).

    A haul counts once for each of its surface readings, or once without any.
    Moments (count, mean, sum of squares about the mean) are taken over the
    hauls of each zone and weight, and the few weights of a zone are merged:
    count, sum w c; mean, sum w c m / sum w c; squares, sum w (q + c (m - mean)^2).
    Nothing is repeated or joined to the readings, and a zone with most of the
    hauls is combined map-side.
    """
    rows = chem.join(fld.select("reference", "zone"), "reference", "left")  # no usable reading: no salinity, no weight
    weight = F.greatest("n_surface", F.lit(1))
    classes = rows.groupBy("zone", weight.alias("w")).agg(
        F.count("salinity").alias("c"), F.avg("salinity").alias("m"), (F.var_pop("salinity") * F.count("salinity")).alias("q"))
    zone = Window.partitionBy("zone")
    n = F.sum(F.col("w") * F.col("c")).over(zone)
    mean = F.sum(F.col("w") * F.col("c") * F.col("m")).over(zone) / F.when(n > 0, n)
    merged = classes.select("zone", n.alias("n"), (F.col("w") * (F.col("q") + F.col("c") * F.pow(F.col("m") - mean, F.lit(2.0)))).alias("q"))
    return merged.groupBy("zone").agg(F.max("n").alias("n"), F.sum("q").alias("q")).select(
        "zone", F.when(F.col("n") > 1, F.sqrt(F.col("q") / (F.col("n") - 1))).alias("sal_sd"))


def hydro_rows(hyd: DataFrame, fld: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """H1-H6 and ``n_usable``: per-haul chemistry with the zone's salinity SD.

    The readings are scanned twice: once for the aggregate that both the
    means and the SD come from, once for the surface rows.  The SD table has
    one row per zone; it is joined null-safely without a hint, so its size at
    run time decides: broadcast, or a shuffled join whose skewed zones
    are split on the side of the hauls.

    A haul without a usable reading is one row without chemistry, which a left
    join of the hauls cannot tell from no row.  It is not filtered here: a
    filter on the aggregate would keep the semi join with ``keys`` above it,
    and with keys that can be broadcast Catalyst moves that below.
    """
    keys = keys if keys is not None else fld.select("reference")
    chem = chemistry_columns(haul_chemistry(hyd, keys))
    surf = hydro_surface(restrict(hyd, keys)).withColumnRenamed("reference", "_ref")
    hz = chem.drop("n_surface").join(surf, (F.col("reference") == F.col("_ref")) & (F.col("n_usable") > 0), "left").drop("_ref")
    hz = hz.join(fld.select("reference", "zone"), "reference", "left")
    sd = zone_salinity_sd(chem, fld).withColumnRenamed("zone", "sd_zone")
    out = hz.join(sd, hz["zone"].eqNullSafe(sd["sd_zone"]), "left")
    return out.select("reference", "n_usable", "temperature", "salinity", "dissolvedO2", "temp_surf", "sal_surf", "do2_surf",
                      F.when(F.col("n_usable") > 0, F.col("sal_sd")).alias("sal_sd"))


def hydro_summary(hyd: DataFrame, fld: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """H6: ``hydro_rows`` of the hauls with a usable reading."""
    return hydro_rows(hyd, fld, keys).where("n_usable > 0").drop("n_usable")
