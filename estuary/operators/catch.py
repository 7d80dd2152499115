"""Catch records: sample key, taxonomy, sub-sample expansion, genus lumping, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.functions import lookups as L
from estuary.functions.rsem import num_text, q, resolve, sql_lit, tail_last
from estuary.operators.physical import HAUL, HAUL_TAIL, by_haul, restrict


def _num_text_sql(x: str) -> str:
    """How R prints a number inside ``paste0`` (2 -> "2", 2.5 -> "2.5")."""
    return (f"CASE WHEN {x} = floor({x}) AND abs({x}) < 1e15 "
            f"THEN CAST(CAST({x} AS BIGINT) AS STRING) ELSE CAST({x} AS STRING) END")


def bio_reference_sql(reference: str, sc: str, splitlevel: str) -> str:
    parts = [q(reference), q(sc), _num_text_sql(q(splitlevel))]
    return "upper(concat(" + ", ".join(f"coalesce(CAST({p} AS STRING), 'NA')" for p in parts) + "))"


def bio_reference(reference: str, sc: str, splitlevel: str) -> Column:
    """sample key = upper(reference + SC + split level); NULL parts print "NA"."""
    return F.expr(bio_reference_sql(reference, sc, splitlevel))


def clean_code(nodccode: str) -> Column:
    """Taxon code with every blank removed."""
    return F.expr(f"replace({q(nodccode)}, ' ', '')")


# Taxonomic levels as code prefix lengths.
TAXON_PREFIX = {"species": 10, "genus": 8, "family": 6, "order": 4, "class": 2}


def taxon_levels(code: str) -> dict[str, Column]:
    """taxonomic levels as code prefixes; subspecies only for codes over 10 chars."""
    cq = q(code)
    out = {"subspecies": F.expr(f"CASE WHEN length({cq}) > 10 THEN {cq} END")}
    out.update({k: F.expr(f"substring({cq}, 1, {n})") for k, n in TAXON_PREFIX.items()})
    return out


def expand_count(number: str, splittype: str, splitlevel: str, cells: str) -> Column:
    """sub-sample expansion Number * type^level / cells (split type 2 -> one cell).

    A missing split type leaves the count as is; zero cells give NULL, not infinity."""
    st = q(splittype)
    cells_sql = f"CASE WHEN {st} IS NULL THEN NULL WHEN {st} = 2 THEN 1.0D ELSE {q(cells)} END"
    return F.expr(f"CAST(CASE WHEN {st} IS NOT NULL "
                  f"THEN try_divide({q(number)} * pow({st}, {q(splitlevel)}), {cells_sql}) "
                  f"ELSE {q(number)} END AS DOUBLE)")


def lump_genera(species: str, genus: str, bay: str) -> Column:
    """some genera are reported at genus level (code genus + "00")."""
    g, b = q(genus), q(bay)
    g_out, bay_out = L.LUMP_GENUS_OUTSIDE_BAY
    always = ", ".join(sql_lit(x) for x in L.LUMP_GENERA_ALWAYS)
    return F.expr(f"CASE WHEN {g} IN ({always}) THEN concat({g}, '00') "
                  f"WHEN {g} = {sql_lit(g_out)} AND {b} <> {sql_lit(bay_out)} THEN concat({g}, '00') "
                  f"ELSE {q(species)} END")


def catch_taxa(counts: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """F1-F4 with every derived column kept (taxonomy included)."""
    df = counts if keys is None else restrict(counts, keys)
    sl = resolve(df, "splitlevel", "Splitlevel")
    df = df.withColumns({
        "bay": F.expr("substring(reference, 1, 2)"),
        "bio_reference": bio_reference("reference", "SC", sl),
        "taxon_code": clean_code("NODCCODE"),
    })
    df = df.withColumns(taxon_levels("taxon_code"))
    df = df.withColumn("number", expand_count("Number", "Splittype", sl, "Cells"))
    df = df.withColumn("species", lump_genera("species", "genus", "bay"))
    return df


def catch_rows(counts: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """cleaned catch rows (reference, bio_reference, species, number, species_record_id)."""
    df = catch_taxa(counts, keys)
    rid = resolve(df, "Species_record_id", "species_record_id")
    return df.select("reference", "bio_reference", "species", "number",
                     F.col(rid).alias("species_record_id"))


def catch_totals(rows: DataFrame, key: str = "reference") -> DataFrame:
    """total number per sample x species, with the sample's haul, the column ``key``.

    ``bio_reference`` starts with the fixed-width haul key, so grouping on
    (bio_reference, species, reference) equals grouping on the first two and
    attaching the haul -- one aggregate instead of aggregate + distinct + join.
    Partial aggregation runs map-side, so a hot sample is combined early.
    """
    return (rows.groupBy("bio_reference", "species", key)
                .agg(F.coalesce(F.sum("number"), F.lit(0.0)).alias("n"))
                .select("bio_reference", "species", "n", key))


# The record id as text, equal for equal numbers only: Spark wraps a DOUBLE that
# is a join key, and an aggregate by it does not take the partitioning of the join.
# And the sample without the haul it begins with, which is in ``_haul`` already.
RECORD, IN_HAUL = "_record", "_in_haul"


def by_record(rows: DataFrame) -> DataFrame:
    """Catch rows as ``_haul``, ``_record``, ``_in_haul``, species and number.

    ``_in_haul`` is "=" and what follows the haul in the sample key, or "-" and
    the whole key where it does not begin with the haul as it is written.  A
    missing record id becomes '', which no length has."""
    return by_haul(rows.withColumn(IN_HAUL, F.expr(
        "CASE WHEN startswith(bio_reference, reference) "
        "THEN concat('=', substring(bio_reference, length(reference) + 1)) ELSE concat('-', bio_reference) END"))).select(
            HAUL, F.coalesce(num_text(F.col("species_record_id").cast("double")), F.lit("")).alias(RECORD),
            IN_HAUL, "species", "number")


def sample_sql() -> str:
    """SQL text: ``bio_reference`` from ``_haul`` and ``_in_haul``."""
    return (f"CASE WHEN startswith({IN_HAUL}, '=') THEN concat({tail_last(HAUL, HAUL_TAIL)}, substring({IN_HAUL}, 2)) "
            f"ELSE substring({IN_HAUL}, 2) END")


def kept_records(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Catch records of the kept hauls, see ``by_record``.

    The match of the lengths and the pairs of the combined table both begin
    here.  ``inline`` of one struct changes no row; neither a filter nor
    pruning passes it, so the two plans are the same below it and Spark
    makes the rows and deals them by the haul once for both."""
    kept = restrict(by_record(rows), by_haul(keys), HAUL)
    return kept.selectExpr(HAUL, f"inline(array(struct({', '.join(c for c in kept.columns if c != HAUL)})))")
