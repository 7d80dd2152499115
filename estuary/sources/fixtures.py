"""Survey-shaped test tables derived from the TPC-H style test data.

The test data holds no survey tables, so ten views map ``orders`` (one row
per haul) and ``lineitem`` (one row per habitat / hydrolab / catch record)
onto the survey schemas.  The SQL texts are shared word for word with the
DuckDB oracle (see ``survey_oracle/``); ``{name}`` placeholders are bound to
DataFrames on the Spark side and to table / CTE names on the DuckDB side.

Every view is derived from the given tables, so the work of every query
grows with the scale factor.  The only constant inputs are the two code
dictionaries, which are reference data by nature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estuary.sources import io, schemas

# every row, numbered within its order; the pair (l_orderkey, l_linenumber)
# repeats in lineitem, so a haul can have several surface readings
FX_LINE = """
SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax) AS INT) AS rec,
 l_partkey AS pk, l_suppkey AS sk, l_quantity AS qty, l_discount AS disc, l_tax AS tax
FROM {lineitem}
"""

FX_HAUL = """
SELECT o_orderkey,
 CASE o_orderkey % 8 WHEN 6 THEN 'JX' WHEN 7 THEN 'CH' ELSE 'TB' END || CASE o_orderstatus WHEN 'P' THEN 'D' ELSE 'M' END || CAST(year(o_orderdate) AS STRING) || lpad(CAST(o_orderkey AS STRING), 8, '0') AS reference,
 CASE o_orderkey % 8 WHEN 6 THEN 'JX' WHEN 7 THEN 'CH' ELSE 'TB' END AS bay,
 CASE o_orderstatus WHEN 'P' THEN 'D' ELSE 'M' END AS type,
 CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
 CASE o_custkey % 7 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' WHEN 4 THEN 'E' WHEN 5 THEN 'Z1' ELSE NULL END AS zone,
 CASE o_orderkey % 20 WHEN 4 THEN 1 WHEN 5 THEN 5 WHEN 6 THEN 11 WHEN 7 THEN 12 WHEN 8 THEN 23 WHEN 9 THEN 153 WHEN 10 THEN 160 WHEN 11 THEN 170 WHEN 12 THEN 180 WHEN 13 THEN 204 WHEN 14 THEN 300 WHEN 15 THEN 350 WHEN 16 THEN 436 WHEN 17 THEN 999 WHEN 18 THEN NULL WHEN 19 THEN 410 ELSE 20 END AS gear,
 CASE o_orderkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN NULL ELSE 'A' END AS stratum,
 CASE o_orderkey % 4 WHEN 0 THEN 'AM' WHEN 1 THEN 'AS' WHEN 2 THEN 'AR' ELSE NULL END AS Project_1,
 CASE o_orderkey % 9 WHEN 0 THEN 'AM' WHEN 1 THEN 'WI' ELSE NULL END AS Project_2,
 CASE o_orderkey % 11 WHEN 0 THEN 'XX' WHEN 1 THEN 'AM' ELSE NULL END AS Project_3,
 CAST(o_orderkey % 30 AS DOUBLE) / 10 AS startdepth,
 CAST(o_custkey % 25 AS DOUBLE) / 10 AS enddepth,
 CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(o_custkey % 20 AS DOUBLE) / 10 END AS wng_dpth,
 CAST(o_orderkey % 4 AS DOUBLE) AS soakhr, CAST(o_orderkey % 60 AS DOUBLE) AS soakmin,
 CAST(o_orderkey % 10 AS DOUBLE) / 10 AS dist_tow,
 CASE o_custkey % 6 WHEN 0 THEN '101' WHEN 1 THEN '-9' WHEN 2 THEN '.' WHEN 3 THEN '0' ELSE CAST(o_custkey % 100 AS STRING) END AS bottomvegcover,
 CASE o_custkey % 5 WHEN 0 THEN '' ELSE CAST(o_custkey % 101 AS STRING) END AS TotalShoreCover
FROM {orders}
"""

FX_HAB = """
SELECT h.reference, CAST(l.rec AS STRING) AS habitat_record_id,
 CASE pk % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'S' WHEN 2 THEN 'U' WHEN 3 THEN 'N' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'O' END AS bottomtype,
 CASE sk % 10 WHEN 0 THEN 'HA' WHEN 1 THEN 'TH' WHEN 2 THEN 'RU' WHEN 3 THEN 'SM' WHEN 4 THEN 'AM' WHEN 5 THEN 'UN' WHEN 6 THEN 'NO' WHEN 7 THEN '' WHEN 8 THEN NULL ELSE '.' END AS bottomveg,
 CASE WHEN pk % 4 = 0 THEN NULL ELSE CAST(pk % 11 AS STRING) END AS BottomVegRatio,
 CASE sk % 8 WHEN 0 THEN 'SW' WHEN 1 THEN 'MG' WHEN 2 THEN 'OY' WHEN 3 THEN 'SP' WHEN 4 THEN 'UN' WHEN 5 THEN 'NO' WHEN 6 THEN ' ' ELSE NULL END AS shoretype,
 CASE WHEN pk % 5 = 0 THEN NULL ELSE CAST(pk % 13 AS STRING) END AS ShoreTypeRatio,
 CASE pk % 3 WHEN 0 THEN 'YES' WHEN 1 THEN '4' ELSE NULL END AS Inund,
 CASE pk % 3 WHEN 0 THEN 'NO' WHEN 1 THEN '11' ELSE 'YES' END AS Over_
FROM {fx_line} l JOIN {fx_haul} h ON l.l_orderkey = h.o_orderkey
"""

FX_HYD = """
SELECT h.reference, CASE l_linenumber WHEN 1 THEN CAST(0.2 AS DOUBLE) ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS depth,
 CASE WHEN pk % 10 = 0 THEN NULL ELSE qty / 2 + 10 END AS temperature,
 CASE WHEN pk % 6 = 0 THEN NULL ELSE disc * 300 END AS salinity,
 tax * 100 AS dissolvedO2
FROM {fx_line} l JOIN {fx_haul} h ON l.l_orderkey = h.o_orderkey
"""

FX_BIO = """
SELECT h.reference, rec AS Species_record_id, CASE pk % 2 WHEN 0 THEN 'a' ELSE 'B' END AS SC,
 CASE pk % 8 WHEN 0 THEN '8835440102' WHEN 1 THEN '61890213 01' WHEN 2 THEN '8747010401' WHEN 3 THEN '8805020302' WHEN 4 THEN '9998000000' WHEN 5 THEN '883544010201' WHEN 6 THEN '8776014401' ELSE NULL END AS NODCCODE,
 CASE WHEN pk % 17 = 0 THEN NULL WHEN pk % 19 = 0 THEN CAST(0 AS DOUBLE) ELSE qty END AS Number,
 CASE pk % 5 WHEN 0 THEN CAST(2 AS DOUBLE) WHEN 1 THEN CAST(3 AS DOUBLE) ELSE NULL END AS Splittype,
 CAST(pk % 4 AS DOUBLE) AS Splitlevel,
 CASE WHEN pk % 23 = 0 THEN NULL ELSE CAST(1 + pk % 3 AS DOUBLE) END AS Cells
FROM {fx_line} l JOIN {fx_haul} h ON l.l_orderkey = h.o_orderkey
"""

# 1 to 4 length records per catch record: k runs over 1 .. 1 + pk % 4.
# Spark generates the k values per row with explode(sequence(..)); the
# oracle uses unnest(generate_series(..)).  Same rows, no pairing join.
_FX_LEN_SELECT = """
SELECT reference, CAST(rec AS STRING) AS species_record_id, CAST(k AS STRING) AS length_record_id,
 CASE WHEN (pk + k) % 13 = 0 THEN '.' ELSE CAST(20 + (pk + k * k) % 6 AS STRING) END AS length
FROM (SELECT h.reference, l.rec, l.pk, {k_values} AS k
      FROM {fx_line} l JOIN {fx_haul} h ON l.l_orderkey = h.o_orderkey) e
"""
FX_LEN_SPARK = _FX_LEN_SELECT.replace("{k_values}", "explode(sequence(CAST(1 AS BIGINT), 1 + l.pk % 4))")
FX_LEN_DUCKDB = _FX_LEN_SELECT.replace("{k_values}", "unnest(generate_series(CAST(1 AS BIGINT), 1 + l.pk % 4))")

FX_CODES = """
SELECT * FROM (VALUES ('BottomType','M','Mud','Mud'),('BottomType','S','Sand','Sand'),('BottomType','U','Unknown','Unknown'),('BottomType','O','Oyster','Structure'),
('BottomVeg','HA','Halodule','Seagrass'),('BottomVeg','TH','Thalassia','Seagrass'),('BottomVeg','RU','Ruppia','Seagrass'),('BottomVeg','SM','Seagrasses: Mixed','SAV'),('BottomVeg','AM','Algae: Mixed','Algae'),('BottomVeg','NO','None','None'),
('ShoreType','SW','Seawall','Manmade'),('ShoreType','MG','Mangrove','Terrestrial'),('ShoreType','OY','Oyster bar','Structure'),('ShoreType','SP','Spartina','Emergent')) t(fieldname, code, description, category)
"""

FX_SPECIES = """
SELECT * FROM (VALUES ('8835440102','Species A'),('8747010400','Species C'),('6189021300','Species B'),('9998000000','No fish'),('883544010201','Species A'),('8776014401','Species E')) t(NODCCODE, Scientificname)
"""

FX_TBNI = """
SELECT reference, CAST(o_orderkey % 47 AS DOUBLE) AS TBNI_Score, CAST(o_orderkey % 11 AS INT) AS ScoreNumTaxa, CAST(o_orderkey % 12 AS INT) AS ScoreShannon, CAST(o_orderkey % 13 AS INT) AS ScoreTaxaSelect, CAST(o_orderkey % 14 AS INT) AS ScoreTaxaBenthic, CAST(o_orderkey % 15 AS INT) AS ScoreNumGuilds
FROM {fx_haul} WHERE o_orderkey % 10 <> 3
"""

FX_SGRS = """
SELECT reference, CASE WHEN o_orderkey % 7 = 2 THEN NULL ELSE year END AS sgyear, CASE WHEN o_orderkey % 3 = 0 THEN '9113' ELSE '9116' END AS FLUCCSCODE, CAST(o_orderkey % 500 AS DOUBLE) / 4 AS acres, CAST(o_orderkey % 900 AS DOUBLE) / 4 AS mngacre, 'area' || CAST(o_orderkey % 30 AS STRING) AS areas
FROM {fx_haul} WHERE o_orderkey % 12 <> 5
"""

# view name -> (SQL, logical survey table it stands for)
VIEWS = {
    "fx_line": FX_LINE, "fx_haul": FX_HAUL, "fx_hab": FX_HAB, "fx_hyd": FX_HYD,
    "fx_bio": FX_BIO, "fx_len": FX_LEN_DUCKDB, "fx_codes": FX_CODES,
    "fx_species": FX_SPECIES, "fx_tbni": FX_TBNI, "fx_sgrs": FX_SGRS,
}


def duckdb_ctes(names=None) -> str:
    """``WITH`` clause defining the fixture views for the DuckDB oracle."""
    names = names or list(VIEWS)
    order = [n for n in VIEWS if n in names]
    parts = []
    for n in order:
        sql = VIEWS[n].format(lineitem="lineitem", orders="orders",
                              fx_line="fx_line", fx_haul="fx_haul")
        parts.append(f"{n} AS ({sql.strip()})")
    return "WITH " + ",\n".join(parts)


def survey_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The survey tables, as lazy DataFrames over ``sf_dir``'s parquet files."""
    lineitem = io.read_table(spark, f"{sf_dir}/lineitem.parquet", schemas.LINEITEM)
    orders = io.read_table(spark, f"{sf_dir}/orders.parquet", schemas.ORDERS)
    fx_line = spark.sql(FX_LINE, lineitem=lineitem)
    # catch and lengths are joined: dealt before the window, where both still have the
    # same columns, the lines are shuffled once for the two
    dealt = spark.sql(FX_LINE, lineitem=lineitem.repartition("l_orderkey"))
    fx_haul = spark.sql(FX_HAUL, orders=orders)
    return {
        "hauls": fx_haul,
        "habitat": spark.sql(FX_HAB, fx_line=fx_line, fx_haul=fx_haul)
                        .withColumnRenamed("Over_", "Over"),
        "hydro": spark.sql(FX_HYD, fx_line=fx_line, fx_haul=fx_haul),
        "counts": spark.sql(FX_BIO, fx_line=dealt, fx_haul=fx_haul),
        "lengths": spark.sql(FX_LEN_SPARK, fx_line=dealt, fx_haul=fx_haul),
        "codes": spark.sql(FX_CODES),
        "species_codes": spark.sql(FX_SPECIES),
        "index": spark.sql(FX_TBNI, fx_haul=fx_haul),
        "seagrass": spark.sql(FX_SGRS, fx_haul=fx_haul),
    }
