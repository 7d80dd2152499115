"""Input schemas of the survey tables (columns the processing touches, plus
pass-through).  Reading with an explicit schema avoids inference passes and
pins the types the R semantics depend on (e.g. ``depth`` must be DOUBLE for
the 0.2 m surface test, gear codes INT for label lookups)."""

from pyspark.sql import types as T

S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()


def _st(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


HAULS = _st(("reference", S), ("bay", S), ("type", S), ("year", I), ("month", I),
            ("zone", S), ("gear", I), ("stratum", S),
            ("Project_1", S), ("Project_2", S), ("Project_3", S),
            ("startdepth", D), ("enddepth", D), ("wng_dpth", D),
            ("soakhr", D), ("soakmin", D), ("dist_tow", D),
            ("bottomvegcover", S), ("TotalShoreCover", S))

HYDRO = _st(("reference", S), ("depth", D), ("temperature", D), ("salinity", D),
            ("dissolvedO2", D))

HABITAT = _st(("reference", S), ("habitat_record_id", S), ("bottomtype", S),
              ("bottomveg", S), ("BottomVegRatio", S), ("shoretype", S),
              ("ShoreTypeRatio", S), ("Inund", S), ("Over", S), ("level", S))

COUNTS = _st(("reference", S), ("Species_record_id", I), ("SC", S), ("NODCCODE", S),
             ("Number", D), ("Splittype", D), ("Splitlevel", D), ("Cells", D))

LENGTHS = _st(("reference", S), ("species_record_id", S), ("length_record_id", S),
              ("length", S))

CODES = _st(("fieldname", S), ("code", S), ("description", S), ("category", S))

SPECIES_CODES = _st(("NODCCODE", S), ("Scientificname", S))

INDEX = _st(("reference", S), ("TBNI_Score", D), ("ScoreNumTaxa", I), ("ScoreShannon", I),
            ("ScoreTaxaSelect", I), ("ScoreTaxaBenthic", I), ("ScoreNumGuilds", I))

SEAGRASS = _st(("reference", S), ("sgyear", I), ("FLUCCSCODE", S), ("acres", D),
               ("areas", S), ("mngacre", D))

# columns that older exports may lack; every other declared column must be there
OPTIONAL = ("level", "Project_2", "Project_3")

# what a run cannot do without; the index and seagrass tables only add outputs
REQUIRED_TABLES = ("hauls", "hydro", "habitat", "counts", "lengths", "codes", "species_codes")

# the columns of the test data that the survey fixtures read
ORDERS = _st(("o_orderkey", T.LongType()), ("o_custkey", T.LongType()), ("o_orderstatus", S),
             ("o_orderdate", T.TimestampNTZType()))
LINEITEM = _st(("l_orderkey", T.LongType()), ("l_partkey", T.LongType()), ("l_suppkey", T.LongType()),
               ("l_linenumber", I), ("l_quantity", D), ("l_discount", D), ("l_tax", D))

# logical table name -> (default file stem, schema)
TABLES: dict[str, tuple[str, T.StructType]] = {
    "hauls": ("physical_master", HAULS),
    "hydro": ("hydrolab", HYDRO),
    "habitat": ("habitat", HABITAT),
    "counts": ("biology_counts", COUNTS),
    "lengths": ("biology_lengths", LENGTHS),
    "codes": ("reference_codes", CODES),
    "species_codes": ("species_codes", SPECIES_CODES),
    "index": ("nekton_index", INDEX),
    "seagrass": ("seagrass", SEAGRASS),
}
