"""Fixed values the survey logic depends on, and column expressions built from them.

All literal tables are stated here, together and in their natural order.
Lookups become constant-folded ``CASE`` / ``map`` expressions, so they cost
nothing at run time and never need a join.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from estuary.functions.rsem import ColumnOrName, c, sql_lit

# ---------------------------------------------------------------------------
# Gear groups.  (group, member gear codes, inclusive ranges)
# in matching order; the first matching row wins.  GEAR_LABELS names the groups;
# gear 20 by the shore is told apart by stratum, see ``physical.gear_group``.
# ---------------------------------------------------------------------------
GEAR_GROUPS: list[tuple[int, tuple[int, ...], tuple[tuple[int, int], ...]]] = [
    (2, (1, 2), ()),
    (5, (5,), ()),
    (20, (11, 13, 20, 21, 25, 26, 29), ((100, 107),)),
    (22, (12, 22, 24, 27, 28), ()),
    (23, (10, 23), ()),
    (153, (153, 154), ()),
    (160, (155, 157, 158, 159, 160), ()),
    (170, (170, 431), ()),
    (180, (180,), ()),
    (207, (), ((204, 209), (403, 406), (409, 410))),
    (300, (300, 301, 306), ()),
    (350, (350, 351, 354), ()),
    (436, (436,), ()),
]
SHORE_STRATUM_GEAR = 20
SHORE_STRATUM = "S"
SHORE_STRATUM_GROUP = 19

# Effort in 100 m2 per gear group (gillnets in soak hours,
# trawls from tow distance; group 153 has none).
EFFORT_CONSTANT: dict[tuple[int, ...], float] = {
    (2,): 31.17 / 100,
    (5,): 10.1 / 100,
    (19, 20): 140 / 100,
    (22,): 338 / 100,
    (23,): 68 / 100,
    (160,): 4120 / 100,
    (170,): 2209 / 100,
    (180,): 465 / 100,
    (350,): 1 / 100,
    (436,): 180 / 100,
}
GILLNET_GROUP = 207
TRAWL_GROUP = 300
TRAWL_WIDTH_M = 4
METRES_PER_NAUTICAL_MILE = 1853

# Slope is start depth minus wing depth for these groups,
# start minus end depth for the trawl.
SLOPE_WING_GROUPS = (19, 20, 23, 160)

# Display labels.
GEAR_LABELS = {
    "19": "offshr sn - shr strat", "20": "offshr sn - off strat",
    "22": "beach seine", "23": "boat seine",
    "160": "183-m haul seine", "170": "183-m purse seine", "153": "61-m blocknet",
    "180": "61-m haul seine", "207": "gillnet", "300": "trawl", "350": "dropnet",
}
MONTH_LABELS = {
    "1": "Jan", "2": "Feb", "3": "Mar", "4": "Apr",
    "5": "May", "6": "Jun", "7": "Jul", "8": "Aug",
    "9": "Sep", "10": "Oct", "11": "Nov", "12": "Dec",
}
BAY_NAMES = {
    "AP": "Apalachicola Bay", "BB": "Big Bend", "CK": "Cedar Key",
    "CH": "Charlotte Harbor", "EB": "Estero Bay", "FB": "Florida Bay",
    "HI": "Honeymoon Island", "IR": "Northern Indian River lagoon",
    "JX": "Northeast Florida", "KY": "Florida Keys", "LB": "Lemon Bay",
    "SA": "St. Andrews Bay", "SB": "Sarasota Bay",
    "TQ": "Southern Indian River Lagoon", "TB": "Tampa Bay",
}
TYPE_NAMES = {
    "M": "stratified-random sampling",
    "D": "directed sampling",
    "F": "fixed station sampling",
}

# Habitat code drop lists (each stage has its own).
BOTTOM_DROP = ("N", "", ".")
VEG_DROP = ("", " ", "  ", ".")
SHORE_DROP = ("  ", " ", ".", "UN", "NO")
VEG_UNKNOWN, VEG_NONE = "UN", "NO"
BOTTOM_UNKNOWN = "U"
VEG_SPECIES_CODES = ("HA", "TH", "RU")
YES_VALUES = ("1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "YES")
MANMADE = "Manmade"
SHORE_CAP = 10.0
SHARE_FIRST_YEAR = 2001
COVER_FULL_CODE = 101

# Dominant-vegetation name recodes.
ALGAE_NAMES = ("Acetabularia spp.", "Alg", "Algae: Mixed",
               "Algae: Unidentified", "Batophora spp.",
               "Algae: Filamentous red", "Algae: Filamentous Green",
               "Gracillaria", "Sargassum spp")
HALOPHILA_NAMES = ("Halophila englemanii (star grass)",
                   "Halophila decipiens (paddle grass)")
SEAGRASS_NAMES = ("Seagrasses: Mixed", "Seagrasses: Unidentified")
MIXED = "Mixed"

# Genera lumped to genus level (the last one except in JX).
LUMP_GENERA_ALWAYS = ("61890213", "87470104")
LUMP_GENUS_OUTSIDE_BAY = ("88050203", "JX")
NO_FISH_CODE = "9998000000"

# Project groups for the QA summary, in matching order.
PROJECT_GROUPS = [
    (("AM", "AS"), "Stratified-random sampling"),
    (("AR",), "River Study"),
    (("WI",), "Inshore - West Florida Shelf"),
]
PROJECT_OTHER = "Other"


def _map(d: dict[str, str]) -> Column:
    return F.expr("map(" + ", ".join(sql_lit(x) for x in chain.from_iterable(d.items())) + ")")


def lookup(d: dict[str, str], key: ColumnOrName) -> Column:
    """Named-vector lookup: unknown (or NULL) keys give NULL."""
    k = c(key).cast("string")
    return F.when(k.isNotNull(), F.try_element_at(_map(d), k))


def gear_label(gr: ColumnOrName) -> Column:
    return lookup(GEAR_LABELS, gr)


def month_label(month: ColumnOrName) -> Column:
    return lookup(MONTH_LABELS, month)


def bay_name(bay: ColumnOrName) -> Column:
    return lookup(BAY_NAMES, F.upper(c(bay)))


def type_name(t: ColumnOrName) -> Column:
    return lookup(TYPE_NAMES, F.upper(c(t)))
