"""Run configuration: which hauls to keep and which variables to export."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class SurveyConfig:
    """Selection parameters of one analysis run.

    ``None`` disables the corresponding filter.  Bay and sampling-type
    codes match in either case (the survey stores upper case, the run
    parameters are often given in lower case).
    """

    bay: str | None = "tb"
    sampling_type: str | None = "m"
    first_year: int | None = 1999
    last_year: int | None = 2023
    projects: tuple[str, ...] | None = ("AM", "XX", "XX", "XX")
    # zone filter: keep zone <= max_zone (bytewise), or zone in ``zones``
    max_zone: str | None = "Z"
    zones: tuple[str, ...] | None = None
    # gear groups to keep; placeholders <= 0 are ignored
    gears: tuple[int, ...] | None = (20, 19, -1, -1, -1, -1)
    # False: gear 20 in stratum 'S' stays group 20 (first match wins);
    # True: such hauls become group 19 (beach stratum)
    split_shore_stratum: bool = False
    # export the nekton-index and seagrass columns with the enrichment table
    include_enrichment: bool = False

    @property
    def valid_gears(self) -> list[int] | None:
        if self.gears is None:
            return None
        return [g for g in self.gears if g > 0]

    @property
    def project_set(self) -> list[str] | None:
        if self.projects is None:
            return None
        return sorted(set(self.projects))

    def with_(self, **kw) -> "SurveyConfig":
        return replace(self, **kw)


DEFAULT = SurveyConfig()

# every haul retained: no bay, type, year, project, zone or gear filter
ALL_HAULS = SurveyConfig(
    bay=None, sampling_type=None, first_year=None, last_year=None,
    projects=None, max_zone=None, zones=None, gears=None,
)


# Export variable lists, in export order.
VAR0 = ["reference", "bio_reference", "species", "number"]

VAR1 = ["date", "starttime", "gear", "rep", "latitude", "longitude", "zone", "grid",
        "Project_1", "Project_2", "Project_3", "historic_reference",
        "secchi_depth", "secchi_on_bottom", "stratum",
        "startdepth", "bottomvegcover", "bycatchquantity",
        "totalshorecover", "shoredistance", "bankdistance",
        "distance_to_edge", "seagrass_habitat_descriptor",
        "dist_to_MHTM", "dist_to_ShoreType", "dist_to_shore",
        "intermittent_land", "total_over_site", "TotalShoreCover", "SAM"]

VAR2 = ["month", "year", "gr", "effort", "cf", "slope", "TBEP_seg",
        "temperature", "salinity", "dissolvedO2", "sal_sd",
        "temp_surf", "sal_surf", "do2_surf",
        "bmud", "bsan", "bstr", "bunk", "bottom", "season", "sgyear",
        "Man", "Ter", "Str", "Eme", "shore", "ovr_wtf", "ind_wtf", "ovr_per", "ind_per",
        "SAV", "Alg", "Non", "HA", "TH", "RU", "bveg", "DominantVeg"]

EXPORT_VARS = VAR0 + VAR1 + VAR2

# Enrichment columns (seagrass, then nekton index).
SEAGRASS_KEEP = ["FLUCCSCODE", "acres", "areas", "mngacre"]
INDEX_KEEP = ["TBNI_Score", "ScoreNumTaxa", "ScoreShannon", "ScoreTaxaSelect",
              "ScoreTaxaBenthic", "ScoreNumGuilds"]
