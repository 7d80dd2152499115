"""Oracle SQL per registered query name (DuckDB dialect)."""

from __future__ import annotations

from survey_oracle.sql import GEAR_LABEL, MONTH_LABEL, _gr, rounded, with_stages

PHYS_D = ["startdepth", "enddepth", "wng_dpth", "soakhr", "soakmin", "dist_tow"]
VEG = ["SAV", "Alg", "Non", "HA", "TH", "RU"]
SHORE = ["Man", "Ter", "Str", "Eme"]
HYD = ["temperature", "salinity", "dissolvedO2", "temp_surf", "sal_surf", "do2_surf", "sal_sd"]
COM_D = ["number", "startdepth", "bottomvegcover", "effort", "slope", *HYD, *SHORE, *VEG]
ENR_D = [*COM_D, "TBNI_Score", "acres", "mngacre"]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    A, DF = "all", "default"
    # physical
    q["phys_select"] = rounded(DF, "phys_sel", PHYS_D)
    phys_d = ", ".join(f"round({d}, 6) AS {d}" for d in PHYS_D)
    for name, test in (("from", "year >= 1995"), ("until", "year <= 1997"), ("zones", "zone IN ('A', 'C', 'Z1')")):
        q[f"phys_select_{name}"] = with_stages(A, f"SELECT * REPLACE ({phys_d}) FROM fx_haul WHERE {test}")
    q["phys_gear_group"] = rounded(A, "phys_all", [], "reference, gear, stratum, gr")
    q["phys_gear_group_split"] = with_stages(
        A, f"SELECT reference, gear, stratum, {_gr(True)} AS gr FROM fx_haul")
    q["phys_effort"] = rounded(A, "phys_all", ["soakhr", "soakmin", "dist_tow", "effort"],
                               "reference, gr, soakhr, soakmin, dist_tow, effort")
    q["phys_zone_key"] = rounded(A, "phys_all", [], "reference, bay, zone, z")
    q["phys_slope"] = rounded(A, "phys_all", ["startdepth", "wng_dpth", "enddepth", "slope"],
                              "reference, gr, startdepth, wng_dpth, enddepth, slope")
    q["phys_master"] = rounded(DF, "phys", [*PHYS_D, "effort", "slope"])
    q["phys_master_all"] = rounded(A, "phys", [*PHYS_D, "effort", "slope"])
    q["phys_retained"] = rounded(DF, "ret", [])
    # hydrolab
    q["hyd_restrict"] = rounded(DF, "hyd_in", ["depth", "temperature", "salinity", "dissolvedO2"])
    q["hyd_restrict_all"] = rounded(A, "hyd_in", ["depth", "temperature", "salinity", "dissolvedO2"])
    q["hyd_mean"] = rounded(A, "hyd_mean", ["temperature", "salinity", "dissolvedO2"])
    q["hyd_surface"] = rounded(A, "hyd_surf", ["temp_surf", "sal_surf", "do2_surf"])
    q["hyd_zone"] = rounded(A, "hyd_fld", HYD[:-1])
    q["hyd_zone_sd"] = rounded(A, "hyd_sd", ["sal_sd"])
    q["hyd_summary"] = rounded(A, "hyd", HYD)
    # bottom
    q["hab_bottom_rows"] = rounded(A, "b_rows", ["habitat_record_id"])
    q["hab_bottom_cat"] = rounded(A, "b_cat", ["habitat_record_id"])
    q["hab_bottom_first"] = rounded(A, "b_first", [])
    q["hab_bottom_pivot"] = rounded(A, "b_piv", [])
    q["hab_bottom_label"] = rounded(A, "btype4", [])
    # vegetation
    q["veg_cover"] = rounded(A, "v_cover", ["bottomvegcover"])
    q["veg_rows"] = rounded(A, "v_rows", ["BottomVegRatio"])
    q["veg_cat"] = rounded(A, "v_cat", ["BottomVegRatio"])
    q["veg_dominant"] = rounded(A, "v_dom", [])
    q["veg_sums"] = rounded(A, "v_sums", ["k"])
    q["veg_pivot"] = rounded(A, "v_piv", VEG)
    q["veg_floor"] = rounded(A, "v_floor", [*VEG, "bottomvegcover"])
    q["veg_cover_impute"] = rounded(A, "v_imp", [*VEG, "bottomvegcover"])
    q["veg_weighted"] = rounded(A, "v_wt", [*VEG, "bottomvegcover"])
    q["veg_class"] = rounded(A, "v_cls", [*VEG, "bottomvegcover"])
    q["veg_dominant_clean"] = rounded(A, "v_fin", [*VEG, "bottomvegcover"])
    q["veg_summary"] = rounded(A, "bvtype4", VEG)
    # shore
    q["shore_cover"] = rounded(A, "s_cover", ["TotalShoreCover"])
    q["shore_rows"] = rounded(A, "s_rows", ["habitat_record_id", "ShoreTypeRatio"])
    q["shore_cat"] = rounded(A, "s_catw", ["habitat_record_id", "ShoreTypeRatio", "inr", "ovr",
                                          "ovr_wt", "ind_wt"])
    q["shore_shares"] = rounded(A, "stype3", ["ovr_wtf", "ind_wtf"])
    q["shore_percents"] = rounded(A, "stype4", ["ovr_wtf", "ind_wtf", "ovr_per", "ind_per"])
    q["shore_sums"] = rounded(A, "s_sums", ["count"])
    q["shore_pivot"] = rounded(A, "s_piv", SHORE)
    q["shore_label"] = rounded(A, "stype5", [*SHORE, "TotalShoreCover"])
    q["hab_combined"] = rounded(A, "hab_comb", [*VEG, *SHORE, "ovr_per", "ind_per"])
    q["hab_combined_default"] = rounded(DF, "hab_comb", [*VEG, *SHORE, "ovr_per", "ind_per"])
    # catch
    q["bio_key"] = rounded(A, "fish_t", ["Splitlevel"], "reference, SC, Splitlevel, bio_reference")
    q["bio_taxa"] = rounded(A, "fish_tax", [], 'reference, Species_record_id, NODCCODE, taxon_code, '
                            'subspecies, species0 AS species, genus, family, "order", class')
    q["bio_expand"] = rounded(A, "fish_x", ["Number", "Splittype", "Splitlevel", "Cells", "number_expanded"],
                              "reference, Species_record_id, Number, Splittype, Splitlevel, Cells, "
                              "number_x AS number_expanded")
    q["bio_lump"] = rounded(A, "fish_x", [], "reference, Species_record_id, genus, bay, species_x AS species")
    q["bio_rows"] = rounded(A, "fish", ["number"])
    q["bio_totals"] = rounded(A, "totals", ["n"])
    # lengths
    q["len_rows"] = rounded(A, "len1", ["species_record_id", "length_record_id", "sl"])
    q["len_matched"] = rounded(A, "len_m", ["species_record_id", "length_record_id", "sl"])
    q["len_freq"] = rounded(A, "len_frq", ["sl"])
    q["len_nl"] = rounded(A, "nl", [])
    q["len_dataset"] = rounded(A, "len_final", ["sl"])
    q["len_final"] = rounded(A, "len_com", ["sl"])
    q["pipe_len"] = rounded(DF, "len_com", ["sl"])
    # combined
    q["com_full"] = rounded(A, "com_m", [*PHYS_D, "effort", "slope", "bottomvegcover", *VEG, *SHORE,
                                         *HYD, "number"])
    q["com_cover"] = with_stages(
        A, "SELECT reference, round(CASE WHEN TRY_CAST(bottomvegcover AS DOUBLE) = 101 THEN 51::DOUBLE "
           "ELSE TRY_CAST(bottomvegcover AS DOUBLE) END, 6) AS bottomvegcover FROM phys")
    q["com_keep"] = rounded(A, "com", COM_D)
    com_d = ", ".join(f'round(c."{d}", 6) AS "{d}"' for d in COM_D)
    q["com_extra"] = with_stages(A, f"SELECT c.* REPLACE ({com_d}), CAST(h.year % 7 AS DOUBLE) AS wind "
                                    "FROM com c JOIN fx_haul h ON c.reference = h.reference")
    q["com_pair_repeats"] = with_stages(
        A, "SELECT bio_reference, species, count(*) AS n FROM com GROUP BY bio_reference, species HAVING count(*) > 1")
    q["pipe_com"] = rounded(DF, "com", COM_D)
    # checks
    q["qa_named"] = rounded(A, "chck", COM_D)
    q["qa_missing"] = with_stages(
        A, "SELECT reference, gr, round(effort, 6) AS effort, round(number, 6) AS number FROM chck "
           "WHERE number IS NULL OR effort IS NULL")
    q["qa_labels"] = with_stages(
        A, f"SELECT reference, gr, month, {GEAR_LABEL} AS gr_label, {MONTH_LABEL} AS month_label FROM phys")
    bay_case = ("CASE upper(bay) WHEN 'AP' THEN 'Apalachicola Bay' WHEN 'BB' THEN 'Big Bend' "
                "WHEN 'CK' THEN 'Cedar Key' WHEN 'CH' THEN 'Charlotte Harbor' WHEN 'EB' THEN 'Estero Bay' "
                "WHEN 'FB' THEN 'Florida Bay' WHEN 'HI' THEN 'Honeymoon Island' "
                "WHEN 'IR' THEN 'Northern Indian River lagoon' WHEN 'JX' THEN 'Northeast Florida' "
                "WHEN 'KY' THEN 'Florida Keys' WHEN 'LB' THEN 'Lemon Bay' WHEN 'SA' THEN 'St. Andrews Bay' "
                "WHEN 'SB' THEN 'Sarasota Bay' WHEN 'TQ' THEN 'Southern Indian River Lagoon' "
                "WHEN 'TB' THEN 'Tampa Bay' ELSE NULL END")
    type_case = ("CASE upper(type) WHEN 'M' THEN 'stratified-random sampling' "
                 "WHEN 'D' THEN 'directed sampling' WHEN 'F' THEN 'fixed station sampling' ELSE NULL END")
    q["qa_bay_names"] = with_stages(
        A, f"SELECT reference, bay, type, {bay_case} AS bay_name, {type_case} AS type_name FROM fx_haul")
    samples = ("SELECT gr_label, year, month_label, count(*) AS n_collections FROM "
               "(SELECT *, row_number() OVER (PARTITION BY reference ORDER BY bio_reference, species) AS rn "
               "FROM chk_lab) WHERE rn = 1 GROUP BY gr_label, year, month_label")
    q["qa_samples"] = with_stages(A, samples)
    q["qa_samples_default"] = with_stages(DF, samples)
    q["qa_project_group"] = rounded(A, "chk_fish", COM_D)
    q["qa_fish_gear_month"] = rounded(A, "fish_gm", ["total_number"])
    q["qa_fish_project"] = rounded(A, "fish_pj", ["total_number"])
    q["qa_top50"] = with_stages(
        A, "SELECT gr_label, year, month_label, scientificname, round(total_number, 6) AS total_number "
           "FROM fish_gm ORDER BY gr_label NULLS LAST, year NULLS LAST, scientificname NULLS LAST, "
           "month_label NULLS LAST LIMIT 50")
    q["qa_top50_project"] = with_stages(
        A, "SELECT px, year, scientificname, round(total_number, 6) AS total_number FROM fish_pj "
           "ORDER BY px NULLS LAST, scientificname NULLS LAST, year NULLS LAST LIMIT 50")
    # enrichment
    q["enr_join"] = rounded(A, "enr", ENR_D)
    q["enr_missing_index"] = with_stages(
        A, "SELECT * REPLACE (" + ", ".join(f'round("{d}", 6) AS "{d}"' for d in ENR_D)
           + ") FROM enr_first WHERE TBNI_Score IS NULL")
    q["enr_missing_sg"] = with_stages(
        A, "SELECT reference, year, sgyear, round(acres, 6) AS acres, round(mngacre, 6) AS mngacre, "
           "FLUCCSCODE, month, gear, round(TBNI_Score, 6) AS TBNI_Score, areas FROM enr_first "
           "WHERE sgyear IS NULL")
    complete = "(SELECT * FROM enr WHERE TBNI_Score IS NOT NULL AND sgyear IS NOT NULL)"
    q["enr_complete"] = rounded(A, complete, ENR_D)
    from survey_oracle.sql import COM_COLS
    q["enr_export"] = rounded(A, complete, COM_D, ", ".join([*COM_COLS, "sgyear"]))
    q["enr_export_all"] = rounded(
        A, complete, [*COM_D, "acres", "mngacre", "TBNI_Score"],
        ", ".join([*COM_COLS, "sgyear", "FLUCCSCODE", "acres", "areas", "mngacre", "TBNI_Score",
                   "ScoreNumTaxa", "ScoreShannon", "ScoreTaxaSelect", "ScoreTaxaBenthic",
                   "ScoreNumGuilds"]))
    # sources
    q["append_years"] = with_stages(
        A, "SELECT * REPLACE (" + ", ".join(f"round({d}, 6) AS {d}" for d in PHYS_D)
           + ", CASE WHEN year < 1998 THEN NULL ELSE TotalShoreCover END AS TotalShoreCover) FROM fx_haul")
    return q
