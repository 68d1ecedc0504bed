"""The site-reporting survey preset: its rules (Q1-Q12), codes, column policies and
version map, bound to the survey's own column names.

Where the original workflow is broken the intended rule is built and the deviation is
named (phone prefixes as an anchored alternation, the waste-disposal code as a
parameter, the cooking rule with its own issue text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from formsieve.operators.checks import LogContext, Rule, any_equals, in_set, prefix_rule

# ------------------------------------------------------------------ fixed values
# Log context of the survey: who and where each logged row is about.
SURVEY_CTX = LogContext(uuid="uuid", agency="q0_3_organization", area="a4_site_name3")
UPDATE_CTX = LogContext(uuid="uuid", agency="q0_3_organization", area="a4_site_name")

# Personal and technical columns removed from a raw batch.
RAW_DROP = ["deviceid", "subscriberid", "imei", "phonenumber", "q0_1_enumerator_name", "q0_2_gender",
            "q1_1_key_informant_name", "q1_2_key_informat_gender", "q1_3_key_informat_mobile_number",
            "a5_gps_coordinates", "calca11", "__version__", "_id", "_submission_time", "_validation_status"]

# Columns removed from the cleaned data before the products are split.
CLEAN_DROP = ["comments_001", "a4_site_name2", "a4_site_name", "deviceid", "subscriberid", "imei", "phonenumber",
              "_validation_status", "d2_2_second_most_common_district_of_idp_origin_001",
              "d2_2_most_common_governorate_of_idp_origin", "d2_governorate_of_idp_origin", "comments",
              "__version__", "calca11", "country_name", "country_id"]

# Columns removed from the internal product.
INTERNAL_DROP = ["start", "end", "q0_1_enumerator_name", "q0_2_gender", "q1_1_key_informant_name",
                 "q1_2_key_informat_gender", "q1_3_key_informat_mobile_number", "a5_gps_coordinates", "_id",
                 "_submission_time", "q0_3_organization_other", "a4_site_name2", "comments", "comments_001",
                 "a4_other_site", "q0_4_date", "b2_exu_fp_name", "b3_exu_fp_mobile_number", "b5_smc_agency_fp_name",
                 "b6_smc_agency_fp_mobile_number", "b8_community_committee_fp_name", "b9_community_committee_fp_cell"]

# Columns removed from the external product.
EXTERNAL_DROP = ["start", "end", "q0_1_enumerator_name", "q0_2_gender", "q1_1_key_informant_name",
                 "q1_2_key_informat_gender", "q1_3_key_informat_mobile_number", "a5_gps_coordinates", "__version__",
                 "_id", "_submission_time", "_validation_status", "q0_3_organization_other", "a4_site_name2",
                 "comments", "comments_001", "a4_other_site", "a5_1_gps_longitude", "a5_2_gps_latitude",
                 "b2_exu_fp_name", "b2_exu_fp_name", "b3_exu_fp_mobile_number", "b5_smc_agency_fp_name",
                 "b6_smc_agency_fp_mobile_number", "b8_community_committee_fp_name", "b9_community_committee_fp_cell",
                 "q0_3_organization", "q0_4_date", "b3_smc_agency_fp_name", "b4_smc_agency_fp_mobile_number",
                 "b6_community_committee_fp_name", "b7_community_committee_fp_cell in external",
                 "b4_site_smc_agency_name", "b7_community_committee_in_place"]

POLICIES = {"raw": RAW_DROP, "clean": CLEAN_DROP, "internal": INTERNAL_DROP, "external": EXTERNAL_DROP}

# Form version 1 -> version 2 column names.
V1_TO_V2 = {
    "b4_site_smc_agency_name": "b2_site_smc_agency_name",
    "b5_smc_agency_fp_name": "b3_smc_agency_fp_name",
    "b6_smc_agency_fp_mobile_number": "b4_smc_agency_fp_mobile_number",
    "b7_community_committee_in_place": "b5_community_committee_in_place",
    "b8_community_committee_fp_name": "b6_community_committee_fp_name",
    "b9_community_committee_fp_cell": "b7_community_committee_fp_cell",
}

# Renames applied to the cleaned data.
CLEAN_RENAMES = {"a4_site_name3": "a4_site_name", "new_site_id": "a4_site_code",
                 "a1_governorate": "a1_governorate_code", "a2_district": "a2_district_code",
                 "a3_sub_district": "a3_sub_district_code"}

# Service adequacy checks: (flag name, service column, need code).
ADEQUACY_CHECKS = [
    ("food_check", "food_distribution", "food"),
    ("water_check", "wash_services", "water"),
    ("shelter_check", "shelter_maintenance_services", "shelter_maintenance_assistance"),
    ("nfi_check", "nfi_distribution", "non_food_items"),
    ("sanitation_check", "waste_disposal_services", "sanitation_services"),
    ("nutrition_check", "nutrition_services", "nutrition_services"),
    ("health_check", "health_services", "medical_assistance"),
    ("livelihoods_check", "livelihood_services", "livelihood_assistance"),
    ("cash_check", "cash_distributions", "cash_assistance"),
    ("protection_check", "protection_services", "protection_services"),
    ("education_check", "education_services", "education"),
    ("wash_sanitation_check", "wash_services", "sanitation_services"),
]
NEED_COLUMNS = ["i1_top_priority_need", "i2_second_priority_need", "i3_third_priority_need"]
SERVICE_FIRST, SERVICE_LAST = "rrm_distributions", "waste_disposal_services"

# GPS box of the country.
LON_MIN, LON_MAX = 41.60824994, 54.73893746
LAT_MIN, LAT_MAX = 11.90848018, 18.99999992

# Allowed mobile prefixes.
PHONE_PREFIXES = ["70", "71", "73", "77", "79"]

UNFIT_SHELTERS = ["emergency_shelter", "makeshift_shelter", "transitional_shelter", "open_air_no_shelter"]
# Open defecation has the dictionary's code; the original comparison names ``open_air``, which
# is no latrine code and never occurs (an option, for results as they were).
UNSAFE_LATRINES = ["flush_latrine_to_the_open", "open_defecation", "pit_latrine_open"]
UNSAFE_LATRINES_AS_WRITTEN = ["flush_latrine_to_the_open", "open_air", "pit_latrine_open"]
UNSAFE_WATER = ["illegal_connection_to_piped_network", "unprotected_well", "surface_water"]

# Issue texts.
ISSUE_DUPLICATE = "Duplicate site name:  check area code"
ISSUE_ADEQUACY = "Service marked both as 'adequate' and as a 'priority need'"
ADEQUACY_VARIABLE = "Multiple (from rrm_distribution to waste_disposal_services)"
ISSUE_GPS = "The GPS coordinates provided may contain errors"
ISSUE_PHONE = "The phone number provided may contain errors"
ISSUE_FORMAL = "Site identied as 'Formal' although the number of HHs is lower than 20"
ISSUE_COLLECTIVE = ("Primary shelter type marked as 'makeshfit', 'emergency', 'transitional', or 'open-air' although "
                    "type of site was identified as 'Collective centre'")
ISSUE_WASTE = ("Waste disposal marked as 'non-existant' although  'flush latrines' was selected as primary latrine "
               "type")
ISSUE_WASH = ("WASH services identified as adequate although water source or primary latrine type was marked as "
              "unsafe or unprotected")
ISSUE_EVICTION = "Eviction was identied as a risk although the site holds a tennacy agreement"
ISSUE_COOKING = "Issue with cooking methodology and fuel availability"

# Interview length limits used by the raw checks (the function defaults are 15 and 100).
LENGTH_LOWER, LENGTH_UPPER = 5, 40

# Code of a missing waste-disposal service in the dictionary (the script compares a
# misspelt code that never occurs).
WASTE_NONE_CODE = "non_existent"

# Legacy latrine code and its replacement in the aggregation.
LEGACY_LATRINE, LEGACY_LATRINE_TARGET = "open_air", "open_defecation"

# Status -> icon table of the per-site merge.
STATUS_ICONS = {"not_applicable": "./merge/grey.png", "inadequate": "./merge/red.png",
                "non_existent": "./merge/grey.png", "adequate": "./merge/green.png"}

# Map-file path formats: per group (prefix + name + suffix) and per site
# (prefix + site name + "__" + sub-district code + suffix).
GROUP_MAP_PREFIX, GROUP_MAP_SUFFIX = "./maps/YEM_CCCM_", ".pdf"
SITE_MAP_PREFIX, SITE_MAP_SUFFIX = "./merge/test maps/YEM_CCCM_", ".pdf"

# Site-code range for sites without a code.
FIRST_SITE_NUMBER, LAST_SITE_NUMBER = 1185, 5000


def c(name):
    return F.col(f"`{name}`") if "." in name else F.col(name)


def adequacy_rules() -> list[Rule]:
    """Q2a-l: a service marked adequate that is also one of the three priority needs."""
    return [Rule(flag, (c(svc) == "adequate") & any_equals(NEED_COLUMNS, need), ADEQUACY_VARIABLE,
                 ISSUE_ADEQUACY, F.lit("1"))
            for flag, svc, need in ADEQUACY_CHECKS]


def gps_rules() -> list[Rule]:
    """Q3: coordinates outside the country box; logs the offending coordinate."""
    lon, lat = "a5_1_gps_longitude", "a5_2_gps_latitude"
    return [Rule("wrong_longitude", (c(lon) > LON_MAX) | (c(lon) < LON_MIN), lon, ISSUE_GPS, lon),
            Rule("wrong_latitude", (c(lat) > LAT_MAX) | (c(lat) < LAT_MIN), lat, ISSUE_GPS, lat)]


def phone_rules() -> list[Rule]:
    """Q4: a present number not starting with an allowed prefix."""
    return [prefix_rule("exu_fb_wrong_number", "b3_exu_fp_mobile_number", PHONE_PREFIXES, ISSUE_PHONE),
            prefix_rule("smc_agency_wrong_number", "b6_smc_agency_fp_mobile_number", PHONE_PREFIXES, ISSUE_PHONE)]


def consistency_rules(waste_none_code: str = WASTE_NONE_CODE, unsafe_latrines: Sequence[str] = UNSAFE_LATRINES) -> list[Rule]:
    """Q5-Q10: contradictory answers."""
    hh = c("a7_site_population_hh").cast("string").try_cast("double")
    cooking_ok = ((c("c5_fuel_available_in_site_close_proximity") == "yes")
                  | ((c("c6_electricity_solar_power_available_in_site") == "yes")
                     & (c("primary_cooking_modality") == "Electrical_stove"))
                  | (c("primary_cooking_modality") == "Gas_stove"))
    return [
        Rule("less_than_20", (c("a9_formal_informal") == "formal") & (hh < 20), "a7_site_population_hh",
             ISSUE_FORMAL, "a7_site_population_hh"),
        Rule("collective_issue", (c("c1_type_of_site") == "collective_centre")
             & in_set("c9_primary_shelter_type", UNFIT_SHELTERS), "c9_primary_shelter_type", ISSUE_COLLECTIVE,
             "c9_primary_shelter_type"),
        Rule("waste_disposal_issue", (c("waste_disposal_services") == waste_none_code)
             & (c("c10_primary_latrine_type") == "flush_latrine_to_tank_sewage_system_pit"),
             "waste_disposal_services", ISSUE_WASTE, "waste_disposal_services"),
        Rule("adequate_wash_issue", (c("wash_services") == "adequate")
             & (in_set("c10_primary_latrine_type", list(unsafe_latrines)) | in_set("c8_primary_water_source", UNSAFE_WATER)),
             "c10_primary_latrine_type", ISSUE_WASH, "c10_primary_latrine_type"),
        Rule("eviction_issue", (c("c3_tenancy_agreement_for_at_least_6_months") == "yes")
             & (c("f1_threats_to_the_site.eviction") == 1), "f1_threats_to_the_site.eviction", ISSUE_EVICTION,
             "f1_threats_to_the_site.eviction"),
        Rule("cooking_issue", ~cooking_ok, "c5_fuel_available_in_site_close_proximity", ISSUE_COOKING,
             "c5_fuel_available_in_site_close_proximity"),
    ]


def raw_rules(waste_none_code: str = WASTE_NONE_CODE, unsafe_latrines: Sequence[str] = UNSAFE_LATRINES) -> list[Rule]:
    """Every row rule of the raw-batch checks, evaluated together in one scan."""
    return adequacy_rules() + gps_rules() + phone_rules() + consistency_rules(waste_none_code, unsafe_latrines)


def update_rules(waste_none_code: str = WASTE_NONE_CODE, unsafe_latrines: Sequence[str] = UNSAFE_LATRINES) -> list[Rule]:
    """The subset the partner-update control runs (no GPS, phone or outlier checks)."""
    return adequacy_rules() + consistency_rules(waste_none_code, unsafe_latrines)
