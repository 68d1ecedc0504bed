"""Seeded survey fixtures (FIXTURES.md): responses, dictionaries, admin list, logs, plans."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SERVICES = ["rrm_distributions", "shelter_maintenance_services", "nfi_distribution", "food_distribution",
            "cash_distributions", "wash_services", "health_services", "education_services", "livelihood_services",
            "protection_services", "nutrition_services", "waste_disposal_services"]
VULNERABLE = ["unaccompanied_separated_children", "child_headed_hh", "elderly", "female_headed_hh",
              "marginalized_people", "persons_with_disabilities", "persons_with_chronic_diseases", "pregnant",
              "minorities"]
THREATS = ["flooding", "eviction", "infectious_diseases", "friction_between_communities", "water_contamination",
           "conflict_related_incidents", "fire_related_incidents"]
NEEDS = ["food", "water", "shelter_maintenance_assistance", "non_food_items", "sanitation_services",
         "nutrition_services", "medical_assistance", "livelihood_assistance", "cash_assistance",
         "protection_services", "education"]

COLUMNS = (["index", "uuid", "start", "end", "deviceid", "imei", "q0_1_enumerator_name", "q0_3_organization",
            "a1_governorate", "a2_district", "a3_sub_district", "a4_site_name", "a4_other_site",
            "a5_1_gps_longitude", "a5_2_gps_latitude", "a6_site_occupation_date_dd_mm_yy",
            "a7_site_population_hh", "a7_site_population_individual", "a9_formal_informal", "b1_site_management",
            "b3_exu_fp_mobile_number", "b6_smc_agency_fp_mobile_number", "c1_type_of_site",
            "c3_tenancy_agreement_for_at_least_6_months", "c5_fuel_available_in_site_close_proximity",
            "c6_electricity_solar_power_available_in_site", "primary_cooking_modality",
            "c8_primary_water_source", "c9_primary_shelter_type", "c10_primary_latrine_type"]
           + [f"c7_presence_of_particularly_vulnerable_groups.{v}" for v in VULNERABLE]
           + SERVICES
           + ["d1_most_common_reason_idps_left_place_of_origin", "d2_1_most_common_district_of_idp_origin",
              "d3_most_common_intention_in_next_three_months"]
           + [f"f1_threats_to_the_site.{t}" for t in THREATS]
           + ["i1_top_priority_need", "i2_second_priority_need", "i3_third_priority_need", "a1_governorate_name"])

INT_COLS = {"index"} | {c for c in COLUMNS if "." in c}
DOUBLE_COLS = {"a5_1_gps_longitude", "a5_2_gps_latitude"}


def response_schema() -> T.StructType:
    def t(c):
        if c == "index":
            return T.LongType()
        if c in INT_COLS:
            return T.IntegerType()
        if c in DOUBLE_COLS:
            return T.DoubleType()
        return T.StringType()
    return T.StructType([T.StructField(c, t(c)) for c in COLUMNS])


def make_responses(n: int = 80, seed: int = 7) -> list[tuple]:
    rnd = random.Random(seed)
    pick = lambda xs: rnd.choice(xs)
    rows = []
    govs = [("YE11", "Ibb"), ("YE12", "Abyan"), ("YE13", "Sana'a")]
    for i in range(n):
        g, gname = pick(govs)
        d = g + pick(["01", "02"])
        day = f"2020-10-{1 + i % 9:02d}"
        start = pick([f"{day}T09:{i % 60:02d}:10.123+03:00", None, "20201001"])
        mins = pick([3, 5, 20, 40, 55])
        end = None if start is None else pick([
            f"{day}T{9 + (i % 60 + mins) // 60:02d}:{(i % 60 + mins) % 60:02d}:40.000+03:00",
            f"2020-10-{2 + i % 9:02d}T09:00:00.000+03:00"])
        site = pick(["site_a", "site_b", "site_c", "other", "  site_d "])
        row = {
            "index": i, "uuid": f"u{i:04d}" if i != 5 else "u0004",
            "start": start, "end": end, "deviceid": f"dev{i}", "imei": "1", "q0_1_enumerator_name": "x",
            "q0_3_organization": pick(["mdf", "ngo_a", "ngo_b"]),
            "a1_governorate": g, "a2_district": d, "a3_sub_district": d + pick(["01", "02"]),
            "a4_site_name": site, "a4_other_site": f"Camp {i % 7}" if site == "other" else None,
            "a5_1_gps_longitude": pick([41.0, 41.60824994, 45.0, 54.73893746, 55.0, None]),
            "a5_2_gps_latitude": pick([11.0, 15.0, 18.99999992, 19.5, None]),
            "a6_site_occupation_date_dd_mm_yy": "01-01-20",
            "a7_site_population_hh": pick(["19", "20", "150", None, "abc"]),
            "a7_site_population_individual": pick(["100", "250", "900", None]),
            "a9_formal_informal": pick(["formal", "informal", None]),
            "b1_site_management": pick(["yes", "no", "dont_know"]),
            "b3_exu_fp_mobile_number": pick(["770000000", "710000000", "123456789", None]),
            "b6_smc_agency_fp_mobile_number": pick(["730000000", "990000000", None]),
            "c1_type_of_site": pick(["collective_centre", "spontaneous_settlement"]),
            "c3_tenancy_agreement_for_at_least_6_months": pick(["yes", "no", None]),
            "c5_fuel_available_in_site_close_proximity": pick(["yes", "no", None]),
            "c6_electricity_solar_power_available_in_site": pick(["yes", "no", None]),
            "primary_cooking_modality": pick(["Electrical_stove", "Gas_stove", "Firewood", None]),
            "c8_primary_water_source": pick(["piped_water", "unprotected_well", "surface_water", None]),
            "c9_primary_shelter_type": pick(["emergency_shelter", "makeshift_shelter", "apartment", None]),
            "c10_primary_latrine_type": pick(["flush_latrine_to_tank_sewage_system_pit", "open_defecation", "open_air",
                                              "pit_latrine_open", "flush_latrine_to_the_open", None]),
            "d1_most_common_reason_idps_left_place_of_origin": pick(["conflict", "economic", "other"]),
            "d2_1_most_common_district_of_idp_origin": pick(["YE1101", "YE1201", "YE1301"]),
            "d3_most_common_intention_in_next_three_months": pick(["stay", "return", "move"]),
            "i1_top_priority_need": pick(NEEDS + [None]), "i2_second_priority_need": pick(NEEDS),
            "i3_third_priority_need": pick(NEEDS), "a1_governorate_name": gname,
        }
        for v in VULNERABLE:
            row[f"c7_presence_of_particularly_vulnerable_groups.{v}"] = pick([0, 1, None])
        for t in THREATS:
            row[f"f1_threats_to_the_site.{t}"] = pick([0, 1, None])
        for s in SERVICES:
            row[s] = pick(["adequate", "inadequate", "non_existent", None])
        rows.append(tuple(row[c] for c in COLUMNS))
    return rows


# The dictionary keeps the cases that decide first-match results: a code repeated with
# two labels, blank rows, a list name with a trailing blank, flag rows 1/0.
DICTIONARY_ROWS = [
    ("yes_no", "yes", "Yes"), ("yes_no", "no", "No"), ("yes_no", "dont_know", "Don't know"),
    ("ngo", "mdf", "MDF first"), ("ngo", "ngo_a", "NGO A"), ("adequacy", "adequate", "Adequate"),
    ("adequacy", "inadequate", "Inadequate"), ("adequacy", "non_existent", "Non existent"),
    ("ngo2", "mdf", "MDF second"), ("", "", ""), (None, None, None),
    ("reason", "conflict", "Conflict"), ("reason", "economic", "Economic reasons"),
    ("intent", "stay", "Stay"), ("intent", "return", "Return"), ("intent", "move", "Move"),
    ("qq3 ", "Gas_stove", "Gas stove"), ("flag", "1", "Yes"), ("flag", "0", "No"),
    ("shelter", "emergency_shelter", "Emergency shelter "),
]

EXTERNAL_ROWS = [
    ("sitename", "site_a", "Al Amal camp"), ("sitename", "site_b", "Bab camp"), ("sitename", "site_a", "dup label"),
    ("district", "YE1101", "Ibb city"), ("district", "YE1201", "Zinjibar"), ("district", "YE1301", "Sanhan"),
]

ADMIN_ROWS = [
    ("YE11", "Ibb", "YE1101", "Ibb city", "YE110101", "Ibb sub 1"),
    ("YE11", "Ibb", "YE1101", "Ibb city", "YE110102", "Ibb sub 2"),
    ("YE11", "Ibb", "YE1102", "Far Al Odayn", "YE110201", "Far sub 1"),
    ("YE12", "Abyan", "YE1201", "Zinjibar", "YE120101", "Zin sub 1"),
    ("YE12", "Abyan", "YE1202", "Khanfar", "YE120201", "Khan sub 1"),
    ("YE13", "Sana'a", "YE1301", "Sanhan", "YE130101", "San sub 1"),
    ("YE13", "Sana'a", "YE1302", "Bani Hushaysh", "YE130201", "Bani sub 1"),
]


def dictionary_df(spark, rows=DICTIONARY_ROWS):
    data = [(i + 1, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "ord long, list_name string, name string, label_english string")


def admin_df(spark):
    return spark.createDataFrame(ADMIN_ROWS, "admin1Pcode string, admin1Name_en string, admin2Pcode string, "
                                             "admin2Name_en string, admin3Pcode string, admin3RefName_en string")


def responses_df(spark, n=80, seed=7):
    return spark.createDataFrame(make_responses(n, seed), response_schema())
