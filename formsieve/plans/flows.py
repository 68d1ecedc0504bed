"""End-to-end flows of the survey workflow, each a composition of library operators.

* ``raw_checks``       raw batch -> issue log, service-adequacy flags, interview lengths
* ``update_checks``    partner-updated data -> issue log (the update subset)
* ``apply_and_publish`` corrected log -> clean data -> dashboard / internal / external
* ``append_master``    master + new batches -> appended master with site codes
* ``indicators``       master -> per-group indicator table (plan shares + modes + totals)
* ``site_merge_table`` per-site report-merge table

Nothing here collects data to the driver; the only driver-side reads are metadata:
plan rows, a bounded dictionary turned into a literal map, the pivot keys of a merge
table (bounded, checked).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formsieve.functions.fmt import map_path, pct100
from formsieve.functions.nulls import col, fill_values, join_on, na_if_else, paste, strict_sum
from formsieve.functions.text import replace_all, to_number, trim_ws
from formsieve.operators import aggregate as agg
from formsieve.operators import checks
from formsieve.operators import columns as cols
from formsieve.operators import joins, lookup, reshape
from formsieve.operators.corrections import apply_log
from formsieve.operators.sitecodes import assign_site_codes, final_code
from formsieve.plans import analysis, survey
from formsieve.sources import io


def resolve_site_names(df: DataFrame, external_choices: DataFrame) -> DataFrame:
    """Site code -> site label from the external ``sitename`` list; free text when unmatched."""
    out = lookup.lookup_first(df, "a4_site_name", external_choices, "a4_site_name2", list_name="sitename")
    return out.withColumn("a4_site_name3", lookup.label_or_text("a4_site_name2", "a4_other_site"))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ("index",)) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude and "." not in f.name]


def raw_checks(responses: DataFrame, external_choices: DataFrame, outlier_cols: Sequence[str] | None = None,
               waste_none_code: str = survey.WASTE_NONE_CODE) -> dict[str, DataFrame]:
    """Section 3.1: the three tables of a raw-batch check run."""
    df = cols.apply_policy(responses, survey.POLICIES, "raw")
    df = resolve_site_names(df, external_choices)
    ctx = survey.SURVEY_CTX
    dup = checks.duplicate_log(df, "a4_site_name3", survey.ISSUE_DUPLICATE,
                               checks.LogContext(ctx.uuid, ctx.agency, "a3_sub_district"))
    dup_ids = checks.duplicate_log(df, "uuid", "duplicated uuid", ctx, rule_id="Q12_DUP")
    ocols = list(outlier_cols) if outlier_cols is not None else numeric_columns(df)
    parts = [dup]
    row_log = checks.run_rules(df, survey.raw_rules(waste_none_code), ctx)
    parts.append(row_log)
    if ocols:
        parts.append(checks.outlier_log(df, ocols, ctx))
    parts.append(dup_ids)
    log = checks.assemble_log(parts)
    service_cols = cols.column_range(df, survey.SERVICE_FIRST, survey.SERVICE_LAST)
    adequacy = checks.rule_flags(df, survey.adequacy_rules(),
                                 ["uuid", "q0_3_organization", "a4_site_name3"] + service_cols + survey.NEED_COLUMNS)
    lengths = checks.duration_issues(df, survey.LENGTH_LOWER, survey.LENGTH_UPPER)
    lengths = lengths.join(df.select("uuid", "q0_3_organization", "a4_site_name3"), "uuid", "left")
    return {"cleaning_log": log, "service_adequacy": adequacy, "survey_length": lengths}


def update_checks(responses: DataFrame, waste_none_code: str = survey.WASTE_NONE_CODE) -> DataFrame:
    """The partner-update control: duplicates plus the update rule subset."""
    ctx = survey.UPDATE_CTX
    dup = checks.duplicate_log(responses, "a4_site_name", survey.ISSUE_DUPLICATE,
                               checks.LogContext(ctx.uuid, ctx.agency, "a3_sub_district_name"))
    return checks.assemble_log([dup, checks.run_rules(responses, survey.update_rules(waste_none_code), ctx)])


def write_run(tables: Mapping[str, DataFrame], base: str, run_date: str) -> dict[str, str]:
    """S10 + S12: all tables of one run under ``base/run_date=YYYY-MM-DD/<table>``."""
    return io.write_tables(tables, io.dated_path(base, run_date))


ADMIN_LEVELS = [("admin1Pcode", "admin1Name_en", "a1_governorate", "a1_governorate_name"),
                ("admin2Pcode", "admin2Name_en", "a2_district", "a2_district_name"),
                ("admin3Pcode", "admin3RefName_en", "a3_sub_district", "a3_sub_district_name")]

# Columns of the dashboard product that keep their codes (everything else is labelled).
DASHBOARD_KEEP = ["q0_4_date", "a5_1_gps_longitude", "a5_2_gps_latitude", "a6_site_occupation_date_dd_mm_yy",
                  "a7_site_population_hh", "a7_site_population_individual", "a1_governorate", "a1_governorate_code",
                  "a2_district_name", "a2_district_code", "a3_sub_district_name", "a3_sub_district_code",
                  "a4_site_code", "a4_site_name"]


def apply_and_publish(responses: DataFrame, correction_log: DataFrame, choices: DataFrame,
                      external_choices: DataFrame, admin: DataFrame,
                      strict_reference: bool = False) -> dict[str, DataFrame]:
    """Section 3.2: apply the edited log, resolve names, add admin names, split products.

    The dashboard labels the columns outside its keep-list frame-wide.  By default only
    text columns are labelled and a cell without a dictionary code keeps its own text,
    so free text survives; ``strict_reference=True`` labels every column outside the
    keep-list and turns unmatched cells (free text, ids, dates) into null, as the
    original does."""
    clean = apply_log(responses, correction_log)
    clean = resolve_site_names(clean, external_choices)
    clean = joins.add_admin_names(clean, admin, [lv for lv in ADMIN_LEVELS if lv[2] in clean.columns],
                                  constants={"country_name": "Yemen", "country_id": "YE"})
    moves = [(m[0], m[1], m[2]) for m in [
        ("country_name", "before", "a1_governorate"), ("country_id", "after", "country_name"),
        ("a1_governorate_name", "before", "a1_governorate"), ("a2_district_name", "before", "a2_district"),
        ("a3_sub_district_name", "before", "a3_sub_district"), ("a4_site_name3", "after", "a3_sub_district")]
        if m[0] in clean.columns and m[2] in clean.columns]
    clean = cols.reorder_columns(clean, moves)
    clean = cols.apply_policy(clean, survey.POLICIES, "clean")
    clean = cols.rename_cols(clean, survey.CLEAN_RENAMES)

    dash = cols.add_constants(clean, {"a9_Site_Classification": " ", "a4_site_code": " "})
    dash = cols.rename_cols(dash, {"a1_governorate_name": "a1_governorate", "uuid": "_uuid", "index": "_index"})
    to_label = [c for c in dash.columns if c not in DASHBOARD_KEEP]
    if not strict_reference:
        to_label = [c for c in to_label if isinstance(dash.schema[c].dataType, T.StringType) and c != "_uuid"]
    dash = lookup.label_columns(dash, to_label, choices, keep_unmatched=not strict_reference)
    multi = "a8_population_groups_other_than_idps_in_site_select_all_applicable"
    fixes = {}
    if multi in dash.columns:
        fixes[multi] = replace_all(replace_all(multi, " ", " - "), "_", " ")
    fixes["a4_site_code"] = replace_all("a4_site_code", "_", " - ")
    dash = dash.withColumns(fixes)
    internal = cols.apply_policy(clean, survey.POLICIES, "internal")
    external = cols.apply_policy(clean, survey.POLICIES, "external")
    return {"clean": clean, "dashboard": dash, "internal": internal, "external": external}


def append_master(master: DataFrame, batches: Sequence[DataFrame], template: DataFrame | None,
                  external_choices: DataFrame, site_master: DataFrame, key: str = "uuid",
                  ord_col: str = "index", version_renames: Sequence[Mapping[str, str] | None] = ()) -> DataFrame:
    """Section 3.2 (append): new rows of each batch (anti-join on ``key``), union by name
    onto the template and master, then site codes: dictionary code by trimmed name,
    numbered codes for the rest, master-list code wins."""
    renamed = [cols.rename_cols(b, version_renames[i]) if i < len(version_renames) and version_renames[i] else b
               for i, b in enumerate(batches)]
    new = [joins.new_rows_only(b, master, key) for b in renamed]
    frames = [master] + new
    out = reshape.union_onto_template(template, frames) if template is not None else reshape.union_fill(frames)
    out = out.withColumns({"country_name": F.lit("Yemen"), "country_id": F.lit("YE"),
                           "a4_site_name": trim_ws("a4_site_name")})
    sitenames = lookup.restrict_list(external_choices, "sitename").select(
        "ord", F.col("label_english").alias("name"), F.col("name").alias("label_english"))
    out = lookup.lookup_first(out.drop("a4_site_code") if "a4_site_code" in out.columns else out,
                              "a4_site_name", sitenames, "a4_site_code")
    out = assign_site_codes(out, "a4_site_code", "a4_site_name", "a2_district_code", ord_col,
                            survey.FIRST_SITE_NUMBER, survey.LAST_SITE_NUMBER)
    out = lookup.lookup_by_trimmed_name(out, "a4_site_name", site_master, "_master_code")
    return out.withColumn("a4_site_code", final_code("_master_code", "a4_site_code")).drop("_master_code")


def indicators(master: DataFrame, choices: DataFrame, external_choices: DataFrame, plan,
               group_col: str = "a1_governorate_name", formal_only: bool = False,
               label_first: int = 18, label_last: int = 147) -> DataFrame:
    """Section 3.3: per-group indicator table (one function for both variants)."""
    df = master.filter(col("a9_formal_informal") == "formal") if formal_only else master
    df = df.withColumn("c10_primary_latrine_type", lookup.recode_value(
        "c10_primary_latrine_type", survey.LEGACY_LATRINE, survey.LEGACY_LATRINE_TARGET))
    agree = na_if_else((col("c3_tenancy_agreement_for_at_least_6_months") == "yes")
                       & (col("f1_threats_to_the_site.eviction").cast("string") == "1"), "1", "0")
    df = df.withColumn("agreement_with_issue", F.when(col("c3_tenancy_agreement_for_at_least_6_months") == "no",
                                                      F.lit(None).cast("string"))
                       .when(col("c3_tenancy_agreement_for_at_least_6_months") != "no", agree))
    g = df.withColumnRenamed(group_col, "governorate")
    # Counts and strict totals in one aggregate (one scan) ...
    totals = agg.drop_null_keys(g, "governorate").groupBy("governorate").agg(
        F.count(F.lit(1)).alias("tot_sites"),
        strict_sum(to_number("a7_site_population_hh")).alias("tot_hh"),
        strict_sum(to_number("a7_site_population_individual")).alias("tot_ind"))
    # ... and the three weighted modes in one more, after their code -> label lookups.
    labelled_modes = lookup.lookup_first(g, "d2_1_most_common_district_of_idp_origin", external_choices, "_dist",
                                         list_name="district")
    labelled_modes = lookup.lookup_first(labelled_modes, "d1_most_common_reason_idps_left_place_of_origin",
                                         choices, "_leave")
    labelled_modes = lookup.lookup_first(labelled_modes, "d3_most_common_intention_in_next_three_months",
                                         choices, "_int")
    modes = agg.weighted_modes(labelled_modes, "governorate", [
        ("_dist", "a7_site_population_individual", "most_district"),
        ("_int", "a7_site_population_hh", "most_intention"),
        ("_leave", "a7_site_population_individual", "most_leave_reason")])
    mode_frames = agg.modes_by_indicator(modes, "governorate",
                                         ["most_district", "most_intention", "most_leave_reason"])
    external = joins.join_chain([totals] + mode_frames, "governorate")

    labelled = cols.reorder_columns(df, [("uuid", "first")])
    # The grouping column keeps its text even when it falls inside the labelled range:
    # relabelling it would null the groups the plan is run by.
    rng = [c for c in cols.column_slice(labelled, label_first, label_last) if c != group_col]
    labelled = lookup.label_columns(labelled, rng, choices, id_col="uuid")
    results = analysis.run_plan(labelled, plan)
    wide = reshape.to_merge_table(results)
    value_cols = [c for c in wide.columns if c != "independent.var.value"]
    wide = fill_values(wide.withColumns({c: pct100(c) for c in value_cols}), 0.0, value_cols)
    wide = wide.withColumnRenamed("independent.var.value", "governorate")
    merged = join_on(wide, external, "governorate", "left")
    merged = merged.withColumn("@map", map_path("governorate", survey.GROUP_MAP_PREFIX, survey.GROUP_MAP_SUFFIX))
    return cols.lower_headers(merged)


def site_merge_table(responses: DataFrame, choices: DataFrame, label_cols: Sequence[str],
                     keep_cols: Sequence[str]) -> DataFrame:
    """Per-site merge in one projection: labelled answers (``*_other`` columns dropped),
    kept columns (site name trimmed), service status icons as ``@`` columns, a map path
    and an empty site-code column."""
    services = cols.column_range(responses, survey.SERVICE_FIRST, survey.SERVICE_LAST)
    filled = fill_values(responses, "not_applicable", services)
    icons = lookup.map_values(filled, services, survey.STATUS_ICONS)
    icons = cols.prefix_headers(icons, "@", services)
    labelled_cols = [c for c in label_cols if not c.lower().endswith("_other")]
    labelled = lookup.label_columns(icons, labelled_cols, choices)
    path = paste(survey.SITE_MAP_PREFIX, trim_ws("a4_site_name"), "__", col("a3_sub_district_code"),
                 survey.SITE_MAP_SUFFIX)
    kept = [trim_ws(c).alias(c) if c == "a4_site_name" else col(c) for c in keep_cols]
    return labelled.select(*[col(c) for c in labelled_cols], *kept, *[col("@" + s) for s in services],
                           path.alias("@maps"), F.lit(None).cast("string").alias("a4_site_code"))
