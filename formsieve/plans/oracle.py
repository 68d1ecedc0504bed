"""DuckDB SQL for each catalog query: the same result written as plain SQL over the
driver's tables (pre-registered views).  Used by the correctness check; never by the
engine itself.  Fixed values (issue texts, dictionary rows, plans) are shared with the
catalog so both sides state them once.
"""

from __future__ import annotations

from formsieve.plans import catalog as C
from formsieve.plans.analysis import Z_95

Z = f"CAST('{Z_95!r}' AS DOUBLE)"
TAIL = "' ' AS new_value, 'Checked with partner' AS fix, 'ON' AS checked_by"
TRIM = "trim({x}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def nt(x: str) -> str:
    """Number as text; integral doubles without '.0' (the engine's num_to_text)."""
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = floor({x}) AND abs({x}) < 1e15 "
            f"THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END")


def trim(x: str) -> str:
    return TRIM.format(x=x)


# ------------------------------------------------------------------ rules

LI = ("SELECT *, concat_ws('-', l_orderkey, l_linenumber) AS uuid, CAST(l_suppkey AS VARCHAR) AS agency "
      "FROM lineitem")
LIO = ("SELECT l.*, o.o_orderstatus, o.o_orderpriority, concat_ws('-', l.l_orderkey, l.l_linenumber) AS uuid, "
       "CAST(l.l_suppkey AS VARCHAR) AS agency, nullif(o.o_orderstatus, 'P') AS status2, "
       "nullif(o.o_orderpriority, '3-MEDIUM') AS prio2 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey")


def _log(src: str, variable: str, issue: str, old: str, rule: str, where: str,
         uuid="uuid", agency="agency", area="l_returnflag") -> str:
    return (f"SELECT {uuid} AS uuid, {agency} AS agency, {area} AS area, {variable} AS variable, {q(issue)} AS issue, "
            f"{old} AS old_value, {TAIL}, {q(rule)} AS rule_id FROM {src} WHERE {where}")


def _range_parts(src: str) -> list[str]:
    return [
        _log(src, "'l_quantity'", C.ISSUE_RANGE, nt("l_quantity"), "R_QTY",
             "l_quantity > 45::DOUBLE OR l_quantity < 5::DOUBLE"),
        _log(src, "'l_discount'", C.ISSUE_RANGE, nt("l_discount"), "R_DISC",
             "l_discount > 0.09::DOUBLE OR l_discount < 0.01::DOUBLE"),
    ]


def _cross_parts(src: str) -> list[str]:
    i = C.ISSUE_CROSS
    return [
        _log(src, "'l_quantity'", i, nt("l_quantity"), "X_Q5", "o_orderstatus = 'F' AND l_quantity < 5"),
        _log(src, "'o_orderpriority'", i, "o_orderpriority", "X_Q6",
             "l_returnflag = 'R' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"),
        _log(src, "'l_linestatus'", i, "l_linestatus", "X_Q7", "status2 = 'O' AND l_linestatus = 'F'"),
        _log(src, "'l_tax'", i, nt("l_tax"), "X_Q9", "prio2 = '1-URGENT' AND l_tax = 0"),
        _log(src, "'o_orderstatus'", i, "o_orderstatus", "X_Q10",
             "NOT (status2 = 'F' OR (l_returnflag = 'N' AND l_linestatus = 'O') OR prio2 = '5-LOW')"),
    ]


RULE_RANGE = f"WITH li AS ({LI})\n" + "\nUNION ALL\n".join(_range_parts("li"))
RULE_CROSS = f"WITH j AS ({LIO})\n" + "\nUNION ALL\n".join(_cross_parts("j"))


def _any(cols, v):
    return "(" + " OR ".join(f"{c} = {q(v)}" for c in cols) + ")"


ADQ_SRC = ("SELECT CAST(o_orderkey AS VARCHAR) AS uuid, CAST(o_custkey AS VARCHAR) AS agency, c_mktsegment, "
           "o_orderpriority, o_orderstatus, nullif(o_orderstatus, 'P') AS status2, "
           "nullif(o_orderpriority, '3-MEDIUM') AS prio2 FROM orders JOIN customer ON o_custkey = c_custkey")
_N = C.ADEQUACY_NEEDS
ADQ_PARTS = [
    ("urgent_check", f"o_orderstatus = 'F' AND {_any(_N, '1-URGENT')}"),
    ("building_check", f"status2 = 'F' AND {_any(_N, 'BUILDING')}"),
    ("high_check", f"o_orderstatus = 'O' AND {_any(_N, '2-HIGH')}"),
    ("machinery_check", f"prio2 = '1-URGENT' AND {_any(_N, 'MACHINERY')}"),
]
RULE_ADEQUACY = f"WITH a AS ({ADQ_SRC})\n" + "\nUNION ALL\n".join(
    _log("a", q(C.ADEQUACY_VARIABLE), C.ISSUE_ADEQUACY, "'1'", rid, where, area="c_mktsegment")
    for rid, where in ADQ_PARTS)

PART_SRC = "SELECT *, nullif(p_brand, 'Brand#5') AS brand2 FROM part"
PREFIX_PART = _log("p", "'brand2'", C.ISSUE_PREFIX, "brand2", "Q4_BRAND",
                   "brand2 IS NOT NULL AND NOT regexp_matches(brand2, '^(Brand#1|Brand#2)')",
                   uuid="CAST(p_partkey AS VARCHAR)", agency="p_type", area="p_name")
RULE_PREFIX = f"WITH p AS ({PART_SRC})\n{PREFIX_PART}"

DUP_KEYS = """
SELECT p_partkey, p_name, freq FROM (
  SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name) AS freq FROM part WHERE p_name IS NOT NULL)
WHERE freq > 1"""

DUP_LOG = ("SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY p_name) AS f FROM p WHERE p_name IS NOT NULL) d")
DUP_PART = _log(f"({DUP_LOG})", "'p_name'", C.ISSUE_DUPLICATE, "p_name", "Q1", "f > 1",
                uuid="CAST(p_partkey AS VARCHAR)", agency="p_type", area="p_name")

_MIN = "hour({t}) * 60 + minute({t}) + second({t}) / 60"
DURATION = f"""
WITH e AS (
  SELECT event_id AS uuid, CAST(ts AS TIMESTAMP) AS s,
         CAST(ts AS TIMESTAMP) + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS en FROM events),
d AS (
  SELECT uuid, round_even({_MIN.format(t='en')}, 2) - round_even({_MIN.format(t='s')}, 2) AS duration_min
  FROM e WHERE CAST(en AS DATE) = CAST(s AS DATE))
SELECT uuid, duration_min AS value, 'Completion Duration (min)' AS variable, 'TRUE' AS has_issue,
       'form duration too short' AS issue_type FROM d WHERE duration_min <= 5
UNION ALL
SELECT uuid, duration_min, 'Completion Duration (min)', 'TRUE', 'form duration too long' FROM d WHERE duration_min >= 40"""

OUTLIER_CTE = """
li AS (SELECT concat_ws('-', l_orderkey, l_linenumber) AS uuid, CAST(l_suppkey AS VARCHAR) AS agency, l_returnflag,
              l_extendedprice, l_quantity FROM lineitem),
lg AS (SELECT uuid, agency, l_returnflag, 'l_extendedprice' AS variable, l_extendedprice AS value FROM li
       UNION ALL SELECT uuid, agency, l_returnflag, 'l_quantity', l_quantity FROM li),
lv AS (SELECT * FROM lg WHERE value IS NOT NULL),
m AS (SELECT variable, avg(value) AS mean, stddev_samp(value) AS sd,
             avg(CASE WHEN value > 0 THEN ln(value) END) AS mean_log,
             stddev_samp(CASE WHEN value > 0 THEN ln(value) END) AS sd_log FROM lv GROUP BY variable),
o AS (SELECT lv.*, 'outlier (normal distribution)' AS issue_type FROM lv JOIN m USING (variable)
        WHERE abs(value - mean) > 3.0::DOUBLE * sd
      UNION ALL
      SELECT lv.*, 'outlier (log-normal distribution)' FROM lv JOIN m USING (variable)
        WHERE value > 0 AND abs(ln(value) - mean_log) > 3.0::DOUBLE * sd_log)"""
OUTLIERS = f"WITH {OUTLIER_CTE}\nSELECT uuid, variable, value, issue_type FROM o"
OUTLIER_PART = (f"SELECT uuid, agency, l_returnflag AS area, variable, issue_type AS issue, {nt('value')} AS old_value, "
                f"{TAIL}, 'Q12' AS rule_id FROM o")

ISSUE_LOG = (f"WITH j AS ({LIO}), a AS ({ADQ_SRC}), p AS ({PART_SRC}), {OUTLIER_CTE}\n"
             + "\nUNION ALL\n".join([DUP_PART] + [
                 _log("a", q(C.ADEQUACY_VARIABLE), C.ISSUE_ADEQUACY, "'1'", rid, where, area="c_mktsegment")
                 for rid, where in ADQ_PARTS] + _range_parts("j") + _cross_parts("j") + [OUTLIER_PART, PREFIX_PART]))

# ------------------------------------------------------------------ lookups and joins

LOOKUP_FIRST = """
WITH d AS (
  SELECT p_partkey AS ord, 'p_type' AS list_name, p_type AS name, p_name AS label FROM part WHERE p_size <= 10
  UNION ALL
  SELECT p_partkey, 'p_brand', p_brand, p_name FROM part WHERE p_size > 45),
t AS (SELECT name, label FROM d WHERE list_name = 'p_type' AND name IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY name ORDER BY ord) = 1),
b AS (SELECT name, label FROM d WHERE list_name = 'p_brand' AND name IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY name ORDER BY ord) = 1)
SELECT p_partkey, t.label AS type_label, b.label AS brand_label
FROM part LEFT JOIN t ON part.p_type = t.name LEFT JOIN b ON part.p_brand = b.name"""


def _dict_values() -> str:
    rows = ", ".join(f"({i + 1}, {q(ln)}, {q(n)}, {q(lab)})" for i, (ln, n, lab) in enumerate(C.CODE_DICTIONARY))
    return f"d(ord, list_name, name, label) AS (VALUES {rows})"


DICT_FIRST = ("f AS (SELECT name, label FROM d WHERE name IS NOT NULL "
              "QUALIFY row_number() OVER (PARTITION BY name ORDER BY ord) = 1)")

LOOKUP_FRAME = f"""
WITH {_dict_values()}, {DICT_FIRST},
j AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, o_orderstatus, o_orderpriority,
             CAST(l_linenumber AS VARCHAR) AS line_code FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, f1.label AS o_orderstatus, f2.label AS o_orderpriority, f3.label AS l_returnflag,
       f4.label AS l_linestatus, f5.label AS line_code
FROM j LEFT JOIN f f1 ON j.o_orderstatus = f1.name LEFT JOIN f f2 ON j.o_orderpriority = f2.name
       LEFT JOIN f f3 ON j.l_returnflag = f3.name LEFT JOIN f f4 ON j.l_linestatus = f4.name
       LEFT JOIN f f5 ON j.line_code = f5.name"""

DIM_HIERARCHY = """
WITH data AS (SELECT c_custkey, c_nationkey, n.n_regionkey AS c_regionkey
              FROM customer LEFT JOIN nation n ON c_nationkey = n.n_nationkey),
admin AS (SELECT r_regionkey AS a1c, r_name AS a1n, n_nationkey AS a2c, n_name AS a2n
          FROM nation JOIN region ON n_regionkey = r_regionkey),
d1 AS (SELECT DISTINCT a1n AS region_name, a1c AS k FROM admin),
d2 AS (SELECT DISTINCT a2n AS nation_name, a2c AS k FROM admin)
SELECT c_custkey, data.c_regionkey, d1.region_name, data.c_nationkey, d2.nation_name,
       'World' AS country_name, 'WD' AS country_id
FROM data LEFT JOIN d1 ON data.c_regionkey = d1.k LEFT JOIN d2 ON data.c_nationkey = d2.k"""


def _log_part(cond, variable, new_value, change, n, uuid="CAST(c_custkey AS VARCHAR)"):
    return (f"SELECT {uuid} AS uuid, {q(variable)} AS variable, {q(new_value)} AS new_value, {q(change)} AS change, "
            f"c_custkey * 10 + {n} AS ord FROM customer WHERE {cond}")


_CLOG = "\n  UNION ALL ".join([
    _log_part("c_mktsegment = 'BUILDING'", "c_acctbal", "0", "TRUE", 1),
    _log_part("c_acctbal < 0", "c_mktsegment", "DEBT", "yes", 2),
    _log_part("c_mktsegment = 'FURNITURE'", "c_name", "refused", "FALSE", 3),
    _log_part("c_mktsegment = 'HOUSEHOLD'", "c_acctbal", "1", "TRUE", 4),
    _log_part("c_mktsegment = 'HOUSEHOLD'", "c_acctbal", "2", "TRUE", 5),
    _log_part("c_mktsegment = 'MACHINERY'", "c_acctbal", "abc", "TRUE", 6),
    _log_part("c_mktsegment = 'MACHINERY'", "c_phone", "555", "TRUE", 7),
    _log_part("c_mktsegment = 'AUTOMOBILE'", "c_nationkey", "99", "TRUE", 8),
    _log_part("c_mktsegment = 'AUTOMOBILE'", "c_name", "ghost", "TRUE", 9, uuid="'x' || CAST(c_custkey AS VARCHAR)"),
])


def _fx(var, alias):
    return (f"bool_or(variable = '{var}') AS h_{alias}, "
            f"max(CASE WHEN variable = '{var}' THEN new_value END) AS v_{alias}")


APPLY_LOG = f"""
WITH log AS ({_CLOG}),
red AS (SELECT uuid, variable, arg_max(new_value, ord) AS new_value FROM log
        WHERE coalesce(lower(trim(change)) IN ('true', 'yes', '1', 'y', 't'), false)
          AND uuid IS NOT NULL AND variable IS NOT NULL GROUP BY uuid, variable),
fx AS (SELECT uuid, {_fx('c_name', 'name')}, {_fx('c_nationkey', 'nat')}, {_fx('c_acctbal', 'bal')},
              {_fx('c_mktsegment', 'seg')} FROM red GROUP BY uuid)
SELECT c_custkey,
       CASE WHEN h_name THEN v_name ELSE c_name END AS c_name,
       CASE WHEN h_nat AND (v_nat IS NULL OR TRY_CAST(v_nat AS INTEGER) IS NOT NULL) THEN TRY_CAST(v_nat AS INTEGER) ELSE c_nationkey END AS c_nationkey,
       CASE WHEN h_bal AND (v_bal IS NULL OR TRY_CAST(v_bal AS DOUBLE) IS NOT NULL) THEN TRY_CAST(v_bal AS DOUBLE) ELSE c_acctbal END AS c_acctbal,
       CASE WHEN h_seg THEN v_seg ELSE c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN fx ON CAST(c_custkey AS VARCHAR) = fx.uuid"""

OVERRIDE_CODE = f"""
WITH data AS (SELECT s_suppkey, ' ' || chr(9) || n_name || chr(10) || ' ' AS site_name,
                     'S' || CAST(s_suppkey AS VARCHAR) AS own_code
              FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
master AS (SELECT {trim('n_name')} AS name, 'M' || CAST(n_nationkey AS VARCHAR) AS site_code, n_nationkey AS ord
           FROM nation WHERE n_regionkey < 3),
m1 AS (SELECT name, site_code FROM master WHERE name IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY name ORDER BY ord) = 1)
SELECT s_suppkey, {trim('data.site_name')} AS site_name, coalesce(m1.site_code, own_code) AS site_code,
       coalesce(m1.site_code, data.site_name) AS code_or_name
FROM data LEFT JOIN m1 ON {trim('data.site_name')} = m1.name"""

RECODE_DERIVE = """
WITH o AS (SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'O') AS status_in
           FROM orders WHERE o_orderpriority <> '5-LOW'),
d AS (SELECT o_orderkey,
        CASE WHEN status_in = 'P' THEN 'PARTIAL' WHEN status_in <> 'P' THEN status_in END AS status_recoded,
        CASE WHEN status_in = 'P' THEN NULL WHEN status_in <> 'P' THEN
          (CASE WHEN status_in = 'F' AND (CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END) = '1' THEN '1'
                WHEN NOT (status_in = 'F' AND (CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END) = '1')
                THEN '0' END) END AS agreement_with_issue
      FROM o)
SELECT o_orderkey, coalesce(status_recoded, 'not_applicable') AS status_recoded,
       coalesce(agreement_with_issue, 'not_applicable') AS agreement_with_issue,
       agreement_with_issue IS NULL AS is_missing FROM d"""

APPEND_NEW = """
WITH master AS (SELECT *, NULL::VARCHAR AS kobo_version FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b1 AS (SELECT *, NULL::VARCHAR AS kobo_version FROM orders WHERE o_orderstatus = 'F'),
b2 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL::VARCHAR AS o_orderpriority,
              'V2' AS kobo_version FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT * FROM master
UNION ALL SELECT * FROM b1 WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.o_orderkey = b1.o_orderkey)
UNION ALL SELECT * FROM b2 WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.o_orderkey = b2.o_orderkey)"""

MEMBERSHIP = """
SELECT (c.k IS NOT NULL) AS is_member, count(*) AS n_rows
FROM events e LEFT JOIN (SELECT DISTINCT c_custkey AS k FROM customer) c ON e.user_id = c.k GROUP BY 1"""

SITE_CODES = """
WITH s AS (SELECT c_custkey,
                  CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'C_' || CAST(c_custkey AS VARCHAR) END
                    AS site_code,
                  nullif(CAST(c_nationkey AS VARCHAR), '3') AS site_name,
                  nullif(substring(c_mktsegment, 1, 3), 'HOU') AS district_code FROM customer),
n AS (SELECT c_custkey, coalesce(district_code, 'NA') || '_' ||
             CAST(1185 + ((row_number() OVER (ORDER BY site_name ASC NULLS FIRST, c_custkey ASC) - 1) % 3816)
                  AS VARCHAR) AS site_code
      FROM s WHERE site_code IS NULL),
a AS (SELECT c_custkey, site_code FROM s WHERE site_code IS NOT NULL UNION ALL SELECT c_custkey, site_code FROM n)
SELECT c_custkey, regexp_replace(site_code, '_', '-') AS site_code FROM a"""

# ------------------------------------------------------------------ aggregations

GROUP_TOTALS = """
WITH k AS (SELECT c_nationkey, c_mktsegment, o_totalprice,
                  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AND o_totalprice > 480000 THEN NULL
                       ELSE o_totalprice END AS price_num
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_nationkey, c_mktsegment, count(*) AS n_orders,
       CAST(CASE WHEN count(*) = count(price_num) THEN sum(CAST(price_num AS DECIMAL(18,2))) END AS DOUBLE) AS tot_price,
       CAST(CASE WHEN count(*) = count(o_totalprice) THEN sum(CAST(o_totalprice AS DECIMAL(18,2))) END AS DOUBLE)
         AS tot_clean
FROM k WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY 1, 2"""

W_SRC = ("SELECT c_nationkey, c_mktsegment, o_orderpriority, TRY_CAST(CAST(floor(o_totalprice / 100000) AS VARCHAR) "
         "AS DOUBLE) AS w FROM orders JOIN customer ON o_custkey = c_custkey")


def _wmode(cat: str, out: str) -> str:
    return (f"SELECT c_nationkey, {cat} AS {out} FROM (SELECT c_nationkey, {cat}, "
            f"CASE WHEN count(*) = count(w) THEN sum(w) END AS x FROM j "
            f"WHERE c_nationkey IS NOT NULL AND {cat} IS NOT NULL GROUP BY 1, 2) "
            f"WHERE x IS NOT NULL QUALIFY rank() OVER (PARTITION BY c_nationkey ORDER BY x DESC) = 1")


WEIGHTED_MODE = f"WITH j AS ({W_SRC})\n{_wmode('c_mktsegment', 'most_segment')}"

MODE_FIRST_SEEN = """
WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2)
SELECT user_id, event_type AS mode FROM c
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f ASC) = 1"""

INDICATOR_JOIN = f"""
WITH j AS ({W_SRC}),
counts AS (SELECT c_nationkey, count(*) AS n_orders FROM j WHERE c_nationkey IS NOT NULL GROUP BY 1),
seg AS ({_wmode('c_mktsegment', 'most_segment')}),
prio AS ({_wmode('o_orderpriority', 'most_priority')})
SELECT counts.c_nationkey, n_orders, most_segment, most_priority
FROM counts LEFT JOIN seg ON counts.c_nationkey = seg.c_nationkey
            LEFT JOIN prio ON counts.c_nationkey = prio.c_nationkey"""

# ------------------------------------------------------------------ analysis plans

LS = "SELECT l.*, s_nationkey FROM lineitem l JOIN supplier ON l.l_suppkey = s_suppkey"


def _shares(deps: list[str], repeat: str | None = None, tag: str = "") -> str:
    """Categorical plan rows by s_nationkey as SQL (one CTE chain)."""
    rsel = f"CAST({repeat} AS VARCHAR)" if repeat else "NULL::VARCHAR"
    long = "\n    UNION ALL ".join(
        f"SELECT {rsel} AS r, CAST(s_nationkey AS VARCHAR) AS g, '{d}' AS var, CAST({d} AS VARCHAR) AS val FROM ls"
        for d in deps)
    rwhere = "AND r IS NOT NULL " if repeat else ""
    return f"""
long{tag} AS ({long}),
c{tag} AS (SELECT r, g, var, val, count(*) AS n FROM long{tag}
           WHERE val IS NOT NULL AND g IS NOT NULL {rwhere}GROUP BY ALL),
t{tag} AS (SELECT r, g, var, sum(n) AS total FROM c{tag} GROUP BY ALL),
p{tag} AS (SELECT c{tag}.r, c{tag}.g, c{tag}.var, c{tag}.val, c{tag}.n, t{tag}.total, c{tag}.n / t{tag}.total AS p
           FROM c{tag} JOIN t{tag} ON c{tag}.g = t{tag}.g AND c{tag}.var = t{tag}.var
                              AND (c{tag}.r = t{tag}.r OR (c{tag}.r IS NULL AND t{tag}.r IS NULL))),
res{tag} AS (SELECT var AS "dependent.var", val AS "dependent.var.value", 's_nationkey' AS "independent.var",
       g AS "independent.var.value", p AS numbers, sqrt(p * (1 - p) / total) AS se,
       greatest(0.0::DOUBLE, p - {Z} * sqrt(p * (1 - p) / total)) AS min,
       least(1.0::DOUBLE, p + {Z} * sqrt(p * (1 - p) / total)) AS max,
       {q(repeat) if repeat else 'NULL::VARCHAR'} AS "repeat.var", r AS "repeat.var.value", true AS is_percent
       FROM p{tag})"""


SHARES_DEPS = [p["dependent.variable"] for p in C.PLAN_SHARES]
SHARES_CTE = f"ls AS ({LS}),{_shares(SHARES_DEPS)}"
PLAN_SHARES = (f"WITH {SHARES_CTE},{_shares(['l_linestatus'], 'l_returnflag', tag='_r')}\n"
               f"SELECT * FROM res UNION ALL SELECT * FROM res_r")


def _means(table: str, deps: list[str], group: str, rnd: bool) -> str:
    r = (lambda x: f"round_even({x}, 6)") if rnd else (lambda x: x)
    long = " UNION ALL ".join(
        f"SELECT CAST({group} AS VARCHAR) AS g, '{d}' AS var, TRY_CAST(CAST({d} AS VARCHAR) AS DOUBLE) AS val "
        f"FROM {table}" for d in deps)
    se = "(sd / sqrt(n))"
    return f"""(SELECT var AS "dependent.var", NULL::VARCHAR AS "dependent.var.value", '{group}' AS "independent.var",
       g AS "independent.var.value", {r('m')} AS numbers, {r(se)} AS se, {r(f'm - {Z} * {se}')} AS min,
       {r(f'm + {Z} * {se}')} AS max, NULL::VARCHAR AS "repeat.var", NULL::VARCHAR AS "repeat.var.value",
       false AS is_percent
FROM (SELECT g, var, avg(val) AS m, stddev_samp(val) AS sd, count(*) AS n FROM ({long})
      WHERE val IS NOT NULL AND g IS NOT NULL GROUP BY g, var))"""


PLAN_NUMERIC = f"WITH ls AS ({LS})\nSELECT * FROM {_means('ls', ['l_extendedprice'], 's_nationkey', True)}"

AUTO_NUM = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
AUTO_PLAN = f"""
WITH long AS (SELECT CAST(l_linestatus AS VARCHAR) AS g, 'l_returnflag' AS var, l_returnflag AS val FROM lineitem),
c AS (SELECT g, var, val, count(*) AS n FROM long WHERE val IS NOT NULL AND g IS NOT NULL GROUP BY ALL),
t AS (SELECT g, var, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT c.*, t.total, c.n / t.total AS p FROM c JOIN t USING (g, var))
SELECT var AS "dependent.var", val AS "dependent.var.value", 'l_linestatus' AS "independent.var",
       g AS "independent.var.value", round_even(p, 6) AS numbers, round_even(sqrt(p * (1 - p) / total), 6) AS se,
       round_even(greatest(0.0::DOUBLE, p - {Z} * sqrt(p * (1 - p) / total)), 6) AS min,
       round_even(least(1.0::DOUBLE, p + {Z} * sqrt(p * (1 - p) / total)), 6) AS max,
       NULL::VARCHAR AS "repeat.var", NULL::VARCHAR AS "repeat.var.value", true AS is_percent FROM p
UNION ALL SELECT * FROM {_means('lineitem', AUTO_NUM, 'l_linestatus', True)}"""

LABELLED_RESULTS = f"""
WITH {SHARES_CTE}, {_dict_values()}, {DICT_FIRST}
SELECT res.*, f.label AS "dependent.var.value.label", NULL::DOUBLE AS "p.value"
FROM res LEFT JOIN f ON res."dependent.var.value" = f.name"""

_TYPES = ["click", "error", "purchase", "signup", "view"]
MULTI_RESPONSE = f"""
WITH u AS (SELECT user_id, {', '.join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in _TYPES)}
           FROM events GROUP BY user_id),
a AS (SELECT {', '.join(f"sum(CASE WHEN CAST({t} AS DOUBLE) <> 0 THEN 1 ELSE 0 END) AS {t}" for t in _TYPES)},
             sum(CASE WHEN CAST({' + '.join(_TYPES)} AS DOUBLE) <> 0 THEN 1 ELSE 0 END) AS cases FROM u),
b AS (SELECT *, {' + '.join(_TYPES)} AS total FROM a),
s AS ({' UNION ALL '.join(f"SELECT '{t}' AS question, {t} AS freq, total, cases FROM b" for t in _TYPES)}
      UNION ALL SELECT 'Total', total, total, cases FROM b)
SELECT question, CAST(freq AS DOUBLE) AS freq, CAST(freq AS DOUBLE) / total * 100 AS percent,
       freq / cases * 100 AS percentofcases FROM s"""

# The pivot keys are spelled out (the values these three columns can take): a query whose
# columns depend on the data cannot be stored as a view.
_MERGE_VALUES = {"l_linenumber": "1234567", "l_linestatus": "FO", "l_returnflag": "ANR"}
_MERGE_KEYS = [(d, v) for d, vs in _MERGE_VALUES.items() for v in vs]


def _cell(col: str, dep: str, val: str) -> str:
    return f"""max({col}) FILTER (WHERE "dependent.var" = '{dep}' AND "dependent.var.value" = '{val}')"""


MERGE_TABLE = f"""
WITH {SHARES_CTE}
SELECT "independent.var.value",
       {", ".join(f"coalesce(round_even({_cell('numbers', d, v)} * 100, 0), 0.0::DOUBLE) AS \"{f'{d}.{v}'.lower()}\"" for d, v in _MERGE_KEYS)}
FROM res GROUP BY "independent.var.value" """

MERGE_CONFINTS = f"""
WITH {SHARES_CTE}
SELECT "independent.var", "independent.var.value",
       {", ".join(f"round_even({_cell(c, d, v)}, 6) AS \"{d}:::{v}_{c}\"" for d, v in _MERGE_KEYS for c in ("numbers", "min", "max"))}
FROM res GROUP BY "independent.var", "independent.var.value" """


def _fmt_num(x, d):
    return f"coalesce({nt(f'round_even({x}, {d})')}, 'NA')"


def _fmt_pct(x):
    return f"coalesce({nt(f'round_even(round_even({x}, 2) * 100, 0)')}, 'NA') || '%'"


def _fmt_pct_raw(x):
    return f"coalesce({nt(f'round_even({x} * 100, 0)')}, 'NA') || '%'"


FORMAT_NUMBERS = f"""
WITH {SHARES_CTE},
mm AS {_means('ls', ['l_extendedprice'], 's_nationkey', False)},
allr AS (SELECT * FROM res UNION ALL
         SELECT "dependent.var", "dependent.var.value", "independent.var", "independent.var.value", numbers, se,
                NULL::DOUBLE, NULL::DOUBLE, "repeat.var", "repeat.var.value", is_percent FROM mm),
fl AS (SELECT "dependent.var" AS dv, "independent.var" AS iv, bool_or(min IS NOT NULL OR max IS NOT NULL) AS hc
       FROM allr GROUP BY ALL),
x AS (SELECT allr.*, hc,
        CASE WHEN is_percent THEN {_fmt_pct('numbers')} ELSE {_fmt_num('round_even(numbers, 2)', 2)} END AS n_txt,
        CASE WHEN is_percent THEN {_fmt_pct_raw('min')} ELSE {_fmt_num('min', 2)} END AS lo_txt,
        CASE WHEN is_percent THEN {_fmt_pct_raw('max')} ELSE {_fmt_num('max', 2)} END AS hi_txt
      FROM allr LEFT JOIN fl ON allr."dependent.var" = fl.dv AND allr."independent.var" = fl.iv),
y AS (SELECT *, concat_ws(' ', n_txt, CASE WHEN hc THEN '(' || lo_txt || '-' || hi_txt || ')' ELSE '' END) AS t
      FROM x)
SELECT "dependent.var", "dependent.var.value", "independent.var.value",
       CASE WHEN t = '0 (0-0)' THEN '0' WHEN t = '0% (0%-0%)' THEN '0%' ELSE t END AS formatted FROM y"""

RESULTS_SUBSET = f"""
WITH {SHARES_CTE}
SELECT * FROM res WHERE "dependent.var" IN ('l_returnflag', 'l_linenumber') AND numbers > 0.3::DOUBLE"""

# ------------------------------------------------------------------ columns and text

DROP_POLICY = ("SELECT c_custkey, c_mktsegment AS segment, c_name AS customer_name FROM customer")

REORDER = ("SELECT CAST(o_orderkey AS VARCHAR) AS uuid, o_orderpriority AS \"@o_orderpriority\", o_custkey, "
           "o_orderkey, o_orderstatus, o_totalprice FROM orders")

CLEAN_TEXT = f"""
SELECT doc_id,
       lower(lower(regexp_replace(concat_ws(' ', lang, source), '[^a-zA-Z0-9_]', '.', 'g'))) AS lang_source,
       lower(regexp_replace(source, 'src', 'src_')) AS source_code,
       CAST(length({trim('text')}) AS BIGINT) AS text_len,
       CAST(length(replace(replace(text, ' ', ' - '), '_', ' ')) AS BIGINT) AS dashed_len,
       lower(upper(lang)) AS lang_upper
FROM documents WHERE NOT coalesce(regexp_matches(text, {q(C.SECRET_PATTERN)}), false)"""

CLEAN_HEADERS = ('SELECT event_id, user_id AS "user.id", event_type AS "event.type", value FROM events')

_ICONS = ", ".join(f"({q(k)}, {q(v)})" for k, v in C.STATUS_ICONS.items())
SITE_MERGE = f"""
WITH s AS (SELECT s_suppkey, s_name, s_nationkey,
                  coalesce(CASE WHEN s_acctbal < 0 THEN 'non_existent' WHEN s_acctbal < 3000 THEN 'inadequate'
                                WHEN s_acctbal < 6000 THEN 'adequate' END, 'not_applicable') AS b,
                  coalesce(CASE WHEN s_nationkey < 10 THEN 'adequate' WHEN s_nationkey < 20 THEN 'inadequate' END,
                           'not_applicable') AS n FROM supplier),
icons(status, path) AS (VALUES {_ICONS})
SELECT s_suppkey, s_name, i1.path AS "@balance_status", i2.path AS "@nation_status",
       './merge/test maps/YEM_CCCM_' || coalesce({trim('s_name')}, 'NA') || '__' ||
       coalesce(CAST(s_nationkey AS VARCHAR), 'NA') || '.pdf' AS "@maps"
FROM s LEFT JOIN icons i1 ON s.b = i1.status LEFT JOIN icons i2 ON s.n = i2.status"""

IO_ROUNDTRIP = """
SELECT c_custkey, c_name, c_acctbal, a.n_name AS nation_name, a.r_name AS region_name
FROM customer LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) a
  ON c_nationkey = a.n_nationkey"""

ORACLE_SQL = {
    "rule_range": RULE_RANGE,
    "rule_cross_field": RULE_CROSS,
    "rule_adequacy": RULE_ADEQUACY,
    "rule_prefix": RULE_PREFIX,
    "dup_keys": DUP_KEYS,
    "duration_check": DURATION,
    "outliers": OUTLIERS,
    "issue_log": ISSUE_LOG,
    "lookup_first": LOOKUP_FIRST,
    "lookup_frame": LOOKUP_FRAME,
    "dim_hierarchy": DIM_HIERARCHY,
    "apply_log": APPLY_LOG,
    "override_code": OVERRIDE_CODE,
    "recode_derive": RECODE_DERIVE,
    "append_new": APPEND_NEW,
    "membership": MEMBERSHIP,
    "site_codes": SITE_CODES,
    "group_totals": GROUP_TOTALS,
    "weighted_mode": WEIGHTED_MODE,
    "mode_first_seen": MODE_FIRST_SEEN,
    "indicator_join": INDICATOR_JOIN,
    "plan_shares": PLAN_SHARES,
    "plan_numeric": PLAN_NUMERIC,
    "auto_plan": AUTO_PLAN,
    "labelled_results": LABELLED_RESULTS,
    "multi_response": MULTI_RESPONSE,
    "merge_table": MERGE_TABLE,
    "merge_confints": MERGE_CONFINTS,
    "format_numbers": FORMAT_NUMBERS,
    "results_subset": RESULTS_SUBSET,
    "drop_policy": DROP_POLICY,
    "reorder": REORDER,
    "clean_text": CLEAN_TEXT,
    "clean_headers": CLEAN_HEADERS,
    "site_merge": SITE_MERGE,
    "io_roundtrip": IO_ROUNDTRIP,
}
