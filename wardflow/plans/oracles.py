"""The same results as ANSI SQL for DuckDB, over the tables read as clinical tables."""

from __future__ import annotations

from wardflow.plans.testdata import AS_OF, LOADED_AT

_INITCAP = r"""list_aggregate(list_transform(
    regexp_extract_all(lower({0}), '[^ \t\n\r\f\v!?@"^#$&~_,.:;+\-*%/|\\\[\](){{}}<>]*[ \t\n\r\f\v!?@"^#$&~_,.:;+\-*%/|\\\[\](){{}}<>]?'),
    lambda w: upper(w[1]) || w[2:]), 'string_agg', '')"""


def initcap(expr: str) -> str:
    return _INITCAP.format(expr)


_PATIENTS = """patients AS (
  SELECT CAST(c_custkey AS VARCHAR) AS pat_id,
         'MRN-' || CAST(c_custkey + 900000 AS VARCHAR) AS pat_mrn,
         c_mktsegment AS pat_first_name, c_name AS pat_last_name,
         DATE '1940-01-01' + CAST(c_custkey * 7919 % 25000 AS INTEGER) AS birth_date,
         left(z, 3) || '-' || substr(z, 4, 2) || '-' || right(z, 4) AS ssn,
         c_nationkey || ' ' || c_mktsegment || ' St' AS address_line_1,
         'City ' || c_nationkey AS city, 'RI' AS state,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
         '(401) 555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
         lower(c_mktsegment) || c_custkey || '@example.com' AS email,
         CASE WHEN c_nationkey < 20 THEN 'English' ELSE 'Spanish' END AS prim_language,
         CASE WHEN c_acctbal < 0 THEN 'Female' ELSE 'Male' END AS gender,
         TIMESTAMP '2024-10-01 00:00:00' AS load_ts
  FROM (SELECT *, lpad(CAST(c_custkey % 1000000000 AS VARCHAR), 9, '0') AS z FROM customer))"""

_DIM_PATIENT = f"""dim_patient AS (
  SELECT pat_id, pat_mrn, {initcap("pat_first_name")} AS first_name, {initcap("pat_last_name")} AS last_name,
         birth_date, CAST(year(DATE '{AS_OF}') - year(birth_date) AS INTEGER) AS age, ssn, address_line_1, city, state,
         zip_code, phone, email, prim_language, gender, load_ts AS source_loaded_at
  FROM patients)"""

_PROVIDERS = """providers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS prov_id, s_name AS prov_name, 'Specialty ' || s_nationkey AS specialty,
         'Dept ' || s_nationkey AS department, lpad(CAST(s_suppkey % 10000000000 AS VARCHAR), 10, '0') AS npi,
         s_acctbal > 0 AS active
  FROM supplier)"""

_ENCOUNTERS = """encounters AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id, CAST(o_custkey AS VARCHAR) AS pat_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Emergency' WHEN '2-HIGH' THEN 'Inpatient'
              ELSE 'Outpatient' END AS encounter_type,
         CAST(o_orderdate AS DATE) AS admit_date,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 12 AS INTEGER) END
           AS discharge_date,
         o_orderpriority AS department, CAST(o_custkey AS VARCHAR) AS attending_prov_id,
         o_orderstatus AS primary_dx_code, 'Diagnosis ' || o_orderstatus AS primary_dx_name,
         CASE WHEN o_orderstatus = 'F' THEN 'Discharged' ELSE 'Completed' END AS encounter_status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_charges, TIMESTAMP '2024-10-01 00:00:00' AS load_ts
  FROM orders)"""

_FACT = f"""fact_encounter AS (
  SELECT e.encounter_id, e.pat_id, e.encounter_type, e.admit_date, e.discharge_date,
         CAST(date_diff('day', e.admit_date, coalesce(e.discharge_date, DATE '{AS_OF}')) AS INTEGER) AS length_of_stay,
         e.department, e.attending_prov_id, p.prov_name AS attending_provider, p.specialty AS provider_specialty,
         e.primary_dx_code, e.primary_dx_name, e.encounter_status, e.total_charges, e.load_ts AS source_loaded_at
  FROM encounters e LEFT JOIN providers p ON e.attending_prov_id = p.prov_id)"""

_VISITS = f"""visits AS (
  SELECT CAST(event_id AS VARCHAR) AS encounter_id, CAST(user_id AS VARCHAR) AS pat_id,
         CASE event_type WHEN 'error' THEN 'Emergency' WHEN 'purchase' THEN 'Inpatient' ELSE 'Outpatient' END
           AS encounter_type,
         CAST(ts AS DATE) AS admit_date,
         date_diff('day', CAST(ts AS DATE),
           coalesce(CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) END, DATE '{AS_OF}')) AS length_of_stay,
         event_type AS department, CAST(value AS DECIMAL(12,2)) AS total_charges
  FROM events)"""

_LABS = """labs AS (
  SELECT l_orderkey || '-' || l_linenumber AS result_id, CAST(l_orderkey AS VARCHAR) AS encounter_id,
         CAST(l_partkey AS VARCHAR) AS pat_id, l_returnflag AS test_code, 'Panel ' || l_linestatus AS test_name,
         CAST(l_quantity AS DECIMAL(10,2)) AS result_value, 'mg/dL' AS result_unit,
         CAST(10 + l_tax * 100 AS DECIMAL(10,2)) AS reference_low,
         CASE WHEN l_discount > 0.09 THEN NULL ELSE CAST(40 AS DECIMAL(10,2)) END AS reference_high,
         l_shipdate AS result_date
  FROM lineitem),
fact_lab_results AS (
  SELECT result_id, encounter_id, pat_id, test_code, test_name, result_value, result_unit, reference_low,
         reference_high,
         CASE WHEN result_value > reference_high THEN 'HIGH' WHEN result_value < reference_low THEN 'LOW'
              ELSE 'NORMAL' END AS abnormal_flag,
         result_date
  FROM labs)"""

_VENDOR = """vendor AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN NULL
              WHEN o_orderpriority = '5-LOW' THEN 'BAD' || o_orderkey
              ELSE 'VL-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') END AS vendor_id,
         CASE WHEN o_totalprice < 20000 THEN NULL
              WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN 'MRN' || o_custkey
              ELSE 'MRN-' || lpad(CAST(o_custkey % 1000000 AS VARCHAR), 6, '0') END AS pat_mrn,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS test_code, 'Test ' || o_orderpriority AS test_name,
         CAST(o_orderkey AS VARCHAR) AS result_value, 'mg/dL' AS result_unit,
         CASE WHEN month(o_orderdate) <> 2 THEN CAST(o_orderdate AS DATE) END AS result_date,
         CASE WHEN o_orderstatus = 'F' THEN 'Y' WHEN o_orderstatus = 'O' THEN 'N'
              WHEN o_totalprice > 400000 THEN 'X' WHEN o_totalprice < 100000 THEN '' END AS abnormal_yn
  FROM orders),
checked AS (
  SELECT *, list_filter([
      CASE WHEN vendor_id IS NULL THEN 'VENDOR_ID is NULL'
           WHEN NOT regexp_full_match(vendor_id, 'VL-[0-9]{6}') THEN 'VENDOR_ID format invalid: ' || vendor_id END,
      CASE WHEN pat_mrn IS NULL THEN 'PAT_MRN is NULL'
           WHEN NOT regexp_full_match(pat_mrn, 'MRN-[0-9]{6}') THEN 'PAT_MRN format invalid: ' || pat_mrn END,
      CASE WHEN test_code IS NULL THEN 'TEST_CODE is NULL' END,
      CASE WHEN result_date IS NULL THEN 'RESULT_DATE is NULL' END,
      CASE WHEN abnormal_yn IS NOT NULL AND abnormal_yn NOT IN ('Y', 'N')
           THEN 'ABNORMAL_YN invalid value: ' || abnormal_yn END], lambda r: r IS NOT NULL) AS reasons
  FROM vendor)"""

_JSON_REASONS = """'[' || coalesce(list_aggregate(list_transform(reasons, lambda r: '"' || r || '"'), 'string_agg', ','), '') || ']'"""

_LOG = """log AS (
  SELECT event_type || '-' || user_id || '-' || event_id AS run_id, event_type AS step_name,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS log_level,
         'Step ''' || event_type || ''' of user ' || user_id || ' ended as ' || event_type || ' with code ' || k AS message,
         k, ts AS logged_at, CAST(user_id AS VARCHAR) AS batch_id, event_type
  FROM (SELECT *, CAST(regexp_extract(props, '"k": ?([0-9]+)', 1) AS BIGINT) AS k FROM events))"""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHOLE_SECOND = "date_trunc('second', {0})"


def _avg6(total: str, count: str) -> str:
    """A decimal average with six digits, rounded half up, as a double."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    micro = f"((CASE WHEN {cents} < 0 THEN -1 ELSE 1 END) * ((2 * abs({cents}) * 10000 + {count}) // (2 * {count})))"
    return f"CASE WHEN {count} > 0 THEN CAST({micro} AS DOUBLE) / 1000000 END"


def _summary(encounters: str) -> str:
    return f"""SELECT p.pat_id, p.pat_mrn, p.first_name || ' ' || p.last_name AS patient_name, p.age, p.gender,
      count(e.encounter_id) AS total_encounters,
      count(CASE WHEN e.encounter_type = 'Inpatient' THEN 1 END) AS inpatient_count,
      count(CASE WHEN e.encounter_type = 'Emergency' THEN 1 END) AS ed_visits,
      CAST(sum(e.total_charges) AS DECIMAL(22,2)) AS total_charges, max(e.admit_date) AS last_visit_date,
      coalesce(string_agg(DISTINCT e.department, ', ' ORDER BY e.department), '') AS departments_seen
    FROM dim_patient p LEFT JOIN {encounters} e ON p.pat_id = e.pat_id
    GROUP BY p.pat_id, p.pat_mrn, p.first_name, p.last_name, p.age, p.gender"""


def _dashboard(encounters: str) -> str:
    return f"""SELECT department, count(DISTINCT encounter_id) AS encounter_count,
      count(DISTINCT pat_id) AS unique_patients,
      count(CASE WHEN encounter_type = 'Inpatient' THEN 1 END) AS inpatient_count,
      count(CASE WHEN encounter_type = 'Emergency' THEN 1 END) AS ed_count,
      CAST(sum(length_of_stay) AS DOUBLE) / count(length_of_stay) AS avg_los,
      CAST(sum(total_charges) AS DECIMAL(22,2)) AS total_charges,
      {_avg6("sum(total_charges)", "count(total_charges)")} AS avg_charges
    FROM {encounters} GROUP BY department"""


_ROLLUP = f"""SELECT department, count(DISTINCT encounter_id) AS encounter_count,
      count(DISTINCT pat_id) AS unique_patients, {_avg6("sum(total_charges)", "count(total_charges)")} AS avg_charges,
      CAST(sum(total_charges) AS DECIMAL(22,2)) AS total_charges
    FROM encounters GROUP BY department"""

_FULL_FACT = f"{_PROVIDERS}, {_ENCOUNTERS}, {_FACT}"
_PEOPLE = f"{_PATIENTS}, {_DIM_PATIENT}"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _masked(first_name: str, ssn: str, string: str, dob: str) -> str:
    cols = ", ".join(f"{string.format(c)} AS {c}" for c in ("pat_mrn", "phone", "email"))
    return _with(
        _PATIENTS,
        f"SELECT pat_id, {first_name} AS pat_first_name, {ssn} AS ssn, {cols}, {dob} AS birth_date, city FROM patients",
    )


def _batch_health(key: str) -> str:
    first, last = _WHOLE_SECOND.format("min(logged_at)"), _WHOLE_SECOND.format("max(logged_at)")
    return f"""SELECT {key} AS batch_prefix,
      count(CASE WHEN log_level = 'INFO' THEN 1 END) AS info_count,
      count(CASE WHEN log_level = 'WARN' THEN 1 END) AS warn_count,
      count(CASE WHEN log_level = 'ERROR' THEN 1 END) AS error_count,
      CASE WHEN count(CASE WHEN log_level = 'ERROR' THEN 1 END) > 0 THEN 'RED'
           WHEN count(CASE WHEN log_level = 'WARN' THEN 1 END) > 0 THEN 'YELLOW' ELSE 'GREEN' END AS health_status,
      min(logged_at) AS started_at, max(logged_at) AS ended_at, date_diff('second', {first}, {last}) AS duration_sec
    FROM log GROUP BY 1"""


_PATTERNS = {
    "SSN": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "PHONE": r"(?:\+?1[-. ]?)?\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}",
    "MRN": r"MRN-[0-9]{6}",
}
# Columns of the patient table whose name alone suggests a category.
_NAMED = {
    ("ssn", "SSN"), ("email", "EMAIL"), ("phone", "PHONE"), ("pat_mrn", "MRN"), ("pat_first_name", "NAME"),
    ("pat_last_name", "NAME"), ("address_line_1", "ADDRESS"), ("birth_date", "DOB"),
}
_PATIENT_TEXT = (
    "pat_id pat_mrn pat_first_name pat_last_name ssn address_line_1 city state zip_code phone email prim_language gender"
).split()


def _classified(
    table: str, columns: list[str], named: set[tuple[str, str]], categories: list[str], threshold: float, full: bool
) -> str:
    match = "regexp_full_match" if full else "regexp_matches"
    parts = []
    for column in columns:
        for category in [*categories, *sorted({c for n, c in named if n == column} - set(categories))]:
            known = "true" if (column, category) in named else "false"
            if category in categories:
                hits = f"count(CASE WHEN {match}({column}, '{_PATTERNS[category]}') THEN 1 END)"
                n = f"count({column})"
            else:
                hits, n = "CAST(0 AS BIGINT)", "CAST(0 AS BIGINT)"
            parts.append(f"SELECT '{column}' AS column_name, '{category}' AS category, {n} AS n_values, "
                         f"{hits} AS n_matches, {known} AS name_match FROM {table}")  # fmt: skip
    for column, category in sorted(named):
        if column not in columns:
            parts.append(f"SELECT '{column}', '{category}', CAST(0 AS BIGINT), CAST(0 AS BIGINT), true FROM {table} LIMIT 1")
    union = " UNION ALL ".join(f"({p})" for p in parts)
    return f"""SELECT column_name, category, n_values, n_matches,
      CASE WHEN n_values > 0 THEN CAST(n_matches AS DOUBLE) / n_values ELSE 0.0::DOUBLE END AS match_rate, name_match,
      (CASE WHEN n_values > 0 THEN CAST(n_matches AS DOUBLE) / n_values ELSE 0 END) >= {threshold} OR name_match
        AS recommended
    FROM ({union})"""


def _aggregated(sql: str) -> str:
    """A part that tests no value still yields one row, also where its table has more."""
    return sql.replace("SELECT '", "SELECT DISTINCT '")


_PATIENT_CLASSES = _aggregated(_classified("patients", _PATIENT_TEXT, _NAMED, list(_PATTERNS), 0.8, True))
_VENDOR_CLASSES = _aggregated(
    _classified(
        "vendor",
        ["vendor_id", "pat_mrn", "test_code", "test_name", "result_value", "result_unit", "abnormal_yn"],
        {("pat_mrn", "MRN")},
        list(_PATTERNS),
        0.8,
        True,
    )
)


def _best(classes: str, table: str) -> str:
    return f"""SELECT 'PII_TYPE' AS tag_name, category AS tag_value, 'COLUMN' AS domain, 'LAB' AS object_database,
      'raw' AS object_schema, '{table}' AS object_name, column_name
    FROM (SELECT *, row_number() OVER (PARTITION BY column_name
            ORDER BY match_rate DESC, name_match DESC, category DESC) AS rank
          FROM ({classes}) WHERE recommended) WHERE rank = 1"""


_TAGS = f"""{_PATIENTS}, {_VENDOR}, refs AS (
  {_best(_PATIENT_CLASSES, "patient_dim")} UNION ALL {_best(_VENDOR_CLASSES, "vendor_labs")}),
labels_of(tag_value, label) AS (VALUES ('SSN', 'Highly Confidential'), ('MRN', 'Confidential'))"""

# A table is refreshed once for every drop that reaches it (see the drops in plans/queries.py).
_REFRESHES = """WITH drops AS (SELECT
    (SELECT count(*) > 0 FROM customer WHERE NOT c_custkey * 7919 % 25000 > date_diff('day', DATE '1940-01-01', DATE '1990-01-01')) AS p1,
    (SELECT count(*) > 0 FROM customer WHERE c_custkey * 7919 % 25000 > date_diff('day', DATE '1940-01-01', DATE '1990-01-01')) AS p3,
    (SELECT count(*) > 0 FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01') AS e1,
    (SELECT count(*) > 0 FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01') AS e2,
    (SELECT count(*) > 0 FROM orders, supplier WHERE o_custkey = s_suppkey) AS known,
    (SELECT count(*) > 0 FROM supplier) AS s2),
  facts AS (SELECT *, e1 AS f1, e2 OR known AS f2 FROM drops)
SELECT name, 'SUCCEEDED' AS state, CAST(n AS BIGINT) AS refreshes FROM (
  SELECT unnest([
    {name: 'curated.dim_patient', n: CAST(p1 AS INT) + CAST(p3 AS INT)},
    {name: 'curated.dim_provider', n: CAST(s2 AS INT)},
    {name: 'curated.fact_encounter', n: CAST(f1 AS INT) + CAST(e2 OR s2 AS INT)},
    {name: 'curated.encounter_partials', n: CAST(f1 AS INT) + CAST(f2 AS INT)},
    {name: 'gold.patient_encounter_summary', n: CAST(p1 OR f1 AS INT) + CAST(f2 AS INT) + CAST(p3 AS INT)},
    {name: 'gold.abnormal_results_summary', n: CAST(p1 OR f1 AS INT) + CAST(f2 AS INT) + CAST(p3 AS INT)},
    {name: 'gold.department_partials', n: CAST(f1 AS INT) + CAST(f2 AS INT)},
    {name: 'gold.department_encounter_counts', n: CAST(e1 AS INT) + CAST(e2 AS INT)},
    {name: 'gold.department_dashboard', n: CAST(f1 AS INT) + CAST(f2 AS INT)}], recursive := true)
  FROM facts) WHERE n > 0"""

_ABNORMAL = """SELECT lr.pat_id, p.first_name || ' ' || p.last_name AS patient_name, lr.test_name, lr.result_value,
             lr.result_unit, lr.reference_high, lr.abnormal_flag, lr.result_date, e.department, e.attending_provider
           FROM fact_lab_results lr JOIN fact_encounter e ON lr.encounter_id = e.encounter_id
           JOIN dim_patient p ON lr.pat_id = p.pat_id WHERE lr.abnormal_flag <> 'NORMAL'"""

ORACLES: dict[str, str] = {
    "dim_patient": _with(_PEOPLE, "SELECT * FROM dim_patient"),
    "dim_provider": _with(_PROVIDERS, "SELECT prov_id, prov_name, specialty, department, npi, active FROM providers"),
    "fact_encounter": _with(_FULL_FACT, "SELECT * FROM fact_encounter"),
    "fact_lab_results": _with(_LABS, "SELECT * FROM fact_lab_results"),
    "patient_encounter_summary": _with(f"{_PEOPLE}, {_FULL_FACT}", _summary("fact_encounter")),
    "patient_visit_summary": _with(f"{_PEOPLE}, {_VISITS}", _summary("visits")),
    "department_dashboard": _with(_FULL_FACT, _dashboard("fact_encounter")),
    "visit_dashboard": _with(_VISITS, _dashboard("visits")),
    "abnormal_results_summary": _with(f"{_PEOPLE}, {_FULL_FACT}, {_LABS}", _ABNORMAL),
    "department_rollup": _with(_ENCOUNTERS, _ROLLUP),
    "open_export": _with(_ENCOUNTERS, _ROLLUP),
    "layer_row_counts": " UNION ALL ".join(
        f"SELECT 'raw.{t}' AS layer, count(*) AS n_rows FROM {t}"
        for t in ("customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations")
    ),
    "estimated_counts": _with(
        _FULL_FACT,
        """SELECT department, count(DISTINCT encounter_id) AS encounter_count, count(DISTINCT pat_id) AS unique_patients,
             true AS encounters_close, true AS patients_close FROM fact_encounter GROUP BY department""",
    ),
    "lagged_dashboard": _with(_FULL_FACT, _dashboard("fact_encounter")),
    "republished_gold": _with(_FULL_FACT, _dashboard("fact_encounter")),
    "incremental_abnormal": _with(f"{_PEOPLE}, {_FULL_FACT}, {_LABS}", _ABNORMAL),
    "refresh_states": _REFRESHES,
    "incremental_summary": _with(f"{_PEOPLE}, {_FULL_FACT}", _summary("fact_encounter")),
    "incremental_dashboard": _with(_FULL_FACT, _dashboard("fact_encounter")),
    "filter_equal": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'",
    "filter_not_normal": _with(
        _LABS, "SELECT result_id, abnormal_flag FROM fact_lab_results WHERE abnormal_flag <> 'NORMAL'"
    ),
    "filter_in_list": "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup')",
    "filter_not_in_or_null": _with(
        _VENDOR,
        """SELECT result_value, abnormal_yn FROM vendor
           WHERE abnormal_yn IS NOT NULL AND abnormal_yn NOT IN ('Y', 'N')""",
    ),
    "recent_events": """SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 600 MINUTE
      AND ts <= TIMESTAMP '2024-01-15 12:00:00'""",
    "top_orders": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
      ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 20""",
    "latest_events": _with(
        _LOG, "SELECT run_id, log_level, logged_at FROM log ORDER BY logged_at DESC NULLS FIRST, run_id LIMIT 10"
    ),
    "text_functions": f"""SELECT p_partkey, {initcap("joined")} AS initcap, regexp_replace(joined, '[^0-9]', '', 'g') AS digits,
        right(p_brand, 4) AS tail, split_part(joined, '-', 1) || '-' || split_part(joined, '-', 2) AS prefix,
        replace(p_name, ' ', 'T') AS replaced, regexp_full_match(p_brand, 'Brand#[0-9]') AS one_digit_brand,
        left(p_name, 5) || '...' AS short, coalesce(nullif(p_type, 'SMALL'), 'NONE') AS type_or_none
      FROM (SELECT *, upper(p_name) || '-' || p_brand || '-' || 'o''neil_x' AS joined FROM part)""",
    "cleaned_phones": _with(
        _PATIENTS,
        "SELECT pat_id, phone AS raw_phone, regexp_replace(phone, '[^0-9]', '', 'g') AS cleaned_phone FROM patients",
    ),
    "date_functions": f"""SELECT o_orderkey, date_diff('year', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS years,
      date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS days FROM orders""",
    "time_functions": """SELECT event_id, date_trunc('hour', ts) AS hour,
      date_diff('second', TIMESTAMP '2024-01-01 00:00:00', date_trunc('second', ts)) AS seconds FROM events""",
    "json_details": """SELECT event_id, CAST(regexp_extract(props, '"k": ?([0-9]+)', 1) AS BIGINT) AS k,
      CAST(NULL AS VARCHAR) AS missing FROM events""",
    "run_summary": _with(
        _LOG,
        """SELECT date_trunc('hour', logged_at) AS log_hour, step_name, log_level, count(*) AS event_count,
             min(logged_at) AS first_event, max(logged_at) AS last_event FROM log GROUP BY 1, 2, 3""",
    ),
    "batch_health": _with(_LOG, _batch_health("split_part(run_id, '-', 1) || '-' || split_part(run_id, '-', 2)")),
    "batch_health_by_id": _with(_LOG, _batch_health("batch_id")),
    "import_details": _with(
        _LOG,
        """SELECT run_id, message, k AS rows_loaded, event_type AS target_table, batch_id FROM log
           WHERE event_type = 'purchase'""",
    ),
    "quarantine_details": _with(
        _LOG,
        """SELECT run_id, message, k * 2 AS accepted, k AS quarantined, batch_id FROM log
           WHERE event_type = 'signup'""",
    ),
    "problem_events": _with(
        _LOG, "SELECT run_id, step_name, log_level, message, logged_at FROM log WHERE log_level IN ('WARN', 'ERROR')"
    ),
    "error_patterns": _with(
        _LOG,
        """SELECT regexp_replace(regexp_replace(message, '''[^'']*''|"[^"]*"', '<text>', 'g'), '[0-9]+', '<n>', 'g')
             AS template, count(*) AS event_count, min(logged_at) AS first_event, max(logged_at) AS last_event
           FROM log WHERE log_level IN ('ERROR', 'WARN') GROUP BY 1""",
    ),
    "top_error_patterns": _with(
        _LOG,
        """SELECT regexp_replace(regexp_replace(message, '''[^'']*''|"[^"]*"', '<text>', 'g'), '[0-9]+', '<n>', 'g')
             AS template, count(*) AS event_count, min(logged_at) AS first_event, max(logged_at) AS last_event
           FROM log GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 2""",
    ),
    "events_of_run": _with(
        _LOG,
        """SELECT run_id, step_name, log_level, message, logged_at FROM log WHERE run_id =
             (SELECT run_id FROM log ORDER BY logged_at DESC NULLS FIRST, run_id LIMIT 1)""",
    ),
    "recent_error_flag": _with(
        _LOG,
        """SELECT now AS checked_at, EXISTS (SELECT 1 FROM log WHERE log_level = 'ERROR' AND logged_at > now - INTERVAL 5 MINUTE)
             AS has_errors
           FROM (VALUES (TIMESTAMP '2024-01-15 12:00:00'), (TIMESTAMP '2024-01-20 00:00:00'),
                        (TIMESTAMP '2023-01-01 00:00:00')) AS t(now)""",
    ),
    "log_views_by_sql": _with(
        f"""{_LOG}, parts AS (SELECT *, split_part(run_id, '-', 1) || '-' || split_part(run_id, '-', 2) AS batch FROM log),
            health AS (SELECT batch, CASE WHEN bool_or(log_level = 'ERROR') THEN 'RED'
                         WHEN bool_or(log_level = 'WARN') THEN 'YELLOW' ELSE 'GREEN' END AS health_status,
                         nullif(count(CASE WHEN log_level IN ('WARN', 'ERROR') THEN 1 END), 0) AS problems
                       FROM parts GROUP BY batch)""",
        """SELECT health_status, count(*) AS batches, CAST(sum(problems) AS BIGINT) AS problems FROM health
           GROUP BY health_status""",
    ),
    "detail_misfits": """SELECT (SELECT count(props) FROM events) + (SELECT count(text) FROM documents) AS n_details,
      (SELECT count(text) FROM documents) AS n_misfits""",
    "error_alerts": _with(
        _LOG,
        """SELECT time_bucket(INTERVAL 5 MINUTE, logged_at) AS window_start,
             time_bucket(INTERVAL 5 MINUTE, logged_at) + INTERVAL 5 MINUTE AS window_end,
             count(*) AS error_count, max(logged_at) AS last_error
           FROM log WHERE log_level = 'ERROR' GROUP BY 1, 2""",
    ),
    "raised_alerts": _with(
        f"""{_LOG}, errors AS (SELECT batch_id, logged_at, CASE WHEN logged_at < lag(logged_at) OVER w + INTERVAL 720 MINUTE THEN 0 ELSE 1 END AS fresh
              FROM log WHERE log_level = 'ERROR' AND logged_at IS NOT NULL WINDOW w AS (PARTITION BY batch_id ORDER BY logged_at)),
            spells AS (SELECT batch_id, min(logged_at) AS first_error, max(logged_at) AS last_error, count(*) AS error_count
              FROM (SELECT *, sum(fresh) OVER (PARTITION BY batch_id ORDER BY logged_at) AS spell FROM errors) GROUP BY batch_id, spell),
            ends AS (SELECT *, last_error + INTERVAL 720 MINUTE AS quiet,
              lead(first_error) OVER (PARTITION BY batch_id ORDER BY first_error) AS next_error FROM spells)""",
        """SELECT batch_id, 'RAISED' AS event, first_error AS at, first_error, last_error, error_count FROM ends
           UNION ALL SELECT batch_id, 'CLEARED', quiet, first_error, last_error, error_count FROM ends
           WHERE next_error IS NOT NULL OR quiet <= (SELECT max(logged_at) - INTERVAL 10 MINUTE FROM log)""",
    ),
    "streamed_run_summary": _with(
        _LOG,
        """SELECT date_trunc('hour', logged_at) AS log_hour, step_name, log_level, count(*) AS event_count,
             min(logged_at) AS first_event, max(logged_at) AS last_event FROM log GROUP BY 1, 2, 3""",
    ),
    "validated_rows": _with(
        _VENDOR, f"SELECT result_value, len(reasons) = 0 AS is_valid, {_JSON_REASONS} AS reasons FROM checked"
    ),
    "routed_rows": _with(
        _VENDOR,
        """SELECT vendor_id, pat_mrn, test_code, test_name, result_value, result_unit, result_date, abnormal_yn,
             'BATCH-001' AS batch_id, CASE WHEN len(reasons) = 0 THEN 'accepted' ELSE 'quarantined' END AS status
           FROM checked""",
    ),
    "validated_by_sql": _with(
        _VENDOR, f"SELECT result_value, len(reasons) = 0 AS is_valid, {_JSON_REASONS} AS reasons FROM checked"
    ),
    "misfit_quarantine": _with(
        f"""{_VENDOR}, odd AS (SELECT *, CASE WHEN abnormal_yn = 'Y' THEN strftime(result_date, '%d.%m.%Y') END AS odd_date
              FROM checked),
            renamed AS (SELECT result_value, odd_date, CASE WHEN odd_date IS NULL THEN reasons ELSE list_filter([
                CASE WHEN vendor_id IS NULL THEN 'VENDOR_ID is NULL'
                     WHEN NOT regexp_full_match(vendor_id, 'VL-[0-9]{{6}}') THEN 'VENDOR_ID format invalid: ' || vendor_id END,
                CASE WHEN pat_mrn IS NULL THEN 'PAT_MRN is NULL'
                     WHEN NOT regexp_full_match(pat_mrn, 'MRN-[0-9]{{6}}') THEN 'PAT_MRN format invalid: ' || pat_mrn END,
                CASE WHEN test_code IS NULL THEN 'TEST_CODE is NULL' END,
                'RESULT_DATE format invalid: ' || odd_date], lambda r: r IS NOT NULL) END AS reasons FROM odd)""",
        f"""SELECT result_value, {_JSON_REASONS} AS reasons, odd_date AS rejected_date FROM renamed WHERE len(reasons) > 0""",
    ),
    "deleted_batch": _with(
        f"""{_VENDOR}, n AS (SELECT count(CASE WHEN len(reasons) = 0 THEN 1 END) AS a,
              count(CASE WHEN len(reasons) > 0 THEN 1 END) AS q FROM checked)""",
        """SELECT 'BATCH-001' AS batch_id, 'DELETED' AS state, CAST(0 AS BIGINT) AS accepted, CAST(0 AS BIGINT) AS quarantined,
             CAST(NULL AS BIGINT) AS n_rows
           UNION ALL SELECT 'BATCH-002', 'ROUTED', a, q, a + q FROM n""",
    ),
    "failed_rerun": _with(
        f"""{_VENDOR}, n AS (SELECT count(CASE WHEN len(reasons) = 0 THEN 1 END) AS a,
              count(CASE WHEN len(reasons) > 0 THEN 1 END) AS q FROM checked)""",
        """SELECT 'BATCH-001' AS batch_id, CASE WHEN len(reasons) = 0 THEN 'accepted' ELSE 'quarantined' END AS status, count(*) AS n_rows,
             'ROUTED' AS state, 'FAILED' AS last_run, any_value(a) AS accepted, any_value(q) AS quarantined, 'FAILED' AS second_run,
             'SKIPPED' AS third_run FROM checked, n GROUP BY 2""",
    ),
    "merged_batch": _with(
        f"""{_VENDOR}, both_runs AS (SELECT result_value, CAST(result_value AS BIGINT) % 3 = 1 AS old, result_unit, abnormal_yn,
              list_filter(reasons, lambda r: NOT starts_with(r, 'ABNORMAL_YN')) AS rest, reasons FROM checked),
            merged AS (SELECT result_value, CASE WHEN old THEN result_unit ELSE 'mmol/L' END AS result_unit,
              CASE WHEN old THEN abnormal_yn ELSE 'N' END AS abnormal_yn,
              CASE WHEN len(CASE WHEN old THEN reasons ELSE rest END) = 0 THEN 'accepted' ELSE 'quarantined' END AS status
              FROM both_runs)""",
        """SELECT 'BATCH-001' AS batch_id, *, (SELECT count(*) FROM merged WHERE status = 'accepted') AS accepted FROM merged""",
    ),
    "failed_replace": """SELECT c_custkey, c_name, c_acctbal, k AS kept_in FROM customer, (VALUES ('folder'), ('table')) t(k)""",
    "skipped_batch": _with(
        _VENDOR,
        """SELECT CASE WHEN len(reasons) = 0 THEN 'accepted' ELSE 'quarantined' END AS status, count(*) AS n_rows,
             'SKIPPED' AS second_run FROM checked GROUP BY 1""",
    ),
    "rerouted_counts": _with(
        _VENDOR,
        """SELECT 'BATCH-001' AS batch_id, CASE WHEN len(reasons) = 0 THEN 'accepted' ELSE 'quarantined' END AS status,
             count(*) AS n_rows FROM checked GROUP BY 2""",
    ),
    "quarantine_report": _with(
        _VENDOR,
        f"""SELECT vendor_id, pat_mrn, test_code, 'BATCH-002' AS batch_id, {_JSON_REASONS} AS reasons
            FROM checked WHERE len(reasons) > 0""",
    ),
    "batch_log": _with(
        f"""{_VENDOR}, n AS (SELECT count(CASE WHEN len(reasons) = 0 THEN 1 END) AS a,
              count(CASE WHEN len(reasons) > 0 THEN 1 END) AS q FROM checked)""",
        """SELECT 'PROCESS_VENDOR_BATCH' AS step_name, l AS log_level, m AS message, d AS detail FROM (
             SELECT 'INFO' AS l, 'Processing vendor batch: drifted as DRIFT-001' AS m, NULL AS d
             UNION ALL SELECT 'WARN', 'Schema drift detected: incoming has 9 columns, expected 8',
               '{"expected_cols":8,"incoming_cols":9}'
             UNION ALL SELECT 'INFO', 'Batch complete: ' || a || ' accepted, ' || q || ' quarantined',
               '{"accepted":' || a || ',"batch_id":"DRIFT-001","quarantined":' || q || '}' FROM n
             UNION ALL SELECT 'WARN', q || ' rows quarantined - review the quarantine table', NULL FROM n WHERE q > 0)""",
    ),
    "reason_counts": _with(
        _VENDOR,
        """SELECT split_part(reason, ':', 1) AS reason, count(*) AS n_rows
           FROM (SELECT unnest(reasons) AS reason FROM checked) GROUP BY 1""",
    ),
    "drift_report": _with(
        _VENDOR,
        """SELECT 'retyped' AS kind, 'result_value' AS column_name, 'string' AS expected_type,
             'bigint' AS incoming_type, count(result_value) AS rows_with_value FROM vendor
           UNION ALL SELECT 'missing', 'result_unit', 'string', NULL, 0
           UNION ALL SELECT 'extra', 'lab_site', NULL, 'string', count(abnormal_yn) FROM vendor
           UNION ALL SELECT 'extra', 'file_version', NULL, 'string', count(*) FROM vendor""",
    ),
    "normalized_formats": """SELECT o_orderkey, 'VL-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS vendor_id,
        'MRN-' || lpad(CAST(o_custkey % 1000000 AS VARCHAR), 6, '0') AS pat_mrn,
        CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS result_date,
        CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS abnormal_yn
      FROM orders""",
    "import_all": """SELECT 'orders' AS source_table, 'SUCCESS' AS status, count(*) AS rows_loaded,
        'SUCCESS' AS last_run_status FROM orders
      UNION ALL SELECT 'customer', 'SUCCESS', count(*), 'SUCCESS' FROM customer
      UNION ALL SELECT 'lineitem', 'SUCCESS', count(*), 'SUCCESS' FROM lineitem
      UNION ALL SELECT 'nowhere', 'FAILED', NULL, 'FAILED'
      UNION ALL SELECT 'part', NULL, NULL, NULL""",
    "import_duplicates": """SELECT t AS target_table, count(*) AS n_rows, 'SUCCESS' AS status, CAST(0 AS BIGINT) AS stamped_before
      FROM orders, (VALUES ('first_copy'), ('second_copy')) AS v(t) GROUP BY t""",
    "declared_defaults": _with(_PROVIDERS, "SELECT prov_id, department, true AS active FROM providers"),
    "imported_rows": f"SELECT *, TIMESTAMP '{LOADED_AT}' AS loaded_at, 'BATCH-7' AS batch_id FROM customer",
    "masked_patients_admin": _masked("pat_first_name", "ssn", "{0}", "birth_date"),
    "masked_patients_clinician": _masked("pat_first_name", "'***-**-' || right(ssn, 4)", "{0}", "birth_date"),
    "masked_patients_analyst": _masked(
        "'***MASKED***'", "'***-**-****'", "'***MASKED***'", "CAST(NULL AS DATE)"
    ),
    "governed_view_clinician": _with(
        _PATIENTS, "SELECT pat_id, '***-**-' || right(ssn, 4) AS ssn, pat_first_name, ssn AS copied_ssn FROM patients"
    ),
    "governed_view_analyst": _with(
        _PATIENTS, "SELECT pat_id, '***-**-****' AS ssn, '***MASKED***' AS pat_first_name, ssn AS copied_ssn FROM patients"
    ),
    "filter_on_masked": "SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_values FROM customer",
    "row_policy_admin": _with(_PROVIDERS, "SELECT prov_id, department FROM providers"),
    "row_policy_clinician": _with(
        _PROVIDERS,
        """SELECT prov_id, department FROM providers WHERE EXISTS (SELECT 1 FROM nation
             WHERE n_regionkey <= 1 AND 'Dept ' || n_nationkey = providers.department)""",
    ),
    "row_policy_analyst": _with(_PROVIDERS, "SELECT prov_id, department FROM providers"),
    "row_policy_visitor": _with(_PROVIDERS, "SELECT prov_id, department FROM providers WHERE false"),
    "classified_columns": _with(_PATIENTS, _PATIENT_CLASSES),
    "classified_documents": _aggregated(
        _classified("documents", ["text", "source"], set(), ["SSN", "EMAIL", "PHONE"], 0.01, False)
    ),
    "recommended_tags": _with(_TAGS, "SELECT * FROM refs"),
    "tag_search": _with(
        _TAGS,
        """SELECT object_database, object_schema, object_name, column_name, tag_value FROM refs
           WHERE tag_name = 'PII_TYPE' AND tag_value = 'MRN'""",
    ),
    "tagged_columns": _with(_TAGS, "SELECT tag_name, count(*) AS tagged_columns FROM refs GROUP BY tag_name"),
    "inherited_masks": """WITH known AS (
        SELECT doc_id, lang, text AS piece FROM documents UNION ALL SELECT conv_id, 'turn', role FROM conversations)
      SELECT lang, '***MASKED***' AS last_piece, CAST(NULL AS BIGINT) AS n_chars, count(piece) AS n_pieces, max(quality) AS best, count(*) AS n_rows
      FROM known LEFT JOIN labels USING (doc_id) GROUP BY lang""",
    "label_mapping": _with(
        _TAGS, "SELECT object_name, column_name, tag_value, label FROM refs LEFT JOIN labels_of USING (tag_value)"
    ),
    "label_gaps": _with(
        _TAGS,
        """SELECT object_name, column_name, tag_value FROM refs
           WHERE tag_value NOT IN (SELECT tag_value FROM labels_of)""",
    ),
    "tag_masked_documents": "SELECT lang, '***MASKED***' AS loud, count(*) AS n_docs FROM documents GROUP BY lang",
    "note_previews": "SELECT doc_id, lang, left(text, 120) || '...' AS preview FROM documents",
    "note_summaries": r"""SELECT doc_id, trim(coalesce(list_aggregate(
        list_slice(regexp_extract_all(text, '[^.!?]+[.!?]*'), 1, 2), 'string_agg', ''), '')) AS summary FROM documents""",
    "extracted_fields": rf"""SELECT doc_id, nullif(regexp_extract(text, '{_PATTERNS["EMAIL"]}'), '') AS email,
        nullif(regexp_extract(text, '[0-9]+'), '') AS first_number,
        nullif(regexp_extract(text, '[A-Za-z]+'), '') AS first_word FROM documents""",
    "looked_up_annotations": """SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d
      LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "described_parts": """SELECT p_partkey,
      'Type: ' || p_type || ', Brand: ' || p_brand || ', Name: ' || p_name AS ai_description FROM part""",
    "review_tiers": """SELECT p_partkey, CASE WHEN p_size > 10 THEN 'Complex - recommend genomics board review'
        WHEN p_size > 5 THEN 'Moderate - standard oncology review' ELSE 'Simple - routine follow-up' END AS tier,
        CASE WHEN p_size > 30 THEN 'large' WHEN p_size > 15 THEN 'medium' ELSE 'small' END AS size_class FROM part""",
    "categorized_turns": r"""SELECT role, CASE WHEN regexp_matches(text, '[0-9]') THEN 'numbers'
        WHEN regexp_matches(text, '\?') THEN 'question' WHEN regexp_matches(text, '\n') THEN 'list' ELSE 'other' END
        AS category, count(*) AS n_turns FROM conversations GROUP BY 1, 2""",
    "modelled_notes": """SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN '' WHEN text IS NULL THEN NULL WHEN trim(text) = '' THEN ''
        ELSE len(regexp_extract_all(text, '[A-Za-z]+')) || ' words' END AS summary, CAST(NULL AS VARCHAR) AS problem FROM documents""",
    "ruled_turns": f"""WITH words AS (SELECT word, count(*) AS priority FROM (
          SELECT unnest(regexp_extract_all({_LOWERED}, '[a-z0-9]+')) AS word FROM benchmark) GROUP BY word),
        rules AS (SELECT word, priority, 'word of ' || lpad(CAST(length(word) AS VARCHAR), 2, '0') AS category FROM words),
        spoken AS (SELECT conv_id, turn, unnest(regexp_extract_all({_LOWERED}, '[a-z0-9]+')) AS word FROM conversations),
        first_rule AS (SELECT conv_id, turn, min((priority, category)) AS f FROM spoken JOIN rules USING (word) GROUP BY conv_id, turn)
      SELECT role, coalesce(f[2], 'other') AS category, count(*) AS n_turns
      FROM conversations LEFT JOIN first_rule USING (conv_id, turn) GROUP BY 1, 2""",
    "listed_graph": """SELECT name, lag AS target_lag, state AS scheduling_state, inputs, (SELECT count(*) FROM customer) AS summary_rows FROM (VALUES
        ('curated.dim_patient', '1 minute', 'SUCCEEDED', 'raw.patient_dim'),
        ('curated.dim_provider', '1 minute', 'NEVER REFRESHED', 'raw.provider_dim'),
        ('curated.encounter_partials', 'DOWNSTREAM', 'NEVER REFRESHED', 'curated.fact_encounter'),
        ('curated.fact_encounter', '1 minute', 'SUCCEEDED', 'raw.encounter_fact, raw.provider_dim'),
        ('curated.fact_lab_results', '1 minute', 'NEVER REFRESHED', 'raw.lab_results'),
        ('gold.abnormal_results_summary', '1 hour', 'NEVER REFRESHED', 'curated.fact_lab_results, curated.fact_encounter, curated.dim_patient'),
        ('gold.department_dashboard', '1 hour', 'NEVER REFRESHED', 'gold.department_partials, gold.department_encounter_counts'),
        ('gold.department_encounter_counts', 'DOWNSTREAM', 'NEVER REFRESHED', 'raw.encounter_keys'),
        ('gold.department_partials', 'DOWNSTREAM', 'NEVER REFRESHED', 'curated.encounter_partials'),
        ('gold.patient_encounter_summary', '1 hour', 'SUCCEEDED', 'curated.dim_patient, curated.encounter_partials')) t(name, lag, state, inputs)""",
    "protected_columns": _with(
        _PATIENTS,
        """SELECT CASE column_name WHEN 'ssn' THEN 'MASK_SSN' WHEN 'birth_date' THEN 'MASK_DOB' ELSE 'MASK_PII_STRING' END AS policy_name,
             'MASKING_POLICY' AS policy_kind, column_name, CASE WHEN column_name NOT IN ('ssn', 'birth_date') THEN 'PII_TYPE' END AS tag_name, n AS n_values
           FROM (UNPIVOT (SELECT count(ssn) AS ssn, count(pat_first_name) AS pat_first_name, count(pat_last_name) AS pat_last_name, count(email) AS email,
             count(phone) AS phone, count(address_line_1) AS address_line_1, count(birth_date) AS birth_date, count(pat_mrn) AS pat_mrn FROM patients)
             ON COLUMNS(*) INTO NAME column_name VALUE n)""",
    ),
    "schema_scan": """SELECT 'customer' AS table_name, column_index AS ordinal, column_name, n AS n_values
        FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM customer) ON COLUMNS(*) INTO NAME column_name VALUE n)
        JOIN (SELECT column_name, column_index FROM duckdb_columns() WHERE table_name = 'customer') USING (column_name)
      UNION ALL SELECT 'documents', column_index, column_name, n
        FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM documents) ON COLUMNS(*) INTO NAME column_name VALUE n)
        JOIN (SELECT column_name, column_index FROM duckdb_columns() WHERE table_name = 'documents') USING (column_name)""",
    "whole_text_files": """SELECT s_nationkey, string_agg(line, '|' ORDER BY line) AS suppliers
      FROM (SELECT s_nationkey, s_suppkey || ',' || s_name AS line FROM supplier) GROUP BY s_nationkey""",
}
