"""Oracle SQL (DuckDB dialect) for every registered query.

Each string is self-contained: a WITH prefix derives the hiring tables from
the driver's views (customer, nation, part, orders, lineitem) with the same
integer arithmetic as ``hirelens.sources.binding``. The queries are stated
apart from the Spark plans: the lifecycle is a filtered aggregate of the events
joined to the applications, the transitions are an unnested list of structs,
the exception rules are one table of (rule, condition) applied to each
lifecycle row, duplicates an EXISTS, percentiles ``quantile_cont``.

Doubles are rounded to 6 decimals on both sides; the evaluation time of the
exception log is a literal on both sides.
"""

from __future__ import annotations

from hirelens.schemas import SPECS

STAGE_CASE = (
    "CASE {c} WHEN 1 THEN 'APPLIED' WHEN 2 THEN 'SCREEN' WHEN 3 THEN 'ONSITE' WHEN 4 THEN 'OFFER' "
    "WHEN 5 THEN 'HIRED' WHEN 6 THEN 'REJECTED' WHEN 7 THEN 'WITHDRAWN' END"
)
def _days(a: str, b: str) -> str:
    return f"date_diff('microsecond', {a}, {b}) / 86400000000.0::DOUBLE"


BINDING = f"""
candidates AS (
  SELECT c_custkey AS candidate_id, TIMESTAMP '1995-01-01' AS created_at, c_mktsegment AS source, n_name AS location,
         CAST(floor(c_acctbal / 200) AS INTEGER) AS years_experience, left(sha256(c_name), 16) AS email_hash
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
requisitions AS (
  SELECT p_partkey AS req_id, p_type AS org, p_brand AS job_family,
         'IC' || repeat(CAST(1 + p_size % 6 AS VARCHAR), CASE WHEN p_size = 50 THEN 9 ELSE 1 END) AS level,
         TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey % 1000 AS INTEGER)) AS open_date,
         CASE WHEN p_partkey % 5 <> 0 THEN TIMESTAMP '1995-01-01' + to_days(CAST(floor(p_retailprice - 100) AS INTEGER)) END AS close_date
  FROM part
),
applications AS (
  SELECT o_orderkey AS application_id, o_custkey AS candidate_id, o_custkey + o_orderkey % 4 AS req_id,
         o_orderdate AS apply_ts, nullif(o_orderkey % 35, 0) AS recruiter_id
  FROM orders
),
lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS event_id,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 97 = 0 THEN -1 - l_orderkey ELSE l_orderkey END AS application_id,
         {STAGE_CASE.format(c="l_linenumber")} AS stage,
         o_orderdate + to_hours(CAST(96 * (least(l_linenumber, 5) - 1) + CAST(trunc(l_quantity) AS INTEGER)
             - CASE WHEN l_discount >= CAST(0.09 AS DOUBLE) THEN 240 ELSE 0 END AS BIGINT)) AS stage_ts,
         CASE l_returnflag WHEN 'A' THEN 'Recruiter' WHEN 'N' THEN 'System' WHEN 'R' THEN 'Candidate' END AS actor_type,
         l_suppkey, l_partkey, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
stage_events_raw AS (SELECT event_id, application_id, stage, stage_ts, actor_type FROM lines),
stage_events AS (SELECT * FROM stage_events_raw WHERE application_id IN (SELECT application_id FROM applications)),
offers AS (
  SELECT concat_ws('-', l_partkey, l_suppkey, l_returnflag) AS offer_id, application_id,
         CASE WHEN l_partkey % 53 <> 52 THEN stage_ts - to_days(CASE WHEN l_suppkey % 10 = 0 THEN 10 ELSE 0 END) END AS offer_ts,
         CASE l_returnflag WHEN 'A' THEN 'ACCEPTED' WHEN 'R' THEN 'DECLINED' WHEN 'N' THEN 'EXPIRED' END AS decision,
         CASE WHEN l_partkey % 31 <> 30 THEN substr('ABC', CAST(1 + l_partkey % 3 AS INTEGER), 1) END AS comp_band
  FROM lines WHERE stage = 'OFFER'
),
hires AS (
  SELECT event_id AS hire_id, application_id, stage_ts AS hired_ts,
         CAST(stage_ts AS DATE) + CAST(14 + l_suppkey % 32 AS INTEGER) AS start_date
  FROM lines WHERE stage = 'HIRED' AND l_returnflag = 'A'
)"""

STAGE_NAMES = "['APPLIED', 'SCREEN', 'ONSITE', 'OFFER', 'HIRED', 'REJECTED', 'WITHDRAWN']"
_STAGE_TIMES = ", ".join(
    f"max(stage_ts) FILTER (stage = '{s.upper()}') AS {s}_ts" for s in ("applied", "screen", "onsite", "offer", "hired", "rejected", "withdrawn")
)
#: name, begin, end, target in days
_STEPS = (
    ("APPLIED_TO_SCREEN", "days_applied_to_screen", "applied_ts", "screen_ts", 3),
    ("SCREEN_TO_ONSITE", "days_screen_to_onsite", "screen_ts", "onsite_ts", 10),
    ("ONSITE_TO_OFFER", "days_onsite_to_offer", "onsite_ts", "offer_ts", 7),
    ("OFFER_TO_DECISION", "days_offer_to_decision", "offer_ts", "decided_ts", 5),
)
_DAYS = ", ".join(f"{_days(a, b)} AS {d}" for _, d, a, b, _ in _STEPS)
_STEP_LIST = ", ".join(f"{{'n': '{n}', 's': {a}, 'e': {b}, 'd': {d}, 't': {t}}}" for n, d, a, b, t in _STEPS)
#: condition on a lifecycle row, kind, severity, text
_LIFE_RULES = (
    ("screen_ts > onsite_ts", "STAGE_ORDER_VIOLATION", "HIGH", "screen happened after onsite"),
    ("onsite_ts > offer_ts", "STAGE_ORDER_VIOLATION", "HIGH", "onsite happened after offer"),
    ("least(" + ", ".join(d for _, d, *_ in _STEPS) + ") < 0", "NEGATIVE_DURATION", "HIGH", "at least one stage duration is negative"),
    (
        "(hired_ts IS NOT NULL)::INT + (rejected_ts IS NOT NULL)::INT + (withdrawn_ts IS NOT NULL)::INT > 1",
        "MULTIPLE_TERMINAL_EVENTS",
        "HIGH",
        "more than one of hired, rejected, withdrawn is recorded",
    ),
)
_RULE_LIST = ", ".join(f"{{'hit': {c}, 'kind': '{k}', 'sev': '{s}', 'txt': '{t}'}}" for c, k, s, t in _LIFE_RULES)

REPORTING = f"""
per_app AS (
  SELECT application_id, {_STAGE_TIMES},
         arg_max(stage, {{'at': stage_ts, 'place': list_position({STAGE_NAMES}, stage)}}) AS latest_stage,
         max(stage_ts) AS latest_stage_ts
  FROM stage_events GROUP BY application_id
),
timed AS (SELECT *, coalesce(hired_ts, rejected_ts, withdrawn_ts) AS decided_ts FROM applications LEFT JOIN per_app USING (application_id)),
life AS (
  SELECT t.*, c.source, r.org, r.job_family,
         CASE WHEN list_position({STAGE_NAMES}, latest_stage) > 4 THEN latest_stage END AS terminal_stage,
         {_DAYS}, {_days('applied_ts', 'hired_ts')} AS total_time_to_hire
  FROM timed t LEFT JOIN candidates c USING (candidate_id) LEFT JOIN requisitions r USING (req_id)
),
sla_transitions AS (
  SELECT application_id, recruiter_id, org, x.n AS transition_name, x.s AS start_ts, x.e AS end_ts, x.d AS duration_days,
         CAST(x.t AS INTEGER) AS sla_days
  FROM (SELECT application_id, recruiter_id, org, unnest([{_STEP_LIST}]) AS x FROM life)
  WHERE x.d IS NOT NULL
),
sla_breaches AS (SELECT *, duration_days > sla_days AS is_breach FROM sla_transitions WHERE duration_days >= 0),
of_life AS (
  SELECT x.kind AS exception_type, x.sev AS severity, application_id, x.txt AS details
  FROM (SELECT application_id, unnest([{_RULE_LIST}]) AS x FROM life) WHERE x.hit
),
of_offers AS (
  SELECT CASE WHEN onsite_ts IS NULL THEN 'OFFER_WITHOUT_ONSITE' ELSE 'OFFER_BEFORE_ONSITE' END AS exception_type,
         'MED' AS severity, o.application_id,
         CASE WHEN onsite_ts IS NULL THEN 'offer record exists but no onsite stage was recorded'
              ELSE 'offer record is dated before the onsite stage' END AS details
  FROM offers o JOIN timed USING (application_id)
  WHERE onsite_ts IS NULL OR o.offer_ts < onsite_ts
),
of_applications AS (
  SELECT 'DUPLICATE_APPLICATION' AS exception_type, 'MED' AS severity, application_id,
         format('candidate {{}} applied to requisition {{}} more than once within 30 days', candidate_id, req_id) AS details
  FROM applications a
  WHERE EXISTS (FROM applications b WHERE b.candidate_id = a.candidate_id AND b.req_id = a.req_id
                  AND b.application_id < a.application_id AND a.apply_ts - b.apply_ts BETWEEN INTERVAL 0 DAY AND INTERVAL 30 DAY)
  UNION ALL
  SELECT 'MISSING_RECRUITER', 'LOW', application_id, 'application has no recruiter assigned'
  FROM applications WHERE recruiter_id IS NULL
),
of_events AS (
  SELECT 'ORPHAN_STAGE_EVENT' AS exception_type, 'HIGH' AS severity, application_id, event_id,
         'stage event points at an application that does not exist' AS details
  FROM stage_events_raw ANTI JOIN applications USING (application_id)
),
exceptions AS (
  FROM of_events
  UNION ALL BY NAME
  SELECT *, CAST(NULL AS VARCHAR) AS event_id FROM (FROM of_life UNION ALL BY NAME FROM of_offers UNION ALL BY NAME FROM of_applications)
)"""


def _q(body: str) -> str:
    return f"WITH {BINDING},{REPORTING}\n{body}"


def _r(expr: str, name: str) -> str:
    return f"round(round({expr}, 9), 6) AS {name}"


LIFE_COLS = (
    "application_id, candidate_id, req_id, recruiter_id, source, org, job_family, "
    "applied_ts, screen_ts, onsite_ts, offer_ts, hired_ts, rejected_ts, withdrawn_ts, "
    "latest_stage, {latest_ts}terminal_stage, "
    + ", ".join(
        _r(c, c)
        for c in (
            "days_applied_to_screen",
            "days_screen_to_onsite",
            "days_onsite_to_offer",
            "days_offer_to_decision",
            "total_time_to_hire",
        )
    )
)

FUNNEL_COUNTS = (
    "count(*) AS applied, count(screen_ts) AS screened, count(onsite_ts) AS onsite, "
    "count(offer_ts) AS offered, count(hired_ts) AS hired"
)


def _funnel_rates(src: str = "") -> str:
    def ratio(n: str, d: str, name: str) -> str:
        return _r(f"CAST({n} AS DOUBLE) / NULLIF({d}, 0)", name)

    return ", ".join(
        [
            ratio("screened", "applied", "applied_to_screen_rate"),
            ratio("onsite", "screened", "screen_to_onsite_rate"),
            ratio("offered", "onsite", "onsite_to_offer_rate"),
            ratio("hired", "offered", "offer_to_hire_rate"),
        ]
    )


def _funnel(keys: str) -> str:
    return _q(
        f"""SELECT {keys}, applied, screened, onsite, offered, hired, {_funnel_rates()}
FROM (SELECT {keys}, {FUNNEL_COUNTS} FROM (SELECT *, CAST(date_trunc('week', applied_ts) AS TIMESTAMP) AS apply_week FROM life) l
      GROUP BY {keys}) g"""
    )


COMPLIANCE_AGGS = (
    "count(*) AS total_cases, "
    "CAST(sum(CAST(is_breach AS INTEGER)) AS BIGINT) AS breaches, "
    + _r("1.0 - CAST(sum(CAST(is_breach AS INTEGER)) AS DOUBLE) / NULLIF(count(*), 0)", "compliance_rate")
    + ", "
    + _r("avg(duration_days)", "avg_duration_days")
    + ", "
    + _r("quantile_cont(duration_days, 0.9)", "p90_duration_days")
)

BREACH_COLS = (
    "application_id, recruiter_id, org, transition_name, start_ts, end_ts, "
    + _r("duration_days", "duration_days")
    + ", sla_days"
)


# ------------------------------------------------------------------ audits


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _audit_row(table: str, kind: str, col: str, cond: str, pk: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS constraint_type, '{col}' AS column_names, "
        f"CAST({pk} AS VARCHAR) AS key_value, CAST(1 AS BIGINT) AS violation_count FROM {table} WHERE {cond}"
    )


def _dup_sql(table: str, kind: str, cols: tuple[str, ...], with_nulls: bool) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    key = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"
    col_list = ", ".join(cols)
    sql = (
        f"SELECT '{table}' AS table_name, '{kind}' AS constraint_type, '{','.join(cols)}' AS column_names, "
        f"{key} AS key_value, count(*) AS violation_count FROM {table} WHERE {present} "
        f"GROUP BY {col_list} HAVING count(*) > 1"
    )
    if with_nulls:
        sql += (
            f"\nUNION ALL\nSELECT '{table}', 'NOT_NULL', '{','.join(cols)}', CAST(NULL AS VARCHAR), count(*) "
            f"FROM {table} WHERE NOT ({present}) HAVING count(*) > 0"
        )
    return sql


def _audits() -> dict[str, str]:
    pk = [_dup_sql(n, "PRIMARY_KEY", (s.primary_key,), True) for n, s in SPECS.items()]
    uq = [_dup_sql(n, "UNIQUE", cols, False) for n, s in SPECS.items() for cols in s.unique]
    nn = [
        _audit_row(n, "NOT_NULL", c, f"{c} IS NULL", s.primary_key) for n, s in SPECS.items() for c in s.not_null
    ]
    rg = [
        _audit_row(n, "RANGE", c, f"NOT ({c} BETWEEN {lo} AND {hi})", s.primary_key)
        for n, s in SPECS.items()
        for c, lo, hi in s.ranges
    ]
    dm = [
        _audit_row(
            n, "DOMAIN", c, f"{c} NOT IN (" + ", ".join(f"'{v}'" for v in values) + ")", s.primary_key
        )
        for n, s in SPECS.items()
        for c, values in s.domains
    ]
    ln = [
        _audit_row(n, "LENGTH", c, f"length({c}) > {m}", s.primary_key)
        for n, s in SPECS.items()
        for c, m in s.max_length
    ]
    fk = [
        f"SELECT '{n}' AS table_name, 'FOREIGN_KEY' AS constraint_type, '{c}' AS column_names, "
        f"CAST(t.{s.primary_key} AS VARCHAR) AS key_value, CAST(1 AS BIGINT) AS violation_count "
        f"FROM {n} t WHERE t.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pkey} = t.{c})"
        for n, s in SPECS.items()
        for c, parent, pkey in s.foreign_keys
    ]
    do = [
        _audit_row(
            "requisitions", "DATE_ORDER", "open_date,close_date", "close_date < open_date", "req_id"
        )
    ]
    return {
        "audit_primary_key": _q(_union(pk)),
        "audit_not_null": _q(_union(nn)),
        "audit_range": _q(_union(rg)),
        "audit_domain": _q(_union(dm)),
        "audit_date_order": _q(_union(do)),
        "audit_unique": _q(_union(uq)),
        "audit_foreign_key": _q(_union(fk)),
        "audit_length": _q(_union(ln)),
    }


def _exc(where: str = "TRUE") -> str:
    return _q(f"SELECT exception_type, severity, application_id, event_id, details FROM exceptions WHERE {where}")


DETECTED = "TIMESTAMP '2024-01-01 00:00:00' AS detected_ts"


def oracle_queries() -> dict[str, str]:
    life_all = LIFE_COLS.format(latest_ts="latest_stage_ts, ")
    life_mart = LIFE_COLS.format(latest_ts="")
    compliance = _q(
        f"SELECT recruiter_id, org, transition_name, {COMPLIANCE_AGGS} FROM sla_breaches GROUP BY recruiter_id, org, transition_name"
    )
    breaches = _q(f"SELECT {BREACH_COLS}, is_breach FROM sla_breaches")
    exceptions = _q(f"SELECT exception_type, severity, application_id, event_id, details, {DETECTED} FROM exceptions")
    out = {
        "promote_events": _q("SELECT event_id, application_id, stage, stage_ts, actor_type FROM stage_events"),
        "latest_stage": _q("SELECT application_id, latest_stage, latest_stage_ts FROM per_app"),
        "lifecycle": _q(f"SELECT {life_all} FROM life"),
        "terminal_stage": _q("SELECT application_id, terminal_stage FROM life"),
        "stage_durations": _q(
            "SELECT application_id, "
            + ", ".join(
                _r(c, c)
                for c in (
                    "days_applied_to_screen",
                    "days_screen_to_onsite",
                    "days_onsite_to_offer",
                    "days_offer_to_decision",
                    "total_time_to_hire",
                )
            )
            + " FROM life"
        ),
        "funnel_metrics": _funnel("org, job_family, source, apply_week"),
        "funnel_by_source": _funnel("source"),
        "funnel_by_org": _funnel("org"),
        "funnel_grains": _q(
            f"""SELECT CASE WHEN no_week = 0 AND no_org = 0 THEN 'FULL' WHEN no_week = 0 THEN 'WEEK' WHEN no_org = 0 THEN 'ORG'
            WHEN no_source = 0 THEN 'SOURCE' ELSE 'OVERALL' END AS grain,
       org, job_family, source, apply_week, applied, screened, onsite, offered, hired, {_funnel_rates()}
FROM (SELECT org, job_family, source, apply_week, {FUNNEL_COUNTS},
             grouping(org) AS no_org, grouping(source) AS no_source, grouping(apply_week) AS no_week
      FROM (SELECT *, CAST(date_trunc('week', applied_ts) AS TIMESTAMP) AS apply_week FROM life) l
      GROUP BY GROUPING SETS ((), (source), (org), (apply_week), (org, job_family, source, apply_week))) g"""
        ),
        "csv_candidates": _q("SELECT * FROM candidates"),
        "csv_requisitions": _q("SELECT * FROM requisitions"),
        # ids are read in lower case
        "csv_offers": _q("SELECT * REPLACE (lower(offer_id) AS offer_id) FROM offers"),
        "kpi_summary": _q(
            f"""SELECT applied, screened, onsite, offered, hired, hires_with_time_to_hire,
       {_r('avg_time_to_hire_days', 'avg_time_to_hire_days')}, {_funnel_rates()},
       {_r('CAST(hired AS DOUBLE) / NULLIF(offered, 0)', 'offer_acceptance_rate')}
FROM (SELECT {FUNNEL_COUNTS}, count(total_time_to_hire) AS hires_with_time_to_hire,
             avg(total_time_to_hire) AS avg_time_to_hire_days FROM life) k"""
        ),
        "exc_orphan_event": _exc("exception_type = 'ORPHAN_STAGE_EVENT'"),
        "exc_duplicate_application": _exc("exception_type = 'DUPLICATE_APPLICATION'"),
        "exc_duplicate_application_symmetric": _q(
            """SELECT 'DUPLICATE_APPLICATION' AS exception_type, 'MED' AS severity, application_id, CAST(NULL AS VARCHAR) AS event_id,
       format('candidate {} applied to requisition {} more than once within 30 days', candidate_id, req_id) AS details
FROM (SELECT *, lag(apply_ts) OVER (PARTITION BY candidate_id, req_id ORDER BY apply_ts, application_id) AS earlier FROM applications)
WHERE apply_ts - earlier <= INTERVAL 30 DAY"""
        ),
        "exc_missing_recruiter": _exc("exception_type = 'MISSING_RECRUITER'"),
        "exc_order_screen_onsite": _exc("details = 'screen happened after onsite'"),
        "exc_order_onsite_offer": _exc("details = 'onsite happened after offer'"),
        "exc_negative_duration": _exc("exception_type = 'NEGATIVE_DURATION'"),
        "exc_multiple_terminal": _exc("exception_type = 'MULTIPLE_TERMINAL_EVENTS'"),
        "exc_offer_before_onsite": _exc("exception_type = 'OFFER_BEFORE_ONSITE'"),
        "exc_offer_without_onsite": _exc("exception_type = 'OFFER_WITHOUT_ONSITE'"),
        "data_exceptions": exceptions,
        "exception_rate": _q(
            """SELECT total_applications, excepted_applications,
       round(round(excepted_applications / total_applications, 9), 6) AS exception_rate
FROM (SELECT count(DISTINCT application_id) AS total_applications,
             count(DISTINCT application_id) FILTER (application_id IN (SELECT application_id FROM exceptions)) AS excepted_applications
      FROM applications)"""
        ),
        "sla_transitions": _q(
            "SELECT application_id, recruiter_id, org, transition_name, start_ts, end_ts, "
            + _r("duration_days", "duration_days")
            + ", sla_days FROM sla_transitions"
        ),
        "sla_breaches": breaches,
        "sla_compliance": compliance,
        "sla_compliance_rollup": _q(
            f"""SELECT CASE grouping(org, recruiter_id) WHEN 3 THEN 'TRANSITION' WHEN 1 THEN 'ORG' ELSE 'RECRUITER' END
         AS grouping_level,
       transition_name, org, recruiter_id, {COMPLIANCE_AGGS}
FROM sla_breaches
GROUP BY GROUPING SETS ((transition_name), (transition_name, org), (transition_name, org, recruiter_id))"""
        ),
        "mart_lifecycle": _q(f"SELECT {life_mart} FROM life"),
        "mart_exceptions": exceptions,
        "mart_sla_breaches": breaches,
        "mart_sla_compliance": compliance,
    }
    out.update(_audits())
    return out
