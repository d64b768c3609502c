"""Review progress and checks, scenario profiles, comparison of systems."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from milepost.plans import diagnostics as dg
from milepost.plans import review as rw
from milepost.plans.rules_plant import latest_report
from registry.base import query, steps

AS_OF = dt.date(2000, 6, 15)
STARTED = dt.datetime(1998, 7, 1, 8, 30)

steps(
    status="""SELECT p.*, r.reviewer, coalesce(p.monitored_at > TIMESTAMP '1998-07-01 08:30:00', false) AS done
 FROM plant_fx p JOIN review_fx r ON r.plant_id = p.plant_id""",
    schedule_last="""SELECT plant_id, reported_planned_start FROM (SELECT *, row_number() OVER
 (PARTITION BY plant_id ORDER BY sent_at DESC, seq DESC, ep DESC) AS rn FROM schedule_fx) WHERE rn = 1""",
    start_checks="""SELECT s.plant_id, s.reviewer, s.done,
 (coalesce(planned_start < granted_start, false) AND coalesce(planned_start < reported_planned_start, false))
 OR coalesce(planned_start < DATE '2000-06-15', false)
 OR (coalesce(planned_start < TIMESTAMP '1998-08-30 08:30:00', false) AND coalesce(reported_planned_start > TIMESTAMP '1998-08-30 08:30:00', false)) AS check_start
 FROM status s LEFT JOIN schedule_last l ON l.plant_id = s.plant_id""",
    just_checks="""SELECT r.plant_id, r.justification_new, s.justification, s.reviewer FROM review_fx r JOIN status s ON s.plant_id = r.plant_id
 WHERE s.done AND NOT coalesce(starts_with(r.justification_new, 'Analisar'), false) AND coalesce(r.justification_new <> s.justification, true)""",
    date_checks="""SELECT f.plant_id, p.monitored_at, f.unit_no, f.planned_commercial, f.rule_date, f.reviewer FROM
 (SELECT u.plant_id, u.unit_no, u.planned_commercial, r.rule_date, r.reviewer, row_number() OVER (PARTITION BY u.plant_id ORDER BY u.unit_no) AS rn
  FROM reg_unit_fx u JOIN review_fx r ON r.plant_id = u.plant_id WHERE u.commercial_date IS NULL AND r.manual IS NOT NULL
  AND r.rule_date IS NOT NULL AND abs(u.planned_commercial - r.rule_date) > 120) f
 JOIN plant_fx p ON p.plant_id = f.plant_id WHERE f.rn = 1 AND p.monitored_at > TIMESTAMP '1998-07-01 08:30:00'""",
    progress="""SELECT reviewer, count(*) AS total, CAST(count(*) FILTER (done) AS BIGINT) AS done,
 CAST(count(*) FILTER (NOT done) AS BIGINT) AS todo, round(100.0 * count(*) FILTER (done) / count(*), 1) AS percent FROM status GROUP BY reviewer""",
)


def status_of(t):
    return rw.review_status(t.plant_fx, t.review_fx, STARTED)


def starts_of(t):
    reports = latest_report(t.schedule_fx, ["seq", "ep"]).select("plant_id", "reported_planned_start")
    return rw.check_start(status_of(t).join(reports, "plant_id", "left"), STARTED, AS_OF)


def justifications_of(t):
    return rw.check_justification(t.review_fx, status_of(t))


def dates_of(t):
    return rw.check_dates(t.reg_unit_fx, t.review_fx, t.plant_fx, STARTED)


@query("reviewer_progress", "SELECT * FROM progress")
def _(t):
    return rw.review_progress(status_of(t))


@query("review_todo", "SELECT plant_id, plant_name, reviewer, monitored_at FROM status WHERE NOT done")
def _(t):
    return rw.review_todo(status_of(t))


@query("check_start", "SELECT * FROM start_checks")
def _(t):
    return starts_of(t).select("plant_id", "reviewer", "done", "check_start")


@query("check_justification", "SELECT * FROM just_checks")
def _(t):
    return justifications_of(t)


@query("check_dates", "SELECT * FROM date_checks")
def _(t):
    return dates_of(t)


@query(
    "full_progress",
    """SELECT p.*, coalesce(a.n, 0) AS starts_to_check, coalesce(b.n, 0) AS justifications_to_check, coalesce(c.n, 0) AS dates_to_check
       FROM progress p LEFT JOIN (SELECT reviewer, count(*) AS n FROM start_checks WHERE check_start AND done GROUP BY reviewer) a ON a.reviewer = p.reviewer
       LEFT JOIN (SELECT reviewer, count(*) AS n FROM just_checks GROUP BY reviewer) b ON b.reviewer = p.reviewer
       LEFT JOIN (SELECT reviewer, count(*) AS n FROM date_checks GROUP BY reviewer) c ON c.reviewer = p.reviewer""",
)
def _(t):
    return rw.full_progress(status_of(t), starts_of(t), justifications_of(t), dates_of(t))


# --- diagnostics --------------------------------------------------------------

_CASES = ["gen_type", "works_status", "start_date", "planned_start", "plant_monitored"]


@query(
    "scenario_profile",
    """SELECT gen_type, works_status, start_date, planned_start, plant_monitored, gen_type_case, works_status_case,
        start_date_case, planned_start_case, plant_monitored_case, n FROM
        (SELECT *, gen_type IS NOT NULL AS gen_type_case, works_status AS works_status_case, start_date IS NOT NULL AS start_date_case,
         planned_start IS NOT NULL AS planned_start_case, plant_monitored AS plant_monitored_case,
         count(*) OVER w AS n, row_number() OVER (w ORDER BY plant_id) AS rn FROM plant_fx
         WINDOW w AS (PARTITION BY gen_type IS NOT NULL, works_status, start_date IS NOT NULL, planned_start IS NOT NULL, plant_monitored))
       WHERE rn = 1""",
)
def _(t):
    return dg.show_cases(t.plant_fx, _CASES, 5, ["plant_id"])


@query(
    "whole_profile",
    """SELECT s_suppkey, s_nationkey, region, rich, s_suppkey_case, s_nationkey_case, region_case, rich_case, n FROM
        (SELECT s_suppkey, s_nationkey, n_regionkey AS region, CASE WHEN s_acctbal > 0 THEN s_acctbal > 5000 END AS rich,
         true AS s_suppkey_case, true AS s_nationkey_case, n_regionkey AS region_case,
         CASE WHEN s_acctbal > 0 THEN s_acctbal > 5000 END AS rich_case,
         count(*) OVER w AS n, row_number() OVER (w ORDER BY s_suppkey) AS rn
         FROM supplier JOIN nation ON s_nationkey = n_nationkey
         WINDOW w AS (PARTITION BY n_regionkey, CASE WHEN s_acctbal > 0 THEN s_acctbal > 5000 END)) WHERE rn = 1""",
)
def _(t):
    """All columns, each example with its whole row."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey",
        "s_nationkey",
        F.col("n_regionkey").alias("region"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal") > 5000).alias("rich"),
    )
    return dg.show_cases(rows, whole=True)


@query(
    "constant_columns",
    """SELECT 'closed' AS "column", CAST(0 AS BIGINT) AS known UNION ALL
       SELECT 'country' AS "column", count(*) AS known FROM plant_fx
       UNION ALL SELECT 'always_open', count(*) FROM plant_fx WHERE no_forecast = 'Sim'""",
)
def _(t):
    rows = t.plant_fx.select(
        "plant_id",
        "gen_type",
        "planned_start",
        F.lit(None).cast("date").alias("closed"),
        F.lit("BR").alias("country"),
        F.when(F.col("no_forecast") == "Sim", "x").alias("always_open"),
    )
    return dg.constant_columns(rows)


def _other(t):
    """The registry as another system tells it: escaped texts, shifted dates, gaps."""
    coded = F.replace(F.col("works_status"), F.lit(" "), F.lit("_x0020_"))
    return t.plant_fx.select(
        F.when(F.col("plant_monitored").isNotNull(), F.col("plant_id")).otherwise(-F.col("plant_id")).alias("plant_id"),
        F.when(F.col("market") == "ACR", 1.0).otherwise(2.0).alias("criterion_pmo"),
        coded.alias("criterion_text"),
        F.when(F.col("start_date").isNull(), "OUT").otherwise("IO").alias("phase"),
        (F.col("granted_start").cast("timestamp_ntz") + F.expr("INTERVAL '5' HOUR")).alias("forecast"),
    )


def _ours(t):
    return t.plant_fx.select(
        "plant_id",
        F.when(F.col("gen_type") == "UHE", 2.0).otherwise(1.0).alias("criterion_pmo"),
        F.col("works_status").alias("criterion_text"),
        F.when(F.col("concrete_date").isNull(), "OUT").otherwise("IO").alias("phase"),
        F.col("planned_start").cast("timestamp_ntz").alias("forecast"),
    )


@query(
    "forecast_differences",
    """SELECT p.plant_id, CASE WHEN concrete_date IS NULL THEN 'OUT' ELSE 'IO' END AS phase_ours,
        CASE WHEN p.plant_monitored IS NOT NULL THEN CASE WHEN start_date IS NULL THEN 'OUT' ELSE 'IO' END END AS phase_theirs,
        CASE WHEN p.plant_monitored IS NOT NULL THEN CAST(planned_start - granted_start AS DOUBLE) END AS diff_days FROM plant_fx p
       UNION ALL SELECT -plant_id, NULL, CASE WHEN start_date IS NULL THEN 'OUT' ELSE 'IO' END, NULL
       FROM plant_fx WHERE plant_monitored IS NULL""",
)
def _(t):
    rows = dg.forecast_differences(_ours(t), _other(t), ["plant_id"])
    return rows.select("plant_id", "phase_ours", "phase_theirs", "diff_days")


@query(
    "compare_systems",
    """SELECT * FROM (SELECT plant_id, CASE WHEN gen_type = 'UHE' THEN 2.0 ELSE 1.0 END AS criterion_pmo_ours,
        CASE WHEN plant_monitored IS NOT NULL THEN CASE WHEN market = 'ACR' THEN 1.0 ELSE 2.0 END END AS criterion_pmo_theirs,
        works_status AS criterion_text_ours, CASE WHEN plant_monitored IS NOT NULL THEN works_status END AS criterion_text_theirs,
        coalesce(criterion_pmo_ours <> criterion_pmo_theirs, true) AS criterion_pmo_differs,
        coalesce(criterion_text_ours <> criterion_text_theirs, true) AS criterion_text_differs FROM plant_fx)
       WHERE criterion_pmo_differs OR criterion_text_differs
       UNION ALL SELECT -plant_id, NULL, CASE WHEN market = 'ACR' THEN 1.0 ELSE 2.0 END, NULL, works_status, true, true
       FROM plant_fx WHERE plant_monitored IS NULL""",
)
def _(t):
    columns = ["criterion_pmo", "criterion_text"]
    theirs = dg.readable_texts(_other(t), ["criterion_text"])
    return dg.compare_systems(_ours(t), theirs, columns)
