"""Checks on the progress and plausibility of a review batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.dates import day, days_between, stamp
from milepost.functions.rules import differs, holds
from milepost.operators.joins import natural_join
from milepost.operators.pick import pick_row
from milepost.plans import texts as t

NEAR_DAYS = 60
DEVIATION_DAYS = 120


def review_status(plants: DataFrame, worklist: DataFrame, started_at: dt.datetime) -> DataFrame:
    """Plants of the batch with their reviewer and whether they were saved since its start."""
    done = holds(stamp(F.col("monitored_at")) > F.lit(started_at).cast("timestamp_ntz"))
    return plants.join(worklist.select("plant_id", "reviewer"), "plant_id").withColumn("done", done)


def review_todo(status: DataFrame) -> DataFrame:
    return status.filter(~F.col("done")).select("plant_id", "plant_name", "reviewer", "monitored_at")


def review_progress(status: DataFrame) -> DataFrame:
    """Plants in total, done, to do and percent done per reviewer."""
    counts = status.groupBy("reviewer").agg(
        F.count("*").alias("total"), F.count_if("done").alias("done")
    )
    return counts.withColumns(
        {
            "todo": F.col("total") - F.col("done"),
            "percent": F.round(F.try_divide(F.col("done") * 100.0, F.col("total")), 1),
        }
    )


def check_start(rows: DataFrame, started_at: dt.datetime, as_of: dt.date) -> DataFrame:
    """Planned start earlier than granted and reported, past, or near while reported late."""
    near = F.lit(started_at + dt.timedelta(days=NEAR_DAYS)).cast("timestamp_ntz")
    planned, granted = stamp(F.col("planned_start")), stamp(F.col("granted_start"))
    reported = stamp(F.col("reported_planned_start"))
    doubtful = (
        (holds(planned < granted) & holds(planned < reported))
        | holds(planned < stamp(day(as_of)))
        | (holds(planned < near) & holds(reported > near))
    )
    return rows.withColumn("check_start", doubtful)


def check_justification(worklist: DataFrame, status: DataFrame) -> DataFrame:
    """Saved justification differs from the proposed one, unless that asks for an analysis."""
    fixed = ~holds(F.startswith(F.col("justification_new"), F.lit(t.ANALYSE_PREFIX)))
    proposed = worklist.filter(fixed).select("plant_id", "justification_new")
    saved = status.filter("done").select("plant_id", "justification", "reviewer")
    return natural_join(proposed, saved).filter(
        differs(F.col("justification_new"), F.col("justification"))
    )


def check_dates(
    units: DataFrame, worklist: DataFrame, plants: DataFrame, started_at: dt.datetime
) -> DataFrame:
    """Manual plants saved since the start whose date on some open unit deviates widely.

    One unit per plant is shown, the lowest number; a unit without one only if all are so.
    """
    manual = worklist.filter(F.col("manual").isNotNull() & F.col("rule_date").isNotNull()).select(
        "plant_id", "rule_date", "reviewer"
    )
    open_units = units.filter(F.col("commercial_date").isNull()).select(
        "plant_id", "unit_no", "planned_commercial"
    )
    gap = F.abs(days_between(F.col("planned_commercial"), F.col("rule_date")))
    # One unit per plant is settled before the plants are joined.
    far = pick_row(
        natural_join(open_units, manual)
        .filter(gap > DEVIATION_DAYS)
        .withColumn("_place", F.struct(F.col("unit_no").isNull().alias("unknown"), "unit_no")),
        ["plant_id"],
        "_place",
        largest=False,
    ).drop("_place")
    since = stamp(F.col("monitored_at")) > F.lit(started_at).cast("timestamp_ntz")
    return plants.select("plant_id", "monitored_at").join(far, "plant_id", "right").filter(since)


def full_progress(
    status: DataFrame, starts: DataFrame, justifications: DataFrame, dates: DataFrame
) -> DataFrame:
    """Progress per reviewer with the number of findings of each check."""

    def per_reviewer(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("reviewer").agg(F.count("*").alias(name))

    findings = {
        "starts_to_check": starts.filter("check_start AND done"),
        "justifications_to_check": justifications,
        "dates_to_check": dates,
    }
    rows = review_progress(status)
    for name, found in findings.items():
        rows = rows.join(per_reviewer(found, name), "reviewer", "left")
    return rows.fillna(0, list(findings))
