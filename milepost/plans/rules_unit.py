"""Unit-level review rules: owner's date, detailed criterion, official date and its source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.dates import day_offset, month_end, stamp
from milepost.functions.rules import differs, first_match, holds, last_match, monitored
from milepost.operators.aggregates import group_max
from milepost.operators.joins import missing_from
from milepost.operators.pick import latest_batch
from milepost.plans import texts as t

# Fixed values, in days.
TEST_EXTENSION = 60
HANDICAP = 5 * 365
# Its text speaks of five years; the date adds six.
HANDICAP_NO_REPORT = 6 * 365

# What units read of their plant; review queries on units stage no more of it.
PLANT_COLUMNS = ["criterion", "no_report", "granted_start", "planned_start", "reported_planned_start"]
FORECAST_COLUMNS = ["phase", "probability", "over_30_days", "forecast", "obligation_date"]


def latest_unit_reports(reports: DataFrame) -> DataFrame:
    """All unit rows of the newest report of every plant."""
    return latest_batch(reports, "plant_id", "sent_at")


def missing_units(units: DataFrame, latest: DataFrame) -> DataFrame:
    """Plants with a monitored registry unit that their newest report leaves out.

    Units already in operation count here.
    """
    listed = units.filter(monitored(F.col("unit_monitored"))).select("plant_id", "unit_no")
    absent = missing_from(listed, latest, ["plant_id", "unit_no"])
    return absent.select("plant_id").distinct()


def plant_unit_facts(plants: DataFrame, units: DataFrame, latest: DataFrame) -> DataFrame:
    """Plants with the two facts that units need about their siblings.

    Both come as one row per plant, so that the units themselves join only once.
    """
    gaps = missing_units(units, latest).withColumn("_gap", F.lit(True))
    newest = group_max(latest, "plant_id", {"expected_commercial": "plant_expected"})
    rows = plants.join(gaps, "plant_id", "left").join(newest, "plant_id", "left")
    gap = holds(F.col("_gap")) & ~F.col("no_report")
    return rows.withColumn("units_missing", gap).drop("_gap")


def assemble_units(
    plants: DataFrame, units: DataFrame, latest: DataFrame, forecasts: DataFrame
) -> DataFrame:
    """Open monitored units of the given plants with their report and forecast.

    Reports and forecasts match on plant and unit together, which spreads large plants.
    """
    open_units = units.filter(
        monitored(F.col("unit_monitored"))
        & F.col("commercial_date").isNull()
        & F.col("unit_no").isNotNull()
    ).select("plant_id", "unit_no", "unit_mw", "planned_commercial")
    key = ["plant_id", "unit_no"]
    scored = forecasts.select(*key, *FORECAST_COLUMNS).withColumn(
        "probability", F.col("probability") / 100
    )
    return (
        open_units.join(latest.select(*key, "expected_commercial"), key, "left")
        .join(scored, key, "left")
        .join(plants.select("plant_id", *PLANT_COLUMNS, "units_missing", "plant_expected"), "plant_id")
    )


def owner_forecast(units: DataFrame) -> DataFrame:
    """Owner's date of the unit, or the plant's latest one when units are left out."""
    own = F.col("expected_commercial")
    use_plant = F.col("units_missing") | own.isNull()
    return units.withColumn(
        "expected_commercial", F.when(use_plant, F.col("plant_expected")).otherwise(own)
    )


def criterion_pmo(units: DataFrame) -> DataFrame:
    """Criterion 0 split by phase and time in test; the others carry over."""
    running = F.col("criterion") == 0
    testing = F.col("phase") == "OT"
    long_test = F.col("over_30_days") == 1
    branches = [
        (running & differs(F.col("phase"), "OT"), 0.1),
        (running & testing & long_test, 0.2),
        (running & testing, 0.3),
        (F.col("criterion").between(1, 9), F.col("criterion").cast("double")),
    ]
    return units.withColumn("criterion_pmo", first_match(branches, 0.0))


def official_date(units: DataFrame, as_of: dt.date) -> DataFrame:
    """Latest of the dates that the criterion admits; past or unknown goes to a reviewer."""
    owner, model, due = (
        stamp(F.col(c)) for c in ("expected_commercial", "forecast", "obligation_date")
    )
    kind, detail = F.col("criterion"), F.col("criterion_pmo")
    branches = [
        (detail.isin(0.1, 0.3), F.greatest(owner, model)),
        (detail == 0.2, stamp(day_offset(as_of, TEST_EXTENSION))),
        (kind.isin(1, 2), F.greatest(owner, model, due)),
        (kind.isin(3, 4, 5), F.greatest(owner, model, due, stamp(day_offset(as_of, HANDICAP)))),
        (kind == 7, F.greatest(model, due, stamp(day_offset(as_of, HANDICAP_NO_REPORT)))),
        (kind == 8, F.greatest(owner, due)),
    ]
    dated = units.withColumn("official_date", first_match(branches))
    by_hand = ~holds(F.col("official_date") >= month_end(as_of))
    return dated.withColumn("manual_date", by_hand).withColumn(
        "official_date", F.when(~F.col("manual_date"), F.col("official_date"))
    )


def official_source(units: DataFrame, as_of: dt.date) -> DataFrame:
    """Which of the dates became the official one; the last label that fits stands."""
    chosen = F.col("official_date")
    branches = [
        (chosen == stamp(F.col("forecast")), t.SOURCE_FORECAST),
        (chosen == stamp(F.col("obligation_date")), t.SOURCE_OBLIGATION),
        (chosen == stamp(F.col("expected_commercial")), t.SOURCE_OWNER),
        (chosen == stamp(day_offset(as_of, TEST_EXTENSION)), t.SOURCE_60_DAYS),
        (F.col("manual_date"), t.SOURCE_REVIEWER),
    ]
    return units.withColumn("official_source", last_match(branches, t.SOURCE_HANDICAP))


def unit_rules(units: DataFrame, as_of: dt.date) -> DataFrame:
    rows = criterion_pmo(owner_forecast(units))
    return official_source(official_date(rows, as_of), as_of)
