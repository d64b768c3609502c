"""Unit results fed back to plants: flags, lanes, texts, roll-up; then plant verdicts to units."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.dates import day_offset, month_end, stamp
from milepost.functions.rules import any_of, differs, first_match, holds
from milepost.operators.joins import restrict_to
from milepost.plans import texts as t
from milepost.plans.model import PHASE_ORDER

STALE_DAYS = 120
LANES = ["lane_1", "lane_2a", "lane_2b", "lane_3"]


def phase_order(phase: Column) -> Column:
    return first_match([(phase == name, rank) for name, rank in PHASE_ORDER.items()])


def plant_rollup(units: DataFrame, as_of: dt.date) -> DataFrame:
    """Everything plants need from their units, in one aggregation.

    The official date is that of the most advanced unit (lowest number among equals),
    not the latest date; the criterion is the worst one.
    """
    rank = phase_order(F.col("phase"))
    order = F.struct((-rank).alias("r"), "unit_no", "official_date", "official_source")
    advanced = F.when(rank.isNotNull(), order)
    lead = F.min_by(F.struct("phase", "official_date", "official_source"), advanced)
    worst = F.max_by(
        F.struct("criterion_pmo", "criterion", "phase", "over_30_days"),
        F.struct(F.col("criterion_pmo"), rank, F.col("over_30_days"), F.col("unit_no")),
    )
    flags = {
        "date_past": F.col("planned_commercial") < month_end(as_of),
        "in_test": F.col("criterion_pmo").isin(0.2, 0.3),
        "any_over_30_days": F.col("over_30_days") == 1,
        "any_unit_missing": F.col("units_missing"),
        "any_manual_date": F.col("manual_date"),
    }
    rolled = units.groupBy("plant_id").agg(
        *[F.bool_or(holds(c)).alias(name) for name, c in flags.items()],
        F.max("planned_commercial").alias("planned_commercial_max"),
        F.max("expected_commercial").alias("expected_commercial_max"),
        F.max("forecast").alias("forecast_max"),
        F.max("obligation_date").alias("obligation_date_max"),
        lead.alias("_lead"),
        worst.alias("_worst"),
    )
    return rolled.select(
        *[c for c in rolled.columns if not c.startswith("_")],
        F.col("_lead.phase").alias("phase_max"),
        F.col("_lead.official_date").alias("official_date_lead"),
        F.col("_lead.official_source").alias("official_source"),
        F.col("_worst.criterion_pmo").alias("criterion_pmo_max"),
        F.col("_worst.phase").alias("_worst_phase"),
        F.col("_worst.over_30_days").alias("_worst_over_30"),
    )


def lanes(plants: DataFrame, as_of: dt.date) -> DataFrame:
    """Automatic lanes I and II-a, ratification lane II-b and review lane III."""
    stale = holds(stamp(F.col("monitored_at")) < stamp(day_offset(as_of, -STALE_DAYS)))
    manual = any_of(
        F.col("paralysed"),
        F.col("unforeseeable"),
        F.col("selected"),
        F.col("in_test"),
        F.col("any_manual_date"),
        F.col("justification") == t.GRID_JUSTIFICATION,
    )
    auto, ratify, review = ~F.col("manual"), F.col("to_ratify"), F.col("review_start")
    pending = F.col("stale") | ratify | review | F.col("date_past")
    return (
        plants.withColumns({"stale": stale, "manual": manual})
        .withColumns(
            {
                "lane_1": auto & ~review & ~ratify,
                "lane_2a": auto & review & ~ratify,
                "lane_2b": auto & ratify,
                "lane_3": (F.col("manual") & pending) | F.col("in_test"),
            }
        )
        .withColumn("in_review", any_of(*[F.col(lane) for lane in LANES]))
    )


def justify(plants: DataFrame) -> DataFrame:
    """Justification by the worst detailed criterion and description by the criterion."""
    detail, kind = F.col("criterion_pmo_max"), F.col("criterion")
    testing, long_test = F.col("_worst_phase") == "OT", F.col("_worst_over_30") == 1
    reasons = [(detail == value, text) for value, text in t.JUSTIFICATIONS.items()]
    described = [
        ((kind == 0) & differs(F.col("_worst_phase"), "OT"), t.DESCRIPTION_WORKS),
        ((kind == 0) & testing & long_test, t.DESCRIPTION_TEST_LONG),
        ((kind == 0) & testing, t.DESCRIPTION_TEST),
        *[(kind == value, text) for value, text in t.DESCRIPTIONS.items()],
    ]
    return plants.withColumns(
        {
            "justification_new": first_match(reasons, t.NO_TEXT),
            "criterion_text": first_match(described, t.NO_TEXT),
        }
    ).drop("_worst_phase", "_worst_over_30")


def plant_verdicts(plants: DataFrame, units: DataFrame, as_of: dt.date) -> DataFrame:
    """Plants that have open units, with flags, lanes, texts and roll-up."""
    return justify(lanes(plants.join(plant_rollup(units, as_of), "plant_id"), as_of))


def push_down(plants: DataFrame, units: DataFrame) -> DataFrame:
    """Verdict of the plant on each of its units."""
    verdict = plants.select(
        "plant_id",
        "justification_new",
        "criterion_text",
        "monitored_at",
        "justification",
        *LANES,
        "in_review",
    )
    return units.join(verdict, "plant_id")


def stage_two(ids: DataFrame, df: DataFrame) -> DataFrame:
    """Recomputed rows of the listed plants, all sent to lane I."""
    rows = restrict_to(ids, df, "plant_id")
    return rows.withColumns({lane: F.lit(lane == "lane_1") for lane in LANES})


def redo_list(plants: DataFrame) -> DataFrame:
    """Plants to compute again once the work of lanes II-a and II-b is done."""
    return plants.filter(F.col("lane_2a") | F.col("lane_2b")).select("plant_id")
