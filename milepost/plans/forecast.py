"""Predicted commercial operation date and on-time probability of every open unit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.dates import (
    add_days,
    day,
    day_offset,
    days_between,
    month_end,
    stamp,
)
from milepost.functions.rules import differs, first_match, holds, last_match
from milepost.functions.stats import late_probability, standard_score
from milepost.plans.history import first_supply
from milepost.plans.model import (
    ALL_MARKETS,
    NO,
    NO_CONCRETE_TYPES,
    NOT_STARTED,
    PHASES,
    REGULATED,
    TYPE_ALIASES,
)
from milepost.session import SmallTable

# Fixed values, in days.
DEFAULT_START_DAYS = 120
NEXT_MILESTONE_DAYS = 40
TEST_LIMIT_DAYS = 30

# Columns of the registry that a forecast reads or hands on.
_UNIT_COLUMNS = ["plant_id", "unit_no", "unit_mw", "test_date", "commercial_date", "granted_commercial"]
_PLANT_COLUMNS = [
    "plant_id",
    "plant_name",
    "gen_type",
    "market",
    "plant_monitored",
    "no_forecast",
    "monitored_at",
    "planned_start",
    "granted_start",
    "start_date",
    "concrete_date",
    "assembly_date",
]

_SCORES = ["a", "b", "mean_days", "mean_delay", "std_delay"]


# --- inputs -------------------------------------------------------------------


def open_units(units: DataFrame) -> DataFrame:
    """Units not yet in commercial operation."""
    return units.filter(F.col("commercial_date").isNull())


def same_type(gen_type: Column) -> Column:
    """Types without a model of their own use the model of another type."""
    return last_match([(gen_type == t, F.lit(alias)) for t, alias in TYPE_ALIASES.items()], gen_type)


def plant_facts(plants: DataFrame, auctions: DataFrame) -> DataFrame:
    """Plants with their first supply date: both sides hold one row per plant."""
    supply = first_supply(auctions.filter(F.col("supply_date").isNotNull()))
    return plants.join(supply, "plant_id", "left")


def model_table(coefficients: DataFrame, choice: DataFrame | None = None) -> SmallTable:
    """The segment rows to score with: all markets, or the level kind chosen per segment.

    With a choice, ``market`` says for which plants a row holds; without one it is absent.
    """
    if choice is None:
        return SmallTable(
            coefficients.filter(F.col("level") == ALL_MARKETS).select("gen_type", "phase", *_SCORES)
        )
    markets = coefficients.filter(F.col("level") != ALL_MARKETS)
    every = coefficients.filter(F.col("level") == ALL_MARKETS)
    seg = ["gen_type", "phase"]
    own = markets.join(choice.filter("kind = 'own'"), seg, "left_semi")
    rest = markets.select(*seg, "level").join(choice.filter("kind = 'own'"), seg, "left_anti")
    shared = rest.join(every.select(*seg, *_SCORES), seg)
    cols = [*seg, F.col("level").alias("market"), *_SCORES]
    return SmallTable(own.select(*cols).unionByName(shared.select(*cols)))


def forecast_input(
    units: DataFrame, plants: DataFrame, auctions: DataFrame, model: SmallTable
) -> DataFrame:
    """Open units with plant attributes and the mean test phase of their type.

    Types unknown to the model drop out. The alias of a type is applied before that
    join, so aliased types are kept. One join of units and plants; all else is small.
    """
    facts = plant_facts(plants.select(*_PLANT_COLUMNS), auctions).withColumn(
        "gen_type", same_type(F.col("gen_type"))
    )
    rows = open_units(units).select(*_UNIT_COLUMNS).join(facts, "plant_id", "left")
    test_phase = model.df.filter("phase = 'OT'")
    if "market" in model.df.columns:
        test_phase = test_phase.groupBy("gen_type").agg(F.max("mean_days").alias("mean_days"))
    return model.derive(
        test_phase.select("gen_type", F.col("mean_days").alias("test_days"))
    ).join(rows, ["gen_type"], "inner")


def missing_auction(market: Column, supply: Column) -> Column:
    """A regulated plant must have a supply date."""
    return holds(market == REGULATED) & supply.isNull()


def split_missing_auction(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for a forecast, and the ones set aside for a missing supply date."""
    bad = missing_auction(F.col("market"), F.col("supply_date"))
    return rows.filter(~bad), rows.filter(bad)


def obligation(supply: Column, granted: Column) -> Column:
    """Later of supply and granted date, an unknown one skipped."""
    return F.greatest(supply, granted)


# --- phases and delays --------------------------------------------------------


def _next_phase(phase: Column, gen_type: Column) -> Column:
    after_start = F.when(gen_type.isin(NO_CONCRETE_TYPES), "ME").otherwise("CC")
    return first_match(
        [
            (phase == NOT_STARTED, "IO"),
            (phase == "IO", after_start),
            (phase == "CC", "ME"),
            (phase == "ME", "OT"),
        ]
    )


def current_phase(rows: DataFrame) -> DataFrame:
    """Last milestone reached, its date and the milestone that comes next."""
    reached = [(F.col(m).isNotNull(), p) for p, m in reversed(PHASES.items())]
    date = F.coalesce(*[F.col(m) for m in reversed(PHASES.values())])
    return (
        rows.withColumn("phase", first_match(reached, NOT_STARTED))
        .withColumn("phase_date", date)
        .withColumn("next_phase", _next_phase(F.col("phase"), F.col("gen_type")))
    )


def impute_start(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Units not started are scored as started on their planned, else a default date.

    The recorded start date is left as it is; the assumed one has its own column.
    """
    waiting = F.col("phase") == NOT_STARTED
    assumed = F.coalesce("planned_start", day_offset(as_of, DEFAULT_START_DAYS))
    return (
        rows.withColumn("start_imputed", F.when(waiting, assumed))
        .withColumn("phase_date", F.coalesce("start_imputed", "phase_date"))
        .withColumn("scored_phase", F.when(waiting, "IO").otherwise(F.col("phase")))
    )


def attach_scores(rows: DataFrame, model: SmallTable, phase: str, suffix: str) -> DataFrame:
    """Model values of the segment the row is in at ``phase``; unknown where there is none."""
    keys = [c for c in ("gen_type", "market") if c in model.df.columns]
    table = model.df.select(
        *keys, F.col("phase").alias(phase), *[F.col(c).alias(f"{c}_{suffix}") for c in _SCORES]
    )
    return model.derive(table).join(rows, [*keys, phase])


def score_delays(
    rows: DataFrame, model: SmallTable, as_of: dt.date, next_of_waiting: str = "start"
) -> DataFrame:
    """Expected dates of the current and the next milestone and the days behind each.

    For units not started the next milestone is the start of works. With
    ``next_of_waiting='after_start'`` its expected date comes from the phase after the
    start while the line stays that of the start.
    """
    scored = attach_scores(rows, model, "scored_phase", "cur")
    scored = attach_scores(scored, model, "next_phase", "nxt")
    mean_next = F.col("mean_days_nxt")
    if next_of_waiting == "after_start":
        later = F.when(
            F.col("phase") == NOT_STARTED, _next_phase(F.lit("IO"), F.col("gen_type"))
        )
        scored = scored.withColumn("later_phase", later)
        keys = [c for c in ("gen_type", "market") if c in model.df.columns]
        means = model.df.select(
            *keys, F.col("phase").alias("later_phase"), F.col("mean_days").alias("mean_days_later")
        )
        scored = model.derive(means).join(scored, [*keys, "later_phase"])
        mean_next = F.when(F.col("phase") == NOT_STARTED, F.col("mean_days_later")).otherwise(
            mean_next
        )
    due = F.col("obligation_date")
    return scored.withColumns(
        {
            "expected_cur": add_days(due, -F.col("mean_days_cur")),
            "expected_nxt": add_days(due, -mean_next),
            "delay_cur": days_between(F.col("phase_date"), due) + F.col("mean_days_cur"),
            "delay_nxt": days_between(day_offset(as_of, NEXT_MILESTONE_DAYS), due) + mean_next,
        }
    )


# --- forecast -----------------------------------------------------------------


def two_forecasts(rows: DataFrame) -> DataFrame:
    """Forecast and probability by current and by next milestone; the later date stands."""
    due = F.col("obligation_date")

    def line(side: str) -> Column:
        return add_days(due, F.col(f"delay_{side}") * F.col(f"a_{side}") + F.col(f"b_{side}"))

    def score(side: str) -> Column:
        return standard_score(*[F.col(f"{c}_{side}") for c in ("delay", "mean_delay", "std_delay")])

    # Three projections: inputs, formulas, choice. Fewer would repeat the formulas.
    scored = rows.withColumns(
        {f"forecast_{s}": line(s) for s in ("cur", "nxt")}
        | {f"_score_{s}": score(s) for s in ("cur", "nxt")}
    )
    chances = scored.select(
        *[c for c in scored.columns if not c.startswith("_score_")],
        *[late_probability(F.col(f"_score_{s}")).alias(f"probability_{s}") for s in ("cur", "nxt")],
    )
    by_next = holds(
        F.col("forecast_nxt") >= F.coalesce(F.col("forecast_cur"), F.col("forecast_nxt"))
    )
    return chances.withColumns(
        {
            "forecast": F.greatest("forecast_cur", "forecast_nxt"),
            "probability": F.when(by_next, F.col("probability_nxt")).otherwise(
                F.col("probability_cur")
            ),
        }
    )


def forecast_error(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Mark forecasts that cannot hold: this month or earlier, or sooner than a test phase.

    Judged on the later of the two forecasts, before any override.
    """
    too_early = holds(F.col("forecast") < month_end(as_of))
    earliest = add_days(day(as_of), F.col("test_days"))
    too_fast = differs(F.col("scored_phase"), "OT") & holds(F.col("forecast") < earliest)
    return rows.withColumn("forecast_error", too_early | too_fast)


def forecast_final(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Overrides: not started takes the current side, then a past date takes the next side."""
    waiting = F.col("phase") == NOT_STARTED
    settled = rows.withColumn(
        "forecast", F.when(waiting, F.col("forecast_cur")).otherwise(F.col("forecast"))
    ).withColumn(
        "probability", F.when(waiting, F.col("probability_cur")).otherwise(F.col("probability"))
    )
    past = holds(F.col("forecast") < stamp(day(as_of))) & F.col("forecast_nxt").isNotNull()
    return settled.select(
        *[c for c in settled.columns if c not in ("forecast", "probability")],
        F.when(past, F.col("forecast_nxt")).otherwise(F.col("forecast")).alias("forecast"),
        F.when(past, F.col("probability_nxt")).otherwise(F.col("probability")).alias("probability"),
    )


def test_over_limit(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """1 for units in test for more than thirty days."""
    late = days_between(day(as_of), F.col("test_date")) > TEST_LIMIT_DAYS
    return rows.withColumn("over_30_days", F.when(holds(late), 1).otherwise(0))


def forecast(
    units: DataFrame,
    plants: DataFrame,
    auctions: DataFrame,
    coefficients: DataFrame,
    as_of: dt.date,
    choice: DataFrame | None = None,
    next_of_waiting: str = "start",
) -> tuple[DataFrame, DataFrame]:
    """Scored open units, and the units set aside for a missing auction date.

    The set-aside rows are returned beside the result instead of stopping the batch.
    """
    model = model_table(coefficients, choice)
    rows, quarantine = split_missing_auction(forecast_input(units, plants, auctions, model))
    rows = rows.filter(differs(F.col("plant_monitored"), NO)).withColumn(
        "obligation_date", obligation(F.col("supply_date"), F.col("granted_commercial"))
    )
    rows = impute_start(current_phase(rows), as_of)
    rows = two_forecasts(score_delays(rows, model, as_of, next_of_waiting))
    rows = forecast_final(forecast_error(rows, as_of), as_of)
    return test_over_limit(rows, as_of), quarantine
