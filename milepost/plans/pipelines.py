"""The end-to-end runs a user calls: train, forecast, review batch, second stage."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from milepost.plans.forecast import forecast
from milepost.plans.history import HISTORY_ORDER, merged_history
from milepost.plans.rules_plant import assemble_plants, plant_states
from milepost.plans.rules_unit import (
    FORECAST_COLUMNS,
    assemble_units,
    latest_unit_reports,
    plant_unit_facts,
    unit_rules,
)
from milepost.plans.rules_verdict import plant_verdicts, push_down, stage_two
from milepost.plans.training import CUT_OFF, Training, clean_history
from milepost.session import staged, temporary_stages


def train(
    units: DataFrame, order: list[str] = ("unit_no",), cut_off: dt.date = CUT_OFF, written: bool = False
) -> Training:
    """Clean the finished units once, into a stage table, and train on it, as far as is asked for.

    The tables of the cleaning go once the history is written.
    """

    def history() -> DataFrame:
        with temporary_stages(units.sparkSession) as kept:
            return kept(staged(clean_history(units, order, written=written)))

    return Training(history, cut_off)


def train_merged(
    legacy: DataFrame,
    types: DataFrame,
    units: DataFrame,
    plants: DataFrame,
    auctions: DataFrame,
    cut_off: dt.date = CUT_OFF,
) -> tuple[DataFrame, Training]:
    """Merge legacy and registry records, then train: the merged history and the training run."""
    merged = staged(merged_history(legacy, types, units, plants, auctions))
    return merged, train(merged, HISTORY_ORDER, cut_off, written=True)


@dataclass
class Snapshot:
    """The tables of one snapshot of the registry and the self-reports."""

    plants: DataFrame
    units: DataFrame
    auctions: DataFrame
    schedule: DataFrame
    contracts: DataFrame
    licences: DataFrame
    access: DataFrame
    unit_reports: DataFrame
    selected: DataFrame
    ties: tuple[str, ...] = ()


def review_plants(snap: Snapshot, as_of: dt.date) -> DataFrame:
    """Plant rows with every rule that needs no unit results."""
    rows = assemble_plants(
        snap.plants,
        snap.auctions,
        snap.schedule,
        snap.contracts,
        snap.licences,
        snap.access,
        list(snap.ties),
    )
    return plant_states(rows, snap.selected, as_of)


def review_units(
    snap: Snapshot, plants: DataFrame, forecasts: DataFrame, as_of: dt.date
) -> DataFrame:
    """Unit rows with detailed criterion, official date and source."""
    latest = staged(latest_unit_reports(snap.unit_reports))
    facts = plant_unit_facts(plants, snap.units, latest)
    return unit_rules(assemble_units(facts, snap.units, latest, forecasts), as_of)


def review_batch(
    snap: Snapshot, forecasts: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Plants with verdicts and units with their plant's verdict.

    Plants and units are written once as stage tables because several later passes read
    them: the roll-up, the verdicts and the push-down.
    """
    verdicts, units = _verdicts(snap, forecasts, as_of)
    return verdicts, push_down(verdicts, units)


def review_verdicts(snap: Snapshot, forecasts: DataFrame, as_of: dt.date) -> DataFrame:
    """The plants of ``review_batch`` alone.

    Only the roll-up reads the units, so they are not written, and the plants they met are where
    their roll-up is needed.
    """
    plants = staged(review_plants(snap, as_of))
    return plant_verdicts(plants, review_units(snap, plants, forecasts, as_of), as_of)


def review_tables(snap: Snapshot, forecasts: DataFrame, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """The results of ``review_batch`` as stage tables, for runs that use both several times.

    Verdicts are written before they meet the units, so they are computed once. The tables that
    led to both are removed.
    """
    with temporary_stages(snap.plants.sparkSession) as kept:
        verdicts, units = _verdicts(snap, forecasts, as_of)
        verdicts = kept(staged(verdicts))
        return verdicts, kept(staged(push_down(verdicts, units)))


def redone_tables(
    ids: DataFrame, snap: Snapshot, forecasts: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame]:
    """The listed rows of ``review_tables``, all sent to lane I, as stage tables.

    Every rule is of one plant, so plants that are not listed leave as soon as their own rules
    are settled, before they meet units and verdicts.
    """
    with temporary_stages(snap.plants.sparkSession) as kept:
        verdicts, units = _verdicts(snap, forecasts, as_of, ids)
        verdicts = staged(verdicts)
        pushed = push_down(verdicts, units)
        return kept(staged(stage_two(ids, verdicts))), kept(staged(stage_two(ids, pushed)))


def _verdicts(
    snap: Snapshot, forecasts: DataFrame, as_of: dt.date, ids: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    plants = review_plants(snap, as_of)
    plants = staged(plants if ids is None else plants.join(ids, "plant_id", "left_semi"))
    units = staged(review_units(snap, plants, forecasts, as_of))
    return plant_verdicts(plants, units, as_of), units


def scored_columns(scored: DataFrame) -> DataFrame:
    """What a review reads of a forecast; a stage table for it holds no more."""
    return scored.select("plant_id", "unit_no", *FORECAST_COLUMNS)


def forecast_and_review(
    snap: Snapshot, coefficients: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Forecast the open units, then review with it. Also returns the set-aside units."""
    scored, quarantine = forecast(snap.units, snap.plants, snap.auctions, coefficients, as_of)
    plants, units = review_batch(snap, staged(scored_columns(scored)), as_of)
    return plants, units, quarantine


def second_stage(
    ids: DataFrame, snap: Snapshot, coefficients: DataFrame, as_of: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Recompute everything and send the listed plants to lane I."""
    plants, units, _ = forecast_and_review(snap, coefficients, as_of)
    return stage_two(ids, plants), stage_two(ids, units)
