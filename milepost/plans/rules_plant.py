"""Plant-level review rules: latest self-reports, state columns, criterion and flags."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.dates import month_end
from milepost.functions.rules import any_of, first_match, holds, last_match, monitored
from milepost.functions.text import class_code, listed
from milepost.operators.pick import pick_row
from milepost.plans import texts as t
from milepost.plans.forecast import first_supply
from milepost.plans.model import FREE, REGULATED, YES

# Label of a milestone, its registry date and its reported date.
MILESTONES_TO_RATIFY = [
    ("DatInicioObraRealizado", "start_date", "reported_start"),
    ("DatConcretagemRealizado", "concrete_date", "reported_concrete"),
    ("DatMontagemRealizado", "assembly_date", "reported_assembly"),
    ("DatEnchimentoRealizado", "filling_date", "reported_filling"),
    ("DatSisTransmissaoRealizado", "transmission_start_date", "reported_transmission_start"),
    ("DatCanteiroObraRealizado", "site_date", "reported_site"),
    ("DatComissionamentoUGRealizado", "commissioning_date", "reported_commissioning"),
    ("DatConclusaoSisTransRealizado", "transmission_end_date", "reported_transmission_end"),
    ("DatDesvioRioRealizado", "diversion_date", "reported_diversion"),
    ("DatConclusaoTorresRealizado", "towers_date", "reported_towers"),
]

# Plant classes whose milestones are reported under other schedule numbers.
SMALL_HYDRO, WIND_OR_SOLAR = "PH", "CV"


def latest_report(reports: DataFrame, ties: list[str] = ()) -> DataFrame:
    """Newest self-report of every plant, one row each."""
    return pick_row(reports, ["plant_id"], "sent_at", list(ties))


def assemble_plants(
    plants: DataFrame,
    auctions: DataFrame,
    schedule: DataFrame,
    contracts: DataFrame,
    licences: DataFrame,
    access: DataFrame,
    ties: list[str] = (),
) -> DataFrame:
    """Monitored plants with their first auction and their newest report of each kind.

    Every right side is an aggregate on the plant, already laid out and sorted by plant: only
    the registry itself is exchanged for the five joins, which then run in one stage. Asking
    for merge joins keeps it so; as broadcasts they would run in as few tasks as the registry
    has files.
    """
    supply = first_supply(auctions.filter(F.col("supply_date").isNotNull()))
    sides = [supply, latest_report(schedule, ties)]
    sides += [latest_report(r, ties).drop("sent_at", *ties) for r in (contracts, licences, access)]
    rows = plants.filter(monitored(F.col("plant_monitored")))
    for side in sides:
        rows = rows.join(side.hint("merge"), "plant_id", "left")
    return rows.drop(*ties).withColumn("no_report", F.col("sent_at").isNull())


def class_milestones(rows: DataFrame) -> DataFrame:
    """Concrete and assembly dates by the schedule numbers of the plant class."""
    kind = class_code(F.col("class_text"))
    concrete = F.when(kind == SMALL_HYDRO, F.col("reported_iv")).when(
        kind == WIND_OR_SOLAR, F.col("reported_v")
    )
    assembly = F.when(kind == WIND_OR_SOLAR, F.col("reported_vi")).otherwise(F.col("reported_x"))
    return rows.withColumns(
        {"plant_class": kind, "reported_concrete": concrete, "reported_assembly": assembly}
    )


def licence_state(rows: DataFrame) -> DataFrame:
    """Validity and kind of the strongest licence: operation, installation, preliminary."""
    kinds = [("lo_until", "LO"), ("li_until", "LI"), ("lp_until", "LP")]
    branches = [(F.col(c).isNotNull(), kind) for c, kind in kinds]
    branches.append((F.col("sent_at").isNotNull(), t.NO_LICENCE))
    return rows.withColumns(
        {
            "licence_until": F.coalesce(*[F.col(c) for c, _ in kinds]),
            "licence": first_match(branches, t.LICENCE_UNKNOWN),
        }
    )


def _contract_state(a: str, b: str, bad: str, gate: Column | None = None) -> Column:
    """State of two contracts; a bad one outweighs a good one, both inapplicable needs a look."""

    def either(*values: str) -> Column:
        return F.col(a).isin(*values) | F.col(b).isin(*values)

    neither = (F.col(a) == t.NOT_APPLICABLE) & (F.col(b) == t.NOT_APPLICABLE)
    branches = [
        (neither, t.CHECK_STATE),
        (either(t.VALID), t.OK_STATE),
        (either(t.EXPIRED, t.UNSIGNED), bad),
    ]
    if gate is not None:
        branches = [(cond & gate, state) for cond, state in branches]
    return last_match(branches, t.UNKNOWN_STATE)


def connection_state(rows: DataFrame) -> DataFrame:
    """Connection contracts; only known once the plant has reported."""
    state = _contract_state("ccd", "cct", t.NO_CONNECTION, F.col("sent_at").isNotNull())
    return rows.withColumn("connection", state)


def usage_state(rows: DataFrame) -> DataFrame:
    """Grid usage contracts; needs no report date."""
    return rows.withColumn("usage", _contract_state("cusd", "cust", t.NO_USAGE))


def sale_state(rows: DataFrame) -> DataFrame:
    """How the energy is sold: regulated, private, both or not at all."""
    private = F.col("private_sale_date").isNotNull()
    market = F.col("market")
    branches = [
        ((market == REGULATED) & ~private, t.SALE_REGULATED),
        ((market == FREE) & ~private, t.SALE_NONE),
        ((market == FREE) & private, t.SALE_PRIVATE),
    ]
    return rows.withColumn("sale", last_match(branches, t.SALE_BOTH))


def criterion(rows: DataFrame) -> DataFrame:
    """First rule that fits decides the forecast criterion of the plant."""
    waiting = F.col("works_status") == t.WORKS_NOT_STARTED
    unsold = F.col("sale") == t.SALE_NONE
    installed = F.col("licence").isin("LI", "LO")
    preliminary = F.col("licence") == "LP"
    usable = F.col("usage") == t.OK_STATE
    idle = waiting & unsold
    branches = [
        (F.col("no_forecast") == YES, 9),
        (F.col("works_status") == t.WORKS_RUNNING, 0),
        (waiting & ~unsold, 1),
        (idle & installed & usable, 2),
        (idle & preliminary & usable, 4),
        (idle & installed & ~usable, 3),
        (idle & preliminary & ~usable, 5),
        (F.col("works_status") == t.WORKS_STOPPED, 8),
        (F.col("licence") == t.NO_LICENCE, 6),
        (F.col("sent_at").isNull() & unsold, 7),
    ]
    return rows.withColumn("criterion", first_match(branches, t.NO_CRITERION))


def milestones_to_ratify(rows: DataFrame) -> DataFrame:
    """Milestones that the owner reports as reached and the registry does not have."""
    open_pairs = [
        (F.col(registry).isNull() & F.col(reported).isNotNull(), label)
        for label, registry, reported in MILESTONES_TO_RATIFY
    ]
    return rows.withColumns(
        {"to_ratify": any_of(*[c for c, _ in open_pairs]), "ratify_list": listed(open_pairs)}
    )


def review_start(rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Planned start already due this month, or the owner reports a later one."""
    planned, reported = F.col("planned_start"), F.col("reported_planned_start")
    due = holds(planned < month_end(as_of)) | holds(reported > planned)
    return rows.withColumn("review_start", due)


def plant_marks(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Listed by hand, works stopped, and no forecast possible.

    The hand-made list is joined like any table; its size decides the join.
    """
    listed_ids = selected.select("plant_id").distinct().withColumn("selected", F.lit(True))
    return (
        rows.join(listed_ids, "plant_id", "left")
        .fillna(False, ["selected"])
        .withColumns(
            {
                "paralysed": holds(F.col("works_paralysed") == YES),
                "unforeseeable": holds(F.col("no_forecast") == YES),
            }
        )
    )


def plant_states(rows: DataFrame, selected: DataFrame, as_of: dt.date) -> DataFrame:
    """All plant-level rules that need no unit data, in order."""
    for step in (
        class_milestones,
        licence_state,
        connection_state,
        usage_state,
        sale_state,
        criterion,
        milestones_to_ratify,
    ):
        rows = step(rows)
    return plant_marks(review_start(rows, as_of), selected)
