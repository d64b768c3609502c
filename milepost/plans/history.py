"""Finished units from the current registry and from the legacy records, in one layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.rules import holds
from milepost.functions.text import unit_count
from milepost.operators.aggregates import collapse_units
from milepost.operators.joins import lookup
from milepost.operators.mapping import apply_mapping, route_columns
from milepost.operators.setops import union_with_origin
from milepost.plans.model import PHASES, REGULATED
from milepost.session import staged

# Legacy column -> column of the common layout. The pairs are the
# default; callers with a mapping table of their own pass it instead.
LEGACY_COLUMNS = {
    "Idempreendimento": "plant_id",
    "Num_UG": "unit_list",
    "Pot_UG": "unit_mw",
    "OpCom_Outor_UG": "obligation_date",
    "OpTest_R_UG": "test_date",
    "OpCom_R_UG": "commercial_date",
    "Obras_Real": "start_date",
    "Concretagem_Real": "concrete_date",
    "Montagem_Real": "assembly_date",
    "Torres_Real": "towers_date",
    "DscComercializacaoEnergia": "market",
}


def first_supply(auctions: DataFrame) -> DataFrame:
    """Earliest supply date of every plant that sold in an auction."""
    return auctions.groupBy("plant_id").agg(F.min("supply_date").alias("supply_date"))


def training_obligation(market, supply, granted):
    """Regulated plants owe their supply date, all others the granted date."""
    return F.when(holds(market == REGULATED), supply).otherwise(granted)


def registry_history(units: DataFrame, plants: DataFrame, auctions: DataFrame) -> DataFrame:
    """Collapsed registry units with the attributes of their plant.

    Only plants with an auction keep their attributes; units of other plants stay with
    unknown ones, and plants without units stay too.
    """
    sold = staged(plants.join(first_supply(auctions), "plant_id"))
    collapsed = staged(collapse_units(units, "unit_mw"))
    bare = sold.join(collapsed.select("plant_id"), "plant_id", "left_anti")
    merged = collapsed.join(sold, "plant_id", "left").unionByName(bare, allowMissingColumns=True)
    return merged.withColumn(
        "obligation_date",
        training_obligation(F.col("market"), F.col("supply_date"), F.col("granted_commercial")),
    )


def normalise_legacy(legacy: DataFrame, mapping: dict[str, str] = LEGACY_COLUMNS) -> DataFrame:
    """Legacy rows in the common layout, unit lists turned into unit counts."""
    mapped = apply_mapping(legacy, mapping)
    return mapped.withColumns(
        {
            "assembly_date": F.coalesce("assembly_date", "towers_date"),
            "plant_id": F.col("plant_id").cast("bigint"),
            "unit_mw": F.col("unit_mw").cast("double"),
            "legacy_units": unit_count(F.col("unit_list")),
        }
    ).drop("towers_date", "unit_list")


def legacy_history(legacy: DataFrame, types: DataFrame) -> DataFrame:
    """Collapsed legacy rows with their generation type looked up by plant."""
    typed = lookup(normalise_legacy(legacy), types, "plant_id", "gen_type", "entry_no")
    return collapse_units(typed, "unit_mw", "legacy_units")


# Columns of the merged history, whatever the origin of a row.
HISTORY_COLUMNS = [
    "plant_id", "gen_type", "market", "obligation_date", "commercial_date",
    *PHASES.values(), "unit_count", "total_power",
]
# What settles equal operation dates of a plant, the older records first.
HISTORY_ORDER = ["origin", "total_power", "unit_count", *PHASES.values(), "obligation_date", "market"]


def merged_history(
    legacy: DataFrame, types: DataFrame, units: DataFrame, plants: DataFrame, auctions: DataFrame
) -> DataFrame:
    """Both origins in one layout, with all milestones, the market and where a row came from.

    Registry units bring their test and operation dates, plants all other milestones; legacy
    rows bring all of their own and take their generation type from ``types``.
    """
    own = ["plant_id", "unit_mw", "test_date", "commercial_date", "granted_commercial"]
    shared = ["plant_id", "gen_type", "market", *(m for m in PHASES.values() if m not in own)]
    registry = registry_history(units.select(*own), plants.select(*shared), auctions)
    both = {"legacy": legacy_history(legacy, types), "registry": registry}
    return combine_history(**route_columns(HISTORY_COLUMNS, both))


def combine_history(legacy: DataFrame, registry: DataFrame) -> DataFrame:
    return union_with_origin({"legacy": legacy, "registry": registry})
