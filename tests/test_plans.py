from __future__ import annotations

import datetime as dt
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from milepost.plans import batch as bt
from milepost.plans import forecast as fc
from milepost.plans import pipelines as pl
from milepost.plans import rules_plant as rp
from milepost.plans import rules_unit as ru
from milepost.plans import rules_verdict as rv
from milepost.plans import texts, training
from milepost.plans.model import LEVELS, PHASES
from milepost.session import SmallTable, staged
from milepost.sources import sinks
from registry import rule_queries as rq
from registry.base import QUERIES, Tables
from registry.training_queries import trained
from tests.conftest import FOLDER
from tests.stages import stage_root, stage_tables

AS_OF = dt.date(2000, 6, 15)
CUT = dt.date(2001, 1, 1)


# --- training against a plain pandas computation ------------------------------


def sample_units(n=400):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        end = dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randrange(600))
        spans = sorted((rnd.randrange(10, 900) for _ in PHASES), reverse=True)
        dates = [end - dt.timedelta(days=s) if rnd.random() > 0.2 else None for s in spans]
        market = rnd.choice(["ACR", "Fora do ACR", None])
        due = end - dt.timedelta(days=rnd.randrange(-100, 400))
        rows.append((i, 1, rnd.choice(["UTE", "EOL"]), market, due, end, *dates))
    return rows


UNIT_SCHEMA = (
    "plant_id int, unit_no int, gen_type string, market string, obligation_date date, "
    "commercial_date date, start_date date, concrete_date date, assembly_date date, test_date date"
)


def by_hand(units: pd.DataFrame) -> dict:
    days = lambda a, b: (pd.to_datetime(a) - pd.to_datetime(b)).dt.days.astype(float)
    train = pd.to_datetime(units.commercial_date) < pd.Timestamp(CUT)
    y = days(units.commercial_date, units.obligation_date)
    found = {}
    for gen in ("UTE", "EOL"):
        for level in LEVELS:
            rows = (units.gen_type == gen) & train
            if level != "Ambos":
                rows &= units.market == level
            for phase, milestone in PHASES.items():
                span = days(units.commercial_date, units[milestone])
                m, s = span[rows].mean(), span[rows].std()
                first = rows & ~((span > m + 1.65 * s) | (span < m - 1.65 * s))
                m, s, n = span[first].mean(), span[first].std(), span[first].count()
                kept = rows & ~((span > m + 1.65 * s) | (span < m - 1.65 * s)) & span.notna()
                x = days(units[milestone], units.obligation_date)[kept] + m
                a, b = np.polyfit(x, y[kept], 1)
                found[gen, phase, level] = (n, m, s, a, b, x.mean(), x.std(ddof=0))
    return found


def test_training_matches_plain_computation(spark):
    df = spark.createDataFrame(sample_units(), UNIT_SCHEMA)
    run = training.Training(training.clean_history(df), CUT)
    expected = by_hand(df.toPandas())
    table = run.coefficient_table().collect()
    assert len(table) == len(expected) == 2 * 4 * 3
    for r in table:
        got = (r.n, r.mean_days, r.std_days, r.a, r.b, r.mean_delay, r.std_delay)
        assert got == pytest.approx(expected[r.gen_type, r.phase, r.level], rel=1e-6, abs=1e-6)


def test_small_segments(spark):
    """Empty, single and constant segments give unknown lines, not failures."""
    day = dt.date(2000, 5, 1)
    rows = [(1, 1, "UTE", "ACR", day, day, day, None, None, None)]
    run = training.Training(training.clean_history(spark.createDataFrame(rows, UNIT_SCHEMA)), CUT)
    table = {(r.phase, r.level): r for r in run.coefficient_table().collect()}
    assert len(table) == 12
    assert table["IO", "ACR"].n == 1 and table["IO", "ACR"].a is None
    assert table["OT", "Fora do ACR"].n == 0 and table["OT", "Fora do ACR"].mean_days is None
    cast = training.backcast(run.delays, SmallTable(run.fit()))
    assert cast.filter("forecast_error IS NOT NULL").isEmpty()


def test_rejects_name_each_reason(spark):
    d = lambda m: dt.date(2000, m, 1)
    row = (1, 1, "UTE", "ACR", d(1), d(9), d(5), d(4), None, d(3))
    clean, rejects = training.check_order(spark.createDataFrame([row], UNIT_SCHEMA))
    assert clean.isEmpty()
    assert rejects.first().reject_reason == "CC>IO,OT>IO,OT>CC,"


# --- forecast -----------------------------------------------------------------


def test_phases_and_aliases(spark):
    d = dt.date(1999, 1, 1)
    rows = spark.createDataFrame(
        [("UFV", d, None, None, None), ("UHE", d, None, None, None), ("UHE", d, d, None, d), ("UTE",) + (None,) * 4],
        "gen_type string, start_date date, concrete_date date, assembly_date date, test_date date",
    )
    got = [(r.phase, r.next_phase) for r in fc.current_phase(rows).collect()]
    assert got == [("IO", "ME"), ("IO", "CC"), ("OT", None), ("OUT", "IO")]
    alias = spark.createDataFrame([("UTN",), ("EOL",)], "g string").select(fc.same_type(F.col("g")))
    assert [r[0] for r in alias.collect()] == ["UTE", "EOL"]


# --- rules --------------------------------------------------------------------


def test_no_rule_matched(spark):
    units = spark.createDataFrame(
        [(1, -8, None, None, None, None, None, False, None)],
        "plant_id int, criterion int, phase string, over_30_days int, forecast timestamp_ntz, "
        "obligation_date date, expected_commercial date, units_missing boolean, plant_expected date",
    )
    row = ru.unit_rules(units, AS_OF).first()
    assert (row.criterion_pmo, row.official_date, row.manual_date) == (0.0, None, True)
    assert row.official_source == texts.SOURCE_REVIEWER


def test_operating_unit_left_out_counts(spark):
    units = spark.createDataFrame(
        [(1, 1, None, dt.date(2000, 1, 1)), (1, 2, "Não", None)],
        "plant_id int, unit_no int, unit_monitored string, commercial_date date",
    )
    latest = spark.createDataFrame([(1, 3)], "plant_id int, unit_no int")
    assert [r.plant_id for r in ru.missing_units(units, latest).collect()] == [1]
    only_unmonitored = units.filter("unit_no = 2")
    assert ru.missing_units(only_unmonitored, latest).isEmpty()


@pytest.fixture(scope="module")
def batch(spark):
    plants, units = rq.batch_of(Tables(spark, FOLDER))
    return staged(plants), staged(units)


def test_lanes_are_disjoint_and_dates_not_past(batch):
    plants, units = batch
    automatic = sum(F.col(c).cast("int") for c in rv.LANES[:3])
    assert plants.filter(automatic > 1).isEmpty()
    assert units.filter(F.col("official_date") < F.lit(dt.datetime(2000, 6, 30, 23, 59, 59))).isEmpty()
    assert units.filter("manual_date <> (official_date IS NULL)").isEmpty()
    assert units.filter("(official_source = 'Análise do Fiscal') <> manual_date").isEmpty()


def test_rollup_keeps_plants_and_units_whole(batch):
    plants, units = batch
    assert plants.count() == units.select("plant_id").distinct().count()
    both = plants.select("plant_id").join(units, "plant_id", "left_anti")
    assert both.isEmpty()


def test_ratify_list_text(spark):
    cols = [(label, reg, rep) for label, reg, rep in rp.MILESTONES_TO_RATIFY]
    d = dt.date(2000, 1, 1)
    schema = ", ".join([f"{reg} date" for _, reg, _ in cols] + [f"{rep} date" for _, _, rep in cols])
    values = [None] * 10 + [d, None, d] + [None] * 7
    row = rp.milestones_to_ratify(spark.createDataFrame([tuple(values)], schema)).first()
    assert row.to_ratify and row.ratify_list == "DatInicioObraRealizado, DatMontagemRealizado"


# --- plans at scale -----------------------------------------------------------


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_and_no_python_in_the_plans(spark):
    t = Tables(spark, FOLDER)
    for df in (rq.plants_of(t), rq.units_of(t), *rq.batch_of(t)):
        text = physical(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "Python" not in text and "Pandas" not in text


def test_rollup_is_one_aggregation(batch):
    text = physical(rv.plant_rollup(batch[1], AS_OF))
    assert text.count("Exchange hashpartitioning(plant_id") == 1
    assert "partial_max_by" in text and "partial_min_by" in text


def test_scans_read_only_needed_columns(spark):
    t = Tables(spark, FOLDER)
    text = physical(fc.first_supply(t.auction_fx))
    assert "l_orderkey" in text and "l_extendedprice" not in text


def test_batches_open_and_close(spark, tmp_path):
    t, folder = Tables(spark, FOLDER), str(tmp_path)
    table = staged(trained(t).coefficient_table())
    run = lambda stage, name, **more: stage(rq.snapshot(t), table, AS_OF, folder, name, **more)
    assert bt.batch_status(spark, folder).isEmpty() and bt.open_batches(spark, folder).isEmpty()
    with pytest.raises(ValueError, match="not open"):
        run(bt.stage_two_batch, "may")
    plants, _ = run(bt.stage_one, "may")
    with pytest.raises(ValueError, match="not finished"):
        run(bt.stage_one, "june")
    redo = {r.plant_id for r in plants.filter("lane_2a OR lane_2b").collect()}
    listed = sinks.read_report(spark, f"{folder}/may/stage_1", "redo_list")
    assert redo and {int(r.IdeUsinaOutorga) for r in listed.collect()} == redo
    again, units = run(bt.stage_two_batch, "may")
    assert {r.plant_id for r in again.collect()} == redo and units.filter("NOT lane_1").isEmpty()
    assert bt.open_batches(spark, folder).isEmpty()
    assert sorted(r.stage for r in bt.batch_status(spark, folder).collect()) == [1, 2]


def test_unit_queries_stage_only_what_units_read(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(rq, "staged", lambda df: seen.append(df.columns) or df)
    rq.units_of(Tables(spark, FOLDER))
    assert seen == [["plant_id", *ru.PLANT_COLUMNS]]


def test_review_tables_are_those_of_the_batch(spark):
    t = Tables(spark, FOLDER)
    for ours, theirs in zip(pl.review_tables(rq.snapshot(t), t.forecast_fx, AS_OF), rq.batch_of(t), strict=True):
        assert ours.columns == theirs.columns and "Scan parquet" in physical(ours) and "Join" not in physical(ours)
        assert ours.exceptAll(theirs).isEmpty() and ours.count() == theirs.count()


def test_a_stage_table_has_settings_of_its_own(spark):
    key, seen = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    assert staged(spark.range(3), **{key: "8000"}).count() == 3 and spark.conf.get(key) == seen


def test_training_computes_what_is_asked_for(spark, monkeypatch):
    """the merged history alone, and its first units, cost no training."""
    made = []
    monkeypatch.setattr(pl, "clean_history", lambda *a, **k: made.append("history") or training.clean_history(*a, **k))
    spread = training.trimmed_stats
    monkeypatch.setattr(training, "trimmed_stats", lambda *a: made.append("stats") or spread(*a))
    run = pl.train(spark.createDataFrame(sample_units(50), UNIT_SCHEMA), cut_off=CUT)
    assert made == []
    assert run.history.count() > 0 and made == ["history"]
    assert run.coefficient_table().count() == 24 and made == ["history", "stats"]


def test_plants_of_a_batch_need_no_table_of_units(spark, monkeypatch):
    """F5, F7, F13, F16 to F18: units are rolled up where they met their plants."""
    tables = []
    monkeypatch.setattr(pl, "staged", lambda df: tables.append(df.columns) or staged(df))
    t = Tables(spark, FOLDER)
    plants = pl.review_verdicts(rq.snapshot(t), t.forecast_fx, AS_OF)
    assert not any("official_date" in columns for columns in tables)
    whole, _ = pl.review_batch(rq.snapshot(t), t.forecast_fx, AS_OF)
    assert plants.columns == whole.columns
    assert plants.exceptAll(whole).isEmpty() and whole.exceptAll(plants).isEmpty()


def test_partitions_are_merged_to_a_bounded_size(spark):
    """a task does not gather small partitions up to Spark's 64 MB."""
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_all_reports_leave_nothing_but_the_reports(spark):
    """the tables behind the reports go with their part of the run."""
    before = stage_tables(spark)
    counts = {r.report: r.n for r in QUERIES["all_reports"](spark, FOLDER).collect()}
    assert set(counts) == set(sinks.REPORTS) and counts["coefficients"] == 60
    (left,) = stage_tables(spark) - before
    assert {x for x in os.listdir(f"{stage_root(spark)}/{left}") if not x.startswith((".", "_"))} == {f"report={x}" for x in sinks.REPORTS}


def test_the_second_stage_writes_listed_plants_only(spark, monkeypatch):
    """plants that are not listed leave before units and verdicts; the rows are those of the whole batch."""
    snap, forecasts = rq.snapshot(Tables(spark, FOLDER)), Tables(spark, FOLDER).forecast_fx
    plants, units = pl.review_tables(snap, forecasts, AS_OF)
    more = spark.createDataFrame([(-5,), (None,)], "plant_id long")
    listed = rv.redo_list(plants)
    ids = staged(listed.unionByName(listed.limit(2)).unionByName(more))
    sizes = []
    monkeypatch.setattr(pl, "staged", lambda df: sizes.append(df.count()) or staged(df))
    found = pl.redone_tables(ids, snap, forecasts, AS_OF)
    assert sizes[0] < plants.count() and max(sizes[2:]) < units.count()
    for ours, theirs in zip(found, (rv.stage_two(ids, plants), rv.stage_two(ids, units)), strict=True):
        assert ours.columns == theirs.columns and ours.count() > 0
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_a_batch_leaves_nothing_but_its_files(spark):
    """the tables of each stage go once its files are written."""
    before = stage_tables(spark)
    assert QUERIES["batch_status"](spark, FOLDER).count() == 2
    (left,) = stage_tables(spark) - before
    assert {x for x in os.listdir(f"{stage_root(spark)}/{left}") if not x.startswith(".")} == {"june", "_status"}
