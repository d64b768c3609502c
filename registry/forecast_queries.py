"""Forecast of open units, step by step and as a whole."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from milepost.functions.rules import differs
from milepost.plans import forecast as fc
from milepost.plans.model import NO
from milepost.session import staged
from registry.base import query, steps
from registry.training_queries import back, rounded, trained
from milepost.plans import training

AS_OF = dt.date(2000, 6, 15)


def _late(side: str) -> str:
    """Chance in percent of a later date, from the rational approximation of erf."""
    z = f"((delay_{side} - mean_delay_{side}) / CASE WHEN std_delay_{side} > 0 THEN std_delay_{side} END)"
    t = f"(1 / (1 + 0.3275911 * abs({z}) / sqrt(2.0)))"
    poly = f"((((1.061405429 * {t} - 1.453152027) * {t} + 1.421413741) * {t} - 0.284496736) * {t} + 0.254829592) * {t}"
    return f"100 * (1 - 0.5 * (1 + sign({z}) * (1 - {poly} * exp(-({z} * {z}) / 2))))"


def _plus(date: str, days: str) -> str:
    return f"(CAST({date} AS TIMESTAMP) + to_microseconds(CAST(round(({days}) * 86400000) AS BIGINT) * 1000))"


_SIDE = "gen_type, phase, a, b, mean_days, mean_delay, std_delay"

steps(
    model="SELECT * FROM coef WHERE level = 'Ambos'",
    facts="""SELECT p.* EXCLUDE (gen_type), CASE WHEN gen_type = 'UTN' THEN 'UTE' ELSE gen_type END AS gen_type, a.supply_date
 FROM plant_fx p LEFT JOIN (SELECT plant_id, min(supply_date) AS supply_date FROM auction_fx GROUP BY plant_id) a
 ON p.plant_id = a.plant_id""",
    fc_input="""SELECT u.*, f.* EXCLUDE (plant_id), m.mean_days AS test_days FROM reg_unit_fx u JOIN facts f ON u.plant_id = f.plant_id
 JOIN model m ON m.gen_type = f.gen_type AND m.phase = 'OT' WHERE u.commercial_date IS NULL""",
    fc_open="""SELECT *, greatest(supply_date, granted_commercial) AS obligation_date FROM fc_input
 WHERE NOT (market = 'ACR' AND supply_date IS NULL) AND plant_monitored IS DISTINCT FROM 'Não'""",
    fc_phase="""SELECT *, CASE WHEN test_date IS NOT NULL THEN 'OT' WHEN assembly_date IS NOT NULL THEN 'ME'
 WHEN concrete_date IS NOT NULL THEN 'CC' WHEN start_date IS NOT NULL THEN 'IO' ELSE 'OUT' END AS phase FROM fc_open""",
    fc_next="""SELECT *, CASE phase WHEN 'OUT' THEN 'IO' WHEN 'IO' THEN CASE WHEN gen_type IN ('UFV', 'UTE') THEN 'ME' ELSE 'CC' END
 WHEN 'CC' THEN 'ME' WHEN 'ME' THEN 'OT' END AS next_phase,
 CASE phase WHEN 'OT' THEN test_date WHEN 'ME' THEN assembly_date WHEN 'CC' THEN concrete_date WHEN 'IO' THEN start_date
  ELSE coalesce(planned_start, DATE '2000-06-15' + 120) END AS phase_date,
 CASE WHEN phase = 'OUT' THEN 'IO' ELSE phase END AS scored_phase FROM fc_phase""",
    fc_scored="""SELECT n.*, c.a AS a_cur, c.b AS b_cur, c.mean_days AS mean_cur, c.mean_delay AS mean_delay_cur, c.std_delay AS std_delay_cur,
 x.a AS a_nxt, x.b AS b_nxt, x.mean_days AS mean_nxt, x.mean_delay AS mean_delay_nxt, x.std_delay AS std_delay_nxt,
 (n.phase_date - n.obligation_date) + c.mean_days AS delay_cur,
 ((DATE '2000-06-15' + 40) - n.obligation_date) + x.mean_days AS delay_nxt
 FROM fc_next n LEFT JOIN model c ON c.gen_type = n.gen_type AND c.phase = n.scored_phase
 LEFT JOIN model x ON x.gen_type = n.gen_type AND x.phase = n.next_phase""",
    fc_two=f"""SELECT *, {_plus('obligation_date', 'delay_cur * a_cur + b_cur')} AS f_cur,
 {_plus('obligation_date', 'delay_nxt * a_nxt + b_nxt')} AS f_nxt, {_late('cur')} AS p_cur, {_late('nxt')} AS p_nxt FROM fc_scored""",
    fc_max="""SELECT *, greatest(f_cur, f_nxt) AS f_max, CASE WHEN f_nxt >= coalesce(f_cur, f_nxt) THEN p_nxt ELSE p_cur END AS p_max FROM fc_two""",
    fc_error=f"""SELECT *, coalesce(f_max < TIMESTAMP '2000-06-30 23:59:59', false)
 OR (scored_phase <> 'OT' AND coalesce(f_max < {_plus("DATE '2000-06-15'", 'test_days')}, false)) AS forecast_error FROM fc_max""",
    fc_settled="""SELECT *, CASE WHEN phase = 'OUT' THEN f_cur ELSE f_max END AS f_set,
 CASE WHEN phase = 'OUT' THEN p_cur ELSE p_max END AS p_set FROM fc_error""",
    fc_final="""SELECT *, CASE WHEN coalesce(f_set < TIMESTAMP '2000-06-15', false) AND f_nxt IS NOT NULL THEN f_nxt ELSE f_set END AS forecast,
 CASE WHEN coalesce(f_set < TIMESTAMP '2000-06-15', false) AND f_nxt IS NOT NULL THEN p_nxt ELSE p_set END AS probability,
 CASE WHEN coalesce(DATE '2000-06-15' - test_date > 30, false) THEN 1 ELSE 0 END AS over_30_days FROM fc_settled""",
)


def model_of(t):
    return fc.model_table(trained(t).coefficient_table())


def rows_of(t, model):
    rows = fc.forecast_input(t.reg_unit_fx, t.plant_fx, t.auction_fx, model)
    return fc.split_missing_auction(rows)


def phased(t, model):
    good, _ = rows_of(t, model)
    good = good.filter(differs(F.col("plant_monitored"), NO)).withColumn(
        "obligation_date", fc.obligation(F.col("supply_date"), F.col("granted_commercial"))
    )
    return fc.impute_start(fc.current_phase(good), AS_OF)


def full(t, **options):
    table = trained(t).coefficient_table()
    return fc.forecast(t.reg_unit_fx, t.plant_fx, t.auction_fx, table, AS_OF, **options)


@query(
    "first_auction",
    "SELECT plant_id, min(supply_date) AS supply_date FROM auction_fx WHERE supply_date IS NOT NULL GROUP BY plant_id",
)
def _(t):
    return fc.first_supply(t.auction_fx.filter("supply_date IS NOT NULL"))


@query(
    "quarantine_no_auction",
    "SELECT plant_id, unit_no, gen_type FROM fc_input WHERE market = 'ACR' AND supply_date IS NULL",
)
def _(t):
    return rows_of(t, model_of(t))[1].select("plant_id", "unit_no", "gen_type")


@query(
    "obligation_date",
    """SELECT u.plant_id, u.unit_no, greatest(f.supply_date, u.granted_commercial) AS obligation_date
       FROM reg_unit_fx u JOIN facts f ON u.plant_id = f.plant_id""",
)
def _(t):
    rows = t.reg_unit_fx.join(fc.plant_facts(t.plant_fx, t.auction_fx), "plant_id")
    due = fc.obligation(F.col("supply_date"), F.col("granted_commercial"))
    return rows.select("plant_id", "unit_no", due.alias("obligation_date"))


@query("type_alias", "SELECT plant_id, gen_type FROM facts")
def _(t):
    return t.plant_fx.select("plant_id", fc.same_type(F.col("gen_type")).alias("gen_type"))


@query(
    "current_phase",
    "SELECT plant_id, unit_no, phase, phase_date, next_phase, scored_phase FROM fc_next",
)
def _(t):
    return phased(t, model_of(t)).select(
        "plant_id", "unit_no", "phase", "phase_date", "next_phase", "scored_phase"
    )


@query(
    "score_delays",
    f"""SELECT plant_id, unit_no, round(delay_cur, 4) + 0.0 AS delay_cur, round(delay_nxt, 4) + 0.0 AS delay_nxt,
        CAST({_plus('obligation_date', '-mean_cur')} AS DATE) AS expected_cur FROM fc_scored""",
)
def _(t):
    model = model_of(t)
    rows = fc.score_delays(phased(t, model), model, AS_OF)
    rows = rows.withColumn("expected_cur", F.col("expected_cur").cast("date"))
    return rounded(rows, 4, "delay_cur", "delay_nxt").select(
        "plant_id", "unit_no", "delay_cur", "delay_nxt", "expected_cur"
    )


@query(
    "two_forecasts",
    """SELECT plant_id, unit_no, CAST(f_cur AS DATE) AS forecast_cur, CAST(f_nxt AS DATE) AS forecast_nxt,
        round(p_cur, 4) + 0.0 AS probability_cur, round(p_nxt, 4) + 0.0 AS probability_nxt FROM fc_two""",
)
def _(t):
    model = model_of(t)
    rows = fc.two_forecasts(fc.score_delays(phased(t, model), model, AS_OF))
    dated = rows.withColumns({c: F.col(c).cast("date") for c in ("forecast_cur", "forecast_nxt")})
    return rounded(dated, 4, "probability_cur", "probability_nxt").select(
        "plant_id", "unit_no", "forecast_cur", "forecast_nxt", "probability_cur", "probability_nxt"
    )


@query(
    "forecast_oc",
    """SELECT plant_id, unit_no, gen_type, market, phase, CAST(forecast AS DATE) AS forecast,
        round(probability, 4) + 0.0 AS probability, forecast_error, over_30_days FROM fc_final""",
)
def _(t):
    scored, _ = full(t)
    dated = scored.withColumn("forecast", F.col("forecast").cast("date"))
    return rounded(dated, 4, "probability").select(
        "plant_id", "unit_no", "gen_type", "market", "phase", "forecast", "probability",
        "forecast_error", "over_30_days",
    )


@query(
    "forecast_error",
    """SELECT gen_type, phase, forecast_error, count(*) AS n FROM fc_final GROUP BY gen_type, phase, forecast_error""",
)
def _(t):
    scored, _ = full(t)
    return scored.groupBy("gen_type", "phase", "forecast_error").agg(F.count("*").alias("n"))


@query(
    "forecast_final",
    "SELECT plant_id, unit_no, start_date, CASE WHEN phase = 'OUT' THEN phase_date END AS start_imputed, CAST(forecast AS DATE) AS forecast FROM fc_final",
)
def _(t):
    scored, _ = full(t)
    return scored.select(
        "plant_id", "unit_no", "start_date", "start_imputed", F.col("forecast").cast("date").alias("forecast")
    )


@query(
    "test_over_30",
    """SELECT plant_id, unit_no, CASE WHEN coalesce(DATE '2000-06-15' - test_date > 30, false) THEN 1 ELSE 0 END AS over_30_days
       FROM reg_unit_fx WHERE commercial_date IS NULL""",
)
def _(t):
    rows = fc.test_over_limit(fc.open_units(t.reg_unit_fx), AS_OF)
    return rows.select("plant_id", "unit_no", "over_30_days")


steps(
    level_kind="""SELECT gen_type, phase, kind FROM (SELECT *, row_number() OVER (PARTITION BY gen_type, phase
 ORDER BY rmse, CASE WHEN kind = 'own' THEN 0 ELSE 1 END) AS rn FROM rmse_train) WHERE rn = 1""",
    model_chosen="""SELECT o.gen_type, o.phase, o.level AS market, c.a, c.b, c.mean_days, c.mean_delay, c.std_delay
 FROM coef o LEFT JOIN level_kind k ON k.gen_type = o.gen_type AND k.phase = o.phase
 JOIN coef c ON c.gen_type = o.gen_type AND c.phase = o.phase AND c.level = CASE WHEN k.kind = 'own' THEN o.level ELSE 'Ambos' END
 WHERE o.level <> 'Ambos'""",
    fc_chosen=f"""SELECT n.plant_id, n.unit_no, n.phase, {_plus('n.obligation_date', '((n.phase_date - n.obligation_date) + c.mean_days) * c.a + c.b')} AS f_cur
 FROM fc_next n LEFT JOIN model_chosen c ON c.gen_type = n.gen_type AND c.phase = n.scored_phase AND c.market = n.market""",
)


@query(
    "forecast_chosen_level",
    "SELECT plant_id, unit_no, phase, CAST(f_cur AS DATE) AS forecast_cur FROM fc_chosen",
)
def _(t):
    run, cast = back(t)
    choice = staged(training.choose_level(training.rmse(cast), "rmse"))
    scored, _ = fc.forecast(
        t.reg_unit_fx, t.plant_fx, t.auction_fx, run.coefficient_table(), AS_OF, choice=choice
    )
    return scored.select(
        "plant_id", "unit_no", "phase", F.col("forecast_cur").cast("date").alias("forecast_cur")
    )


@query(
    "forecast_after_start",
    f"""SELECT n.plant_id, n.unit_no, round(((DATE '2000-06-15' + 40) - n.obligation_date) + coalesce(l.mean_days, CASE WHEN n.phase <> 'OUT' THEN x.mean_days END), 4) + 0.0 AS delay_nxt
        FROM fc_next n LEFT JOIN model x ON x.gen_type = n.gen_type AND x.phase = n.next_phase
        LEFT JOIN model l ON n.phase = 'OUT' AND l.gen_type = n.gen_type AND l.phase = CASE WHEN n.gen_type IN ('UFV', 'UTE') THEN 'ME' ELSE 'CC' END""",
)
def _(t):
    scored, _ = full(t, next_of_waiting="after_start")
    return rounded(scored, 4, "delay_nxt").select("plant_id", "unit_no", "delay_nxt")
