"""Training: durations, order, trimming, regression, evaluation, diagnostics."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from milepost.plans import training
from milepost.plans.model import SEGMENT
from milepost.plans.pipelines import train, train_merged
from milepost.session import SmallTable
from registry.base import STEPS, query, steps

CUT_OFF = dt.date(2000, 1, 1)
ORDER = ["unit_no", "ep"]
PHASES = {"IO": "start_date", "CC": "concrete_date", "ME": "assembly_date", "OT": "test_date"}
_PAIRS = [("IO", "CC"), ("IO", "ME"), ("IO", "OT"), ("CC", "ME"), ("CC", "OT"), ("ME", "OT")]


def trained(t) -> training.Training:
    return train(t.unit_fx, ORDER, CUT_OFF)


def rounded(df, digits: int, *cols):
    """Round and clear the sign of a zero."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in cols})


_DAYS = ", ".join(f"commercial_date - {m} AS days_{p}" for p, m in PHASES.items())
_REASON = " || ".join(
    f"CASE WHEN coalesce(days_{a} < days_{b}, false) THEN '{b}>{a},' ELSE '' END" for a, b in _PAIRS
)
_KEY = """CASE WHEN gen_type = 'UHE' AND count(*) OVER (PARTITION BY plant_id) > 1
 THEN concat(CAST(plant_id AS STRING), '_', CAST(row_number() OVER (PARTITION BY plant_id, gen_type = 'UHE' ORDER BY commercial_date, unit_no, ep) - 1 AS STRING)) ELSE CAST(plant_id AS STRING) END AS unit_key"""
_OBS = " UNION ALL ".join(
    f"""SELECT unit_key, gen_type, market, obligation_date, commercial_date, delay, is_train, '{p}' AS phase,
 {m} AS milestone_date, days_{p} AS days FROM history_tagged"""
    for p, m in PHASES.items()
)

steps(
    durations=f"SELECT *, {_DAYS}, commercial_date - obligation_date AS delay FROM (SELECT *, {_KEY} FROM unit_fx)",
    judged=f"SELECT *, {_REASON} AS reject_reason FROM durations",
    history="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit_key ORDER BY commercial_date, unit_no, ep) AS rn
 FROM judged WHERE reject_reason = '') WHERE rn = 1""",
    history_tagged="SELECT *, commercial_date < DATE '2000-01-01' AS is_train FROM history",
    obs_phase=_OBS,
    obs="""SELECT *, 'Ambos' AS level FROM obs_phase UNION ALL SELECT *, market AS level FROM obs_phase
 WHERE market IN ('ACR', 'Fora do ACR')""",
    stats_first="""SELECT gen_type, phase, level, avg(days) AS m, stddev_samp(days) AS s FROM obs WHERE is_train
 GROUP BY gen_type, phase, level""",
    flagged="""SELECT o.*, coalesce(o.days > f.m + 1.65 * f.s OR o.days < f.m - 1.65 * f.s, false) AS outlier
 FROM obs o LEFT JOIN stats_first f ON o.gen_type = f.gen_type AND o.phase = f.phase AND o.level = f.level""",
    stats="""SELECT gen_type, phase, level, count(days) AS n, avg(days) AS mean_days, stddev_samp(days) AS std_days
 FROM flagged WHERE is_train AND NOT outlier GROUP BY gen_type, phase, level""",
    delays="""SELECT f.*, s.mean_days, s.std_days, (f.milestone_date - f.obligation_date) + s.mean_days AS milestone_delay
 FROM flagged f LEFT JOIN stats s ON f.gen_type = s.gen_type AND f.phase = s.phase AND f.level = s.level""",
    fit_pairs="""SELECT *, milestone_delay AS x, CAST(delay AS DOUBLE) AS y FROM delays WHERE is_train AND milestone_delay IS NOT NULL
 AND NOT coalesce(days > mean_days + 1.65 * std_days OR days < mean_days - 1.65 * std_days, false)""",
    fit_table="""SELECT gen_type, phase, level, CASE WHEN var_pop(x) > 0 THEN regr_slope(y, x) END AS a,
 CASE WHEN var_pop(x) > 0 THEN regr_intercept(y, x) END AS b,
 CASE WHEN var_pop(x) > 0 AND var_pop(y) > 0 THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END AS r,
 avg(x) AS mean_delay, stddev_pop(x) AS std_delay FROM fit_pairs GROUP BY gen_type, phase, level""",
    coef="""SELECT g.gen_type, p.phase, l.level, coalesce(s.n, 0) AS n, s.mean_days, s.std_days, f.a, f.b, f.r,
 f.mean_delay, f.std_delay FROM (SELECT DISTINCT gen_type FROM history) g,
 (SELECT unnest(['IO', 'CC', 'ME', 'OT']) AS phase) p, (SELECT unnest(['Ambos', 'ACR', 'Fora do ACR']) AS level) l
 LEFT JOIN stats s ON s.gen_type = g.gen_type AND s.phase = p.phase AND s.level = l.level
 LEFT JOIN fit_table f ON f.gen_type = g.gen_type AND f.phase = p.phase AND f.level = l.level""",
    casts="""SELECT d.*, d.delay - (d.milestone_delay * f.a + f.b) AS err, d.milestone_delay * f.a + f.b AS shift
 FROM delays d LEFT JOIN fit_table f ON f.gen_type = d.gen_type AND f.phase = d.phase AND f.level = d.level""",
    plants_out="SELECT DISTINCT unit_key FROM flagged WHERE outlier",
    rmse_train="""SELECT gen_type, phase, CASE WHEN level = 'Ambos' THEN 'all' ELSE 'own' END AS kind,
 round_even(sqrt(avg(floor(round(err, 8)) * floor(round(err, 8)))), 1) AS rmse, count(err) AS n FROM casts
 WHERE is_train AND unit_key NOT IN (SELECT unit_key FROM plants_out) GROUP BY ALL HAVING count(err) > 0""",
    rmse_test="""SELECT gen_type, phase, CASE WHEN level = 'Ambos' THEN 'all' ELSE 'own' END AS kind,
 round_even(sqrt(avg(floor(round(err, 8)) * floor(round(err, 8)))), 1) AS rmse, count(err) AS n FROM casts
 WHERE NOT is_train GROUP BY ALL HAVING count(err) > 0""",
    resid="SELECT p.*, p.y - (p.x * f.a + f.b) AS residual FROM fit_pairs p LEFT JOIN fit_table f ON f.gen_type = p.gen_type AND f.phase = p.phase AND f.level = p.level",
)


@query(
    "phase_durations",
    """SELECT plant_id, unit_no, CAST(days_IO AS DOUBLE) AS days_IO, CAST(days_CC AS DOUBLE) AS days_CC,
        CAST(days_ME AS DOUBLE) AS days_ME, CAST(days_OT AS DOUBLE) AS days_OT, CAST(delay AS DOUBLE) AS delay FROM durations""",
)
def _(t):
    spans = [f"days_{p}" for p in PHASES]
    return training.phase_durations(t.unit_fx).select("plant_id", "unit_no", *spans, "delay")


@query("order_check", "SELECT plant_id, unit_no, CAST(delay AS DOUBLE) AS delay FROM judged WHERE reject_reason = ''")
def _(t):
    clean, _ = training.check_order(training.phase_durations(t.unit_fx))
    return clean.select("plant_id", "unit_no", "delay")


@query("order_rejects", "SELECT plant_id, unit_no, gen_type, reject_reason FROM judged WHERE reject_reason <> ''")
def _(t):
    _, rejects = training.check_order(training.phase_durations(t.unit_fx))
    return rejects.select("plant_id", "unit_no", "gen_type", "reject_reason")


@query(
    "first_unit_history",
    "SELECT unit_key, plant_id, unit_no, gen_type, market, commercial_date, CAST(delay AS DOUBLE) AS delay FROM history",
)
def _(t):
    cols = ["unit_key", "plant_id", "unit_no", "gen_type", "market", "commercial_date", "delay"]
    return training.clean_history(t.unit_fx, ORDER).select(*cols)


@query("date_split", "SELECT unit_key, is_train FROM history_tagged")
def _(t):
    before, after = training.split_by_date(training.clean_history(t.unit_fx, ORDER), CUT_OFF)
    marked = before.withColumn("is_train", F.lit(True)).unionByName(
        after.withColumn("is_train", F.lit(False))
    )
    return marked.select("unit_key", "is_train")


@query(
    "phase_stats",
    """SELECT gen_type, phase, level, count(days) AS n, round(avg(days), 4) AS mean_days,
        round(stddev_samp(days), 4) AS std_days FROM obs GROUP BY gen_type, phase, level""",
)
def _(t):
    obs = training.observations(training.clean_history(t.unit_fx, ORDER), CUT_OFF)
    return rounded(training._spread(obs), 4, "mean_days", "std_days")


@query("outlier_flags", "SELECT unit_key, phase, level, outlier FROM flagged")
def _(t):
    return trained(t).flagged.select("unit_key", "phase", "level", "outlier")


@query(
    "trimmed_stats",
    "SELECT gen_type, phase, level, n, round(mean_days, 4) AS mean_days, round(std_days, 4) AS std_days FROM stats",
)
def _(t):
    return rounded(trained(t).stats.df, 4, "mean_days", "std_days")


@query(
    "milestone_delay",
    """SELECT unit_key, phase, level, round(milestone_delay, 4) + 0.0 AS milestone_delay,
        CAST(CAST(obligation_date AS TIMESTAMP) - to_microseconds(CAST(round(mean_days * 86400000) AS BIGINT) * 1000) AS DATE) AS expected_date
       FROM delays""",
)
def _(t):
    rows = trained(t).delays.withColumn("expected_date", F.col("expected_date").cast("date"))
    return rounded(rows, 4, "milestone_delay").select(
        "unit_key", "phase", "level", "milestone_delay", "expected_date"
    )


@query(
    "delay_means",
    """SELECT gen_type, phase, level, round(avg(milestone_delay), 4) AS mean_delay FROM delays WHERE level <> 'Ambos'
        AND unit_key NOT IN (SELECT unit_key FROM plants_out) GROUP BY gen_type, phase, level
       UNION ALL SELECT gen_type, phase, 'Ambos', round(avg(milestone_delay), 4) FROM delays WHERE level <> 'Ambos'
        AND unit_key NOT IN (SELECT unit_key FROM plants_out) GROUP BY gen_type, phase""",
)
def _(t):
    return rounded(training.delay_means(trained(t).delays), 4, "mean_delay")


@query(
    "delay_regression",
    """SELECT gen_type, phase, level, round(a, 6) AS a, round(b, 4) AS b, round(r, 6) AS r,
        round(mean_delay, 4) AS mean_delay, round(std_delay, 4) AS std_delay FROM fit_table""",
)
def _(t):
    return rounded(rounded(trained(t).fit(), 6, "a", "r"), 4, "b", "mean_delay", "std_delay")


_COEF = """SELECT gen_type, phase, level, n, round(mean_days, 4) AS mean_days, round(std_days, 4) AS std_days,
 round(a, 6) AS a, round(b, 4) AS b, round(mean_delay, 4) AS mean_delay, round(std_delay, 4) AS std_delay FROM coef"""


@query("coefficient_table", _COEF)
def _(t):
    table = trained(t).coefficient_table().drop("r")
    return rounded(rounded(table, 6, "a"), 4, "mean_days", "std_days", "b", "mean_delay", "std_delay")


def back(t):
    run = trained(t)
    return run, training.backcast(run.delays, SmallTable(run.fit()))


@query(
    "backcast",
    """SELECT unit_key, phase, level, round(round(err, 8), 3) + 0.0 AS forecast_error FROM casts""",
)
def _(t):
    _, cast = back(t)
    return rounded(cast, 3, "forecast_error").select("unit_key", "phase", "level", "forecast_error")


@query("rmse_by_type", "SELECT * FROM rmse_train")
def _(t):
    return training.rmse(back(t)[1])


@query("rmse_test_by_type", "SELECT * FROM rmse_test")
def _(t):
    return training.rmse(back(t)[1], train=False)


@query(
    "level_choice",
    """SELECT gen_type, phase, kind FROM (SELECT *, row_number() OVER (PARTITION BY gen_type, phase
        ORDER BY rmse, CASE WHEN kind = 'own' THEN 0 ELSE 1 END) AS rn FROM rmse_train) WHERE rn = 1""",
)
def _(t):
    return training.choose_level(training.rmse(back(t)[1]), "rmse")


@query(
    "residual_means",
    "SELECT gen_type, phase, level, abs(round(avg(residual), 4)) AS mean_residual FROM resid GROUP BY gen_type, phase, level",
)
def _(t):
    run = trained(t)
    rows = training.mean_residuals(training.residuals(run.delays, SmallTable(run.fit())))
    return rows.withColumn("mean_residual", F.abs(F.round("mean_residual", 4)))


@query(
    "residual_histogram",
    """WITH lim AS (SELECT gen_type, phase, min(delay) AS lo, max(delay) AS hi FROM fit_pairs WHERE level = 'Ambos' GROUP BY gen_type, phase)
       SELECT p.gen_type, p.phase, CASE WHEN hi > lo THEN CAST(least(floor(CAST(p.delay - lo AS DOUBLE) / (hi - lo) * 30), 29) AS INT) ELSE 15 END AS bin,
        count(*) AS n FROM fit_pairs p JOIN lim ON p.gen_type = lim.gen_type AND p.phase = lim.phase WHERE p.level = 'Ambos' GROUP BY ALL""",
)
def _(t):
    rows = training.fit_rows(trained(t).delays).filter("level = 'Ambos'")
    return training.histogram(rows, ["gen_type", "phase"], "delay", 30)


@query(
    "normality_jb",
    """SELECT gen_type, phase, level, n, round(jb, 3) AS jb, round(exp(-jb / 2), 4) AS p_value FROM
        (SELECT gen_type, phase, level, n, n / 6.0 * ((m3 / pow(m2, 1.5)) ** 2 + (m4 / (m2 * m2) - 3) ** 2 / 4) AS jb FROM
         (SELECT p.gen_type, p.phase, p.level, count(*) AS n, avg((y - mu) ** 2) AS m2, avg((y - mu) ** 3) AS m3, avg((y - mu) ** 4) AS m4
          FROM fit_pairs p JOIN (SELECT gen_type, phase, level, avg(y) AS mu FROM fit_pairs GROUP BY gen_type, phase, level) g
           ON p.gen_type = g.gen_type AND p.phase = g.phase AND p.level = g.level GROUP BY p.gen_type, p.phase, p.level))""",
)
def _(t):
    rows = training.normality(training.fit_rows(trained(t).delays), SEGMENT, "delay")
    return rounded(rounded(rows, 3, "jb"), 4, "p_value")


def _horner(coefficients: str, x: str) -> str:
    """SQL of a polynomial whose coefficients rise in power."""
    text = "0.0"
    for c in reversed(coefficients.split()):
        text = f"({text} * {x} + {c}::DOUBLE)"
    return text


def _probit(p: str) -> str:
    """SQL of the inverse normal distribution in the middle and at the sides (AS 241)."""
    middle = (
        "3.3871328727963666080e0 1.3314166789178437745e2 1.9715909503065514427e3 1.3731693765509461125e4"
        " 4.5921953931549871457e4 6.7265770927008700853e4 3.3430575583588128105e4 2.5090809287301226727e3",
        "1 4.2313330701600911252e1 6.8718700749205790830e2 5.3941960214247511077e3"
        " 2.1213794301586595867e4 3.9307895800092710610e4 2.8729085735721942674e4 5.2264952788528545610e3",
    )
    side = (
        "1.42343711074968357734e0 4.63033784615654529590e0 5.76949722146069140550e0 3.64784832476320460504e0"
        " 1.27045825245236838258e0 2.41780725177450611770e-1 2.27238449892691845833e-2 7.74545014278341407640e-4",
        "1 2.05319162663775882187e0 1.67638483018380384940e0 6.89767334985100004550e-1"
        " 1.48103976427480074590e-1 1.51986665636164571966e-2 5.47593808499534494600e-4 1.05075007164441684324e-9",
    )
    q, r = f"({p} - 0.5)", f"(sqrt(-ln(least({p}, 1 - {p}))) - 1.6)"
    inner, outer = (" / ".join(_horner(c, x) for c in parts) for parts, x in ((middle, f"(0.180625 - {q} * {q})"), (side, r)))
    return f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {inner} ELSE sign({q}) * {outer} END"


# Weights of Royston's W test: the two ends by their polynomials, the others by their scores.
steps(
    w_rows="""SELECT gen_type, phase, level, 'delay' AS variable, y AS x FROM fit_pairs
 UNION ALL SELECT gen_type, phase, level, 'milestone_delay', x FROM fit_pairs""",
    w_ranked=f"""SELECT *, {_probit('((i - 0.375) / (n + 0.25))')} AS m FROM
 (SELECT *, row_number() OVER (PARTITION BY gen_type, phase, level, variable ORDER BY x)::DOUBLE AS i,
  count(*) OVER (PARTITION BY gen_type, phase, level, variable)::DOUBLE AS n FROM w_rows)""",
    w_ends=f"""SELECT gen_type, phase, level, variable, n, sum(m * m) AS mm, max(m) AS m1, max(m) FILTER (i = n - 1) AS m2,
 CASE WHEN n = 3 THEN sqrt(0.5) ELSE {_horner('0 0.221157 -0.147981 -2.07119 4.434685 -2.706056', '(1 / sqrt(n))')} + max(m) / sqrt(sum(m * m)) END AS a1,
 {_horner('0 0.042981 -0.293762 -1.752461 5.682633 -3.582633', '(1 / sqrt(n))')} + max(m) FILTER (i = n - 1) / sqrt(sum(m * m)) AS a2
 FROM w_ranked WHERE n >= 3 GROUP BY gen_type, phase, level, variable, n""",
    w_weighted="""SELECT r.*, CASE WHEN i IN (1, r.n) THEN sign(m) * a1 WHEN r.n > 5 AND i IN (2, r.n - 1) THEN sign(m) * a2 WHEN r.n = 3 THEN 0
 ELSE m / sqrt((mm - 2 * m1 * m1 - CASE WHEN r.n > 5 THEN 2 * m2 * m2 ELSE 0 END) / (1 - 2 * a1 * a1 - CASE WHEN r.n > 5 THEN 2 * a2 * a2 ELSE 0 END)) END AS a
 FROM w_ranked r JOIN w_ends e USING (gen_type, phase, level, variable)""",
    w_values="""SELECT gen_type, phase, level, variable, r.n::BIGINT AS n,
 CASE WHEN max(r.x) > min(r.x) THEN least(pow(sum(a * (r.x - mu)), 2) / sum(pow(r.x - mu, 2)), 1) END AS w FROM w_weighted r
 JOIN (SELECT gen_type, phase, level, variable, avg(x) AS mu FROM w_rows GROUP BY ALL) USING (gen_type, phase, level, variable)
 GROUP BY ALL""",
)


@query(
    "normality_w",
    """SELECT gen_type, phase, level, variable, count(*) AS n, round(max(w), 6) AS w
       FROM w_rows LEFT JOIN w_values USING (gen_type, phase, level, variable) GROUP BY ALL""",
)
def _(t):
    rows = training.fit_rows(trained(t).delays).select(*SEGMENT, "delay", "milestone_delay")
    tests = training.normality_by_order(rows, SEGMENT, ["delay", "milestone_delay"])
    return tests.select(*SEGMENT, "variable", "n", F.round("w", 6).alias("w"))


@query(
    "normality_verdict",
    f"""SELECT gen_type, phase, level, variable, CASE WHEN n > 11 THEN ln(1 - w) >
         {_horner('-1.5861 -0.31082 -0.083751 0.0038915', 'ln(n)')} + 1.6448536 * exp({_horner('-0.4803 -0.082676 0.0030302', 'ln(n)')})
        ELSE -ln({_horner('-2.273 0.459', 'n')} - ln(1 - w)) >
         {_horner('0.5440 -0.39978 0.025054 -6.714e-4', 'n')} + 1.6448536 * exp({_horner('1.3822 -0.77857 0.062767 -0.0020322', 'n')}) END AS not_normal
        FROM w_values WHERE n > 3 AND w IS NOT NULL""",
)
def _(t):
    rows = training.fit_rows(trained(t).delays).select(*SEGMENT, "delay", "milestone_delay")
    tests = training.normality_by_order(rows, SEGMENT, ["delay", "milestone_delay"])
    return tests.filter("n > 3 AND w IS NOT NULL").select(
        *SEGMENT, "variable", (F.col("p_value") < 0.05).alias("not_normal")
    )


@query(
    "milestone_histogram",
    """WITH lim AS (SELECT gen_type, phase, min(x) AS lo, max(x) AS hi FROM fit_pairs WHERE level = 'Ambos' GROUP BY gen_type, phase)
       SELECT p.gen_type, p.phase, CASE WHEN hi > lo THEN CAST(least(floor(round((p.x - lo) / (hi - lo) * 30, 9)), 29) AS INT) ELSE 15 END AS bin,
        count(*) AS n FROM fit_pairs p JOIN lim ON p.gen_type = lim.gen_type AND p.phase = lim.phase WHERE p.level = 'Ambos' GROUP BY ALL""",
)
def _(t):
    rows = training.fit_rows(trained(t).delays).filter("level = 'Ambos'")
    return training.histogram(rows, ["gen_type", "phase"], "milestone_delay", 30)


@query(
    "correlation_matrix",
    """SELECT gen_type, max(CASE WHEN phase = 'IO' THEN p END) AS "IO", max(CASE WHEN phase = 'CC' THEN p END) AS "CC",
        max(CASE WHEN phase = 'ME' THEN p END) AS "ME", max(CASE WHEN phase = 'OT' THEN p END) AS "OT"
       FROM (SELECT gen_type, phase, round_even(r * 100, 1) AS p FROM fit_table WHERE level = 'Ambos') GROUP BY gen_type""",
)
def _(t):
    return training.correlations(trained(t).fit())


# --- legacy and registry records merged, then trained as one ------------------

_MILESTONES = ["start_date", "concrete_date", "assembly_date", "test_date"]
_MERGED = ["plant_id", "gen_type", "market", "obligation_date", "commercial_date", *_MILESTONES, "unit_count", "total_power"]
_MERGED_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in ["origin", "total_power", "unit_count", *_MILESTONES, "obligation_date", "market"]
)


def _merged_step(text: str) -> str:
    """A training step over the merged history in place of the finished units."""
    for name in _CHAIN:
        text = re.sub(rf"\b{name}\b", f"mg_{name}", text)
    text = text.replace("unit_fx", "mg_finished").replace("commercial_date, unit_no, ep", f"commercial_date, {_MERGED_ORDER}")
    return text


_CHAIN = [
    "durations", "judged", "history", "history_tagged", "obs_phase", "obs", "stats_first", "flagged", "stats", "delays",
    "fit_pairs", "fit_table", "coef",
]

steps(
    mg_legacy="""SELECT 'legacy' AS origin, u.plant_id, p.gen_type, u.market, u.obligation_date, u.commercial_date, u.start_date,
 u.concrete_date, coalesce(u.assembly_date, u.start_date + 30) AS assembly_date, u.test_date, CAST(sum(3) AS BIGINT) AS unit_count,
 coalesce(sum(u.unit_mw), 0.0) AS total_power
 FROM unit_fx u LEFT JOIN plant_fx p ON p.plant_id = u.plant_id GROUP BY ALL""",
    mg_sold="""SELECT p.*, a.supply_date FROM plant_fx p JOIN
 (SELECT plant_id, min(supply_date) AS supply_date FROM auction_fx GROUP BY plant_id) a ON p.plant_id = a.plant_id""",
    mg_units="""SELECT plant_id, test_date, commercial_date, granted_commercial, CAST(count(unit_mw) AS BIGINT) AS unit_count,
 coalesce(sum(unit_mw), 0.0) AS total_power FROM reg_unit_fx GROUP BY ALL""",
    mg_registry="""SELECT 'registry' AS origin, coalesce(u.plant_id, p.plant_id) AS plant_id, p.gen_type, p.market,
 CASE WHEN p.market = 'ACR' THEN p.supply_date ELSE u.granted_commercial END AS obligation_date, u.commercial_date, p.start_date,
 p.concrete_date, p.assembly_date, u.test_date, u.unit_count, u.total_power
 FROM mg_units u FULL JOIN mg_sold p ON p.plant_id = u.plant_id""",
    mg_all="SELECT * FROM mg_legacy UNION ALL SELECT * FROM mg_registry",
    mg_finished="SELECT * FROM mg_all WHERE obligation_date IS NOT NULL AND commercial_date IS NOT NULL AND plant_id IS NOT NULL",
)
steps(**{f"mg_{name}": _merged_step(STEPS[name]) for name in _CHAIN})


def merged(t):
    """Both origins: finished units as legacy records in their own column names and texts."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd").cast("date")
    first = (F.col("unit_no") % 10).cast("string")
    legacy = t.unit_fx.select(
        F.col("plant_id").cast("string").alias("Idempreendimento"),
        F.concat(F.lit("0"), first, F.lit(" a "), (F.col("unit_no") % 10 + 2).cast("string")).alias("Num_UG"),
        F.col("unit_mw").cast("string").alias("Pot_UG"),
        F.col("obligation_date").alias("OpCom_Outor_UG"),
        F.col("test_date").alias("OpTest_R_UG"),
        iso("commercial_date").alias("OpCom_R_UG"),
        F.col("start_date").alias("Obras_Real"),
        F.col("concrete_date").alias("Concretagem_Real"),
        F.col("assembly_date").alias("Montagem_Real"),
        F.date_add("start_date", 30).alias("Torres_Real"),
        F.col("market").alias("DscComercializacaoEnergia"),
    )
    types = t.plant_fx.select("plant_id", "gen_type", F.col("plant_id").alias("entry_no"))
    return train_merged(legacy, types, t.reg_unit_fx, t.plant_fx, t.auction_fx, CUT_OFF)


@query("merged_history", f"SELECT origin, {', '.join(_MERGED)} FROM mg_all")
def _(t):
    return merged(t)[0].select("origin", *_MERGED)


@query("merged_training", _merged_step(_COEF))
def _(t):
    table = merged(t)[1].coefficient_table().drop("r")
    return rounded(rounded(table, 6, "a"), 4, "mean_days", "std_days", "b", "mean_delay", "std_delay")


@query(
    "merged_first_units",
    """SELECT unit_key, plant_id, gen_type, market, commercial_date, CAST(delay AS DOUBLE) AS delay FROM mg_history""",
)
def _(t):
    return merged(t)[1].history.select("unit_key", "plant_id", "gen_type", "market", "commercial_date", "delay")
