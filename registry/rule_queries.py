"""Review rules: plant states, unit dates, lanes, texts, roll-up, second stage."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from milepost.operators.aggregates import value_counts
from milepost.plans import rules_plant as rp
from milepost.plans import rules_unit as ru
from milepost.plans import rules_verdict as rv
from milepost.plans import batch, training
from milepost.plans.pipelines import (
    Snapshot,
    forecast_and_review,
    review_batch,
    review_plants,
    review_tables,
    review_units,
    review_verdicts,
)
from milepost.session import SmallTable, stage_folder, staged, temporary_stages
from milepost.sources import sinks
from registry import review_queries as rq
from registry.base import STEPS, query, steps
from registry.training_queries import trained

AS_OF = dt.date(2000, 6, 15)
TIES = ("seq", "ep")


def _newest(table: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY sent_at DESC, seq DESC, ep DESC) AS rn
 FROM {table}) WHERE rn = 1"""


def _state(a: str, b: str, bad: str, gate: str = "true") -> str:
    return f"""CASE WHEN ({a} IN ('Vencido', 'Não Assinado') OR {b} IN ('Vencido', 'Não Assinado')) AND {gate} THEN '{bad}'
 WHEN ({a} = 'Válido' OR {b} = 'Válido') AND {gate} THEN 'OK'
 WHEN {a} = 'Não se Aplica' AND {b} = 'Não se Aplica' AND {gate} THEN 'Verificar' ELSE 'Não informado' END"""


# What the rules have to write, stated here once more so that a changed text shows.
_JUSTIFICATIONS = {
    9.0: "Analisar justificativa: Revogação da outorga em avaliação ou Demandas judiciais ou Inviabilidade da implantação da usina",
    8.0: "Paralisação de obras",
    0.2: "Analisar justificativa: Sem Licença de Operação (LO) ou Alterações de características técnicas ou Estágio das obras da conexão associada ou Demandas judiciais ou Paralisação de obras",
    0.1: "Estágio das obras da usina",
    0.3: "Estágio das obras da usina",
    1.0: "Compromisso de venda de energia - PPA",
    2.0: "Acesso a rede contratado - CUST/CUSD",
    3.0: "Acesso a rede não contratado - CUST/CUSD",
    4.0: "Sem Licença de Instalação - LI",
    5.0: "Sem Licença de Instalação - LI",
    6.0: "Nenhuma licença ambiental válida",
    7.0: "Sem RAPEEL",
}
_DESCRIPTIONS = {
    9: "Usina Viabilidade Baixa análise da fiscalização",
    1: "Usina sem obras com PPA = Previsão OC maior entre data calculada, data RAPEEL e data compromisso",
    2: "Usina sem obras com CUST = Previsão OC maior entre data calculada, data RAPEEL e data compromisso",
    3: "Usina sem obras, sem cust, sem PPA e com LI = Previsão OC handicap de 5 anos",
    4: "Usina sem obras, com cust, sem PPA e sem LI = Previsão OC handicap de 5 anos",
    5: "Usina sem obras, sem cust, sem PPA e sem LI = Previsão OC handicap de 5 anos",
    7: "Usina sem obras, sem PPA e sem RAPEEL = Previsão OC handicap de 5 anos",
    6: "Usina sem LP = Previsão OC sem previsão",
    8: "Usina obras paralisadas = Previsão OC maior entre data RAPEEL e data compromisso",
}
_WORKS = "Usina em obras = Previsão OC maior entre data calculada e data RAPEEL"
_TEST_LONG = "Usina em Teste há mais de 30 dias = Previsão OC próximos 60 dias"
_TEST = "Usina em Teste = Previsão OC conforme data calculada"
_GRID = "Situação das obras de conexão e linha de transmissão associada."
_MILESTONES = [
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

_OPEN = [
    f"CASE WHEN {registry} IS NULL AND {reported} IS NOT NULL THEN '{label}' END"
    for label, registry, reported in _MILESTONES
]


def _cases(column: str, mapping: dict) -> str:
    return " ".join(f"WHEN {column} = {k} THEN '{v}'" for k, v in mapping.items())


_EXTRA = "TIMESTAMP '2000-06-15'"

steps(
    schedule_new=_newest("schedule_fx"),
    contract_new=_newest("contract_fx"),
    licence_new=_newest("licence_fx"),
    access_new=_newest("access_fx"),
    rp_base="""SELECT p.*, s.* EXCLUDE (plant_id, seq, ep, rn), c.private_sale_date, l.lp_until, l.li_until, l.lo_until,
 a.ccd, a.cct, a.cusd, a.cust, s.sent_at IS NULL AS no_report, substr(p.class_text, 5, 2) AS plant_class,
 CASE substr(p.class_text, 5, 2) WHEN 'PH' THEN s.reported_iv WHEN 'CV' THEN s.reported_v END AS reported_concrete,
 CASE substr(p.class_text, 5, 2) WHEN 'CV' THEN s.reported_vi ELSE s.reported_x END AS reported_assembly
 FROM plant_fx p LEFT JOIN schedule_new s ON s.plant_id = p.plant_id LEFT JOIN contract_new c ON c.plant_id = p.plant_id
 LEFT JOIN licence_new l ON l.plant_id = p.plant_id LEFT JOIN access_new a ON a.plant_id = p.plant_id
 WHERE p.plant_monitored IS DISTINCT FROM 'Não'""",
    rp_states=f"""SELECT *, coalesce(lo_until, li_until, lp_until) AS licence_until,
 CASE WHEN lo_until IS NOT NULL THEN 'LO' WHEN li_until IS NOT NULL THEN 'LI' WHEN lp_until IS NOT NULL THEN 'LP'
  WHEN sent_at IS NOT NULL THEN 'Sem LP' ELSE 'Não Informado' END AS licence,
 {_state('ccd', 'cct', 'Sem Conexão', 'sent_at IS NOT NULL')} AS connection, {_state('cusd', 'cust', 'Sem Uso')} AS usage,
 CASE WHEN market = 'ACR' AND private_sale_date IS NULL THEN 'ACR' WHEN market = 'Fora do ACR' AND private_sale_date IS NULL THEN 'Nenhum'
  WHEN market = 'Fora do ACR' THEN 'ACL' ELSE 'Ambos' END AS sale FROM rp_base""",
    rp_plants=f"""SELECT *, CASE WHEN no_forecast = 'Sim' THEN 9 WHEN works_status = 'Em andamento' THEN 0
  WHEN works_status = 'Não Iniciada' AND sale <> 'Nenhum' THEN 1
  WHEN works_status = 'Não Iniciada' AND licence IN ('LI', 'LO') AND usage = 'OK' THEN 2
  WHEN works_status = 'Não Iniciada' AND licence = 'LP' AND usage = 'OK' THEN 4
  WHEN works_status = 'Não Iniciada' AND licence IN ('LI', 'LO') THEN 3
  WHEN works_status = 'Não Iniciada' AND licence = 'LP' THEN 5
  WHEN works_status = 'Paralisada' THEN 8 WHEN licence = 'Sem LP' THEN 6
  WHEN sent_at IS NULL AND sale = 'Nenhum' THEN 7 ELSE -8 END AS criterion,
 concat_ws(', ', {', '.join(_OPEN)}) AS ratify_list, concat_ws(', ', {', '.join(_OPEN)}) <> '' AS to_ratify,
 coalesce(planned_start < TIMESTAMP '2000-06-30 23:59:59', false) OR coalesce(reported_planned_start > planned_start, false) AS review_start,
 plant_id IN (SELECT plant_id FROM selected_fx) AS selected, coalesce(works_paralysed = 'Sim', false) AS paralysed,
 coalesce(no_forecast = 'Sim', false) AS unforeseeable FROM rp_states""",
    unit_new="SELECT * EXCLUDE (r) FROM (SELECT *, rank() OVER (PARTITION BY plant_id ORDER BY sent_at DESC) AS r FROM unit_report_fx) WHERE r = 1",
    plants_short="""SELECT DISTINCT plant_id FROM reg_unit_fx u WHERE unit_monitored IS DISTINCT FROM 'Não'
 AND NOT EXISTS (SELECT 1 FROM unit_new n WHERE n.plant_id = u.plant_id AND n.unit_no = u.unit_no)""",
    plant_latest="SELECT plant_id, max(expected_commercial) AS plant_expected FROM unit_new GROUP BY plant_id",
    ru_base="""SELECT u.plant_id, u.unit_no, u.planned_commercial, n.expected_commercial AS own, f.phase, f.probability / 100 AS probability,
 f.over_30_days, f.forecast, f.obligation_date, p.criterion, x.plant_expected,
 NOT p.no_report AND u.plant_id IN (SELECT plant_id FROM plants_short) AS units_missing
 FROM reg_unit_fx u JOIN rp_plants p ON p.plant_id = u.plant_id
 LEFT JOIN unit_new n ON n.plant_id = u.plant_id AND n.unit_no = u.unit_no
 LEFT JOIN FORECASTS f ON f.plant_id = u.plant_id AND f.unit_no = u.unit_no
 LEFT JOIN plant_latest x ON x.plant_id = u.plant_id
 WHERE u.unit_monitored IS DISTINCT FROM 'Não' AND u.commercial_date IS NULL""".replace("FORECASTS", "forecast_fx"),
    ru_owner="""SELECT *, CASE WHEN units_missing OR own IS NULL THEN plant_expected ELSE own END AS expected_commercial,
 CASE WHEN criterion = 0 AND phase IS DISTINCT FROM 'OT' THEN 0.1 WHEN criterion = 0 AND over_30_days = 1 THEN 0.2
  WHEN criterion = 0 THEN 0.3 WHEN criterion BETWEEN 1 AND 9 THEN CAST(criterion AS DOUBLE) ELSE 0.0 END AS criterion_pmo FROM ru_base""",
    ru_dates=f"""SELECT *, CASE WHEN criterion_pmo IN (0.1, 0.3) THEN greatest(CAST(expected_commercial AS TIMESTAMP), forecast)
  WHEN criterion_pmo = 0.2 THEN {_EXTRA} + INTERVAL 60 DAY
  WHEN criterion IN (1, 2) THEN greatest(CAST(expected_commercial AS TIMESTAMP), forecast, obligation_date)
  WHEN criterion IN (3, 4, 5) THEN greatest(CAST(expected_commercial AS TIMESTAMP), forecast, obligation_date, {_EXTRA} + INTERVAL 1825 DAY)
  WHEN criterion = 7 THEN greatest(forecast, CAST(obligation_date AS TIMESTAMP), {_EXTRA} + INTERVAL 2190 DAY)
  WHEN criterion = 8 THEN greatest(CAST(expected_commercial AS TIMESTAMP), obligation_date) END AS raw_date FROM ru_owner""",
    ru_manual="SELECT *, coalesce(raw_date < TIMESTAMP '2000-06-30 23:59:59', true) AS manual_date FROM ru_dates",
    ru_units=f"""SELECT *, CASE WHEN NOT manual_date THEN raw_date END AS official_date,
 CASE WHEN manual_date THEN 'Análise do Fiscal' WHEN raw_date = {_EXTRA} + INTERVAL 60 DAY THEN '60 dias'
  WHEN raw_date = expected_commercial THEN 'Previsão do agente' WHEN raw_date = obligation_date THEN 'Obrigação'
  WHEN raw_date = forecast THEN 'Data calculada' ELSE 'Handicap' END AS official_source,
 CASE phase WHEN 'OUT' THEN 0 WHEN 'IO' THEN 1 WHEN 'CC' THEN 2 WHEN 'ME' THEN 3 WHEN 'OT' THEN 4 END AS phase_rank FROM ru_manual""",
    rv_lead="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY phase_rank DESC, unit_no, official_date NULLS FIRST, official_source) AS rn
 FROM ru_units WHERE phase_rank IS NOT NULL) WHERE rn = 1""",
    rv_worst="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY criterion_pmo DESC, phase_rank DESC NULLS LAST,
 over_30_days DESC NULLS LAST, unit_no DESC) AS rn FROM ru_units) WHERE rn = 1""",
    rv_sums="""SELECT plant_id, bool_or(coalesce(planned_commercial < TIMESTAMP '2000-06-30 23:59:59', false)) AS date_past,
 bool_or(criterion_pmo IN (0.2, 0.3)) AS in_test, bool_or(coalesce(over_30_days = 1, false)) AS any_over_30_days,
 bool_or(units_missing) AS any_unit_missing, bool_or(manual_date) AS any_manual_date,
 max(planned_commercial) AS planned_commercial_max, max(expected_commercial) AS expected_commercial_max,
 max(forecast) AS forecast_max, max(obligation_date) AS obligation_date_max FROM ru_units GROUP BY plant_id""",
    rv_roll="""SELECT s.*, l.phase AS phase_max, l.official_date AS official_date_lead, l.official_source,
 w.criterion_pmo AS criterion_pmo_max, w.phase AS worst_phase, w.over_30_days AS worst_over FROM rv_sums s
 LEFT JOIN rv_lead l ON l.plant_id = s.plant_id LEFT JOIN rv_worst w ON w.plant_id = s.plant_id""",
    rv_manual=f"""SELECT p.*, r.* EXCLUDE (plant_id), coalesce(p.monitored_at < DATE '2000-06-15' - 120, false) AS stale,
 paralysed OR unforeseeable OR selected OR in_test OR any_manual_date
 OR coalesce(justification = '{_GRID}', false) AS manual FROM rp_plants p JOIN rv_roll r ON r.plant_id = p.plant_id""",
    rv_plants=f"""SELECT *, NOT manual AND NOT review_start AND NOT to_ratify AS lane_1, NOT manual AND review_start AND NOT to_ratify AS lane_2a,
 NOT manual AND to_ratify AS lane_2b, (manual AND (stale OR to_ratify OR review_start OR date_past)) OR in_test AS lane_3,
 CASE {_cases('criterion_pmo_max', _JUSTIFICATIONS)} ELSE '0' END AS justification_new,
 CASE WHEN criterion = 0 AND worst_phase IS DISTINCT FROM 'OT' THEN '{_WORKS}'
  WHEN criterion = 0 AND worst_over = 1 THEN '{_TEST_LONG}' WHEN criterion = 0 THEN '{_TEST}'
  {_cases('criterion', _DESCRIPTIONS)} ELSE '0' END AS criterion_text FROM rv_manual""",
)


def snapshot(t) -> Snapshot:
    return Snapshot(
        plants=t.plant_fx,
        units=t.reg_unit_fx,
        auctions=t.auction_fx,
        schedule=t.schedule_fx,
        contracts=t.contract_fx,
        licences=t.licence_fx,
        access=t.access_fx,
        unit_reports=t.unit_report_fx,
        selected=t.selected_fx,
        ties=TIES,
    )


def plants_of(t):
    return review_plants(snapshot(t), AS_OF)


def units_of(t):
    snap = snapshot(t)
    plants = staged(review_plants(snap, AS_OF).select("plant_id", *ru.PLANT_COLUMNS))
    return review_units(snap, plants, t.forecast_fx, AS_OF)


def batch_of(t):
    return review_batch(snapshot(t), t.forecast_fx, AS_OF)


def verdicts_of(t):
    return review_verdicts(snapshot(t), t.forecast_fx, AS_OF)


def _plant_query(name: str, *cols: str) -> None:
    """A query over the plant-level rules that shows the named columns."""

    @query(name, f"SELECT plant_id, {', '.join(cols)} FROM rp_plants")
    def _(t):
        return plants_of(t).select("plant_id", *cols)


_plant_query("assemble_plants", "gen_type", "market", "sent_at", "no_report", "private_sale_date", "lp_until", "ccd")
_plant_query("class_milestones", "plant_class", "reported_concrete", "reported_assembly")
_plant_query("licence_state", "licence_until", "licence")
_plant_query("connection_state", "connection")
_plant_query("usage_state", "usage")
_plant_query("ppa_state", "sale")
_plant_query("criterion", "criterion")
_plant_query("ratify_list", "to_ratify", "ratify_list")
_plant_query("review_start", "review_start")
_plant_query("plant_marks", "selected", "paralysed", "unforeseeable")


@query("missing_unit_flag", "SELECT plant_id FROM plants_short")
def _(t):
    return ru.missing_units(t.reg_unit_fx, ru.latest_unit_reports(t.unit_report_fx))


@query("assemble_units", "SELECT plant_id, unit_no, criterion, phase, units_missing, plant_expected FROM ru_units")
def _(t):
    return units_of(t).select(
        "plant_id", "unit_no", "criterion", "phase", "units_missing", "plant_expected"
    )


@query("owner_forecast", "SELECT plant_id, unit_no, expected_commercial FROM ru_units")
def _(t):
    return units_of(t).select("plant_id", "unit_no", "expected_commercial")


@query("criterion_pmo", "SELECT plant_id, unit_no, CAST(criterion_pmo AS DOUBLE) AS criterion_pmo FROM ru_units")
def _(t):
    return units_of(t).select("plant_id", "unit_no", "criterion_pmo")


@query("official_date", "SELECT plant_id, unit_no, official_date, manual_date FROM ru_units")
def _(t):
    return units_of(t).select("plant_id", "unit_no", "official_date", "manual_date")


@query("official_source", "SELECT plant_id, unit_no, official_source FROM ru_units")
def _(t):
    return units_of(t).select("plant_id", "unit_no", "official_source")


@query(
    "plant_flags",
    """SELECT plant_id, date_past, in_test, any_over_30_days, any_unit_missing, any_manual_date, stale, manual FROM rv_plants""",
)
def _(t):
    return verdicts_of(t).select(
        "plant_id", "date_past", "in_test", "any_over_30_days", "any_unit_missing",
        "any_manual_date", "stale", "manual",
    )


@query(
    "lanes",
    "SELECT plant_id, lane_1, lane_2a, lane_2b, lane_3, lane_1 OR lane_2a OR lane_2b OR lane_3 AS in_review FROM rv_plants",
)
def _(t):
    return verdicts_of(t).select("plant_id", *rv.LANES, "in_review")


@query("justify", "SELECT plant_id, justification_new, criterion_text FROM rv_plants")
def _(t):
    return verdicts_of(t).select("plant_id", "justification_new", "criterion_text")


@query(
    "plant_rollup",
    """SELECT plant_id, phase_max, planned_commercial_max, expected_commercial_max, CAST(forecast_max AS DATE) AS forecast_max,
        obligation_date_max, official_date_lead, official_source, CAST(criterion_pmo_max AS DOUBLE) AS criterion_pmo_max FROM rv_plants""",
)
def _(t):
    return verdicts_of(t).select(
        "plant_id", "phase_max", "planned_commercial_max", "expected_commercial_max",
        F.col("forecast_max").cast("date").alias("forecast_max"), "obligation_date_max",
        "official_date_lead", "official_source", "criterion_pmo_max",
    )


@query(
    "push_down",
    """SELECT u.plant_id, u.unit_no, u.official_date, p.justification_new, p.lane_1, p.lane_3 FROM ru_units u
       JOIN rv_plants p ON p.plant_id = u.plant_id""",
)
def _(t):
    return batch_of(t)[1].select(
        "plant_id", "unit_no", "official_date", "justification_new", "lane_1", "lane_3"
    )


@query(
    "stage_two",
    """SELECT r.plant_id, p.criterion_text, true AS lane_1, false AS lane_2a, false AS lane_2b, false AS lane_3 FROM
        (SELECT plant_id FROM rv_plants WHERE lane_2a OR lane_2b) r LEFT JOIN rv_plants p ON p.plant_id = r.plant_id""",
)
def _(t):
    plants = staged(verdicts_of(t))
    return rv.stage_two(rv.redo_list(plants), plants).select(
        "plant_id", "criterion_text", *rv.LANES
    )


@query(
    "lane_one_export",
    """SELECT u.plant_id AS "IdeUsinaOutorga", u.unit_no AS "NumUgUsina", u.official_date AS "PrevisaoOC_regra",
        p.justification_new AS "Justificativadaprevisao_new", p.criterion_text AS "DscCriterioPrevisao"
       FROM ru_units u JOIN rv_plants p ON p.plant_id = u.plant_id WHERE p.lane_1""",
)
def _(t):
    return sinks.report(batch_of(t)[1], "lane_1")


@query(
    "lane_cases",
    """SELECT manual, review_start, to_ratify, in_test, stale, lane_1, lane_2a, lane_2b, lane_3, count(*) AS n
       FROM rv_plants GROUP BY ALL""",
)
def _(t):
    cols = ["manual", "review_start", "to_ratify", "in_test", "stale", *rv.LANES]
    return value_counts(verdicts_of(t), cols)


# The whole run: train, forecast, review. Its steps are those above with the
# forecast of this run in place of the given one.
_RUN = ["ru_base", "ru_owner", "ru_dates", "ru_manual", "ru_units", "rv_lead", "rv_worst", "rv_sums", "rv_roll", "rv_manual", "rv_plants"]


def _rewired(text: str) -> str:
    for name in _RUN:
        text = re.sub(rf"\b{name}\b", f"run_{name}", text)
    return text.replace("LEFT JOIN forecast_fx f", "LEFT JOIN fc_final f")


steps(**{f"run_{name}": _rewired(STEPS[name]) for name in _RUN})


@query(
    "full_review_run",
    """SELECT plant_id, criterion_text, justification_new, phase_max, official_source,
        CAST(official_date_lead AS DATE) AS official_date_lead, lane_1, lane_2a, lane_2b, lane_3 FROM run_rv_plants""",
)
def _(t):
    plants, _, _ = forecast_and_review(snapshot(t), trained(t).coefficient_table(), AS_OF)
    return plants.select(
        "plant_id", "criterion_text", "justification_new", "phase_max", "official_source",
        F.col("official_date_lead").cast("date").alias("official_date_lead"), *rv.LANES,
    )


_LANES = ["lane_1", "lane_2a", "lane_2b", "lane_3"]
_REDO = "SELECT plant_id FROM run_rv_plants WHERE lane_2a OR lane_2b"


@query(
    "batch_status",
    f"""SELECT 1 AS stage, DATE '2000-06-15' AS as_of, count(*) AS plants,
        (SELECT count(*) FROM run_ru_units u JOIN run_rv_plants p ON p.plant_id = u.plant_id) AS units,
        (SELECT count(*) FROM fc_input WHERE market = 'ACR' AND supply_date IS NULL) AS set_aside,
        {", ".join(f"count(*) FILTER ({x}) AS {x}" for x in _LANES)} FROM run_rv_plants
       UNION ALL SELECT 2, DATE '2000-06-15', count(*),
        (SELECT count(*) FROM ({_REDO}) r LEFT JOIN run_ru_units u ON u.plant_id = r.plant_id),
        (SELECT count(*) FROM fc_input WHERE market = 'ACR' AND supply_date IS NULL), count(*), 0, 0, 0 FROM ({_REDO})""",
)
def _(t):
    """Both stages of a batch, to files, and its status rows. Each step's tables go with it."""
    folder, snap = stage_folder(t.spark), snapshot(t)
    with temporary_stages(t.spark):
        with temporary_stages(t.spark) as kept:
            table = kept(staged(trained(t).coefficient_table()))
        with temporary_stages(t.spark):
            batch.stage_one(snap, table, AS_OF, folder, "june", compression="gzip")
        batch.stage_two_batch(snap, table, AS_OF, folder, "june", compression="gzip")
    return batch.batch_status(t.spark, folder).drop("batch")


_STARTS = [*sinks.reported_columns("review"), "done", "check_start"]


@query(
    "all_reports",
    f"""SELECT 'lane_1' AS report, count(*) AS n FROM run_ru_units u JOIN run_rv_plants p ON p.plant_id = u.plant_id WHERE p.lane_1
       UNION ALL SELECT 'lane_2a', count(*) FROM run_rv_plants WHERE lane_2a
       UNION ALL SELECT 'review_list', count(*) FROM run_rv_plants WHERE lane_2b OR lane_3
       UNION ALL SELECT 'redo_list', count(*) FROM ({_REDO})
       UNION ALL SELECT 'forecast', count(*) FROM fc_final
       UNION ALL SELECT 'quarantine', count(*) FROM fc_input WHERE market = 'ACR' AND supply_date IS NULL
       UNION ALL SELECT 'todo', count(*) FROM status WHERE NOT done
       UNION ALL SELECT 'check_start', count(*) FROM start_checks WHERE check_start AND done
       UNION ALL SELECT 'check_justification', count(*) FROM just_checks
       UNION ALL SELECT 'check_dates', count(*) FROM date_checks
       UNION ALL SELECT 'coefficients', count(*) FROM coef
       UNION ALL SELECT 'training_rows', count(*) FROM delays
       UNION ALL SELECT 'test_forecasts', count(*) FROM casts WHERE NOT is_train AND level = 'Ambos'
       UNION ALL SELECT 'order_rejects', count(*) FROM judged WHERE reject_reason <> ''
       UNION ALL SELECT 'public_data', count(*) FROM history""",
)
def _(t):
    """Every report of every result table, written and read back.

    The tables of a part go once its reports are written, those of the training first.
    """
    folder = stage_folder(t.spark)
    export = lambda **tables: sinks.export_reports(tables, folder, compression="gzip")
    with temporary_stages(t.spark):
        with temporary_stages(t.spark) as kept:
            run = trained(t)
            table = kept(staged(run.coefficient_table()))
            export(
                coefficients=table,
                training=run.delays,
                backcast=training.backcast(run.delays, SmallTable(run.fit())),
                rejects=training.check_order(training.phase_durations(t.unit_fx))[1],
                history=run.history,
            )
        with temporary_stages(t.spark):
            snap = snapshot(t)
            scored, quarantine = batch.reported_forecast(snap, table, AS_OF)
            plants, units = review_tables(snap, scored, AS_OF)
            export(plants=plants, units=units, forecasts=scored, quarantine=quarantine)
        # Starts have two reports; the others are written as they are computed.
        with temporary_stages(t.spark):
            starts = staged(rq.starts_of(t).select(*_STARTS))
            export(review=starts, justifications=rq.justifications_of(t), dates=rq.dates_of(t))
    return sinks.report_counts(t.spark, folder)
