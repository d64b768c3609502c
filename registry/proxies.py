"""Domain views derived from the given tables. The same text runs in Spark and DuckDB;
base tables stand in braces. Every view keeps all rows of its table; where a plant is to lack
reports or forecasts, those rows belong to a plant that the registry does not know (a
negative id)."""

TABLES = {
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
}

_TYPE = """CASE o_custkey % 6 WHEN 0 THEN 'UFV' WHEN 1 THEN 'UTE' WHEN 2 THEN 'UHE'
 WHEN 3 THEN 'EOL' WHEN 4 THEN 'PCH' ELSE {last} END"""
_UNIT_NO = "l_partkey * 1000000 + l_suppkey * 10 + l_linenumber"


def _after(date: str, days: str) -> str:
    return f"CAST({date} AS DATE) + CAST({days} AS INT)"


PROXIES = {
    # Finished generating units with their milestones.
    "unit_fx": f"""
SELECT l.l_orderkey AS plant_id, {_UNIT_NO} AS unit_no, l.l_extendedprice AS ep,
 l.l_quantity AS unit_mw, {_TYPE.replace('{last}', "'UFV'")} AS gen_type,
 CASE WHEN o.o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'ACR'
  WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE 'Fora do ACR' END AS market,
 CAST(o.o_orderdate AS DATE) AS obligation_date,
 CAST(l.l_shipdate AS DATE) AS commercial_date,
 CASE WHEN l.l_tax < 0.07 THEN CAST(l.l_shipdate AS DATE) - CAST(floor(l.l_quantity) AS INT) END AS test_date,
 CASE WHEN l.l_discount < 0.09 THEN CAST(l.l_shipdate AS DATE) - CAST(floor(l.l_quantity * 3) AS INT) END AS assembly_date,
 CASE WHEN l.l_discount > 0.02 THEN CAST(l.l_shipdate AS DATE) - CAST(45 + floor(l.l_quantity * 2) AS INT) END AS concrete_date,
 CAST(l.l_shipdate AS DATE) - CAST(120 + floor(l.l_extendedprice / 500) AS INT) AS start_date
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey""",
    # Registry units, some of them in operation.
    "reg_unit_fx": f"""
SELECT l_orderkey AS plant_id, {_UNIT_NO} AS unit_no, l_quantity AS unit_mw,
 CASE WHEN l_discount < 0.01 THEN 'Não' WHEN l_discount < 0.03 THEN NULL ELSE 'Sim' END AS unit_monitored,
 CASE WHEN l_tax < 0.02 THEN CAST(l_shipdate AS DATE) - CAST(floor(l_quantity) AS INT) END AS test_date,
 CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS commercial_date,
 CASE WHEN l_quantity > 5 THEN CAST(l_shipdate AS DATE) + 100 END AS granted_commercial,
 CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + 60 END AS planned_commercial
FROM {{lineitem}}""",
    "auction_fx": """
SELECT l_orderkey AS plant_id, l_partkey AS lot,
 CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS DATE) - 30 END AS supply_date
FROM {lineitem}""",
    # Plant registry.
    "plant_fx": f"""
SELECT o_orderkey AS plant_id, concat('P', CAST(o_orderkey AS STRING)) AS plant_name,
 concat('ABC.', CASE o_custkey % 3 WHEN 0 THEN 'PH' WHEN 1 THEN 'CV' ELSE 'RS' END, '.01') AS class_text,
 {_TYPE.replace('{last}', "'UTN'")} AS gen_type,
 CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'ACR' ELSE 'Fora do ACR' END AS market,
 CASE WHEN o_totalprice < 40000 THEN 'Não' WHEN o_totalprice < 60000 THEN NULL ELSE 'Sim' END AS plant_monitored,
 CASE WHEN o_custkey % 11 = 0 THEN 'Sim' ELSE 'Não' END AS no_forecast,
 CASE WHEN o_custkey % 13 = 0 THEN 'Sim' ELSE 'Não' END AS works_paralysed,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Em andamento' WHEN '2-HIGH' THEN 'Paralisada'
  WHEN '5-LOW' THEN NULL ELSE 'Não Iniciada' END AS works_status,
 CASE o_custkey % 7 WHEN 0 THEN 'Situação das obras de conexão e linha de transmissão associada.'
  WHEN 1 THEN 'Paralisação de obras' WHEN 2 THEN NULL
  ELSE 'Compromisso de venda de energia - PPA' END AS justification,
 CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) + 100 END AS monitored_at,
 CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 200 END AS planned_start,
 CAST(o_orderdate AS DATE) + 150 AS granted_start,
 CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderdate AS DATE) + 10 END AS start_date,
 CASE WHEN o_orderkey % 4 > 1 AND o_custkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 150 END AS concrete_date,
 CASE WHEN o_orderkey % 4 = 3 THEN CAST(o_orderdate AS DATE) + 300 END AS assembly_date,
 CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) + 310 END AS filling_date,
 CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_orderdate AS DATE) + 320 END AS transmission_start_date,
 CASE WHEN o_orderkey % 9 > 1 THEN CAST(o_orderdate AS DATE) + 5 END AS site_date,
 CASE WHEN o_orderkey % 9 > 2 THEN CAST(o_orderdate AS DATE) + 330 END AS commissioning_date,
 CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS DATE) + 340 END AS transmission_end_date,
 CASE WHEN o_orderkey % 7 > 1 THEN CAST(o_orderdate AS DATE) + 20 END AS diversion_date,
 CASE WHEN o_orderkey % 7 > 2 THEN CAST(o_orderdate AS DATE) + 290 END AS towers_date
FROM {{orders}}""",
    # Self-reports of four kinds, many per plant; seq settles equal times.
    "schedule_fx": f"""
SELECT CASE WHEN l_returnflag <> 'N' THEN l_orderkey ELSE -l_orderkey END AS plant_id, CAST(l_shipdate AS DATE) AS sent_at, {_UNIT_NO} AS seq, l_extendedprice AS ep,
 CASE WHEN l_tax < 0.06 THEN {_after('l_shipdate', 'floor(l_quantity)')} END AS reported_planned_start,
 CASE WHEN l_quantity > 40 THEN {_after('l_shipdate', '-100')} END AS reported_site,
 CASE WHEN l_quantity > 30 THEN {_after('l_shipdate', '-90')} END AS reported_start,
 CASE WHEN l_tax < 0.02 THEN {_after('l_shipdate', '-80')} END AS reported_iv,
 CASE WHEN l_tax < 0.03 THEN {_after('l_shipdate', '-70')} END AS reported_v,
 CASE WHEN l_tax > 0.06 THEN {_after('l_shipdate', '-60')} END AS reported_vi,
 CASE WHEN l_discount > 0.08 THEN {_after('l_shipdate', '-50')} END AS reported_towers,
 CASE WHEN l_discount < 0.02 THEN {_after('l_shipdate', '-45')} END AS reported_diversion,
 CASE WHEN l_quantity < 10 THEN {_after('l_shipdate', '-40')} END AS reported_x,
 CASE WHEN l_quantity < 20 THEN {_after('l_shipdate', '-30')} END AS reported_filling,
 CASE WHEN l_discount > 0.05 THEN {_after('l_shipdate', '-20')} END AS reported_commissioning,
 CASE WHEN l_discount > 0.06 THEN {_after('l_shipdate', '-15')} END AS reported_transmission_start,
 CASE WHEN l_discount > 0.07 THEN {_after('l_shipdate', '-10')} END AS reported_transmission_end
FROM {{lineitem}}""",
    "contract_fx": f"""
SELECT CASE WHEN l_returnflag <> 'N' THEN l_orderkey ELSE -l_orderkey END AS plant_id, CAST(l_shipdate AS DATE) AS sent_at, {_UNIT_NO} AS seq, l_extendedprice AS ep,
 CASE WHEN l_discount > 0.07 THEN CAST(l_shipdate AS DATE) END AS private_sale_date
FROM {{lineitem}}""",
    "licence_fx": f"""
SELECT CASE WHEN l_returnflag <> 'N' THEN l_orderkey ELSE -l_orderkey END AS plant_id, CAST(l_shipdate AS DATE) AS sent_at, {_UNIT_NO} AS seq, l_extendedprice AS ep,
 CASE WHEN l_quantity > 10 THEN CAST(l_shipdate AS DATE) + 365 END AS lp_until,
 CASE WHEN l_quantity > 25 THEN CAST(l_shipdate AS DATE) + 500 END AS li_until,
 CASE WHEN l_quantity > 40 THEN CAST(l_shipdate AS DATE) + 700 END AS lo_until
FROM {{lineitem}}""",
    "access_fx": f"""
SELECT CASE WHEN l_returnflag <> 'N' THEN l_orderkey ELSE -l_orderkey END AS plant_id, CAST(l_shipdate AS DATE) AS sent_at, {_UNIT_NO} AS seq, l_extendedprice AS ep,
 CASE WHEN l_tax < 0.02 THEN 'Válido' WHEN l_tax < 0.03 THEN 'Vencido' WHEN l_tax < 0.04 THEN 'Não Assinado'
  WHEN l_tax < 0.07 THEN 'Não se Aplica' END AS ccd,
 CASE WHEN l_discount < 0.02 THEN 'Válido' WHEN l_discount < 0.03 THEN 'Vencido'
  WHEN l_discount < 0.04 THEN 'Não Assinado' WHEN l_discount < 0.09 THEN 'Não se Aplica' END AS cct,
 CASE WHEN l_tax > 0.05 THEN 'Válido' WHEN l_tax > 0.04 THEN 'Vencido' WHEN l_tax > 0.01 THEN 'Não se Aplica' END AS cusd,
 CASE WHEN l_discount > 0.05 THEN 'Válido' WHEN l_discount > 0.04 THEN 'Não Assinado'
  WHEN l_discount > 0.01 THEN 'Não se Aplica' END AS cust
FROM {{lineitem}}""",
    # Several unit rows share one report time.
    "unit_report_fx": f"""
SELECT CASE WHEN l_returnflag <> 'N' OR l_linestatus = 'O' THEN l_orderkey ELSE -l_orderkey END AS plant_id, {_UNIT_NO} AS unit_no,
 CAST(date_trunc('year', l_shipdate) AS DATE) AS sent_at,
 CASE WHEN l_quantity > 4 THEN CAST(l_shipdate AS DATE) + 90 END AS expected_commercial
FROM {{lineitem}}""",
    # Forecast of open units, as another run would have left it.
    "forecast_fx": f"""
SELECT CASE WHEN l_returnflag <> 'R' THEN l_orderkey ELSE -l_orderkey END AS plant_id, {_UNIT_NO} AS unit_no,
 CASE WHEN l_tax < 0.02 THEN 'OT' WHEN l_tax < 0.04 THEN 'ME' WHEN l_tax < 0.05 THEN 'CC'
  WHEN l_tax < 0.07 THEN 'IO' ELSE 'OUT' END AS phase,
 l_quantity * 2 AS probability,
 CASE WHEN l_tax < 0.01 THEN 1 ELSE 0 END AS over_30_days,
 CASE WHEN l_discount > 0 THEN {_after('l_shipdate', 'floor(l_quantity * 12)')} END AS forecast,
 CAST(l_shipdate AS DATE) + 60 AS obligation_date
FROM {{lineitem}}""",
    # Free-text unit lists of legacy records.
    "legacy_fx": f"""
SELECT l_orderkey AS plant_id, l_partkey AS pk,
 concat('0', CAST(l_linenumber AS STRING), ' a ',
  CAST(l_linenumber + CAST(floor(l_quantity / 10) AS INT) AS STRING),
  CASE WHEN l_linestatus = 'O' THEN ' e 40' ELSE '-45, 50' END) AS unit_list,
 l_quantity AS mw
FROM {{lineitem}}""",
    # Work list of a review batch.
    "review_fx": """
SELECT c_custkey AS plant_id, concat('F', CAST(c_nationkey % 5 AS STRING)) AS reviewer,
 CASE WHEN c_acctbal > 2000 THEN true END AS manual,
 CASE WHEN c_acctbal > 4000 THEN CAST('1999-06-01' AS DATE) + CAST(c_nationkey * 10 AS INT) END AS rule_date,
 CASE c_nationkey % 4 WHEN 0 THEN 'Analisar justificativa: outra' WHEN 1 THEN 'Paralisação de obras'
  WHEN 2 THEN 'Compromisso de venda de energia - PPA' END AS justification_new
FROM {customer}""",
    "selected_fx": "SELECT c_custkey AS plant_id FROM {customer} WHERE c_acctbal < 0",
    # Submissions stamped with a time of day.
    "submission_fx": """
SELECT user_id AS plant_id, ts AS sent_at, event_id,
 CASE event_type WHEN 'purchase' THEN 'Válido' WHEN 'click' THEN 'Vencido'
  WHEN 'error' THEN 'Não Assinado' WHEN 'view' THEN 'Não se Aplica' END AS contract_status,
 CASE WHEN value < 30 THEN NULL ELSE CAST(ts AS DATE) + CAST(floor(value) AS INT) END AS valid_until
FROM {events}""",
}
