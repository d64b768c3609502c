"""Sources, projections, filters, joins, aggregates, windows, set and scalar operators."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from milepost.functions import dates, stats, text
from milepost.functions.rules import any_of, differs, first_match, last_match, monitored
from milepost.operators import aggregates as agg
from milepost.operators import joins, mapping, pick, setops
from milepost.plans.history import first_supply, legacy_history, registry_history, training_obligation
from milepost.session import SmallTable, stage_folder
from milepost.sources import files, manifest, sinks, splits, views
from registry.base import query, steps

AS_OF = dt.date(2000, 6, 15)

# --- sources ------------------------------------------------------------------


@query(
    "typed_scan",
    """SELECT l_orderkey AS plant_id, CAST(l_shipdate AS TIMESTAMP) AS shipped, l_quantity AS quantity
       FROM lineitem""",
)
def _(t):
    raw = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("IdeUsina"),
        F.col("l_shipdate").cast("string").alias("DatShip"),
        F.col("l_quantity").cast("string").alias("MdaQuantity"),
    )
    names = {"IdeUsina": "plant_id", "DatShip": "shipped", "MdaQuantity": "quantity"}
    return views.scan(views.apply_prefix_types(raw), names)


@query(
    "coerce_dates",
    """SELECT l_orderkey AS plant_id,
        CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) END AS "DatShip" FROM lineitem""",
)
def _(t):
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    wrong = F.date_format("l_shipdate", "dd/MM/yyyy")
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("plant_id"),
        F.when(F.col("l_returnflag") != "R", day).otherwise(wrong).alias("DatShip"),
    )
    return views.coerce_dates(raw)


@query(
    "snapshot_manifest",
    """SELECT r_name AS table_name FROM region
       UNION ALL SELECT n_name FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)""",
)
def _(t):
    loads = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("table_name"),
        F.timestamp_seconds("c_custkey").cast("timestamp_ntz").alias("loaded_at"),
    )
    names = t.nation.select(F.col("n_name").alias("table_name"))
    required = names.unionByName(t.region.select(F.col("r_name").alias("table_name")))
    return manifest.missing_tables(manifest.latest_entries(loads), required)


_SNAPSHOT = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@query(
    "snapshot_commit",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, {2 if name == 'orders' else 1} AS folders, count(*) AS n_rows, count(*) AS n_read,
 CAST({2 if name == 'orders' else 1} * count(*) AS BIGINT) AS n_second FROM {name}"""
        for name in _SNAPSHOT
    ),
)
def _(t):
    """Two generations, the second with twice the orders, read pinned to the first and the second."""
    spark, folder = t.spark, stage_folder(t.spark)
    tables = {name: getattr(t, name) for name in _SNAPSHOT}
    first = manifest.commit_tables(spark, tables, folder, dt.datetime(2024, 3, 1))
    again = {"orders": t.orders.unionByName(t.orders)}
    manifest.commit_tables(spark, again, folder, dt.datetime(2024, 3, 2))

    def counts(generation, name):
        parts = [
            df.groupBy().agg(F.lit(table).alias("table_name"), F.count("*").alias(name))
            for table, df in manifest.read_tables(spark, folder, generation).items()
        ]
        return reduce(lambda a, b: a.unionByName(b), parts)

    listed = manifest.read_manifest(spark, folder, first).select("table_name", "n_rows", "path")
    newest = manifest.read_manifest(spark, folder).select("table_name", F.col("path").alias("new_path"))
    joined = listed.join(newest, "table_name").join(counts(first, "n_read"), "table_name").join(counts(None, "n_second"), "table_name")
    folders = F.when(F.col("path") == F.col("new_path"), 1).otherwise(2).alias("folders")
    return joined.select("table_name", folders, "n_rows", "n_read", "n_second")


@query(
    "ingest_changed_file",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'X' END AS o_orderstatus,
        CASE WHEN o_orderstatus = 'F' THEN 'finished.csv' ELSE 'others.csv' END AS file FROM orders""",
)
def _(t):
    """Two sources of csv files, ingested, one of them rewritten, ingested again."""
    folder = stage_folder(t.spark)
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    sources = {"finished.csv": rows.filter("o_orderstatus = 'F'"), "others.csv": rows.filter("o_orderstatus <> 'F'")}
    for name, part in sources.items():
        part.write.csv(f"{folder}/{name}", header=True)
    paths = [f"{folder}/{name}" for name in sources]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string"
    files.ingest_files(t.spark, paths, parquet_dir=f"{folder}/copies", schema=schema)
    changed = sources["others.csv"].withColumn("o_orderstatus", F.lit("X"))
    changed.write.mode("overwrite").csv(paths[1], header=True)
    rows = files.ingest_files(t.spark, paths, parquet_dir=f"{folder}/copies", schema=schema)
    name = F.element_at(F.split(files.SOURCE_FILE, "/"), -2)
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus", name.alias("file"))


@query(
    "split_read",
    "SELECT count(*) AS n_rows, 16 AS parts, CAST(0 AS BIGINT) AS uncovered, CAST(0 AS BIGINT) AS twice, true AS even FROM lineitem",
)
def _(t):
    counts = splits.key_counts(t.lineitem, "l_orderkey")
    predicates = splits.split_predicates(counts, "l_orderkey", 16)
    takers = reduce(lambda a, b: a + b, [F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in predicates])
    largest = max(n for _, n in counts)
    per_part = splits.read_split(t.lineitem.withColumn("takers", takers), predicates).groupBy("part").agg(
        F.count("*").alias("n"), F.count_if(F.col("takers") == 0).alias("none"), F.count_if(F.col("takers") > 1).alias("more")
    )
    return per_part.agg(
        F.sum("n").alias("n_rows"),
        F.count("part").cast("int").alias("parts"),
        F.sum("none").alias("uncovered"),
        F.sum("more").alias("twice"),
        (F.max("n") <= F.sum("n") / 16 + largest).alias("even"),
    )


@query(
    "table_round_trip",
    "SELECT event_id, user_id, CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) AS ts FROM events",
)
def _(t):
    path = stage_folder(t.spark)
    sinks.write_table(t.events.select("event_id", "user_id", "ts"), path, "user_id")
    return t.spark.read.parquet(path)


@query(
    "cross_file_overlap",
    """SELECT o_custkey, min(o_orderstatus) AS first_file, max(o_orderstatus) AS last_file
       FROM orders GROUP BY o_custkey HAVING min(o_orderstatus) <> max(o_orderstatus)""",
)
def _(t):
    tagged = t.orders.select("o_custkey", F.col("o_orderstatus").alias(files.SOURCE_FILE))
    return files.overlapping_values(tagged, "o_custkey")


@query(
    "id_list_member",
    """SELECT o_orderkey AS plant_id FROM orders WHERE o_orderkey IN
        (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def _(t):
    lines = t.customer.filter("c_acctbal < 0").select(
        F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(",\n")).alias("value")
    )
    ids = files.parse_ids(lines)
    return t.orders.select(F.col("o_orderkey").alias("plant_id")).join(ids, "plant_id", "left_semi")


@query(
    "export_lane_columns",
    """SELECT plant_id AS "IdeUsinaOutorga", granted_start AS "DatInicioObraOutorgado",
        granted_start AS prev_IO_rapeel, planned_start AS prev_IO_SFG
       FROM plant_fx WHERE coalesce(planned_start < DATE '2000-01-01', false)""",
)
def _(t):
    rows = t.plant_fx.withColumns(
        {
            "reported_planned_start": F.col("granted_start"),
            "lane_2a": F.coalesce(F.col("planned_start") < dates.day(dt.date(2000, 1, 1)), F.lit(False)),
        }
    )
    return sinks.report(rows, "lane_2a")


# --- projections and filters --------------------------------------------------


@query(
    "monitored_filter",
    "SELECT plant_id, plant_monitored FROM plant_fx WHERE coalesce(plant_monitored <> 'Não', true)",
)
def _(t):
    return t.plant_fx.filter(monitored(F.col("plant_monitored"))).select("plant_id", "plant_monitored")


@query(
    "open_units_filter",
    "SELECT plant_id, unit_no FROM reg_unit_fx WHERE commercial_date IS NULL AND unit_no IS NOT NULL",
)
def _(t):
    rows = t.reg_unit_fx.filter(F.col("commercial_date").isNull() & F.col("unit_no").isNotNull())
    return rows.select("plant_id", "unit_no")


@query(
    "null_safe_not_equal",
    "SELECT plant_id, works_status FROM plant_fx WHERE works_status IS DISTINCT FROM 'Paralisada'",
)
def _(t):
    return t.plant_fx.filter(differs(F.col("works_status"), "Paralisada")).select(
        "plant_id", "works_status"
    )


@query(
    "required_dates",
    "SELECT plant_id, unit_no FROM unit_fx WHERE test_date IS NOT NULL AND concrete_date IS NOT NULL",
)
def _(t):
    return t.unit_fx.dropna(subset=["test_date", "concrete_date"]).select("plant_id", "unit_no")


@query(
    "first_match_rules",
    """SELECT plant_id, CASE WHEN no_forecast = 'Sim' THEN 9 WHEN works_status = 'Em andamento' THEN 0
        WHEN works_status = 'Paralisada' THEN 8 WHEN market = 'ACR' THEN 1 ELSE -8 END AS rule FROM plant_fx""",
)
def _(t):
    branches = [
        (F.col("no_forecast") == "Sim", 9),
        (F.col("works_status") == "Em andamento", 0),
        (F.col("works_status") == "Paralisada", 8),
        (F.col("market") == "ACR", 1),
    ]
    return t.plant_fx.select("plant_id", first_match(branches, -8).alias("rule"))


@query(
    "last_match_rules",
    """SELECT event_id, CASE WHEN contract_status IN ('Vencido', 'Não Assinado') THEN 'Sem Uso'
        WHEN contract_status = 'Válido' THEN 'OK' WHEN contract_status = 'Não se Aplica' THEN 'Verificar'
        ELSE 'Não informado' END AS state FROM submission_fx""",
)
def _(t):
    status = F.col("contract_status")
    branches = [
        (status == "Não se Aplica", "Verificar"),
        (status == "Válido", "OK"),
        (status.isin("Vencido", "Não Assinado"), "Sem Uso"),
    ]
    return t.submission_fx.select("event_id", last_match(branches, "Não informado").alias("state"))


@query(
    "prefix_exclude",
    "SELECT plant_id FROM review_fx WHERE NOT coalesce(starts_with(justification_new, 'Analisar'), false)",
)
def _(t):
    starts = F.startswith(F.col("justification_new"), F.lit("Analisar"))
    return t.review_fx.filter(~F.coalesce(starts, F.lit(False))).select("plant_id")


@query(
    "schema_mapping",
    "SELECT o_orderkey AS plant_id, o_totalprice AS power FROM orders",
)
def _(t):
    pairs = t.region.selectExpr(
        "CASE r_regionkey WHEN 0 THEN 'o_orderkey' WHEN 1 THEN 'o_totalprice' WHEN 2 THEN 'absent' END AS old",
        "CASE r_regionkey WHEN 0 THEN 'plant_id' WHEN 1 THEN 'power' WHEN 2 THEN 'none' END AS new",
    )
    return mapping.apply_mapping(t.orders, mapping.read_mapping(pairs, "old", "new", t.orders.columns))


# --- joins --------------------------------------------------------------------


@query(
    "left_enrich",
    """SELECT u.plant_id, u.unit_no, p.gen_type, p.market FROM reg_unit_fx u
       LEFT JOIN plant_fx p ON u.plant_id = p.plant_id""",
)
def _(t):
    plants = t.plant_fx.select("plant_id", "gen_type", "market")
    return t.reg_unit_fx.select("plant_id", "unit_no").join(plants, "plant_id", "left")


@query(
    "composite_enrich",
    """SELECT u.plant_id, u.unit_no, r.expected_commercial FROM reg_unit_fx u LEFT JOIN unit_report_fx r
        ON u.plant_id IS NOT DISTINCT FROM r.plant_id AND u.unit_no IS NOT DISTINCT FROM r.unit_no""",
)
def _(t):
    reports = t.unit_report_fx.drop("sent_at")
    return joins.null_safe_join(
        t.reg_unit_fx.select("plant_id", "unit_no"), reports, ["plant_id", "unit_no"], "left"
    )


steps(
    type_means="""SELECT gen_type, avg(commercial_date - test_date) AS test_days FROM unit_fx GROUP BY gen_type""",
)


@query(
    "inner_segment",
    """SELECT p.plant_id, p.gen_type, round(m.test_days, 4) AS test_days
       FROM plant_fx p JOIN type_means m ON p.gen_type = m.gen_type""",
)
def _(t):
    span = dates.days_between(F.col("commercial_date"), F.col("test_date"))
    means = SmallTable(t.unit_fx.groupBy("gen_type").agg(F.avg(span).alias("test_days")))
    rows = means.join(t.plant_fx.select("plant_id", "gen_type"), ["gen_type"], "inner")
    return rows.withColumn("test_days", F.round("test_days", 4))


@query(
    "full_reconcile",
    """SELECT coalesce(u.plant_id, r.plant_id) AS plant_id, coalesce(u.unit_no, r.unit_no) AS unit_no,
        u.plant_id IS NOT NULL AS in_registry, r.plant_id IS NOT NULL AS in_report
       FROM reg_unit_fx u FULL JOIN unit_report_fx r
        ON u.plant_id = r.plant_id AND u.unit_no = r.unit_no""",
)
def _(t):
    key = ["plant_id", "unit_no"]
    registry = t.reg_unit_fx.select(*key)
    return joins.reconcile(
        registry, t.unit_report_fx.select(*key), key, "in_registry", "in_report"
    )


@query(
    "missing_units",
    """SELECT DISTINCT plant_id FROM reg_unit_fx u WHERE NOT EXISTS
        (SELECT 1 FROM unit_report_fx r WHERE r.plant_id = u.plant_id AND r.unit_no = u.unit_no)""",
)
def _(t):
    absent = joins.missing_from(
        t.reg_unit_fx.select("plant_id", "unit_no"), t.unit_report_fx, ["plant_id", "unit_no"]
    )
    return absent.select("plant_id").distinct()


@query(
    "semi_open_plants",
    """SELECT plant_id, gen_type FROM plant_fx WHERE plant_id IN
        (SELECT plant_id FROM reg_unit_fx WHERE commercial_date IS NULL)""",
)
def _(t):
    open_units = t.reg_unit_fx.filter("commercial_date IS NULL").select("plant_id")
    return t.plant_fx.select("plant_id", "gen_type").join(open_units, "plant_id", "left_semi")


@query(
    "natural_join",
    """SELECT p.plant_id, p.gen_type, p.market, u.unit_no FROM plant_fx p JOIN unit_fx u
        ON p.plant_id = u.plant_id AND p.gen_type IS NOT DISTINCT FROM u.gen_type
        AND p.market IS NOT DISTINCT FROM u.market""",
)
def _(t):
    return joins.natural_join(
        t.plant_fx.select("plant_id", "gen_type", "market"),
        t.unit_fx.select("plant_id", "gen_type", "market", "unit_no"),
    )


@query(
    "right_join",
    """SELECT r.plant_id, r.reviewer, p.monitored_at FROM plant_fx p
       RIGHT JOIN review_fx r ON p.plant_id = r.plant_id""",
)
def _(t):
    return t.plant_fx.select("plant_id", "monitored_at").join(
        t.review_fx.select("plant_id", "reviewer"), "plant_id", "right"
    )


@query(
    "registry_outer_join",
    """SELECT coalesce(u.plant_id, p.plant_id) AS plant_id, u.n, p.market FROM
        (SELECT plant_id, count(*) AS n FROM reg_unit_fx GROUP BY plant_id) u
        FULL JOIN plant_fx p ON u.plant_id = p.plant_id""",
)
def _(t):
    units = t.reg_unit_fx.groupBy("plant_id").agg(F.count("*").alias("n"))
    return joins.full_join(units, t.plant_fx.select("plant_id", "market"), ["plant_id"])


@query(
    "unique_key_check",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(t):
    return joins.key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dictionary_lookup",
    """SELECT r.plant_id, r.reviewer, e.contract_status FROM review_fx r LEFT JOIN
        (SELECT plant_id, contract_status FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY event_id DESC) AS rn
         FROM submission_fx) WHERE rn = 1) e ON r.plant_id = e.plant_id""",
)
def _(t):
    rows = t.review_fx.select("plant_id", "reviewer")
    return joins.lookup(rows, t.submission_fx, "plant_id", "contract_status", "event_id")


@query(
    "redo_subset",
    "SELECT s.plant_id, p.gen_type FROM selected_fx s LEFT JOIN plant_fx p ON s.plant_id = p.plant_id",
)
def _(t):
    return joins.restrict_to(t.selected_fx, t.plant_fx.select("plant_id", "gen_type"), "plant_id")


# --- aggregates ---------------------------------------------------------------


@query(
    "pick_latest",
    """SELECT plant_id, sent_at, seq, ep, private_sale_date FROM (SELECT *, row_number() OVER
        (PARTITION BY plant_id ORDER BY sent_at DESC, seq DESC, ep DESC) AS rn FROM contract_fx) WHERE rn = 1""",
)
def _(t):
    return pick.pick_row(t.contract_fx, ["plant_id"], "sent_at", ["seq", "ep"])


@query(
    "pick_first_unit",
    """SELECT plant_id, commercial_date, unit_no, ep FROM (SELECT *, row_number() OVER
        (PARTITION BY plant_id ORDER BY commercial_date, unit_no, ep) AS rn FROM unit_fx) WHERE rn = 1""",
)
def _(t):
    rows = t.unit_fx.select("plant_id", "commercial_date", "unit_no", "ep")
    return pick.pick_row(rows, ["plant_id"], "commercial_date", ["unit_no", "ep"], largest=False)


@query(
    "plant_date_max",
    """SELECT plant_id, max(planned_commercial) AS planned_max, max(granted_commercial) AS granted_max,
        max(test_date) AS test_max FROM reg_unit_fx GROUP BY plant_id""",
)
def _(t):
    return agg.group_max(
        t.reg_unit_fx,
        "plant_id",
        {"planned_commercial": "planned_max", "granted_commercial": "granted_max", "test_date": "test_max"},
    )


@query(
    "plant_any_flag",
    """SELECT plant_id, bool_or(coalesce(planned_commercial < DATE '2000-07-01', false)) AS past,
        bool_or(test_date IS NOT NULL) AS testing FROM reg_unit_fx GROUP BY plant_id""",
)
def _(t):
    flags = {
        "past": F.col("planned_commercial") < dates.day(dt.date(2000, 7, 1)),
        "testing": F.col("test_date").isNotNull(),
    }
    return agg.group_any(t.reg_unit_fx, "plant_id", flags)


@query(
    "collapse_units",
    """SELECT gen_type, market, obligation_date, CAST(count(unit_mw) AS BIGINT) AS unit_count,
        coalesce(sum(unit_mw), 0.0) AS total_power FROM unit_fx GROUP BY gen_type, market, obligation_date""",
)
def _(t):
    return agg.collapse_units(
        t.unit_fx.select("gen_type", "market", "obligation_date", "unit_mw"), "unit_mw"
    )


@query(
    "conservation",
    """SELECT CAST((SELECT count(unit_mw) FROM unit_fx) - sum(n) AS BIGINT) AS unit_diff,
        abs(round((SELECT sum(unit_mw) FROM unit_fx) - sum(p), 4)) AS power_diff FROM
        (SELECT count(unit_mw) AS n, sum(unit_mw) AS p FROM unit_fx GROUP BY gen_type, market, obligation_date)""",
)
def _(t):
    units = t.unit_fx.select("gen_type", "market", "obligation_date", "unit_mw")
    gap = agg.conservation(units, agg.collapse_units(units, "unit_mw"), "unit_mw")
    return gap.withColumn("power_diff", F.abs(F.round("power_diff", 4)))


steps(
    registry_sold="""SELECT p.plant_id, p.market, a.supply_date FROM plant_fx p JOIN
 (SELECT plant_id, min(supply_date) AS supply_date FROM auction_fx GROUP BY plant_id) a ON p.plant_id = a.plant_id""",
    registry_collapsed="""SELECT plant_id, granted_commercial, commercial_date, CAST(count(unit_mw) AS BIGINT) AS unit_count,
 coalesce(sum(unit_mw), 0.0) AS total_power FROM reg_unit_fx GROUP BY plant_id, granted_commercial, commercial_date""",
    registry_history="""SELECT coalesce(u.plant_id, p.plant_id) AS plant_id, granted_commercial, commercial_date, unit_count, total_power,
 market, supply_date, CASE WHEN market = 'ACR' THEN supply_date ELSE granted_commercial END AS obligation_date
 FROM registry_collapsed u FULL JOIN registry_sold p ON u.plant_id = p.plant_id""",
    legacy_typed="""SELECT l_orderkey AS plant_id, CASE WHEN l_discount < 0.05 THEN CAST(l_shipdate AS DATE) END AS commercial_date,
 concat('0', CAST(l_linenumber AS STRING), ' a ', CAST(l_linenumber + CAST(floor(l_quantity / 10) AS INT) AS STRING)) AS unit_list,
 CASE WHEN l_linenumber < 3 THEN CAST(l_shipdate AS DATE) - 10 WHEN l_linenumber < 5 THEN CAST(l_shipdate AS DATE) - 20 END AS assembly_date,
 l_quantity AS unit_mw, l_linenumber, l_quantity, o_orderstatus AS gen_type FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    legacy_history="""SELECT plant_id, commercial_date, assembly_date, gen_type, CAST(sum(greatest(CAST(floor(l_quantity / 10) AS INT) + 1, 2)) AS BIGINT) AS unit_count,
 coalesce(sum(unit_mw), 0.0) AS total_power FROM legacy_typed GROUP BY plant_id, commercial_date, assembly_date, gen_type""",
)


@query("registry_history", "SELECT * FROM registry_history")
def _(t):
    units = t.reg_unit_fx.select("plant_id", "granted_commercial", "commercial_date", "unit_mw")
    return registry_history(units, t.plant_fx.select("plant_id", "market"), t.auction_fx)


def _legacy(t):
    ship = F.col("l_shipdate").cast("date")
    quantity = F.floor(F.col("l_quantity") / 10).cast("int")
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("Idempreendimento"),
        F.concat(
            F.lit("0"), F.col("l_linenumber"), F.lit(" a "), F.col("l_linenumber") + quantity
        ).alias("Num_UG"),
        F.col("l_quantity").cast("string").alias("Pot_UG"),
        F.when(F.col("l_discount") < 0.05, ship).alias("OpCom_R_UG"),
        F.when(F.col("l_linenumber") < 3, F.date_sub(ship, 10)).alias("Montagem_Real"),
        F.when(F.col("l_linenumber") < 5, F.date_sub(ship, 20)).alias("Torres_Real"),
    )


def _types(t):
    return t.orders.select(
        F.col("o_orderkey").alias("plant_id"),
        F.col("o_orderstatus").alias("gen_type"),
        F.col("o_custkey").alias("entry_no"),
    )


@query("legacy_history", "SELECT * FROM legacy_history")
def _(t):
    return legacy_history(_legacy(t), _types(t))


@query(
    "union_origin",
    """SELECT 'legacy' AS origin, plant_id, commercial_date, unit_count, total_power, gen_type, assembly_date,
        NULL AS granted_commercial, NULL AS market, NULL AS supply_date, NULL AS obligation_date FROM legacy_history
       UNION ALL SELECT 'registry', plant_id, commercial_date, unit_count, total_power, NULL, NULL,
        granted_commercial, market, supply_date, obligation_date FROM registry_history""",
)
def _(t):
    units = t.reg_unit_fx.select("plant_id", "granted_commercial", "commercial_date", "unit_mw")
    registry = registry_history(units, t.plant_fx.select("plant_id", "market"), t.auction_fx)
    return setops.union_with_origin({"legacy": legacy_history(_legacy(t), _types(t)), "registry": registry})


@query(
    "training_obligation",
    """SELECT p.plant_id, CASE WHEN market = 'ACR' THEN supply_date ELSE granted_start END AS obligation_date
       FROM plant_fx p LEFT JOIN (SELECT plant_id, min(supply_date) AS supply_date FROM auction_fx GROUP BY plant_id) a
       ON p.plant_id = a.plant_id""",
)
def _(t):
    rows = t.plant_fx.join(first_supply(t.auction_fx), "plant_id", "left")
    due = training_obligation(F.col("market"), F.col("supply_date"), F.col("granted_start"))
    return rows.select("plant_id", due.alias("obligation_date"))


_BOUNDS = """SELECT gen_type, market, avg(unit_mw) AS m, stddev_samp(unit_mw) AS s FROM unit_fx GROUP BY gen_type, market"""


@query(
    "group_summary",
    f"""WITH b AS ({_BOUNDS}), d AS (SELECT u.gen_type, u.market, u.commercial_date,
        CASE WHEN NOT coalesce(u.unit_mw > b.m + 1.1 * b.s OR u.unit_mw < b.m - 1.1 * b.s, false) THEN u.unit_mw END AS unit_mw
        FROM unit_fx u LEFT JOIN b ON u.gen_type = b.gen_type AND u.market = b.market),
       g AS (SELECT * FROM (SELECT DISTINCT gen_type FROM unit_fx WHERE gen_type IS NOT NULL),
        (SELECT DISTINCT market FROM unit_fx WHERE market IS NOT NULL))
       SELECT g.gen_type, g.market, min(unit_mw) AS unit_mw_min, max(unit_mw) AS unit_mw_max,
        round(avg(unit_mw), 4) AS unit_mw_mean, round(stddev_samp(unit_mw), 4) AS unit_mw_std, count(unit_mw) AS unit_mw_count,
        CAST(min(commercial_date - DATE '1970-01-01') AS DOUBLE) AS commercial_date_min,
        CAST(max(commercial_date - DATE '1970-01-01') AS DOUBLE) AS commercial_date_max,
        round(avg(commercial_date - DATE '1970-01-01'), 4) AS commercial_date_mean,
        round(stddev_samp(commercial_date - DATE '1970-01-01'), 4) AS commercial_date_std,
        count(commercial_date) AS commercial_date_count
       FROM g LEFT JOIN d ON g.gen_type = d.gen_type AND g.market = d.market GROUP BY g.gen_type, g.market""",
)
def _(t):
    rows = agg.group_summary(
        t.unit_fx,
        ["gen_type", "market"],
        ["unit_mw", "commercial_date"],
        ["min", "max", "mean", "std", "count"],
        z=1.1,
    )
    floats = [c for c in rows.columns if c.endswith(("_mean", "_std"))]
    return rows.withColumns({c: F.round(c, 4) for c in floats})


@query(
    "inconsistent_keys",
    """SELECT plant_id, count(DISTINCT contract_status) AS n FROM submission_fx GROUP BY plant_id
       HAVING count(DISTINCT contract_status) > 1""",
)
def _(t):
    return agg.inconsistent_keys(t.submission_fx, "plant_id", "contract_status")


@query(
    "value_counts",
    "SELECT works_status, market, plant_monitored, count(*) AS n FROM plant_fx GROUP BY ALL",
)
def _(t):
    return agg.value_counts(t.plant_fx, ["works_status", "market", "plant_monitored"])


@query("group_row_count", "SELECT gen_type, count(*) AS n FROM unit_fx GROUP BY gen_type")
def _(t):
    return agg.value_counts(t.unit_fx, ["gen_type"])


@query(
    "rowwise_greatest",
    """SELECT plant_id, unit_no, greatest(planned_commercial, granted_commercial, test_date) AS latest
       FROM reg_unit_fx""",
)
def _(t):
    latest = F.greatest("planned_commercial", "granted_commercial", "test_date")
    return t.reg_unit_fx.select("plant_id", "unit_no", latest.alias("latest"))


@query(
    "rowwise_any",
    """SELECT plant_id, coalesce(no_forecast = 'Sim', false) OR coalesce(works_paralysed = 'Sim', false)
        OR coalesce(works_status = 'Paralisada', false) AS flagged FROM plant_fx""",
)
def _(t):
    flagged = any_of(
        F.col("no_forecast") == "Sim",
        F.col("works_paralysed") == "Sim",
        F.col("works_status") == "Paralisada",
    )
    return t.plant_fx.select("plant_id", flagged.alias("flagged"))


# --- windows, order, sets -----------------------------------------------------


@query(
    "latest_batch",
    """SELECT plant_id, sent_at, unit_no, expected_commercial FROM
        (SELECT *, rank() OVER (PARTITION BY plant_id ORDER BY sent_at DESC) AS r FROM unit_report_fx) WHERE r = 1""",
)
def _(t):
    return pick.latest_batch(t.unit_report_fx, "plant_id", "sent_at")


@query(
    "duplicate_flag",
    "SELECT plant_id, count(*) AS n FROM unit_fx GROUP BY plant_id HAVING count(*) > 1",
)
def _(t):
    return pick.duplicated(t.unit_fx, "plant_id")


@query(
    "split_duplicate_ids",
    """SELECT plant_id, unit_no, CASE WHEN gen_type = 'UHE' AND count(*) OVER (PARTITION BY plant_id) > 1
        THEN concat(CAST(plant_id AS STRING), '_', CAST(row_number() OVER (PARTITION BY plant_id, gen_type = 'UHE'
         ORDER BY commercial_date, unit_no) - 1 AS STRING))
        ELSE CAST(plant_id AS STRING) END AS unit_key FROM unit_fx""",
)
def _(t):
    rows = t.unit_fx.select("plant_id", "unit_no", "commercial_date", "gen_type")
    keyed = pick.split_duplicate_ids(
        rows, "plant_id", ["commercial_date", "unit_no"], F.col("gen_type") == "UHE"
    )
    return keyed.select("plant_id", "unit_no", "unit_key")


@query(
    "top_differences",
    """SELECT plant_id, unit_no, commercial_date - obligation_date AS diff_days FROM unit_fx
       ORDER BY diff_days DESC, plant_id, unit_no LIMIT 20""",
)
def _(t):
    diff = F.datediff("commercial_date", "obligation_date").cast("bigint")
    rows = t.unit_fx.select("plant_id", "unit_no", diff.alias("diff_days"))
    return setops.top_rows(rows, F.col("diff_days"), 20, ["plant_id", "unit_no"])


@query(
    "seeded_sample",
    """SELECT plant_id, gen_type FROM plant_fx ORDER BY md5(concat_ws('|', CAST(plant_id AS STRING), '7')), plant_id LIMIT 10""",
)
def _(t):
    return setops.seeded_sample(t.plant_fx.select("plant_id", "gen_type"), ["plant_id"], 10, 7)


@query(
    "union_same_columns",
    "SELECT plant_id, sent_at FROM contract_fx UNION ALL SELECT plant_id, sent_at FROM unit_report_fx",
)
def _(t):
    cols = ["plant_id", "sent_at"]
    return t.contract_fx.select(*cols).unionByName(t.unit_report_fx.select(*cols))


@query("distinct_ids", "SELECT DISTINCT plant_id FROM reg_unit_fx WHERE test_date IS NOT NULL")
def _(t):
    return t.reg_unit_fx.filter("test_date IS NOT NULL").select("plant_id").distinct()


@query(
    "distinct_by_key",
    """SELECT plant_id, planned_commercial, unit_no FROM (SELECT *, row_number() OVER
        (PARTITION BY plant_id ORDER BY planned_commercial NULLS LAST, unit_no) AS rn FROM reg_unit_fx) WHERE rn = 1""",
)
def _(t):
    rows = t.reg_unit_fx.select("plant_id", "planned_commercial", "unit_no")
    return pick.pick_row(rows, ["plant_id"], "planned_commercial", ["unit_no"], largest=False, keep_unknown=True)


@query(
    "value_intersection",
    "SELECT plant_id FROM submission_fx INTERSECT SELECT plant_id FROM selected_fx",
)
def _(t):
    return setops.shared_values(t.submission_fx, t.selected_fx, "plant_id")


@query(
    "key_product",
    """SELECT g.gen_type, m.works_status FROM (SELECT DISTINCT gen_type FROM plant_fx) g,
        (SELECT DISTINCT works_status FROM plant_fx WHERE works_status IS NOT NULL) m""",
)
def _(t):
    return setops.key_product(t.plant_fx, ["gen_type", "works_status"])


# --- scalar functions ---------------------------------------------------------

@query(
    "unit_list_count",
    """SELECT plant_id, pk, mw, 2 + greatest(gap, 0) + CASE WHEN is_o THEN 1 ELSE 2 + greatest(45 - hi - 1, 0) END
        AS units, is_o AND false AS split_digits FROM (SELECT l_orderkey AS plant_id, l_partkey AS pk, l_quantity AS mw,
        l_linestatus = 'O' AS is_o, CAST(floor(l_quantity / 10) AS INT) - 1 AS gap,
        l_linenumber + CAST(floor(l_quantity / 10) AS INT) AS hi FROM lineitem)""",
)
def _(t):
    return t.legacy_fx.select(
        "plant_id",
        "pk",
        "mw",
        text.unit_count(F.col("unit_list")).alias("units"),
        text.has_split_digits(F.col("unit_list")).alias("split_digits"),
    )


@query(
    "unit_list_members",
    """SELECT plant_id, pk, mw, lst[1] AS first_unit, lst[-1] AS last_unit, len(lst) AS units FROM
        (SELECT plant_id, pk, mw, list_sort(list_concat(
          CASE WHEN b > a THEN range(a, b + 1) ELSE [a, b] END,
          CASE WHEN is_o THEN [40] ELSE range(b + 1, 45) || [45, 50] END)) AS lst FROM
        (SELECT l_orderkey AS plant_id, l_partkey AS pk, l_quantity AS mw, l_linestatus = 'O' AS is_o,
         CAST(l_linenumber AS BIGINT) AS a, CAST(l_linenumber + CAST(floor(l_quantity / 10) AS INT) AS BIGINT) AS b FROM lineitem))""",
)
def _(t):
    units = text.unit_list(F.col("unit_list"))
    return t.legacy_fx.select("plant_id", "pk", "mw", units.alias("u")).select(
        "plant_id",
        "pk",
        "mw",
        F.element_at("u", 1).alias("first_unit"),
        F.element_at("u", -1).alias("last_unit"),
        F.size("u").alias("units"),
    )


@query(
    "month_end_flags",
    """SELECT plant_id, last_day(planned_start) AS month_last,
        coalesce(planned_start < TIMESTAMP '2000-06-30 23:59:59', false) AS due,
        CAST(last_day(planned_start) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS month_end FROM plant_fx""",
)
def _(t):
    due = F.coalesce(F.col("planned_start") < dates.month_end(AS_OF), F.lit(False))
    return t.plant_fx.select(
        "plant_id",
        F.last_day("planned_start").alias("month_last"),
        due.alias("due"),
        dates.month_end_of(F.col("planned_start")).alias("month_end"),
    )


@query(
    "class_substring",
    """SELECT plant_id, substr(class_text, 5, 2) AS plant_class, substr(class_text, 1, length(class_text) - 3) AS stem
       FROM plant_fx""",
)
def _(t):
    col = F.col("class_text")
    return t.plant_fx.select(
        "plant_id", text.class_code(col).alias("plant_class"), text.drop_suffix(col, 3).alias("stem")
    )


@query(
    "date_arithmetic",
    """SELECT event_id, date_trunc('day', sent_at) AS midnight, CAST(floor(epoch(sent_at - TIMESTAMP '2024-01-15 12:00:00') / 86400.0) AS BIGINT) AS whole_days,
        abs(CAST(sent_at AS DATE) - valid_until) > 60 AS far, strftime(sent_at, '%d/%m/%Y, %H:%M:%S') AS label FROM submission_fx""",
)
def _(t):
    anchor = F.lit(dt.datetime(2024, 1, 15, 12)).cast("timestamp_ntz")
    sent = F.col("sent_at")
    return t.submission_fx.select(
        "event_id",
        dates.midnight(sent).alias("midnight"),
        dates.whole_days(sent, anchor).alias("whole_days"),
        (F.abs(F.datediff(sent, F.col("valid_until"))) > 60).alias("far"),
        text.stamp_text(sent).alias("label"),
    )


@query(
    "normal_cdf_indicator",
    """SELECT plant_id, unit_no, ep, round(0.5 * (1 + sign(z) * (1 - ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t
        - 0.284496736) * t + 0.254829592) * t * exp(-(abs(z) / sqrt(2.0)) * (abs(z) / sqrt(2.0))))), 6) AS p
       FROM (SELECT plant_id, unit_no, ep, z, 1 / (1 + 0.3275911 * abs(z) / sqrt(2.0)) AS t
        FROM (SELECT plant_id, unit_no, ep, (unit_mw - 25) / 10 AS z FROM unit_fx))""",
)
def _(t):
    z = (F.col("unit_mw") - 25) / 10
    return t.unit_fx.select("plant_id", "unit_no", "ep", F.round(stats.normal_cdf(z), 6).alias("p"))


@query(
    "decode_escapes",
    """SELECT p_partkey, p_name || CASE p_partkey % 6 WHEN 0 THEN ' ' WHEN 1 THEN '(' WHEN 2 THEN ')' WHEN 3 THEN '/'
        WHEN 4 THEN '=' ELSE ',' END || p_type || ' x0020_ ' AS label FROM part""",
)
def _(t):
    codes = ["_x0020_", "_x0028_", "_x0029_", "_x002F_", "_x003D_", "_x002C_"]
    code = F.element_at(F.array(*map(F.lit, codes)), (F.col("p_partkey") % 6 + 1).cast("int"))
    spaced = F.concat(F.replace("p_name", F.lit(" "), F.lit("_x0020_")), code, F.replace("p_type", F.lit(" "), F.lit("_x0020_")))
    return t.part.select("p_partkey", text.decode_escapes(F.concat(spaced, F.lit(" x0020_ "))).alias("label"))


@query(
    "split_digits",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linenumber % 4 IN (0, 1) AS split FROM lineitem""",
)
def _(t):
    gaps = F.array(*map(F.lit, ["  ", " ", ", ", " a "]))
    gap = F.element_at(gaps, (F.col("l_linenumber") % 4 + 1).cast("int"))
    units = F.concat(F.lit("0"), F.col("l_linenumber").cast("string"), gap, F.col("l_partkey").cast("string"))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", text.has_split_digits(units).alias("split"))


@query(
    "reading_texts",
    """SELECT event_id, CAST(event_id % 400 // 2 AS VARCHAR) || CASE WHEN event_id % 2 = 1 THEN '.5 %' ELSE '.0 %' END AS share,
        strftime(ts, '%d/%m/%Y, %H:%M:%S') AS stamp FROM events""",
)
def _(t):
    share = (F.col("event_id") % 400) / 2
    return t.events.select("event_id", text.percent_text(share).alias("share"), text.stamp_text(F.col("ts")).alias("stamp"))


@query(
    "rounding",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, round_even(l_quantity / 4, 1) AS quarter FROM lineitem",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        F.bround(F.col("l_quantity") / 4, 1).alias("quarter"),
    )
