"""Parquet results, csv lanes and report tables under their business names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.session import held

# Column of the plans -> heading of the exported files.
BUSINESS_NAMES = {
    "plant_id": "IdeUsinaOutorga",
    "plant_name": "NomUsina",
    "gen_type": "SigTipoGeracao",
    "unit_no": "NumUgUsina",
    "reviewer": "Fiscal",
    "planned_commercial_max": "PrevOC_Atual",
    "any_manual_date": "PrevOCMmanual",
    "date_past": "RevisarOC",
    "in_test": "EmTeste",
    "stale": "MuitoTempoSemMonitorar",
    "phase_max": "Fase Atual",
    "official_date": "PrevisaoOC_regra",
    "official_date_lead": "PrevisaoOC_regra",
    "justification_new": "Justificativadaprevisao_new",
    "criterion_pmo_max": "CriterioNovoPMO",
    "criterion_text": "DscCriterioPrevisao",
    "obligation_date": "OC_Obrigacao",
    "justification": "DscJustificativaPrevisaoAtual",
    "forecast": "Calculo OC",
    "to_ratify": "Homologar Marcos",
    "ratify_list": "Marcos a Homologar",
    "manual": "Manual",
    "expected_commercial_max": "Previsão do agente max",
    "forecast_max": "Calculada max",
    "obligation_date_max": "Obrigação max",
    "official_source": "EscolhaRegraPMO",
    "review_start": "Revisar IO",
    "planned_start": "prev_IO_SFG",
    "reported_planned_start": "prev_IO_rapeel",
    "granted_start": "DatInicioObraOutorgado",
    "monitored_at": "DatMonitoramento",
    "sent_at": "DthEnvio",
}

# Reports of each result table.
REPORTS_OF = {
    "units": ["lane_1"],
    "plants": ["lane_2a", "review_list", "redo_list"],
    "review": ["todo", "check_start"],
    "justifications": ["check_justification"],
    "dates": ["check_dates"],
    "coefficients": ["coefficients"],
    "training": ["training_rows"],
    "backcast": ["test_forecasts"],
    "rejects": ["order_rejects"],
    "history": ["public_data"],
    "forecasts": ["forecast"],
    "quarantine": ["quarantine"],
}

# Rows and columns of each report.
REPORTS = {
    "lane_1": (
        "lane_1",
        ["plant_id", "unit_no", "official_date", "justification_new", "criterion_text"],
    ),
    "lane_2a": (
        "lane_2a",
        ["plant_id", "granted_start", "reported_planned_start", "planned_start"],
    ),
    "review_list": (
        "lane_2b OR lane_3",
        [
            "plant_id", "gen_type", "plant_name", "manual", "official_date_lead",
            "justification_new", "official_source", "criterion_pmo_max", "criterion_text",
            "ratify_list", "to_ratify", "review_start", "date_past", "in_test", "stale",
            "any_manual_date", "phase_max", "expected_commercial_max", "forecast_max",
            "obligation_date_max", "planned_start", "reported_planned_start", "granted_start",
            "planned_commercial_max", "monitored_at", "sent_at",
        ],
    ),
    "redo_list": ("lane_2a OR lane_2b", ["plant_id"]),
    "todo": ("NOT done", ["plant_id", "plant_name", "reviewer", "monitored_at"]),
    "check_start": (
        "check_start AND done",
        [
            "plant_id", "plant_name", "planned_start", "granted_start",
            "reported_planned_start", "reviewer", "monitored_at",
        ],
    ),
    "check_justification": (
        "true",
        ["plant_id", "justification_new", "justification", "reviewer"],
    ),
    "check_dates": (
        "true",
        ["plant_id", "monitored_at", "unit_no", "planned_commercial", "rule_date", "reviewer"],
    ),
    "coefficients": (
        "true",
        [
            "gen_type", "phase", "level", "n", "mean_days", "std_days", "a", "b", "r",
            "mean_delay", "std_delay",
        ],
    ),
    "training_rows": (
        "true",
        [
            "unit_key", "plant_id", "gen_type", "market", "phase", "level", "is_train", "outlier",
            "obligation_date", "commercial_date", "milestone_date", "days", "milestone_delay", "delay",
        ],
    ),
    "test_forecasts": (
        "NOT is_train AND level = 'Ambos'",
        [
            "unit_key", "plant_id", "gen_type", "market", "phase", "obligation_date",
            "commercial_date", "forecast", "forecast_error",
        ],
    ),
    "order_rejects": ("true", ["plant_id", "gen_type", "reject_reason"]),
    "forecast": (
        "true",
        [
            "plant_name", "plant_id", "unit_no", "gen_type", "forecast", "obligation_date",
            "monitored_at", "phase", "probability", "over_30_days", "planned_start", "granted_start",
        ],
    ),
    "quarantine": (
        "true",
        ["plant_id", "plant_name", "unit_no", "gen_type", "market", "granted_commercial"],
    ),
    "public_data": (
        "true",
        [
            "plant_id", "gen_type", "market", "start_date", "concrete_date", "assembly_date",
            "test_date", "commercial_date", "obligation_date",
        ],
    ),
}


def report(df: DataFrame, name: str) -> DataFrame:
    """Rows and columns of a report under their business names."""
    condition, columns = REPORTS[name]
    return df.filter(condition).select(
        *[F.col(c).alias(BUSINESS_NAMES.get(c, c)) for c in columns]
    )


def export_report(df: DataFrame, name: str, folder: str) -> None:
    """Write a report as csv part files with a heading."""
    report(df, name).write.mode("overwrite").csv(f"{folder}/{name}", header=True)


def reported_columns(table: str) -> list[str]:
    """What the reports of a result table show; a table written for them alone holds no more."""
    return list(dict.fromkeys(c for name in REPORTS_OF[table] for c in REPORTS[name][1]))


_STAMP = "yyyy-MM-dd HH:mm:ss"


def _flat(df: DataFrame) -> DataFrame:
    """Lists are joined to one text; other values stay."""
    lists = [c for c, kind in df.dtypes if kind.startswith("array")]
    return df.withColumns({c: F.array_join(F.col(f"`{c}`").cast("array<string>"), ", ") for c in lists})


def export_reports(
    tables: dict[str, DataFrame], folder: str, parts: int | None = None, compression: str | None = None
) -> None:
    """Write all reports of all tables as csv files below ``report=<name>``.

    Each file begins with the heading, so a file is a csv table of its own and a folder reads as
    one; a report without rows is one file with the heading alone. Every task writes the rows it
    has read, so no report is shuffled, sorted or held, however long. With ``parts`` its rows
    are dealt over that many files, which costs a shuffle. ``compression`` as Spark's csv files
    know it, ``gzip`` for one.
    """
    for table, df in tables.items():
        for name in REPORTS_OF[table]:
            rows = _flat(report(df, name))
            rows = rows.repartition(parts) if parts else rows
            stamps = {"timestampFormat": _STAMP, "timestampNTZFormat": _STAMP}
            with held(df.sparkSession):
                rows.write.mode("overwrite").options(**stamps).csv(
                    f"{folder}/report={name}", header=True, compression=compression
                )


def report_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each report that ``export_reports`` wrote: lines less a heading in each file."""
    lines = spark.read.text(folder).groupBy("report", F.col("_metadata.file_path").alias("file"))
    return lines.agg((F.count("*") - 1).alias("n")).groupBy("report").agg(F.sum("n").alias("n"))


def read_report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A report that ``export_reports`` wrote, all columns as text."""
    return spark.read.csv(f"{folder}/report={name}", header=True)


def write_table(df: DataFrame, path: str, cluster_by: str | None = None) -> None:
    """Parquet sink with millisecond times. Sorting files by the key lets scans skip them."""
    stamps = [c for c, t in df.dtypes if t.startswith("timestamp")]
    rounded = df.withColumns({c: F.date_trunc("millisecond", F.col(c)) for c in stamps})
    if cluster_by:
        rounded = rounded.sortWithinPartitions(cluster_by)
    rounded.write.mode("overwrite").parquet(path)
