from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from milepost.sources import catalog, files, manifest, sinks, splits, views


def empty_view(spark, name):
    """One row of the view with every column as text, dates readable."""
    cols = [
        F.lit("2024-03-01").alias(c)
        if c.startswith("Dat")
        else F.lit("1.5" if c.startswith("Mda") else "7").alias(c)
        for c in catalog.VIEWS[name]
    ]
    return spark.range(1).select(*cols)


def test_view_columns_are_distinct():
    for name, columns in catalog.VIEWS.items():
        assert len(columns) == len(set(columns)), name
    for view, names in catalog.SNAPSHOT_TABLES.values():
        assert set(names) <= set(catalog.VIEWS[view])


def test_prefix_types(spark):
    raw = spark.createDataFrame([("9", "1.5", "nonsense", "x")], ["IdeA", "MdaB", "DatC", "NomD"])
    typed = views.apply_prefix_types(raw)
    assert typed.dtypes == [
        ("IdeA", "bigint"), ("MdaB", "double"), ("DatC", "timestamp_ntz"), ("NomD", "string"),
    ]
    assert tuple(typed.first()) == (9, 1.5, None, "x")


def test_strict_dates(spark):
    raw = spark.createDataFrame([("2024-01-05", "05/01/2024")], ["DatA", "DatB"])
    assert tuple(views.coerce_dates(raw).first()) == (dt.date(2024, 1, 5), None)


def test_snapshot_round_trip(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "snap")
    names = [view for view, _ in catalog.SNAPSHOT_TABLES.values()]
    for name in names:
        empty_view(spark, name).write.parquet(f"{source}/{name}")
    views.take_snapshot(spark, names, target, dt.datetime(2024, 3, 2), location=source)
    listed = manifest.read_manifest(spark, target)
    assert manifest.snapshot_complete(listed, names)
    assert not manifest.snapshot_complete(listed, [*names, "other"])
    assert {r.label for r in manifest.snapshot_label(listed).collect()} == {"2024_03_02_00_00"}

    ids = tmp_path / "ids.txt"
    ids.write_text("7,\n8,\n 9")
    snap = views.read_snapshot(spark, target, str(ids))
    assert sorted(r.plant_id for r in snap.selected.collect()) == [7, 8, 9]
    row = snap.units.first()
    assert row.plant_id == 7 and row.unit_mw == 1.5
    assert row.test_date == dt.datetime(2024, 3, 1)


def test_ingest_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (tmp_path / "b.json").write_text('{"name": "z", "id": 3, "more": 1}\n')
    (tmp_path / "c.csv").write_text("name,id\nw,2\n")
    a, b, c = (str(tmp_path / n) for n in ("a.csv", "b.json", "c.csv"))
    copies = str(tmp_path / "copies")
    df = files.ingest_files(spark, [a, b], parquet_dir=copies, unique_across=["id"])
    assert sorted((r.id, r.name) for r in df.collect()) == [(1, "x"), (2, "y"), (3, "z")]
    (tmp_path / "a.csv").write_text("id,name\n9,changed\n")
    again = files.ingest_files(spark, [a, b], parquet_dir=copies)
    assert not again.filter("id = 9").isEmpty() and again.count() == 2
    fresh = files.ingest_files(spark, [a, b], parquet_dir=copies, refresh=True)
    assert not fresh.filter("id = 9").isEmpty()
    (tmp_path / "a.csv").write_text("id,name\n2,y\n")
    with pytest.raises(ValueError, match="more than one file"):
        files.ingest_files(spark, [a, c], unique_across=["id"])
    with pytest.raises(ValueError, match="unsupported"):
        files.ingest_files(spark, ["x.xlsx"])


def test_only_changed_files_are_read_again(spark, tmp_path):
    paths = []
    for name, text in {"a.csv": "id,name\n1,x\n", "b b.csv": "name,id\ny,2\n", "empty.csv": "id,name\n", "d.json": '{"id": 4, "name": "w"}\n'}.items():
        (tmp_path / name).write_text(text)
        paths.append(str(tmp_path / name))
    copies = str(tmp_path / "copies")
    read = lambda: files.ingest_files(spark, paths, parquet_dir=copies, schema="id long, name string")
    assert sorted((r.id, r.name, r.source_file) for r in read().collect()) == [(1, "x", paths[0]), (2, "y", paths[1]), (4, "w", paths[3])]
    runs = lambda: len(list((tmp_path / "copies").glob("run-*")))
    assert runs() == 1 and len(read().collect()) == 3 and runs() == 1
    (tmp_path / "b b.csv").write_text("name,id\nz,3\n")
    assert sorted((r.id, r.name) for r in read().collect()) == [(1, "x"), (3, "z"), (4, "w")] and runs() == 2
    second = list((tmp_path / "copies").glob("run-*/source_state=*"))
    assert len(second) == 4  # three files with rows, then one of them again
    # A run that stops before its entry is written leaves nothing that is read.
    (tmp_path / "copies" / "run-lost").mkdir()
    assert len(read().collect()) == 3


def test_failed_copy_leaves_the_snapshot(spark, tmp_path):
    folder = str(tmp_path / "snap")
    good = {"a": spark.range(5), "b": spark.range(7)}
    assert manifest.commit_tables(spark, good, folder, dt.datetime(2024, 1, 1)) == 1
    broken = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        manifest.commit_tables(spark, {"a": spark.range(50), "b": broken}, folder, dt.datetime(2024, 1, 2))
    tables = manifest.read_tables(spark, folder)
    assert tables["a"].count() == 5 and tables["b"].count() == 7
    assert manifest.commit_tables(spark, {"b": spark.range(0)}, folder, dt.datetime(2024, 1, 3)) == 2
    rows = {r.table_name: (r.generation, r.n_rows, r.loaded_at.day) for r in manifest.read_manifest(spark, folder).collect()}
    assert rows == {"a": (2, 5, 1), "b": (2, 0, 3)}
    # Readers pinned before keep what they had.
    assert tables["b"].count() == 7 and manifest.read_tables(spark, folder, 1)["b"].count() == 7
    assert manifest.read_tables(spark, folder)["b"].count() == 0
    with pytest.raises(ValueError):
        manifest.read_tables(spark, folder, 9)
    with pytest.raises(ValueError):
        manifest.read_tables(spark, str(tmp_path / "none"))


def takes(predicate, key):
    """Whether a planned predicate takes a key."""
    if key is None:
        return predicate.endswith("IS NULL")
    tests = {">=": key.__ge__, "<": key.__lt__}
    words = [p.split() for p in predicate.split(" AND ")]
    return all(w[1:] == ["IS", "NOT", "NULL"] or (w[1] in tests and tests[w[1]](int(w[2]))) for w in words)


@pytest.mark.parametrize("parts", [1, 3, 8])
@pytest.mark.parametrize(
    "counts",
    [
        [(0, 10)],
        [(None, 4)],
        [],
        [(k * 10, 5) for k in range(40)],
        [(None, 9), (0, 1), (10, 1000), (20, 1), (30, 1), (40, 300)],
        [(-50, 7), (-40, 0), (-30, 900), (0, 3)],
    ],
)
def test_split_plans_cover_every_key_once(counts, parts):
    predicates = splits.split_predicates(counts, "k", parts)
    assert len(predicates) <= parts + 1
    for key in [None, -(10**9), 10**9, *(k + d for k, _ in counts if k is not None for d in (-1, 0, 1))]:
        assert sum(takes(p, key) for p in predicates) == 1
    known = [(k, n) for k, n in counts if k is not None]
    if known:
        largest = max(n for _, n in known)
        loads = [sum(n for k, n in known if takes(p, k)) for p in predicates]
        assert max(loads) <= sum(n for _, n in known) / parts + largest
    with pytest.raises(ValueError):
        splits.split_predicates(counts, "k", 0)


def test_key_counts(spark):
    df = spark.createDataFrame([(None,), (5,), (5,), (9,), (100,)], "k long")
    assert splits.key_counts(df, "k", 8) == [(None, 1), (5, 3), (89, 1)] or sum(n for _, n in splits.key_counts(df, "k", 8)) == 5
    assert splits.key_counts(df.filter("k IS NULL"), "k") == [(None, 1)]
    assert splits.key_counts(df.limit(0), "k") == [(None, 0)]


def test_counting_queries_agree_with_the_frame(spark):
    """The texts that go to a database, answered by one inside this process."""
    keys = [None, None, -7, 0, 0, 3, 50, 51, 52, 1000]
    con = duckdb.connect()
    con.execute("CREATE TABLE v (k BIGINT)")
    con.executemany("INSERT INTO v VALUES (?)", [(k,) for k in keys])
    low, high, n = con.execute(splits.bounds_query("v", "k")).fetchone()
    assert (low, high, n) == (-7, 1000, len(keys))
    width = splits.range_width(low, high, 16)
    found = splits.counts_of(con.execute(splits.counts_query("v", "k", low, width)).fetchall(), low, width)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert found == splits.key_counts(df, "k", 16) and found[0] == (None, 2)
    predicates = splits.split_predicates(found, "k", 3)
    parts = [con.execute(f"SELECT count(*) FROM v WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(parts) == len(keys)


def test_id_lists_do_not_lose_entries(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("7, 8,\n x9, 10")
    with pytest.raises(ValueError, match="x9"):
        files.read_id_list(spark, str(tmp_path / "ids.txt"))


def test_reports_of_one_job(spark, tmp_path):
    plants = spark.createDataFrame(
        [(1, True, False), (2, True, True), (3, False, False)], "plant_id int, lane_2a boolean, lane_2b boolean"
    )
    plants = plants.withColumns({c: F.lit(None).cast("date") for c in ("granted_start", "reported_planned_start", "planned_start", "monitored_at", "sent_at")})
    texts = [c for c in sinks.REPORTS["review_list"][1] if c not in plants.columns]
    plants = plants.withColumns({c: F.lit('a "b", c') for c in texts} | {"lane_3": F.lit(False)})
    rejects = spark.createDataFrame([(9, "UHE", ["x>y", "z"])], "plant_id int, gen_type string, reject_reason array<string>")
    sinks.export_reports({"plants": plants, "rejects": rejects}, str(tmp_path / "out"), parts=2)
    read = lambda name: sinks.read_report(spark, str(tmp_path / "out"), name)
    assert sorted(r.IdeUsinaOutorga for r in read("lane_2a").collect()) == ["1", "2"]
    assert sorted(r.IdeUsinaOutorga for r in read("redo_list").collect()) == ["1", "2"]
    assert [r.NomUsina for r in read("review_list").collect()] == ['a "b", c']
    assert [(r.IdeUsinaOutorga, r.reject_reason) for r in read("order_rejects").collect()] == [("9", "x>y, z")]


def test_reports_are_written_by_the_tasks_that_read_them(spark, tmp_path):
    """no report is shuffled, sorted or dealt to a few tasks; headings are not counted as rows."""
    context, folder = spark.sparkContext, str(tmp_path / "out")
    rows = spark.range(1000, numPartitions=6).select(F.col("id").alias("plant_id"), F.lit("UHE").alias("gen_type"), F.array(F.lit("x>y"), F.lit("z")).alias("reject_reason"))
    none = spark.createDataFrame([], "plant_id int, plant_name string, unit_no int, gen_type string, market string, granted_commercial timestamp_ntz")
    context.setJobGroup("reports", "reports")
    try:
        sinks.export_reports({"rejects": rows, "quarantine": none}, folder, compression="gzip")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    assert all(len(tracker.getJobInfo(job).stageIds) == 1 for job in tracker.getJobIdsForGroup("reports"))
    assert len(list((tmp_path / "out/report=order_rejects").glob("part-*.csv.gz"))) == 6
    assert {r.report: r.n for r in sinks.report_counts(spark, folder).collect()} == {"order_rejects": 1000, "quarantine": 0}
    back = sinks.read_report(spark, folder, "order_rejects")
    assert back.columns == ["IdeUsinaOutorga", "SigTipoGeracao", "reject_reason"]
    assert back.count() == 1000 and back.filter("reject_reason = 'x>y, z'").count() == 1000
    assert sinks.read_report(spark, folder, "quarantine").count() == 0


def test_exports(spark, tmp_path):
    row = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), None, None, True), (2, None, None, None, False)],
        "plant_id int, granted_start date, reported_planned_start date, planned_start date, lane_2a boolean",
    )
    sinks.export_report(row, "lane_2a", str(tmp_path))
    back = spark.read.csv(str(tmp_path / "lane_2a"), header=True)
    assert back.columns[0] == "IdeUsinaOutorga" and back.count() == 1

    stamps = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00.123456' AS t, 2 AS k")
    sinks.write_table(stamps, str(tmp_path / "t"), "k")
    assert spark.read.parquet(str(tmp_path / "t")).first().t.microsecond == 123000
