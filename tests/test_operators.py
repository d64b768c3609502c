from __future__ import annotations

import collections
import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from milepost.operators import aggregates as agg
from milepost.operators import joins, mapping, pick, ranks, setops
from milepost.plans import diagnostics as dg
from milepost.session import SmallTable, scratch_dir, staged, temporary_stages
from milepost.sources import files
from tests.stages import stage_tables


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pick_row_ties_and_unknown(spark):
    df = spark.createDataFrame(
        [(1, 5, 1, "a"), (1, 5, 2, "b"), (1, None, 9, "c"), (2, None, 1, "d")],
        "k int, by int, tie int, v string",
    )
    assert rows(pick.pick_row(df, ["k"], "by", ["tie"]), "k", "v") == [(1, "b")]
    assert rows(pick.pick_row(df, ["k"], "by", ["tie"], largest=False), "k", "v") == [(1, "a")]


def test_pick_row_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("by"))
    text = plan(pick.pick_row(df, ["k"], "by"))
    exchange = text.index("Exchange hashpartitioning")
    assert "partial_max_by" in text[exchange:]
    assert "Window" not in text


def test_latest_batch_keeps_ties(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c")], "k int, ts int, v string")
    assert rows(pick.latest_batch(df, "k", "ts"), "v") == [("b",), ("c",)]


def test_split_duplicate_ids_with_a_hot_key(spark):
    hot = spark.range(5000).select(F.lit(7).alias("k"), "id", F.lit("H").alias("kind"))
    rest = spark.createDataFrame([(8, 1, "H"), (9, 1, "H"), (9, 2, "X")], "k int, id bigint, kind string")
    out = pick.split_duplicate_ids(hot.unionByName(rest), "k", ["id"], F.col("kind") == "H")
    assert out.count() == 5003
    numbers = {int(r.unit_key.split("_")[1]) for r in out.filter("k = 7").collect()}
    assert numbers == set(range(5000))
    assert rows(out.filter("k <> 7"), "k", "unit_key") == [(8, "8"), (9, "9"), (9, "9_0")]


def test_null_matches_null(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, 2, "y")], "p int, u int, v string")
    b = spark.createDataFrame([(1, None, "z")], "p int, u int, w string")
    assert rows(joins.null_safe_join(a, b, ["p", "u"], "left"), "v", "w") == [("x", "z"), ("y", None)]
    both = joins.reconcile(a.select("p", "u"), b.select("p", "u"), ["p", "u"])
    assert rows(both, "p", "u", "in_a", "in_b") == [(1, 2, True, False), (1, None, True, True)]
    assert rows(joins.missing_from(a, b, ["p", "u"]), "v") == [("y",)]


def test_natural_join_uses_all_shared_columns(spark):
    a = spark.createDataFrame([(1, "n", 5)], "id int, name string, x int")
    b = spark.createDataFrame([(1, "n", 6), (1, "m", 7)], "id int, name string, y int")
    assert rows(joins.natural_join(a, b), "x", "y") == [(5, 6)]
    with pytest.raises(ValueError):
        joins.natural_join(a.select("x"), b.select("y"))


def test_lookup_last_entry_wins_and_unique_check(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    entries = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, v string, n int")
    assert rows(joins.lookup(df, entries, "k", "v", "n"), "k", "v") == [(1, "new"), (2, None)]
    assert joins.assert_unique(df, ["k"]) is df
    with pytest.raises(ValueError):
        joins.assert_unique(entries, ["k"])


def test_collapse_keeps_unknown_groups_and_totals(spark):
    df = spark.createDataFrame(
        [(1, None, 2.0), (1, None, 3.0), (1, "a", None)], "p int, g string, mw double"
    )
    out = agg.collapse_units(df, "mw")
    assert rows(out, "g", "unit_count", "total_power") == [("a", 0, 0.0), (None, 2, 5.0)]
    assert tuple(agg.conservation(df, out, "mw").first()) == (0, 0.0)


def test_group_summary_lists_empty_cells(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0, dt.date(1970, 1, 2)), ("b", "y", 3.0, None)],
        "g string, m string, v double, d date",
    )
    out = agg.group_summary(df, ["g", "m"], ["v", "d"], ["mean", "count"])
    assert rows(out, "g", "m", "v_mean", "v_count", "d_mean", "d_count") == [
        ("a", "x", 1.0, 1, 1.0, 1),
        ("a", "y", None, 0, None, 0),
        ("b", "x", None, 0, None, 0),
        ("b", "y", 3.0, 1, None, 0),
    ]


def test_segment_table_joins_left_and_inner_only(spark):
    big = spark.range(500).select((F.col("id") % 5).alias("k"), "id")
    table = SmallTable(spark.range(4).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")))
    assert table.join(big, ["k"]).count() == 500 and table.join(big, ["k"], "inner").count() == 400
    for how in ("full", "right"):
        with pytest.raises(ValueError):
            table.join(big, ["k"], how)


def test_rows_without_a_key_are_kept_when_ids_are_split(spark):
    df = spark.createDataFrame([(None, "H", 1), (None, "H", 2), (7, "H", 3), (7, "H", 4), (None, "x", 5)], "k long, kind string, id long")
    out = pick.split_duplicate_ids(df, "k", ["id"], F.col("kind") == "H")
    assert out.count() == 5 and out.filter("k IS NULL AND unit_key IS NULL").count() == 3
    assert sorted(r.unit_key for r in out.filter("k = 7").collect()) == ["7_0", "7_1"]


def test_full_joins_are_split_and_complete(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k long, x string")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (None, "r"), (4, "s")], "k long, y string")
    full = joins.null_safe_join(a, b, ["k"], "full")
    found = {(r.k, r.x, r.y) for r in full.collect()}
    assert found == {(1, "a", "p"), (1, "a", "q"), (None, "b", "r"), (3, "c", None), (4, None, "s")}
    assert "FullOuter" not in plan(full)
    sides = {(r.k, r.in_a, r.in_b) for r in joins.reconcile(a, b, ["k"]).collect()}
    assert sides == {(1, True, True), (None, True, True), (3, True, False), (4, False, True)}


def test_equal_rows_are_settled_without_tie_columns(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "c"), (1, 5, "b"), (2, 1, None)], "k int, t int, v string")
    for parts in (1, 3):
        best = pick.pick_row(df.repartition(parts), ["k"], "t")
        assert {(r.k, r.v) for r in best.collect()} == {(1, "c"), (2, None)}


def test_unreadable_ids_are_told(spark):
    lines = spark.createDataFrame([("12, x7,",), (" 13,x7",)], "value string")
    assert sorted(r.plant_id for r in files.parse_ids(lines).collect()) == [12, 13]
    assert [r.token for r in files.unreadable_ids(lines).collect()] == ["x7"]


def test_files_of_one_name_keep_their_own_copies(spark, tmp_path):
    for folder, value in (("x", 1), ("y", 2)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "t.csv").write_text(f"id\n{value}\n")
    paths = [str(tmp_path / f / "t.csv") for f in ("x", "y")]
    stacked = files.ingest_files(spark, paths, parquet_dir=str(tmp_path / "copies"))
    assert sorted(int(r.id) for r in stacked.collect()) == [1, 2]


def test_stage_tables_use_the_shared_folder(spark):
    df = staged(spark.range(10))
    assert df.count() == 10
    folder = scratch_dir(spark).removeprefix("file:").rstrip("/")
    assert df.inputFiles()[0].removeprefix("file:").replace("///", "/").startswith(folder)


def test_setops(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 5)], "id int, b int")
    both = setops.union_with_origin({"one": a, "two": b})
    assert rows(both, "id", "a", "b", "origin") == [(1, "x", None, "one"), (2, None, 5, "two")]
    df = spark.range(100)
    first = setops.seeded_sample(df, ["id"], 5, 1).collect()
    assert first == setops.seeded_sample(df.repartition(7), ["id"], 5, 1).collect()
    assert first != setops.seeded_sample(df, ["id"], 5, 2).collect()
    product = setops.key_product(spark.createDataFrame([("a", 1), ("b", 2)], "g string, n int"), ["g", "n"])
    assert product.count() == 4
    assert "CartesianProduct" not in plan(product) and "NestedLoop" not in plan(product)


def test_mapping(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    pairs = spark.createDataFrame([("x", "a"), ("gone", "b"), ("y", None)], "old string, new string")
    names = mapping.read_mapping(pairs, "old", "new", ["x", "y"])
    assert mapping.apply_mapping(a, names).columns == ["a"]
    assert rows(mapping.schema_diff(a, a.select("x")), "column", "side") == [("y", "left_only")]
    routed = mapping.route_columns(["y", "z"], {"a": a})
    assert routed["a"].columns == ["y"]


def test_show_cases_worked_example(spark):
    df = spark.createDataFrame(
        [(0, 1.0, None, 3.0), (1, None, 4.0, 6.0), (2, 3.0, 6.0, 5.0), (3, None, None, None), (4, 5.0, 10.0, 15.0)],
        "i int, A double, B double, C double",
    )
    by_presence = dg.show_cases(df, ["A", "B", "C"], 0, ["i"])
    assert rows(by_presence, "A", "B", "C", "A_case", "n") == [
        (1.0, None, 3.0, True, 1),
        (3.0, 6.0, 5.0, True, 2),
        (None, 4.0, 6.0, False, 1),
        (None, None, None, False, 1),
    ]
    by_value = dg.show_cases(df, ["A", "B", "C"], 5, ["i"])
    assert by_value.count() == 5
    # With at most three values allowed, four values (one of them unknown) are too many.
    assert dg.many_valued(df, ["A", "B", "C"], 3) == {"A", "B", "C"}


def test_many_valued_needs_no_exact_count_for_wide_columns(spark):
    df = spark.range(10000).select("id", (F.col("id") % 3).alias("few"))
    assert dg.many_valued(df, ["id", "few"], 5) == {"id"}


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None)], "x int, y string, z string")
    assert rows(dg.constant_columns(df), "column", "known") == [("y", 2), ("z", 0)]


# --- places, one-shuffle joins, grids, bounded distinct counts ----------------


def test_places_without_a_window_over_a_group(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", "a", None, "c"]), rng.random(), i) for i in range(3000)] + [("one", 0.5, 1)]
    df = spark.createDataFrame(data, "g string, x double, _id long").repartition(6)
    ranked = ranks.numbered(df, ["g"], ["x", "_id"])
    assert ranked.columns == ["g", "x", "_id", "place", "size"]
    groups = collections.defaultdict(list)
    for g, x, i in data:
        groups[g].append((x, i))
    wanted = {(g, x, i, k, len(v)) for g, v in groups.items() for k, (x, i) in enumerate(sorted(v))}
    assert {tuple(r) for r in ranked.collect()} == wanted
    flagged = ranks.numbered(df.withColumn("odd", F.col("_id") % 2 == 1), ["g"], ["x"], only="odd")
    odd = [r.place for r in flagged.filter("odd AND g = 'a'").collect()]
    assert sorted(odd) == list(range(len(odd)))
    assert ranks.numbered(df.limit(0), ["g"], ["x"]).count() == 0
    with pytest.raises(ValueError):
        ranks.numbered(df, [], ["x"])


def test_numbering_spreads_a_hot_key(spark):
    """One key with all rows: every task has a part of it, windows see one row a partition."""
    hot = spark.range(40_000).select(F.lit(7).alias("k"), F.col("id").alias("t"), F.lit("H").alias("kind"))
    out = pick.split_duplicate_ids(hot, "k", ["t"], F.col("kind") == "H")
    assert out.filter(F.col("unit_key") != F.concat(F.lit("7_"), F.col("t").cast("string"))).isEmpty()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranks.numbered(hot, ["k"], ["t"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [pq.read_metadata(f.removeprefix("file://")).num_rows for f in set(ranked.inputFiles())]
    assert len(sizes) > 1 and max(sizes) < 20_000
    text = plan(out)
    assert "SinglePartition" not in text and text.count("Scan parquet") <= 2


def by_hand_full(a, b):
    out = collections.Counter()
    for k, x in a:
        met = [y for j, y in b if j == k]
        for y in met or [None]:
            out[(k, x, y)] += 1
    for k, y in b:
        if k not in [j for j, _ in a]:
            out[(k, None, y)] += 1
    return out


@pytest.mark.parametrize("repeats", [False, True])
def test_full_join_in_one_shuffle(spark, repeats):
    a = [(k, f"a{k}") for k in range(0, 60, 2)] + [(None, "an")]
    b = [(k, f"b{k}") for k in range(0, 60, 3)] + [(None, "bn")]
    if repeats:
        a += [(None, f"n{i}") for i in range(40)] + [(6, "again"), (2, "again"), (2, None)]
        b += [(None, f"m{i}") for i in range(30)] + [(6, "more"), (9, None), (9, None)]
    left, right = spark.createDataFrame(a, "k long, x string"), spark.createDataFrame(b, "k long, y string")
    full = joins.full_join(left, right, ["k"])
    assert collections.Counter(tuple(r) for r in full.collect()) == by_hand_full(a, b)
    assert "FullOuter" not in plan(full)
    sides = joins.reconcile(left.select("k"), right.select("k"), ["k"])
    wanted = collections.Counter((k, x, y) for (k, x, y), n in by_hand_full([(k, 1) for k, _ in a], [(k, 1) for k, _ in b]).items() for _ in range(n))
    found = collections.Counter((r.k, 1 if r.in_a else None, 1 if r.in_b else None) for r in sides.collect())
    assert found == wanted
    assert plan(sides).count("Join") == 0
    with pytest.raises(ValueError):
        joins.full_join(left, left, ["k"])


def test_unknown_keys_are_dealt_over_parts(spark):
    a = spark.createDataFrame([(None, i) for i in range(100)] + [(1, 1)], "k long, x long")
    b = spark.createDataFrame([(None, i) for i in range(100)] + [(1, 7), (2, 8)], "k long, y long")
    pairs = joins.null_safe_join(a, b, ["k"], "inner")
    assert pairs.count() == 10_001 and pairs.filter("k IS NULL").select("x", "y").distinct().count() == 10_000
    assert joins.null_safe_join(a, b, ["k"], "left_semi").count() == 101
    assert joins.null_safe_join(b, a, ["k"], "left_anti").collect()[0].y == 8
    right = joins.null_safe_join(a, b, ["k"], "right")
    assert right.columns == ["k", "x", "y"] and right.count() == 10_002 and right.filter("k = 2").first().x is None
    assert plan(pairs).count("xxhash64") >= 1


def test_rows_with_some_key_known_travel_once(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (None, None)], "p int, u int")
    copies = joins.copied(df, ["p", "u"], "_copy").groupBy("p", "u").count()
    assert rows(copies, "p", "count") == [(1, 1), (None, 1), (None, joins.UNKNOWN_PARTS)]
    both = joins.null_safe_join(df, df.withColumn("x", F.lit(1)), ["p", "u"], "inner")
    assert both.count() == 3


def test_grid_and_cells_come_from_one_aggregate(spark):
    df = spark.createDataFrame(
        [("a", 1, True, 2.0), ("b", 2, False, 4.0), ("a", 1, True, 6.0), (None, 3, None, 1.0), ("b", None, True, 9.0)],
        "g string, n int, f boolean, v double",
    )
    product = setops.key_product(df, ["g", "n", "f"])
    assert {tuple(r) for r in product.collect()} == {(g, n, f) for g in "ab" for n in (1, 2, 3) for f in (True, False)}
    assert product.count() == 12
    assert {r.g for r in setops.key_product(df, ["g"]).collect()} == {"a", "b"}
    assert setops.key_product(df.limit(0), ["g", "n"]).count() == 0
    assert setops.key_product(df.select("g", F.lit(None).cast("int").alias("n")), ["g", "n"]).count() == 0
    cells = agg.group_summary(df, ["g", "n"], ["v"], ["mean", "count"])
    assert {tuple(r) for r in cells.collect()} == {
        (g, n, {("a", 1): 4.0, ("b", 2): 4.0}.get((g, n)), {("a", 1): 2, ("b", 2): 1}.get((g, n), 0)) for g in "ab" for n in (1, 2, 3)
    }
    for result in (product, cells):
        assert "SinglePartition" not in plan(result) and "NestedLoop" not in plan(result) and "Cartesian" not in plan(result)


@pytest.mark.parametrize("k", [1, 2, 15, 16, 17, 100, 1000])
def test_many_valued_is_exact_for_every_bound(spark, k):
    parts = {f"c{d}": F.when(F.col("id") % 7 != 0, F.col("id") % d) for d in (max(1, k - 1), k, k + 1)}
    df = spark.range(20_000).select(
        *[c.cast("string").alias(n) for n, c in parts.items()],
        F.when(F.col("id") % 3 == 0, "").otherwise("x").alias("texts"),
        F.lit(None).cast("date").alias("a b"),
        F.col("id").cast("double").alias("all"),
    )
    exact = {c for c in df.columns if df.select(c).distinct().count() > k}
    assert dg.many_valued(df, df.columns, k) == exact


def test_compare_systems_takes_any_column_name(spark):
    ours = spark.createDataFrame([(1, 1.0, "x"), (2, 1.0, "y")], ["plant_id", "criterion_pmo", "a b"])
    theirs = spark.createDataFrame([(1, 1.0, "x"), (2, 1.0, "z")], ["plant_id", "criterion_pmo", "a b"])
    assert [r.plant_id for r in dg.compare_systems(ours, theirs, ["criterion_pmo", "a b"]).collect()] == [2]


def test_a_picked_row_travels_once(spark):
    """F12, F13, F16 to F18: the columns that decide are part of the row, not beside it."""
    df = spark.createDataFrame(
        [(1, 5, 2, "b", None), (1, 5, 2, "b", 4), (1, 5, 1, "z", 9), (1, 3, 9, "c", 1), (2, None, 1, "d", 1)],
        "k int, by int, tie int, v string, w int",
    )
    assert rows(pick.pick_row(df, ["k"], "by", ["tie"]), "by", "tie", "v", "w") == [(5, 2, "b", 4)]
    least = pick.pick_row(df, ["k"], "by", ["tie"], largest=False, keep_unknown=True)
    assert least.columns == df.columns
    assert rows(least, *df.columns) == [(1, 3, 9, "c", 1), (2, None, 1, "d", 1)]
    assert "max_by" not in plan(pick.pick_row(df, ["k"], "by", ["tie"]))


def test_lookup_carries_order_and_value_once(spark):
    """also where value and order are one column, or the value is unknown."""
    entries = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 3, "b"), (2, None, "z")], "k int, n int, v string")
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    got = joins.lookup(df, entries, "k", "v", "n")
    assert rows(got, "k", "v") == sorted([(1, None), (2, "b"), (3, None), (None, None)], key=str)
    assert "max_by" not in plan(got)
    assert rows(joins.lookup(df, entries, "k", "n", "n"), "k", "n") == sorted([(1, 2), (2, 3), (3, None), (None, None)], key=str)


def test_only_chosen_rows_are_put_in_order(spark, monkeypatch):
    """F8, F10: rows that keep their key are not range-partitioned with those that are numbered."""
    df = spark.createDataFrame(
        [(1, 5, "H"), (1, 4, "X"), (2, 1, "X"), (2, 2, "X"), (3, 2, "H"), (3, 1, "H"), (None, 1, "H"), (4, 1, None), (5, 1, "H")],
        "k int, t int, kind string",
    )
    seen = []
    monkeypatch.setattr(pick, "numbered", lambda d, *a, **k: seen.append(d.count()) or ranks.numbered(d, *a, **k))
    for written in (False, True):
        out = pick.split_duplicate_ids(df, "k", ["t"], F.col("kind") == "H", written=written)
        assert rows(out, "k", "t", "unit_key") == sorted(
            [(1, 5, "1_0"), (1, 4, "1"), (2, 1, "2"), (2, 2, "2"), (3, 1, "3_0"), (3, 2, "3_1"), (None, 1, None),
             (4, 1, "4"), (5, 1, "5")], key=str,
        )
    assert seen == [4, 4]


def test_temporary_stages_go_unless_kept(spark):
    """a long run does not keep every table it has written."""
    before = stage_tables(spark)
    with temporary_stages(spark) as outer:
        first = staged(spark.range(3))
        with temporary_stages(spark) as inner:
            staged(spark.range(4))
            second = inner(staged(spark.range(5)))
            with pytest.raises(ValueError, match="inside"):
                inner(first)
        assert len(stage_tables(spark) - before) == 2 and second.count() == 5
        first = outer(first)
    assert len(stage_tables(spark) - before) == 1 and first.count() == 3
    with pytest.raises(RuntimeError), temporary_stages(spark):
        staged(spark.range(6))
        raise RuntimeError
    assert len(stage_tables(spark) - before) == 1
