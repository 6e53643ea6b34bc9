"""Versioned tables: versions, time travel, merge rules, partitions, compaction."""

import os
import random

import pytest
from pyspark.sql import functions as F

from strata.sinks import tables

S = "id long, name string, region string"
T0, T1 = __import__("datetime").datetime(2024, 1, 1), __import__("datetime").datetime(2024, 1, 2)


def _key(t):
    return tuple((x is None, x) for x in t)


def _sorted(rows):
    return sorted(rows, key=_key)


def _rows(df):
    return _sorted(tuple(r) for r in df.collect())


def test_append_overwrite_time_travel(spark, tmp_dir):
    p = f"{tmp_dir}/t"
    r0 = tables.write_table(spark.createDataFrame([(1, "a", "EU")], S), p, "append", ["region"])
    tables.write_table(spark.createDataFrame([(2, "b", "AS")], S), p, "append")
    tables.write_table(spark.createDataFrame([(3, "c", "EU")], S), p, "overwrite")
    tables.write_table(spark.createDataFrame([(4, "d", "007")], S), p, "append")
    assert r0["rows_written"] == 1 and r0["version"] == 0
    assert _rows(tables.read_version(spark, p, 0)) == [(1, "a", "EU")]
    assert _rows(tables.read_version(spark, p, 1)) == [(1, "a", "EU"), (2, "b", "AS")]
    assert _rows(tables.read_version(spark, p, 2)) == [(3, "c", "EU")]
    # partition values keep their declared type: "007" is not read back as 7
    assert _rows(tables.read_version(spark, p)) == [(3, "c", "EU"), (4, "d", "007")]
    with pytest.raises(ValueError):
        tables.read_version(spark, p, 9)
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, f"{tmp_dir}/none")


def test_unfinished_version_is_ignored(spark, tmp_dir):
    p = f"{tmp_dir}/t"
    tables.write_table(spark.createDataFrame([(1, "a", "EU")], S), p, "append")
    os.makedirs(f"{p}/strata_version=1/strata_kind=append")  # a crashed write
    assert _rows(tables.read_version(spark, p)) == [(1, "a", "EU")]
    r = tables.write_table(spark.createDataFrame([(2, "b", "EU")], S), p, "append")
    assert r["version"] == 2
    assert len(_rows(tables.read_version(spark, p))) == 2


def test_merge_creates_then_upserts(spark, tmp_dir):
    p = f"{tmp_dir}/m"
    first = tables.merge_upsert(spark.createDataFrame([(1, "a", "EU"), (2, "b", "AS")], S), p, "id",
                                partition_by=["region"])
    assert first["rows_inserted"] == 2 and first["mode"] == "merge (initial write)"
    res = tables.merge_upsert(spark.createDataFrame([(2, None, "AS"), (3, "c", "EU")], S), p, "id")
    assert (res["rows_updated"], res["rows_inserted"]) == (1, 1)
    assert _rows(tables.read_version(spark, p)) == [(1, "a", "EU"), (2, None, "AS"), (3, "c", "EU")]


def test_merge_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "t", "EU"), (1, "a", "EU")], S)
    s = spark.createDataFrame([(None, "s", "EU")], S)
    out = _rows(tables.merge_frames(t, s, "id").drop(tables.ACTION))
    assert out == _sorted([(None, "t", "EU"), (None, "s", "EU"), (1, "a", "EU")])


def test_merge_duplicate_source_key_raises(spark, tmp_dir):
    p = f"{tmp_dir}/m"
    tables.merge_upsert(spark.createDataFrame([(1, "a", "EU")], S), p, "id")
    with pytest.raises(ValueError):
        tables.merge_upsert(spark.createDataFrame([(1, "x", "EU"), (1, "y", "EU")], S), p, "id")


def test_merge_empty_source_keeps_target(spark, tmp_dir):
    p = f"{tmp_dir}/m"
    tables.merge_upsert(spark.createDataFrame([(1, "a", "EU")], S), p, "id")
    res = tables.merge_upsert(spark.createDataFrame([], S), p, "id")
    assert (res["rows_updated"], res["rows_inserted"]) == (0, 0)
    assert _rows(tables.read_version(spark, p)) == [(1, "a", "EU")]


def test_merge_columns_and_delete(spark):
    t = spark.createDataFrame([(1, "a", "EU"), (2, "b", "AS")], S)
    s = spark.createDataFrame([(1, "A", "XX"), (3, "c", "EU")], S)
    cols = _rows(tables.merge_frames(t, s, "id", columns=["name"]).drop(tables.ACTION))
    assert cols == [(1, "A", "EU"), (2, "b", "AS"), (3, "c", "EU")]
    dele = _rows(tables.merge_frames(t, s, "id", delete_unmatched=True).drop(tables.ACTION))
    assert dele == [(1, "A", "XX"), (3, "c", "EU")]
    with pytest.raises(ValueError):
        tables.merge_frames(t, s.drop("region"), "id")


@pytest.mark.parametrize("seed", [11, 12])
def test_merge_matches_python_model(spark, seed):
    rnd = random.Random(seed)
    target = [(rnd.choice([None] + list(range(20))), f"t{i}", "R") for i in range(60)]
    keys = rnd.sample(range(40), 25)
    source = [(k, f"s{k}", "S") for k in keys] + [(None, "sn", "S")]
    got = _rows(tables.merge_frames(spark.createDataFrame(target, S), spark.createDataFrame(source, S),
                                    "id").drop(tables.ACTION))
    src = {k: (k, n, r) for k, n, r in source if k is not None}
    want = [src[k] if k in src else (k, n, r) for k, n, r in target]
    tkeys = {k for k, _, _ in target if k is not None}
    want += [row for k, row in src.items() if k not in tkeys] + [(None, "sn", "S")]
    assert got == _sorted(want)


def test_overwrite_partitions_null_safe(spark, tmp_dir):
    p = f"{tmp_dir}/po"
    tables.write_table(spark.createDataFrame([(1, "a", "EU"), (2, "b", None), (3, "c", "AS")], S),
                       p, "overwrite", ["region"])
    tables.overwrite_partitions(spark.createDataFrame([(4, "d", None), (5, "e", "EU")], S), p)
    got = _rows(tables.read_version(spark, p))
    assert got == _sorted([(3, "c", "AS"), (4, "d", None), (5, "e", "EU")])


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_dir):
    p = f"{tmp_dir}/c"
    df = spark.range(2000).select(F.col("id"), F.lit("n").alias("name"),
                                  (F.col("id") % 2).cast("string").alias("region"))
    for _ in range(3):
        tables.write_table(df.repartition(16), p, "append", ["region"])
    before = sum(tables.count_files(spark, p, v) for v in range(3))
    res = tables.compact(spark, p)
    assert res["rows_written"] == 6000
    assert tables.compact(spark, p)["mode"] == "compact (not needed)"
    assert tables.count_files(spark, p) < before
    assert tables.read_version(spark, p).count() == 6000
    # the advisory size was set for the compaction only
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != str(128 << 20)


def test_partition_overwrite_in_place_and_appends(spark, tmp_dir):
    p = f"{tmp_dir}/pr"
    tables.write_table(spark.createDataFrame([(1, "a", "EU"), (2, "b", None), (3, "c", "AS")], S),
                       p, "overwrite", ["region"])
    res = tables.overwrite_partitions(spark.createDataFrame([(4, "d", None), (5, "e", "EU")], S), p)
    assert res["version"] == 0 and res["rows_written"] == 2
    tables.write_table(spark.createDataFrame([(6, "f", "EU")], S), p, "append")
    for changed in (0, 1):  # version 0 is not what it was, and version 1 builds on it
        with pytest.raises(ValueError, match="in place"):
            tables.read_version(spark, p, changed)
    latest = tables.read_version(spark, p)
    assert _rows(latest) == _sorted([(3, "c", "AS"), (4, "d", None), (5, "e", "EU"), (6, "f", "EU")])
    before = _rows(latest)
    tables.compact(spark, p, only_if_needed=False)
    assert _rows(tables.read_version(spark, p)) == before
    with pytest.raises(ValueError):
        tables.overwrite_partitions(spark.createDataFrame([(7, "g", "EU")], S), p, ["name"])


def test_partition_replace_two_columns(spark, tmp_dir):
    p = f"{tmp_dir}/pr2"
    s2 = "id long, y int, m int"
    tables.write_table(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2023, 1)], s2), p,
                       "overwrite", ["y", "m"])
    tables.overwrite_partitions(spark.createDataFrame([(9, 2024, 1)], s2), p)
    assert sorted(r.id for r in tables.read_version(spark, p).collect()) == [2, 3, 9]


def test_merge_within_partitions(spark, tmp_dir):
    p = f"{tmp_dir}/mp"
    ev = "id long, name string, day string"
    tables.merge_upsert(spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d2")], ev),
                        p, "id", partition_by=["day"])
    res = tables.merge_upsert(spark.createDataFrame([(2, "B", "d2"), (4, "d", "d3")], ev), p, "id",
                              within_partitions=True)
    assert res["mode"] == "merge (partitions)"
    assert (res["rows_updated"], res["rows_inserted"]) == (1, 1)
    got = sorted(tuple(r) for r in tables.read_version(spark, p).collect())
    assert got == [(1, "a", "d1"), (2, "B", "d2"), (3, "c", "d2"), (4, "d", "d3")]
    assert [h["kind"] for h in tables.history(spark, p)] == ["snapshot"]


def test_compact_selected_partitions(spark, tmp_dir):
    p = f"{tmp_dir}/cp"
    df = spark.range(3000).select(F.col("id"), F.lit("n").alias("name"),
                                  (F.col("id") % 3).cast("string").alias("region"))
    tables.write_table(df.repartition(12), p, "overwrite", ["region"])
    res = tables.compact(spark, p, partitions=[["0"]])
    assert res["rows_written"] == 1000
    assert tables.read_version(spark, p).count() == 3000
    files = tables.file_sizes(spark, p)
    assert len(files["region=0"]) == 1 and set(files) == {"region=0", "region=1", "region=2"}


def test_write_table_merge_mode(spark, tmp_dir):
    p = f"{tmp_dir}/wm"
    tables.write_table(spark.createDataFrame([(1, "a", "EU")], S), p, "overwrite")
    res = tables.write_table(spark.createDataFrame([(1, "z", "EU")], S), p, "merge", merge_key="id",
                             merge_columns=["name"])
    assert res["rows_updated"] == 1
    assert _rows(tables.read_version(spark, p)) == [(1, "z", "EU")]
    with pytest.raises(ValueError):
        tables.write_table(spark.createDataFrame([(1, "z", "EU")], S), p, "merge")


def test_read_changes(spark, tmp_dir):
    p = f"{tmp_dir}/rc"
    assert tables.read_changes(spark, p, None) == (None, None, False)
    tables.write_table(spark.createDataFrame([(1, "a", "EU")], S), p, "append")
    df, v, full = tables.read_changes(spark, p, None)
    assert (df.count(), v, full) == (1, 0, True)
    assert tables.read_changes(spark, p, 0)[0] is None
    tables.write_table(spark.createDataFrame([(2, "b", "EU")], S), p, "append")
    tables.write_table(spark.createDataFrame([(3, "c", "EU")], S), p, "append")
    df, v, full = tables.read_changes(spark, p, 0)
    assert sorted(r.id for r in df.collect()) == [2, 3] and v == 2 and not full
    tables.write_table(spark.createDataFrame([(4, "d", "EU")], S), p, "overwrite")
    df, v, full = tables.read_changes(spark, p, 2)
    assert [r.id for r in df.collect()] == [4] and full


def test_merge_delete_drops_null_key_target_rows(spark):
    t = spark.createDataFrame([(None, "t", "EU"), (1, "a", "EU"), (2, "b", "EU")], S)
    s = spark.createDataFrame([(1, "A", "EU"), (None, "s", "AS")], S)
    out = _rows(tables.merge_frames(t, s, "id", delete_unmatched=True).drop(tables.ACTION))
    assert out == _sorted([(1, "A", "EU"), (None, "s", "AS")])


def test_append_must_keep_partitioning(spark, tmp_dir):
    p = f"{tmp_dir}/lay"
    tables.write_table(spark.createDataFrame([(1, "a", "EU")], S), p, "append", ["region"])
    with pytest.raises(ValueError):
        tables.write_table(spark.createDataFrame([(2, "b", "EU")], S), p, "append", ["name"])
    tables.write_table(spark.createDataFrame([(3, "c", "EU")], S), p, "overwrite", ["name"])
    assert _rows(tables.read_version(spark, p)) == [(3, "c", "EU")]


def _plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_untouched_null_partitions_stay(spark, tmp_dir):
    p = f"{tmp_dir}/np"
    tables.write_table(spark.createDataFrame([(1, "a", None), (2, "b", "a"), (3, "c", "b")], S), p,
                       "overwrite", ["region"])
    tables.overwrite_partitions(spark.createDataFrame([(9, "z", "a")], S), p)
    assert _plain(tables.read_version(spark, p)) == sorted([(1, "a", None), (3, "c", "b"), (9, "z", "a")], key=repr)


def test_empty_string_partition_is_null(spark, tmp_dir):
    p = f"{tmp_dir}/es"
    tables.merge_upsert(spark.createDataFrame([(1, "a", ""), (2, "b", None), (3, "c", "x")], S), p, "id",
                        partition_by=["region"])
    tables.merge_upsert(spark.createDataFrame([(1, "A", ""), (4, "d", None)], S), p, "id", within_partitions=True)
    assert _plain(tables.read_version(spark, p)) == sorted(
        [(1, "A", None), (2, "b", None), (3, "c", "x"), (4, "d", None)], key=repr)


def test_rows_move_between_partitions(spark, tmp_dir):
    p = f"{tmp_dir}/mv"
    tables.merge_upsert(spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2"), (3, "c", None), (4, "d", "d 4/x")], S),
                        p, "id", partition_by=["region"])
    res = tables.merge_upsert(spark.createDataFrame([(1, "A", "d2"), (3, "C", "d1"), (4, "D", None)], S), p, "id",
                              within_partitions=True)
    assert (res["rows_updated"], res["rows_inserted"]) == (3, 0)
    assert _plain(tables.read_version(spark, p)) == sorted(
        [(1, "A", "d2"), (2, "b", "d2"), (3, "C", "d1"), (4, "D", None)], key=repr)
    assert "region=d1" in tables.file_sizes(spark, p) and len(tables.file_sizes(spark, p)) == 3


def test_newer_rows_win_whatever_the_order(spark, tmp_dir):
    s = "id long, at timestamp, v string, day string"
    rows = [(1, T0, "old", "d1"), (1, T1, "new", "d2"), (2, None, "none", "d1"), (2, T0, "dated", "d1"),
            (3, T1, "x", "d1"), (3, T1, "y", "d1")]
    results = set()
    for order in ([0, 2, 4], [1, 3, 5]), ([1, 3, 5], [0, 2, 4]), ([1, 2, 5], [0, 3, 4]):
        p = f"{tmp_dir}/nw{order[0][0]}{order[0][1]}"
        for part in order:
            tables.merge_upsert(spark.createDataFrame([rows[i] for i in part], s), p, "id", partition_by=["day"],
                                within_partitions=True, newer=["at"])
        results.add(tuple(sorted((r.id, r.v, r.day) for r in tables.read_version(spark, p).collect())))
    assert len(results) == 1
    assert results.pop()[:2] == ((1, "new", "d2"), (2, "dated", "d1"))


def test_many_two_column_partitions(spark, tmp_dir):
    p = f"{tmp_dir}/many"
    df = spark.range(1600).select("id", F.when(F.col("id") % 40 != 0, (F.col("id") % 40).cast("string")).alias("a"),
                                  F.floor(F.col("id") / 40).alias("b")).repartition(2, "a", "b")
    tables.write_table(df, p, "overwrite", ["a", "b"])
    tables.overwrite_partitions(df.filter("id < 1560").withColumn("id", -F.col("id") - 1), p)
    got = tables.read_version(spark, p)
    assert got.count() == 1600 and got.filter("id >= 0").count() == 40
    assert got.filter("a is null").count() == 40


def test_compaction_looks_at_each_partition(spark, tmp_dir):
    p = f"{tmp_dir}/cs"
    big = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit("EU").alias("region"))
    tables.write_table(big.coalesce(1), p, "append")
    for i in range(4):
        tables.write_table(spark.createDataFrame([(-i, "n", "EU")], S), p, "append")
    assert tables.compact(spark, p, "1mb")["mode"] == "compact"
    assert tables.read_version(spark, p).count() == 400_004


def test_changes_in_place_are_seen_and_have_no_version(spark, tmp_dir):
    """A partition overwrite: readers of changes get the table again, old numbers are refused."""
    path = f"{tmp_dir}/t"
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, p string")
    tables.write_table(df, path, "overwrite", ["p"])
    _, state, full = tables.read_changes(spark, path, None)
    assert (state, full) == (0, True) and tables.read_changes(spark, path, state)[0] is None
    tables.overwrite_partitions(spark.createDataFrame([(9, "a")], "k int, p string"), path)
    rows, later, full = tables.read_changes(spark, path, state)
    assert full and later == [0, 2] and sorted(r.k for r in rows.collect()) == [3, 9]
    assert tables.read_changes(spark, path, later)[0] is None
    with pytest.raises(ValueError, match="in place"):
        tables.read_version(spark, path, 0)
    tables.write_table(spark.createDataFrame([(5, "c")], "k int, p string"), path, "append")
    rows, last, full = tables.read_changes(spark, path, later)
    assert (full, last) == (False, 1) and [r.k for r in rows.collect()] == [5]
    assert sorted(r.k for r in tables.read_version(spark, path).collect()) == [3, 5, 9]
    tables.merge_upsert(spark.createDataFrame([(3, "a")], "k int, p string"), path, "k", within_partitions=True)
    assert tables.read_changes(spark, path, last)[2] is True


def test_keys_are_looked_up_where_the_source_has_no_rows(spark, tmp_dir):
    """Touched: the source's partitions, and others (NULL too) that hold one of its keys."""
    path = f"{tmp_dir}/t"
    stored = [("a", 1, "x"), ("b", 1, "y"), ("c", 1, None), ("d", 1, "z"), (None, 1, "n"), ("e", 1, "x")]
    tables.write_table(spark.createDataFrame(stored, "k string, v int, p string"), path, "overwrite", ["p"])
    source = spark.createDataFrame([("a", 2, "new"), ("c", 2, "x"), ("c", 2, "x"), (None, 2, "x"), ("q", 2, "")],
                                   "k string, v int, p string")
    touched = tables.touched_partitions(tables.read_version(spark, path), source, "k", ["p"])
    assert sorted(str(r.p) for r in touched.collect()) == ["None", "new", "x"]
    only = source.filter("k = 'a'")
    touched = tables.touched_partitions(tables.read_version(spark, path), only, "k", ["p"])
    assert sorted(r.p for r in touched.collect()) == ["new", "x"]


def test_a_staged_frame_is_not_staged_again(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    tables.write_table(spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "v int, p string"), path, "overwrite", ["p"])
    rows = tables.staged(spark.createDataFrame([(4, "x"), (5, "x")], "v int, p string"), "rows")
    within = tables.staged(spark.createDataFrame([("x",), ("y",)], "p string"), "within")
    monkeypatch.setattr(tables, "staged", None)
    res = tables.overwrite_partitions(rows, path, ["p"], within=within, written=True)
    assert res["rows_written"] == 2
    assert sorted((r.v, r.p) for r in tables.read_version(spark, path).collect()) == [(3, "z"), (4, "x"), (5, "x")]
