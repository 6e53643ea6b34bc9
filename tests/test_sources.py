"""JSON lines, CSV, CSV records with rejects and dense numbering."""

import os

import pytest
from pyspark.sql import types as T

from strata.schemas import EVENT_SCHEMA
from strata.sources import files, records


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_json_lines_good_broken_blank_empty(spark, tmp_dir):
    p = _write(f"{tmp_dir}/e.json", '{"event_id": "1", "customer_id": "c"}\n'
               '{"event_id": "2",\n\n   \n{}\n')
    df = files.read_json_lines(spark, p, EVENT_SCHEMA)
    clean, corrupt = files.split_corrupt(df)
    assert df.count() == 3  # blank lines dropped
    assert corrupt.count() == 1 and corrupt.collect()[0]._corrupt_record == '{"event_id": "2",'
    assert sorted(str(r.event_id) for r in clean.collect()) == ["1", "None"]
    assert "_corrupt_record" not in clean.columns


def test_split_without_corrupt_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    clean, corrupt = files.split_corrupt(df)
    assert corrupt is None and clean is df


def test_read_source_schema_wins_over_inference(spark, tmp_dir):
    p = _write(f"{tmp_dir}/c.csv", "customer_id,n\n007,1\n")
    schema = T.StructType([T.StructField("customer_id", T.StringType()),
                           T.StructField("n", T.StringType())])
    df = files.read_source(spark, {"format": "csv", "path": p,
                                   "read_options": {"header": "true", "inferSchema": "true"}}, schema)
    assert df.collect()[0].customer_id == "007"


CSV = ('id,status,email\n'
       '1,active, A@x.com \n'
       '2,short\n'
       '3,active,b,EXTRA\n'
       '\n'
       '4,,\n'
       '5,"say ""hi""",q\n')


def test_csv_records_edge_cases(spark, tmp_dir):
    p = _write(f"{tmp_dir}/r.csv", CSV)
    scan = records.read_csv_records(spark, p, "users")
    got = {r.id: r for r in scan.records.collect()}
    assert sorted(got) == ["1", "4", "5"]
    assert got["1"].email == "A@x.com "          # leading space trimmed, trailing kept
    assert got["4"].status == "" and got["4"].email == ""  # empty field is ""
    assert got["5"].status == 'say "hi"'
    assert [got[k]._row_number for k in ("1", "4", "5")] == [1, 2, 3]
    assert [got[k]._record_id for k in ("1", "4", "5")] == ["users-1", "users-2", "users-3"]
    rej = scan.rejects.collect()
    assert sorted(r._corrupt_record for r in rej) == ["2,short", "3,active,b,EXTRA"]
    assert scan.records.count() == 3 and scan.rejects.count() == 2


def test_csv_records_numbering_spans_files_and_splits(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/many")
    n = 0
    for f in range(3):
        lines = ["k,v"] + [f"{n + i},x" for i in range(500)]
        n += 500
        _write(f"{tmp_dir}/many/part-{f}.csv", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        scan = records.read_csv_records(spark, f"{tmp_dir}/many", "s")
        rows = scan.records.select("k", "_row_number").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((int(r.k) + 1, r._row_number) for r in rows) == [(i, i) for i in range(1, 1501)]


def test_union_sources_by_name(spark):
    a = spark.createDataFrame([("1", "x")], "id string, a string")
    b = spark.createDataFrame([("2", "y")], "id string, b string")
    rows = {r.id: r for r in records.union_sources({"A": a, "B": b}).collect()}
    assert rows["1"]._record_source == "A" and rows["1"].b is None and rows["2"].a is None


def test_csv_malformed_rows_do_not_depend_on_projection(spark, tmp_dir):
    """DEC9: with column pruning off, one column or all give the same rows."""
    p = _write(f"{tmp_dir}/p.csv", "a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n")
    scan = records.read_csv_records(spark, p, "s")
    assert scan.records.count() == 2
    assert scan.records.select("a").count() == 2
    assert sorted(r.a for r in scan.records.select("a").collect()) == ["1", "10"]
    assert scan.rejects.count() == 2 and scan.rejects.select("_error").count() == 2
    df = files.read_csv(spark, p, T.StructType([T.StructField(c, T.StringType())
                                                for c in "abc"]), mode="DROPMALFORMED")
    assert df.count() == df.select("a").count() == len(df.collect()) == 2


def test_csv_records_multiline_quoted_field(spark, tmp_dir):
    """DEC25: newlines inside quotes need multi_line (files stop being splittable)."""
    p = _write(f"{tmp_dir}/m.csv", 'id,note\n1,"two\nlines"\n2,plain\n')
    scan = records.read_csv_records(spark, p, "s", multi_line=True)
    got = {r.id: r.note for r in scan.records.collect()}
    assert got == {"1": "two\nlines", "2": "plain"}
    assert scan.rejects.count() == 0


def test_record_numbers_same_without_broadcast(spark, tmp_dir, monkeypatch):
    """With split offsets joined by a shuffle: same numbers."""
    p = _write(f"{tmp_dir}/n.csv", "k,v\n" + "".join(f"{i},x\n" for i in range(300)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(records, "broadcast_below", lambda df, **_: df)
    try:
        df = records.read_csv_records(spark, p, "s").records
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = df.select("k", "_row_number").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastExchange" not in plan
    assert sorted((int(r.k) + 1, r._row_number) for r in rows) == [(i, i) for i in range(1, 301)]


def test_ten_thousand_files_with_their_own_headers(spark, tmp_dir):
    """Headers come from a scan on the executors: no file is opened or listed by name on the driver."""
    os.makedirs(f"{tmp_dir}/in")
    for i in range(10_000):
        names = ("k", "v") if i % 2 else ("v", "k")
        _write(f"{tmp_dir}/in/{i:05d}.csv", f"{','.join(names)}\n" + (f"{i},x\n" if i % 2 else f"x,{i}\n"))
    scan = records.read_csv_records(spark, f"{tmp_dir}/in", "s")
    got = scan.records.select("k", "v", "_row_number").orderBy("_row_number").collect()
    assert [(r.k, r.v, r._row_number) for r in got] == [(str(i), "x", i + 1) for i in range(10_000)]
    assert scan.rejects.count() == 0 and scan.header == ["v", "k"]


def test_numbers_without_a_window_over_rows(spark, tmp_dir):
    """Malformed and blank lines between good ones, over several splits and files."""
    want = []
    for f in range(2):
        lines = ["k,v"]
        for i in range(3000):
            key = f * 3000 + i
            lines += [f"{key},x"] + (["bad,row,here"] if i % 7 == 0 else []) + ([""] if i % 11 == 0 else [])
            want.append((str(key), key + 1))
        _write(f"{tmp_dir}/in{f}.csv", "\n".join(lines) + "\n")
    confs = {"spark.sql.files.minPartitionNum": "6", "spark.sql.files.openCostInBytes": "0"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        scan = records.read_csv_records(spark, [f"{tmp_dir}/in0.csv", f"{tmp_dir}/in1.csv"], "s")
        plan = scan.records._jdf.queryExecution().executedPlan().toString()
        got = sorted(((r.k, r._row_number) for r in scan.records.collect()), key=lambda r: r[1])
    finally:
        for k in confs:
            spark.conf.unset(k)
    assert got == want and scan.rejects.count() == 2 * 429
    rows_side = plan.split("BroadcastExchange")[0]
    assert "Window" not in rows_side and "Exchange hashpartitioning" not in rows_side


def test_mixed_headers_in_another_encoding(spark, tmp_dir):
    for name, text in (("a", "name,note\nJosé,x\n"), ("b", "note;name\n\"y,z\",Zoë\n".replace(";", ","))):
        with open(f"{tmp_dir}/{name}.csv", "w", encoding="iso-8859-1") as f:
            f.write(text)
    scan = records.read_csv_records(spark, f"{tmp_dir}/*.csv", "s", encoding="iso-8859-1")
    assert sorted((r.name, r.note) for r in scan.records.collect()) == [("José", "x"), ("Zoë", "y,z")]


def test_scratch_folders_are_dropped_on_request(spark):
    from strata import session
    a = session.stored(spark.range(5), "t")
    path = a.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "")
    assert session.drop_scratch(spark, path) == 1 and not os.path.exists(path)
    with pytest.raises(ValueError):
        session.drop_scratch(spark, "/tmp/not-ours")
