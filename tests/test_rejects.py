"""Records that are errors: missing fields, NULL keys, headers, options, counters."""

import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import filters
from strata.plans.records import RecordFlow, run_records
from strata.sources import files, records
from strata.streaming.records import StreamSource, read_ndjson_records, run_record_streams


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_missing_field_is_an_error_not_a_filtered_record(spark, tmp_dir):
    a = _write(f"{tmp_dir}/in/a.csv", "login,tier\nx,1\ny,2\n")
    b = _write(f"{tmp_dir}/in/b.csv", "login\nz\nbad,row\n")
    flow = RecordFlow().filter("other", "tier", "neq", "1")
    seen = []
    flow.set_error_handler(lambda df: seen.extend(r._error for r in df.collect()))
    src = [{"name": "a", "location": a}, {"name": "b", "location": b}]
    for dead in (None, f"{tmp_dir}/dead"):
        seen.clear()
        m = run_records(spark, src, flow, f"{tmp_dir}/out{dead is None}", dead)
        assert (m.records_read, m.records_written, m.records_filtered, m.records_rejected) == (4, 1, 1, 2)
        assert sorted(seen) == ["field 'tier' not found in record", "field count differs from header"]
    assert spark.read.parquet(f"{tmp_dir}/dead").count() == 2
    kept, rejects = filters.split_records(spark.createDataFrame([("q",)], "login string"), "tier", "eq", "1")
    assert (kept.count(), rejects.count()) == (0, 1)


def test_each_file_has_its_own_header(spark, tmp_dir):
    _write(f"{tmp_dir}/in/1.csv", "id,email\n1,a@x\n2,b@x\n")
    _write(f"{tmp_dir}/in/2.csv", "\nemail,id,note\nc@x,3,n\nshort,4\n")
    scan = records.read_csv_records(spark, f"{tmp_dir}/in", "s")
    got = sorted((r.id, r.email, r.note, r._row_number) for r in scan.records.collect())
    assert got == [("1", "a@x", None, 1), ("2", "b@x", None, 2), ("3", "c@x", "n", 3)]
    assert [r._corrupt_record for r in scan.rejects.collect()] == ["short,4"]


def test_numbers_survive_other_split_sizes(spark, tmp_dir):
    p = _write(f"{tmp_dir}/n/a b.csv", "k,v\n" + "".join(f"{i},x\n" for i in range(4000)))
    confs = {"spark.sql.files.minPartitionNum": "2", "spark.sql.files.openCostInBytes": "0"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = records.read_csv_records(spark, p, "s").records
        spark.conf.set("spark.sql.files.minPartitionNum", "7")
        rows = df.select("k", "_row_number").collect()
    finally:
        for k in confs:
            spark.conf.unset(k)
    assert sorted((int(r.k) + 1, r._row_number) for r in rows) == [(i, i) for i in range(1, 4001)]


def test_json_options_reach_the_parser(spark, tmp_dir):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType()),
                           T.StructField("name", T.StringType())])
    p = _write(f"{tmp_dir}/j/a.json", '{"id": 1, "at": "31/12/2023 10:00", "name": "é"}\n', "iso-8859-1")
    cfg = {"format": "json", "path": p, "read_options": {"timestampFormat": "dd/MM/yyyy HH:mm", "encoding": "ISO-8859-1"}}
    row = files.read_source(spark, cfg, schema).select("id", F.col("at").cast("string").alias("at"), "name", "_corrupt_record").first()
    assert tuple(row) == (1, "2023-12-31 10:00:00", "é", None)
    for bad in ({"mode": "FAILFAST"}, {"encoding": "UTF-16"}):
        with pytest.raises(ValueError):
            files.read_source(spark, {**cfg, "read_options": bad}, schema)


def test_stream_rows_without_the_key_pass(spark, tmp_dir):
    _write(f"{tmp_dir}/a/f.csv", "login,tier\nx,1\nx,2\n")
    _write(f"{tmp_dir}/b/f.csv", "tier\n7\n8\n9,9\n")
    flow = RecordFlow().deduplicate("d", "login")
    calls = []
    flow.set_error_handler(lambda df: calls.append(df.count()))
    run = run_record_streams(spark, [StreamSource("a", f"{tmp_dir}/a", ["login", "tier"]),
                                     StreamSource("b", f"{tmp_dir}/b", ["tier"])], flow,
                             f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    rows = sorted((r.Data.get("login") or "", r.Data["tier"]) for r in read_ndjson_records(spark, f"{tmp_dir}/out").collect())
    assert rows[:2] == [("", "7"), ("", "8")] and rows[2][0] == "x" and len(rows) == 3
    m = run.metrics
    assert (m.records_read, m.records_written, m.records_filtered, m.records_rejected) == (5, 3, 1, 1)
    assert sum(calls) == 1


def test_stream_late_and_undated_rows_are_counted_as_rejects(spark, tmp_dir):
    _write(f"{tmp_dir}/in/1.csv", "login,at\na,2024-01-02 00:00:00\nb,2024-01-05 00:00:00\nc,never\n")
    flow = RecordFlow().deduplicate("d", "login", event_time="at", watermark="1 hour")
    args = (spark, [StreamSource("s", f"{tmp_dir}/in", ["login", "at"])], flow, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    first = run_record_streams(*args, dead_letter_path=f"{tmp_dir}/dead").metrics
    assert (first.records_written, first.records_rejected) == (2, 1)
    _write(f"{tmp_dir}/in/2.csv", "login,at\nz,2023-01-01 00:00:00\ny,2024-01-06 00:00:00\n")
    second = run_record_streams(*args, dead_letter_path=f"{tmp_dir}/dead").metrics
    assert (second.records_read, second.records_written, second.records_filtered, second.records_rejected) == (2, 1, 0, 1)
