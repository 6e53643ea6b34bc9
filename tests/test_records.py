"""Record filters, normalize, rename, the flow from config, batch run counters."""

import math

import pytest

from strata.functions.numbers import go_float
from strata.operators import columns, filters
from strata.plans.records import RecordFlow, run_records

from pyspark.sql import functions as F


@pytest.mark.parametrize("text,value", [
    ("5", 5.0), ("5d", 0.0), (" 5", 0.0), ("1e3", 1000.0), ("abc", 0.0), (".5", 0.5),
    ("5.", 5.0), ("1e999", math.inf), ("-inf", -math.inf), ("Infinity", math.inf), ("", 0.0),
    ("0x10", 0.0), ("+7", 7.0)])
def test_go_float(spark, text, value):
    got = spark.createDataFrame([(text,)], "s string").select(go_float(F.col("s")).alias("v")).first().v
    assert got == value


def test_go_float_nan(spark):
    got = spark.createDataFrame([("NaN",)], "s string").select(go_float(F.col("s")).alias("v")).first().v
    assert math.isnan(got)


REC = "user_id string, status string, score string"


def _recs(spark):
    return spark.createDataFrame([("1", "active", "10"), ("2", "inactive", "abc"),
                                  ("3", "active", "NaN"), ("4", None, "-2")], REC)


@pytest.mark.parametrize("op,value,ids", [
    ("eq", "active", ["1", "3"]), ("neq", "active", ["2", "4"]), ("contains", "act", ["1", "2", "3"]),
    ("gt", "0", ["1"]), ("lt", "1", ["2", "4"]), ("gt", "x", ["1"])])
def test_filter_operators(spark, op, value, ids):
    field = "status" if op in ("eq", "neq", "contains") else "score"
    got = sorted(r.user_id for r in filters.filter_records(_recs(spark), field, op, value).collect())
    assert got == ids


def test_filter_errors(spark):
    with pytest.raises(ValueError):
        filters.filter_records(_recs(spark), "status", "like", "a")
    with pytest.raises(ValueError):
        filters.filter_records(_recs(spark), "nope", "eq", "a")


def test_normalize_unicode_space(spark):
    df = spark.createDataFrame([("\t A@B.C \n", 5), (" X　", 6)], "email string, n int")
    out = [r.email for r in columns.normalize_fields(df, ["email", "n", "missing"]).collect()]
    assert out == ["a@b.c", "x"]


def test_rename_is_simultaneous(spark):
    df = spark.createDataFrame([("u", "n", "s")], "user_id string, username string, status string")
    out = columns.rename_fields(df, {"ref": "user_id", "user_id": "username", "x": "missing"})
    assert out.columns == ["user_id", "ref", "status"]
    assert tuple(out.first()) == ("n", "u", "s")


def test_from_config_unknown_operation():
    with pytest.raises(ValueError):
        RecordFlow.from_config([{"name": "j", "operation": "join", "config": {}}])


def test_custom_stage_and_order(spark):
    flow = RecordFlow().add_stage("tag", lambda df: df.withColumn("t", F.lit(1)))
    flow.filter("active", "status", "eq", "active")
    assert flow.apply(_recs(spark)).count() == 2


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_run_records_counters_are_disjoint(spark, tmp_dir):
    a = _write(f"{tmp_dir}/a.csv", "user_id,status,email\n1,active, X@Y.Z\n2,inactive,q\n3,active\n1,active,dup\n")
    b = _write(f"{tmp_dir}/b.csv", "user_id,status,email\n1,active,other\n9,active,NINE \n")
    flow = RecordFlow.from_config([
        {"name": "f", "operation": "filter", "config": {"field": "status", "operator": "eq", "value": "active"}},
        {"name": "n", "operation": "normalize", "config": {"fields": ["email"]}},
        {"name": "d", "operation": "deduplicate", "config": {"key_field": "user_id"}}])
    rejected = []
    flow.set_error_handler(lambda df: rejected.append(df.count()))
    out = f"{tmp_dir}/out"
    m = run_records(spark, [{"name": "a", "location": a}, {"name": "b", "location": b}], flow,
                    out, dead_letter_path=f"{tmp_dir}/dead")
    assert (m.records_read, m.records_written, m.records_filtered, m.records_rejected) == (6, 2, 3, 1)
    assert m.records_read == m.records_written + m.records_filtered + m.records_rejected
    assert rejected == [1]
    back = spark.read.json(out).collect()
    got = sorted((r.Data.user_id, r.Data.email, r.ID) for r in back)
    assert got == [("1", "x@y.z", "a-1"), ("9", "nine", "b-2")]
    assert m.snapshot()["error_rate_percent"] == pytest.approx(100 / 6)


def test_run_from_config_batch_and_stream(spark, tmp_dir):
    import os
    from strata.plans.records import run_from_config
    os.makedirs(f"{tmp_dir}/src")
    _write(f"{tmp_dir}/src/a.csv", "user_id,status,email,username\n1,active,A@B,U\n1,active,x,y\n2,off,c,d\nbad\n")
    cfg = {"sources": [{"name": "users", "type": "csv", "location": f"{tmp_dir}/src"}],
           "transforms": [
               {"name": "f", "operation": "filter", "config": {"field": "status", "operator": "eq", "value": "active"}},
               {"name": "n", "operation": "normalize", "config": {"fields": ["email", "username"]}},
               {"name": "d", "operation": "deduplicate", "config": {"key_field": "user_id"}}],
           "destination": {"type": "jsonfile", "connection_string": f"{tmp_dir}/out"},
           "pipeline": {"dead_letter_path": f"{tmp_dir}/dead"}}
    m = run_from_config(spark, cfg)
    assert (m.records_read, m.records_written, m.records_filtered, m.records_rejected) == (4, 1, 2, 1)
    cfg["destination"]["connection_string"] = f"{tmp_dir}/out_stream"
    s = run_from_config(spark, cfg, stream=True, checkpoint=f"{tmp_dir}/ckpt")
    assert (s.records_read, s.records_written, s.records_rejected) == (4, 1, 1)
    with pytest.raises(ValueError):
        run_from_config(spark, {**cfg, "destination": {"type": "postgres"}})


def test_filter_record_maps_missing_key_is_rejected(spark):
    df = spark.createDataFrame([({"status": "active"},), ({"status": "off"},), ({"other": "x"},)],
                               "Data map<string,string>")
    kept, rejects = filters.filter_record_maps(df, "status", "eq", "active")
    assert [r.Data["status"] for r in kept.collect()] == ["active"]
    rej = rejects.collect()
    assert len(rej) == 1 and rej[0]._error == "field 'status' not found in record"
    with pytest.raises(ValueError):
        filters.filter_record_maps(df, "status", "like", "a")


def test_flow_dedup_without_envelope_uses_read_order(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "user_id string, v string")
    flow = RecordFlow().deduplicate("d", "user_id")
    assert sorted(r.user_id for r in flow.apply(df).collect()) == ["1", "2"]
