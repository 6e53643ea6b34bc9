"""Record flow on Structured Streaming: dedup across files, restart, idempotent sink."""

import os

from strata.plans.records import RecordFlow
from strata.streaming.records import read_ndjson_records, run_record_stream

HEADER = ["user_id", "status", "email"]
FLOW = [{"name": "n", "operation": "normalize", "config": {"fields": ["email"]}},
        {"name": "d", "operation": "deduplicate", "config": {"key_field": "user_id"}}]


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_stream_dedup_restart_and_rejects(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    _write(f"{src}/1.csv", "user_id,status,email\n1,a, A@X \n2,a,b\n2,a,again\n")
    _write(f"{src}/2.csv", "user_id,status,email\n2,a,later\n3,a,c\nbroken\n")
    out, ckpt, dead = f"{tmp_dir}/out", f"{tmp_dir}/ckpt", f"{tmp_dir}/dead"
    run = run_record_stream(spark, src, HEADER, "s", RecordFlow.from_config(FLOW), out, ckpt,
                            dead_letter_path=dead)
    rows = read_ndjson_records(spark, out).collect()
    keys = sorted(r.Data["user_id"] for r in rows)
    assert keys == ["1", "2", "3"]  # one row per key, across files
    assert [r.Data["email"] for r in rows if r.Data["user_id"] == "1"] == ["a@x"]
    m = run.metrics
    assert m.records_written == 3 and m.records_rejected == 1 and m.batches_processed == 2
    assert m.records_read == 6 and m.records_filtered == 2
    assert spark.read.parquet(dead).count() == 1

    # restart on the same checkpoint: nothing new, nothing rewritten
    again = run_record_stream(spark, src, HEADER, "s", RecordFlow.from_config(FLOW), out, ckpt)
    assert again.metrics.records_written == 0
    assert read_ndjson_records(spark, out).count() == 3

    # a new file with a known key and a new key: state remembers key 2
    _write(f"{src}/3.csv", "user_id,status,email\n2,a,x\n4,a,d\n")
    third = run_record_stream(spark, src, HEADER, "s", RecordFlow.from_config(FLOW), out, ckpt)
    assert third.metrics.records_written == 1
    assert sorted(r.Data["user_id"] for r in read_ndjson_records(spark, out).collect()) == \
        ["1", "2", "3", "4"]


def test_stream_dedup_within_watermark(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    _write(f"{src}/1.csv", "user_id,ts\n1,2024-01-01 00:00:00\n1,2024-01-01 00:10:00\n2,2024-01-01 00:20:00\n")
    flow = RecordFlow().deduplicate("d", "user_id", event_time="ts", watermark="1 hour")
    run = run_record_stream(spark, src, ["user_id", "ts"], "s", flow, f"{tmp_dir}/out",
                            f"{tmp_dir}/ckpt")
    keys = sorted(r.Data["user_id"] for r in read_ndjson_records(spark, f"{tmp_dir}/out").collect())
    assert keys == ["1", "2"] and run.metrics.records_written == 2


def test_streams_share_dedup_state_across_sources(spark, tmp_dir):
    from strata.streaming.records import StreamSource, run_record_streams
    for name, text in (("a", "user_id,email\n1,x\n2,y\n"), ("b", "user_id,email,extra\n2,z,q\n3,w,r\n")):
        os.makedirs(f"{tmp_dir}/{name}")
        _write(f"{tmp_dir}/{name}/f.csv", text)
    flow = RecordFlow.from_config([{"name": "d", "operation": "deduplicate",
                                    "config": {"key_field": "user_id"}}])
    run = run_record_streams(spark, [StreamSource("a", f"{tmp_dir}/a", ["user_id", "email"]),
                                     StreamSource("b", f"{tmp_dir}/b", ["user_id", "email", "extra"])],
                             flow, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    keys = sorted(r.Data["user_id"] for r in read_ndjson_records(spark, f"{tmp_dir}/out").collect())
    assert keys == ["1", "2", "3"] and run.metrics.records_read == 4


def test_stream_batches_by_bytes(spark, tmp_dir):
    from strata.streaming.records import StreamSource, run_record_streams
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    for i in range(3):
        _write(f"{src}/{i}.csv", "user_id,email\n" + "".join(f"{i}{j},e\n" for j in range(50)))
    run = run_record_streams(spark, [StreamSource("s", src, ["user_id", "email"])], RecordFlow(),
                             f"{tmp_dir}/out", f"{tmp_dir}/ckpt", max_bytes_per_trigger=500)
    assert run.metrics.records_read == 150 and run.metrics.batches_processed == 3


def _rows(spark, path):
    return sorted((sorted(r.Data.items()) for r in read_ndjson_records(spark, path).collect()))


def test_each_file_of_a_stream_has_its_own_header(spark, tmp_dir):
    """Other orders, other columns, files in one trigger and in a later one, by config too."""
    from strata.plans.records import run_from_config
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    _write(f"{src}/1.csv", "id,email\n1,a@x\n")
    _write(f"{src}/2.csv", "\nemail,id,note\nb@x,2,\"n,m\"\nbad,line\n")
    config = {"sources": [{"name": "s", "type": "csv", "location": src, "properties": {}}],
              "transforms": [{"name": "d", "operation": "deduplicate", "config": {"key_field": "id"}}],
              "destination": {"type": "jsonfile", "connection_string": f"{tmp_dir}/out"},
              "pipeline": {"dead_letter_path": f"{tmp_dir}/dead", "max_files_per_trigger": 10}}
    m = run_from_config(spark, config, stream=True, checkpoint=f"{tmp_dir}/ckpt")
    want = [[("email", "a@x"), ("id", "1")], [("email", "b@x"), ("id", "2"), ("note", "n,m")]]
    assert _rows(spark, f"{tmp_dir}/out") == want
    assert (m.records_read, m.records_written, m.records_rejected) == (3, 2, 1)
    assert [r._corrupt_record for r in spark.read.parquet(f"{tmp_dir}/dead").collect()] == ["bad,line"]
    _write(f"{src}/3.csv", "new,id\nq,3\nq,1\n")
    m = run_from_config(spark, config, stream=True, checkpoint=f"{tmp_dir}/ckpt")
    assert _rows(spark, f"{tmp_dir}/out") == [*want, [("id", "3"), ("new", "q")]]
    assert (m.records_read, m.records_written, m.records_filtered) == (2, 1, 1)


def test_late_rows_go_to_the_dead_letter(spark, tmp_dir):
    from strata.streaming.records import StreamSource, run_record_streams
    os.makedirs(f"{tmp_dir}/in")
    _write(f"{tmp_dir}/in/1.csv", "k,at\na,2024-01-05 00:00:00\n")
    flow = RecordFlow().normalize("n", ["k"]).deduplicate("d", "k", event_time="at", watermark="1 hour")
    args = (spark, [StreamSource("s", f"{tmp_dir}/in")], flow, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    run_record_streams(*args, dead_letter_path=f"{tmp_dir}/dead")
    # on the watermark: late; just after: kept; a late row without the key: kept; one without a time: not
    _write(f"{tmp_dir}/in/2.csv", "at,k\n2024-01-04 23:00:00,b\n2024-01-04 23:00:01,c\nnever,e\n")
    _write(f"{tmp_dir}/in/3.csv", "at\n2020-01-01 00:00:00\n")
    m = run_record_streams(*args, dead_letter_path=f"{tmp_dir}/dead", max_files_per_trigger=5).metrics
    assert (m.records_read, m.records_written, m.records_filtered, m.records_rejected) == (4, 2, 0, 2)
    dead = spark.read.parquet(f"{tmp_dir}/dead")
    assert sorted((r.fields["k"], r._error) for r in dead.collect()) == \
        [("b", "later than the watermark"), ("e", "no time in field 'at'")]
    assert sorted(r.Data.get("k", "") for r in read_ndjson_records(spark, f"{tmp_dir}/out").collect()) == ["", "a", "c"]


def test_rows_without_the_key_leave_no_state(spark, tmp_dir):
    from strata.streaming.records import StreamSource, run_record_streams
    os.makedirs(f"{tmp_dir}/in")
    _write(f"{tmp_dir}/in/1.csv", "k,v\n" + "".join(f"{i},x\n" for i in range(5)))
    _write(f"{tmp_dir}/in/2.csv", "v\n" + "y\n" * 400)
    run = run_record_streams(spark, [StreamSource("s", f"{tmp_dir}/in")], RecordFlow().deduplicate("d", "k"),
                             f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    assert run.metrics.records_written == 405
    assert spark.read.format("statestore").load(f"{tmp_dir}/ckpt/stream-1").count() == 5


def test_two_deduplications_and_stages_between(spark, tmp_dir):
    from strata.streaming.records import StreamSource, run_record_streams
    os.makedirs(f"{tmp_dir}/in")
    _write(f"{tmp_dir}/in/1.csv", "a,b\n1,X\n1,Y\n2,x\n3,z\n")
    flow = (RecordFlow().deduplicate("d", "a").normalize("n", ["b"]).filter("f", "b", "neq", "z").deduplicate("e", "b"))
    m = run_record_streams(spark, [StreamSource("s", f"{tmp_dir}/in")], flow, f"{tmp_dir}/out", f"{tmp_dir}/ckpt").metrics
    rows = [r.Data for r in read_ndjson_records(spark, f"{tmp_dir}/out").collect()]
    assert len({r["a"] for r in rows}) == len(rows) == len({r["b"] for r in rows}) and {r["b"] for r in rows} <= {"x", "y"}
    assert m.records_read == 4 and m.records_written == len(rows) and m.records_filtered == 4 - len(rows)


def test_a_batch_run_again_changes_nothing(spark, tmp_dir):
    from strata.streaming.records import StreamSource, forget_last_commits, run_record_streams
    os.makedirs(f"{tmp_dir}/in")
    for i in range(3):
        _write(f"{tmp_dir}/in/{i}.csv", "k,at\n" + "".join(f"{j},2024-01-0{i + 1} 00:00:00\n" for j in range(10)))
    for flow, out in ((RecordFlow(), "plain"), (RecordFlow().deduplicate("d", "k"), "dedup"),
                      (RecordFlow().deduplicate("d", "k", event_time="at", watermark="1 day"), "late")):
        args = (spark, [StreamSource("s", f"{tmp_dir}/in")], flow, f"{tmp_dir}/{out}", f"{tmp_dir}/ckpt-{out}",
                f"{tmp_dir}/dead-{out}")
        run_record_streams(*args, keep_published=True)
        before = _rows(spark, f"{tmp_dir}/{out}")
        assert forget_last_commits(spark, f"{tmp_dir}/ckpt-{out}") == len(flow.segments())
        run_record_streams(*args, keep_published=True)
        assert _rows(spark, f"{tmp_dir}/{out}") == before and len(before) == (30 if out == "plain" else 10)


def test_stream_on_an_interval(spark, tmp_dir):
    from strata.streaming.records import StreamSource, run_record_streams
    os.makedirs(f"{tmp_dir}/in")
    for i in range(2):
        _write(f"{tmp_dir}/in/{i}.csv", "k\n" + "".join(f"{j}\n" for j in range(i, 10)))
    run = run_record_streams(spark, [StreamSource("s", f"{tmp_dir}/in")], RecordFlow().deduplicate("d", "k"),
                             f"{tmp_dir}/out", f"{tmp_dir}/ckpt", processing_time="1 second", timeout_s=120,
                             stop_when_idle=True)
    assert run.metrics.records_read == 19 and run.metrics.records_written == 10 and run.metrics.batches_processed == 2
