"""The lakehouse job on small hand-made raw files: incremental silver."""

import json

from strata.config import load_config
from strata.plans import catalog, lakehouse
from strata.sinks import tables


def _events(path, rows):
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def _ev(i, cust, ts, typ="click"):
    return {"event_id": str(i), "customer_id": cust, "event_type": typ,
            "event_date": ts[:10], "event_timestamp": ts, "properties": '{"session_id": "s"}'}


def test_silver_reads_only_new_bronze_versions(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "e1").mkdir(parents=True)
    (raw / "e2").mkdir()
    (raw / "c").mkdir()
    _events(raw / "e1" / "a.json", [_ev(1, "c1", "2024-01-01T10:00:00"),
                                    _ev(2, "c2", "2024-01-02T10:00:00")])
    (raw / "c" / "c.csv").write_text(
        "customer_id,first_name,last_name,email,region,signup_date,status\n"
        "c1,A,B,a@b.co,EU,2020-01-01,active\nc2,C,D,c@d.co,AS,2020-01-01,active\n")
    lake = tmp_path / "lake"
    cfg = load_config(overrides={
        "sources": {"raw_events": {"format": "json", "path": str(raw / "e1"),
                                   "partition_columns": ["event_date"]},
                    "raw_customers": {"format": "csv", "path": str(raw / "c")}},
        "events": {"property_keys": ["session_id"]},
        "layers": {"bronze": {"path": str(lake / "b")}, "silver": {"path": str(lake / "s")},
                   "gold": {"path": str(lake / "g")}},
        "quality": {"quarantine_path": str(lake / "q")}})
    first = lakehouse.run(spark, cfg, as_of="2024-02-01")
    assert first["status"] == "success"
    assert first["layers"]["silver"]["events"]["full_read"] is True

    # a second delivery: one new event and a later version of event 2
    _events(raw / "e2" / "b.json", [_ev(3, "c1", "2024-01-02T11:00:00"),
                                    _ev(2, "c2", "2024-01-02T12:00:00", typ="view")])
    cfg["sources"]["raw_events"]["path"] = str(raw / "e2")
    second = lakehouse.run(spark, cfg, as_of="2024-02-01")
    ev = second["layers"]["silver"]["events"]
    assert ev["full_read"] is False and ev["mode"] == "merge (partitions)"
    assert (ev["rows_inserted"], ev["rows_updated"]) == (1, 1)
    silver = {r.event_id: r.event_type for r in
              tables.read_version(spark, str(lake / "s" / "events")).collect()}
    assert silver == {"1": "click", "2": "view", "3": "click"}
    cust = {r.customer_id: r.total_events for r in
            tables.read_version(spark, str(lake / "s" / "customers")).collect()}
    assert cust == {"c1": 2, "c2": 1}
    daily = tables.read_version(spark, str(lake / "g" / "daily_summary"))
    assert daily.groupBy().sum("event_count").first()[0] == 3

    # nothing new: silver events are left alone
    third = lakehouse.run(spark, cfg, layers=["silver"], as_of="2024-02-01")
    assert third["layers"]["silver"]["events"]["mode"] == "no new bronze rows"


def _lake(tmp_path, name, transactions=None):
    lake = tmp_path / name
    (tmp_path / "c").mkdir(exist_ok=True)
    (tmp_path / "c" / "c.csv").write_text("customer_id,first_name,last_name,email,region,signup_date,status\n"
                                          "c1,A,B,a@b.co,EU,2020-01-01,active\n")
    return load_config(overrides={
        "sources": {"raw_events": {"format": "json", "path": None, "partition_columns": ["event_date"]},
                    "raw_customers": {"format": "csv", "path": str(tmp_path / "c")},
                    "raw_transactions": {"format": "parquet", "path": transactions}},
        "layers": {x: {"path": str(lake / x)} for x in ("bronze", "silver", "gold")}})


def test_silver_does_not_depend_on_the_cut_of_deliveries(spark, tmp_path):
    rows = [_ev(1, "c1", "2024-01-01T12:00:00", "newer"), _ev(1, "c1", "2024-01-01T10:00:00", "stale"),
            _ev(2, "c1", "2024-01-01T10:00:00"), _ev(2, "c1", "2024-01-03T10:00:00", "moved"),
            {**_ev(3, "c1", "2024-01-02T10:00:00"), "event_date": None}, _ev(4, "c1", "2024-01-02T09:00:00", "x"),
            _ev(4, "c1", "2024-01-02T09:00:00", "y"), _ev(5, "c1", "2024-01-02T08:00:00")]
    results = []
    for n, cut in enumerate(([rows], [rows[:1], rows[1:]], [rows[::2], rows[1::2]], [rows[1::2], rows[::2]])):
        cfg = _lake(tmp_path, f"lake{n}")
        for k, part in enumerate(cut):
            folder = tmp_path / f"e{n}-{k}"
            folder.mkdir()
            _events(folder / "a.json", part)
            cfg["sources"]["raw_events"]["path"] = str(folder)
            assert lakehouse.run(spark, cfg, as_of="2024-02-01",
                                 ingested_at="2024-01-09 00:00:00")["status"] == "success"
        silver = tables.read_version(spark, cfg["layers"]["silver"]["path"] + "/events")
        results.append(sorted((r.event_id, r.event_type, r.event_date or "") for r in silver.collect()))
    assert all(r == results[0] for r in results)
    assert results[0][0] == ("1", "newer", "2024-01-01") and results[0][1] == ("2", "moved", "2024-01-03")
    assert [r[0] for r in results[0]] == ["1", "2", "3", "4", "5"]


def test_transactions_are_read_once(spark, tmp_path):
    src = str(tmp_path / "tx")
    schema = "txn_id string, customer_id string, amount double, txn_date date, status string"
    cfg = _lake(tmp_path, "lake", src)
    (tmp_path / "e").mkdir()
    _events(tmp_path / "e" / "a.json", [_ev(1, "c1", "2024-01-01T12:00:00")])
    cfg["sources"]["raw_events"]["path"] = str(tmp_path / "e")
    for day, full in ((1, True), (2, False)):
        spark.createDataFrame([(f"t{day}", "c1", 0.004, None, "F")] * 3, schema).write.mode("overwrite").parquet(src)
        res = lakehouse.run(spark, cfg, as_of="2024-02-01")["layers"]["silver"]["transactions"]
        assert (res["rows_written"], res["full_read"]) == (3, full)
    silver = tables.read_version(spark, cfg["layers"]["silver"]["path"] + "/transactions")
    assert silver.count() == 6
    clv = tables.read_version(spark, cfg["layers"]["gold"]["path"] + "/customer_clv").first()
    assert abs(clv.lifetime_spend - 0.024) < 1e-12 and clv.transaction_count == 6
    again = lakehouse.run(spark, cfg, ["silver"])["layers"]["silver"]["transactions"]
    assert again["mode"] == "no new bronze rows"


def _gold(spark, cfg):
    daily = tables.read_version(spark, cfg["layers"]["gold"]["path"] + "/daily_summary")
    cust = tables.read_version(spark, cfg["layers"]["silver"]["path"] + "/customers")
    return (sorted(tuple(str(x) for x in r) for r in daily.select(
                "event_date", "event_type", "region", "event_count", "unique_customers", "unique_sessions").collect()),
            sorted(tuple(str(x) for x in r) for r in cust.select(
                "customer_id", "first_name", "region", "total_events", "distinct_event_types", "first_event_at",
                "last_event_at", "segment").collect()))


def _deliver(spark, tmp_path, cfg, n, events, customers):
    for name, rows in (("e", events), ("c", customers)):
        source = "raw_events" if name == "e" else "raw_customers"
        cfg["sources"][source]["path"] = None
        if rows:
            folder = tmp_path / f"{name}{n}"
            folder.mkdir(exist_ok=True)
            if name == "e":
                _events(folder / "a.json", rows)
            else:
                (folder / "a.csv").write_text("customer_id,first_name,last_name,email,region,signup_date,status\n" + "".join(
                    f"{i},{first},B,a@b.co,{region},2020-01-01,active\n" for i, first, region in rows))
            cfg["sources"][source]["path"] = str(folder)


DELIVERIES = [
    ([_ev(1, "c1", "2024-01-01T12:00:00"), _ev(2, "c2", "2024-01-02T10:00:00"), _ev(3, "c3", "2024-01-03T10:00:00"),
      {**_ev(4, "c1", "2024-01-04T10:00:00", "view"), "event_date": "2024-01-03"}],
     [("c1", "A", "EU"), ("c2", "C", "AS"), ("c3", "E", "AS")]),
    ([_ev(2, "c1", "2024-01-05T10:00:00"), _ev(5, "c2", "2024-01-03T09:00:00", "buy")], []),  # moved: day, customer
    ([], [("c3", "E", "EU"), ("c4", "F", "EU")]),  # another region, a new customer
    ([_ev(6, "c4", "2024-01-03T11:00:00")], [("c1", "A2", "EU")]),
    ([], []),
]


def test_incremental_customers_and_gold_equal_full_runs(spark, tmp_path):
    """After every delivery the tables equal those of a lake that got all rows at once."""
    cfg = _lake(tmp_path, "lake")
    modes = []
    for n, (events, customers) in enumerate(DELIVERIES):
        _deliver(spark, tmp_path, cfg, n, events, customers)
        res = lakehouse.run(spark, cfg, as_of="2024-02-01", ingested_at=f"2024-01-1{n} 00:00:00")["layers"]
        modes.append((res["silver"]["customers"].get("full_read"), res["gold"]["daily_summary"].get("full_read")))
        if n not in (2, 3):
            continue
        fresh = _lake(tmp_path, f"fresh{n}")
        for k in range(n + 1):
            _deliver(spark, tmp_path, fresh, k, *DELIVERIES[k])
            lakehouse.run(spark, fresh, ["bronze"], ingested_at=f"2024-01-1{k} 00:00:00")
        lakehouse.run(spark, fresh, ["silver", "gold"], as_of="2024-02-01")
        assert _gold(spark, cfg) == _gold(spark, fresh)
    assert modes == [(True, True), (False, False), (False, False), (False, False), (None, None)]


def test_unchanged_days_keep_their_files(spark, tmp_path):
    cfg = _lake(tmp_path, "lake")

    def files():
        rows = tables.read_version(spark, cfg["layers"]["gold"]["path"] + "/daily_summary").inputFiles()
        return {f.split("event_date=")[1].split("/")[0]: f for f in rows}

    _deliver(spark, tmp_path, cfg, 0, *DELIVERIES[0])
    lakehouse.run(spark, cfg, as_of="2024-02-01", ingested_at="2024-01-10 00:00:00")
    first = files()
    _deliver(spark, tmp_path, cfg, 1, *DELIVERIES[1])
    lakehouse.run(spark, cfg, as_of="2024-02-01", ingested_at="2024-01-11 00:00:00")
    second = files()
    assert set(first) - set(second) == {"2024-01-02"} and first["2024-01-01"] == second["2024-01-01"]
    assert second["2024-01-03"] != first["2024-01-03"] and "2024-01-05" in second


def test_tables_out_of_step_are_computed_in_full(spark, tmp_path):
    """Other thresholds, and daily metrics lost between two runs."""
    import shutil
    cfg = _lake(tmp_path, "lake")
    _deliver(spark, tmp_path, cfg, 0, *DELIVERIES[0])
    lakehouse.run(spark, cfg, as_of="2024-02-01", ingested_at="2024-01-10 00:00:00")
    cfg["segments"] = {"active_events": 1}
    for source in ("raw_events", "raw_customers"):
        cfg["sources"][source]["path"] = None
    res = lakehouse.run(spark, cfg, ["silver"], as_of="2024-02-01")["layers"]["silver"]["customers"]
    assert res["full_read"] and {r[1][-1] for r in enumerate(_gold(spark, cfg)[1])} == {"active"}
    moved = str(tmp_path / "lost")
    shutil.move(cfg["layers"]["silver"]["path"] + "/customer_daily", moved)
    _deliver(spark, tmp_path, cfg, 1, *DELIVERIES[1])
    res = lakehouse.run(spark, cfg, as_of="2024-02-01", ingested_at="2024-01-11 00:00:00")["layers"]
    assert res["silver"]["customers"]["full_read"] and res["gold"]["daily_summary"]["full_read"]
    assert [r[3] for r in _gold(spark, cfg)[1]] == ["3", "1", "1"]


def test_json_is_parsed_once(spark, tmp_path):
    from strata.schemas import EVENT_SCHEMA
    from strata.sources import files
    _events(tmp_path / "a.json", [_ev(1, "c1", "2024-01-01T12:00:00")])
    with open(tmp_path / "a.json", "a") as f:
        f.write("broken\n")
    clean, corrupt = files.staged_split(files.read_json_lines(spark, str(tmp_path / "a.json"), EVENT_SCHEMA))
    assert (clean.count(), corrupt.count()) == (1, 1) and "_corrupt_record" not in clean.columns
    for part in (clean, corrupt):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "FileScan parquet" in plan


def test_deliveries_write_no_events_that_no_run_reads(spark, monkeypatch):
    monkeypatch.setattr(catalog.fixtures, "write_event_json", None)
    config = catalog._run_deliveries(spark, "/root/testdata/sf0.001", ())
    assert "delivery1" in config["sources"]["raw_events"]["path"]
