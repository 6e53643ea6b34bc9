import json

from strata.config import DEFAULT_CONFIG, deep_merge, load_config


def test_deep_merge_keeps_siblings():
    base = {"spark": {"config": {"a": 1, "b": 2}}, "x": [1]}
    out = deep_merge(base, {"spark": {"config": {"b": 3}}, "x": [2]})
    assert out == {"spark": {"config": {"a": 1, "b": 3}}, "x": [2]}
    assert base["spark"]["config"]["b"] == 2


def test_load_config_with_env_overlay(tmp_path):
    (tmp_path / "base.json").write_text(json.dumps({"layers": {"bronze": {"path": "/b"}}}))
    (tmp_path / "dev.yaml").write_text("layers:\n  silver:\n    path: /s\n")
    cfg = load_config(str(tmp_path / "base.json"), env="dev", overrides={"segments": {"power_events": 5}})
    assert cfg["layers"]["bronze"]["path"] == "/b" and cfg["layers"]["silver"]["path"] == "/s"
    assert cfg["layers"]["silver"]["merge_key"] == DEFAULT_CONFIG["layers"]["silver"]["merge_key"]
    assert cfg["segments"] == {"power_events": 5, "power_types": 5, "active_events": 10}


def test_lakehouse_cli_end_to_end(spark, tmp_path):
    """The job entry point over small raw files, all three layers."""
    from strata.plans import catalog
    from strata.plans.lakehouse import main
    cfg = catalog.job_config(spark, "/root/testdata/sf0.001")
    cfg["quality"]["fail_on_error"] = False
    path = tmp_path / "job.json"
    path.write_text(json.dumps(cfg))
    from strata.sinks import tables
    assert main(["--config", str(path), "--date", "2001-09-01"]) == 0
    silver = f"{cfg['layers']['silver']['path']}/events"
    gold = f"{cfg['layers']['gold']['path']}/daily_summary"
    first = (tables.read_version(spark, silver).count(),
             tables.read_version(spark, gold).groupBy().sum("event_count").first()[0])
    # a rerun of silver and gold upserts the same events: nothing doubles
    assert main(["--config", str(path), "--layers", "silver", "gold"]) == 0
    again = (tables.read_version(spark, silver).count(),
             tables.read_version(spark, gold).groupBy().sum("event_count").first()[0])
    assert again == first
    assert [h["kind"] for h in tables.history(spark, silver)][-1] == "snapshot"
