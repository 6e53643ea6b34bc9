"""Validation: rule semantics, order-dependent counts, quarantine, report."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import (DataQualityError, QualityCheck, QualityEngine,
                                      run_checks)

SCHEMA = "id long, email string, amount double, event_date string"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_unknown_rule_and_severity_raise():
    with pytest.raises(ValueError):
        QualityCheck("x", "c", "between")
    with pytest.raises(ValueError):
        QualityCheck("x", "c", "not_null", severity="fatal")


def test_null_passes_regex_and_lte_but_fails_greater_than(spark):
    df = _frame(spark, [(1, None, None, None)])
    checks = [{"name": "re", "column": "email", "rule": "regex", "pattern": "@", "severity": "critical"},
              {"name": "le", "column": "event_date", "rule": "less_than_or_equal",
               "value": "DATE '2024-01-01'", "severity": "critical"},
              {"name": "gt", "column": "amount", "rule": "greater_than", "value": 0,
               "severity": "critical"}]
    v = run_checks(df, checks)
    report = {r["check"]: r["failing_rows"] for r in v.report()}
    assert report == {"re": 0, "le": 0, "gt": 1}
    assert v.quarantine.collect()[0]._quality_check == "gt"


def test_pattern_is_literal(spark):
    df = _frame(spark, [(1, "a@b-com", 1.0, None), (2, "a@b.com", 1.0, None), (3, "it's", 1.0, None)])
    checks = [{"name": "re", "column": "email", "rule": "regex", "pattern": r"^[a-z]+@[a-z]+\.com$"},
              {"name": "quote", "column": "email", "rule": "regex", "pattern": "'"}]
    rep = {r["check"]: r["failing_rows"] for r in run_checks(df, checks).report()}
    assert rep == {"re": 2, "quote": 2}


def test_string_date_column_against_date_bound(spark):
    df = _frame(spark, [(1, None, 1.0, "2024-01-02"), (2, None, 1.0, "2023-12-31"),
                        (3, None, 1.0, "not a date")])
    checks = [{"name": "le", "column": "event_date", "rule": "less_than_or_equal",
               "value": "current_date()", "severity": "warning"}]
    rep = run_checks(df, checks, as_of="2024-01-01").report()
    assert rep[0]["failing_rows"] == 1


def test_row_failing_two_critical_checks_goes_to_first(spark):
    df = _frame(spark, [(None, None, -1.0, None), (2, None, 5.0, None)])
    checks = [{"name": "ids", "column": "id", "rule": "not_null", "severity": "critical"},
              {"name": "pos", "column": "amount", "rule": "greater_than", "value": 0,
               "severity": "critical"}]
    v = run_checks(df, checks)
    assert [r._quality_check for r in v.quarantine.collect()] == ["ids"]
    rep = {r["check"]: r["failing_rows"] for r in v.report()}
    assert rep == {"ids": 1, "pos": 0}
    assert all(r["total_rows"] == 2 for r in v.report())


def test_missing_column_skipped_or_error(spark):
    df = _frame(spark, [(1, None, 1.0, None)])
    checks = [{"name": "nope", "column": "zzz", "rule": "not_null"}]
    rep = run_checks(df, checks).report()
    assert rep[0]["status"] == "skipped" and rep[0]["failing_rows"] is None
    with pytest.raises(ValueError):
        run_checks(df, checks, on_missing="error")


def test_tables_scope(spark):
    df = _frame(spark, [(1, None, 1.0, None)])
    checks = [{"name": "only_tx", "column": "amount", "rule": "greater_than", "value": 5,
               "tables": ["transactions"]}]
    assert run_checks(df, checks, table="events").report() == []
    assert run_checks(df, checks, table="transactions").report()[0]["failing_rows"] == 1


def test_unique_counts_duplicated_keys_and_null_group(spark):
    df = _frame(spark, [(1, "a", 1.0, None), (1, "b", 1.0, None), (None, "c", 1.0, None),
                        (None, "d", 1.0, None), (3, "e", 1.0, None)])
    checks = [{"name": "u", "column": "id", "rule": "unique", "severity": "critical"}]
    v = run_checks(df, checks)
    assert v.report()[0]["failing_rows"] == 2
    assert v.clean.count() == 5  # unique never removes rows


def test_report_frame_equals_report(spark):
    df = _frame(spark, [(i, "x@y.z" if i % 3 else "bad", float(i % 5) - 1, None) for i in range(40)])
    checks = [{"name": "pos", "column": "amount", "rule": "greater_than", "value": 0, "severity": "critical"},
              {"name": "mail", "column": "email", "rule": "regex", "pattern": "@"},
              {"name": "u", "column": "amount", "rule": "unique"}]
    v = run_checks(df, checks)
    frame = {r["check"]: (r["failing_rows"], r["pass_rate"]) for r in v.report_frame().collect()}
    assert frame == {r["check"]: (r["failing_rows"], r["pass_rate"]) for r in v.report()}


def _model(rows, checks):
    """The sequential reading: one pass per check over the rows still left."""
    total, alive, counts, quarantined = len(rows), list(rows), [], []
    for c in checks:
        col = c["column"]
        if c["rule"] == "unique":
            seen = {}
            for r in alive:
                seen[r[col]] = seen.get(r[col], 0) + 1
            counts.append(sum(1 for n in seen.values() if n > 1))
            continue
        if c["rule"] == "not_null":
            fail = lambda r: r[col] is None
        elif c["rule"] == "greater_than":
            fail = lambda r: r[col] is None or r[col] <= c["value"]
        elif c["rule"] == "regex":
            fail = lambda r: r[col] is not None and re.search(c["pattern"], r[col]) is None
        else:
            fail = lambda r: r[col] is not None and r[col] > c["value"]
        bad = [r for r in alive if fail(r)]
        counts.append(len(bad))
        if c["severity"] == "critical":
            quarantined += [(r["id"], c["name"]) for r in bad]
            alive = [r for r in alive if not fail(r)]
    return total, counts, sorted(r["id"] for r in alive), sorted(quarantined)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_single_pass_matches_sequential_model(spark, seed):
    rnd = random.Random(seed)
    rows = [{"id": i,
             "k": rnd.choice([None, "a", "b", "c", "d"]),
             "email": rnd.choice([None, "x@y.z", "nope", "a@b"]),
             "amount": rnd.choice([None, -1.0, 0.0, 2.5, 10.0]),
             "score": rnd.choice([None, 1, 5, 9])} for i in range(300)]
    rules = [
        {"rule": "not_null", "column": "k"},
        {"rule": "greater_than", "column": "amount", "value": 0},
        {"rule": "regex", "column": "email", "pattern": "@"},
        {"rule": "less_than_or_equal", "column": "score", "value": 5},
        {"rule": "unique", "column": "k"},
    ]
    checks = []
    for i in range(6):
        c = dict(rnd.choice(rules))
        c.update(name=f"c{i}", severity=rnd.choice(["critical", "warning"]))
        checks.append(c)
    df = spark.createDataFrame([(r["id"], r["k"], r["email"], r["amount"], r["score"]) for r in rows],
                               "id long, k string, email string, amount double, score long")
    v = run_checks(df, checks)
    total, counts, alive, quarantined = _model(rows, checks)
    rep = v.report()
    assert [r["failing_rows"] for r in rep] == counts
    assert all(r["total_rows"] == total for r in rep)
    assert sorted(r.id for r in v.clean.collect()) == alive
    assert sorted((r.id, r._quality_check) for r in v.quarantine.collect()) == quarantined


def test_engine_writes_quarantine_then_raises(spark, tmp_dir):
    df = _frame(spark, [(1, None, -1.0, None), (2, None, 3.0, None)])
    cfg = {"quarantine_path": f"{tmp_dir}/q", "fail_on_error": True,
           "checks": [{"name": "pos", "column": "amount", "rule": "greater_than", "value": 0,
                       "severity": "critical"}]}
    with pytest.raises(DataQualityError) as err:
        QualityEngine(cfg).validate(df, "events")
    assert err.value.report[0]["failing_rows"] == 1
    q = spark.read.parquet(f"{tmp_dir}/q/events/")
    assert [(r.id, r._quality_check) for r in q.collect()] == [(1, "pos")]


def test_engine_without_quarantine_returns_clean(spark):
    df = _frame(spark, [(1, None, -1.0, None), (2, None, 3.0, None)])
    cfg = {"checks": [{"name": "pos", "column": "amount", "rule": "greater_than", "value": 0,
                       "severity": "critical"},
                      {"name": "u", "column": "id", "rule": "unique", "severity": "critical"}]}
    clean, report = QualityEngine(cfg).validate(df)
    assert [r.id for r in clean.collect()] == [2]
    assert [r["failing_rows"] for r in report] == [1, 0]
    assert report[0]["pass_rate"] == 50.0


def test_tag_warnings(spark):
    df = _frame(spark, [(1, "bad", 1.0, None)])
    v = run_checks(df, [{"name": "mail", "column": "email", "rule": "regex", "pattern": "@"}],
                   tag_warnings=True)
    assert v.clean.collect()[0]._warnings == ["mail"]


def test_engine_quarantine_with_unique_check(spark, tmp_dir):
    df = _frame(spark, [(1, None, -1.0, None), (2, None, 3.0, None), (2, None, 4.0, None)])
    cfg = {"quarantine_path": f"{tmp_dir}/q",
           "checks": [{"name": "pos", "column": "amount", "rule": "greater_than", "value": 0,
                       "severity": "critical"},
                      {"name": "u", "column": "id", "rule": "unique", "severity": "warning"}]}
    clean, report = QualityEngine(cfg).validate(df, "t")
    assert [r["failing_rows"] for r in report] == [1, 1]
    assert sorted(r.id for r in clean.collect()) == [2, 2]
    assert spark.read.parquet(f"{tmp_dir}/q/t/").count() == 1


def test_pass_rate_rounds_half_up_in_both_forms(spark):
    # 3 failing of 8 -> 62.5 exactly; 27 of 80 -> 66.25; 3 of 800 -> 99.625 (a tie)
    rows = [(i, None, -1.0 if i < 3 else 1.0, None) for i in range(800)]
    v = run_checks(_frame(spark, rows), [{"name": "pos", "column": "amount",
                                          "rule": "greater_than", "value": 0}])
    assert v.report()[0]["pass_rate"] == 99.63
    assert v.report_frame().first().pass_rate == 99.63


def test_stored_validation_reads_its_input_once(spark, tmp_path):
    """Same report, clean rows and quarantine; the input is computed by one job."""
    rows = [(i, "" if i % 5 == 0 else "x", None if i % 7 == 0 else float(i), i % 10) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, s string, amount double, k int").repartition(3)
    runs = spark.sparkContext.accumulator(0)
    checks = [{"name": "amount known", "column": "amount", "rule": "not_null", "severity": "critical"},
              {"name": "s/filled", "column": "s", "rule": "regex", "pattern": "x", "severity": "critical"},
              {"name": "k_once", "column": "k", "rule": "unique"},
              {"name": "small", "column": "amount", "rule": "less_than_or_equal", "value": 100},
              {"name": "id_once", "column": "id", "rule": "unique"}]

    def counted(it):
        for b in it:
            runs.add(b.num_rows)
            yield b

    results = []
    for store in (False, True):
        engine = QualityEngine({"checks": checks, "quarantine_path": str(tmp_path / f"q{store}")})
        runs.value = 0
        clean, report = engine.validate(df.mapInArrow(counted, df.schema), "t", store=store)
        kept = sorted(r.id for r in clean.collect())
        bad = sorted((r.id, r._quality_check) for r in spark.read.parquet(str(tmp_path / f"q{store}" / "t")).collect())
        results.append((report, kept, bad, clean.columns))
    assert results[0] == results[1] and runs.value == 200
    assert len(results[0][2]) == 63


@pytest.mark.parametrize("store", [False, True])
def test_sieved_unique_check_counts_like_the_plain_one(spark, store):
    rows = [(i % 7 if i < 20 else None if i < 23 else i, None, -1.0 if i % 5 == 0 else 1.0, None) for i in range(60)]
    df = _frame(spark, rows)
    checks = [{"name": "u0", "column": "id", "rule": "unique"},
              {"name": "pos", "column": "amount", "rule": "greater_than", "value": 0, "severity": "critical"},
              {"name": "u1", "column": "id", "rule": "unique"}]
    sieved = [c | {"sieve": True} if c["rule"] == "unique" else c for c in checks]

    def report(cs):
        v = run_checks(df, cs)
        return (v.stored() if store else v).report()

    assert report(sieved) == report(checks)
    assert [r["failing_rows"] for r in report(sieved)] == [8, 12, 8]
