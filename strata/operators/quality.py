"""Data quality checks in one pass, with quarantine and a report.

Checks run in list order, as a sequential reading would: a critical row
check removes its failing rows, so a later check counts only rows still
left, while ``total_rows`` stays the input count. Instead of one scan per
check, every row check becomes a flag column and a single aggregate counts
``flag_i AND NOT (earlier critical flags)``. A row goes to quarantine under
the first critical check it fails. ``unique`` checks count duplicated keys
(a NULL key group included) among rows left at their position and never
remove rows. The row checks are one scan and one row per task; each unique
check reads its key and the columns that decide whether a row is still left,
and is reduced to one row. No row is shuffled for the row checks. A unique
check with ``sieve: true`` shuffles digests instead of its keys, and full keys
only where a digest repeats: for wide keys that should be unique.

Decisions: NULL passes ``regex`` and ``less_than_or_equal`` (and is kept);
patterns are taken literally; a string column compared with a date bound is
read with ``try_cast``; a check whose column is missing is reported as
skipped (or raises with ``on_missing="error"``).
"""

from __future__ import annotations

import datetime as _dt
from decimal import ROUND_HALF_UP, Decimal
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import duplicate_keys
from strata.session import scratch_path

RULES = ("not_null", "regex", "greater_than", "less_than_or_equal", "unique")
SEVERITIES = ("critical", "warning")
CHECK_COL = "_quality_check"
QUARANTINE_TS = "_quarantine_ts"


class DataQualityError(Exception):
    """Critical checks failed and the engine was told to stop."""

    def __init__(self, message: str, report: list[dict] | None = None):
        super().__init__(message)
        self.report = report or []


@dataclass(frozen=True)
class QualityCheck:
    name: str
    column: str
    rule: str
    severity: str = "warning"
    params: Mapping[str, object] = field(default_factory=dict)
    tables: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.rule not in RULES:
            raise ValueError(f"check {self.name!r} has rule {self.rule!r}; the rules are {', '.join(RULES)}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"Unknown severity: {self.severity}")

    @classmethod
    def from_dict(cls, d: Mapping[str, object]) -> "QualityCheck":
        known = {"name", "column", "rule", "severity", "tables"}
        tables = d.get("tables")
        return cls(name=str(d["name"]), column=str(d["column"]), rule=str(d["rule"]),
                   severity=str(d.get("severity", "warning")),
                   params={k: v for k, v in d.items() if k not in known},
                   tables=tuple(tables) if tables else None)

    @property
    def is_row_check(self) -> bool:
        return self.rule != "unique"

    def applies_to(self, table: str | None) -> bool:
        return table is None or self.tables is None or table in self.tables

    def failing(self, df: DataFrame, as_of: str | None = None) -> Column:
        """Condition true on failing rows (may be NULL; callers coalesce)."""
        c = df[self.column]
        if self.rule == "not_null":
            return c.isNull()
        if self.rule == "regex":
            return ~c.rlike(str(self.params.get("pattern", ".*")))
        if self.rule == "greater_than":
            return (c <= _bound(self.params.get("value", 0), as_of)) | c.isNull()
        if self.rule == "less_than_or_equal":
            bound = _bound(self.params.get("value", 0), as_of)
            return _aligned(df, c, self.column, bound) > bound
        raise ValueError(f"rule {self.rule} has no row condition")


def _bound(value: object, as_of: str | None) -> Column:
    """A numeric literal, or SQL text such as ``current_date()``."""
    if isinstance(value, str):
        text = value
        if as_of is not None:
            text = text.replace("current_date()", f"DATE '{as_of}'")
        return F.expr(text)
    return F.lit(value)


def _aligned(df: DataFrame, c: Column, name: str, bound: Column) -> Column:
    """Read a string column as the bound's type (dates, numbers) with try_cast."""
    col_type = df.schema[name].dataType
    bound_type = df.select(bound.alias("b")).schema[0].dataType
    if isinstance(col_type, T.StringType) and not isinstance(bound_type, T.StringType):
        return c.try_cast(bound_type)
    return c


def _any(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols) if cols else F.lit(False)


@dataclass
class Validation:
    """Lazy result of ``run_checks``: frames plus what the report needs."""

    flagged: DataFrame
    clean: DataFrame
    quarantine: DataFrame
    checks: list[QualityCheck]
    status: dict[str, str]
    count_exprs: list[Column]
    flags: dict[int, str]
    stamp: Column
    counted: dict[str, int] | None = None

    @property
    def duplicates(self) -> list[DataFrame]:
        """One row for each unique check: its duplicated keys among the rows left at its position."""
        out = []
        for pos, chk in enumerate(self.checks, start=1):
            if chk.rule == "unique" and self.status[chk.name] == "ok":
                left = self.flagged.filter(~_removed_before(pos, self.checks, self.flags))
                if chk.params.get("sieve"):
                    again = duplicate_keys(left, chk.column, sieve=True)
                    out.append(again.agg(F.count(F.lit(1)).alias(f"failing_{pos}")))
                    continue
                keys = left.groupBy(chk.column).agg(F.count(F.lit(1)).alias("n"))
                out.append(keys.agg(F.count_if(F.col("n") > 1).alias(f"failing_{pos}")))
        return out

    def stored(self) -> "Validation":
        """The same over a scratch table, written once with the rows of each failed check apart; the
        counts of the row checks are observed on that write."""
        spark, path, seen = self.flagged.sparkSession, scratch_path(self.flagged.sparkSession, "validated"), \
            Observation("validated")
        (self.flagged.observe(seen, *self.count_exprs).write.partitionBy(CHECK_COL).parquet(path))
        flagged = spark.read.schema(self.flagged.schema).parquet(path)
        clean, quarantine = _apart(flagged, self.flags.values(), self.stamp)
        return replace(self, flagged=flagged, clean=clean, quarantine=quarantine, counted=dict(seen.get))

    @property
    def has_unique(self) -> bool:
        return any(c.rule == "unique" and self.status[c.name] == "ok" for c in self.checks)

    @property
    def can_remove(self) -> bool:
        """Whether any check can send rows to quarantine."""
        return any(c.is_row_check and c.severity == "critical" and self.status[c.name] == "ok"
                   for c in self.checks)

    @property
    def totals(self) -> DataFrame:
        """One row: ``total_rows`` and ``failing_<pos>`` of every active check."""
        return _one_row([self.flagged.agg(*self.count_exprs), *self.duplicates])

    def report_frame(self) -> DataFrame:
        """The report as a DataFrame, one row per check."""
        rows = []
        for pos, chk in enumerate(self.checks, start=1):
            ok = self.status[chk.name] == "ok"
            failing = F.col(f"failing_{pos}") if ok else F.lit(None).cast("long")
            rows.append(_report_struct(pos, chk, self.status[chk.name],
                                       F.col("total_rows"), failing))
        if not rows:
            return self.totals.select(F.inline(F.array(_report_struct(
                0, QualityCheck("none", "", "not_null"), "skipped", F.col("total_rows"),
                F.lit(None).cast("long"))))).filter(F.lit(False))
        return self.totals.select(F.inline(F.array(*rows)))

    def report(self) -> list[dict]:
        """The report as dicts in check order."""
        if self.counted is None:
            counts = self.totals.first().asDict()
        else:
            counts = self.counted | (_one_row(self.duplicates).first().asDict() if self.has_unique else {})
        total = int(counts["total_rows"])
        out = []
        for pos, chk in enumerate(self.checks, start=1):
            entry = {"check": chk.name, "column": chk.column, "rule": chk.rule,
                     "severity": chk.severity, "status": self.status[chk.name],
                     "total_rows": total, "failing_rows": None, "pass_rate": None}
            if self.status[chk.name] == "ok":
                failing = int(counts[f"failing_{pos}"])
                entry["failing_rows"] = failing
                entry["pass_rate"] = _pass_rate(failing, total)
            out.append(entry)
        return out


def _pass_rate(failing: int, total: int) -> float:
    """round((1 - failing / max(total, 1)) * 100, 2), half up like Spark's
    ``round`` (Python's ``round`` goes to even), so both report forms agree."""
    rate = (1 - failing / max(total, 1)) * 100
    return float(Decimal(repr(rate)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def _report_struct(pos: int, chk: QualityCheck, status: str, total: Column,
                   failing: Column) -> Column:
    rate = F.round((F.lit(1) - failing / F.greatest(total, F.lit(1))) * 100, 2)
    return F.struct(
        F.lit(pos).alias("position"), F.lit(chk.name).alias("check"),
        F.lit(chk.column).alias("column"), F.lit(chk.rule).alias("rule"),
        F.lit(chk.severity).alias("severity"), F.lit(status).alias("status"),
        total.cast("long").alias("total_rows"), failing.cast("long").alias("failing_rows"),
        rate.alias("pass_rate"))


def run_checks(df: DataFrame, checks: Iterable[QualityCheck | Mapping[str, object]],
               table: str | None = None, on_missing: str = "skip",
               as_of: str | _dt.date | None = None,
               run_ts: str | _dt.datetime | None = None,
               tag_warnings: bool = False) -> Validation:
    """Plan every check over ``df`` at once; nothing runs until an action."""
    checks = [c if isinstance(c, QualityCheck) else QualityCheck.from_dict(c) for c in checks]
    checks = [c for c in checks if c.applies_to(table)]
    as_of = None if as_of is None else str(as_of)
    status = {}
    for chk in checks:
        if chk.column in df.columns:
            status[chk.name] = "ok"
        elif on_missing == "error":
            raise ValueError(f"check {chk.name!r}: column {chk.column!r} not in frame")
        else:
            status[chk.name] = "skipped"

    flags: dict[int, str] = {}
    flag_exprs = {}
    for pos, chk in enumerate(checks, start=1):
        if chk.is_row_check and status[chk.name] == "ok":
            flags[pos] = f"__q{pos}"
            flag_exprs[flags[pos]] = F.coalesce(chk.failing(df, as_of), F.lit(False))
    flagged = df.withColumns(flag_exprs) if flag_exprs else df

    count_exprs = [F.count(F.lit(1)).alias("total_rows")]
    for pos, chk in enumerate(checks, start=1):
        if status[chk.name] == "ok" and chk.is_row_check:
            count_exprs.append(F.count_if(F.col(flags[pos]) & ~_removed_before(pos, checks, flags))
                               .alias(f"failing_{pos}"))
    critical = [(flags[p], c.name) for p, c in enumerate(checks, start=1)
                if p in flags and c.severity == "critical"]
    tag = F.coalesce(*[F.when(F.col(f), F.lit(n)) for f, n in critical]) if critical \
        else F.lit(None).cast("string")
    flagged = flagged.withColumn(CHECK_COL, tag)
    if tag_warnings:
        warn = [(flags[p], c.name) for p, c in enumerate(checks, start=1)
                if p in flags and c.severity == "warning"]
        names = F.array(*[F.when(F.col(f), F.lit(n)) for f, n in warn]) if warn \
            else F.array().cast("array<string>")
        flagged = flagged.withColumn("_warnings", F.filter(names, lambda x: x.isNotNull()))
    stamp = F.current_timestamp() if run_ts is None else F.lit(str(run_ts)).cast("timestamp")
    clean, quarantine = _apart(flagged, flags.values(), stamp)
    return Validation(flagged, clean, quarantine, checks, status, count_exprs, flags, stamp)


def _removed_before(pos: int, checks: Sequence[QualityCheck], flags: Mapping[int, str]) -> Column:
    return _any([F.col(flags[j]) for j, c in enumerate(checks, start=1)
                 if j < pos and j in flags and c.severity == "critical"])


def _apart(flagged: DataFrame, flags: Iterable[str], stamp: Column) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with their check and time)."""
    clean = flagged.filter(F.col(CHECK_COL).isNull()).drop(CHECK_COL, *flags)
    return clean, (flagged.filter(F.col(CHECK_COL).isNotNull()).drop(*flags).withColumn(QUARANTINE_TS, stamp))


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """One-row frames with different columns as one row."""
    if len(parts) == 1:
        return parts[0]
    names = [c for p in parts for c in p.columns]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for c in names])


class QualityEngine:
    """Config-driven validation: ``validate(df, source_name) -> (clean, report)``.

    Config keys: ``checks`` (list of dicts: name, column, rule, severity,
    rule parameters, optional ``tables``), ``quarantine_path``,
    ``fail_on_error``, ``on_missing``.
    """

    def __init__(self, quality_config: Mapping[str, object],
                 as_of: str | _dt.date | None = None):
        self.quarantine_path = quality_config.get("quarantine_path")
        self.fail_on_error = bool(quality_config.get("fail_on_error", False))
        self.on_missing = str(quality_config.get("on_missing", "skip"))
        self.checks = [QualityCheck.from_dict(c) for c in quality_config.get("checks", [])]
        self.as_of = as_of

    def plan(self, df: DataFrame, table: str | None = None) -> Validation:
        return run_checks(df, self.checks, table=table, on_missing=self.on_missing,
                          as_of=self.as_of)

    def validate(self, df: DataFrame, source_name: str = "unknown",
                 table: str | None = None, store: bool = False) -> tuple[DataFrame, list[dict]]:
        """Run the checks; write quarantined rows; maybe raise; return clean rows.

        The report reads the columns of the checks; the quarantine write is a
        scan of its own, rebalanced by check so that few rows make few files.
        With ``store`` the input is computed once: one write to a scratch table, apart by
        failed check, counts the report's rows on the way; quarantine, unique checks and
        clean rows read that. For inputs that are costly or have several readers.
        """
        v = self.plan(df, table or source_name)
        if store:
            v = v.stored()
        if self.quarantine_path and v.can_remove:
            (v.quarantine.hint("rebalance", CHECK_COL).write.mode("append").partitionBy(CHECK_COL)
             .parquet(f"{str(self.quarantine_path).rstrip('/')}/{source_name}/"))
        report = v.report()
        failed = [r for r in report if r["severity"] == "critical" and r["failing_rows"]]
        if failed and self.fail_on_error:
            raise DataQualityError("critical checks with failing rows: " + ", ".join(r["check"] for r in failed), report)
        return v.clean, report
