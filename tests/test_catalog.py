"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
import os
import re
import shutil
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as se
from strata.plans import catalog
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0 and "segment" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(se.queries()) and len(catalog.QUERIES) >= 70


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(catalog.ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


def test_query_names_and_docs():
    assert not any(n == "pipeline" or re.match(r"op\d+_", n) for n in catalog.QUERIES)


def test_entry_works_without_the_document_operators(tmp_path):
    root = os.path.dirname(os.path.abspath(se.__file__))
    shutil.copytree(f"{root}/strata", tmp_path / "strata",
                    ignore=lambda d, names: {"llm", "__pycache__"} & set(names))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    (tmp_path / "strata" / "llm").mkdir()  # an empty folder is no subpackage
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()) == set(e.catalog.QUERIES)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120,
                   env={**os.environ, "PYTHONPATH": str(tmp_path)})
