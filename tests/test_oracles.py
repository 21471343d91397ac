"""Every query with SQL against DuckDB on the smallest tables, and the driver's contract."""

from __future__ import annotations

import ast
import glob
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
LLM = ("op", "pipeline")
NAMES = sorted(n for n in __spark_entry__.oracle_sql() if not n.startswith("op"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, (float, Decimal)) else v


@pytest.mark.parametrize("name", NAMES)
def test_query_is_its_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    cur = duck.execute(__spark_entry__.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(repr([plain(r[cols.index(c)]) for c in sorted(cols)]) for r in cur.fetchall())
    got = sorted(repr([plain(v) for v in r]) for r in df.select(*sorted(cols)).collect())
    assert got == want


def test_entry_has_rows(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["value", "n", "place"] and df.count() > 0


def test_every_catalog_query_has_sql():
    known = {n for n in __spark_entry__.queries() if not n.startswith("op") and n != "pipeline"}
    assert known == set(NAMES)


def test_nothing_else_imports_the_corpus_operators():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for path in glob.glob(f"{root}/quarry/**/*.py", recursive=True):
        if "/llm/" in path:
            continue
        tree = ast.parse(open(path, encoding="utf-8").read())
        names = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)] + [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
        assert not [n for n in names if "llm" in n.split(".") or n == "corpus_pipeline"], path
