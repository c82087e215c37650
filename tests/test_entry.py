"""The driver's contract: queries give what their SQL gives."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__
from vellum import catalogue_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return round(float(v), 5) if hasattr(v, "as_tuple") else v


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue_queries.oracle_sql()))
def test_query_matches_sql(spark, tables, name):
    d = catalogue_queries.queries()[name](spark, SF)
    cols = sorted(d.columns)
    got = sorted(repr(tuple(map(plain, r))) for r in d.select(*cols).collect())
    r = tables.sql(catalogue_queries.oracle_sql()[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    assert got == sorted(repr(tuple(plain(x[i]) for i in at)) for x in r.fetchall())


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_query_is_named_once():
    names = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert os.path.isdir(SF)


@pytest.mark.parametrize("gone", [("vellum/llm", "tests/llm"), ("vellum/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_works_without_the_training_data_operators(tmp_path, gone):
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        path = copy / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, check=True).stdout
    names, sql = (x.split() for x in said.strip().splitlines()[-1].split("|"))
    assert set(names) == set(catalogue_queries.queries()) and set(sql) == set(catalogue_queries.oracle_sql())
