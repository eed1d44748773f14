"""Every registered query of the warehouse against its SQL twin, and the repository without its optional parts."""

import math
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from locusmill import queries

DATA, ROOT = "/root/testdata/sf0.001", Path(__file__).resolve().parent.parent
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double"}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS FROM '{DATA}/{t}.parquet'")
    return c


def plain(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) and not math.isnan(x) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    want = duck.sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert dict(df.dtypes) == {c: TYPES[str(t)] for c, t in zip(want.columns, want.types)}
    order = sorted(df.columns)
    at = [want.columns.index(c) for c in order]
    assert plain(map(tuple, df.select(*order).collect())) == plain(tuple(r[i] for i in at) for r in want.fetchall())


def test_every_query_has_a_twin():
    assert set(queries.queries()) == set(queries.oracle_sql())


def test_pushdown(spark):
    """Scans read the columns they need, and a filter on a stored column reaches Parquet."""
    plan = queries.queries()["dup_ss_qc"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_without_optional_parts(tmp_path):
    for x in ("locusmill", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / x).is_dir() else shutil.copy)(ROOT / x, tmp_path / x)
    shutil.rmtree(tmp_path / "locusmill" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q); print(e.__file__)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert out.returncode == 0 and str(tmp_path) in out.stdout, out.stderr
