import duckdb
import pytest

import __spark_entry__ as E
from mesonlab.plans import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["bin", "bin_lo", "bin_hi", "n"]
    assert df.count() > 0


def test_oracles_cover_queries():
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(ORACLE_SQL) == {"sample", "approx_quantile_001", "histogram_fd_approx"}


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle_small(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got == want


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_cross_products_or_row_udfs(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(op in plan for op in FORBIDDEN), plan


def test_user_functions_work_from_another_directory(tmp_path):
    """Python workers import this package from the shipped zip, not the cwd."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {repo!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        f"rows = E.queries()['dataset_map'](spark, {SF_SMALL!r}).collect()\n"
        "print('ROWS', len(rows))\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS 6000" in out.stdout, out.stderr[-2000:]
