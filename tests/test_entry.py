"""Driver contract: entry smoke, and every registered query against its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from evallens.plans.catalog import QUERIES as OWN
from compare import compare, duck, type_problems

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].total_evaluations > 0
    assert df.columns == ["total_evaluations", "correct_answers", "incorrect_answers", "correct_pct", "incorrect_pct"]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.queries()) and set(OWN) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    assert not type_problems(df, con, E.oracle_sql()[name])
    problems, _ = compare(df, con, E.oracle_sql()[name])
    assert not problems, problems


def test_python_workers_run_from_another_directory(tmp_path):
    """The driver may import the entry from any folder; Python workers must not need the package on their path."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "import __spark_entry__ as E\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('ROWS', E.queries()['extract_zip'](s, %r).count())\n" % (root, SF)
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-3000:]
