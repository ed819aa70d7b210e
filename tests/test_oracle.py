"""Every registered query against its DuckDB oracle (small scale), and the driver entry points."""

import importlib.util
import os

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


ENTRY = _entry_module()
NAMES = sorted(ENTRY._registry.queries())


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(NAMES) - set(ENTRY.oracle_sql())
    assert missing == set(), f"queries without oracle SQL: {missing}"


def test_entry_runs(spark):
    df = ENTRY.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns[0] == "label"
    assert any(r.label == "Total" for r in rows)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF_SMALL, name, con)
    assert ok, msg


def test_udfs_run_without_package_on_workers(tmp_dir):
    """The driver may import the entry from any directory: UDF bodies must reach workers by value."""
    import subprocess
    import sys
    import textwrap

    script = textwrap.dedent(
        f"""
        import importlib.util
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spec = importlib.util.spec_from_file_location("spark_entry", "{ROOT}/__spark_entry__.py")
        m = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(m)
        q = m.queries()
        print("SIG", q["minhash_signature"](spark, "{SF_SMALL}").collect()[0][1].count(","))
        """
    )
    path = os.path.join(tmp_dir, "drv.py")
    with open(path, "w") as fh:
        fh.write(script)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, path], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=600)
    assert "SIG 127" in out.stdout, out.stderr[-2000:]
