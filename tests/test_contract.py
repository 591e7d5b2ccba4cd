"""The driver contract: every query against its DuckDB oracle on sf0.001."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as E  # noqa: E402
from bagdiff.plans import contract  # noqa: E402
from tools.check_contract import canon  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["bucket", "line_no", "line", "key", "n_left", "n_right", "occ_rank"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(contract.queries()) == set(contract.oracle_sql()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(rel.columns, orows)


@pytest.mark.parametrize("heavy_rows", [0, 3, None])
@pytest.mark.parametrize("mode", ["files", "dirs", "pooled"])
def test_heavy_keys_match_oracle(spark, duck, mode, heavy_rows):
    """All, some or no keys ranked in 8-line chunks: the oracle's rows on real data."""
    from bagdiff.plans.pipelines import FILES, POOLED, compare, diff_file_pairs

    if mode == "files":
        df = compare(contract.x_lines(spark, SF), FILES, heavy_rows=heavy_rows, chunk_bits=3)
        name, cols = "diff_files", ["bucket", "line_no", "line", "key", "n_left", "n_right", "occ_rank"]
    elif mode == "dirs":
        df = diff_file_pairs(contract.y_lines(spark, SF), contract.y_files(spark, SF), heavy_rows=heavy_rows, chunk_bits=3)
        name, cols = "diff_dirs", ["file", "bucket", "line_no", "line", "key"]
    else:
        df = compare(contract.y_lines(spark, SF), POOLED, heavy_rows=heavy_rows, chunk_bits=3)
        name, cols = "diff_pooled_dirs", ["bucket", "line", "key", "n_left", "n_right"]
    rows = df.select(*cols).collect()
    rel = duck.sql(E.oracle_sql()[name])
    assert canon(cols, rows) == canon(rel.columns, rel.fetchall())


def test_entry_in_a_plain_session(tmp_path):
    """As the driver calls it: a fresh process, a plain local session, no
    checkpoint folder configured."""
    import subprocess

    script = tmp_path / "smoke.py"
    script.write_text(
        "import importlib.util\n"
        "from pyspark.sql import SparkSession\n"
        f"spec = importlib.util.spec_from_file_location('e', '{Path(__file__).resolve().parents[1]}/__spark_entry__.py')\n"
        "E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "df = E.entry(spark)\n"
        "print('ROWS', df.count(), ','.join(df.columns))\n"
    )
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600, cwd=tmp_path)
    assert "ROWS 1829 bucket,line_no,line,key,n_left,n_right,occ_rank" in out.stdout, out.stderr[-2000:]
