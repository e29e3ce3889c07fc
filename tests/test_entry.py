"""Driver contract: entry() runs, every query has an oracle, and a sample of
queries matches its DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def test_every_query_has_an_oracle():
    from ebbflow.plans.catalog import QUERIES

    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@needs_data
def test_entry_returns_rows(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0


@needs_data
@pytest.mark.parametrize("name", ["fraud_two_cities", "scd2_merge", "driver_overtime_rolling",
                                  "driver_assignment", "client_metrics", "watermark_advance"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "supplier", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry_mod.queries()[name](spark, SF)
    rel = con.sql(entry_mod.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    exp = sorted((tuple(r) for r in con.sql(f"SELECT {', '.join(cols)} FROM ({entry_mod.oracle_sql()[name]})").fetchall()),
                 key=repr)
    assert got == exp


@needs_data
def test_bench_prints_one_json_line():
    import json
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_QUERIES="full_name,key_snapshot")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], capture_output=True, text=True,
                         env=env, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"full_name", "key_snapshot"} and d["value"] > 0
