"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="checking tables not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_REPEAT="1", BENCH_QUERIES="dim_date,ads_trade_stats")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"dim_date", "ads_trade_stats"}
    assert d["value"] == pytest.approx(sum(d["queries"].values()), abs=0.01)
