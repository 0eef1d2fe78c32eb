"""Driver contract: bench.py prints one JSON line with the required keys; every query has an oracle."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


# Not expressible in SQL; each is compared with a brute-force version in the named test module.
BRUTE_FORCE = {"boundary_learned": "test_subword"}


def test_every_query_has_an_oracle():
    assert set(E.REGISTRY) <= set(E.queries()) and set(E.REGISTRY) - set(BRUTE_FORCE) <= set(E.oracle_sql())
    assert all(os.path.exists(os.path.join(ROOT, "tests", f"{m}.py")) for m in BRUTE_FORCE.values())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_QUERIES="prompt_template,split_exact")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d) and d["unit"] == "sec"
    assert set(d["queries"]) >= {"prompt_template", "split_exact"}
