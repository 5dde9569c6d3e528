"""The driver contract of __spark_entry__.py."""

from __future__ import annotations

import importlib.util
import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_stable_schema(spark):
    mod = load_entry()
    a, b = mod.entry(spark), mod.entry(spark)
    assert a.schema == b.schema and a.count() > 0


def test_every_oracle_key_is_a_query():
    mod = load_entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}
    assert sorted(own - set(o)) == ["hotspots_kmeans", "serve_hotspots"]
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) for s in o.values())


def test_bench_prints_one_json_line():
    import json
    import subprocess
    import sys
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1",
               BENCH_CPUS="2", BENCH_KEYS="trend_all,alerts_batch,trend_all_union")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["metric"] and rec["value"] > 0
    assert set(rec["queries"]) == {"trend_all", "alerts_batch"}
    assert set(rec["variants"]) == {"trend_all_union"} and rec["sf"] == 0.001
