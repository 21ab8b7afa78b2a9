import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_WARM_DIR="/nonexistent")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "preview", "sentiment_counts"],
                         env=env, capture_output=True, text=True, timeout=600, cwd="/tmp")
    lines = [l for l in out.stdout.splitlines() if l.startswith("{")]
    assert len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"preview", "sentiment_counts"}
    assert d["value"] == round(sum(d["queries"].values()), 3)
