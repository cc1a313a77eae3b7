"""Tasks that fail and are retried give the same results (range buckets, hot-day
slices and checkpoints are deterministic). Runs in its own process: the retry count
of a local session is fixed when its context starts."""

import json
import os
import subprocess
import sys

from tests.conftest import SF001

HELPER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "helpers", "retry_run.py")


def test_results_survive_task_retries(tmp_path):
    out = subprocess.run([sys.executable, HELPER, SF001, str(tmp_path / "ck")], capture_output=True, text=True,
                         timeout=900, check=True).stdout.strip().splitlines()[-1]
    res = json.loads(out)
    assert set(res) == {"auc", "roc_points", "prior_features", "stump_search", "knn"}
    for name, r in res.items():
        assert r["rows"] > 0 and r["same"], name
