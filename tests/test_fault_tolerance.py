import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_lost_worker_lands_every_request_once(tmp_path):
    marker = str(tmp_path / "crashed")
    out = subprocess.run([sys.executable, os.path.join(HERE, "scripts", "worker_loss.py"), marker],
                         capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert line, out.stderr[-2000:]
    got = json.loads(line[-1])
    assert got["crashed"]                                   # the worker really died once
    assert got["landed"] == got["requests"] == 23           # dev ids, 36 listed twice
    assert got["distinct"] == 23                             # retried task did not double anything


def test_python_workers_import_the_package_from_any_directory(tmp_path):
    repo = os.path.dirname(HERE)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, os.path.join(HERE, "scripts", "foreign_cwd.py"), repo],
                         capture_output=True, text=True, timeout=600, cwd=str(tmp_path), env=env)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
    assert line, out.stderr[-2000:]
    got = json.loads(line[-1])
    assert got["raw_landing"] > 0 and got["xml_discovered_tags"] == 1500
