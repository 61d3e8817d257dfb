"""Opt-in: two executor JVMs and an executor killed mid-run (``COHORTEX_CLUSTER_TEST=1``).

Runs ``scripts/cluster_check.py`` in its own process (it starts its own local-cluster
session) and requires every check to report OK.
"""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(os.environ.get("COHORTEX_CLUSTER_TEST") != "1", reason="starts extra executor JVMs")
def test_cluster_check():
    out = subprocess.run(
        [sys.executable, os.path.join(REPO, "scripts", "cluster_check.py")],
        capture_output=True, text=True, timeout=900, cwd=REPO,
    ).stdout
    lines = [line.split("\r")[-1] for line in out.splitlines()]
    checks = [line for line in lines if line.endswith("OK") or "BAD" in line or "executor loss" in line]
    assert any(line.startswith("entry rows") for line in lines)
    assert checks and all("BAD" not in line for line in checks)
    assert any("after executor loss: OK" in line for line in lines)
