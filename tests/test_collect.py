"""All test folders can be collected in one call."""

from __future__ import annotations

import os
import subprocess
import sys

TESTS = os.path.dirname(os.path.abspath(__file__))


def test_all_folders_collect_together():
    call = [sys.executable, "-m", "pytest", TESTS, "--collect-only", "-q", "-p", "no:cacheprovider"]
    done = subprocess.run(call, capture_output=True, text=True, timeout=300, cwd=os.path.dirname(TESTS))
    assert done.returncode == 0, done.stdout[-2000:]


def test_core_modules_have_names_of_their_own():
    def modules(folder):
        return {f for f in os.listdir(folder) if f.endswith(".py") and f not in ("conftest.py", "__init__.py")}

    for name in os.listdir(TESTS):
        inner = os.path.join(TESTS, name)
        if os.path.isdir(inner) and name != "__pycache__":
            assert not modules(TESTS) & modules(inner)
