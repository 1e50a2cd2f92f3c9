"""The whole tree must be collected, as a name in one folder can hide a module of another."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_every_module_is_collected():
    run = subprocess.run(
        [sys.executable, "-m", "pytest", "tests/", "--collect-only", "-q", "-p", "no:cacheprovider"],
        cwd=ROOT, capture_output=True, text=True, timeout=300, check=False,
    )
    assert run.returncode == 0, run.stdout[-3000:]
    for module in sorted((ROOT / "tests").rglob("test_*.py")):
        assert str(module.relative_to(ROOT)) in run.stdout
