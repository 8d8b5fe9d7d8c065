"""All test files are collected, also together with those of subfolders."""

import subprocess
import sys
from pathlib import Path

HERE = Path(__file__).resolve().parent


def test_every_test_file_is_collected():
    found = subprocess.run(
        [sys.executable, "-m", "pytest", str(HERE), "--collect-only", "-q", "-p", "no:cacheprovider"],
        cwd=HERE.parent,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert found.returncode == 0, found.stdout[-2000:]
    collected = {line.partition("::")[0] for line in found.stdout.splitlines() if "::" in line}
    files = {str(f.relative_to(HERE.parent)) for f in HERE.rglob("test_*.py")}
    assert files <= collected
