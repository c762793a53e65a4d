"""The contract module in a tree without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left", ["corpus_pipeline.py", None])
def test_import_without_the_optional_subpackage(tmp_path, left):
    """Without the folder, with or without the pipeline file, everything else is there."""
    gone = ["llm", ".git", "__pycache__", "*.json"] + ([] if left else ["corpus_pipeline.py"])
    shutil.copytree(TOP, tmp_path / "tree", ignore=shutil.ignore_patterns(*gone))
    code = "import __spark_entry__ as c; print(sorted(c.queries()), sorted(c.oracle_sql()) == sorted(c.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "tree", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "q01_scan_full" in done.stdout and "op1_" not in done.stdout and "pipeline" not in done.stdout and "True" in done.stdout
