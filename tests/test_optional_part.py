"""The library without its optional corpus part: a copy of the repository with
both corpus folders left out still imports and keeps every other query."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

PROBE = """
import sys
import __spark_entry__ as e
names = set(e.queries())
assert "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names), names
assert len(names) > 60 and set(e.oracle_sql()) <= names
assert not any(m.startswith("tablestats.llm") for m in sys.modules)
"""


@pytest.mark.parametrize("pipeline_kept", [True, False])
def test_entry_without_corpus_part(tmp_path, pipeline_kept):
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline_kept else [])):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(f"{ROOT}/tablestats", tmp_path / "tablestats",
                    ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
