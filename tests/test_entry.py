"""The registry without the optional modules."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def names(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-800:]
    return [set(line.split()) for line in out.stdout.splitlines()]


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_training_data_operators(tmp_path, pipeline):
    """With the subpackage gone, with or without the pipeline's file, the other queries stay."""
    from wordloom.plans.queries import QUERIES

    folder = tmp_path / "copy"
    folder.mkdir()
    shutil.copytree(
        os.path.join(ROOT, "wordloom"), folder / "wordloom", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    for file in ("__spark_entry__.py", "corpus_pipeline.py")[: 1 + pipeline]:
        if os.path.exists(os.path.join(ROOT, file)):
            shutil.copy(os.path.join(ROOT, file), folder)
    queries, oracle = names(folder)
    assert queries == set(QUERIES) == oracle
