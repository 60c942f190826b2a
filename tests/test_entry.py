"""The driver's contract, with and without the text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(*q)"


def names(folder: str) -> list[str]:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", SHOW], cwd=folder, env=env, capture_output=True, text=True, check=True).stdout.split()


def test_all_queries_are_registered():
    found = names(ROOT)
    assert "action_columns_by_order" in found and len(found) == len(set(found))
    if os.path.isdir(os.path.join(ROOT, "tracewell", "llm")):
        assert "pipeline" in found and all(any(n.startswith(f"op{k}_") for n in found) for k in range(1, 11))


def test_the_rest_works_without_the_text_operators(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    found = names(str(copy))
    assert "action_columns_by_order" in found and not any(n.startswith("op") or n == "pipeline" for n in found)
