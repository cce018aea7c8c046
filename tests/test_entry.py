"""The entry points where the corpus operators are missing, in whole or in part."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), 'season_stats' in q, any(n.startswith('op') or n == 'pipeline' for n in q))"


@pytest.mark.parametrize("leftover", ["nothing", "empty folder", "missing library"])
def test_without_the_corpus_operators(tmp_path, leftover):
    """A copy without the folder, with an empty one as removal leaves it, and with one that cannot be imported, serves all other queries."""
    from terraloom.plans import registered
    keep = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(f"{ROOT}/terraloom", tmp_path / "terraloom", ignore=keep)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if leftover != "nothing":
        (tmp_path / "terraloom/llm/__pycache__").mkdir(parents=True)
    if leftover == "missing library":
        (tmp_path / "terraloom/llm/__init__.py").write_text("def registered():\n    import no_such_library_here\n")
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, timeout=120, check=True)
    n = len(registered())
    assert done.stdout.split() == [str(n), str(sum(1 for _, sql in registered().values() if sql)), "True", "False"]
