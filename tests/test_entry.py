"""The driver contract with and without the optional operators, in a copy of the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def names(folder: Path) -> list[str]:
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(*e.queries())"
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, check=True, capture_output=True, text=True).stdout.split()


@pytest.mark.parametrize("gone", [["cellframe/llm", "tests/llm"], ["cellframe/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
@pytest.mark.parametrize("caches", [False, True])
def test_imports_without_optional_parts(tmp_path, gone, caches):
    from checks import QUERIES

    def left_out(folder: str, entries: list[str]) -> list[str]:
        here = Path(folder).resolve().relative_to(ROOT)
        return [e for e in entries if str(here / e) in gone or e in (".git", "__pycache__", ".pytest_cache")]

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=left_out)
    if caches and "cellframe/llm" in gone:
        (copy / "cellframe/llm/__pycache__").mkdir(parents=True)
    found = names(copy)
    assert set(QUERIES) <= set(found) and "pipeline" not in found
    if "cellframe/llm" in gone:
        assert not any(n.startswith("op") and n[2:3].isdigit() for n in found)
