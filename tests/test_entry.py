"""The entry module without the language-data folders."""

import shutil
import subprocess
import sys
from pathlib import Path

from millrace import catalog

ROOT = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), *sorted(e.queries()))"


def names(folder: Path) -> list[str]:
    done = subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, check=True)
    return done.stdout.split()


def without(folder: Path, *gone: str) -> Path:
    """A copy of the tree without some files or folders."""
    skip = {ROOT / g for g in gone}
    shutil.copytree(ROOT, folder, ignore=lambda at, found: [
        f for f in found if Path(at) / f in skip or f in (".git", "__pycache__", "spark-warehouse")])
    return folder


def test_without_language_data(tmp_path):
    """The pipeline stays in the root there; it is left out as well."""
    kept = ["True", *sorted(catalog.QUERIES)]
    assert names(without(tmp_path / "a", "millrace/llm", "tests/llm")) == kept
    assert names(without(tmp_path / "b", "millrace/llm", "tests/llm", "corpus_pipeline.py")) == kept


def test_other_missing_modules_are_not_hidden(tmp_path):
    folder = without(tmp_path / "c", "millrace/sources/staging.py")
    done = subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True)
    assert done.returncode and "millrace.sources.staging" in done.stderr
