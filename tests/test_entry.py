"""The entry point with and without the corpus operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_names_every_query():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names) and entry.FLAGSHIP in names


def test_entry_without_the_corpus_operators(tmp_path):
    """The same files without the corpus folder: all other queries are there."""
    import shutil

    shutil.copytree(ROOT / "lakeaudit", tmp_path / "lakeaudit", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; n = e.queries(); print(len(n), any(x.startswith('op') and '_' in x and x[2].isdigit() for x in n), 'pipeline' in n)"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    count, corpus, pipeline = said.stdout.split()
    assert int(count) >= 120 and corpus == "False" and pipeline == "False"
