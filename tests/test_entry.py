"""The driver's contract."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__spark_entry__.__file__).parent


def test_names_and_sql():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert len(queries) > 200 and set(sql) <= set(queries) and all(map(callable, queries.values()))


def test_imports_without_a_session():
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_core_queries_without_what_the_text_operators_need():
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 250 and not any(k.startswith('op') for k in q) and 'pipeline' not in q and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_core_queries_without_the_text_operators(tmp_path):
    shutil.copytree(ROOT / "kerbside", tmp_path / "kerbside", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 250 and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op') for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
