"""The entry point lives without the training-data operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_without_what_the_operators_need(tmp_path):
    (tmp_path / "public_tokenizers.py").write_text("raise ImportError('absent')")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'verify_suite' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    env = {**os.environ, "PYTHONPATH": f"{tmp_path}:{ROOT}"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=env, timeout=60)
