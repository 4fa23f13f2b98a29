import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"


def listed(path):
    out = subprocess.run([sys.executable, "-c", SAY], cwd=path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return [eval(line) for line in out.stdout.splitlines()[-2:]]


@pytest.mark.parametrize("pipeline", [True, False])
def test_registration_without_the_corpus_operators(tmp_path, pipeline):
    """With the subpackage deleted the other queries are registered, whether the pipeline's file is there or not."""
    from payguard.plans.catalog import REGISTRY
    path = tmp_path / "copy"
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(os.path.join(ROOT, "payguard"), path / "payguard", ignore=skip)
    for name in ["__spark_entry__.py"] + (["corpus_pipeline.py"] if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")) else []):
        shutil.copy(os.path.join(ROOT, name), path / name)
    keys, sqls = listed(path)
    assert keys == sorted(REGISTRY) and sqls == sorted(k for k, q in REGISTRY.items() if q.sql is not None)
