"""Every query that has SQL gives the same rows as DuckDB."""

import pytest

from canopyspark.plans import registry
from conftest import rows_of


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(name, spark, duck, sf_dir):
    got, want = registry.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry_imports_without_the_training_data_parts(tmp_path):
    import shutil
    import subprocess
    import sys

    from conftest import ROOT

    for name in ("canopyspark", "__spark_entry__.py"):
        source = ROOT / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; assert 'camera_pose' in e.queries() and not any(k.startswith('op') for k in e.queries()); assert set(e.oracle_sql()) == set(e.queries())"
    subprocess.run([sys.executable, "-c", code.replace("k.startswith('op')", "k[:2] == 'op' and k[2].isdigit()")], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
