"""Every registered query with an oracle statement equals DuckDB on sf0.001
(the driver runs the same comparison on sf0.01)."""

import os
import shutil
import subprocess
import sys

import pytest

from ledgerline.plans.registry import ORACLE, QUERIES
import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import canon



def test_every_key_has_a_callable():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) == 85


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck_small, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck_small.execute(ORACLE[key])
    names = [c[0] for c in res.description]
    assert canon(df.columns, rows) == canon(names, res.fetchall())


def test_the_other_keys_do_without_the_training_data_operators(tmp_path):
    """A copy without those folders: the entry still lists every key of the analytics part."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda folder, names: [n for n in names if n in ("llm", ".git", "__pycache__")])
    for keep_pipeline in (True, False):
        if not keep_pipeline:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()))"],
                              cwd=copy, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True)
        assert said.stdout.split() == ["True", str(len(QUERIES))], said.stderr


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 30
    assert df.columns[0] == "call_date"
