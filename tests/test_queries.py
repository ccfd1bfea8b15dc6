"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle import compare, connect

from samplelake.catalog import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert compare(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["shard", "shard_idx", "sample_idx", "__key__", "cls", "source"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_packages_of_the_operators():
    """A package that only the training-data operators need may be absent."""
    import subprocess
    import sys

    code = (
        "import sys; sys.modules.update(xxhash=None, zstandard=None, ahocorasick=None); import __spark_entry__ as e; "
        "from samplelake.catalog import QUERIES, SQL; "
        "assert set(QUERIES) <= set(e.queries()) and set(SQL) <= set(e.oracle_sql())"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
