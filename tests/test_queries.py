"""Every registered query, against DuckDB where it has SQL."""

from __future__ import annotations

import pytest
from oracle import connect, difference

from flowgauge.registry import ENTRIES

WITH_SQL = [n for n, e in ENTRIES.items() if e.sql is not None]
ROWS_ONLY = [n for n, e in ENTRIES.items() if e.sql is None]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", WITH_SQL)
def test_equals_sql(spark, sf_dir, con, name):
    assert difference(ENTRIES[name].run(spark, sf_dir), con, ENTRIES[name].sql) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_gives_rows(spark, sf_dir, name):
    df = ENTRIES[name].run(spark, sf_dir)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())
