"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from wordtide.plans import BOUNDED, STREAMS
from wordtide.plans.oracle import ORACLE

FOLDER = os.environ.get("WORDTIDE_TABLES", entry.SMOKE_FOLDER)
OWN = {*BOUNDED, *STREAMS}
TABLES = ["documents", "conversations", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"{FOLDER} is not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert OWN == set(ORACLE) == OWN & set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_its_twin(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    expected = duck.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert sorted(expected.columns) == columns
    mine = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    listed = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(duck.sql(f"SELECT {listed} FROM expected").fetchall(), key=repr)
    assert len(mine) > 0
    assert mine == theirs


def test_entry(spark):
    flow = entry.entry(spark)
    assert flow.columns == ["edge_no", "from_node", "to_node", "cnt"]
    assert flow.count() == 7
