"""Registered corpus queries that SQL can express, against their SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from flowlens.llm.queries import ORACLE, QUERIES
from sampleset.compare import differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    ours = QUERIES[name](spark, SMALL)
    assert differences(ours.toArrow(), duck.sql(ORACLE[name]).to_arrow_table()) == []


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
