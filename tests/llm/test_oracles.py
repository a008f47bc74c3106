"""Queries that SQL can express, against DuckDB at sf0.001."""

import duckdb
import pytest

from cairn.llm.queries import ORACLES, QUERIES
from cairn.sources.tables import TABLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = QUERIES[name](spark, sf_small)
    res = con.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in df.columns) for r in res.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == want


def test_entry_lists_all_operators_and_the_pipeline():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{i}_" for i in range(1, 14)} <= {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert "pipeline" in names
