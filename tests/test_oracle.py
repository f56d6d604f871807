"""Every registered query against the same result in DuckDB's SQL, at the smallest scale."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from annospark.plans import registry

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{sf}/{name}'")
    return con


def text(v) -> str:
    if isinstance(v, (list, np.ndarray)):
        return str([text(x) for x in v])
    if v is None or (isinstance(v, float) and np.isnan(v)) or v is pd.NaT or v is pd.NA:
        return "null"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    return f"{float(v):.9g}" if isinstance(v, (int, float, np.number)) else str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, duck, name):
    got, want = QUERIES[name](spark, sf).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ["e09_turns", "c06_agreement", "e17_tiling", "c08_best_match", "d16_conversation_stats"])
def test_partition_count_changes_nothing(spark, sf, name):
    seen = []
    for n in ("2", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(rows(QUERIES[name](spark, sf).toPandas()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]
