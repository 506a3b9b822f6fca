"""Every registered query against its SQL twin in DuckDB."""

import duckdb
import pytest
from __spark_entry__ import entry, oracle_sql, queries

from tapemill.plans.oracles import oracle_queries
from tapemill.plans.registry import registered_queries

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def ordered(frame):
    frame = frame[sorted(frame.columns)]
    return sorted([tuple(None if v != v else v for v in row) for row in frame.itertuples(index=False)], key=repr)


def test_every_query_of_the_library_has_a_twin():
    assert set(registered_queries()) == set(oracle_queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, name, sf):
    sf_dir = f"{DATA}/{sf}"
    ours = queries()[name](spark, sf_dir).toPandas()
    theirs = duck(sf_dir).execute(oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert {c: ours[c].dtype.kind for c in ours} == {c: theirs[c].dtype.kind for c in ours}
    assert ordered(ours) == ordered(theirs)


def test_entry_runs(spark):
    assert entry(spark).count() > 0
