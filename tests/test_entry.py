"""Every named query against its SQL twin, over whole tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import SMALL
from runtrail.plans.catalogue import QUERIES
from runtrail.plans.oracle import ORACLE

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_each_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[0] == "run_id" and frame.count() == 1500


@pytest.mark.parametrize("hidden", ["xxhash", "zstandard", "corpus_pipeline", "runtrail.llm"])
def test_queries_are_offered_without_the_packages_of_others(hidden):
    """A package that only the training-text operators need may be absent."""
    code = (
        f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; "
        "print(len(e.queries()), len(e.oracle_sql()), e.LLM_MISSING)"
    )
    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    assert said.split()[:2] == [str(len(QUERIES)), str(len(ORACLE))] and hidden in said


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_twin(spark, duck, name):
    ours = QUERIES[name](spark, SMALL).toArrow()
    theirs = duck.sql(ORACLE[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    assert [str(ours.schema.field(c).type) for c in columns] == [
        str(theirs.schema.field(c).type) for c in columns
    ]

    def rows(table):
        return sorted(zip(*[table[c].to_pylist() for c in columns]), key=str)

    assert rows(ours) == rows(theirs)
