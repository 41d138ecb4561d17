from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SMALL
from suite.oracles import ORACLES
from suite.queries import QUERIES
from tools.compare import rows_of

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, database, name):
    frame = contract.queries()[name](spark, SMALL)
    answer = database.execute(contract.oracle_sql()[name])
    wanted = rows_of([column[0] for column in answer.description], answer.fetchall())
    assert rows_of(frame.columns, frame.collect()) == wanted


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert rows and rows == sorted(rows, key=lambda row: (-row["priority_score"], row["s_id"]))


def test_no_python_functions_and_no_driver_data_paths():
    """The library stays on built-in expressions: no UDFs, RDDs, cross joins or local checkpoints."""
    forbidden = r"\budf\b|pandas|\.rdd\b|mapPartitions|crossJoin|localCheckpoint|toLocalIterator|toPandas"
    for file in (ROOT / "bumpwise").rglob("*.py"):
        if "llm" in file.relative_to(ROOT).parts:
            continue
        assert not re.search(forbidden, file.read_text()), file
