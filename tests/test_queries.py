"""Every registered query against its SQL, on whole tables."""

import math
import re
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as registered

TABLES = ["events", "documents", "conversations", "pages", "benchmark"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    yield db
    db.close()


def cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(cell(r[i]) for i in order) for r in rows), key=lambda r: [(v is None, str(v)) for v in r]
    )


#: The corpus queries; those without SQL are held against brute force in their own tests.
CORPUS = {name for name in registered.queries() if re.match(r"op\d+_|pipeline$", name)}


def test_every_query_has_its_sql():
    assert registered.queries().keys() - CORPUS == registered.oracle_sql().keys() - CORPUS
    assert registered.oracle_sql().keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", registered.oracle_sql())
def test_query(spark, sf_dir, duck, name):
    df = registered.queries()[name](spark, sf_dir)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    answer = duck.execute(registered.oracle_sql()[name])
    expected = normal([c[0] for c in answer.description], answer.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    assert got[1] == expected[1]
    assert got[1]


def test_entry(spark):
    assert registered.entry(spark).columns[0] == "symbol"


@pytest.mark.parametrize("name, batches", [("history_compact", 7), ("history_replay", 5)])
def test_a_topic_is_parsed_once_for_all_its_batches(spark, sf_dir, monkeypatch, name, batches):
    parsed, written = [], []
    ingest, write = registered.ingest, registered.write_history
    monkeypatch.setattr(registered, "ingest", lambda *args: parsed.append(1) or ingest(*args))
    monkeypatch.setattr(registered, "write_history", lambda *args: written.append(args[-1]) or write(*args))
    registered.queries()[name](spark, sf_dir)
    assert len(parsed) == 1 and len(written) == batches
