"""Registered queries against their SQL, on the smallest tables."""

import sys

import duckdb
import pytest

import __spark_entry__ as registered

STREAMS = [q for q in registered.queries() if q.startswith("stream_")]
BATCH = [q for q in registered.oracle_sql() if q not in STREAMS]


def rows(frame):
    columns = sorted(frame.columns)
    return sorted(tuple(map(repr, r)) for r in frame[columns].astype(object).where(frame.notna(), None).values.tolist())


@pytest.mark.parametrize("name", BATCH)
def test_equals_sql(spark, small, name):
    got = registered.queries()[name](spark, small).toPandas()
    base = duckdb.connect()
    for table in ("events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    want = base.sql(registered.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    for column in got.columns:
        if str(got[column].dtype).startswith(("float", "int")) and want[column].dtype != got[column].dtype:
            want[column] = want[column].astype(got[column].dtype)
    assert rows(got) == rows(want)


def test_entry_runs(spark):
    assert registered.entry(spark).count() == 433


def test_the_rest_stands_without_the_training_data_package(monkeypatch):
    import importlib

    for name in [m for m in sys.modules if m.startswith("frostline.llm")] + ["corpus_pipeline", "frostline.llm"]:
        monkeypatch.setitem(sys.modules, name, None)
    try:
        plain = importlib.reload(registered)
        assert not [q for q in plain.queries() if q.startswith("op") or q == "pipeline"]
        assert "door_alerts" in plain.oracle_sql()
    finally:
        monkeypatch.undo()
        importlib.reload(registered)
