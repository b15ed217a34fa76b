"""Every registered query of the engine against its DuckDB twin."""

import math

import duckdb
import pytest

from talus.queries import ORACLE_SQL, QUERIES

from .conftest import DATA

SF = DATA / "sf0.001"


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in SF.glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def comparable(rows, columns, order):
    def value(v):
        return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v

    at = [columns.index(c) for c in order]
    return sorted((tuple(value(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    twin = duck.sql(ORACLE_SQL[name])
    order = sorted(df.columns)
    assert sorted(twin.columns) == order
    assert comparable(df.collect(), df.columns, order) == comparable(twin.fetchall(), twin.columns, order)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize(("name", "rows"), [("scenario_winter", 32), ("scenario_spring", 10), ("scenario_winter_and", 12), ("scenario_high4", 27), ("scenario_low2", 19), ("size1_rel_only", 17), ("master_union", 42), ("legend_multi_pot", 312)])
def test_measured_counts(spark, name, rows):
    assert QUERIES[name](spark, str(SF)).count() == rows
