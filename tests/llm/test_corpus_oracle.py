"""The corpus queries that SQL can say, against DuckDB, on whole tables and on awkward rows."""

import duckdb
import pytest

from talus.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import DATA
from .rows import awkward


def same(spark, name, folder):
    db = duckdb.connect()
    for path in folder.glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if path.is_dir() else ''}')")
    df, twin = QUERIES[name](spark, str(folder)), db.sql(ORACLE_SQL[name])
    order = sorted(df.columns)
    assert sorted(twin.columns) == order

    def plain(rows, columns):
        at = [columns.index(c) for c in order]
        return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in at) for r in rows), key=repr)

    assert plain(df.collect(), df.columns) == plain(twin.fetchall(), twin.columns)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, name, DATA / "sf0.001")


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op10_licenses", "quality_statistics", "mix_targets"])
def test_awkward_rows_equal_their_sql(spark, tmp_path, name):
    # DuckDB copies a text's word list for each of its words: long texts are left to the brute-force tests.
    awkward(spark).where("doc_id <> 3 AND coalesce(length(text), 0) < 1000").write.parquet(f"file://{tmp_path}/documents.parquet")
    same(spark, name, tmp_path)
