"""Queries of this subpackage against their SQL, on a fixture with nulls, repeated rows and long texts, and on a table."""

import duckdb
import pytest

from ionloom.llm.queries import ORACLES, QUERIES

NAMES = ("rules_base_columns", "pretoken_counts")


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kind", ["fixture", "table", "empty"])
def test_base_columns_and_pretokens(spark, docs, tmp_path, name, kind):
    folder = "/root/testdata/sf0.001" if kind == "table" else str(tmp_path)
    if kind != "table":
        docs.limit(0 if kind == "empty" else 1 << 20).write.parquet(f"{folder}/documents.parquet")
    got = QUERIES[name](spark, folder)
    with duckdb.connect() as db:
        files = f"{folder}/documents.parquet" + ("" if kind == "table" else "/*.parquet")
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{files}'")
        want = db.execute(ORACLES[name])
        columns = [c[0] for c in want.description]
        want = want.fetchall()
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert (kind == "empty") == (not want)
