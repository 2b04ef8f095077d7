import duckdb
import pytest

from millrace.llm import queries

COLUMNS = {
    "p1_found": {"offer_a", "offer_b"}, "p3_found": {"page_id", "text_md5"}, "p4_found": {"offer_id", "field_name", "pos", "canon_id"}, "p7_found": {"employer_a", "employer_b"},
    "p8_ids": {"doc_id", "ids"}, "p9_found": {"doc_id", "item_id"}, "p10_found": {"doc_id", "seg_no", "seg_lang"},
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    if name in COLUMNS:
        assert set(df.columns) == COLUMNS[name]
    rows = df.collect()
    assert len(rows) > 0
    if name in COLUMNS and name != "p8_ids":
        assert len(set(map(tuple, rows))) == len(rows)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "eval_item"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, want))
