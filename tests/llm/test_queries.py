"""The registered queries on the smallest tables, and those that SQL can express against it."""

import duckdb
import pytest

import __spark_entry__ as entry
from rosterline.llm.queries import ORACLE, QUERIES


OTHER_ROWS = {"op11_stripe_collocations", "op12_conversation_trie"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHER_ROWS))
def test_a_row_for_each_document(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    out = QUERIES[name](spark, sf_dir)
    assert out.select("doc_id").distinct().count() == docs


def test_all_are_registered():
    assert all(entry.queries()[name] is QUERIES[name] for name in QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    wanted = con.sql(ORACLE[name])
    out = QUERIES[name](spark, sf_dir)
    columns = sorted(out.columns)
    assert columns == sorted(wanted.columns)
    pick = [wanted.columns.index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in out.collect()) == \
        sorted(tuple(r[i] for i in pick) for r in wanted.fetchall())
