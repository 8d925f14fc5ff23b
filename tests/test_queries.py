import pytest
from oracle import same

from quire.plans import ingest_queries, queries  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    same(spark, SF, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_page_texts_have_no_markup(spark):
    rows = queries.QUERIES["page_texts"](spark, SF).collect()
    assert rows
    for r in rows:
        assert (r.text is None) == (r.parsing_status == "error")
        if r.text:
            assert "track(0)" not in r.text and "<p>" not in r.text and all(line.strip() == line != "" for line in r.text.split("\n"))


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
