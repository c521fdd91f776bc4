"""Every query with SQL against DuckDB on the smallest tables; the others by their known results."""

import pytest

from lodestack import catalog

QUERIES = catalog.load()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_sql(name, same_rows):
    same_rows(QUERIES[name].run, QUERIES[name].sql)


def test_minimum_pages_ranks_by_all_words(spark):
    words = lambda t: {w for w in (t or "").split(" ") if w}
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    docs = [(r["doc_id"], words(r["text"])) for r in read("documents").select("doc_id", "text").collect()]
    expected = set()
    for r in read("benchmark").collect():
        q = words(r["text"])
        best = sorted((-len(q & w), i) for i, w in docs if q & w)[:2]
        expected |= {(r["item_id"], place, i, -less) for place, (less, i) in enumerate(best, 1)}
    rows = QUERIES["minimum_pages"].run(spark, "/root/testdata/sf0.001").collect()
    assert {(r["id"], r["place"], r["page_id"], r["overlap"]) for r in rows} == expected
    assert len(rows) == len(expected)


def test_missing_links_reads_all_orders(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    met = {}
    for r in read("lineitem").select("l_orderkey", "l_suppkey").collect():
        met.setdefault(r["l_orderkey"], set()).add(r["l_suppkey"])
    pairs = {(a, b) for nodes in met.values() for a in nodes for b in nodes if a < b}
    linked = {tuple(sorted((r["s_suppkey"], (r["s_suppkey"] + 1) % 50))) for r in read("supplier").select("s_suppkey").collect()}
    rows = [tuple(r) for r in QUERIES["missing_links"].run(spark, "/root/testdata/sf0.01").select("src", "dst").collect()]
    assert set(rows) == pairs - linked
    assert len(rows) == len(pairs - linked)


def test_tool_catalogue_describes_every_query(spark):
    rows = {r["name"]: r for r in QUERIES["tool_catalogue"].run(spark, "").collect()}
    assert set(rows) == set(QUERIES)
    assert rows["port_files"]["inputs"] == ["supplier"]
    assert rows["port_files"]["purpose"].startswith("A port file for each supplier")
    assert all(r["purpose"] and r["operators"] for r in rows.values())


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["source", "sources", "processed", "unprocessed", "duplicates", "size"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
