import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.operators import entities
from tessera.plans import index_queries
from tessera.sources import indexes


@pytest.mark.parametrize("name", sorted(index_queries.QUERIES))
def test_queries_equal_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.execute(index_queries.SQL[name]).fetchall()
    names = [c[0] for c in con.description]
    got = [tuple(r) for r in index_queries.QUERIES[name](spark, sf_dir).select(*names).collect()]
    assert got and sorted(map(str, got)) == sorted(map(str, want))


def test_index_lines_and_pages(spark):
    lines = spark.createDataFrame([("f", "com,host)/a 2020\tpart\t10\t5"), ("f", "broken"), ("f", "k\tp\tx\t1")], "file string, value string")
    assert [tuple(r) for r in indexes.block_index(lines).collect()] == [("f", "com,host)/a", 10, 5)]
    bodies = ["https://h/a\nhttps://h/b\n\nnext%20key\n", "https://h/a\n\nhttps://h/b\n", ""]
    got = spark.createDataFrame([(b,) for b in bodies], "b string").select(indexes.resume_page(F.col("b")).alias("p")).select("p.*").collect()
    assert [(r["urls"], r["resume_key"]) for r in got] == [(["https://h/a", "https://h/b"], "next%20key"), (["https://h/a", "https://h/b"], None), ([], None)]


def test_reachable_maps_and_files(spark, tmp_path):
    rows = [("http://h/i", "index", "http://h/a"), ("http://h/a", "index", "http://h/i"), ("http://h/a", "page", "p"), ("http://h/z", "page", "q")]
    entries = spark.createDataFrame(rows, "map string, kind string, loc string")
    assert [r["loc"] for r in indexes.reachable(entries, ["http://h/i"]).collect()] == ["p"]
    with pytest.raises(ValueError):
        indexes.reachable(entries, ["http://h/i"], most=1)
    (tmp_path / "p.csv").write_text('slug,name\na,"x, y"\n')
    assert [tuple(r) for r in indexes.products_file(spark, f"{tmp_path}/p.csv").collect()] == [("a", "x, y")]
    with pytest.raises(ValueError):
        indexes.products_file(spark, "p.txt")


def test_filter_report(spark):
    mentions = spark.createDataFrame([("a",), ("b",), ("b",)], "slug string")
    assert tuple(entities.filter_report(mentions, mentions.where("slug = 'b'"), "v").first()) == (3, 2, 1, "v")
