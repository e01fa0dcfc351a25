"""Captured files, markup and exports on small inline inputs."""

import gzip
import io
import tarfile
import zipfile

import zstandard
from pyspark.sql import functions as F

from tessera.functions import markup
from tessera.sources import captures, exports

HOST = "host.example"


def lines(spark, *some):
    return spark.createDataFrame([(x,) for x in some], "value string")


def test_capture_indexes(spark):
    j = captures.cdx_json(lines(spark, '{"url": "https://host.example/products/a", "status": "200"}', '{"x": 1}', "broken")).collect()
    assert [r["malformed"] for r in j] == [False, True, True] and j[0]["url"].endswith("/a")
    b = captures.cdx_block(lines(spark, 'example,host)/products/a 2020 {"url": "https://host.example/products/a", "status": "404"}', "x")).collect()
    assert (b[0]["status"], b[0]["timestamp"], b[1]["malformed"]) == ("404", "2020", True)
    f = captures.cdx_fields(lines(spark, "k 2020 https://host.example/tech/Demo text/html 200 h - - 99 5 file", "a b c")).collect()
    assert (f[0]["url"], f[0]["length"], f[0]["filename"], f[1]["malformed"]) == ("https://host.example/tech/Demo", "99", "file", True)
    found = captures.urls_in(lines(spark, 'x https://host.example/products/one?y "https://www.host.example/products/Two"', "https://other.example/products/three"), HOST, "products")
    assert {r["slug"] for r in found.collect()} == {"one", "two"}
    routes = spark.createDataFrame([("https://host.example/books/Old-Book?ref=home",), ("https://host.example/tech/demo/x",), ("https://host.example/topics/demo",)], "u string")
    assert [r[0] and tuple(r[0]) for r in routes.select(captures.legacy_route(F.col("u"), HOST)).collect()] == [("books", "old-book"), ("tech", "demo"), None]


def test_best_captures(spark):
    rows = spark.createDataFrame(
        [("https://host.example/products/demo", "1", "200", "f", "100", "200"), ("https://host.example/products/demo?x=1", "2", "200", "g", "1", "9"), ("https://host.example/products/demo", "2", "200", "h", "3", "5"),
         ("https://host.example/products/demo/reviews", "9", "200", "i", "1", "1"), ("https://host.example/products/demo", "9", "404", "j", "1", "1"), ("https://host.example/products/other", "9", "200", "k", "1", "1")],
        "url string, timestamp string, status string, filename string, offset string, length string",
    ).withColumn("malformed", F.lit(False))
    got = captures.best_captures(rows, spark.createDataFrame([("demo",)], "slug string"), HOST, "products").collect()
    assert [(r["slug"], r["filename"]) for r in got] == [("demo", "h")]


def test_sitemaps(spark, tmp_path):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    page = f"<urlset {ns}><url><loc>https://host.example/products/Alpha/alternatives</loc><lastmod>2024-03-01</lastmod></url><url><loc>https://host.example/products/alpha</loc><lastmod>2024-01-01</lastmod></url><url><loc>https://host.example/posts/x</loc></url></urlset>"
    (tmp_path / "a.xml.gz").write_bytes(gzip.compress(page.encode()))
    (tmp_path / "i.xml").write_text(f"<sitemapindex {ns}><sitemap><loc>https://host.example/a.xml.gz</loc></sitemap></sitemapindex>")
    entries = captures.sitemaps(spark, str(tmp_path))
    assert entries.where("kind = 'index'").count() == 1
    got = captures.sitemap_products(entries, HOST).collect()
    assert [(r["slug"], str(r["lastmod"].date())) for r in got] == [("alpha", "2024-03-01")]


def test_zipped_csv_and_dump(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("b.csv", "﻿Name,URL\nlater,https://host.example/products/x\n")
        z.writestr("a.csv", "Name,URL\nfirst,https://host.example/products/x\n,\n")
    rows = captures.zipped_csv(spark, f"{tmp_path}/d.zip")
    got = captures.last_per_slug(rows, captures.product_slug(F.col("fields")["URL"], HOST)).collect()
    assert [(r["slug"], r["fields"]["Name"]) for r in got] == [("x", "later")]
    (tmp_path / "dump.json").write_text('{"users": [\n{"id": 9},\n"products": [\n{"id": 1, "slug": "a"},\n{"id": 2, "slug": "b"}\n"posts": [\n{"id": 3}\n]}')
    assert [r["slug"] for r in captures.sectioned_json(spark, f"{tmp_path}/dump.json", "products", "posts", "id long, slug string").collect()] == ["a", "b"]


def test_http_bodies(spark):
    chunked = b"WARC/1.0\r\nA: b\r\n\r\nHTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nWiki\r\n5\r\npedia\r\n0\r\n\r\n"
    zipped = gzip.compress(b"WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(b"page"))
    rows = spark.createDataFrame([(chunked,), (zipped,), (b"junk",), (None,)], "r binary")
    assert [r[0] and bytes(r[0]) for r in rows.select(captures.bodies(F.col("r"))).collect()] == [b"Wikipedia", b"page", None, None]


PAGE = """<html><head><title>Demo | Catalogue</title><meta property="og:title" content="Demo: The tool for tests | Catalogue"><meta name="description" content="Meta &amp; text">
<script type="application/ld+json">{"@graph": [{"@type": "WebSite", "description": "site"}, {"@type": "Product", "url": "https://host.example/products/demo", "name": "LD name", "description": "LD text"}]}</script>
<script>window.x = {"list": [{"slug": "demo", "name": "Embedded"}, {"slug": "demo", "__typename": "Product", "tagline": "Embedded {tag}", "categories": [{"name": "A"}, "B", "A"]}]};</script></head>
<body><h1> Head </h1><a data-test="visit-button" href="https://demo.example/">go</a><a href="/products/other">o</a></body></html>"""


def test_product_pages(spark):
    rows = spark.createDataFrame([("demo", PAGE), ("other", PAGE), ("none", None)], "slug string, html string")
    parts = rows.withColumn("p", markup.page_parts(F.col("html"), F.col("slug")))
    fields = markup.product_fields(F.col("p"), F.col("slug"), F.concat(F.lit("https://host.example/products/"), F.col("slug")))
    got = {r["slug"]: r for r in parts.select("slug", *(c.alias(n) for n, c in fields.items())).collect()}
    d = got["demo"]
    assert (d["name"], d["tagline"], d["description"], d["website_url"], d["categories"]) == ("LD name", "Embedded {tag}", "LD text", "https://demo.example/", ["A", "B"])
    assert got["other"]["tagline"] is None and got["none"]["name"] is None and got["none"]["categories"] == []


def test_website_candidates(spark):
    site = """<title>Acme — Web sites that explain themselves</title><meta property="og:description" content="A long enough description of it."><meta name="twitter:description" content="a long enough description of it.">
<script type="application/ld+json">{"@type": "SoftwareApplication", "slogan": "Explain all the things"}</script><h1>Acme</h1>"""
    rows = spark.createDataFrame([("Acme", site), ("Acme", "<title>Home</title><h1>Welcome to our place</h1>")], "name string, html string")
    parts = rows.withColumn("p", markup.page_parts(F.col("html"), F.lit(None).cast("string")))
    got = parts.select(*(F.transform(markup.website_candidates(F.col("p"), F.col("name"), k), lambda x: F.concat_ws("=", x["source"], x["value"])).alias(k) for k in ("tagline", "description"))).collect()
    assert got[0]["tagline"] == ["json_ld_slogan=Explain all the things", "og_description=A long enough description of it.", "title=Web sites that explain themselves"]
    assert got[0]["description"] == ["og_description=A long enough description of it."] and got[1]["tagline"] == []


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("b", "B", "t", "d", "w", ["x"], "u", "fetched"), ("a", "A", None, "d", None, None, "u", "fetched"), ("c", None, None, None, None, None, "u", "retry")], "slug string, name string, tagline string, description string, website_url string, categories array<string>, product_url string, status string")
    assert exports.snapshot(rows, f"{tmp_path}/s") == 2
    again = exports.restored(rows.where("slug = 'a'"), spark, f"{tmp_path}/s").collect()
    assert [(r["slug"], r["status"], r["tagline_source"], len(r["content_hash"])) for r in again] == [("b", "fetched", "snapshot", 64)]
    for name in ("one", "two"):
        assert exports.compact_archive({"products": (rows.select("slug", "name"), "slug")}, f"{tmp_path}/{name}.tar.zst", 3) == {"products": 3}
    assert (tmp_path / "one.tar.zst").read_bytes() == (tmp_path / "two.tar.zst").read_bytes()
    tar = tarfile.open(fileobj=io.BytesIO(zstandard.ZstdDecompressor().decompress((tmp_path / "one.tar.zst").read_bytes(), max_output_size=1 << 20)))
    assert tar.getnames() == ["products.csv", "schema.json"]
    (tmp_path / "f").mkdir()
    (tmp_path / "f/x.bin").write_bytes(b"abc")
    found = exports.manifest(spark, f"{tmp_path}/f")
    assert exports.verify_manifest(found, found).count() == 0
    wrong = spark.createDataFrame([("x.bin", 3, "0"), ("y.bin", 1, "1")], "name string, bytes long, sha256 string")
    assert {(r["name"], r["problem"]) for r in exports.verify_manifest(wrong, found).collect()} == {("x.bin", "hash"), ("y.bin", "missing")}


def test_command_line(spark, tmp_path, capsys, sf_dir):
    from tessera.__main__ import main

    assert main(["list", "--sf", sf_dir, "dashboard_labels"]) == 0 and "1-URGENT" in capsys.readouterr().out
    assert main(["snapshot", "--sf", sf_dir, f"{tmp_path}/s"]) == 0 and "products" in capsys.readouterr().out
    assert main(["search", "--sf", sf_dir, "--label", "1-URGENT", "--limit", "2"]) == 0
    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.bin").write_bytes(b"1")
    exports.manifest(spark, f"{tmp_path}/f").write.parquet(f"{tmp_path}/m")
    assert main(["verify", f"{tmp_path}/f", f"{tmp_path}/m"]) == 0
