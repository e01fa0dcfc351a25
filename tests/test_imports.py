"""Other catalogues' files on small inline inputs."""

import zipfile

from tessera.sources import imports as I

HOST = "host.example"


def by(rows, *columns):
    return {r["slug"]: tuple(r[c] for c in columns) for r in rows.collect()}


def test_launch_exports(spark, tmp_path):
    (tmp_path / "l.csv").write_text(
        "slug,name,tagline,description,website,ph_url,launch_date,topic_slugs\n"
        "one-2,One,Second,,https://x.example/r/ABC,https://host.example/products/one,2024-02-01,a|b\n"
        'one,One,First,"A, long\ntext",https://x.example/r/ABC,https://host.example/products/one,2024-01-01,a| b |\n'
        "two,Two,T,,https://two.example,,2024-01-01,\n"
    )
    (tmp_path / "r.csv").write_text("start url,redirect to\nhttps://x.example/r/abc,\nhttps://x.example/r/ABC,https://one.example\nhttps://x.example/none,https://z.example\n")
    rows = I.launches(spark, f"{tmp_path}/l.csv", HOST)
    links = I.redirects(spark, f"{tmp_path}/r.csv", "start url", "redirect to")
    assert [(r["token"], r["direct_url"]) for r in links.collect()] == [("abc", "https://one.example")]
    got = by(I.with_direct_sites(rows, links), "tagline", "description", "website_url", "categories")
    assert got == {"one": ("First", "A, long\ntext", "https://one.example", ["a", "b"]), "two": ("T", None, "https://two.example", [])}
    dump = spark.createDataFrame([("two", "", "New", "D", None)], "slug string, name string, tagline string, description string, website_url string")
    assert by(I.filled_from(rows, dump), "name", "tagline", "description")["two"] == ("Two", "New", "D")


def test_metadata(spark, tmp_path):
    (tmp_path / "m.csv").write_text("homepage,url,name,description,title\nhttps://a.example,https://host.example/products/a,A,text,A: does things\nhttps://b.example,https://host.example/products/b,B,,B - x\nhttps://c.example,https://host.example/products/c,C,text,C - y\n")
    known = spark.createDataFrame([("c",)], "slug string")
    assert by(I.metadata(spark, f"{tmp_path}/m.csv", HOST, known), "tagline", "website_url") == {"a": ("does things", "https://a.example")}


def test_zipped_reports(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("1.csv", "Name,Tagline,URL,Website,Topics,Description\nX,T,https://host.example/products/x,https://x.example,\"AI, ,Dev\",\n,T,https://host.example/products/y,,,\n")
    assert by(I.daily(spark, f"{tmp_path}/d.zip", HOST), "name", "description", "categories") == {"x": ("X", "T", ["AI", "Dev"])}
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        z.writestr("a.md", "# x\n| [Tom &amp; Co](https://host.example/products/tom) | Fine &lt;tag&gt; <details><summary>more</summary>Long<br>text</details> |\n| no link | x |\n")
        z.writestr("b.md", "| [Tom](https://host.example/products/tom?ref=1) | Later |\n")
    assert by(I.markdown(spark, f"{tmp_path}/m.zip", HOST), "name", "tagline", "description") == {"tom": ("Tom", "Later", "Later")}
    with zipfile.ZipFile(tmp_path / "n.zip", "w") as z:
        z.writestr("a.md", "| [Tom &amp; Co](https://host.example/products/tom) | Fine &lt;tag&gt; <details><summary>more</summary>Long<br>text</details> |\n")
    assert by(I.markdown(spark, f"{tmp_path}/n.zip", HOST), "name", "tagline", "description") == {"tom": ("Tom & Co", "Fine <tag>", "Long\ntext")}
