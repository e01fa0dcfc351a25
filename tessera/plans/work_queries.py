"""Sectioned dumps, batches, shards, listings, logs and samples over the driver's tables, with SQL for each."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import folded
from tessera.operators.batches import FIELD, HEAD, slug_batches
from tessera.operators.samples import failure_samples
from tessera.plans.events import EventLog, durations
from tessera.plans.shards import MENTION_ROWS, Shards, mentions
from tessera.sources import indexes
from tessera.sources.binding import read
from tessera.sources.scratch import folder
from tessera.sources.sections import section_objects, selected_objects

#: Order keys of a dump: as one task writes it, a larger table has more dumps and not larger ones.
DUMP = 500_000


def dump_section(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the products of dumps, dumps of at most DUMP keys for each status, with other sections before and after; the last order of each customer is taken."""
    o = read(spark, d, "orders").withColumn("part", F.lpad(F.floor(F.col("o_orderkey") / DUMP).cast("string"), 12, "0"))
    line = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("slug"), F.col("o_orderpriority").alias("name")))
    body = o.select("o_orderstatus", "part", F.lit(3).alias("s"), F.col("o_orderkey").alias("n"), F.concat(F.lit("    "), line, F.lit(",")).alias("value"))
    posts = o.select("o_orderstatus", "part", F.lit(5).alias("s"), F.col("o_orderkey").alias("n"), F.concat(F.lit("    "), line, F.lit(",")).alias("value"))
    marks = [(0, "{"), (1, '  "users": ['), (2, "  ],"), (2, '  "products": ['), (4, "  ],"), (4, '  "posts": ['), (6, "  ]"), (6, "}")]
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("s"), F.lit(i).cast("long").alias("n"), F.lit(v).alias("value")) for i, (s, v) in enumerate(marks))))
    frame = o.select("o_orderstatus", "part").distinct().select("o_orderstatus", "part", each.alias("m")).select("o_orderstatus", "part", "m.*")
    path = folder(spark, "dump")
    lines = body.unionByName(posts).unionByName(frame).repartition(F.col("o_orderstatus"), F.col("part")).sortWithinPartitions("o_orderstatus", "part", "s", "n")
    lines.select("o_orderstatus", "part", "value").write.partitionBy("o_orderstatus", "part").text(path)
    objects = section_objects(spark, path, "products", "posts", "id long, slug string, name string")
    wanted = read(spark, d, "customer").where("c_custkey % 4 > 0").select(F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("slug"))
    objects = objects.withColumn("file", F.regexp_extract("file", "o_orderstatus=([^/]*/part=[^/]*)/", 1))
    return selected_objects(objects, wanted).select("slug", F.col("r.id").alias("id"), F.col("r.name").alias("name"))


def lookup_batches(spark: SparkSession, d: str) -> DataFrame:
    """Slugs of very different lengths, each twice."""
    c = read(spark, d, "customer")
    slug = F.concat_ws("-", F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.repeat("c_mktsegment", (F.col("c_custkey") % 40).cast("int")), F.lit('"é'))
    rows = c.select(slug.alias("slug")).union(c.select(F.when(F.col("c_custkey") % 2 == 0, slug).alias("slug")))
    return slug_batches(rows, "slug").select("slug", "batch", "part", "place", "size")


def _model(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit("[A-Z][a-z]{3,}"), F.lit(0))
    one = lambda w, i: F.struct(w.alias("text"), F.when(F.length(w) % 2 == 0, "Even").otherwise("Odd").alias("label"), (F.length(w) / 32).cast("float").alias("score"), i.alias("start"), (i + F.length(w)).alias("end"))
    return F.transform(words, one)


def sharded_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Capitalised words of all documents as a model's mentions, by shards."""
    docs = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("slug"), "lang", "text")
    first = F.regexp_extract("text", "[A-Z][a-z]{3,}", 0)
    docs = docs.select("slug", F.when(F.col("slug").cast("long") % 3 == 0, first).alias("name"), F.lit(None).cast("string").alias("tagline"), F.col("text").alias("description"))
    shards = Shards(spark, folder(spark, "shards"), {"model": "capitals", "labels": ["Even", "Odd"]}, 8)
    shards.run(docs, "slug", lambda rows: mentions(rows, _model, "capitals", "catalogue"), wave=4, level=3)
    return shards.read(MENTION_ROWS).drop("shard")


def _listing(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = read(spark, d, "orders")
    k = F.col("o_orderkey")
    letter = F.expr(f"substring('{indexes.PREFIXES}', CAST(o_orderkey % 34 AS INT) + 1, 1)")
    url = F.when(k % 97 > 0, F.concat(F.lit("https://catalogue.example/products/"), F.when((k % 34 == 5) & (k % 35 == 0), "zz").otherwise(letter), F.col("o_custkey").cast("string")))
    pages = o.select(letter.alias("prefix"), F.floor(k / 5000).alias("page"), url.alias("url"))
    counts = pages.groupBy("prefix").agg((F.max("page") + 1).alias("pages"))
    shift = F.when(F.col("prefix") == "c", 1).when(F.col("prefix") == "d", -1).otherwise(0)
    return pages, counts.where("prefix <> 'b'").select("prefix", (F.col("pages") + shift).alias("pages"))


def prefix_report(spark: SparkSession, d: str) -> DataFrame:
    return indexes.prefix_listing(*_listing(spark, d))[1]


def prefix_addresses(spark: SparkSession, d: str) -> DataFrame:
    return indexes.prefix_listing(*_listing(spark, d))[0]


def event_log(spark: SparkSession, d: str) -> DataFrame:
    """Counters that a run's steps left in the log."""
    log = EventLog(spark, folder(spark, "events"))
    for name in ("orders", "lineitem", "documents"):
        with log.step(name) as step:
            rows = read(spark, d, name)
            key = F.col(rows.columns[0])
            step.watch(rows, rows=F.count(F.lit(1)), even=F.count_if(key % 2 == 0)).write.format("noop").mode("overwrite").save()
            step.count(steps=1)
    rows = durations(log.events()).where("elapsed_seconds >= 0")
    return rows.select("name", "event", F.explode("counters").alias("counter", "n"))


def failure_sample(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("lang", "doc_id", (F.col("doc_id") % 3).alias("attempt"), F.when(F.col("doc_id") % 4 > 0, F.col("text")).alias("text"))
    rows = failure_samples(docs, "lang", "doc_id", "attempt", "text", 10, 1000)
    return rows.select("kind", "file_name", F.length("body").cast("long").alias("n_bytes"), F.md5("body").alias("digest"))


def text_folding(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    text = F.concat("text", F.lit(" Straße ſchön İZMİR ΟΔΟΣ ΣΑΣ. ﬁ ẞ Ǆ"))
    return docs.select("doc_id", F.sha2(folded(text), 256).alias("digest"))


QUERIES = {f.__name__: f for f in (dump_section, lookup_batches, sharded_mentions, prefix_report, prefix_addresses, event_log, failure_sample, text_folding)}


def _halved(levels: int, limit: int) -> str:
    head, field = len(HEAD) + 2, len(FIELD)
    size = f"sum(bytes + length(CAST(place AS VARCHAR))) OVER w + count(*) OVER w - 1 + {head}"
    steps = [f"""
k AS (
  SELECT DISTINCT concat_ws('-', lpad(CAST(c_custkey AS VARCHAR), 9, '0'), repeat(c_mktsegment, CAST(c_custkey % 40 AS INTEGER)), '"é') AS slug FROM customer),
p0 AS (
  SELECT slug, (i - 1) // 100 AS batch, CAST(0 AS BIGINT) AS part, (i - 1) % 100 AS place, strlen(slug) + 3 + {len(':product(slug:)') + 1 + field} AS bytes FROM (SELECT slug, row_number() OVER (ORDER BY slug) AS i FROM k))"""]
    for n in range(levels):
        steps.append(f"""
p{n + 1} AS (
  SELECT slug, batch, part * 2 + CASE WHEN large AND place >= half THEN 1 ELSE 0 END AS part, CASE WHEN large AND place >= half THEN place - half ELSE place END AS place, bytes
  FROM (SELECT *, {size} > {limit} AS large, count(*) OVER w // 2 AS half FROM p{n} WINDOW w AS (PARTITION BY batch, part)))""")
    return f"WITH {','.join(steps)}\nSELECT slug, batch, part, place, CAST({size} AS BIGINT) AS size FROM p{levels} WINDOW w AS (PARTITION BY batch, part)"


_LISTING = f"""
p AS (
  SELECT substr('{indexes.PREFIXES}', CAST(o_orderkey % 34 AS INTEGER) + 1, 1) AS prefix, o_orderkey // 5000 AS page, o_orderkey AS k,
    CASE WHEN o_orderkey % 97 > 0 THEN CASE WHEN o_orderkey % 34 = 5 AND o_orderkey % 35 = 0 THEN 'zz' ELSE substr('{indexes.PREFIXES}', CAST(o_orderkey % 34 AS INTEGER) + 1, 1) END || o_custkey END AS tail FROM orders),
c AS (SELECT prefix, CAST(max(page) + CASE prefix WHEN 'c' THEN 2 WHEN 'd' THEN 0 ELSE 1 END AS BIGINT) AS pages FROM p WHERE prefix <> 'b' GROUP BY prefix),
r AS (
  SELECT prefix, count(DISTINCT page) AS pages_read, max(page) AS last, count(*) AS lines, count(*) FILTER (tail IS NULL) AS malformed, count(DISTINCT tail) AS addresses, count(*) FILTER (NOT starts_with(tail, prefix)) AS foreign_ FROM p GROUP BY prefix),
e AS (SELECT unnest(string_split('{','.join(indexes.PREFIXES)}', ',')) AS prefix),
t AS (
  SELECT e.prefix, pages, coalesce(pages_read, 0) AS pages_read, coalesce(lines, 0) AS lines, coalesce(malformed, 0) AS malformed, coalesce(addresses, 0) AS addresses,
    CASE WHEN pages IS NULL THEN 'not asked' WHEN coalesce(pages_read, 0) < pages THEN 'pages missing' WHEN last >= pages THEN 'pages too many' WHEN foreign_ > 0 THEN 'addresses of another prefix' END AS problem
  FROM e LEFT JOIN c ON c.prefix = e.prefix LEFT JOIN r ON r.prefix = e.prefix)"""

SQL = {
    "dump_section": """
SELECT 'p' || o_custkey AS slug, max_by(o_orderkey, (o_orderstatus, o_orderkey)) AS id, max_by(o_orderpriority, (o_orderstatus, o_orderkey)) AS name FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 4 > 0 GROUP BY o_custkey""",
    "lookup_batches": _halved(math.ceil(math.log2(100)), 24_000),
    "sharded_mentions": """
WITH d AS (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN regexp_extract(text, '[A-Z][a-z]{3,}') END AS name, CASE WHEN text <> '' THEN regexp_extract_all('Description: ' || text, '[A-Z][a-z]{3,}') END AS w FROM documents),
m AS (SELECT doc_id, lower(name) AS own, unnest(w) AS w, unnest(range(len(w))) AS i FROM d),
k AS (SELECT * FROM m WHERE NOT coalesce((lower(w) = own) OR (length(w) >= 5 AND contains(own, lower(w))), false) AND lower(w) <> 'catalogue'),
b AS (SELECT doc_id, max_by(w, -i) AS w, min(i) AS i FROM k GROUP BY doc_id, lower(w))
SELECT CAST(doc_id AS VARCHAR) AS slug, w AS entity_text, CASE WHEN length(w) % 2 = 0 THEN 'Even' ELSE 'Odd' END AS label, CAST(length(w) / 32 AS FLOAT) AS score, CAST(i AS INTEGER) AS start, CAST(i + length(w) AS INTEGER) AS "end", 'capitals' AS model FROM b""",
    "prefix_report": f"WITH {_LISTING} SELECT * FROM t",
    "prefix_addresses": f"WITH {_LISTING} SELECT DISTINCT 'https://catalogue.example/products/' || tail AS url FROM p JOIN t ON p.prefix = t.prefix WHERE tail IS NOT NULL AND problem IS NULL",
    "event_log": " UNION ALL ".join(
        f"SELECT '{t}' AS name, 'step_finished' AS event, unnest(['rows', 'even', 'steps']) AS counter, unnest([count(*), count(*) FILTER ({k} % 2 = 0), 1]) AS n FROM {t}" for t, k in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("documents", "doc_id"))
    ),
    "failure_sample": """
WITH r AS (
  SELECT lang, doc_id, text, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '-' || doc_id % 3), CAST(doc_id AS VARCHAR)) AS i FROM documents WHERE doc_id % 4 > 0 AND text IS NOT NULL),
b AS (SELECT *, substr(hex(encode(text)), 1, 2000) AS h FROM r WHERE i <= 10)
SELECT lang AS kind, doc_id || '-attempt-' || doc_id % 3 || '.html' AS file_name, length(h) // 2 AS n_bytes, md5(unhex(h)) AS digest FROM b""",
    # what lower() alone leaves: the letters with a longer or another folding that the texts hold
    "text_folding": """
SELECT doc_id, sha256(replace(replace(replace(replace(replace(lower(replace(text || ' Straße ſchön İZMİR ΟΔΟΣ ΣΑΣ. ﬁ ẞ Ǆ', 'İ', 'i̇')), 'ß', 'ss'), 'ſ', 's'), 'ς', 'σ'), 'ﬁ', 'fi'), 'ẞ', 'ss')) AS digest FROM documents""",
}
