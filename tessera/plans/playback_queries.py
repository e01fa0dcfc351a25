"""As-of joins and playback over the driver's tables, with SQL for each.

Errors of users look for the view of the same user nearest in time; view events are captures, in hours so that some fall together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.asof import DAY, nearest
from tessera.plans import playback
from tessera.sources.binding import read


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = read(spark, d, "events").withColumn("ts", F.date_trunc("hour", "ts"))
    user = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id"))  # one user has a third of all rows
    # some have no key or time, and some users no captures at all
    left = e.where("event_type <> 'view'").select("event_id", F.when(F.col("event_id") % 50 > 0, user).alias("user_id"), F.when(F.col("event_id") % 70 > 0, F.col("ts")).alias("ts"))
    right = e.where("event_type = 'view'").select(F.col("event_id").alias("capture_id"), user.alias("user_id"), "ts", "value").where("user_id % 7 > 0")
    return left, right


def _found(spark: SparkSession, d: str, side: str, span: int) -> DataFrame:
    left, right = _sides(spark, d)
    return nearest(left, right, "user_id", "ts", ["capture_id"], side, span).select("event_id", F.col("found.capture_id").alias("capture_id"), F.col("found.value").alias("value"))


def archive_nearest(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, "either", DAY)


def archive_latest_before(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, "before", 3 * DAY)


def archive_first_after(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d, "after", 7 * DAY)


def archive_playback(spark: SparkSession, d: str) -> DataFrame:
    """Customers as lost products, views as captures of them, pages as what playback gives."""
    targets = read(spark, d, "customer").select(F.concat(F.lit("p"), F.col("c_custkey")).alias("slug"), F.lit(1).cast("long").alias("attempt"))
    views = read(spark, d, "events").where("event_type = 'view'")
    digits = F.when(F.col("event_id") % 9 > 0, F.date_format("ts", "yyyyMMddHHmmss")).otherwise("unknown")
    captures = views.select(F.concat(F.lit("p"), F.col("user_id")).alias("slug"), digits.alias("timestamp"), F.col("event_id").alias("capture_id"))
    html = read(spark, d, "pages").select(F.col("page_id"), "html")
    pages = views.join(html, F.col("user_id") == F.col("page_id"), "left").select(F.col("event_id").alias("capture_id"), F.lit(200).alias("http_status"), "html")
    url = F.concat(F.lit("https://catalogue.example/products/"), F.col("slug"))
    rows = playback.replayed(targets, captures, pages, F.to_timestamp(F.lit("2024-01-15 12:00:00")), url)
    return rows.select("slug", "attempt", "capture_timestamp", F.col("outcome").isin("no_capture", "retry").alias("without_page"))


QUERIES = {f.__name__: f for f in (archive_nearest, archive_latest_before, archive_first_after, archive_playback)}

_SIDES = """
e AS (SELECT event_id, date_trunc('hour', ts) AS ts, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS u, event_type, value FROM events),
l AS (SELECT event_id, CASE WHEN event_id % 50 > 0 THEN u END AS u, CASE WHEN event_id % 70 > 0 THEN ts END AS ts FROM e WHERE event_type <> 'view'),
r AS (SELECT u, ts, max(event_id) AS capture_id, max_by(value, event_id) AS value FROM e WHERE event_type = 'view' AND u % 7 > 0 GROUP BY u, ts),
b AS (SELECT l.event_id, l.ts, r.ts AS at, capture_id, value FROM l ASOF LEFT JOIN r ON l.u = r.u AND l.ts >= r.ts),
a AS (SELECT l.event_id, l.ts, r.ts AS at, capture_id, value FROM l ASOF LEFT JOIN r ON l.u = r.u AND l.ts <= r.ts)"""
SQL = {
    "archive_nearest": f"""
WITH {_SIDES}
SELECT b.event_id, CASE WHEN later THEN a.capture_id ELSE b.capture_id END AS capture_id, CASE WHEN later THEN a.value ELSE b.value END AS value
FROM (SELECT b.event_id AS id, a.at IS NOT NULL AND (b.at IS NULL OR a.at - a.ts < b.ts - b.at) AS later FROM b JOIN a ON a.event_id = b.event_id) c JOIN b ON b.event_id = id JOIN a ON a.event_id = id""",
    "archive_latest_before": f"WITH {_SIDES} SELECT event_id, capture_id, value FROM b",
    "archive_first_after": f"WITH {_SIDES} SELECT event_id, capture_id, value FROM a",
    "archive_playback": """
WITH c AS (
  SELECT user_id, date_trunc('second', ts) AS t, max(event_id) AS id FROM events WHERE event_type = 'view' AND event_id % 9 > 0 GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY abs(epoch_us(t) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')), t) AS i FROM c)
SELECT 'p' || c_custkey AS slug, CAST(1 AS BIGINT) AS attempt, CASE WHEN html IS NOT NULL THEN strftime(t, '%Y%m%d%H%M%S') END AS capture_timestamp, html IS NULL AS without_page
FROM customer LEFT JOIN n ON user_id = c_custkey AND i = 1 LEFT JOIN pages ON page_id = user_id""",
}
