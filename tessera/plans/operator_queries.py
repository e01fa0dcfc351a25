"""Queries of single operators over the driver's tables, with their SQL: scalar functions, entity rules, merges,
queues, set operations and pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import vocabulary as V
from tessera.operators import entities as E
from tessera.operators import merge as M
from tessera.sources.binding import OWN_HOST, read

#: Mention texts that the events are taken to hold, by number.
MENTIONS = (
    "Windows 11 Pro", "mac-os", "Python", "next.js", "Java", "C", "PDFs and more", "yml file", "Slack", "google_drive", "saas", "Data Engineers",
    "AI designers", "HR professionals", "users", "restaurants", "E-Commerce", "banks", "healthcare", "iPhones", "device", "smartwatches", "Ubuntu", "nothing",
)


def functions_url(spark: SparkSession, d: str) -> DataFrame:
    """Hosts of page addresses, and the slug of a catalogue address made of them."""
    rows = read(spark, d, "pages").select("page_id", "url")
    own = F.concat(F.lit(f"https://www.{OWN_HOST}/products/Item-"), "page_id", F.when(F.col("page_id") % 3 == 0, ".png").otherwise("?ref=x"))
    return rows.select("page_id", T.website_host(F.col("url")).alias("host"), T.product_slug(own, OWN_HOST).alias("slug"), T.product_slug(F.col("url"), OWN_HOST).alias("foreign_slug"))


def functions_text(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select("doc_id", "text", "lang", "source")
    words = F.split("lang", "")
    return rows.select(
        "doc_id",
        T.trimmed_length(F.col("text")).cast("long").alias("characters"),
        T.blank(F.col("text")).alias("blank"),
        T.present(F.col("text")).alias("present"),
        T.sql_content_hash([F.col("lang"), F.col("source"), F.col("text")], words).alias("content_hash"),
        (F.length(F.trim(F.concat(F.coalesce("lang", F.lit("")), F.lit(" "), F.coalesce("source", F.lit(""))))) >= 8).alias("long_enough"),
    )


def functions_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return rows.select(
        "p_partkey",
        F.array_join(T.split_nonblank(F.col("p_name"), " "), "|").alias("words"),
        T.clean_entity(F.concat_ws("_", "p_brand", "p_type")).alias("clean"),
        T.compact_name(F.col("p_brand")).alias("compact"),
        T.is_self_name(F.split("p_name", " ")[0], F.col("p_name")).alias("is_self"),
        T.without_prefix(F.concat_ws(": ", "p_brand", "p_name"), F.col("p_brand")).alias("tagline"),
    )


def functions_events(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "events").select("event_id", "props", "user_id")
    status = F.element_at(F.array(*(F.lit(s) for s in (200, 301, 403, 404, 410, 429, 500, 503))), (F.pmod("event_id", F.lit(8)) + 1).cast("int"))
    even = F.pmod("user_id", F.lit(2)) == 0
    return rows.select(
        "event_id",
        T.safe_json_int(F.col("props"), "$.k").alias("k"),
        T.offset_cursor(F.col("event_id")).alias("page_cursor"),
        T.retry_delay(F.pmod("event_id", F.lit(12))).alias("delay"),
        T.http_outcome(status, even).alias("outcome"),
        T.website_outcome(status, even, F.pmod("user_id", F.lit(3)) == 0).alias("website_outcome"),
    )


def mentions(spark: SparkSession, d: str) -> DataFrame:
    n = F.lit(len(MENTIONS))
    e = read(spark, d, "events").select("event_id", "user_id")
    pick = lambda some, i: F.element_at(F.array(*(F.lit(x) for x in some)), (i + 1).cast("int"))
    return e.select(
        F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("slug"),
        pick(V.LABELS, F.pmod(F.floor(F.col("event_id") / n), F.lit(8))).alias("label"),
        pick(MENTIONS, F.pmod("event_id", n)).alias("entity_text"),
        (F.pmod("event_id", F.lit(97)) / F.lit(96.0)).alias("score"),
    )


def entities_filtered(spark: SparkSession, d: str) -> DataFrame:
    return E.filtered(mentions(spark, d)).withColumn("score", F.round("score", 9))


def entities_per_product(spark: SparkSession, d: str) -> DataFrame:
    rows = mentions(spark, d)
    names = rows.select("slug").distinct().withColumn("name", F.concat(F.lit("Python Slack "), "slug"))
    return E.per_product(rows, names).withColumn("score", F.round("score", 9))


def entities_audit_sample(spark: SparkSession, d: str) -> DataFrame:
    return E.audit_sample(E.filtered(mentions(spark, d)), "seed", 10, 5, 40).select("slug", "entity_type", "canonical_value", "audit_stratum")


def audit_rates(spark: SparkSession, d: str) -> DataFrame:
    """Labels as verdicts over documents, by language and by source."""
    rows = read(spark, d, "documents").select("doc_id", "lang", "source").join(read(spark, d, "labels"), "doc_id")
    rows = rows.select("lang", "source", (F.col("quality") == 1).alias("type_correct"), (F.col("toxic") == 0).alias("relevant"))
    return E.audit_rates(rows, "lang").unionByName(E.audit_rates(rows, "source"))


def queue_claim(spark: SparkSession, d: str) -> DataFrame:
    """Events as a queue: the next hundred to work on."""
    e = read(spark, d, "events")
    rows = e.select(
        F.col("event_id").cast("string").alias("slug"),
        F.when(F.col("event_type") == "click", "pending").when(F.col("event_type") == "view", "retry").otherwise("fetched").alias("status"),
        F.pmod("event_id", F.lit(6)).alias("attempts"),
        F.when(F.pmod("event_id", F.lit(4)) == 0, F.col("event_id")).alias("next_retry_at"),
        F.when(F.pmod("event_id", F.lit(5)) > 0, F.floor("value").cast("long")).alias("source_lastmod"),
        F.pmod("event_id", F.lit(50)).alias("first_seen_at"),
    )
    return M.claim(rows, F.lit(5000), 100, 5).drop("next_retry_at")


_RULES = {"event_type": "last", "k": "last_set", "first_k": "first_set", "value": "max", "seen": "sum", "odd": "any"}


def _event_batches(spark: SparkSession, d: str) -> DataFrame:
    k = T.safe_json_int(F.col("props"), "$.k")
    return read(spark, d, "events").select(
        "event_id", "user_id", "event_type", F.when(F.pmod("event_id", F.lit(3)) == 0, k).alias("k"), F.when(F.pmod("event_id", F.lit(7)) == 0, k).alias("first_k"),
        "value", F.lit(1).cast("long").alias("seen"), (F.pmod("event_id", F.lit(11)) == 0).alias("odd"),
    )


def merge_batches(spark: SparkSession, d: str) -> DataFrame:
    """Events in two batches folded and merged by user: the same as one fold over all."""
    rows = _event_batches(spark, d)
    first, second = (M.fold(rows.where(c), "user_id", _RULES, "event_id") for c in ("event_id % 1000 < 500", "event_id % 1000 >= 500"))
    # batches apply in order, so the second one's events come last
    return M.merge(first, second, "user_id", _RULES)


def insert_missing(spark: SparkSession, d: str) -> DataFrame:
    """Customers without orders in two states; keys known anywhere are left out."""
    orders = read(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus")
    customers = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    return M.insert_missing(orders.where("o_orderstatus = 'F'"), customers, "k", orders.where("o_orderstatus = 'P'"))


def known_keys(spark: SparkSession, d: str) -> DataFrame:
    """Distinct union of two key sets."""
    a = read(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    return a.union(read(spark, d, "customer").where("c_acctbal < 0").select("c_custkey")).distinct()


def duplicate_copies(spark: SparkSession, d: str) -> DataFrame:
    """Groups of documents with one text, and the rows beyond the first in each."""
    groups = read(spark, d, "documents").groupBy(F.sha2("text", 256).alias("h")).count().where("count > 1")
    return groups.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra_rows"))


def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").where("o_orderkey > 100").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(50)


def latest_captures(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    rows = e.select(
        F.col("user_id").cast("string").alias("slug"), F.lpad(F.pmod("event_id", F.lit(977)).cast("string"), 14, "0").alias("capture_timestamp"),
        F.col("event_id").cast("string").alias("crawl_id"), F.when(F.pmod("event_id", F.lit(9)) == 0, "recovered").otherwise("pending").alias("outcome"), F.pmod("event_id", F.lit(4)).alias("attempts"),
    )
    return M.latest_captures(rows, 3)


def completeness(spark: SparkSession, d: str) -> DataFrame:
    from tessera.sources.binding import products

    return M.completeness(products(spark, d)).withColumn("completeness", F.round("completeness", 9))


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        functions_url, functions_text, functions_parts, functions_events, entities_filtered, entities_per_product, entities_audit_sample, audit_rates,
        queue_claim, merge_batches, insert_missing, known_keys, duplicate_copies, keyset_page, latest_captures, completeness,
    )
}


def _list(some) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in some) + "]"


def _in(some) -> str:
    return "(" + _list(some)[1:-1] + ")"


def _map(column: str, table: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {column} END"


_CLEAN = r"trim(regexp_replace(lower(trim({})), '[\s_/.-]+', ' ', 'g'))"
_COMPACT = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"
_MENTIONS = f"""
  SELECT 'p' || user_id AS slug, ({_list(V.LABELS)})[CAST((event_id // {len(MENTIONS)}) % 8 + 1 AS INTEGER)] AS label,
    ({_list(MENTIONS)})[CAST(event_id % {len(MENTIONS)} + 1 AS INTEGER)] AS entity_text, (event_id % 97) / CAST(96 AS DOUBLE) AS score FROM events"""
_SYSTEMS = " ".join(f"WHEN v = '{a}' OR starts_with(v, '{a} ') THEN '{n}'" for a, n in V.OPERATING_SYSTEMS.items())
_ACCEPTED = f"""
mentions AS ({_MENTIONS}),
supported AS (
  SELECT m.*, n AS support_products, {_CLEAN.format('m.entity_text')} AS v
  FROM mentions m JOIN (SELECT label, lower(entity_text) AS t, count(DISTINCT slug) AS n FROM mentions GROUP BY ALL) s ON m.label = s.label AND lower(m.entity_text) = s.t),
prepared AS (
  SELECT *, string_split(v, ' ') AS words, {_map('v', V.TECHNOLOGY_ALIASES)} AS tech,
    list_filter(list_transform(regexp_extract_all(v, '[a-z0-9]+'), lambda t: {_map('t', V.FILE_PLURALS)}), lambda t: t IN {_in(V.FILE_FORMATS)})[1] AS form,
    coalesce(CASE v {' '.join(f"WHEN '{k}' THEN '{x}'" for k, x in V.INDUSTRY_CANONICAL.items())} END, regexp_replace(v, 's$', '')) AS ind,
    CASE {_SYSTEMS} END AS os
  FROM supported),
typed AS (
  SELECT *, CASE
    WHEN label = 'operating system' THEN CASE WHEN os IS NOT NULL THEN 'operating_system' END
    WHEN label = 'file format' THEN CASE WHEN form IS NOT NULL THEN 'file_format' END
    WHEN label IN ('programming language or framework', 'technical method or standard') THEN
      CASE WHEN tech IN {_in(V.TECHNOLOGIES)} AND score >= CASE WHEN tech IN ('c', 'java') THEN 0.9 ELSE 0.68 END THEN 'technology_or_tool' END
    WHEN label = 'external software service' THEN CASE WHEN support_products >= 3 AND score >= 0.7 AND v NOT IN {_in(V.GENERIC_SERVICES)} AND v IN {_in(V.PLATFORMS)} THEN 'external_platform_mentioned' END
    WHEN label = 'professional role' THEN CASE WHEN support_products >= 2 AND score >= 0.72 AND v NOT IN {_in(V.GENERIC_ROLES)} AND NOT starts_with(v, 'ai ') AND NOT contains(v, ' and ')
      AND (list_has_any(words, {_list(V.ROLE_NOUNS)}) OR v IN {_in(V.ROLE_ABBREVIATIONS)} OR (list_has_any(words, {_list(V.ROLE_QUALIFIERS)}) AND list_has_any(words, ['professional', 'professionals']))) THEN 'audience_role' END
    WHEN label = 'industry sector' THEN CASE WHEN v IN {_in(V.INDUSTRIES)} OR ind IN {_in(V.INDUSTRIES)} OR v = 'e commerce' THEN 'industry' END
    WHEN label = 'hardware device' THEN CASE WHEN support_products >= 2 AND score >= 0.75 AND v NOT IN {_in(V.GENERIC_HARDWARE)} THEN 'hardware' END
  END AS entity_type
  FROM prepared),
accepted AS (
  SELECT slug, entity_type, CASE entity_type
      WHEN 'operating_system' THEN os WHEN 'file_format' THEN {_map('form', V.FILE_CANONICAL)} WHEN 'technology_or_tool' THEN tech WHEN 'industry' THEN ind
      WHEN 'audience_role' THEN array_to_string(list_concat(words[:-2], [{_map('words[-1]', V.ROLE_SINGULARS)}]), ' ') WHEN 'hardware' THEN {_map('v', V.HARDWARE_ALIASES)} ELSE v END AS canonical_value,
    entity_text AS source_span, score, support_products, label
  FROM typed WHERE entity_type IS NOT NULL),
filtered AS (SELECT * EXCLUDE (label) FROM accepted QUALIFY row_number() OVER (PARTITION BY slug, entity_type, canonical_value ORDER BY score DESC, source_span, support_products DESC, label) = 1)"""
_HOST_SQL = r"lower(nullif(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:www\.)?([^/:?#]+)', 1), ''))"
_STATUS = "([200, 301, 403, 404, 410, 429, 500, 503])[CAST(event_id % 8 + 1 AS INTEGER)]"
_KEY = "slug || '|' || entity_type || '|' || canonical_value"

SQL: dict[str, str] = {
    "functions_url": f"""
SELECT page_id, {_HOST_SQL} AS host, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'item-' || page_id END AS slug, CAST(NULL AS VARCHAR) AS foreign_slug FROM pages""",
    "functions_text": """
SELECT doc_id, CAST(length(trim(coalesce(text, ''))) AS BIGINT) AS characters, coalesce(trim(text), '') = '' AS blank, text IS NOT NULL AND trim(text) <> '' AS present,
  sha256(concat_ws(chr(31), lang, source, text, array_to_string(string_split(lang, ''), chr(30)))) AS content_hash,
  length(trim(coalesce(lang, '') || ' ' || coalesce(source, ''))) >= 8 AS long_enough
FROM documents""",
    "functions_parts": f"""
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_name, ' '), lambda x: trim(x)), lambda x: x <> ''), '|') AS words,
  {_CLEAN.format("p_brand || '_' || p_type")} AS clean, {_COMPACT.format('p_brand')} AS compact,
  {_COMPACT.format("string_split(p_name, ' ')[1]")} = {_COMPACT.format('p_name')} OR (length({_COMPACT.format("string_split(p_name, ' ')[1]")}) >= 5 AND contains({_COMPACT.format('p_name')}, {_COMPACT.format("string_split(p_name, ' ')[1]")})) AS is_self,
  p_name AS tagline
FROM part""",
    "functions_events": f"""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, base64(CAST(CAST(event_id AS VARCHAR) AS BLOB)) AS page_cursor,
  CAST(least(3600, 15 * pow(2, greatest(0, event_id % 12 - 1))) AS BIGINT) AS delay,
  CASE WHEN s IN (403, 429) OR s >= 500 THEN 'retry' WHEN s >= 400 THEN 'unavailable' WHEN user_id % 2 <> 0 THEN 'parse_failed' ELSE 'fetched' END AS outcome,
  CASE WHEN s IN (401, 403, 429) THEN 'blocked' WHEN s >= 500 THEN 'retry' WHEN s >= 400 THEN 'unavailable' WHEN user_id % 2 <> 0 THEN 'non_html'
    WHEN user_id % 3 = 0 THEN 'enriched' ELSE 'no_metadata' END AS website_outcome
FROM (SELECT *, {_STATUS} AS s FROM events)""",
    "entities_filtered": f"WITH {_ACCEPTED} SELECT slug, entity_type, canonical_value, source_span, round(score, 9) AS score, support_products FROM filtered",
    "entities_per_product": f"""
WITH mentions AS ({_MENTIONS}),
m AS (SELECT *, {_COMPACT.format('entity_text')} AS compact, {_COMPACT.format("'Python Slack ' || slug")} AS n FROM mentions)
SELECT slug, label, entity_text, round(score, 9) AS score, compact FROM m WHERE NOT (compact = n OR (length(compact) >= 5 AND contains(n, compact)))
QUALIFY row_number() OVER (PARTITION BY slug, compact, label ORDER BY score DESC, entity_text) = 1""",
    "entities_audit_sample": f"""
WITH {_ACCEPTED},
a AS (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY sha256('seed|' || {_KEY})) AS i FROM filtered),
b AS (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY sha256('seed|rare|' || {_KEY})) AS j FROM a WHERE i > 10 AND support_products <= 40)
SELECT slug, entity_type, canonical_value, 'random' AS audit_stratum FROM a WHERE i <= 10
UNION ALL SELECT slug, entity_type, canonical_value, 'rare' AS audit_stratum FROM b WHERE j <= 5""",
    "audit_rates": " UNION ALL ".join(
        f"""SELECT '{g}' AS grouping, {g} AS value, count(*) AS items, round(CAST(count(*) FILTER (quality = 1) AS DOUBLE) / count(*), 9) AS precision,
  round(CAST(count(*) FILTER (toxic = 0) AS DOUBLE) / count(*), 9) AS relevance FROM documents JOIN labels USING (doc_id) GROUP BY {g}"""
        for g in ("lang", "source")
    ),
    "queue_claim": """
SELECT slug, 'retry' AS status, attempts + 1 AS attempts, source_lastmod, first_seen_at
FROM (
  SELECT CAST(event_id AS VARCHAR) AS slug, CASE event_type WHEN 'click' THEN 'pending' WHEN 'view' THEN 'retry' ELSE 'fetched' END AS status, event_id % 6 AS attempts,
    CASE WHEN event_id % 4 = 0 THEN event_id END AS next_retry_at, CASE WHEN event_id % 5 > 0 THEN CAST(floor(value) AS BIGINT) END AS source_lastmod, event_id % 50 AS first_seen_at
  FROM events)
WHERE status IN ('pending', 'retry') AND attempts < 5 AND coalesce(next_retry_at, 0) <= 5000
ORDER BY CASE status WHEN 'pending' THEN 0 ELSE 1 END, source_lastmod DESC NULLS LAST, first_seen_at, slug LIMIT 100""",
    "merge_batches": """
WITH e AS (
  SELECT user_id, event_type, value, (event_id % 1000 >= 500) AS late, event_id, CASE WHEN event_id % 3 = 0 THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
    CASE WHEN event_id % 7 = 0 THEN TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS first_k, event_id % 11 = 0 AS odd FROM events)
SELECT user_id, last(event_type ORDER BY late, event_id) AS event_type, last(k ORDER BY late, event_id) FILTER (k IS NOT NULL) AS k,
  first(first_k ORDER BY late, event_id) FILTER (first_k IS NOT NULL) AS first_k, max(value) AS value, count(*) AS seen, bool_or(odd) AS odd
FROM e GROUP BY user_id""",
    "insert_missing": "SELECT c_custkey AS k, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus IN ('F', 'P'))",
    "known_keys": "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0",
    "duplicate_copies": "SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows FROM (SELECT count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)",
    "keyset_page": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50",
    "latest_captures": """
SELECT CAST(user_id AS VARCHAR) AS slug, lpad(CAST(event_id % 977 AS VARCHAR), 14, '0') AS capture_timestamp, CAST(event_id AS VARCHAR) AS crawl_id, 'pending' AS outcome, event_id % 4 AS attempts
FROM events WHERE event_id % 9 <> 0 AND event_id % 4 < 3
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY lpad(CAST(event_id % 977 AS VARCHAR), 14, '0') DESC, CAST(event_id AS VARCHAR) DESC) = 1""",
    "completeness": """
SELECT count(*) AS fetched, count(text) AS complete, round(CAST(count(text) AS DOUBLE) / count(*), 9) AS completeness
FROM customer LEFT JOIN documents ON doc_id = c_custkey WHERE c_acctbal >= 0""",
}
