"""The mart's queries and their SQL, for the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import dashboard
from tessera.plans.mart import TABLES, Mart
from tessera.plans.oracle import over_mart
from tessera.sources.binding import relations

Query = Callable[[SparkSession, str], DataFrame]


def _table(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = getattr(Mart(relations(spark, sf_dir)), name)
        if name == "product_facts":  # arrays are compared as text
            rows = rows.withColumn("source_categories", F.array_join("source_categories", "|"))
        return rows

    return query


def _list(name: str) -> Query:
    return lambda spark, sf_dir: dashboard.ordered_list(Mart(relations(spark, sf_dir)), name)


_SEARCHES = {
    "search_text": {"query": "the "},
    "search_label_relaunches": {"label": "1-URGENT", "sort": "relaunches", "limit": 48},
    "search_facets_name": {"entity_type": "A", "entity": "Brand#11", "sort": "name", "offset": 5, "limit": 20},
}
_SEARCH_SQL = {
    "search_text": ("WHERE name ILIKE '%the%' OR slug ILIKE '%the%' OR tagline ILIKE '%the%' OR website_host ILIKE '%the%'", "latest_post_id DESC NULLS LAST, name, slug LIMIT 24"),
    "search_label_relaunches": ("WHERE slug IN (SELECT slug FROM product_labels WHERE label = '1-URGENT')", "launch_count DESC, latest_post_id DESC NULLS LAST, name LIMIT 48"),
    "search_facets_name": (
        "WHERE slug IN (SELECT slug FROM product_entities WHERE entity_type = 'A') AND slug IN (SELECT slug FROM product_entities WHERE canonical_value = 'Brand#11')",
        "name, slug LIMIT 20 OFFSET 5",
    ),
}


def _flat(rows: DataFrame) -> DataFrame:
    """Arrays are compared as text."""
    return rows.withColumn("source_categories", F.array_join("source_categories", "|"))


def _search(name: str) -> Query:
    return lambda spark, sf_dir: _flat(dashboard.search(Mart(relations(spark, sf_dir)), **_SEARCHES[name]))


def search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many products match, beside the page."""
    return dashboard.matching(Mart(relations(spark, sf_dir)), query="the ").agg(F.count(F.lit(1)).alias("total"))


def product_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _flat(dashboard.detail(Mart(relations(spark, sf_dir)), "p7"))
    text = lambda c, *names: F.array_join(F.transform(c, lambda x: F.concat_ws("=", *(x[n] for n in names))), "|")
    return rows.withColumns({"labels": text("labels", "label", "method"), "entities": text("entities", "entity_type", "canonical_value", "source_span", "method")})


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.health(Mart(relations(spark, sf_dir)))


def dashboard_composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every section of the dashboard."""
    return dashboard.composed(Mart(relations(spark, sf_dir))).groupBy("section").agg(F.count(F.lit(1)).alias("items"), F.max("place").cast("long").alias("last_place"))


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.table_rows(Mart(relations(spark, sf_dir)))


_FLAT = [", ".join("array_to_string(source_categories, '|') AS source_categories" if c == "source_categories" else c for c in some) for some in (dashboard.SEARCH_COLUMNS, dashboard.DETAIL_COLUMNS)]

QUERIES: dict[str, Query] = (
    {f"mart_{name}": _table(name) for name in (*TABLES, "core_metrics")}
    | {name: _list(name) for name in dashboard.LISTS}
    | {name: _search(name) for name in _SEARCHES}
    | {"search_total": search_total, "product_detail": product_detail, "health": health, "dashboard_composed": dashboard_composed, "table_rows": table_rows}
)

SQL: dict[str, str] = (
    {f"mart_{name}": over_mart(f"SELECT * FROM {name}") for name in (*TABLES, "core_metrics") if name != "product_facts"}
    | {"mart_product_facts": over_mart("SELECT * REPLACE (array_to_string(source_categories, '|') AS source_categories) FROM product_facts")}
    | {name: over_mart(dashboard.list_sql(name)) for name in dashboard.LISTS}
    | {name: over_mart(f"SELECT {_FLAT[0]}, count(*) OVER () AS total_matches FROM product_facts {where} ORDER BY {order}") for name, (where, order) in _SEARCH_SQL.items()}
    | {
        "search_total": over_mart(f"SELECT count(*) AS total FROM product_facts {_SEARCH_SQL['search_text'][0]}"),
        "product_detail": over_mart(
            f"""SELECT {_FLAT[1]},
  (SELECT string_agg(label || '=' || method, '|' ORDER BY score DESC, label) FROM product_labels WHERE slug = 'p7') AS labels,
  (SELECT string_agg(concat_ws('=', entity_type, canonical_value, source_span, method), '|' ORDER BY entity_type, canonical_value) FROM product_entities WHERE slug = 'p7') AS entities
FROM product_facts WHERE slug = 'p7'"""
        ),
        "health": over_mart("SELECT count(*) AS products FROM product_facts"),
        "dashboard_composed": over_mart(
            "SELECT 'metrics' AS section, 1 AS items, 1 AS last_place UNION ALL "
            + " UNION ALL ".join(f"SELECT '{name[10:]}', count(*), count(*) FROM ({dashboard.list_sql(name)}) HAVING count(*) > 0" for name in dashboard.LISTS if name.startswith("dashboard_"))
        ),
        "table_rows": over_mart(" UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS rows FROM {name}" for name in TABLES)),
    }
)
