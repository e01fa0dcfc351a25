"""Lists of the dashboard and report, product search, product detail and ad-hoc questions over the mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.mart import TABLES, Mart



def _sorts() -> dict[str, list[Column]]:
    """Sort orders of the search; an unknown name means the first."""
    return {
        "recent": [F.desc_nulls_last("latest_post_id"), F.asc_nulls_last("name"), F.asc("slug")],
        "relaunches": [F.desc("launch_count"), F.desc_nulls_last("latest_post_id"), F.asc_nulls_last("name"), F.asc("slug")],
        "name": [F.asc_nulls_last("name"), F.asc("slug")],
    }


#: Columns of a search result and of a product's fact row.
SEARCH_COLUMNS = (
    "slug", "name", "tagline", "website_host", "product_url", "source_categories", "launch_count", "latest_post_id",
    "top_trusted_label", "top_trusted_label_score", "entity_count",
)
DETAIL_COLUMNS = (
    "slug", "name", "tagline", "description", "website_url", "website_host", "product_url", "source_categories", "source_category_count",
    "first_product_id", "latest_product_id", "product_id_count", "launch_count", "first_post_id", "latest_post_id", "trusted_label_count",
    "top_trusted_label", "top_trusted_label_score", "entity_count", "tagline_source", "description_source", "has_external_website", "has_launch_mapping",
)


def clamp(value: int, low: int, high: int) -> int:
    return max(low, min(high, value))


def matching(mart: Mart, query: str = "", label: str = "", entity_type: str = "", entity: str = "") -> DataFrame:
    """Facts that hold the query in any of four columns, and every facet in rows of their own."""
    found = mart.product_facts
    if query := query.strip()[:120]:
        pattern = f"%{query}%"
        columns = ("name", "slug", "tagline", "website_host")
        hit = F.lit(False)
        for c in columns:
            hit = hit | F.coalesce(F.ilike(F.col(c), F.lit(pattern)), F.lit(False))
        found = found.where(hit)
    if label := label.strip()[:80]:
        found = found.join(mart.product_labels.where(F.col("label") == label).select("slug"), "slug", "left_semi")
    if entity_type := entity_type.strip()[:80]:
        found = found.join(mart.product_entities.where(F.col("entity_type") == entity_type).select("slug"), "slug", "left_semi")
    if entity := entity.strip()[:120]:
        found = found.join(mart.product_entities.where(F.col("canonical_value") == entity).select("slug"), "slug", "left_semi")
    return found


def search(mart: Mart, sort: str = "recent", limit: int = 24, offset: int = 0, **filters: str) -> DataFrame:
    """One page of matching products, each with the number of all that match."""
    order = _sorts().get(sort, _sorts()["recent"])
    found = matching(mart, **filters)
    page = found.select(*SEARCH_COLUMNS).orderBy(*order).offset(clamp(offset, 0, 1_000_000)).limit(clamp(limit, 1, 48))
    return page.crossJoin(F.broadcast(found.agg(F.count(F.lit(1)).alias("total_matches"))))  # one row


def detail(mart: Mart, slug: str) -> DataFrame:
    """A product's fact row with its labels by score and its entities by type and value, as arrays of structs; no row for an unknown slug."""
    label = F.struct((-F.col("score")).alias("s"), "label", "score", "method")
    labels = mart.product_labels.where(F.col("slug") == slug).groupBy("slug").agg(
        F.transform(F.array_sort(F.collect_list(label)), lambda x: F.struct(x["label"].alias("label"), x["score"].alias("score"), x["method"].alias("method"))).alias("labels")
    )
    entity = F.struct("entity_type", "canonical_value", "source_span", "score", "support_products", "method")
    entities = mart.product_entities.where(F.col("slug") == slug).groupBy("slug").agg(F.array_sort(F.collect_list(entity)).alias("entities"))
    fact = mart.product_facts.where(F.col("slug") == slug).select(*DETAIL_COLUMNS)
    return fact.join(labels, "slug", "left").join(entities, "slug", "left")


def health(mart: Mart) -> DataFrame:
    """How many products the mart serves."""
    return mart.product_facts.agg(F.count(F.lit(1)).alias("products"))


#: What each list of the dashboard shows.
PANELS = {
    "labels": ("label", "products", "catalogue_share", "average_score", "average_launches", "relaunch_rate"),
    "categories": ("category", "products", "catalogue_share", "average_launches", "relaunch_rate"),
    "entity_types": ("entity_type", "assignments", "products", "distinct_values", "average_score"),
    "entities": ("entity_type", "canonical_value", "products", "average_score"),
    "domains": ("website_host", "products", "catalogue_share", "mapped_launches"),
    "cohorts": ("relative_cohort", "products", "labeled_products", "entity_products", "average_launches", "relaunch_rate", "category_coverage", "trusted_label_coverage"),
    "label_trends": ("label", "early_products", "recent_products", "early_labeled_share", "recent_labeled_share", "labeled_share_change", "coverage_normalized_growth_index"),
    "entity_risers": ("entity_type", "canonical_value", "all_products", "early_entity_product_share", "recent_entity_product_share", "share_change", "coverage_normalized_growth_index"),
    "entity_fallers": ("entity_type", "canonical_value", "all_products", "early_entity_product_share", "recent_entity_product_share", "share_change", "coverage_normalized_growth_index"),
    "label_pairs": ("label_a", "label_b", "products"),
}


def metrics(mart: Mart) -> DataFrame:
    """The dashboard's twelve numbers, in one row."""
    f = mart.product_facts
    counts = f.agg(
        F.count(F.lit(1)).alias("products"), F.count_if("has_external_website").alias("external_websites"), F.count_if("has_source_categories").alias("categorized_products"),
        F.sum("source_category_count").alias("category_assignments"), F.count_if("has_trusted_label").alias("labeled_products"), F.sum("trusted_label_count").alias("label_assignments"),
        F.count_if("has_entity").alias("entity_products"), F.sum("entity_count").alias("entity_assignments"), F.count_if("has_launch_mapping").alias("launched_products"),
        F.sum("launch_count").alias("launch_relationships"), F.count_if(F.col("launch_count") > 1).alias("relaunched_products"),
    )
    return counts.crossJoin(F.broadcast(mart.domain_stats.agg(F.count(F.lit(1)).alias("distinct_domains"))))  # one row each


def panel(mart: Mart, name: str) -> DataFrame:
    """One list of the dashboard with the columns that it shows, in its order."""
    return ordered_list(mart, f"dashboard_{name}").select(*PANELS[name])


def composed(mart: Mart) -> DataFrame:
    """The whole dashboard as rows (section, place, item): the metrics and every list's rows as JSON, in order."""
    mart = mart.with_shared()
    parts = [metrics(mart).select(F.lit("metrics").alias("section"), F.lit(1).alias("place"), F.to_json(F.struct("*")).alias("item"))]
    for name in (x for x in LISTS if x.startswith("dashboard_")):
        rows = ordered_list(mart, name)
        order = LISTS[name][1].split(", ")
        place = F.row_number().over(Window.orderBy(*(F.expr(o[:-5]).desc() if o.endswith(" DESC") else F.expr(o).asc() for o in order)))  # a list is short
        parts.append(rows.select(F.lit(name[10:]).alias("section"), place.alias("place"), F.to_json(F.struct(*PANELS[name[10:]])).alias("item")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def valid_slug(slug: str) -> bool:
    return bool(slug) and "/" not in slug and len(slug) <= 240


def table_rows(mart: Mart) -> DataFrame:
    """Rows of every table of the mart."""
    mart, out = mart.with_shared(), None
    for name in TABLES:
        row = getattr(mart, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.col("n").alias("rows"))
        out = row if out is None else out.unionByName(row)
    return out


#: Ordered lists: name -> (table, order, limit, condition); orders end in the table's key, so that cuts have no ties.
LISTS = {
    "report_top_labels": ("label_stats", "products DESC, label", 20, ""),
    "report_top_categories": ("category_stats", "products DESC, category", 25, ""),
    "report_top_domains": ("domain_stats", "products DESC, website_host", 25, ""),
    "report_label_trends": ("label_relative_trends", "labeled_share_change DESC, label", 0, ""),
    "report_entity_trends": ("entity_relative_trends", "share_change DESC, entity_type, canonical_value", 50, ""),
    "dashboard_labels": ("label_stats", "products DESC, label", 0, ""),
    "dashboard_categories": ("category_stats", "products DESC, category", 20, ""),
    "dashboard_entity_types": ("entity_type_stats", "products DESC, entity_type", 0, ""),
    "dashboard_entities": ("entity_stats", "products DESC, entity_type, canonical_value", 30, ""),
    "dashboard_domains": ("domain_stats", "products DESC, website_host", 15, ""),
    "dashboard_cohorts": ("relative_launch_cohort_stats", "relative_cohort", 0, ""),
    "dashboard_label_trends": ("label_relative_trends", "labeled_share_change DESC, label", 0, ""),
    "dashboard_entity_risers": ("entity_relative_trends", "share_change DESC, entity_type, canonical_value", 18, "all_products >= 100"),
    "dashboard_entity_fallers": ("entity_relative_trends", "share_change, entity_type, canonical_value", 18, "all_products >= 100"),
    "dashboard_label_pairs": ("label_cooccurrence", "products DESC, label_a, label_b", 15, ""),
    "adhoc_top_categories": ("category_stats", "products DESC, category", 50, ""),
    "adhoc_entity_pairs": ("entity_cooccurrence", "products DESC, entity_type_a, canonical_value_a, entity_type_b, canonical_value_b", 50, "entity_type_a <> entity_type_b"),
    "adhoc_entity_movement": ("entity_relative_trends", "coverage_normalized_growth_index DESC, entity_type, canonical_value", 50, "coverage_normalized_growth_index IS NOT NULL"),
    "adhoc_relaunching_categories": ("category_stats", "relaunch_rate DESC, category", 50, "products >= 500"),
    "adhoc_products_per_host": ("domain_stats", "products DESC, website_host", 100, "products > 1"),
}


def ordered_list(mart: Mart, name: str) -> DataFrame:
    table, order, limit, condition = LISTS[name]
    rows = getattr(mart, table)
    rows = (rows.where(condition) if condition else rows).orderBy(*(F.expr(o[:-5]).desc() if o.endswith(" DESC") else F.expr(o).asc() for o in order.split(", ")))
    return rows.limit(limit) if limit else rows


def list_sql(name: str) -> str:
    table, order, limit, condition = LISTS[name]
    return f"SELECT * FROM {table}" + f" WHERE {condition}" * bool(condition) + f" ORDER BY {order}" + f" LIMIT {limit}" * bool(limit)
