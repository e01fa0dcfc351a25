"""The analytics mart: pure functions from the catalogue's relations to the mart's tables."""

from __future__ import annotations

import copy
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators.relational import best_per_key, ieee_div, ntile, pair_counts, with_total
from tessera.sources.binding import OWN_HOST
from tessera.sources.scratch import written

#: Tables that several others are made of, in the order of building.
_SHARED = ("product_labels", "product_entities", "product_categories", "_spine", "product_relative_launch_cohorts", "relative_launch_cohort_stats")


def _one():
    return F.count(F.lit(1))


def _r(c, digits: int = 9):
    """Averages and shares do not depend on the order of addition once rounded."""
    return F.round(c, digits)


class Mart:
    """Tables of the mart over relations products, ids, launches, labels and entities; each is lazy."""

    def __init__(self, relations: dict[str, DataFrame], own_host: str = OWN_HOST, tiles: int = 20, support: int = 25):
        self.source, self.own_host, self.tiles, self.support = relations, own_host, tiles, support

    def with_shared(self) -> Mart:
        """The same mart for queries of many tables: those that others are made of are written once, and the others read them."""
        mart = copy.copy(self)
        for name in _SHARED:
            vars(mart)[name] = written(getattr(mart, name), name.strip("_"))
        return mart

    @cached_property
    def fetched(self) -> DataFrame:
        return self.source["products"].where("status = 'fetched'")

    @cached_property
    def product_labels(self) -> DataFrame:
        rows = self.source["labels"].withColumnRenamed("tag", "label")
        return best_per_key(rows, ["slug", "label"], [F.desc("score"), F.col("rank"), F.col("method")])

    @cached_property
    def product_entities(self) -> DataFrame:
        order = [F.desc("score"), F.col("source_span"), F.col("method"), F.col("support_products")]
        return best_per_key(self.source["entities"], ["slug", "entity_type", "canonical_value"], order)

    @cached_property
    def product_categories(self) -> DataFrame:
        each = self.fetched.select("slug", F.explode(F.coalesce("categories", F.array().cast("array<string>"))).alias("category"))
        return each.select("slug", F.trim("category").alias("category")).where("category <> ''").distinct()

    @cached_property
    def product_launches(self) -> DataFrame:
        return self.source["launches"].join(self.fetched.select("slug"), "slug")

    @cached_property
    def product_ids(self) -> DataFrame:
        return self.source["ids"].join(self.fetched.select("slug"), "slug")

    @cached_property
    def product_facts(self) -> DataFrame:
        ids = self.product_ids.groupBy("slug").agg(
            F.min("product_id").alias("first_product_id"), F.max("product_id").alias("latest_product_id"), F.countDistinct("product_id").alias("ids")
        )
        launches = self.product_launches.groupBy("slug").agg(_one().alias("launches"), F.min("post_id").alias("first_post_id"), F.max("post_id").alias("latest_post_id"))
        place = F.struct(F.col("rank"), (-F.col("score")).alias("s"), F.col("label"))
        labels = self.product_labels.groupBy("slug").agg(
            _one().alias("labels"), F.min_by("label", place).alias("top_trusted_label"), F.min_by("score", place).alias("top_trusted_label_score")
        )
        entities = self.product_entities.groupBy("slug").agg(_one().alias("entities"))
        base = self.fetched.withColumn("website_host", T.website_host(F.col("website_url")))
        for stats in (ids, launches, labels, entities):
            base = base.join(stats, "slug", "left")
        categories = F.coalesce("categories", F.array().cast("array<string>"))
        count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
        return base.select(
            "slug", "name", "tagline", "description", "website_url", "website_host", "product_url",
            categories.alias("source_categories"),
            F.size(categories).cast("long").alias("source_category_count"),
            "first_product_id", "latest_product_id",
            count("ids").alias("product_id_count"),
            count("launches").alias("launch_count"),
            "first_post_id", "latest_post_id",
            count("labels").alias("trusted_label_count"),
            "top_trusted_label", "top_trusted_label_score",
            count("entities").alias("entity_count"),
            *(T.trimmed_length(F.col(c)).cast("long").alias(f"{c}_characters") for c in ("name", "tagline", "description")),
            "tagline_source", "description_source",
            (F.col("website_host").isNotNull() & ~F.endswith(F.col("website_host"), F.lit(self.own_host))).alias("has_external_website"),
            *(T.present(F.col(c)).alias(f"has_{c}") for c in ("name", "tagline", "description")),
            (F.size(categories) > 0).alias("has_source_categories"),
            F.col("launches").isNotNull().alias("has_launch_mapping"),
            F.col("labels").isNotNull().alias("has_trusted_label"),
            F.col("entities").isNotNull().alias("has_entity"),
        )

    @cached_property
    def _spine(self) -> DataFrame:
        """The launch columns of product_facts, for what needs no texts."""
        launches = self.product_launches.groupBy("slug").agg(_one().alias("launch_count"), F.min("post_id").alias("first_post_id"))
        rows = self.fetched.select("slug").join(launches, "slug", "left")
        return rows.select("slug", "first_post_id", F.coalesce("launch_count", F.lit(0)).cast("long").alias("launch_count"))

    @cached_property
    def product_relative_launch_cohorts(self) -> DataFrame:
        rows = self._spine.where("first_post_id is not null").select("slug", "first_post_id")
        return ntile(rows, self.tiles, "first_post_id", "slug", "relative_cohort")

    def _share(self, c: str = "products"):
        return _r(F.col(c) / F.col("_all").cast("double"))

    @cached_property
    def category_stats(self) -> DataFrame:
        rows = self.product_categories.join(self._spine, "slug").groupBy("category").agg(
            _one().alias("products"), _r(F.avg("launch_count")).alias("average_launches"), _r(F.count_if(F.col("launch_count") > 1) / _one()).alias("relaunch_rate")
        )
        return with_total(rows, self._spine).select("category", "products", self._share().alias("catalogue_share"), "average_launches", "relaunch_rate")

    @cached_property
    def label_stats(self) -> DataFrame:
        rows = self.product_labels.join(self._spine, "slug").groupBy("label").agg(
            _one().alias("products"), _r(F.avg("score"), 4).alias("average_score"), _r(F.avg("launch_count")).alias("average_launches"),
            _r(F.count_if(F.col("launch_count") > 1) / _one()).alias("relaunch_rate"),
        )
        return with_total(rows, self._spine).select("label", "products", self._share().alias("catalogue_share"), "average_score", "average_launches", "relaunch_rate")

    @cached_property
    def entity_stats(self) -> DataFrame:
        return self.product_entities.groupBy("entity_type", "canonical_value").agg(_one().alias("products"), _r(F.avg("score"), 4).alias("average_score"))

    @cached_property
    def entity_type_stats(self) -> DataFrame:
        return self.product_entities.groupBy("entity_type").agg(
            _one().alias("assignments"), F.countDistinct("slug").alias("products"), F.countDistinct("canonical_value").alias("distinct_values"), _r(F.avg("score"), 4).alias("average_score")
        )

    @cached_property
    def _hosts(self) -> DataFrame:
        rows = self.fetched.select("slug", T.website_host(F.col("website_url")).alias("website_host"))
        return rows.where(F.col("website_host").isNotNull() & ~F.endswith(F.col("website_host"), F.lit(self.own_host)))

    @cached_property
    def domain_stats(self) -> DataFrame:
        rows = self._hosts.join(self._spine, "slug").groupBy("website_host").agg(_one().alias("products"), F.sum("launch_count").alias("mapped_launches"))
        return with_total(rows, self._spine).select("website_host", "products", self._share().alias("catalogue_share"), "mapped_launches")

    @cached_property
    def launch_multiplicity_stats(self) -> DataFrame:
        rows = self._spine.groupBy("launch_count").agg(_one().alias("products"))
        return with_total(rows, self._spine).select("launch_count", "products", self._share().alias("catalogue_share"))

    @cached_property
    def provenance_stats(self) -> DataFrame:
        rows = self.fetched.groupBy("tagline_source", "description_source").agg(_one().alias("products"))
        return with_total(rows, self._spine).select("tagline_source", "description_source", "products", self._share().alias("catalogue_share"))

    @cached_property
    def relative_launch_cohort_stats(self) -> DataFrame:
        flags = self.fetched.select("slug", (F.size(F.coalesce("categories", F.array().cast("array<string>"))) > 0).alias("cat"))
        rows = self.product_relative_launch_cohorts.join(self._spine.select("slug", "launch_count"), "slug").join(flags, "slug")
        rows = rows.join(self.product_labels.select("slug").distinct().withColumn("lab", F.lit(True)), "slug", "left")
        rows = rows.join(self.product_entities.select("slug").distinct().withColumn("ent", F.lit(True)), "slug", "left")
        return rows.groupBy("relative_cohort").agg(
            _one().alias("products"),
            F.count_if("lab").alias("labeled_products"),
            F.count_if("ent").alias("entity_products"),
            F.min("first_post_id").alias("minimum_first_post_id"),
            F.max("first_post_id").alias("maximum_first_post_id"),
            _r(F.avg("launch_count")).alias("average_launches"),
            _r(F.count_if(F.col("launch_count") > 1) / _one()).alias("relaunch_rate"),
            _r(F.count_if("cat") / _one()).alias("category_coverage"),
            _r(F.count_if("lab") / _one()).alias("trusted_label_coverage"),
        )

    def _cohort_shares(self, rows: DataFrame, keys: list[str], part: str, name: str) -> DataFrame:
        sizes = self.relative_launch_cohort_stats.select("relative_cohort", F.col("products").alias("_all"), F.col(part).alias("_part"))  # one row per tile
        counts = self.product_relative_launch_cohorts.join(rows, "slug").groupBy("relative_cohort", *keys).agg(_one().alias("products"))
        joined = counts.join(F.broadcast(sizes), "relative_cohort")
        return joined.select("relative_cohort", *keys, "products", self._share().alias("catalogue_share"), _r(ieee_div(F.col("products"), F.col("_part"))).alias(name))

    @cached_property
    def relative_launch_cohort_entities(self) -> DataFrame:
        return self._cohort_shares(self.product_entities, ["entity_type", "canonical_value"], "entity_products", "share_among_entity_products")

    @cached_property
    def relative_launch_cohort_labels(self) -> DataFrame:
        return self._cohort_shares(self.product_labels, ["label"], "labeled_products", "share_among_labeled")

    def _trend(self, rows: DataFrame, keys: list[str], part: str) -> DataFrame:
        quarter = self.tiles // 4
        early, recent = F.col("relative_cohort") <= quarter, F.col("relative_cohort") > self.tiles - quarter
        stats = self.relative_launch_cohort_stats
        sizes = stats.agg(*(F.sum(F.when(when, F.col(c))).alias(f"{when_name}_{c}") for when_name, when in (("early", early), ("recent", recent)) for c in ("products", part)))
        counts = rows.join(self.product_relative_launch_cohorts, "slug").groupBy(*keys).agg(
            F.count_if(early).alias("n_early"), F.count_if(recent).alias("n_recent"), _one().alias("all_products")
        )
        return counts.crossJoin(F.broadcast(sizes))

    @staticmethod
    def _growth(early: str, recent: str):
        return _r(F.when(F.col(early) != 0, F.col(recent) / F.when(F.col(early) != 0, F.col(early))))

    @cached_property
    def entity_relative_trends(self) -> DataFrame:
        t = self._trend(self.product_entities, ["entity_type", "canonical_value"], "entity_products").where(F.col("all_products") >= self.support)
        t = t.withColumn("e", ieee_div(F.col("n_early"), F.col("early_entity_products"))).withColumn("r", ieee_div(F.col("n_recent"), F.col("recent_entity_products")))
        return t.select(
            "entity_type", "canonical_value", "all_products", _r(F.col("e")).alias("early_entity_product_share"), _r(F.col("r")).alias("recent_entity_product_share"),
            _r(F.col("r") - F.col("e")).alias("share_change"), self._growth("e", "r").alias("coverage_normalized_growth_index"),
        )

    @cached_property
    def label_relative_trends(self) -> DataFrame:
        t = self._trend(self.product_labels, ["label"], "labeled_products")
        for name, n, d in (("ec", "n_early", "early_products"), ("rc", "n_recent", "recent_products"), ("el", "n_early", "early_labeled_products"), ("rl", "n_recent", "recent_labeled_products")):
            t = t.withColumn(name, ieee_div(F.col(n), F.col(d)))
        return t.select(
            "label", F.col("n_early").alias("early_products"), F.col("n_recent").alias("recent_products"),
            _r(F.col("ec")).alias("early_catalogue_share"), _r(F.col("rc")).alias("recent_catalogue_share"), _r(F.col("rc") - F.col("ec")).alias("catalogue_share_change"),
            _r(F.col("el")).alias("early_labeled_share"), _r(F.col("rl")).alias("recent_labeled_share"), _r(F.col("rl") - F.col("el")).alias("labeled_share_change"),
            self._growth("el", "rl").alias("coverage_normalized_growth_index"),
        )

    @cached_property
    def label_cooccurrence(self) -> DataFrame:
        return pair_counts(self.product_labels, "slug", ["label"])

    @cached_property
    def category_cooccurrence(self) -> DataFrame:
        return pair_counts(self.product_categories, "slug", ["category"])

    @cached_property
    def entity_cooccurrence(self) -> DataFrame:
        return pair_counts(self.product_entities, "slug", ["entity_type", "canonical_value"])

    @cached_property
    def core_metrics(self) -> DataFrame:
        """One row of counts over the facts."""
        f = self.product_facts
        return f.agg(
            _one().alias("products"),
            F.count_if("has_external_website").alias("external_websites"),
            F.count_distinct(F.when(F.col("has_external_website"), F.col("website_host"))).alias("distinct_domains"),
            *(F.count_if(f"has_{c}").alias(f"with_{c}") for c in ("name", "tagline", "description", "source_categories", "launch_mapping", "trusted_label", "entity")),
            F.sum("launch_count").alias("launches"),
            F.count_if(F.col("launch_count") > 1).alias("relaunched"),
            F.sum("source_category_count").alias("category_assignments"),
            F.sum("trusted_label_count").alias("label_assignments"),
            F.sum("entity_count").alias("entity_assignments"),
        )


#: The mart's tables, in the order of building.
TABLES = (
    "product_labels", "product_entities", "product_categories", "product_launches", "product_ids", "product_facts",
    "product_relative_launch_cohorts", "category_stats", "label_stats", "entity_stats", "entity_type_stats", "domain_stats",
    "launch_multiplicity_stats", "provenance_stats", "relative_launch_cohort_stats", "relative_launch_cohort_entities",
    "relative_launch_cohort_labels", "entity_relative_trends", "label_relative_trends", "label_cooccurrence",
    "category_cooccurrence", "entity_cooccurrence",
)
