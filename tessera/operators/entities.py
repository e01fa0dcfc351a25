"""Entity evidence: exact support, precision rules, per-product dedup, audit samples and their rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import vocabulary as V
from tessera.functions.text import clean_entity, compact_name, is_self_name


def _mapped(value: Column, table: dict[str, str]) -> Column:
    """The value's entry in a small table, or itself."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def classify(label: Column, text: Column, support: Column, score: Column) -> Column:
    """struct(entity_type, canonical_value) where the rules accept a mention, else null."""
    value = clean_entity(text)
    words = F.split(value, " ")

    def result(kind: str, canonical: Column) -> Column:
        return F.struct(F.lit(kind).alias("entity_type"), canonical.alias("canonical_value"))

    system = F.lit(None).cast("string")
    for alias, name in reversed(V.OPERATING_SYSTEMS.items()):
        system = F.when((value == alias) | F.startswith(value, F.lit(f"{alias} ")), name).otherwise(system)
    tokens = F.transform(F.regexp_extract_all(value, F.lit("[a-z0-9]+"), F.lit(0)), lambda t: _mapped(t, V.FILE_PLURALS))
    format_ = F.get(F.filter(tokens, lambda t: t.isin(*V.FILE_FORMATS)), F.lit(0))
    tech = _mapped(value, V.TECHNOLOGY_ALIASES)
    least = F.lit(V.TECHNOLOGY_SCORE)
    for name, bound in V.TECHNOLOGY_SCORES.items():
        least = F.when(tech == name, F.lit(bound)).otherwise(least)
    known = lambda some: F.arrays_overlap(words, F.array(*(F.lit(x) for x in some)))
    role = known(V.ROLE_NOUNS) | value.isin(*V.ROLE_ABBREVIATIONS) | (known(V.ROLE_QUALIFIERS) & known(("professional", "professionals")))
    role = role & ~value.isin(*V.GENERIC_ROLES) & ~F.startswith(value, F.lit("ai ")) & ~F.contains(value, F.lit(" and "))
    singular = F.array_join(F.concat(F.slice(words, 1, F.size(words) - 1), F.array(_mapped(F.element_at(words, -1), V.ROLE_SINGULARS))), " ")
    industry = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for p in V.INDUSTRY_CANONICAL.items() for x in p)), value), F.regexp_replace(value, "s$", ""))
    return (
        F.when((label == "operating system") & system.isNotNull(), result("operating_system", system))
        .when((label == "file format") & format_.isNotNull(), result("file_format", _mapped(format_, V.FILE_CANONICAL)))
        .when(label.isin("programming language or framework", "technical method or standard") & tech.isin(*V.TECHNOLOGIES) & (score >= least), result("technology_or_tool", tech))
        .when((label == "external software service") & (support >= 3) & (score >= 0.70) & ~value.isin(*V.GENERIC_SERVICES) & value.isin(*V.PLATFORMS), result("external_platform_mentioned", value))
        .when((label == "professional role") & (support >= 2) & (score >= 0.72) & role, result("audience_role", singular))
        .when((label == "industry sector") & (value.isin(*V.INDUSTRIES) | industry.isin(*V.INDUSTRIES) | (value == "e commerce")), result("industry", industry))
        .when((label == "hardware device") & (support >= 2) & (score >= 0.75) & ~value.isin(*V.GENERIC_HARDWARE), result("hardware", _mapped(value, V.HARDWARE_ALIASES)))
    )


def with_support(mentions: DataFrame) -> DataFrame:
    """Attach in how many products a (label, lower-case text) is mentioned, counted exactly."""
    counts = mentions.groupBy("label", F.lower("entity_text").alias("_text")).agg(F.count_distinct("slug").alias("support_products"))
    return mentions.withColumn("_text", F.lower("entity_text")).join(counts, ["label", "_text"]).drop("_text")


def filtered(mentions: DataFrame) -> DataFrame:
    """Accepted entities: one row per product, type and value, the best-scored mention."""
    hit = with_support(mentions).withColumn("hit", classify(F.col("label"), F.col("entity_text"), F.col("support_products"), F.col("score"))).where("hit is not null")
    rows = hit.select("slug", "hit.*", F.col("entity_text").alias("source_span"), "score", "support_products", "label")
    order = F.struct((-F.col("score")).alias("s"), "source_span", (-F.col("support_products")).alias("n"), "label")
    best = rows.groupBy("slug", "entity_type", "canonical_value").agg(F.min_by(F.struct("source_span", "score", "support_products"), order).alias("r"))
    return best.select("slug", "entity_type", "canonical_value", "r.*")


def per_product(mentions: DataFrame, names: DataFrame) -> DataFrame:
    """Mentions once per compact text and label of a product; those that only name the product go."""
    rows = mentions.join(names, "slug").where(~F.coalesce(is_self_name(F.col("entity_text"), F.col("name")), F.lit(False)))
    best = Window.partitionBy("slug", "compact", "label").orderBy(F.desc("score"), "entity_text")
    return rows.withColumn("compact", compact_name(F.col("entity_text"))).withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n", "name")


def hash_order(seed: str, *columns: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(seed), *columns), 256)


def audit_sample(entities: DataFrame, seed: str, random: int, rare: int, rare_support: int = 5) -> DataFrame:
    """Per type: `random` rows in hash order, then `rare` others with little support in another hash order."""
    key = ("slug", "entity_type", "canonical_value")
    order = Window.partitionBy("entity_type").orderBy(hash_order(seed, *key), *key)
    placed = entities.withColumn("_n", F.row_number().over(order))
    first = placed.where(F.col("_n") <= random).withColumn("audit_stratum", F.lit("random"))
    tail = Window.partitionBy("entity_type").orderBy(hash_order(f"{seed}|rare", *key), *key)
    others = placed.where((F.col("_n") > random) & (F.col("support_products") <= rare_support)).withColumn("_n", F.row_number().over(tail))
    return first.unionByName(others.where(F.col("_n") <= rare).withColumn("audit_stratum", F.lit("rare"))).drop("_n")


def audit_rates(reviewed: DataFrame, group: str) -> DataFrame:
    """Items, and the shares with the right type and of relevance, by a grouping; null where nothing was reviewed."""
    n = F.count(F.lit(1))
    share = lambda c: F.round(F.try_divide(F.count_if(F.col(c)), n), 9)
    return reviewed.groupBy(F.col(group).alias("value")).agg(n.alias("items"), share("type_correct").alias("precision"), share("relevant").alias("relevance")).select(F.lit(group).alias("grouping"), "*")


def prompt_text(tagline: Column, description: Column) -> Column:
    """The copy of a product as lines with their names; empty parts are left out."""
    line = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}: "), c))
    return F.concat_ws("\n", line("Tagline", tagline), line("Description", description))


def audit_context(entities: DataFrame, products: DataFrame) -> DataFrame:
    """Entities beside the name and copy of their products; those of unknown products go."""
    return entities.join(products.select("slug", "name", "tagline", "description"), "slug")


def filter_report(mentions: DataFrame, entities: DataFrame, version: str) -> DataFrame:
    """One row: mentions before the rules, assignments and products after them."""
    before = mentions.agg(F.count(F.lit(1)).alias("raw_candidates"), F.lit(0).cast("long").alias("retained_assignments"), F.lit(0).cast("long").alias("retained_products"))
    after = entities.agg(F.lit(0).cast("long").alias("raw_candidates"), F.count(F.lit(1)).alias("retained_assignments"), F.count_distinct("slug").alias("retained_products"))
    both = before.unionByName(after)
    return both.agg(*(F.sum(c).alias(c) for c in both.columns)).withColumn("precision_filter_version", F.lit(version))
