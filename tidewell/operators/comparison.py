"""Comparison of brands: feature matrix, timeline, side by side, and coverage by price tier."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.prices import TIERS, price_tier
from ..functions.text import non_blank


def category_or_default(category: Column) -> Column:
    return F.coalesce(non_blank(category), F.lit("uncategorized"))


def feature_summary(*more: str) -> Column:
    """The fields that readers get, blank for a missing text."""
    return F.struct("id", F.coalesce("feature_name_en", F.lit("")).alias("feature_name_en"), F.coalesce("supplier", F.lit("")).alias("supplier"), F.col("first_seen_date"), *more)


def feature_matrix(features: DataFrame) -> DataFrame:
    """For each brand and category the number of features and their summaries by id; features without a brand are left out."""
    named = features.where(non_blank(F.col("brand_name_en")).isNotNull())
    groups = named.groupBy("brand_name_en", category_or_default(F.col("category")).alias("category"))
    return groups.agg(F.count("*").alias("n_features"), F.array_sort(F.collect_list(feature_summary())).alias("features"))


def feature_matrix_wide(features: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row for each brand and one count for each category named."""
    named = features.where(non_blank(F.col("brand_name_en")).isNotNull()).withColumn("category", category_or_default(F.col("category")))
    return named.groupBy("brand_name_en").pivot("category", list(categories)).agg(F.count("*")).na.fill(0)


def feature_matrix_totals(features: DataFrame) -> DataFrame:
    """Counts of each brand and category, of each brand, and of all; nulls stand for all."""
    named = features.where(non_blank(F.col("brand_name_en")).isNotNull())
    return named.withColumn("category", category_or_default(F.col("category"))).rollup("brand_name_en", "category").agg(F.count("*").alias("n_features"))


def matrix_axes(features: DataFrame) -> DataFrame:
    """One row: all brands and all categories in order, and the number of features."""
    named = features.where(non_blank(F.col("brand_name_en")).isNotNull())
    return named.agg(F.array_sort(F.collect_set("brand_name_en")).alias("brands"), F.array_sort(F.collect_set(category_or_default(F.col("category")))).alias("categories"), F.count("*").alias("total_features"))


def feature_timeline(features: DataFrame, category: str | None = None, brand: str | None = None) -> DataFrame:
    """Features by the day they were first seen, undated ones last, ties by ``ord``; ``position`` from 1 in each category."""
    chosen = features
    if category is not None:
        chosen = chosen.where(F.col("category") == category)
    if brand is not None:
        chosen = chosen.where(F.col("brand_name_en") == brand)
    day, group = [F.col("first_seen_date").asc_nulls_last(), F.col("ord").asc()], F.coalesce("category", F.lit(""))
    undated = F.concat(F.lit("x"), F.lpad(F.floor(F.col("ord") / F.lit(100_000)).cast("string"), 15, "0"))
    dealt = chosen.withColumns({"__group": group, "__day": F.coalesce(F.date_format("first_seen_date", "yyyyMMdd"), undated)})
    # Days are ranked in their category by counts, and features in their day: no task holds a whole category.
    days = dealt.groupBy("__group", "__day").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.partitionBy("__group").orderBy("__day").rowsBetween(W.unboundedPreceding, -1))
    starts = days.select("__group", "__day", F.coalesce(before, F.lit(0)).alias("__before"))
    placed = dealt.withColumn("__at", F.row_number().over(W.partitionBy("__group", "__day").orderBy(*day))).join(starts, ["__group", "__day"])
    return placed.withColumn("position", (F.col("__before") + F.col("__at")).cast("int")).drop("__group", "__day", "__before", "__at")


def first_movers(features: DataFrame) -> DataFrame:
    """The brand that was first in each category."""
    key = F.struct(F.col("first_seen_date").isNull(), "first_seen_date", "ord")
    return features.groupBy("category").agg(F.min_by("brand_name_en", key).alias("brand_name_en"), F.min_by("id", key).alias("id"), F.min("first_seen_date").alias("first_seen_date"))


def brand_entries(requested: DataFrame, brands: DataFrame, features: DataFrame, vehicles: DataFrame) -> DataFrame:
    """For each requested brand that is known: its group, and the numbers of its features, categories and vehicles."""
    known = brands.join(requested.select(F.col("brand").alias("name_en")).distinct(), "name_en", "left_semi")
    f = features.groupBy(F.col("brand_name_en").alias("name_en")).agg(F.count("*").alias("n_features"), F.countDistinct(category_or_default(F.col("category"))).alias("n_categories"))
    v = vehicles.groupBy(F.col("brand_name_en").alias("name_en")).agg(F.count("*").alias("n_vehicles"))
    return known.join(f, "name_en", "left").join(v, "name_en", "left").na.fill(0, ["n_features", "n_categories", "n_vehicles"])


def brands_not_found(requested: DataFrame, brands: DataFrame) -> DataFrame:
    """Requested names without a brand, as often as they are requested."""
    return requested.join(brands.select(F.col("name_en").alias("brand")), "brand", "left_anti")


def category_comparison(requested: DataFrame, brands: DataFrame, features: DataFrame) -> DataFrame:
    """A count for every found brand and every category that any of them has, zeros included."""
    found = brands.join(requested.select(F.col("brand").alias("name_en")).distinct(), "name_en", "left_semi").select("name_en")
    counts = features.select(F.col("brand_name_en").alias("name_en"), category_or_default(F.col("category")).alias("category")).join(found, "name_en", "left_semi").groupBy("name_en", "category").agg(F.count("*").alias("n"))
    all_categories = F.broadcast(counts.agg(F.collect_set("category").alias("all")))  # one row of category names
    grid = found.join(all_categories).select("name_en", F.explode("all").alias("category"))
    return grid.join(counts, ["name_en", "category"], "left").select("category", "name_en", F.coalesce("n", F.lit(0)).alias("n_features"))


def tier_table(vehicles: DataFrame) -> DataFrame:
    return vehicles.sparkSession.createDataFrame([(i, t) for i, t in enumerate(TIERS)], "tier_rank int, tier string")


def price_tier_stats(vehicles: DataFrame, features: DataFrame) -> DataFrame:
    """For each of the five tiers: vehicles, features of their brands counted once for each vehicle, and the average.

    Features are counted by brand before the join, so that each vehicle meets one row, not every feature.
    """
    per_brand = features.groupBy("brand_name_en").agg(F.count("*").alias("n"))
    tiered = vehicles.withColumn("tier", price_tier(F.col("price_range_cny"))).join(per_brand, "brand_name_en", "left")
    stats = tiered.groupBy("tier").agg(F.count("*").alias("vehicle_count"), F.sum(F.coalesce("n", F.lit(0))).alias("features"))
    return tier_table(vehicles).join(stats, "tier", "left").select(
        "tier", F.coalesce("vehicle_count", F.lit(0)).alias("vehicle_count"), F.coalesce("features", F.lit(0)).alias("feature_total"),
        F.coalesce(F.try_divide(F.col("features").cast("double"), F.col("vehicle_count").cast("double")), F.lit(0.0)).alias("avg_features"),
    )


def price_tier_categories(vehicles: DataFrame, features: DataFrame) -> DataFrame:
    """Average number of features of each category for the vehicles of a tier."""
    per_brand = features.groupBy("brand_name_en", category_or_default(F.col("category")).alias("category")).agg(F.count("*").alias("n"))
    tiered = vehicles.select("brand_name_en", price_tier(F.col("price_range_cny")).alias("tier"))
    of_brand = tiered.groupBy("tier", "brand_name_en").agg(F.count("*").alias("vehicles"))
    totals = tiered.groupBy("tier").agg(F.count("*").alias("vehicle_count"))
    summed = of_brand.join(per_brand, "brand_name_en").groupBy("tier", "category").agg(F.sum(F.col("vehicles") * F.col("n")).alias("total"))
    return summed.join(totals, "tier").select("tier", "category", F.try_divide(F.col("total").cast("double"), F.col("vehicle_count").cast("double")).alias("avg_features"))
