"""Queries on brands, features and vehicles."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import comparison as C
from ..sources import queues, store
from .fixtures import brands, features, vehicles

FEATURES = """f AS (
  SELECT p_partkey::VARCHAR AS id, p_partkey AS ord, p_brand AS brand_name_en, split_part(p_name, ' ', 2) AS category, p_name AS feature_name_en,
    CASE WHEN p_partkey % 17 <> 0 THEN min(l_shipdate) END AS first_seen_date, min(l_suppkey)::VARCHAR AS supplier
  FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_brand, p_name)"""
VEHICLES = """v AS (
  SELECT p_partkey::VARCHAR AS id, p_brand AS brand_name_en, p_name AS model_name_en, p_type AS segment,
    CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN 'TBD' ELSE (p_size * 12)::VARCHAR || ',000-' || (p_size * 12 + 50)::VARCHAR || ',000' END AS price_range_cny FROM part),
t AS (SELECT *, try_cast(regexp_extract(replace(price_range_cny, ',', ''), '([0-9]+)', 1) AS BIGINT) AS low FROM v),
tiered AS (SELECT *, CASE WHEN low IS NULL THEN 'unknown' WHEN low < 150000 THEN 'budget' WHEN low < 300000 THEN 'mid' WHEN low <= 500000 THEN 'premium' ELSE 'luxury' END AS tier FROM t)"""
REQUESTED = ("Brand#11", "Brand#23", "Brand#45", "Brand#11", "Nobody", "Brand#99", "Nobody")


def requested(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(b,) for b in REQUESTED], "brand string")


REQUESTED_SQL = f"q AS (SELECT unnest({list(REQUESTED)}) AS brand)"
BRANDS_SQL = "b AS (SELECT DISTINCT p_brand AS name_en, 'group' || right(p_brand, 1) AS parent_group FROM part)"


def feature_matrix(spark, sf_dir):
    return C.feature_matrix(features(spark, sf_dir)).select("brand_name_en", "category", "n_features", F.transform("features", lambda f: f["id"]).alias("feature_ids"))




def feature_summaries(spark, sf_dir):
    """What readers get of each feature of a brand and category."""
    cells = C.feature_matrix(features(spark, sf_dir).withColumn("supplier", F.when(F.col("ord") % 4 > 0, F.col("supplier"))))
    return cells.select("brand_name_en", F.col("category").alias("in_category"), F.inline("features"))


def price_tier_stats(spark, sf_dir):
    return C.price_tier_stats(vehicles(spark, sf_dir), features(spark, sf_dir)).withColumn("avg_features", F.round("avg_features", 6))


def price_tier_category_avg(spark, sf_dir):
    return C.price_tier_categories(vehicles(spark, sf_dir), features(spark, sf_dir)).withColumn("avg_features", F.round("avg_features", 6))


def upsert_merge_first_seen(spark, sf_dir):
    """The dated features are stored; a later run brings all of them, with new suppliers (some missing) and later dates."""
    every = features(spark, sf_dir)
    new = every.withColumns({"supplier": F.when(F.col("ord") % 5 != 0, F.concat(F.lit("s"), "supplier")), "first_seen_date": F.col("first_seen_date") + F.expr("INTERVAL 9 DAYS")})
    key = ["brand_name_en", "feature_name_en", "category"]
    last = lambda df: df.groupBy(key).agg(F.max("supplier").alias("supplier"), F.min("first_seen_date").alias("first_seen_date"))
    return store.upsert(last(every.where("first_seen_date IS NOT NULL")), last(new), key, create_only=["first_seen_date"])


QUERIES = {
    "feature_summaries": feature_summaries,
    "scan_features_by_category": lambda s, d: queues.where_equal(features(s, d), category="gear").select("id", "brand_name_en", "feature_name_en"),
    "scan_features_by_brand": lambda s, d: queues.where_equal(features(s, d), brand_name_en="Brand#23").select("id", "category", "feature_name_en"),
    "scan_vehicles_by_brand_segment": lambda s, d: queues.where_equal(vehicles(s, d), brand_name_en="Brand#23", segment=None).select("id", "model_name_en", "segment"),
    "feature_matrix": feature_matrix,
    "feature_matrix_axes": lambda s, d: C.matrix_axes(features(s, d)),
    "feature_matrix_rollup": lambda s, d: C.feature_matrix_totals(features(s, d)),
    "feature_timeline": lambda s, d: C.feature_timeline(features(s, d)).select("id", "category", "brand_name_en", "first_seen_date", "position"),
    "first_movers": lambda s, d: C.first_movers(features(s, d)),
    "brand_comparison_entries": lambda s, d: C.brand_entries(requested(s), brands(s, d), features(s, d), vehicles(s, d)),
    "brand_comparison_rectangular": lambda s, d: C.category_comparison(requested(s), brands(s, d), features(s, d)),
    "brands_not_found": lambda s, d: C.brands_not_found(requested(s), brands(s, d)),
    "price_tier_stats": price_tier_stats,
    "price_tier_category_avg": price_tier_category_avg,
    "upsert_merge_first_seen": upsert_merge_first_seen,
}

ORACLE_SQL = {
    "feature_summaries": f"WITH {FEATURES} SELECT brand_name_en, category AS in_category, id, feature_name_en, CASE WHEN ord % 4 > 0 THEN coalesce(supplier, '') ELSE '' END AS supplier, first_seen_date FROM f",
    "scan_features_by_category": "SELECT p_partkey::VARCHAR AS id, p_brand AS brand_name_en, p_name AS feature_name_en FROM part WHERE split_part(p_name, ' ', 2) = 'gear'",
    "scan_features_by_brand": "SELECT p_partkey::VARCHAR AS id, split_part(p_name, ' ', 2) AS category, p_name AS feature_name_en FROM part WHERE p_brand = 'Brand#23'",
    "scan_vehicles_by_brand_segment": "SELECT p_partkey::VARCHAR AS id, p_name AS model_name_en, p_type AS segment FROM part WHERE p_brand = 'Brand#23'",
    "feature_matrix": f"WITH {FEATURES} SELECT brand_name_en, category, count(*) AS n_features, list(id ORDER BY id) AS feature_ids FROM f GROUP BY 1, 2",
    "feature_matrix_axes": f"WITH {FEATURES} SELECT list_sort(list(DISTINCT brand_name_en)) AS brands, list_sort(list(DISTINCT category)) AS categories, count(*) AS total_features FROM f",
    "feature_matrix_rollup": f"WITH {FEATURES} SELECT brand_name_en, category, count(*) AS n_features FROM f GROUP BY ROLLUP (brand_name_en, category)",
    "feature_timeline": f"WITH {FEATURES} SELECT id, category, brand_name_en, first_seen_date, row_number() OVER (PARTITION BY category ORDER BY first_seen_date ASC NULLS LAST, ord)::INT AS position FROM f",
    "first_movers": f"WITH {FEATURES} SELECT category, brand_name_en, id, first_seen_date FROM f QUALIFY row_number() OVER (PARTITION BY category ORDER BY first_seen_date ASC NULLS LAST, ord) = 1",
    "brand_comparison_entries": f"""WITH {FEATURES}, {BRANDS_SQL}, {REQUESTED_SQL}, x AS (SELECT brand_name_en, count(*) AS n, count(DISTINCT category) AS c FROM f GROUP BY 1), y AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)
SELECT b.name_en, parent_group, coalesce(x.n, 0) AS n_features, coalesce(x.c, 0) AS n_categories, coalesce(y.n, 0) AS n_vehicles FROM b LEFT JOIN x ON x.brand_name_en = b.name_en LEFT JOIN y ON y.p_brand = b.name_en WHERE b.name_en IN (SELECT brand FROM q)""",
    "brand_comparison_rectangular": f"""WITH {FEATURES}, {BRANDS_SQL}, {REQUESTED_SQL}, k AS (SELECT name_en FROM b WHERE name_en IN (SELECT brand FROM q)), c AS (SELECT brand_name_en, category, count(*) AS n FROM f WHERE brand_name_en IN (SELECT name_en FROM k) GROUP BY 1, 2)
SELECT g.category, g.name_en, coalesce(n, 0) AS n_features FROM (SELECT * FROM k, (SELECT DISTINCT category FROM c)) g LEFT JOIN c ON c.category = g.category AND c.brand_name_en = g.name_en""",
    "brands_not_found": f"WITH {REQUESTED_SQL} SELECT brand FROM q WHERE brand NOT IN (SELECT p_brand FROM part)",
    "price_tier_stats": f"""WITH {FEATURES}, {VEHICLES}, n AS (SELECT brand_name_en, count(*) AS n FROM f GROUP BY 1), s AS (SELECT tier, count(*) AS vehicle_count, sum(coalesce(n, 0))::BIGINT AS total FROM tiered LEFT JOIN n USING (brand_name_en) GROUP BY 1)
SELECT tier, coalesce(vehicle_count, 0) AS vehicle_count, coalesce(total, 0) AS feature_total, round(coalesce(total / vehicle_count, 0), 6) AS avg_features FROM (SELECT unnest(['budget', 'mid', 'premium', 'luxury', 'unknown']) AS tier) LEFT JOIN s USING (tier)""",
    "price_tier_category_avg": f"""WITH {FEATURES}, {VEHICLES}, n AS (SELECT tier, count(*) AS vehicles FROM tiered GROUP BY 1)
SELECT tiered.tier, category, round(count(*) / any_value(vehicles), 6) AS avg_features FROM tiered JOIN f USING (brand_name_en) JOIN n ON n.tier = tiered.tier GROUP BY 1, 2""",
    "upsert_merge_first_seen": f"""WITH {FEATURES}, o AS (SELECT brand_name_en, feature_name_en, category, max(supplier) AS supplier, min(first_seen_date) AS first_seen_date FROM f WHERE first_seen_date IS NOT NULL GROUP BY ALL),
n AS (SELECT brand_name_en, feature_name_en, category, max(CASE WHEN ord % 5 <> 0 THEN 's' || supplier END) AS supplier, min(first_seen_date + INTERVAL 9 DAY) AS first_seen_date FROM f GROUP BY ALL)
SELECT brand_name_en, feature_name_en, category, CASE WHEN n.brand_name_en IS NOT NULL THEN n.supplier ELSE o.supplier END AS supplier, coalesce(o.first_seen_date, n.first_seen_date) AS first_seen_date
FROM o FULL JOIN n USING (brand_name_en, feature_name_en, category)""",
}
