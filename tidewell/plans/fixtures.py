"""The driver's tables in the shapes that the kernels take: articles, features, vehicles, brands, aliases, runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import table

CATEGORIES = ("adas", "ai_assistant", "infotainment", "connectivity", "ota", "battery_software", "cockpit_ux")
CONTENT_TYPES = ("news", "review", "teardown", "forum_post", "opinion", "regulatory", "earnings")

ARTICLES = """
SELECT cast(doc_id AS string) AS id, doc_id AS ord, source AS source_name, lang AS language,
  'https://example.org/' || source || '/' || cast(doc_id % 700 AS string) AS source_url,
  substr(regexp_extract(text, '^[^.!?\\n]*[.!?]?', 0), 1, 200) AS title_en, text AS body_en,
  array_sort(array_distinct(filter(w, x -> length(x) = 10))) AS brands_mentioned, array_sort(array_distinct(filter(w, x -> length(x) > 10))) AS vehicles_mentioned,
  timestamp'2024-01-01' + make_dt_interval(0, 0, cast(doc_id * 7 AS int), 0) AS scrape_date,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE timestamp'2024-01-01' + make_dt_interval(0, 0, cast(doc_id * 7 - 60 AS int), 0) END AS publish_date,
  element_at(array('adas', 'ai_assistant', 'infotainment', 'connectivity', 'ota', 'battery_software', 'cockpit_ux'), length(regexp_extract(text, '[A-Za-zÀ-ÿ]+', 0)) % 7 + 1) AS category,
  element_at(array('news', 'review', 'teardown', 'forum_post', 'opinion', 'regulatory', 'earnings'), cast(n_chars % 5 AS int) + 1) AS content_type,
  cast(1 + n_chars % 10 AS int) AS relevance_score, n_chars % 3 = 0 AS is_new, doc_id % 4 <> 0 AS processed,
  CASE WHEN doc_id % 6 = 0 THEN NULL ELSE doc_id % 5 = 0 END AS phase2_processed,
  CASE WHEN n_chars % 2 = 0 THEN 'impact ' || lang ELSE NULL END AS competitive_signal
FROM (SELECT *, filter(split(lower(text), '[^a-zà-ÿ]+'), x -> length(x) >= 10) AS w FROM {documents})
"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = spark.sql(ARTICLES, documents=docs)
    feature = F.struct(
        F.try_element_at("vehicles_mentioned", F.lit(1)).alias("feature_name"), "category", F.col("body_en").alias("description"), F.lit(None).cast("string").alias("supplier"), "is_new"
    )
    return out.withColumns({"features_extracted": F.array(feature), "is_duplicate": F.lit(None).cast("boolean"), "duplicate_group_id": F.lit(None).cast("string")})


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of brands; every seventeenth is undated."""
    part, line = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    dated = line.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_shipdate").alias("first"), F.min("l_suppkey").alias("by"))
    return part.join(dated, "p_partkey", "left").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("ord"), F.col("p_brand").alias("brand_name_en"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("category"),
        F.col("p_name").alias("feature_name_en"), F.when(F.col("p_partkey") % 17 != 0, F.col("first")).alias("first_seen_date"), F.col("by").cast("string").alias("supplier"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, low = F.col("p_partkey"), F.col("p_size") * 12
    price = F.when(key % 11 == 0, None).when(key % 13 == 0, "TBD").otherwise(F.concat(low.cast("string"), F.lit(",000-"), (low + 50).cast("string"), F.lit(",000")))
    return table(spark, sf_dir, "part").select(key.cast("string").alias("id"), F.col("p_brand").alias("brand_name_en"), F.col("p_name").alias("model_name_en"), F.col("p_type").alias("segment"), price.alias("price_range_cny"))


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands of the parts, their group from the last digit."""
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("name_en")).distinct().withColumn("parent_group", F.concat(F.lit("group"), F.substring("name_en", -1, 1)))


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spellings of each brand: with a blank for the number sign, and the number alone."""
    name = F.col("name_en")
    return brands(spark, sf_dir).select(F.explode(F.array(F.lower(F.replace(name, F.lit("#"), F.lit(" "))), F.lower(name))).alias("alias"), name.alias("canonical"))
