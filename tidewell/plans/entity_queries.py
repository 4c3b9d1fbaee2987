"""Queries on entities, model answers and web pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, jsonx
from ..operators import entities, web
from ..tables import table
from . import pipelines
from .corpus_queries import ARTICLES
from .fixtures import aliases, articles, brands

MENTIONS = """m AS (
  SELECT p_partkey AS id, p_partkey AS ord, p_partkey AS row, 0 AS pos, p_name,
    CASE p_partkey % 5 WHEN 0 THEN '  ' || upper(p_brand) || ' ' WHEN 1 THEN lower(replace(p_brand, '#', ' ')) WHEN 2 THEN 'Honor' WHEN 3 THEN p_brand ELSE 'Maker ' || (p_partkey % 400)::VARCHAR END AS name FROM part),
al AS (SELECT DISTINCT p_brand AS canonical, unnest([lower(p_brand), lower(replace(p_brand, '#', ' '))]) AS alias FROM part)"""


def mentions(spark, sf_dir) -> DataFrame:
    """Brand names as articles spell them, one for each part."""
    key, brand = F.col("p_partkey"), F.col("p_brand")
    name = F.when(key % 5 == 0, F.concat(F.lit("  "), F.upper(brand), F.lit(" "))).when(key % 5 == 1, F.lower(F.replace(brand, F.lit("#"), F.lit(" ")))).when(key % 5 == 2, "Honor").when(key % 5 == 3, brand)
    return table(spark, sf_dir, "part").select(key.alias("id"), key.alias("ord"), key.alias("row"), F.lit(0).alias("pos"), "p_name", name.otherwise(F.concat(F.lit("Maker "), (key % 400).cast("string"))).alias("name"))


def named(spark, sf_dir) -> DataFrame:
    return mentions(spark, sf_dir).where(~entities.is_not_a_brand(F.col("name")))


def vehicle_split(spark, sf_dir):
    rows = mentions(spark, sf_dir).withColumn("name", F.concat("name", F.lit(" "), "p_name"))
    return entities.split_vehicles(rows, aliases(spark, sf_dir)).select("id", "brand", "model")


def article_mentions(spark, sf_dir) -> DataFrame:
    """Articles that name two makers each, the first of which every other article's alias table lacks."""
    rows = articles(spark, sf_dir)
    first = F.when(F.col("ord") % 2 == 0, F.concat(F.lit("Maker "), F.col("ord").cast("string"))).otherwise("brand 11")
    return rows.withColumn("brands_mentioned", F.array(first, F.concat(F.lit("Brand#"), (F.col("ord") % 30 + 11).cast("string"))))


def answers(spark, sf_dir) -> DataFrame:
    """Model answers for all events: objects in prose, bad scores, missing keys, and no object at all."""
    key = F.col("event_id")
    score = F.when(key % 7 == 0, '"high"').when(key % 7 == 1, "7.5").when(key % 7 == 2, "true").when(key % 7 == 3, "null").otherwise((key % 10).cast("string"))
    keyed = F.concat(F.lit('{"headline": "h", "relevance_score": '), score, F.when(key % 11 == 0, "}").otherwise(', "content_type": "news"}'))
    text = F.when(key % 13 == 0, "no answer").when(key % 13 == 1, "[1, 2]").when(key % 3 == 0, F.concat(F.lit("Sure: "), keyed, F.lit(" Done."))).otherwise(keyed)
    return table(spark, sf_dir, "events").select(key.alias("id"), "props", text.alias("text"))


def triage_answers(spark, sf_dir):
    valid = jsonx.valid_triage(F.col("text"))
    score = jsonx.whole_number(valid, "relevance_score")
    return answers(spark, sf_dir).select("id", valid.isNotNull().alias("valid"), score.alias("relevance_score"), F.coalesce(score >= pipelines.RELEVANT, F.lit(True)).alias("passes"))


def json_salvage(spark, sf_dir):
    wrapped = F.concat(F.lit("The answer is "), "props", F.lit(", as asked."))
    return answers(spark, sf_dir).select("id", F.get_json_object(jsonx.json_object(wrapped), "$.k").cast("long").alias("k"), jsonx.has_keys(F.col("props"), ["k"]).alias("has_k"), jsonx.has_keys(F.col("props"), ["k", "z"]).alias("has_z"))


def chinese_dates(spark, sf_dir):
    """Stamps written from the events' times in Beijing, in three forms, and read back."""
    at = F.date_trunc("minute", "ts")
    local = F.from_utc_timestamp(at, dates.BEIJING)
    form = F.when(F.col("event_id") % 3 == 1, F.date_format(local, "yyyy-M-d HH:mm")).otherwise(F.concat((F.col("event_id") % 50).cast("string"), F.lit("小时前")))
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("发布于 "), F.date_format(local, "yyyy"), F.lit("年"), F.date_format(local, "M"), F.lit("月"), F.date_format(local, "d"), F.lit("日 "), F.date_format(local, "HH:mm"))).otherwise(form)
    return table(spark, sf_dir, "events").select("event_id", dates.result_date(text, F.lit("2024-02-01 00:00:00").cast("timestamp")).alias("parsed"))


def url_normalize(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    href = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("//www.example.org/p/"), F.col("page_id").cast("string"), F.lit("#top"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("/p/"), F.col("page_id").cast("string"))).otherwise(F.col("url"))
    return rows.select("page_id", web.same_site_url(href, "https://example.org", "example.org").alias("url"), web.note_url(F.concat(F.lit("https://n.org/discovery/item/0123456789abcdef"), F.lpad(F.lower(F.hex("page_id")), 4, "0"), F.lit("?x=1")), "https://n.org").alias("note"))


QUERIES = {
    "alias_resolution": lambda s, d: entities.resolve_brands(named(s, d), aliases(s, d)).select("id", "canonical"),
    "resolution_budget": lambda s, d: entities.names_for_the_model(named(s, d), aliases(s, d)),
    "vehicle_split": vehicle_split,
    "promote_brands": lambda s, d: entities.promote_brands(article_mentions(s, d), aliases(s, d), brands(s, d)),
    "promote_features_first_brand": lambda s, d: entities.promote_features(article_mentions(s, d), aliases(s, d)).select("article_id", "brand_name_en", "feature_name_en", "category", "launch_type", "first_seen_date"),
    "json_salvage_validate": json_salvage,
    "triage_filter": triage_answers,
    "extraction_summary": lambda s, d: pipelines.run_summary(pipelines.extraction_outcomes(articles(s, d).where("NOT processed"))),
    "chinese_date_parse": chinese_dates,
    "url_normalize": url_normalize,
    "html_articles": lambda s, d: web.scrape_articles(table(s, d, "pages"), "baidu_news", F.lit("2024-02-01").cast("timestamp")).select("source_url", "title", F.md5("body").alias("body_md5"), "publish_date"),
    "html_links": lambda s, d: web.links(table(s, d, "pages").select("page_id", "html")).select("page_id", "ord", "href", "title"),
}

_ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*["''][^"'']*["''][^>]*>.*?</a>"""

ORACLE_SQL = {
    "html_links": f"""WITH c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', ' ', 'g'), '(?is)<style\\b.*?</style>', ' ', 'g'), '(?is)<noscript\\b.*?</noscript>', ' ', 'g') AS h FROM pages),
l AS (SELECT page_id, regexp_extract_all(h, '{_ANCHOR}') AS l FROM c), r AS (SELECT page_id, unnest(range(len(l))) AS ord, unnest(l) AS anchor FROM l)
SELECT page_id, ord::INT AS ord, regexp_extract(anchor, '(?is)href\\s*=\\s*["'']([^"'']*)["'']', 1) AS href, trim(regexp_replace(regexp_replace(anchor, '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS title FROM r""",
    "alias_resolution": f"WITH {MENTIONS} SELECT id, canonical FROM m LEFT JOIN al ON alias = lower(trim(name)) WHERE name <> 'Honor'",
    "resolution_budget": f"""WITH {MENTIONS}, u AS (SELECT lower(trim(name)) AS key, min(ord) AS first FROM m WHERE name <> 'Honor' AND lower(trim(name)) NOT IN (SELECT alias FROM al) GROUP BY 1)
SELECT key, (row_number() OVER (ORDER BY first, key))::INT AS turn FROM u QUALIFY turn <= 20""",
    "vehicle_split": f"""WITH {MENTIONS}, w AS (SELECT id, string_split_regex(trim(name || ' ' || p_name), '\\s+') AS w FROM m), t AS (SELECT id, w, unnest([1, 2, 3]) AS n FROM w)
SELECT id, canonical AS brand, array_to_string(w[n + 1:], ' ') AS model FROM t JOIN al ON alias = lower(array_to_string(w[1:n], ' ')) WHERE n < len(w) QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC) = 1""",
    "promote_brands": """WITH n AS (SELECT doc_id AS id, unnest([CASE WHEN doc_id % 2 = 0 THEN NULL ELSE 'Brand#11' END, 'Brand#' || (doc_id % 30 + 11)::VARCHAR]) AS name_en FROM documents)
SELECT name_en, count(DISTINCT id) AS n_articles, 'group' || right(name_en, 1) AS parent_group FROM n WHERE name_en IN (SELECT p_brand FROM part) GROUP BY 1""",
    "promote_features_first_brand": f"""WITH {ARTICLES}, n AS (SELECT *, CASE WHEN ord % 2 = 1 THEN 'Brand#11' END AS first, 'Brand#' || (ord % 30 + 11)::VARCHAR AS second FROM a WHERE is_new),
b AS (SELECT *, coalesce((SELECT any_value(p_brand) FROM part WHERE p_brand = first), (SELECT any_value(p_brand) FROM part WHERE p_brand = second)) AS brand_name_en FROM n)
SELECT id AS article_id, brand_name_en, vehicles_mentioned[1] AS feature_name_en, category, 'new' AS launch_type, scrape_date AS first_seen_date FROM b WHERE brand_name_en IS NOT NULL""",
    "triage_filter": """WITH t AS (SELECT event_id AS id, event_id % 13 > 1 AND event_id % 11 <> 0 AND event_id % 7 > 3 AS valid FROM events), s AS (SELECT id, valid, CASE WHEN valid THEN id % 10 END AS relevance_score FROM t)
SELECT id, valid, relevance_score, coalesce(relevance_score >= 4, true) AS passes FROM s""",
    "json_salvage_validate": """SELECT event_id AS id, (props->>'k')::BIGINT AS k, props->>'k' IS NOT NULL AS has_k, props->>'z' IS NOT NULL AS has_z FROM events""",
    "chinese_date_parse": "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN timestamp '2024-02-01' - to_hours((event_id % 50)::INT) ELSE date_trunc('minute', ts) END AS parsed FROM events",
    "url_normalize": """SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://www.example.org/p/' || page_id::VARCHAR WHEN 1 THEN 'https://example.org/p/' || page_id::VARCHAR ELSE CASE WHEN url LIKE '%example.org%' THEN split_part(url, '#', 1) END END AS url,
  'https://n.org/explore/0123456789abcdef' || lpad(lower(to_hex(page_id)), 4, '0') AS note FROM pages""",
}
