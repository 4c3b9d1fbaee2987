"""Queries on what runs write: results of extraction, promoted entities, answers of a resolver, appended and updated rows."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, jsonx
from ..operators import entities, listings, web
from ..sources import queues, snapshots, store
from ..tables import table, workspace
from . import pipelines
from .corpus_queries import _STORED, ARTICLES, stored_signals
from .entity_queries import article_mentions
from .fixtures import aliases, articles, brands, vehicles

AS_OF, NOTED = datetime(2024, 1, 5), datetime(2024, 1, 20, 12)


def outcomes(rows: DataFrame) -> DataFrame:
    """What a run over all articles got, as answers made from their texts: a fifth are errors, two fifths end at triage."""
    outcome = F.when(F.col("ord") % 5 == 0, "error").when(F.col("ord") % 5 <= 2, "triage_only").otherwise("extracted")
    score = (F.length("body_en") % 10).cast("long")
    short = F.struct(F.substring("body_en", 1, 40).alias("headline"), score.alias("relevance_score"), F.lit("review").alias("content_type"))
    feature = F.struct(F.element_at(F.split("body_en", " "), 1).alias("feature_name"), F.lit("ota").alias("category"), F.col("body_en").alias("description"), F.lit(None).cast("string").alias("supplier"), (F.col("ord") % 2 == 0).alias("is_new"))
    long = F.struct(
        short["headline"].alias("headline"), F.lit("s").alias("summary"), score.alias("relevance_score"), F.lit("review").alias("content_type"), F.col("vehicles_mentioned").alias("brands_mentioned"), F.col("brands_mentioned").alias("vehicles_mentioned"),
        F.array(feature, feature).alias("features_extracted"), F.lit(None).cast("string").alias("competitive_signal"),
    )
    result = F.when(outcome == "extracted", F.to_json(long, {"ignoreNullFields": "false"})).when(outcome == "triage_only", F.to_json(short))
    return rows.select("id", outcome.alias("outcome"), F.when(outcome == "extracted", jsonx.valid_extraction(result)).otherwise(jsonx.valid_triage(result)).alias("result"))


def extraction_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir)
    done = pipelines.write_back(rows, pipelines.article_update(outcomes(rows)))
    return done.select(
        "id", "title_en", "relevance_score", "content_type", "brands_mentioned", "vehicles_mentioned", F.size("features_extracted").alias("n_features"), F.element_at("features_extracted", 1)["category"].alias("category"),
        F.md5(F.element_at("features_extracted", 1)["description"]).alias("description_md5"), "competitive_signal", "processed", F.coalesce("triage_only", F.lit(False)).alias("triage_only"),
    )


def with_vehicles(rows: DataFrame) -> DataFrame:
    """Articles that name three vehicles: of a brand by its name, of an unknown maker, and of a brand by its other spelling."""
    number = lambda n: (F.col("ord") % n).cast("string")
    first = F.concat(F.lit("Brand#"), (F.col("ord") % 30 + 11).cast("string"), F.lit(" Model "), number(40))
    return rows.withColumn("vehicles_mentioned", F.array(F.concat(F.lit("Maker "), number(9)), first, F.concat(F.lit("brand 11 City "), number(3)), first))


def promoted(spark: SparkSession, sf_dir: str) -> entities.Promoted:
    rows = with_vehicles(article_mentions(spark, sf_dir))
    return entities.promote_entities(rows, aliases(spark, sf_dir), brands(spark, sf_dir))


#: When the runs of ``stored_features`` were.
RUNS = (datetime(2024, 2, 1), datetime(2024, 2, 8))


def stored_features(spark: SparkSession, sf_dir: str) -> snapshots.RunStore:
    """A store after two runs that promote features, over the even and over the odd articles; the second one is done twice.

    Articles name two new features each, of one name and two categories; every third has no vehicle.
    """
    rows = with_vehicles(article_mentions(spark, sf_dir)).where("is_new").withColumn("vehicles_mentioned", F.when(F.col("ord") % 3 > 0, F.col("vehicles_mentioned")).otherwise(F.array().cast("array<string>")))
    feature = lambda category: F.struct(F.concat(F.lit("Feature "), (F.col("ord") % 25).cast("string")).alias("feature_name"), F.lit(category).alias("category"), F.md5("body_en").alias("description"), F.lit(None).cast("string").alias("supplier"), F.lit(True).alias("is_new"))
    rows = rows.withColumn("features_extracted", F.array(feature("adas"), feature("ota")))
    known = brands(spark, sf_dir).select("name_en", entities.entity_id(F.col("name_en")).alias("brand_id"))
    into = snapshots.RunStore(spark, workspace(spark, "runs"))
    for turn, run in ((0, "first"), (1, "second"), (1, "second")):
        if into.find(run):
            continue
        base, at = into.snapshot(), F.lit(RUNS[turn])
        found = entities.merge_features(entities.promote_features(rows.where(F.col("ord") % 2 == turn), aliases(spark, sf_dir), None, known))
        made = into.upsert(base, "features", found, entities.FEATURE_KEY, ["first_seen_date"], entities.FEATURE_LINK, at, buckets=16)
        into.commit(base, run, {"features": made})
    return into


def features_after_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_features(spark, sf_dir).read("features").select("brand_name_en", "feature_name_en", "category", "article_id", "description", "vehicle_model_name", "first_seen_date", "last_updated")


def snapshot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many features each version of the store has, by the run that wrote them last."""
    into = stored_features(spark, sf_dir)
    parts = [into.read("features", into.snapshot(v)).groupBy("last_updated").agg(F.count("*").alias("n_features")).select(F.lit(v).cast("long").alias("version"), "last_updated", "n_features") for v in into.versions()]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def maker_model(prompts):
    """Answers for names of makers: those with an even number are brands."""
    said = []
    for p in prompts:
        name = p.rsplit("Name: ", 1)[-1]
        number = name.rsplit(" ", 1)[-1]
        said.append(f'It is {{"name_en": "{name.title()}"}}.' if number.isdigit() and int(number) % 2 == 0 else "I don't know.")
    return said


def resolver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the older half of the articles and one over all, with the memo of the first."""
    rows = article_mentions(spark, sf_dir).withColumn("brands_mentioned", F.array(F.concat(F.lit(" Maker "), (F.col("ord") % 60).cast("string")), F.element_at("brands_mentioned", 2)))
    known = aliases(spark, sf_dir)
    memo = entities.resolver_run(rows.where("ord % 2 = 0"), known, None, maker_model)
    return entities.resolver_run(rows, known, memo, maker_model)


def retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results and errors written back: errors stay in the queue, and a later success clears the message."""
    rows = store.new_articles(articles(spark, sf_dir))
    errors = rows.where("ord % 3 = 0").select("id", F.concat(F.lit("no answer for "), "id").alias("error"))
    again = store.failed(rows, errors)
    done = store.processed(again, rows.where("ord % 2 = 0").select("id", F.lit("done").alias("title_en")))
    return done.select("id", "processed", "processing_error", F.when(F.col("processed"), F.col("title_en")).alias("title"))


def dated_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signals of the articles as stored, dated an hour apart."""
    return store.new_signals(stored_signals(spark, sf_dir), F.lit(AS_OF)).withColumn("created_date", F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("ord").cast("int")))


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed for each language and source, made of the first words of its documents, with the address of each."""
    rows = table(spark, sf_dir, "documents").where("text IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL")
    stamp: Column = F.date_format(F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("doc_id").cast("int")), "d MMM yyyy HH:mm:ss")
    item = F.concat(F.lit("<item><title> "), F.regexp_extract("text", r"[A-Za-z]+", 0), F.lit(" </title><link>https://example.org/"), F.col("doc_id").cast("string"), F.lit("</link><pubDate>Mon, "), stamp, F.lit(" +0000</pubDate></item>"))
    return rows.groupBy("lang", "source", (F.col("doc_id") % 50).alias("part")).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.array_sort(F.collect_list(item)), ""), F.lit("</channel></rss>")).alias("xml"))  # at most a fiftieth of a source


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.feed_entries(feeds(spark, sf_dir)).select("url", "title", "publish_date")


def brands_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brands as stored, after a run that renames the groups of some and brings brands of suppliers."""
    old = brands(spark, sf_dir)
    renamed = old.where(F.substring("name_en", -1, 1) > "2").select("name_en", F.concat(F.lit("new "), "parent_group").alias("parent_group"))
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Supplier "), F.col("s_suppkey").cast("string")).alias("name_en"), F.lit(None).cast("string").alias("parent_group"))
    return store.upsert(old, renamed.unionByName(suppliers), ["name_en"], as_of=F.lit(AS_OF)).select("name_en", "parent_group", "last_updated")


def note_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' times as the stamps of notes: month and day, with a clock, minutes ago, today, and none."""
    form, local = F.col("event_id") % 5, F.from_utc_timestamp("ts", dates.BEIJING)
    text = (
        F.when(form == 0, F.concat(F.lit("编辑于 "), F.date_format(local, "MM-dd"))).when(form == 1, F.date_format(local, "yyyy-MM-dd HH:mm:ss")).when(form == 2, F.concat((F.col("event_id") % 70).cast("string"), F.lit(" 分钟前")))
        .when(form == 3, F.lit("今天 12:00")).otherwise("no date")
    )
    return table(spark, sf_dir, "events").select("event_id", dates.note_date(text, F.lit(NOTED)).alias("at"))


def news_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of search results for each document, found by one of the words; stories that several words find count under the first."""
    docs = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    story = F.concat(F.lit("https://news.example.org/"), (F.col("doc_id") % 300).cast("string"))
    title = F.concat(F.lit("Story "), F.col("doc_id").cast("string"))
    html = F.concat(F.lit('<div class="result"><h3><a href="'), story, F.lit('">'), title, F.lit("</a></h3></div>"))
    pages = docs.select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("url"), F.element_at(F.array(*(F.lit(w) for w in listings.NEWS_WORDS)), (F.col("doc_id") % 5 + 1).cast("int")).alias("word"), html.alias("html"))
    return listings.discover(pages, "baidu_news", F.lit(AS_OF), word_col="word").select("source_name", "source_url", "title", F.col("ord.turn").cast("long").alias("turn"))


def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' times as ISO strings of four forms, and forms that aren't dates."""
    form = F.col("event_id") % 6
    text = (
        F.when(form == 0, F.date_format("ts", "yyyy-MM-dd")).when(form == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(form == 2, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+08:00")))
        .when(form == 3, F.date_format("ts", "yyyyMMdd")).when(form == 4, F.concat(F.lit("on "), F.date_format("ts", "yyyy-MM-dd"))).otherwise("")
    )
    return table(spark, sf_dir, "events").select("event_id", dates.resolve_date(dates.parse_iso(text), dates.parse_iso(F.lit("1999-12-31"))).alias("at"))


def narratives_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts of conversations, wrapped as an answer with some of the keys, are valid narratives."""
    keys = F.col("turn") % 3
    quoted = F.to_json(F.struct(F.col("text").alias("summary")))
    more = F.when(keys == 0, F.lit('"title": "t", "implications_for_western_oems": null, "competitive_impact_score": 3, ')).when(keys == 1, F.lit('"title": "t", ')).otherwise("")
    answer = F.concat(F.lit("Here: {"), more, F.substring(quoted, 2, 1_000_000_000))
    valid = jsonx.valid_narrative(answer)
    return table(spark, sf_dir, "conversations").where("text IS NOT NULL").select("conv_id", "turn", valid.isNotNull().alias("valid"), F.md5(F.get_json_object(valid, "$.summary")).alias("summary_md5"))


QUERIES = {
    "extraction_writeback": extraction_writeback,
    "promote_vehicles": lambda s, d: promoted(s, d).vehicles.select("brand_name_en", "brand_id", "model_name_en", "n_articles"),
    "promote_features_linked": lambda s, d: entities.promote_features(with_vehicles(article_mentions(s, d)), aliases(s, d), None, brands(s, d).select("name_en", entities.entity_id(F.col("name_en")).alias("brand_id"))).select("article_id", "brand_name_en", "brand_id", "vehicle_model_name", "first_seen_date"),
    "promote_features_stored": features_after_runs,
    "snapshot_versions": snapshot_versions,
    "promote_entities_counts": lambda s, d: promoted(s, d).counts,
    "resolver_run": resolver_run,
    "write_back_and_retry": retried,
    "scan_recent_signals": lambda s, d: store.recent_signals(dated_signals(s, d), F.lit(datetime(2024, 1, 20)), 14).select("id", "created_date", "status"),
    "scan_vehicles_by_segment": lambda s, d: queues.where_equal(vehicles(s, d), brand_name_en=None, segment="STANDARD").select("id", "brand_name_en", "model_name_en"),
    "scan_one_article": lambda s, d: queues.find_one(articles(s, d), id="33").select("id", "source_name", "relevance_score"),
    "scan_by_source_and_type": lambda s, d: queues.where_equal(articles(s, d), source_name="src1", content_type="news").select("id", "language"),
    "scan_duplicate_group": lambda s, d: queues.where_equal(articles(s, d).withColumn("duplicate_group_id", F.concat(F.lit("g"), (F.col("ord") % 50).cast("string"))), duplicate_group_id="g7").select("id", "source_name"),
    "phase2_flags": lambda s, d: store.phase2_done(articles(s, d), articles(s, d).where("ord % 3 = 0")).select("id", "phase2_processed"),
    "upsert_brands": brands_upserted,
    "note_date_parse": note_dates,
    "news_listings": news_listings,
    "feed_entries": feed_entries,
    "iso_date_parse": iso_dates,
    "narrative_validate": narratives_valid,
    "keyword_titles": lambda s, d: articles(s, d).select("id", web.is_ev_related(F.col("title_en")).alias("related"), web.search_word(F.col("scrape_date")).alias("word")),
}

_MENTIONS = f"""{ARTICLES}, pb AS (SELECT DISTINCT p_brand AS name FROM part),
n AS (SELECT *, CASE WHEN ord % 2 = 1 THEN 'Brand#11' END AS first, 'Brand#' || (ord % 30 + 11)::VARCHAR AS second, (ord % 40)::VARCHAR AS model, (ord % 3)::VARCHAR AS city FROM a),
b AS (SELECT n.*, x.name AS b1, y.name AS b2 FROM n LEFT JOIN pb x ON x.name = first LEFT JOIN pb y ON y.name = second),
k AS (SELECT DISTINCT b1 AS name FROM b WHERE b1 IS NOT NULL UNION SELECT b2 FROM b WHERE b2 IS NOT NULL),
v AS (SELECT id, 1 AS pos, second AS brand, 'Model ' || model AS name FROM b UNION ALL SELECT id, 2, 'Brand#11', 'City ' || city FROM b),
kv AS (SELECT v.* FROM v JOIN k ON k.name = v.brand)"""
_RUNS = f"""{_MENTIONS}, f AS (SELECT v.id, arg_min(v.name, pos) AS model FROM v JOIN pb ON pb.name = v.brand GROUP BY 1),
nw AS (SELECT coalesce(b1, b2) AS brand, 'Feature ' || (ord % 25)::VARCHAR AS feature, unnest(['adas', 'ota']) AS category, b.ord, b.id, md5(body_en) AS description, CASE WHEN ord % 3 > 0 THEN f.model END AS model, b.scrape_date FROM b LEFT JOIN f ON f.id = b.id WHERE is_new AND coalesce(b1, b2) IS NOT NULL),
r AS (SELECT brand, feature, category, ord % 2 AS run, arg_min(id, ord) AS id, arg_min(description, ord) AS description, arg_min(model, ord) FILTER (model IS NOT NULL) AS model, min(scrape_date) AS first FROM nw GROUP BY ALL),
x AS (SELECT * FROM r WHERE run = 0), y AS (SELECT * FROM r WHERE run = 1)"""
_KEYWORDS = f"list_has_any([true], list_transform({list(web.EV_KEYWORDS)}, lambda k: contains(lower(title_en), k)))"

ORACLE_SQL = {
    "extraction_writeback": f"""WITH {ARTICLES}, o AS (SELECT *, CASE WHEN ord % 5 = 0 THEN 0 WHEN ord % 5 <= 2 THEN 1 ELSE 2 END AS got FROM a)
SELECT id, CASE WHEN got > 0 THEN substr(body_en, 1, 40) ELSE title_en END AS title_en, CASE WHEN got > 0 THEN (length(body_en) % 10)::INT ELSE relevance_score END AS relevance_score, CASE WHEN got > 0 THEN 'review' ELSE content_type END AS content_type,
  CASE WHEN got = 2 THEN vehicles_mentioned ELSE brands_mentioned END AS brands_mentioned, CASE WHEN got = 2 THEN brands_mentioned ELSE vehicles_mentioned END AS vehicles_mentioned, CASE WHEN got = 2 THEN 2 ELSE 1 END AS n_features,
  CASE WHEN got = 2 THEN 'ota' ELSE category END AS category, md5(body_en) AS description_md5, CASE WHEN got < 2 THEN competitive_signal END AS competitive_signal, got > 0 OR processed AS processed, got = 1 AS triage_only FROM o""",
    "promote_vehicles": f"WITH {_MENTIONS} SELECT brand AS brand_name_en, md5(brand) AS brand_id, name AS model_name_en, count(DISTINCT id) AS n_articles FROM kv GROUP BY 1, 2, 3",
    "promote_features_linked": f"""WITH {_MENTIONS}, f AS (SELECT v.id, arg_min(v.name, pos) AS model FROM v JOIN pb ON pb.name = v.brand GROUP BY 1)
SELECT b.id AS article_id, coalesce(b1, b2) AS brand_name_en, md5(coalesce(b1, b2)) AS brand_id, f.model AS vehicle_model_name, scrape_date AS first_seen_date FROM b LEFT JOIN f ON f.id = b.id WHERE is_new AND coalesce(b1, b2) IS NOT NULL""",
    "promote_features_stored": f"""WITH {_RUNS} SELECT brand AS brand_name_en, feature AS feature_name_en, category, coalesce(y.id, x.id) AS article_id, coalesce(y.description, x.description) AS description, coalesce(y.model, x.model) AS vehicle_model_name,
  coalesce(x.first, y.first) AS first_seen_date, CASE WHEN y.run IS NULL THEN timestamp '{RUNS[0]}' ELSE timestamp '{RUNS[1]}' END AS last_updated FROM x FULL JOIN y USING (brand, feature, category)""",
    "snapshot_versions": f"""WITH {_RUNS}, nk AS (SELECT brand, feature, category, max(run) AS last FROM r GROUP BY ALL)
SELECT 1 AS version, timestamp '{RUNS[0]}' AS last_updated, count(*) AS n_features FROM x HAVING count(*) > 0 UNION ALL SELECT 2, CASE last WHEN 0 THEN timestamp '{RUNS[0]}' ELSE timestamp '{RUNS[1]}' END, count(*) FROM nk GROUP BY last""",
    "promote_entities_counts": f"""WITH {_MENTIONS}, c AS (SELECT id, count(DISTINCT brand || '/' || name) AS vehicles FROM kv GROUP BY 1)
SELECT b.id, (b1 IS NOT NULL)::BIGINT + (b2 IS NOT NULL)::BIGINT AS brands_promoted, coalesce(vehicles, 0) AS vehicles_promoted, (is_new AND coalesce(b1, b2) IS NOT NULL)::BIGINT AS features_promoted FROM b LEFT JOIN c ON c.id = b.id""",
    "resolver_run": """WITH m AS (SELECT doc_id AS ord, 0 AS pos, 'maker ' || (doc_id % 60)::VARCHAR AS key FROM documents UNION ALL
  SELECT doc_id, 1, lower('Brand#' || (doc_id % 30 + 11)::VARCHAR) FROM documents WHERE 'Brand#' || (doc_id % 30 + 11)::VARCHAR NOT IN (SELECT p_brand FROM part)),
f AS (SELECT key, min((ord, pos)) AS first FROM m WHERE ord % 2 = 0 GROUP BY 1 ORDER BY first, key LIMIT 20), s AS (SELECT key, min((ord, pos)) AS first FROM m WHERE key NOT IN (SELECT key FROM f) GROUP BY 1 ORDER BY first, key LIMIT 20),
k AS (SELECT key FROM f UNION ALL SELECT key FROM s)
SELECT key, CASE WHEN key LIKE 'maker %' AND split_part(key, ' ', 2)::INT % 2 = 0 THEN 'Maker ' || split_part(key, ' ', 2) END AS name_en FROM k""",
    "write_back_and_retry": """SELECT doc_id::VARCHAR AS id, doc_id % 2 = 0 AS processed, CASE WHEN doc_id % 3 = 0 AND doc_id % 2 <> 0 THEN 'no answer for ' || doc_id::VARCHAR END AS processing_error, CASE WHEN doc_id % 2 = 0 THEN 'done' END AS title FROM documents""",
    "scan_recent_signals": f"""WITH {ARTICLES}, {_STORED} SELECT signal_type || '/' || article_id AS id, timestamp '2024-01-01' + to_hours(ord::INT) AS created_date, 'pending' AS status FROM s WHERE timestamp '2024-01-01' + to_hours(ord::INT) >= timestamp '2024-01-06'""",
    "scan_vehicles_by_segment": "SELECT p_partkey::VARCHAR AS id, p_brand AS brand_name_en, p_name AS model_name_en FROM part WHERE p_type = 'STANDARD'",
    "scan_one_article": f"WITH {ARTICLES} SELECT id, source_name, relevance_score FROM a WHERE id = '33'",
    "scan_by_source_and_type": f"WITH {ARTICLES} SELECT id, language FROM a WHERE source_name = 'src1' AND content_type = 'news'",
    "scan_duplicate_group": f"WITH {ARTICLES} SELECT id, source_name FROM a WHERE ord % 50 = 7",
    "phase2_flags": f"WITH {ARTICLES} SELECT id, CASE WHEN ord % 3 = 0 THEN true ELSE phase2_processed END AS phase2_processed FROM a",
    "upsert_brands": f"""WITH b AS (SELECT DISTINCT p_brand AS name_en, 'group' || right(p_brand, 1) AS parent_group FROM part)
SELECT name_en, CASE WHEN right(name_en, 1) > '2' THEN 'new ' || parent_group ELSE parent_group END AS parent_group, CASE WHEN right(name_en, 1) > '2' THEN timestamp '{AS_OF}' END AS last_updated FROM b
UNION ALL SELECT 'Supplier ' || s_suppkey::VARCHAR, NULL, timestamp '{AS_OF}' FROM supplier""",
    "note_date_parse": f"""WITH e AS (SELECT event_id, ts::TIMESTAMP + INTERVAL 8 HOUR AS t, timestamp '{NOTED}' AS n FROM events),
y AS (SELECT *, make_timestamp(year(n + INTERVAL 8 HOUR), month(t), day(t), 0, 0, 0) - INTERVAL 8 HOUR AS this, make_timestamp(year(n + INTERVAL 8 HOUR) - 1, month(t), day(t), 0, 0, 0) - INTERVAL 8 HOUR AS last FROM e)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN CASE WHEN this > n + INTERVAL 1 DAY THEN last ELSE this END WHEN 1 THEN date_trunc('second', t) - INTERVAL 8 HOUR WHEN 2 THEN n - to_minutes((event_id % 70)::INT) WHEN 3 THEN n END AS at FROM y""",
    "news_listings": """WITH r AS (SELECT doc_id, doc_id % 300 AS story, doc_id % 5 + 1 AS turn FROM documents WHERE doc_id IS NOT NULL)
SELECT 'baidu_news' AS source_name, 'https://news.example.org/' || story::VARCHAR AS source_url, 'Story ' || arg_min(doc_id, (turn, doc_id))::VARCHAR AS title, min(turn) AS turn FROM r GROUP BY story""",
    "feed_entries": r"""SELECT 'https://example.org/' || doc_id::VARCHAR AS url, regexp_extract(text, '[A-Za-z]+') AS title, timestamp '2024-01-01' + to_hours(doc_id::INT) AS publish_date FROM documents WHERE text IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL""",
    "iso_date_parse": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('second', ts) - INTERVAL 8 HOUR WHEN 3 THEN date_trunc('day', ts) ELSE timestamp '1999-12-31' END AS at FROM events""",
    "narrative_validate": "SELECT conv_id, turn, turn % 3 = 0 AS valid, CASE WHEN turn % 3 = 0 THEN md5(text) END AS summary_md5 FROM conversations WHERE text IS NOT NULL",
    "keyword_titles": f"WITH {ARTICLES} SELECT id, {_KEYWORDS} AS related, {list(web.SEARCH_WORDS)}[dayofyear(scrape_date)::INT % {len(web.SEARCH_WORDS)} + 1] AS word FROM a",
}
