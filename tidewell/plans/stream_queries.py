"""Queries on runs and streams, over the events and conversations."""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import runs
from ..sources import batch_calls, snapshots
from ..streaming import incremental
from ..tables import materialise, workspace, table
from . import pipelines
from .corpus_queries import ARTICLES, AS_OF
from .fixtures import articles

KIND = "CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'ingested' ELSE 'request' END"


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "ingested").otherwise("request")
    return table(spark, sf_dir, "events").select("event_id", "ts", F.concat(F.lit("source"), (F.col("user_id") % 7).cast("string")).alias("source_name"), kind.alias("kind"))


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark: SparkSession, made: DataFrame, name: str) -> DataFrame:
    root = workspace(spark, f"stream-{name}")
    incremental.drain(made, f"{root}/table", f"{root}/checkpoint")
    return spark.read.schema(made.schema).parquet(f"{root}/table")


def stream_dedup_url(spark, sf_dir):
    """Each user's first event of a type by the hour, as one address, seen once within the watermark."""
    rows = stream(spark, sf_dir).select("ts", F.concat_ws("/", F.col("user_id").cast("string"), "event_type", F.date_format("ts", "yyyyMMddHH")).alias("source_url"))
    return _drained(spark, incremental.distinct_urls(rows, delay="40 days"), "urls").select("source_url")


def stream_interval_join(spark, sf_dir):
    rows = lambda kind: stream(spark, sf_dir).where(F.col("event_type") == kind).select(F.col("event_id").alias("id"), "ts", "user_id")
    return _drained(spark, incremental.lookback_join(rows("error"), rows("purchase"), "user_id"), "join").select("a_id", "b_id")


def ingest_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as requests for pages; errors have their properties as a message."""
    rows = table(spark, sf_dir, "events")
    source = F.concat(F.lit("source"), (F.col("user_id") % 7).cast("string"))
    return rows.select(source.alias("source_name"), "ts", F.concat(F.lit("https://example.org/e/"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("url"), F.when(F.col("event_type") == "error", F.col("props")).alias("message"))


def ingest_run(spark, sf_dir):
    """Listings are the articles that aren't processed yet; sources are those of the events and two that never started."""
    rows = articles(spark, sf_dir).withColumns({"source_name": F.concat(F.lit("source"), (F.col("ord") % 9).cast("string")), "title": F.col("title_en")})
    known = rows.where("processed AND phase2_processed")
    sources = spark.range(10).select(F.concat(F.lit("source"), F.col("id").cast("string")).alias("source_name"))
    return pipelines.ingest_run(rows.where("NOT processed"), rows.where("NOT processed"), known, ingest_requests(spark, sf_dir), sources, F.lit(AS_OF))


def batch_progress(spark, sf_dir):
    """Each user's events as a batch of requests."""
    state = F.when(F.col("event_type") == "purchase", "succeeded").when(F.col("event_type") == "error", "errored").when(F.col("event_type") == "click", "processing").when(F.col("event_type") == "signup", "expired").otherwise("canceled")
    return runs.batch_progress(table(spark, sf_dir, "events").select(F.col("user_id").alias("batch_id"), state.alias("state")))


def batch_answers(spark, sf_dir):
    """Users' turns as requests, the assistant's next turns as their answers, one in seven a failure; two attempts, an hour each."""
    turns = table(spark, sf_dir, "conversations").select("*", *(F.lead(c).over(W.partitionBy("conv_id").orderBy("turn")).alias(f"next_{c}") for c in ("role", "text")))
    asked = materialise(turns.where("role = 'user'").withColumn("request_id", F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))), "turns")  # every poll reads it
    answers = asked.where("next_role = 'assistant' AND next_text IS NOT NULL").select("request_id", (F.length("next_text") % 7 > 0).alias("ok"), F.col("next_text").alias("answer"))
    store = snapshots.RunStore(spark, workspace(spark, "batch-calls"))
    calls = batch_calls.BatchCalls(store, batch_calls.FolderService(f"{store.root}/outbox", answers), retries=1, max_age=3600, buckets=64)
    calls.enqueue("prompts", asked.select("request_id", F.col("text").alias("prompt")), AS_OF)
    for hour in range(0, 8, 2):
        calls.tick(f"tick{hour}", AS_OF + timedelta(hours=hour))
    return calls.requests(texts=["answer"]).select("request_id", "state", "attempts", F.md5("answer").alias("answer_md5"))


QUERIES = {
    "batch_answers": batch_answers,
    "ingest_articles": lambda s, d: ingest_run(s, d).articles.select("id", "source_name", "source_url", "processed"),
    "ingest_health": lambda s, d: ingest_run(s, d).health.select("source_name", "status", "requests_made", "articles_ingested", "error_count", F.get(F.col("errors"), F.lit(0))["url"].alias("first_error"), F.size("errors").alias("n_listed")),
    "batch_progress": batch_progress,
    "health_status_by_source": lambda s, d: runs.health_by_source(log(s, d)),
    "health_tumbling": lambda s, d: runs.health_by_window(log(s, d)),
    "run_totals": lambda s, d: runs.run_totals(runs.health_by_source(log(s, d))),
    "run_summary_json": lambda s, d: runs.summary_json(runs.run_totals(runs.health_by_source(log(s, d)))),
    "stream_dedup_url": stream_dedup_url,
    "stream_interval_join": stream_interval_join,
}

_LOG = f"""l AS (SELECT ts, 'source' || (user_id % 7)::VARCHAR AS source_name, {KIND} AS kind FROM events),
h AS (SELECT source_name, count(*) FILTER (kind = 'request') AS requests_made, count(*) FILTER (kind = 'ingested') AS articles_ingested, count(*) FILTER (kind = 'error') AS error_count FROM l GROUP BY 1),
g AS (SELECT *, CASE WHEN error_count = 0 THEN 'success' WHEN articles_ingested > 0 THEN 'partial' ELSE 'failure' END AS status FROM h)"""

_SOURCES = f"""{ARTICLES}, u AS (SELECT *, 'source' || (ord % 9)::VARCHAR AS src FROM a WHERE NOT processed AND source_url NOT IN (SELECT source_url FROM a WHERE processed AND phase2_processed)),
x AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY ord) = 1), y AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY ord) AS turn FROM x),
i AS (SELECT u.* FROM u WHERE source_url IN (SELECT source_url FROM y WHERE turn <= 25) AND title_en <> '')"""

ORACLE_SQL = {
    "ingest_articles": f"WITH {_SOURCES} SELECT id, src AS source_name, source_url, false AS processed FROM i",
    "ingest_health": f"""WITH {_SOURCES}, e AS (SELECT 'source' || (user_id % 7)::VARCHAR AS src, count(*) AS asked, count(*) FILTER (event_type = 'error') AS failed,
  arg_min('https://example.org/e/' || lpad(event_id::VARCHAR, 9, '0'), (ts, event_id)) FILTER (event_type = 'error') AS first_error FROM events GROUP BY 1), n AS (SELECT src, count(*) AS n FROM i GROUP BY 1),
s AS (SELECT 'source' || k::VARCHAR AS src FROM range(10) t(k)), h AS (SELECT s.src, coalesce(asked, 0) AS asked, coalesce(failed, 0) AS failed, coalesce(n, 0) AS n, first_error FROM s LEFT JOIN e ON e.src = s.src LEFT JOIN n ON n.src = s.src)
SELECT src AS source_name, CASE WHEN failed = 0 THEN 'success' WHEN n > 0 THEN 'partial' ELSE 'failure' END AS status, asked AS requests_made, n AS articles_ingested, failed AS error_count, first_error, least(failed, 100)::INT AS n_listed FROM h""",
    "batch_answers": """WITH t AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
q AS (SELECT conv_id || '/' || turn AS request_id, text, CASE WHEN next_role = 'assistant' THEN next_text END AS answer FROM t WHERE role = 'user')
SELECT request_id, CASE WHEN text IS NULL THEN 'canceled' WHEN answer IS NULL THEN 'expired' WHEN length(answer) % 7 = 0 THEN 'errored' ELSE 'succeeded' END AS state,
  CASE WHEN text IS NULL THEN 0 WHEN answer IS NOT NULL AND length(answer) % 7 > 0 THEN 1 ELSE 2 END AS attempts, CASE WHEN text IS NOT NULL AND length(answer) % 7 > 0 THEN md5(answer) END AS answer_md5 FROM q""",
    "batch_progress": """SELECT user_id AS batch_id, count(*) FILTER (event_type = 'click') AS processing, count(*) FILTER (event_type = 'purchase') AS succeeded, count(*) FILTER (event_type NOT IN ('click', 'purchase', 'error', 'signup')) AS canceled,
  count(*) FILTER (event_type = 'signup') AS expired, count(*) FILTER (event_type = 'error') AS errored, count(*) AS total FROM events GROUP BY 1""",
    "run_summary_json": f"WITH {_LOG}, t AS (SELECT count(*) AS sources, sum(articles_ingested)::BIGINT AS articles_ingested, sum(error_count)::BIGINT AS errors, count(*) FILTER (status = 'failure') AS failed_sources FROM g) SELECT to_json(t)::VARCHAR AS summary FROM t",
    "health_status_by_source": f"WITH {_LOG} SELECT * FROM g",
    "health_tumbling": f"WITH {_LOG} SELECT source_name, time_bucket(INTERVAL 6 HOUR, ts, timestamp '2000-01-01') AS window_start, count(*) AS requests, count(*) FILTER (kind = 'error') AS errors FROM l GROUP BY 1, 2",
    "run_totals": f"WITH {_LOG} SELECT count(*) AS sources, sum(articles_ingested)::BIGINT AS articles_ingested, sum(error_count)::BIGINT AS errors, count(*) FILTER (status = 'failure') AS failed_sources FROM g",
    "stream_dedup_url": "SELECT DISTINCT user_id::VARCHAR || '/' || event_type || '/' || strftime(ts, '%Y%m%d%H') AS source_url FROM events",
    "stream_interval_join": """SELECT a.event_id AS a_id, b.event_id AS b_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'error' AND b.event_type = 'purchase'
  AND b.ts BETWEEN a.ts - INTERVAL 72 HOUR AND a.ts + INTERVAL 72 HOUR AND a.event_id < b.event_id""",
}
