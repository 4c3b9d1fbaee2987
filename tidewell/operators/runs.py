"""Health of runs: status, counters and totals."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def run_status(errors: Column, ingested: Column) -> Column:
    return F.when(errors == 0, "success").when(ingested > 0, "partial").otherwise("failure")


def health_by_source(log: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Requests, ingested articles and errors of each source (``kind`` of each log row), with its status.

    With ``sources``, those without a row have zeros.
    """
    counts = log.groupBy("source_name").agg(
        F.count_if(F.col("kind") == "request").alias("requests_made"), F.count_if(F.col("kind") == "ingested").alias("articles_ingested"), F.count_if(F.col("kind") == "error").alias("error_count")
    )
    if sources is not None:
        counts = sources.select("source_name").distinct().join(counts, "source_name", "left").na.fill(0)
    return counts.withColumn("status", run_status(F.col("error_count"), F.col("articles_ingested")))


def health_by_window(log: DataFrame, width: str = "6 hours") -> DataFrame:
    """The same counters for each source and span of time."""
    spans = log.groupBy("source_name", F.window("ts", width).alias("w"))
    return spans.agg(F.count("*").alias("requests"), F.count_if(F.col("kind") == "error").alias("errors")).select("source_name", F.col("w.start").alias("window_start"), "requests", "errors")


def health_rows(log: DataFrame, sources: DataFrame, as_of: Column, keep_errors: int = 100) -> DataFrame:
    """What a run appends to the health table: a row for each source, with zeros if it never started.

    ``log`` has ``source_name``, ``ts``, ``kind``, ``url`` and ``message``. The first ``keep_errors`` errors of a source are
    listed, in the order of time; ``error_count`` counts all.
    """
    errors = log.where("kind = 'error'").withColumn("turn", F.row_number().over(W.partitionBy("source_name").orderBy("ts", "url"))).where(F.col("turn") <= keep_errors)
    listed = errors.groupBy("source_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "url", "message"))), lambda e: F.struct(e["url"].alias("url"), e["message"].alias("message"))).alias("errors"))
    spans = log.groupBy("source_name").agg((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))).alias("micros"))
    none = F.array().cast("array<struct<url: string, message: string>>")
    rows = health_by_source(log, sources).join(listed, "source_name", "left").join(spans, "source_name", "left")
    return rows.select("source_name", as_of.alias("run_timestamp"), "status", "articles_ingested", "requests_made", "error_count", F.coalesce("errors", none).alias("errors"), (F.coalesce("micros", F.lit(0)) / 1e6).alias("duration_seconds"))


def batch_progress(requests: DataFrame) -> DataFrame:
    """How many requests of each batch are in each state; a state that isn't known counts as an error."""
    state = lambda name: F.count_if(F.col("state") == name).alias(name)
    known = ("processing", "succeeded", "canceled", "expired")
    return requests.groupBy("batch_id").agg(*(state(s) for s in known), F.count_if(~F.coalesce(F.col("state").isin(*known), F.lit(False))).alias("errored"), F.count("*").alias("total"))


def run_totals(health: DataFrame) -> DataFrame:
    return health.agg(
        F.count("*").alias("sources"), F.sum("articles_ingested").alias("articles_ingested"), F.sum("error_count").alias("errors"),
        F.count_if(F.col("status") == "failure").alias("failed_sources"),
    )


def summary_json(row: DataFrame) -> DataFrame:
    return row.select(F.to_json(F.struct("*")).alias("summary"))
