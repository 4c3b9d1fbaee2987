"""Reading the collections: work queues, recent windows, point look-ups. Filters reach the Parquet scan."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUEUE, PHASE2, PER_SOURCE, CHUNK = 50, 100, 25, 100
MOST = 100_000


def unprocessed(articles: DataFrame, limit: int = QUEUE) -> DataFrame:
    """The oldest articles still to be processed."""
    return articles.where(~F.col("processed")).orderBy("scrape_date", "id").limit(limit)


def recent(rows: DataFrame, date_col: str, as_of: datetime, hours: int) -> DataFrame:
    """Rows dated from ``hours`` before ``as_of`` on (that moment included), newest first; undated ones are left out."""
    return rows.where(F.col(date_col) >= F.lit(as_of) - F.make_interval(hours=F.lit(hours))).orderBy(F.desc(date_col), "id")


def recent_processed(articles: DataFrame, as_of: datetime, hours: int = 72) -> DataFrame:
    return recent(articles.where("processed"), "scrape_date", as_of, hours)


def phase2_queue(articles: DataFrame, limit: int | None = PHASE2) -> DataFrame:
    """Processed articles whose second phase isn't done (false or missing), newest first."""
    queue = articles.where(F.col("processed") & ~F.coalesce("phase2_processed", F.lit(False))).orderBy(F.desc("scrape_date"), "id")
    return queue if limit is None else queue.limit(limit)


def where_equal(rows: DataFrame, **values: object) -> DataFrame:
    """Rows with all these values; a value of None asks for nothing."""
    for column, value in values.items():
        if value is not None:
            rows = rows.where(F.col(column) == F.lit(value))
    return rows


def find_one(rows: DataFrame, **values: object) -> DataFrame:
    return where_equal(rows, **values).limit(1)


def signals_of_article(signals: DataFrame, article_id: str | Column) -> DataFrame:
    return signals.where(F.array_contains("source_article_ids", article_id))


def keep_first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in the given order; rows without a key are left out. Groups are aggregated before the shuffle."""
    some = rows.where(F.coalesce(F.col(key), F.lit("")) != "")
    return some.groupBy(key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("row")).select("row.*")


def new_listings(listings: DataFrame, known: DataFrame, per_source: int = PER_SOURCE) -> DataFrame:
    """Listings whose URL isn't stored yet, each URL once, up to ``per_source`` of each source in listing order."""
    fresh = keep_first(listings, "source_url", "ord").join(known.select("source_url"), "source_url", "left_anti")
    return fresh.withColumn("turn", F.row_number().over(W.partitionBy("source_name").orderBy("ord"))).where(F.col("turn") <= per_source)


def chunks(rows: DataFrame, order: str, size: int = CHUNK) -> DataFrame:
    """``chunk`` from 0, of ``size`` rows in order. For a run's queue, which is limited; ``MOST`` rows at most, checked."""
    if rows.count() > MOST:
        raise ValueError(f"more than {MOST} rows: a run takes a limited queue")
    return rows.withColumn("chunk", F.floor((F.row_number().over(W.orderBy(order)) - 1) / F.lit(size)))


def corpus_without_batch(recent_rows: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch, and what is recent and not in it."""
    return batch.unionByName(recent_rows.join(batch.select("id"), "id", "left_anti"), allowMissingColumns=True)
