"""Writing the collections: appends with defaults, partial updates and upserts as a join."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def new_articles(articles: DataFrame) -> DataFrame:
    """As they are appended: unprocessed and without an error."""
    return articles.withColumns({"processed": F.lit(False), "processing_error": F.lit(None).cast("string")})


def new_signals(signals: DataFrame, as_of: Column) -> DataFrame:
    """As they are appended: dated, and pending unless they say otherwise."""
    status = F.coalesce("status", F.lit("pending")) if "status" in signals.columns else F.lit("pending")
    return signals.withColumns({"created_date": as_of, "status": status})


def recent_signals(signals: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Signals dated within ``days`` before ``as_of``, that moment included."""
    return signals.where(F.col("created_date") >= as_of - F.make_interval(days=F.lit(days)))


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], create_only: Sequence[str] = (), keep_known: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """The table after ``new`` is merged into ``old`` on ``key``, in which nulls are equal.

    A row that matches gets every column that ``new`` has, nulls included, except ``create_only`` ones, which keep an
    old value, and ``keep_known`` ones, which keep it where ``new`` has null; other rows are inserted. Columns that only
    ``old`` has stay. ``new`` must have a key once. With ``as_of``, ``last_updated`` is set on the rows of ``new``.
    """
    if as_of is not None:
        new = new.withColumn("last_updated", as_of)
    fresh = new.select(*(F.col(c).alias(f"new_{c}") for c in new.columns), F.lit(True).alias("__new"))
    kept = old.withColumn("__old", F.lit(True))
    joined = kept.join(fresh, reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in key)), "full_outer")
    out = []
    for c in dict.fromkeys([*old.columns, *new.columns]):
        if c not in new.columns:
            out.append(F.col(c))
        elif c not in old.columns:
            out.append(F.col(f"new_{c}").alias(c))
        elif c in key:
            out.append(F.when(F.col("__old"), F.col(c)).otherwise(F.col(f"new_{c}")).alias(c))
        elif c in create_only:
            out.append(F.coalesce(F.col(c), F.col(f"new_{c}")).alias(c))
        elif c in keep_known:
            out.append(F.coalesce(F.col(f"new_{c}"), F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("__new"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def update(rows: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """``rows`` with the columns of ``changes`` where the key matches; keys that ``rows`` lacks are dropped."""
    fresh = changes.select(key, *(F.col(c).alias(f"new_{c}") for c in changes.columns if c != key), F.lit(True).alias("__new"))
    joined = rows.join(fresh, key, "left")
    value = lambda c: F.when(F.col("__new"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in changes.columns and c != key else F.col(c)
    return joined.select(*(value(c) for c in rows.columns), *(F.col(f"new_{c}").alias(c) for c in changes.columns if c not in rows.columns))


def processed(articles: DataFrame, results: DataFrame) -> DataFrame:
    """Results written back: processed, and no error any more."""
    return update(articles, results.withColumns({"processed": F.lit(True), "processing_error": F.lit(None).cast("string")}))


def failed(articles: DataFrame, errors: DataFrame) -> DataFrame:
    """Errors written back; the articles stay in the queue."""
    return update(articles, errors.select("id", F.col("error").alias("processing_error")))


def phase2_done(articles: DataFrame, ids: DataFrame) -> DataFrame:
    return update(articles, ids.select("id", F.lit(True).alias("phase2_processed")))
