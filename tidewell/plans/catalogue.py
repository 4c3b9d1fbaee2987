"""The registered queries over the driver's tables and the SQL of those that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import comparison_queries, corpus_queries, entity_queries, store_queries, stream_queries

_PARTS = (comparison_queries, corpus_queries, entity_queries, store_queries, stream_queries)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for part in _PARTS for k, v in part.QUERIES.items()}

ORACLE_SQL: dict[str, str] = {k: v for part in _PARTS for k, v in part.ORACLE_SQL.items()}
