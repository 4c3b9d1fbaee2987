"""Dictionaries from configuration files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BRAND = "struct<nameZh: string, parentGroup: string, evFocus: boolean>"


def load_aliases(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``alias, canonical`` and the brands' metadata, from one JSON object with ``aliases`` and ``brands``."""
    config = spark.read.schema(f"aliases map<string, string>, brands map<string, {BRAND}>").json(path, multiLine=True)
    aliases = config.select(F.explode("aliases").alias("alias", "canonical"))
    meta = config.select(F.explode("brands").alias("name_en", "b")).select("name_en", F.col("b.nameZh").alias("name_zh"), F.col("b.parentGroup").alias("parent_group"), F.col("b.evFocus").alias("ev_focus"))
    return aliases, meta


def load_glossary(spark: SparkSession, path: str) -> DataFrame:
    """Terms with their right and wrong translations."""
    return spark.read.schema("term_zh string, correct string, wrong string").json(path, multiLine=True)
