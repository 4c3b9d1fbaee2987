"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before kept. All but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.jaccard import keep_one_of_each_class
from tidewell.llm.mixing import mix_sources
from tidewell.llm.packing import pack_documents
from tidewell.llm.quality import classify_quality
from tidewell.llm.queries import tokenizer_path
from tidewell.llm.substring import cut_passages, repeated_passages
from tidewell.tables import discard, materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return classify_quality(docs, table(spark, sf_dir, "labels")).where("predicted = 1").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that link, the one with the smallest id stays."""
    return keep_one_of_each_class(docs)


def repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has are cut out; every document stays."""
    cut = cut_passages(docs, repeated_passages(docs))
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else cut


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled so that sources, languages and topics come nearer to their target weights."""
    return mix_sources(docs).where("sampled").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeated),
    ("mixing sources", mixing),
    ("best-fit packing", packing),
]

#: The classifier, the window search and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(docs)  # the table of the stage before; the documents themselves stay
        docs = done
    return docs
