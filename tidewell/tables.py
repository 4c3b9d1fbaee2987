"""Reading tables and cutting lineage with tables in the shared folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: what the session names in ``spark.checkpoint.dir``.

    Only where that is unset and all tasks run in the driver's process, as in tests, a temporary folder is made and set; a
    cluster without a shared folder is an error, for its machines would not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


#: Tables that ``materialise`` wrote for this process and nobody deleted yet.
_made: list[str] = []


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder of the shared folder for what a query stores; ``clear`` deletes it."""
    _made.append(path := f"{shared_dir(spark)}/tidewell-{name}-{uuid.uuid4().hex}")
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back, so that a lost executor costs no recomputation.

    Results that are returned lazily read such tables: ``clear`` deletes them once the results are written.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, place: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` wrote and nothing reads any more; other tables stay."""
    for file in df.inputFiles()[:1]:
        name = file.rsplit("/", 2)[-2]
        for path in [p for p in _made if p.rsplit("/", 1)[-1] == name]:
            _delete(df.sparkSession, path)
            _made.remove(path)


def clear(spark: SparkSession) -> None:
    """Delete all tables that ``materialise`` wrote in this process: results not written elsewhere are lost."""
    while _made:
        _delete(spark, _made.pop())
