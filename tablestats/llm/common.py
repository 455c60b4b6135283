"""Helpers shared by the corpus operators: input columns, written tables, sizes.

Intermediate tables go to the folder all executors share
(``spark.checkpoint.dir``); nothing is kept in an executor's own storage, so a
lost executor costs a re-run of its tasks and no more.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestats.session import ensure_checkpoint_dir

#: Rows up to which a side is broadcast after its rows were counted (narrow
#: rows: some tens of MB at most).  Beyond it the join shuffles.
BROADCAST_ROWS = 500_000

#: Rows per Arrow batch: texts are long, and a batch is held several times over.
BATCH_ROWS = 1_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to ``BATCH_ROWS`` rows, which bounds Python's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of its own only where unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def written(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back; ``by``: columns with a folder per value."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._corpus_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table that ``written`` made and nothing reads any more."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df._corpus_path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df`` if its counted ``rows`` are within the bound; else shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: as empty text)."""
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % F.lit(modulus)


def same_row(text: str = "text") -> Column:
    """Tells rows of one ``doc_id`` with different texts apart."""
    return F.xxhash64(F.col(text).isNull(), F.col(text))
