"""Pieces that several corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talus.shipping import with_package

#: Characters that separate words: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Only where the session names none and runs on one machine (tests) a
    temporary one is made and set; a cluster has to name it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            return jvm_dir.get()
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='talus-')}"
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return path


#: Spark's switch for giving back a query's shuffle files at its end.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: lost executors cost a re-read, not the work before.
    So nothing needs the shuffle files that led to the table, and they go at
    once; else iterations pile them up until the driver collects its garbage.
    The table goes with :func:`discard`, or when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/talus-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    table = spark.read.schema(df.schema).parquet(path)
    table._talus_folder = folder
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialise` that nothing reads any more."""
    for table in tables:
        folder = table.__dict__.get("_talus_folder")
        if folder is not None:
            folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


#: Spark's setting for the rows of a batch that goes to a Python worker, and what whole texts leave room for.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 1000


def to_workers(df: DataFrame) -> DataFrame:
    """``df`` for functions of this package over whole texts, in batches that neither side need hold many of."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_ROWS)) <= MOST_ROWS:
        conf.set(BATCH_ROWS, str(MOST_ROWS))
    return with_package(df)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out over all shuffle partitions: for short rows that many others are made of."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the byte-wise built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column) -> Column:
    """The runs of ``[^\\x20\\x09-\\x0D]`` in a non-null text."""
    return F.array_remove(F.split(text, SPACE), "")


def fold(doc_id: Column, folds: int = 4) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, whatever the case."""
    have = {c.lower() for c in df.columns}
    prefix = "_"
    while any((prefix + n).lower() in have for n in names):
        prefix += "_"
    return [prefix + n for n in names]
