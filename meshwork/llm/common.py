"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import math
import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = str(Path(__file__).resolve().parents[2])
#: Bounds of a batch that goes to a Python worker: rows and bytes.
BATCH = (("spark.sql.execution.arrow.maxRecordsPerBatch", 2000), ("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20))

#: Bytes of a computed table that are worth a partition of their own.
PART_BYTES = 4 << 20

#: Types whose Python values Arrow takes as they are.
PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.StringType, T.BinaryType, T.DecimalType, T.DateType)


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor can see.

    It is the one named by ``spark.checkpoint.dir``. Only where the session has none and
    runs in one process (tests) a temporary folder is set; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="meshwork-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and cut its lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tight(df: DataFrame) -> DataFrame:
    """As ``cut``, but in no more partitions than its bytes are worth, one for each core at
    least: every task is a record that the driver keeps, and each step over a table costs as
    many as it has partitions. No row is touched.

    Spark's guess of the size stays out: a checkpoint hands it on, each join multiplies it, and
    after some steps it is a number of so many digits that it fills the driver's heap."""
    out, sc = cut(df), df.sparkSession.sparkContext
    rdd = out._jdf.queryExecution().analyzed().rdd()
    folder = sc._jvm.org.apache.hadoop.fs.Path(rdd.getCheckpointFile().get())
    size = folder.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    out = DataFrame(df.sparkSession._jsparkSession.internalCreateDataFrame(rdd, out._jdf.schema(), False), df.sparkSession)
    parts = max(sc.defaultParallelism, -(-size // PART_BYTES))
    if parts < rdd.getNumPartitions():
        out = out.coalesce(parts)
    out.cut_bytes = size
    return out


def dealt(df: DataFrame, *of: DataFrame) -> DataFrame:
    """``df`` in one partition for each core if ``of``, the results of ``tight`` that it is
    made of without a Python step, are small in all; others are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    small = sum(getattr(x, "cut_bytes", math.inf) for x in of) <= cores * PART_BYTES
    return df.coalesce(cores) if small else df


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path for a new table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where it lies, and
    keep the batches that they get small.

    On a cluster the library is installed on the executors or shipped with
    ``--py-files``; then the path changes nothing there. Batches are bounded in bytes,
    as texts differ in length; a session's own smaller bounds stay.
    """
    for name, most in BATCH:
        now = spark.conf.get(name)
        if not re.fullmatch(r"[1-9]\d*b?", now) or int(now.rstrip("b")) > most:
            spark.conf.set(name, str(most))
    own = spark.sparkContext.environment
    paths = [x for x in own.get("PYTHONPATH", "").split(os.pathsep) if x]
    if ROOT not in paths:
        own["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def few_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the driver's rows that comes to the executors as columns.

    Spark reads a list of rows by Python workers on the executors, a second set of them
    beside those of ``mapInArrow``. Times and nested values are left to Spark's own way."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T.StructType.fromDDL(schema)
    if not all(isinstance(f.dataType, PLAIN) for f in kind):
        return spark.createDataFrame(rows, kind)
    arrow = to_arrow_schema(kind)
    columns = zip(*rows, strict=True) if rows else [()] * len(arrow)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), kind)


def utf8(text: str | Column) -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col, F.lit("")).cast("binary")


def fold(doc_id: str | Column, folds: int = 4) -> Column:
    """crc32 of an id's decimal text modulo ``folds``; -1 for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def draw(key: str | Column) -> Column:
    """A number in [0, 1) that depends on a key alone."""
    return F.shiftrightunsigned(F.xxhash64(F.col(key) if isinstance(key, str) else key), 11) / F.lit(float(2**53))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, chosen by a hash of their key.

    A share of about rows / count is drawn where the rows lie, so only about ``rows``
    rows in all reach the final cut, whatever the number of partitions.
    """
    n = df.count()
    if n > rows:
        df = df.where(draw(key) < rows / n)
    return df.orderBy(F.xxhash64(key), *df.columns).limit(rows)
