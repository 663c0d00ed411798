"""Session helpers shared by all operators: table access, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rows, and most bytes, a side may hold to be broadcast; beyond either the join is left to a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Tables of more bytes on disk are never dealt out anew.
SMALL_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Parquet table ``name`` of the directory ``sf_dir`` (a file or a folder of parts).

    ``spread``: for work that is heavy per row, a table of at most SMALL_BYTES on disk in fewer partitions than half the
    cores (one small file) is dealt out to all of them first; any larger table is read as it is. Rows are the same."""
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    few = spread and df.rdd.getNumPartitions() * 2 <= cores
    return df.repartition(cores) if few and bytes_on_disk(spark, path) <= SMALL_BYTES else df


def bytes_on_disk(spark: SparkSession, path: str) -> int:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the cluster's spark.checkpoint.dir; a local folder only where none is set and
    all executors are on this machine. Elsewhere a missing setting is an error: a folder of one machine is lost with it."""
    sc = spark.sparkContext
    if (now := sc.getCheckpointDir()) is not None:
        return now
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(configured or "file://" + os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and return it with its lineage cut; survives lost executors.
    Its files are removed when Python exits."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    try:
        atexit.register(_remove, df.sparkSession, out._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    except Exception:  # where the plan does not say, the folder's owner clears it
        pass
    return out


def written(df: DataFrame) -> DataFrame:
    """Like ``materialize``, as a Parquet table in the same folder: smaller, and read by column. Removed when Python exits."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session has ended; the folder's owner clears it
        pass


def _width(field: T.StructField) -> Column:
    """Bytes a value takes, about: the length of strings and binaries, that of the text form of nested ones, else 8."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return F.lit(8)


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is counted to at most ``rows`` rows and ``most`` bytes (no more than ``rows`` + 1 rows are looked at)."""
    width = F.lit(0)
    for field in df.schema.fields:
        width = width + _width(field)
    seen, size = df.limit(rows + 1).select(width.cast("long").alias("w")).agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0))).first()
    return seen <= rows and size <= most


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it ``fits_broadcast``; else unchanged, so the join shuffles. ``df`` should be
    materialized or cheap: it is counted here."""
    return F.broadcast(df) if fits_broadcast(df, rows, most) else df
