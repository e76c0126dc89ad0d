"""Session helpers shared by all operators: table access, lineage cuts, size checks."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A frame is broadcast only if it was counted to have no more rows.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in spark.checkpoint.dir.

    Only on one machine (master local) may the setting be absent; then a temporary folder is made. Elsewhere
    each executor would write to its own disk, so its absence is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        found = os.path.join(tempfile.gettempdir(), f"cladeworks-{os.getuid()}-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


_CUTS: list[str] = []


def cut(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back.

    It cuts the lineage like a checkpoint, survives the loss of executors, and as a
    compressed columnar table takes less disk than checkpointed rows. release() deletes what was written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    _CUTS.append(path)
    w = df.write.option("compression", "zstd")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path  # type: ignore[attr-defined]
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in _CUTS:
        _CUTS.remove(path)


def drop_cut(df: DataFrame) -> None:
    """Delete the table behind a frame made by cut(); nothing may read it afterwards."""
    path = getattr(df, "_cut_path", None)
    if path:
        _delete(df.sparkSession, path)


def mark() -> int:
    """The place to give to release(), so that only tables written from here on are deleted."""
    return len(_CUTS)


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables cut() wrote since mark(); call it when the results that read them are written. Gives their number."""
    paths = _CUTS[since:]
    for path in paths:
        _delete(spark, path)
    return len(paths)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of df if, counted, it has at most `rows` rows; else leave the join to Spark.

    df is written once, so that counting it does not compute it twice.
    """
    kept = df if hasattr(df, "_cut_path") else cut(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def splits(df: DataFrame) -> int:
    """About how many file splits a scan gives, from Spark's estimate of its size; nothing is run."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    per = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return max(1, min(size // per, 1_000_000))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give CPU-heavy Python stages enough even tasks.

    Small inputs come as one or two file splits; they are hashed on `key` into twice as
    many parts as there are cores. Inputs with as many splits already stay unshuffled.
    """
    want = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if splits(df) >= want else df.repartition(want, key)
