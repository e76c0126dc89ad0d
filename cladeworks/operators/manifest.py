"""The manifest of genomes and the ledger of stages, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str, *order: str) -> DataFrame:
    """Full-row replace: rows of new displace rows of old with the same key; of several new ones the latest in order."""
    cols = old.columns
    rest = F.struct(*cols)
    last = new.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max_by(rest, F.struct(*order)).alias("_r")).select("_r.*")
    return old.join(last.select(key), key, "left_anti").select(*cols).unionByName(last)


def latest(log: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key in order; rows without a key are dropped."""
    rows = log.where(F.col(key).isNotNull())
    return rows.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*log.columns), F.struct(*order)).alias("_r")).select("_r.*")


def set_status(manifest: DataFrame, status: DataFrame) -> DataFrame:
    """manifest with derep_status and representative from status (accession, derep_status, representative).

    Keys that the manifest does not hold change nothing; rows without a new status keep theirs.
    """
    s = status.select("accession", F.col("derep_status").alias("_s"), F.col("representative").alias("_r"), F.lit(True).alias("_hit"))
    out = manifest.join(s, "accession", "left")
    return out.withColumns({
        "derep_status": F.when(F.col("_hit"), F.col("_s")).otherwise(F.col("derep_status")),
        "representative": F.when(F.col("_hit"), F.col("_r")).otherwise(F.col("representative")),
    }).select(*manifest.columns)


def ledger_status(ledger: DataFrame, chain: list[str], stage: str = "stage", done: str = "completed") -> DataFrame:
    """(ord, stage, completed, next): each stage of a chain with its last completion; next marks the first without one."""
    spark = ledger.sparkSession
    plan = spark.createDataFrame(list(enumerate(chain)), "ord int, stage string")
    last = ledger.groupBy(F.col(stage).alias("stage")).agg(F.max(done).alias("completed"))
    got = plan.join(last, "stage", "left")
    first = got.where("completed is null").agg(F.min("ord").alias("first"))
    return got.join(F.broadcast(first)).select("ord", "stage", "completed", F.coalesce(F.col("ord") == F.col("first"), F.lit(False)).alias("next"))


def stale_stages(ledger: DataFrame, chain: list[str], stage: str = "stage", done: str = "completed") -> DataFrame:
    """(stage, upstream): completed stages that an earlier stage of the chain was completed after."""
    s = ledger_status(ledger, chain, stage, done).where("completed is not null")
    u = s.select(F.col("ord").alias("uo"), F.col("stage").alias("upstream"), F.col("completed").alias("uc"))
    return s.join(F.broadcast(u), (F.col("uo") < F.col("ord")) & (F.col("uc") > F.col("completed"))).select("stage", "upstream")
