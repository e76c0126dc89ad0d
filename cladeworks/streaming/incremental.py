"""Arriving records against the representatives there are: an extension with Structured Streaming.

Each micro-batch is sketched and compared with the sketches of the present representatives;
records close to one become its members, the rest are covered among themselves and add
representatives. State lives in tables written per batch, so a replayed batch replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sketch
from ..plans.dereplicate import cover_sketch
from ..session import cut


def _read(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema + ", batch bigint").parquet(path).where(F.col("batch") < before).drop("batch")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def assign(sk: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """(member, representative): ids of sk within the threshold of a representative, the most similar one, of equals the least.

    sk, reps: (id, h). Only pairs of a new record with a representative are made.
    """
    n1 = sk.groupBy("id").agg(F.count("*").alias("n1"))
    n2 = reps.groupBy("id").agg(F.count("*").alias("n2"))
    shared = sk.join(reps.withColumnRenamed("id", "rep"), "h").groupBy("id", "rep").agg(F.count("*").alias("s"))
    j = shared.join(n1, "id").join(n2.withColumnRenamed("id", "rep"), "rep").withColumn("j", F.col("s") / (F.col("n1") + F.col("n2") - F.col("s")))
    best = j.where(F.col("j") >= threshold).groupBy("id").agg(F.max(F.struct("j", (-F.col("rep")).alias("r"))).alias("b"))
    return best.select(F.col("id").alias("member"), (-F.col("b")["r"]).alias("representative"))


def absorb(batch: DataFrame, number: int, state: str, ident: str, text: str, threshold: float = 0.8) -> None:
    """Add one batch to the tables clusters and sketches under `state`."""
    spark = batch.sparkSession
    sk = cut(sketch.word_sketch(batch, ident, text))
    reps = _read(spark, f"{state}/sketches", "id bigint, h bigint", number)
    known = _read(spark, f"{state}/clusters", "representative bigint, member bigint", number).select(F.col("member").alias("id"))
    sk = cut(sk.join(known, "id", "left_anti"))
    near = cut(assign(sk, reps, threshold))
    rest = cut(sk.join(near.select(F.col("member").alias("id")), "id", "left_anti"))
    everyone = batch.select(F.col(ident).cast("bigint").alias("id")).where("id is not null").distinct().join(known, "id", "left_anti")
    others = cut(cover_sketch(rest, everyone.join(near.select(F.col("member").alias("id")), "id", "left_anti"), threshold))
    rows = near.select("representative", "member").unionByName(others).withColumn("batch", F.lit(number).cast("bigint"))
    fresh = rest.join(others.where("representative = member").select(F.col("member").alias("id")), "id", "left_semi")
    for name, df in (("clusters", rows), ("sketches", fresh.withColumn("batch", F.lit(number).cast("bigint")))):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{state}/{name}")


def start(stream: DataFrame, state: str, ident: str = "doc_id", text: str = "text", threshold: float = 0.8, **trigger):
    """Run absorb on every micro-batch of a stream; returns the running query."""
    def each(batch: DataFrame, number: int) -> None:
        absorb(batch, number, state, ident, text, threshold)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{state}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


__all__ = ["absorb", "assign", "start"]
