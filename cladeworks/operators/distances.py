"""Distances between vectors or groups, outgroups from distances, distributions of similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def centroids(df: DataFrame, label: str, vector: str, digits: int = 9) -> DataFrame:
    """(label, i, x): the mean vector of each label, by position."""
    long = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.posexplode(vector).alias("i", "x"))
    return long.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), digits).alias("x"))


def euclidean(points: DataFrame, digits: int = 6) -> DataFrame:
    """(a, b, d) of all ordered pairs of a few labelled points given as (label, i, x); a != b."""
    a, b = points.select(F.col("label").alias("a"), "i", F.col("x").alias("xa")), points.select(F.col("label").alias("b"), "i", F.col("x").alias("xb"))
    s = a.join(b, "i").where("a != b").groupBy("a", "b").agg(F.sum((F.col("xa") - F.col("xb")) ** 2).alias("s"))
    return s.select("a", "b", F.round(F.sqrt("s"), digits).alias("d"))


def outgroup_candidates(d: DataFrame) -> DataFrame:
    """(o, lo, hi, limit): each candidate's least and greatest distance to the kept records, and the least a good one has.

    d: (s, o, d), distances between kept records s and candidates o. The limit is the greater of mean minus
    sample deviation and median of all distances.
    """
    limit = d.agg(F.greatest(F.avg("d") - F.coalesce(F.stddev_samp("d"), F.lit(0.0)), F.median("d")).alias("limit"))
    return d.groupBy("o").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).join(F.broadcast(limit))


def outgroup(d: DataFrame) -> DataFrame:
    """One row (o, lo, hi): by falling greatest, then rising least distance the first whose least reaches the limit, else the first."""
    c = outgroup_candidates(d)
    return c.orderBy(F.col("lo") < F.col("limit"), F.desc("hi"), "lo", "o").limit(1).select("o", "lo", "hi")


def pair_kinds(d: DataFrame, kept: Column, digits: int = 6) -> DataFrame:
    """(kind, n, median, mean, stdev) of distances within kept, within others and across; d: (a, b, d), each pair once."""
    a, b = kept(F.col("a")), kept(F.col("b"))
    kind = F.when(a & b, "S-S").when(~a & ~b, "O-O").otherwise("S-O")
    return d.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("n"), F.round(F.median("d"), digits).alias("median"),
        F.round(F.avg("d"), digits).alias("mean"), F.round(F.stddev_samp("d"), digits).alias("stdev"),
    )


def _between(sims: DataFrame, low: float, high: float, weight: str | None) -> DataFrame:
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    return sims.where((F.col("a") != F.col("b")) & F.col("s").between(low, high)).select("s", w.alias("w"))


def overview(sims: DataFrame, low: float, high: float, bins: int = 100, weight: str | None = None) -> DataFrame:
    """(bin, n): histogram of the similarities between low and high, self pairs dropped; sims: a, b, s.

    weight: a column with the number of pairs a row stands for, else 1.
    """
    at = F.least(F.floor((F.col("s") - low) / ((high - low) / bins)), F.lit(bins - 1)).cast("int")
    return _between(sims, low, high, weight).groupBy(at.alias("bin")).agg(F.sum("w").alias("n"))


def five_numbers(sims: DataFrame, low: float, high: float, weight: str | None = None) -> DataFrame:
    """One row: number, least, quartiles and greatest of the similarities between low and high, self pairs dropped; weight as in overview."""
    q = {k: F.percentile("s", x, F.col("w")).alias(k) for k, x in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))}
    return _between(sims, low, high, weight).agg(F.coalesce(F.sum("w"), F.lit(0)).cast("bigint").alias("n"), F.min("s").alias("least"), *q.values(), F.max("s").alias("most"))
