"""Exact set-similarity join over sketches.

Records with equal sketches form one class first, so copies never meet in pairs. Classes are
compared through their prefixes: with hashes ordered from rare to frequent, sets of similarity
t share one of the first n - ceil(t n) + 1, so frequent hashes make no candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut


def classes(sketch: DataFrame) -> DataFrame:
    """(id, class_id, n): class_id is the least id with the same sketch, n the sketch's size.

    Sketches are told apart by their size and two sums of 64-bit hashes, combined before the shuffle.
    """
    own = sketch.groupBy("id").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(F.lit(1), "h")).alias("x"), F.bit_xor(F.xxhash64(F.lit(2), "h")).alias("y")
    )
    least = own.groupBy("n", "x", "y").agg(F.min("id").alias("class_id"))
    return own.join(least, ["n", "x", "y"]).select("id", "class_id", "n")


def class_edges(sketch: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(a, b, shared, na, nb, jaccard), a < b: all pairs of different classes of Jaccard similarity >= threshold."""
    heads = members.where("id = class_id").select("id", "n")
    sets = cut(sketch.join(heads, "id"))
    freq = sets.groupBy("h").agg(F.count("*").alias("f")).where("f > 1")
    order = W.partitionBy("id").orderBy("f", "h")
    # hashes no other class holds come first and fill the prefix, but make no candidates
    spare = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    common = sets.join(freq, "h").withColumn("k", F.row_number().over(order))
    alone = F.col("n") - F.count("*").over(W.partitionBy("id"))
    prefix = cut(common.withColumn("alone", alone).where(F.col("k") + F.col("alone") <= spare).select("h", "id", "n"))
    a = prefix.select("h", F.col("id").alias("a"), F.col("n").alias("na"))
    b = prefix.select("h", F.col("id").alias("b"), F.col("n").alias("nb"))
    near = F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - 1e-9
    pairs = a.join(b, "h").where("a < b").where(near).select("a", "b", "na", "nb").distinct()
    left = pairs.join(sets.select(F.col("id").alias("a"), "h"), "a")
    shared = left.join(sets.select(F.col("id").alias("b"), "h"), ["b", "h"]).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared"))
    return shared.withColumn("jaccard", F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).where(
        F.col("jaccard") >= threshold
    ).select("a", "b", "shared", "na", "nb", "jaccard")


def containment(edges: DataFrame) -> DataFrame:
    """Adds containment in a and in b, their maximum and average, and the Mash distance for k = 1."""
    ca, cb = F.col("shared") / F.col("na"), F.col("shared") / F.col("nb")
    return edges.withColumns({
        "in_a": ca, "in_b": cb, "max_containment": F.greatest(ca, cb), "average_containment": (ca + cb) / 2,
        "mash": -F.log(2 * F.col("jaccard") / (1 + F.col("jaccard"))),
    })


def edges_from_pairs(pairs: DataFrame, a: str, b: str, score: str, threshold: float, known: DataFrame | None = None) -> DataFrame:
    """(u, v) in both directions from a table of scored pairs.

    Pairs with equal or unknown ends, or a score that is no number or below the threshold, are dropped.
    known: (id).
    """
    e = pairs.select(F.col(a).alias("u"), F.col(b).alias("v"), F.col(score).try_cast("double").alias("s")).where(
        (F.col("u") != F.col("v")) & (F.col("s") >= threshold) & ~F.isnan("s")
    )
    if known is not None:
        e = e.join(known.select(F.col("id").alias("u")), "u", "left_semi").join(known.select(F.col("id").alias("v")), "v", "left_semi")
    return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
