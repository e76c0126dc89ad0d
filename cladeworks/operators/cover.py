"""Choosing representatives: the greedy cover of a similarity graph by degree."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, drop_cut

#: Undecided edges, counted in both directions, that one task finishes.
FINISH_EDGES = 200_000


def degrees(members: DataFrame, edges: DataFrame) -> DataFrame:
    """(class_id, size, degree): neighbours of each record of a class, counted over records, not classes.

    members: (id, class_id); edges: (a, b) between classes. Copies are each other's neighbours.
    """
    sizes = members.groupBy("class_id").agg(F.count("*").alias("size"))
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    around = both.join(sizes.select(F.col("class_id").alias("b"), F.col("size").alias("s")), "b").groupBy(F.col("a").alias("class_id")).agg(F.sum("s").alias("s"))
    return sizes.join(around, "class_id", "left").select(
        "class_id", "size", (F.coalesce("s", F.lit(0)) + F.col("size") - 1).alias("degree")
    )


def _sequential(x: pd.DataFrame) -> pd.DataFrame:
    """The greedy rule one node after the other, over the few edges that are left."""
    near: dict = {}
    rank: dict = {}
    for u, v, r in zip(x["u"].tolist(), x["v"].tolist(), x["ru"].tolist()):
        near.setdefault(u, []).append(v)
        rank[u] = (r["d"], r["i"])
    reps: set = set()
    for u in sorted(near, key=rank.get):
        if not any(v in reps for v in near[u]):
            reps.add(u)
    return pd.DataFrame({"u": sorted(reps)})


def greedy_cover(nodes: DataFrame, edges: DataFrame, finish: int = FINISH_EDGES) -> DataFrame:
    """(id, rep): each node with its representative; a representative has itself.

    nodes: (id, degree); edges: (a, b), each pair once. In the order of falling degree and rising id a
    node becomes a representative unless a neighbour is one already; the others go to
    their first representative in that order. All nodes without an earlier undecided neighbour are
    decided at once, so the rounds follow the longest chain of falling order, not the nodes. Once at most `finish`
    directed edges are undecided, one task walks through them in order.
    """
    rank = F.struct((-F.col("degree")).alias("d"), F.col("id").alias("i"))
    ranked = nodes.select("id", rank.alias("rank"))
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = (
        e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        .join(ranked.select(F.col("id").alias("u"), F.col("rank").alias("ru")), "u")
        .join(ranked.select(F.col("id").alias("v"), F.col("rank").alias("rv")), "v")
    )
    whole = cut(both)
    live, reps = whole, None
    while (n := live.count()) > 0:
        # in `live` both ends are undecided, and no undecided node has a representative beside it
        if n <= finish:
            last = live.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(_sequential, f"u {nodes.schema['id'].dataType.simpleString()}")
            reps = last if reps is None else reps.unionByName(last)
            break
        fresh = cut(live.groupBy("u", "ru").agg(F.min("rv").alias("first")).where("first > ru").select("u"))
        reps = fresh if reps is None else reps.unionByName(fresh)
        covered = live.join(fresh.withColumnRenamed("u", "v"), "v", "left_semi").select("u")
        gone = cut(covered.unionByName(fresh).distinct())
        rest = cut(live.join(gone, "u", "left_anti").join(gone.withColumnRenamed("u", "v"), "v", "left_anti"))
        # nodes that lost all undecided neighbours without being covered are representatives
        lone = cut(live.select("u").distinct().join(gone, "u", "left_anti").join(rest.select("u").distinct(), "u", "left_anti"))
        reps = reps.unionByName(lone)
        if live is not whole:
            drop_cut(live)
        live = rest
    alone = nodes.select("id").join(whole.select(F.col("u").alias("id")).distinct(), "id", "left_anti")
    if reps is None:
        return alone.select("id", F.col("id").alias("rep"))
    reps = cut(reps.select(F.col("u").alias("id")))
    near = whole.join(reps.select(F.col("id").alias("v")), "v", "left_semi").groupBy(F.col("u").alias("id")).agg(F.min("rv").alias("r"))
    members = near.join(reps, "id", "left_anti").select("id", F.col("r")["i"].alias("rep"))
    return members.unionByName(reps.unionByName(alone).select("id", F.col("id").alias("rep")))


def expand_classes(cover: DataFrame, members: DataFrame) -> DataFrame:
    """(representative, member) over records from a cover of classes; a representative lists itself."""
    return members.join(cover.withColumnRenamed("id", "class_id"), "class_id").select(
        F.col("rep").alias("representative"), F.col("id").alias("member")
    )


def statuses(clusters: DataFrame, failed: DataFrame | None = None, everyone: DataFrame | None = None) -> DataFrame:
    """(genome, status) of every record: representative, contained or fail_qc.

    clusters: (representative, member); failed: (genome), which counts only where a record is not placed;
    everyone: (genome), of whom those nowhere placed and not failed are contained.
    """
    own = clusters.groupBy(F.col("member").alias("genome")).agg(F.max((F.col("representative") == F.col("member")).cast("int")).alias("r"))
    placed = own.unionByName(clusters.select(F.col("representative").alias("genome"), F.lit(1).alias("r")).distinct())
    placed = placed.groupBy("genome").agg(F.max("r").alias("r")).select(
        "genome", F.when(F.col("r") == 1, "representative").otherwise("contained").alias("status")
    )
    for more, status in ((failed, "fail_qc"), (everyone, "contained")):
        if more is not None:
            left = more.select("genome").where("genome is not null").distinct().join(placed, "genome", "left_anti")
            placed = placed.unionByName(left.select("genome", F.lit(status).alias("status")))
    return placed
