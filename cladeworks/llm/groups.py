"""Consolidating pairwise matches into groups: connected components by randomised contraction."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..session import cut, drop_cut, table


def _order_hash(x: Column, round_no: int, seed: int) -> Column:
    """A keyed one-to-one map of 64-bit integers, with a fresh key for each round.

    For one 8-byte value XXH64 is a chain of steps that can each be undone (multiplication by odd numbers, rotation,
    xor with a shift of itself), whatever its key; so hashes of different vertices differ and can serve as the
    vertices' names in the next round. The key goes through multiplications, so the orders of two rounds
    have nothing in common that a graph could be built around.
    """
    return F.xxhash64(F.lit(random.Random(f"{seed}-{round_no}").getrandbits(63)), x)


def hooks(edges: DataFrame, round_no: int, seed: int) -> DataFrame:
    """(v, r): each vertex with the least hash among itself and its neighbours."""
    a, b = F.col("a"), F.col("b")
    ha, hb = _order_hash(a, round_no, seed), _order_hash(b, round_no, seed)
    both = edges.select(ha.alias("ha"), hb.alias("hb"), "a", "b").select(
        F.least("ha", "hb").alias("m"), F.explode(F.array("a", "b")).alias("v")
    )
    return both.groupBy("v").agg(F.min("m").alias("r"))


def contract(edges: DataFrame, seed: int = 0) -> list[DataFrame]:
    """The mappings (v, r) of all rounds; edges: (a, b) BIGINT, a != b, repeats allowed.

    Each round hooks every vertex to the least hash in its closed neighbourhood, renames both
    ends of every edge, drops loops and repeats. Under a random order at least a quarter of the
    vertices of each component are expected to vanish in a round, whatever its shape; tests measure the rounds
    on paths, stars and grids. Vertices without a remaining edge are done. Large vertices are split by the skew join of adaptive execution;
    minima are combined before the shuffle.
    """
    maps, round_no = [], 0
    while True:
        mapping = cut(hooks(edges, round_no, seed))
        step = (
            edges.join(mapping.withColumnsRenamed({"v": "a", "r": "ra"}), "a")
            .join(mapping.withColumnsRenamed({"v": "b", "r": "rb"}), "b")
            .where("ra != rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        after = cut(step)
        drop_cut(edges)
        maps.append(mapping)
        edges, round_no = after, round_no + 1
        if edges.isEmpty():
            drop_cut(edges)
            return maps


def expand(maps: list[DataFrame]) -> DataFrame:
    """(v, level, r): for each vertex of the first round its component's last name and the round that made it."""
    out = maps[-1].select("v", F.lit(len(maps)).alias("level"), "r")
    for k in range(len(maps) - 1, 0, -1):
        later = out.select(F.col("v").alias("r"), "level", F.col("r").alias("last"))
        out = maps[k - 1].join(later, "r", "left").select(
            "v", F.coalesce("level", F.lit(k)).alias("level"), F.coalesce("last", "r").alias("r")
        )
        if k % 4 == 0:
            out = cut(out)
    return out


def keyed(vertices: DataFrame, tries: int = 8) -> tuple[DataFrame, int]:
    """vertices (name) with distinct 64-bit ids; the hash seed is changed until no two names share one."""
    for seed in range(tries):
        ids = cut(vertices.select(F.xxhash64(F.lit(seed), "name").alias("id"), "name").repartition("id").distinct())
        if ids.groupBy("id").count().where("count > 1").isEmpty():
            return ids, seed
        drop_cut(ids)
    raise ValueError("no seed gives distinct ids")


def groups(links: DataFrame, vertices: DataFrame) -> DataFrame:
    """(group_key, name): each vertex of a group of two or more; group_key is its least name.

    links: (x, y) names; a link with an end that is null or not among the vertices, or with
    equal ends, joins nothing. vertices: (name); nulls and repeats do not matter.
    Empty tables give an empty result.
    """
    ids, seed = keyed(vertices.select("name").where("name is not null").distinct())
    known = ids.select("name")
    edges = (
        links.where("x != y")
        .join(known.withColumnRenamed("name", "y"), "y", "left_semi")
        .join(known.withColumnRenamed("name", "x"), "x", "left_semi")
        .select(F.xxhash64(F.lit(seed), "x").alias("a"), F.xxhash64(F.lit(seed), "y").alias("b"))
        .distinct()
    )
    maps = contract(cut(edges), seed)
    ends = cut(expand(maps).join(ids.withColumnRenamed("id", "v"), "v").select("level", "r", "name"))
    keys = ends.groupBy("level", "r").agg(F.min("name").alias("group_key"))
    return ends.join(keys, ["level", "r"]).select("group_key", "name")


def genome_links(genomes: DataFrame, clusters: DataFrame) -> DataFrame:
    """(x, y): accessions linked by a row of genomes or of derep_clusters, not yet checked to exist."""
    own = genomes.select(F.col("accession").alias("x"), names.accession_of(F.col("representative")).alias("y"))
    rows = clusters.select(
        names.accession_of(F.col("representative")).alias("x"), names.accession_of(F.col("member")).alias("y")
    )
    return own.unionByName(rows)


def p2_found(spark, sf_dir):
    """(group_key, accession) of every genome in a group of two or more."""
    genomes = table(spark, sf_dir, "genomes")
    links = genome_links(genomes, table(spark, sf_dir, "derep_clusters"))
    return groups(links, genomes.select(F.col("accession").alias("name"))).withColumnRenamed("name", "accession")
