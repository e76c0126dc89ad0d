"""From clusters of parts to clusters of the whole: chunks, composition, reduction, assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut


def positions(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """Adds the 0-based place in a global order without sorting everything in one task.

    Rows are range-partitioned by the order and numbered within each part; the parts' offsets come
    from their counts. The order must be total for a definite result.
    """
    part = cut(df.repartitionByRange(*(F.col(c) for c in order)).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_p")))
    counts = {r["_p"]: r["count"] for r in part.groupBy("_p").count().collect()}
    offsets, total = {}, 0
    for p in sorted(counts):
        offsets[p], total = total, total + counts[p]
    rows = df.sparkSession.createDataFrame(list(offsets.items()) or [(0, 0)], "_p int, _o bigint")
    local = F.row_number().over(W.partitionBy("_p").orderBy(*order))
    return part.withColumn("_n", local).join(F.broadcast(rows), "_p").withColumn(name, F.col("_o") + F.col("_n") - 1).drop("_p", "_n", "_o")


def before(df: DataFrame, value: str, *order: str, name: str = "at") -> DataFrame:
    """Adds the sum of `value` over all rows before, in a global order, without sorting everything in one task."""
    part = cut(df.repartitionByRange(*(F.col(c) for c in order)).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_p")))
    sums = {r["_p"]: r["s"] for r in part.groupBy("_p").agg(F.sum(value).cast("bigint").alias("s")).collect()}
    offsets, total = [], 0
    for p in sorted(sums):
        offsets.append((p, total))
        total += sums[p] or 0
    rows = df.sparkSession.createDataFrame(offsets or [(0, 0)], "_p int, _o bigint")
    local = F.coalesce(F.sum(value).over(W.partitionBy("_p").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return part.withColumn("_n", local).join(F.broadcast(rows), "_p").withColumn(name, (F.col("_o") + F.col("_n")).cast("bigint")).drop("_p", "_n", "_o")


def chunk_id(pos: Column, n: Column, size: int) -> Column:
    """Chunk of a place among n rows; a last row that would stand alone joins the chunk before."""
    alone = (n > size) & (pos == n - 1) & (n % size == (1 if size > 1 else 0))
    return (F.floor(pos / size) - F.when(alone, 1).otherwise(0)).cast("bigint")


def chunks(df: DataFrame, size: int, *order: str) -> DataFrame:
    """Adds chunk: consecutive rows in the given order, `size` at a time."""
    placed = positions(df, *order)
    n = placed.count()
    return placed.withColumn("chunk", chunk_id(F.col("pos"), F.lit(n), size))


def compose(stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """(representative, member) from clusters of parts and clusters of their representatives.

    Members follow their first representative to its second one; a representative without a second
    stage row stays. Nobody is lost. Both: (representative, member); self rows may be present.
    """
    up = stage2.where("representative != member").select(F.col("member").alias("r1"), F.col("representative").alias("r2"))
    up = up.groupBy("r1").agg(F.min("r2").alias("r2"))
    heads = stage1.select("representative", F.col("representative").alias("member"))
    rows = stage1.select("representative", "member").unionByName(heads).distinct()
    out = rows.join(up, rows.representative == up.r1, "left")
    return out.select(F.coalesce("r2", "representative").alias("representative"), "member").distinct()


def keepers(sizes: DataFrame, taxon: list[str]) -> DataFrame:
    """(taxon, name): per taxon the representative with most members, of equals the greatest name.

    sizes: name, members, taxon columns. A null or blank taxon forms no group: its rows stay.
    """
    full = None
    for t in taxon:
        c = F.coalesce(F.trim(t) != "", F.lit(False))
        full = c if full is None else full & c
    best = sizes.where(full).groupBy(*taxon).agg(F.max(F.struct("members", "name")).alias("k")).select(*taxon, F.col("k")["name"].alias("name"))
    return best.unionByName(sizes.where(~full).select(*taxon, "name"))


def reduce_by_taxon(clusters: DataFrame, taxa: DataFrame, taxon: list[str]) -> DataFrame:
    """(representative, member) with one representative per taxon, which takes over the others' members.

    clusters: (representative, member) with self rows; taxa: (name, taxon columns).
    """
    sizes = clusters.groupBy(F.col("representative").alias("name")).agg(F.sum((F.col("member") != F.col("representative")).cast("int")).alias("members"))
    sized = cut(sizes.join(taxa, "name", "left"))
    best = keepers(sized, taxon).withColumnRenamed("name", "keeper")
    full = best.where(" and ".join(f"trim({t}) != ''" for t in taxon))
    to = sized.join(full, taxon, "left").select(F.col("name").alias("representative"), F.coalesce("keeper", "name").alias("keeper"))
    return clusters.join(to, "representative").select(F.col("keeper").alias("representative"), "member")


def best_edges(edges: DataFrame, reps: DataFrame, score: float, cover: float | None = None) -> DataFrame:
    """(member, representative, score): the best representative of each non-representative.

    edges: a, b, score, ord and, with `cover`, aligned fractions fa and fb, of which the lesser counts.
    Either end may be the representative. The greatest score wins, of equals the first in ord.
    """
    good = edges.where(F.col("score") >= score)
    if cover is not None:
        good = good.where(F.least("fa", "fb") >= cover)
    both = good.select(F.col("a").alias("member"), F.col("b").alias("representative"), "score", "ord").unionByName(
        good.select(F.col("b").alias("member"), F.col("a").alias("representative"), "score", "ord")
    )
    r = reps.select(F.col("id").alias("representative")).distinct()
    cand = both.join(r, "representative", "left_semi").join(r.withColumnRenamed("representative", "member"), "member", "left_anti")
    best = cand.groupBy("member").agg(F.max(F.struct("score", (-F.col("ord")).alias("o"), "representative")).alias("k"))
    return best.select("member", F.col("k")["representative"].alias("representative"), F.col("k")["score"].alias("score"))


def status_matrix(everyone: DataFrame, stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """(genome, is_rep, s1, s2): each genome's status in both stages, NA where it has none."""
    a = stage1.select("genome", F.col("status").alias("s1"))
    b = stage2.select("genome", F.col("status").alias("s2"))
    out = everyone.select("genome").distinct().join(a, "genome", "left").join(b, "genome", "left").fillna("NA", ["s1", "s2"])
    return out.select("genome", ((F.col("s1") == "representative") & (F.col("s2").isin("representative", "NA"))).alias("is_rep"), "s1", "s2")


def two_parents(clusters: DataFrame) -> DataFrame:
    """(member, parents): members that stand under more than one representative; a sound table has none."""
    return clusters.where("member != representative").groupBy("member").agg(F.count_distinct("representative").alias("parents")).where("parents > 1")


def summary(clusters: DataFrame) -> DataFrame:
    """(representative, num_contained, contained): clusters with their other members in order."""
    other = F.when(F.col("member") != F.col("representative"), F.col("member"))
    return clusters.groupBy("representative").agg(
        F.count_distinct(other).alias("num_contained"), F.sort_array(F.collect_set(other)).alias("contained")
    )


def match_labels(labels: DataFrame, files: DataFrame) -> DataFrame:
    """(label, name): the file a label means, by its base name, else by its stem, else its base name as it is."""
    from ..functions.names import strip_suffix

    base = F.substring_index("label", "/", -1)
    exact = files.select(F.col("name").alias("_b"), F.col("name").alias("_n1")).distinct()
    stems = files.groupBy(strip_suffix(F.col("name")).alias("_s")).agg(F.min("name").alias("_n2"))
    out = labels.select("label").distinct().withColumn("_b", base).withColumn("_s", strip_suffix(base))
    return out.join(exact, "_b", "left").join(stems, "_s", "left").select("label", F.coalesce("_n1", "_n2", "_b").alias("name"))


def reused(stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """(representative, members): of each second-stage representative its children and their first-stage children, in order."""
    two = stage2.where("representative != member").select("representative", "member")
    one = stage1.where("representative != member").select(F.col("representative").alias("member"), F.col("member").alias("child"))
    under = two.join(one, "member").select("representative", F.col("child").alias("member"))
    own = two.select("representative").distinct().join(one.withColumnRenamed("member", "representative"), "representative").select("representative", F.col("child").alias("member"))
    everyone = two.unionByName(under).unionByName(own).where("member != representative")
    return everyone.groupBy("representative").agg(F.sort_array(F.collect_set("member")).alias("members"))
