"""Choosing a varied subset: grid round-robin over several attributes, in SQL expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names
from ..operators.compose import positions
from ..session import cut, small, table

#: About how many rows of one cell one ranking task sees; larger cells are cut along the order, which changes no rank.
SLICE_ROWS = 100_000
KEY = ["family", "genus", "species"]


def spellings(genomes: DataFrame) -> DataFrame:
    """(f, g, s, family, genus, species): each way the three names are written, once, in canonical spelling.

    Ways with a null or blank name are left out.
    """
    # written, so that the filter on canonical names isn't pushed below distinct and worked out for every row
    raw = cut(genomes.select(*(F.col(c).alias(c[0]) for c in KEY)).dropna().distinct())
    return raw.select(
        "f", "g", "s", names.rank_name(F.col("f")).alias("family"), names.rank_name(F.col("g")).alias("genus"),
        names.species_name(F.col("s"), F.col("g")).alias("species"),
    ).dropna()


def placements(genomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (accession, cell), each genome in each cell any of its rows puts it in, and cells (cell, family, genus, species).

    Rows with a null or blank accession, family, genus or species give nothing; repeats count once.
    """
    spelled = cut(spellings(genomes))
    cells = cut(spelled.select(*KEY).distinct().withColumn("cell", F.monotonically_increasing_id()))
    ways = spelled.join(cells, KEY).select("f", "g", "s", "cell")
    rows = genomes.select(F.nullif(F.trim("accession"), F.lit("")).alias("accession"), *(F.col(c).alias(c[0]) for c in KEY)).dropna()
    return rows.join(small(ways), ["f", "g", "s"]).select("accession", "cell").distinct(), cells


def clean_targets(targets: DataFrame) -> DataFrame:
    """(target_id, scope_rank, scope_name, k), scope as the cells spell it; unusable targets are left out."""
    return targets.select(
        "target_id",
        F.lower(F.trim("scope_rank")).alias("scope_rank"),
        F.when(F.lower(F.trim("scope_rank")) == "all", F.lit(""))
        .otherwise(names.rank_name(F.col("scope_name"))).alias("scope_name"),
        F.col("subset_size").cast("long").alias("k"),
    ).where("target_id is not null and scope_name is not null and k > 0 and scope_rank in ('all', 'family', 'genus')")


def cell_order(cells: DataFrame) -> DataFrame:
    """Order cells so that a prefix of them covers families first, then genera, then species.

    A cell's place is (number of its species within the genus, number of its genus within the
    family), by hash order within the parent. cells: one row per (family, genus, species).
    """
    g = cells.select("family", "genus").distinct().withColumn(
        "g_no", F.row_number().over(W.partitionBy("family").orderBy(F.md5("genus"), "genus"))
    )
    s = cells.withColumn(
        "s_no", F.row_number().over(W.partitionBy("family", "genus").orderBy(F.md5("species"), "species"))
    )
    return s.join(g, ["family", "genus"])


def shares(scoped: DataFrame) -> DataFrame:
    """(target_id, r, left): the even share of each target and what is left of its k after every cell gave r or all it has.

    scoped: target_id, k, n. The share follows from how many cells there are of each size; a task sees one row for
    each size that occurs, and N records have fewer than sqrt(2 N) sizes.
    """
    of = W.partitionBy("target_id").orderBy("n")
    sizes = scoped.groupBy("target_id", "k", "n").agg(F.count("*").alias("c"))
    below = F.coalesce(F.sum(F.col("n") * F.col("c")).over(of.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("c").over(of.rowsBetween(W.currentRow, W.unboundedFollowing))
    sizes = sizes.withColumn("below", below).withColumn("rest", rest)
    # the least size that, given to all not smaller, exceeds k; r is the even share there
    over = F.col("below") + F.col("n") * F.col("rest") > F.col("k")
    share = F.floor((F.col("k") - F.col("below")) / F.col("rest"))
    r = sizes.groupBy("target_id").agg(
        F.coalesce(F.min_by(F.when(over, share), F.when(over, F.col("n"))), F.max("n")).alias("r"), F.max("k").alias("k"),
    )
    given = sizes.select("target_id", "n", "c").join(r, "target_id").groupBy("target_id", "r", "k").agg(F.sum(F.least("n", "r") * F.col("c")).alias("given"))
    return given.select("target_id", "r", (F.col("k") - F.col("given")).alias("left"))


def quotas(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """How many records of each cell the first k of the global order (rank, cell) holds.

    Taking records by rank and then by cell until k are there fills cells evenly: every cell
    gives r records or all it has, and the first few cells with more give one further. r
    follows from the cell sizes alone, so no record is sorted globally, and only the cells with
    more than r are put in order, by ranges.
    cells: cell, family, genus, species, n. Result: target_id, k, n_taxa, cell, quota.
    """
    scopes = cell_order(cells).select(
        "*",
        F.explode(F.array(
            F.struct(F.lit("all").alias("scope_rank"), F.lit("").alias("scope_name")),
            F.struct(F.lit("family").alias("scope_rank"), F.col("family").alias("scope_name")),
            F.struct(F.lit("genus").alias("scope_rank"), F.col("genus").alias("scope_name")),
        )).alias("scope"),
    ).select("*", "scope.*").drop("scope")
    # a taxon that two families hold counts once before it counts again
    taxon = W.partitionBy("target_id", "genus", "species").orderBy(F.desc("n"), "family")
    scoped = cut(scopes.join(targets, ["scope_rank", "scope_name"]).withColumn("again", F.row_number().over(taxon)))
    taxa = scoped.where("again = 1").groupBy("target_id").agg(F.count("*").alias("n_taxa"))
    each = scoped.join(small(shares(scoped).join(taxa, "target_id")), "target_id")
    more = each.where("n > r and left > 0").select("target_id", "left", "again", "s_no", "g_no", F.md5("family").alias("h"), *KEY, "cell")
    placed = positions(more, "target_id", "again", "s_no", "g_no", "h", *KEY)
    first = placed.groupBy("target_id").agg(F.min("pos").alias("first"))
    one = placed.join(small(first), "target_id").where("pos - first < left").select("target_id", "cell", F.lit(1).alias("one"))
    return each.join(one, ["target_id", "cell"], "left").select(
        "target_id", "k", "n_taxa", "cell", (F.least("n", "r") + F.coalesce("one", F.lit(0))).alias("quota")
    ).where("quota > 0")


def ranked(records: DataFrame, wanted: DataFrame, most: int) -> DataFrame:
    """Records (cell, accession) with pick_rank, their place in the order of md5 within the cell, as far as it is wanted.

    wanted: cell, n, most; most: the greatest of all. A cell of more than SLICE_ROWS records is cut into slices of
    consecutive md5 values by their leading bits; the ranks of a slice start where the counts of the
    slices before it end, so the order and the ranks are the same for any number of slices.
    """
    cells = cut(wanted.withColumn("slices", F.ceil(F.col("n") / SLICE_ROWS).cast("long")))
    lead = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    at = F.when(F.col("slices") > 1, F.floor(lead * F.col("slices") / (1 << 32)).cast("long")).otherwise(F.lit(0).cast("long"))
    sliced = records.join(small(cells), "cell").withColumn("h", F.md5("accession")).withColumn("slice", at)
    if cells.where("slices > 1").isEmpty():
        sliced = sliced.withColumn("start", F.lit(0).cast("long"))
    else:
        counts = sliced.where("slices > 1").groupBy("cell", "slice").agg(F.count("*").alias("c"))
        before = W.partitionBy("cell").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
        starts = counts.select("cell", "slice", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
        sliced = sliced.join(small(starts), ["cell", "slice"], "left").fillna(0, ["start"])
    w = W.partitionBy("cell", "slice").orderBy("h", "accession")
    top = sliced.where("start < most").withColumn("no", F.row_number().over(w)).where(F.col("no") <= most)
    return top.select("cell", "accession", (F.col("start") + F.col("no")).alias("pick_rank"))


def varied_subset(genomes: DataFrame, targets: DataFrame) -> DataFrame:
    """For each target, its subset: (target_id, subset_size, n_taxa, accession, family, genus, species, pick_rank).

    A cell is one (family, genus, species) in canonical spelling. Records are ranked within
    their cell by hash and taken by rank, then by cell, until subset_size are there or the
    scope ends. Null or blank names, targets and sizes give nothing; repeats count once; an
    empty table gives an empty result; further columns are ignored.
    """
    records, named = placements(genomes)
    records = cut(records)
    cells = cut(records.groupBy("cell").agg(F.count("*").alias("n")).join(named, "cell"))
    plan = cut(quotas(cells, clean_targets(targets)))
    wanted = cut(plan.groupBy("cell").agg(F.max("quota").alias("most")).join(cells.select("cell", "n"), "cell"))
    most = wanted.agg(F.max("most")).first()[0] or 0
    picks = ranked(records, wanted, most).join(small(plan.join(named, "cell")), "cell").where("pick_rank <= quota")
    return picks.select("target_id", F.col("k").alias("subset_size"), "n_taxa", "accession", *KEY, "pick_rank")


def p1_found(spark, sf_dir):
    """One row per taxon of each target whose size is at least the number of taxa in its scope."""
    chosen = varied_subset(table(spark, sf_dir, "genomes"), table(spark, sf_dir, "subset_targets"))
    return chosen.where("subset_size >= n_taxa").select("target_id", "genus", "species").distinct()


def p1_subset(spark, sf_dir):
    """The subsets themselves, for every target."""
    return varied_subset(table(spark, sf_dir, "genomes"), table(spark, sf_dir, "subset_targets"))
