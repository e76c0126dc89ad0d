"""Viral records: reading, lineages, lengths per taxon, isolates, outgroup drafts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import classify
from . import nested
from .nested import _L, _R, parent


def virus_records(nodes: DataFrame) -> DataFrame:
    """(id, record_pos, accession, taxid, organism, family, genus, species, length, completeness, segment, isolate).

    nodes: of nested.report_nodes, after cut(). Lineage names are read in order; absent values are '' or 0, the segment ANONYMOUS.
    """
    base = nested.records(nodes)

    def leaf(k):
        return F.coalesce(F.col("leaves")[k], F.lit(""))

    more = nodes.where(F.col("path") == _R).select(
        "row", F.col("dewey").alias("record"), leaf("accession").alias("accession"), leaf("virus.organism_name").alias("organism"),
        F.coalesce(F.col("leaves")["length"].try_cast("bigint"), F.lit(0)).alias("length"), F.upper(leaf("completeness")).alias("completeness"),
    )
    names = nodes.where(F.col("path") == _L).select("row", parent(F.col("dewey"), 2).alias("record"), F.struct(F.col("dewey")[4].alias("i"), F.col("leaves")["name"].alias("n")).alias("e"))
    names = names.where("e.n != ''").groupBy("row", "record").agg(F.sort_array(F.collect_list("e")).alias("e")).select("row", "record", F.transform("e", lambda x: x["n"]).alias("lineage"))
    out = base.join(more, ["row", "record"]).join(names, ["row", "record"], "left")
    return out.select("*", classify(F.col("lineage"), F.col("organism")).alias("c")).select(
        "id", "record_pos", "accession", "taxid", "organism", "c.family", "c.genus", "c.species", "length", "completeness", "segment", "isolate"
    )


def lineage_entries(nodes: DataFrame) -> DataFrame:
    """(id, record_pos, pos, name, taxid, rank) of every named lineage entry."""
    d = F.col("dewey")
    return nodes.where(F.col("path") == _L).select(
        "id", d[1].alias("record_pos"), d[4].alias("pos"), F.col("leaves")["name"].alias("name"), F.col("leaves")["tax_id"].alias("taxid"), F.col("leaves")["rank"].alias("rank")
    ).where("name != ''")


def wide_lineage(entries: DataFrame, key: list[str], ranks: list[str]) -> DataFrame:
    """One row per key with a name and an id column per rank, '' where there is none; of repeated ranks the least name counts."""
    best = entries.where(F.col("rank").isin(ranks)).groupBy(*key, "rank").agg(F.min(F.struct("name", "taxid")).alias("x"))
    wide = best.groupBy(*key).pivot("rank", ranks).agg(F.first("x"))
    cols = [F.coalesce(F.col(r)["name"], F.lit("")).alias(r) for r in ranks] + [F.coalesce(F.col(r)["taxid"], F.lit("")).alias(f"{r}_taxid") for r in ranks]
    return wide.select(*key, *cols)


def rank_summary(entries: DataFrame) -> DataFrame:
    """(rank, name, n, with_id): how often each name of each rank occurs, and with an id."""
    return entries.where("rank is not null").groupBy("rank", "name").agg(F.count("*").alias("n"), F.count("taxid").alias("with_id"))


def near_median(df: DataFrame, key: str, length: str, share: float) -> DataFrame:
    """Rows whose length lies within `share` of their key's whole median."""
    med = df.where(F.col(length) > 0).groupBy(key).agg(F.median(length).cast("bigint").alias("_m"))
    return df.join(med, key).where(F.col(length).between(F.col("_m") * (1 - share), F.col("_m") * (1 + share))).drop("_m")


def outgroup_draft(pool: DataFrame, species: str, length: str, mid: float, share: float = 0.15, each: int = 3, order: str = "accession") -> DataFrame:
    """Up to `each` records per species whose length is within `share` of `mid`, in order."""
    fits = pool.where(F.col(length).between(mid * (1 - share), mid * (1 + share)))
    return fits.withColumn("_n", F.row_number().over(W.partitionBy(species).orderBy(order))).where(F.col("_n") <= each).drop("_n")


def resolve_aliases(wanted: DataFrame, taxa: DataFrame) -> DataFrame:
    """(wanted, taxid): the requested id a taxon answers to, its own or one of its aliases; taxa: taxid, aka array."""
    names = taxa.select("taxid", F.explode(F.array_union(F.array("taxid"), F.coalesce("aka", F.array().cast("array<string>")))).alias("wanted"))
    return wanted.select("wanted").distinct().join(names, "wanted", "left").groupBy("wanted").agg(F.min("taxid").alias("taxid"))


def fetch_missing(ids: DataFrame, fetch: Callable[[list[str]], list[dict]], schema: str, key: str = "taxid", size: int = 100, attempts: int = 3) -> DataFrame:
    """Rows that `fetch` gives for ids (key), asked in batches of `size`, the missing ones again up to `attempts` times."""
    from ..session import cut

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), size):
                got = fetch(b[key].iloc[k : k + size].tolist())
                if got:
                    yield pd.DataFrame(got)

    left, out = ids.select(key).distinct(), None
    for _ in range(attempts):
        got = cut(left.mapInPandas(run, schema))
        out = got if out is None else out.unionByName(got)
        left = cut(left.join(got.select(key).distinct(), key, "left_anti"))
        if left.isEmpty():
            break
    return out


def file_of(accession: DataFrame, files: DataFrame) -> DataFrame:
    """(accession, name): the first file by name that carries the accession; exact by the naming contract, so an equi-join."""
    from ..functions.names import accession_of

    own = files.select("name", accession_of(F.col("name")).alias("accession"))
    return accession.select("accession").distinct().join(own, "accession").groupBy("accession").agg(F.min("name").alias("name"))
