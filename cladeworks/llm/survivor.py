"""Best representative of each duplicate group: one surviving record, field by field, by currency reasoning."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names
from ..session import cut, small, table

#: Field -> (least, most, whether the least itself is usable).
FIELDS = {
    "completeness": (0.0, 100.0, True),
    "contamination": (0.0, 100.0, True),
    "genome_length": (0.0, None, False),
    "n50": (0.0, None, False),
    "centrality": (0.0, 1.0, False),
}
#: The signs of a decimal number; it keeps out what a cast reads beyond those (nan, infinity, 1d, 0x1p3).
_SIGNS = r"^[\s0-9.eE+-]+$"
#: The stated order of the rows of a group: by trust of the source, time of assessment, and the least id.
STATED = ("trust", "assessed_at", "neg")


def number(text: Column) -> Column:
    """A finite decimal number, padding and exponent allowed; else null."""
    x = F.when(F.rlike(text, F.lit(_SIGNS)), text).try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def in_range(x: Column, field: str) -> Column:
    low, high, closed = FIELDS[field]
    ok = (x >= low) if closed else (x > low)
    return F.coalesce(ok if high is None else ok & (x <= high), F.lit(False))


def usable(text: Column, field: str) -> Column:
    return in_range(number(text), field)


def binned(x: Column, field: str) -> Column:
    """The class of a usable value in whose terms precedence is learned: twentieths of the range, or the number of binary digits."""
    high = FIELDS[field][1]
    if high is None:
        return F.length(F.bin(F.floor(F.least(x, F.lit(9e18))).cast("long"))).cast("long")
    return F.floor(x * (20 / high)).cast("long")


def current_rows(genomes: DataFrame) -> DataFrame:
    """(accession, contained, rep): the latest row of each accession; ties go to the later arrival, then row_id."""
    picked = genomes.where("accession is not null").select(
        "accession",
        F.struct(
            "updated_at", "ingested_at", "row_id",
            F.coalesce(F.lower(F.trim("derep_status")) == "contained", F.lit(False)).alias("contained"),
            names.accession_of(F.col("representative")).alias("rep"),
        ).alias("row"),
    )
    return picked.groupBy("accession").agg(F.max("row").alias("row")).select("accession", "row.contained", "row.rep")


def memberships(current: DataFrame) -> DataFrame:
    """(accession, representative): members of each group of a representative and at least one contained genome."""
    known = current.select(F.col("accession").alias("rep"))
    held = current.where("contained and rep is not null and rep != accession").join(known, "rep", "left_semi")
    pairs = held.select("accession", F.col("rep").alias("representative"))
    return pairs.unionByName(pairs.select(F.col("representative").alias("accession"), "representative").distinct())


def trusted(sources: DataFrame) -> DataFrame:
    """(source, trust) in one spelling; of repeated spellings the highest trust."""
    return sources.select(F.lower(F.trim("qc_source")).alias("source"), "trust").where("source is not null").groupBy(
        "source"
    ).agg(F.max("trust").alias("trust"))


def transitions(rows: DataFrame, entity: str, value: str, stamp: str, kind: str | None = None) -> DataFrame:
    """(kind, earlier, later, n): how often one value directly follows another within an entity, by time.

    kind tells apart values that have nothing to do with each other, such as those of different fields.
    Only dated rows with a value count. Time is cut into days; steps within a day come from a
    window over that day of one entity, steps between days from the days' first and last
    values, so the rows of a large entity never meet in one task.
    """
    dated = rows.select((F.col(kind) if kind else F.lit("")).alias("kind"), F.col(entity).alias("e"), F.col(value).alias("v"), F.col(stamp).alias("t"))
    dated = dated.dropna().distinct().withColumn("day", F.to_date("t"))
    inside = dated.withColumn("prev", F.lag("v").over(W.partitionBy("e", "kind", "day").orderBy("t", "v"))).where(
        "prev is not null"
    ).select("kind", "prev", "v")
    days = dated.groupBy("e", "kind", "day").agg(F.min(F.struct("t", "v"))["v"].alias("first"), F.max(F.struct("t", "v"))["v"].alias("last"))
    across = days.withColumn("prev", F.lag("last").over(W.partitionBy("e", "kind").orderBy("day"))).where(
        "prev is not null"
    ).select("kind", "prev", F.col("first").alias("v"))
    steps = inside.unionByName(across).where("prev != v")
    return steps.groupBy("kind", F.col("prev").alias("earlier"), F.col("v").alias("later")).agg(F.count("*").alias("n"))


def heights(edges: list[tuple]) -> dict:
    """Longest-path height of each value in a graph of (earlier, later); the values of a cycle are level.

    Cycles are condensed first (Tarjan, without recursion); a component is above all components before it.
    """
    before: dict = {}
    for u, v in edges:
        before.setdefault(u, [])
        before.setdefault(v, []).append(u)
    index, low, of, stack, out = {}, {}, set(), [], {}
    for root in sorted(before):
        work = [] if root in index else [(root, iter(before[root]))]
        if work:
            index[root] = low[root] = len(index)
            stack.append(root)
            of.add(root)
        while work:
            v, rest = work[-1]
            for u in rest:
                if u not in index:
                    index[u] = low[u] = len(index)
                    stack.append(u)
                    of.add(u)
                    work.append((u, iter(before[u])))
                    break
                if u in of:
                    low[v] = min(low[v], index[u])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[v])
                if low[v] == index[v]:
                    # components before this one are complete already
                    k = stack.index(v)
                    part, stack[k:] = stack[k:], []
                    of.difference_update(part)
                    h = max((out[u] + 1 for x in part for u in before[x] if u in out), default=0)
                    out.update(dict.fromkeys(part, h))
    return out


def precedence(steps: DataFrame) -> DataFrame:
    """(kind, v, height): height of each value; a value precedes another if it is followed by it more often than not.

    Cycles are condensed; the height is the longest chain of values below, so every value is above all it follows,
    directly or through others, and the values of a cycle are level. One task for each kind works it out from the
    net steps, one per pair of values; values are bins, so their number does not grow with the rows.
    """
    back = steps.select("kind", F.col("later").alias("earlier"), F.col("earlier").alias("later"), (-F.col("n")).alias("n"))
    net = steps.select("kind", "earlier", "later", "n").unionByName(back).groupBy("kind", "earlier", "later").agg(F.sum("n").alias("net"))
    type_ = steps.schema["earlier"].dataType.simpleString()

    def made(x: pd.DataFrame) -> pd.DataFrame:
        h = heights(list(zip(x["earlier"].tolist(), x["later"].tolist())))
        return pd.DataFrame({"kind": x["kind"].iloc[0], "v": list(h), "height": list(h.values())})

    return net.where("net > 0").groupBy("kind").applyInPandas(made, f"kind string, v {type_}, height long")


def learned_heights(rows: DataFrame) -> DataFrame:
    """(kind, v, height) of the bins of every field, learned from the dated rows with a usable value.

    rows: accession, assessed_at and the fields as numbers.
    """
    values = F.array(*(F.struct(F.lit(f).alias("kind"), F.when(in_range(F.col(f), f), binned(F.col(f), f)).alias("v")) for f in FIELDS))
    dated = rows.where("assessed_at is not null").select("accession", "assessed_at", F.inline(values))
    return precedence(transitions(dated, "accession", "v", "assessed_at", "kind"))


def survivors(info: DataFrame, members: DataFrame, sources: DataFrame, stated: tuple[str, ...] = STATED) -> DataFrame:
    """(representative, field_name, qc_id): the row that gives each field of each group's surviving record.

    For each field the rows of a group with a usable value form a partial order, and the topologically latest is
    taken. What `stated` names comes first: higher trust of the source, later assessment with undated rows below dated
    ones, and, if it ends in "neg", the smallest qc_id, which leaves nothing open. Without it, rows of equal
    trust and no time are ordered by currency: the value that follows others is later. Which value follows which is learned
    per field from dated rows of the same genomes; the heights of `precedence` are above those of all values before, so
    among the values of a group a greatest height is never followed by another of them. Rows that are level
    go to the smallest qc_id.
    Rows with a null or unknown genome or without a usable value give nothing; rows with null or unlisted sources rank
    last; groups without a usable value of a field have no row for it. Best rows are kept per genome first, so a
    genome or group with very many rows is combined before any shuffle.
    """
    rows = info.where("qc_id is not null").select(
        names.accession_of(F.col("genome")).alias("accession"),
        F.lower(F.trim("qc_source")).alias("source"), "assessed_at", (-F.col("qc_id")).alias("neg"),
        *(number(F.col(f)).alias(f) for f in FIELDS),
    ).where("accession is not null")
    heights_of = dict.fromkeys(FIELDS, F.lit(0).cast("long"))
    if "neg" not in stated:
        rows = cut(rows)
        order = cut(learned_heights(rows))
        for f in FIELDS:
            of = order.where(F.col("kind") == f).select(F.col("v").alias(f"{f}_v"), F.col("height").alias(f"{f}_h"))
            rows = rows.withColumn(f"{f}_v", F.when(F.col("assessed_at").isNull(), binned(F.col(f), f))).join(small(of), f"{f}_v", "left")
            heights_of[f] = F.when(F.col("assessed_at").isNull(), F.coalesce(f"{f}_h", F.lit(-1))).otherwise(0).cast("long")
    rows = rows.join(small(trusted(sources)), "source", "left")
    rows = rows.select("accession", *(F.when(in_range(F.col(f), f), F.struct(
        *(c for c in STATED if c in stated and c != "neg"), heights_of[f].alias("height"), "neg")).alias(f) for f in FIELDS))
    best = rows.where(" or ".join(f"{f} is not null" for f in FIELDS)).groupBy("accession").agg(*(F.max(f).alias(f) for f in FIELDS))
    grouped = best.join(members, "accession").groupBy("representative").agg(*(F.max(f).alias(f) for f in FIELDS))
    long = grouped.select("representative", F.inline(F.array(
        *(F.struct(F.lit(f).alias("field_name"), (-F.col(f)["neg"]).alias("qc_id")) for f in FIELDS)
    )))
    return long.where("qc_id is not null")


def _bound(spark, sf_dir, stated):
    members = memberships(current_rows(table(spark, sf_dir, "genomes")))
    return survivors(table(spark, sf_dir, "genome_information"), members, table(spark, sf_dir, "qc_sources"), stated)


def p4_found(spark, sf_dir):
    """The row that supplies each field of each group's record; the stated order decides down to the id."""
    return _bound(spark, sf_dir, STATED)


def p4_currency(spark, sf_dir):
    """The same with undated rows of equal trust ordered by the learned precedence of their values."""
    return _bound(spark, sf_dir, ("trust", "assessed_at"))
