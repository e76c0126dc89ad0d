"""Selecting records: taxa, outgroups, lengths, tags, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import norm

LEVELS = ("family", "genus", "species")


def _same(a: Column, b) -> Column:
    b = F.lit(b)
    return F.lower(a) == F.translate(F.lower(b), "_", "-")


def resolve_target(rows: DataFrame, family: str | None = None, genus: str | None = None, species: str | None = None, order: str = "ord") -> DataFrame:
    """The lineage (family, genus, species) of the first row that fits the most specific target; one row or none."""
    if species and genus:
        fits = _same(F.col("species"), species) & _same(F.col("genus"), genus)
    elif genus:
        fits = _same(F.col("genus"), genus)
    elif family:
        fits = _same(F.col("family"), family)
    else:
        raise ValueError("a family, a genus, or a genus and a species must be named")
    return rows.where(fits).orderBy(order).limit(1).select(*LEVELS)


def select_taxon(rows: DataFrame, target: DataFrame, level: str, limit: int | None = None, order: str = "ord") -> DataFrame:
    """Rows whose lineage equals the target's down to `level`; with limit the first in order."""
    keys = list(LEVELS[: LEVELS.index(level) + 1])
    out = rows.join(F.broadcast(target.select(*keys).limit(1)), keys, "left_semi")
    return out if limit is None else out.orderBy(order).limit(limit)


def pick_outgroup(rows: DataFrame, target: DataFrame, level: str, selected: DataFrame, order: str = "ord", rep: Column | None = None) -> DataFrame:
    """The first representative outside the target taxon that shares the rank above it; one row or none."""
    k = LEVELS.index(level)
    above, own = list(LEVELS[:k]), LEVELS[k]
    t = F.broadcast(target.select(*above, F.col(own).alias("_own")).limit(1))
    near = rows.join(t, above) if above else rows.join(t)
    near = near.where((F.col(own) != F.col("_own")) & (F.trim(own) != "")).drop("_own")
    if rep is not None:
        near = near.where(rep)
    return near.join(selected.select("accession").distinct(), "accession", "left_anti").orderBy(order).limit(1)


def matches(targets: dict[str, list[str]], fields: list[str], any_custom: bool = False) -> Column:
    """Whether a record fits all levels: genus and species by equal names, serotype by a part of organism,
    custom by key:value (all of them, or any). Names are compared without case, blanks and hyphens."""
    if not targets:
        return F.lit(False)
    out = F.lit(True)
    for level, values in targets.items():
        want = [v.lower().replace("-", "").replace("_", "").replace(" ", "") for v in values]
        if level in ("genus", "species", "family"):
            ok = norm(F.coalesce(F.col(level), F.lit(""))).isin(want)
        elif level == "serotype":
            ok = F.lit(False)
            for v in want:
                ok = ok | F.contains(norm(F.coalesce("organism", F.lit(""))), F.lit(v))
        elif level == "custom":
            tests = []
            for v in values:
                key, colon, val = v.partition(":")
                if colon:
                    have = norm(F.coalesce(F.col(key.strip()).cast("string"), F.lit(""))) if key.strip() in fields else F.lit("")
                    tests.append(have == norm(F.lit(val)))
            ok = F.lit(not any_custom)
            for t in tests:
                ok = (ok | t) if any_custom else (ok & t)
        else:
            ok = F.lit(False)
        out = out & ok
    return out


def length_stats(df: DataFrame, key: str, length: str, description: str, order: str) -> DataFrame:
    """(key, num, seq_min, seq_max, seq_med, seq_mean, description): whole numbers cut off, first description in order."""
    d = df.where(F.col(length).isNotNull()).groupBy(key).agg(
        F.count("*").alias("num"), F.min(length).alias("seq_min"), F.max(length).alias("seq_max"),
        F.median(length).cast("bigint").alias("seq_med"), F.avg(length).cast("bigint").alias("seq_mean"),
        F.min_by(description, order).alias("description"),
    )
    return d


def length_band(df: DataFrame, key: str, length: str, deviation: float = 10.0, method: str = "median_of_medians") -> DataFrame:
    """One row (lo, hi): the middle length plus and minus deviation percent, whole numbers cut off.

    median_of_medians: the median of the keys' whole medians; mean_of_means: the mean of the keys' means;
    mean: the mean of all; all: least and greatest length.
    """
    rows = df.where(F.col(length).isNotNull())
    if method == "all":
        return rows.agg(F.min(length).cast("bigint").alias("lo"), F.max(length).cast("bigint").alias("hi"))
    if method == "mean":
        mid = rows.agg(F.avg(length).alias("mid"))
    elif method == "mean_of_means":
        mid = rows.groupBy(key).agg(F.avg(length).alias("m")).agg(F.avg("m").alias("mid"))
    elif method == "median_of_medians":
        mid = rows.groupBy(key).agg(F.median(length).cast("bigint").alias("m")).agg(F.median("m").alias("mid"))
    else:
        raise ValueError(f"no such method: {method}")
    return mid.select((F.col("mid") * (1 - deviation / 100)).cast("bigint").alias("lo"), (F.col("mid") * (1 + deviation / 100)).cast("bigint").alias("hi"))


def within(df: DataFrame, band: DataFrame, length: str) -> DataFrame:
    """Rows whose length lies in the closed band of one row (lo, hi); the band is read first and pushed down."""
    r = band.first()
    return df.where(F.col(length).between(r["lo"], r["hi"])) if r and r["lo"] is not None else df.limit(0)


def without_tags(df: DataFrame, text: str, tags: list[str]) -> DataFrame:
    """Rows whose text holds none of the tags, case counting; a null text holds none."""
    bad = F.lit(False)
    for t in tags:
        bad = bad | F.contains(F.coalesce(text, F.lit("")), F.lit(t))
    return df.where(~bad)


def capped(df: DataFrame, key: str, most: int, *order: str) -> DataFrame:
    """The first `most` rows of each key; the limit is applied before and after the shuffle."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def pool(df: DataFrame, kept: DataFrame, key: str, least: int) -> DataFrame:
    """Rows of keys that are not kept and have at least `least` rows."""
    free = df.join(kept.select(key).distinct(), key, "left_anti")
    big = free.groupBy(key).count().where(F.col("count") >= least).select(key)
    return free.join(big, key, "left_semi")


def name_dictionary(df: DataFrame, name: str, taxid: str, level: str, dataset: str, order: str) -> DataFrame:
    """(name, taxid, level, datasets): first taxid and level of each name and all its data sets in order."""
    return df.where(F.col(name).isNotNull()).groupBy(name).agg(
        F.min_by(taxid, order).alias("taxid"), F.min_by(level, order).alias("level"),
        F.sort_array(F.collect_set(dataset)).alias("datasets"),
    )


def segments(df: DataFrame, isolate: str, length: str, order: str, accession: str, seq: str) -> DataFrame:
    """(accession, n_segments, seq): sequences of one isolate joined, longest first; others as they are.

    Null and blank isolates and isolates of one record stay single. Ties go by order.
    """
    named = F.trim(F.coalesce(F.col(isolate), F.lit(""))) != ""
    part = F.struct((-F.col(length)).alias("l"), F.col(order).alias("o"), F.col(seq).alias("s"), F.col(accession).alias("a"))
    g = df.where(named).groupBy(F.col(isolate).alias("iso")).agg(F.sort_array(F.collect_list(part)).alias("p"))
    many = F.size("p") > 1
    from ..functions.text import isolate_token

    grouped = g.select(
        F.when(many, isolate_token(F.col("iso"))).otherwise(F.col("p")[0]["a"]).alias("accession"), F.size("p").alias("n_segments"),
        F.array_join(F.transform("p", lambda x: x["s"]), "").alias("seq"),
    )
    return grouped.unionByName(df.where(~named).select(F.col(accession).alias("accession"), F.lit(1).alias("n_segments"), F.col(seq).alias("seq")))


def reject_reasons(length: Column, completeness: Column, contamination: Column) -> Column:
    """Array of reasons to reject a genome; values that are no number pass."""
    n = [x.try_cast("double") for x in (length, completeness, contamination)]
    return F.array_compact(F.array(
        F.when(n[0] < 5000, "length"), F.when(n[1] < 75, "completeness"), F.when(~F.isnan(n[2]) & (n[2] > 25), "contamination")
    ))
