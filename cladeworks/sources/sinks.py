"""Writers of trees, matrices, records, lists and versions, each a folder of one text file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines(df: DataFrame, path: str, column: str) -> None:
    """One value a line, in order; nulls are left out. For lists as short as a file of names."""
    df.select(F.col(column).cast("string").alias("value")).where("value is not null").orderBy("value").coalesce(1).write.mode("overwrite").text(path)


def newick(trees: DataFrame, path: str, column: str = "newick") -> None:
    """One tree a line."""
    trees.select(F.col(column).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def square(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per label with a column per label: a symmetric matrix of pairs (a, b, d), 0 on the diagonal.

    labels: (name). Its rows become columns, so it is for as many as a table bears.
    """
    heads = [str(r[0]) for r in labels.select("name").distinct().orderBy("name").collect()]
    p = pairs.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "d")
    both = p.unionByName(p.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    own = labels.select(F.col("name").cast("string").alias("a"), F.col("name").cast("string").alias("b"), F.lit(0).cast("bigint").alias("d")).distinct()
    wide = both.unionByName(own).groupBy(F.col("a").alias("name")).pivot("b", heads).agg(F.max("d"))
    return wide.orderBy("name")


def matrix(pairs: DataFrame, labels: DataFrame, path: str) -> None:
    """square() as a tab-separated table whose first head is empty."""
    w = square(pairs, labels)
    w.withColumnRenamed("name", " ").coalesce(1).write.mode("overwrite").options(sep="\t", header=True, ignoreLeadingWhiteSpace=True).csv(path)


def records(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.write.mode("overwrite").json(path)


def merged_versions(ledger: DataFrame) -> DataFrame:
    """(tool, version): what the stages of a ledger were run with; of several entries of a tool the last counts."""
    each = ledger.select("completed", F.explode(F.from_json("versions", "map<string,string>")).alias("tool", "version"))
    return each.groupBy("tool").agg(F.max_by("version", "completed").alias("version"))


def versions(ledger: DataFrame, path: str) -> None:
    """`tool: version` lines, sorted."""
    merged_versions(ledger).orderBy("tool").select(F.concat("tool", F.lit(": "), "version").alias("value")).coalesce(1).write.mode("overwrite").text(path)
