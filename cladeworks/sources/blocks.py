"""Alignment block files as rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import small

MAF = "block bigint, row int, src string, start bigint, size bigint, strand string, text string"
XMFA = "block bigint, genome string, p1 bigint, p2 bigint, sign string, text string"


def maf(spark: SparkSession, path) -> DataFrame:
    """One row per aligned sequence: block, row in the block, source, 0-based start, size, strand, text.

    Each block is read as one record, from its `a` line to the next, so files are split between blocks, whatever
    ends their lines and however many blank lines stand between them.
    """
    raw = spark.read.option("lineSep", "\na").text(path).withColumn("block", F.monotonically_increasing_id())
    lines = raw.select("block", F.posexplode(F.split("value", "\n")).alias("row", "line")).where(F.rlike("line", F.lit(r"^s\s")))
    p = F.split(F.trim("line"), r"\s+")
    return lines.select("block", "row", p.alias("p")).where(F.size("p") >= 7).select(
        "block", "row", F.col("p")[1].alias("src"), F.col("p")[2].cast("bigint").alias("start"), F.col("p")[3].cast("bigint").alias("size"), F.col("p")[4].alias("strand"), F.col("p")[6].alias("text")
    )


def maf_genomes(rows: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Adds genome: the source's entry in names (src, genome), else that of its part before the first dot, else that part."""
    short = F.substring_index("src", ".", 1)
    if names is None:
        return rows.withColumn("genome", short)
    named = small(names.select("src", "genome"))
    exact, cut = named.select("src", F.col("genome").alias("_g1")), named.select(F.col("src").alias("_short"), F.col("genome").alias("_g2"))
    out = rows.withColumn("_short", short).join(exact, "src", "left").join(cut, "_short", "left")
    return out.withColumn("genome", F.coalesce("_g1", "_g2", "_short")).drop("_g1", "_g2", "_short")


def parse_xmfa(text: str) -> list[tuple]:
    """Rows of one XMFA text; sequence numbers become the names its head gives them."""
    names, rows, block, now = {}, [], 0, None
    for line in text.splitlines():
        if line.startswith("#"):
            key, _, value = line[1:].partition("\t") if "\t" in line else line[1:].partition(" ")
            if key.startswith("Sequence") and key.endswith("File"):
                names[key[8:-4]] = value.strip()
        elif line.startswith(">"):
            num, _, span = line[1:].strip().partition(":")
            place, sign = span.split()[:2]
            p1, _, p2 = place.partition("-")
            now = [block, num.strip(), int(p1), int(p2), sign, []]
            rows.append(now)
        elif line.startswith("="):
            block, now = block + 1, None
        elif now is not None:
            now[5].append(line.strip())
    return [(b, names.get(n, n), p1, p2, s, "".join(t)) for b, n, p1, p2, s, t in rows]


def xmfa(spark: SparkSession, path) -> DataFrame:
    """One row per sequence of each block: block, genome, 1-based first and last place, sign, text."""
    whole = spark.read.text(path, wholetext=True)

    def run(batches):
        for b in batches:
            for t in b["value"]:
                yield pd.DataFrame(parse_xmfa(t), columns=["block", "genome", "p1", "p2", "sign", "text"])

    return whole.mapInPandas(run, XMFA)
