"""FASTA files as tables, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import SUFFIXES, stem
from ..functions.text import wrap


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name) of sequence files right under a folder, hidden ones aside, sorted; an absent folder has none."""
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.format("binaryFile").load(folder).select("path")
    except AnalysisException:
        return spark.createDataFrame([], "path string, name string")
    ends = F.lit(False)
    name = F.substring_index("path", "/", -1)
    for s in SUFFIXES:
        ends = ends | F.endswith(name, F.lit(s))
    return found.select("path", name.alias("name")).where(ends & ~F.startswith("name", F.lit("."))).orderBy("path")


def records(spark: SparkSession, path) -> DataFrame:
    """(file, header, name, seq): one row per record; a '>' inside a header does not start another."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    body = F.regexp_replace(F.regexp_replace("value", "^>", ""), "\r", "")
    head = F.substring_index(body, "\n", 1)
    seq = F.regexp_replace(F.substring(body, F.length(head) + 2, F.length(body)), r"\s+", "")
    rows = raw.select("file", head.alias("header"), seq.alias("seq")).where("header != ''")
    return rows.select("file", "header", F.split_part("header", F.lit(" "), F.lit(1)).alias("name"), "seq")


def checked(rows: DataFrame) -> DataFrame:
    """The same rows; a record without a sequence is an error when read."""
    bad = F.length("seq") == 0
    return rows.withColumn("seq", F.when(bad, F.raise_error(F.concat(F.lit("no sequence: "), "header"))).otherwise(F.col("seq")))


def whole(rows: DataFrame) -> DataFrame:
    """(genome, seq): the contigs of each file joined in order of their headers' places in the file."""
    numbered = rows.withColumn("_o", F.monotonically_increasing_id())
    parts = numbered.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("_o", "seq"))).alias("p"))
    return parts.select(stem(F.col("file")).alias("genome"), F.array_join(F.transform("p", lambda x: x["seq"]), "").alias("seq"))


def contig_map(rows: DataFrame) -> DataFrame:
    """(contig, genome): which genome file each sequence name stands in."""
    return rows.select(F.col("name").alias("contig"), stem(F.col("file")).alias("genome")).distinct()


def write(df: DataFrame, path: str, name: str = "name", seq: str = "seq", width: int = 80) -> None:
    """One FASTA text table with lines of `width`."""
    df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), wrap(F.col(seq), width)).alias("value")).write.mode("overwrite").text(path)
