"""Sketches of records: hashed word shingles or k-mers below a bound."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import reverse_complement
from ..session import spread


#: Letters of scripts that put no spaces between words.
_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}&&\p{L}]"


def words(text: Column) -> Column:
    """Runs of letters, their marks and digits of any script, in lower case.

    In scripts written without spaces each letter with its marks is a word. Forms are taken as written:
    a full-width letter is another letter than its narrow one, a composed accent another than a combining one.
    """
    apart = F.regexp_replace(F.lower(text), rf"({_UNSPACED}\p{{M}}*)", " $1 ")
    return F.filter(F.split(F.regexp_replace(apart, r"[^\p{L}\p{M}\p{N}]+", " "), " "), lambda w: w != "")


def shingles(items: Column, size: int, sep: str) -> Column:
    """All runs of `size` neighbours of an array, joined; [] where there are fewer."""
    n = F.size(items) - size
    starts = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(items, i + 1, size), sep))


def kmers(seq: Column, k: int) -> Column:
    """All substrings of length k."""
    n = F.length(seq) - k
    starts = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(seq, i + 1, F.lit(k)))


def fraction_bound(scaled: int) -> str:
    """The hex prefix below which one hash in `scaled` lies."""
    return f"{min(0xFFFFFFFF, (1 << 32) // scaled):08x}"


def sketch(df: DataFrame, ident: str, items: Column, parts: Callable[[Column], Column], scaled: int = 1) -> DataFrame:
    """(id, h): the distinct hashes of each record's parts that fall below the bound.

    items: what a record is made of, worked out once per record; parts: the array of parts made from it.
    A hash is the first 15 hex digits of the part's md5. A record has the same sketch however it is
    split over rows. Null ids and parts give nothing.
    """
    made = spread(df.where(F.col(ident).isNotNull()).select(F.col(ident).alias("id"), items.alias("_items")), "id")
    rows = made.select("id", F.explode(parts(F.col("_items"))).alias("part")).select("id", F.substring(F.md5("part"), 1, 15).alias("h"))
    if scaled > 1:
        rows = rows.where(F.substring("h", 1, 8) < fraction_bound(scaled))
    return rows.select("id", F.conv("h", 16, 10).cast("bigint").alias("h")).where("h is not null").distinct()


def word_sketch(df: DataFrame, ident: str = "doc_id", text: str = "text", size: int = 5, scaled: int = 1) -> DataFrame:
    """Sketches of runs of `size` words."""
    return sketch(df, ident, words(F.col(text)), lambda w: shingles(w, size, " "), scaled)


def kmer_sketch(df: DataFrame, ident: str = "accession", seq: str = "seq", k: int = 31, scaled: int = 1000) -> DataFrame:
    """Sketches of DNA; a k-mer and its reverse complement count as one."""
    return sketch(df, ident, F.upper(seq), lambda s: F.transform(kmers(s, k), lambda x: F.least(x, reverse_complement(x))), scaled)
