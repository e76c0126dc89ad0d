"""Selecting viral genomes: by taxon and length, with segments joined or an outgroup chosen by distance."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import distances, select, sketch, viral
from ..session import cut
from .registry import InputError

#: How many kept records are compared with outgroup candidates, and how many candidates of a group.
KEPT, EACH, EACH_TAXID = 12, 3, 4


@dataclass
class Select:
    """targets: level -> wanted values. length_range: fixed bounds instead of those worked out."""

    targets: dict[str, list[str]] = field(default_factory=dict)
    any_custom: bool = False
    length_range: tuple[int, int] | None = None
    length_method: str = "median_of_medians"
    length_deviation: float = 10.0
    length_all: bool = False
    discard: list[str] = field(default_factory=list)
    group_segments: bool = False
    no_outgroup: bool = False
    min_genomes: int = 5
    ignore_duplicates: bool = False
    k: int = 21

    def __post_init__(self):
        if not any(self.targets.values()):
            raise InputError("a genus, species, serotype or custom target must be named")


@dataclass
class Selected:
    """genomes: (accession, filename, family, genus, species, seq); outgroup: the same columns, one row or none."""

    genomes: DataFrame
    outgroup: DataFrame | None


def unique_sequences(sequences: DataFrame, key: str, order: str, ignore_duplicates: bool) -> DataFrame:
    """Sequences with each key once: a repeated key is an error, or with ignore_duplicates its last row in order counts."""
    if not ignore_duplicates:
        twice = sequences.groupBy(key).count().where(F.col("count") > 1).limit(3).collect()
        if twice:
            raise InputError(f"ids occur more than once, such as {', '.join(str(r[0]) for r in twice)}; they can be ignored on demand")
    return sequences.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*sequences.columns), order).alias("x")).select("x.*")


def _bounds(rows: DataFrame, key: str, p: Select) -> tuple[int, int]:
    if p.length_range:
        return p.length_range
    r = select.length_band(rows.where("length > 0"), key, "length", p.length_deviation, "all" if p.length_all else p.length_method).first()
    if r is None or r["lo"] is None:
        raise InputError("no length to aim at; give a range")
    return r["lo"], r["hi"]


def mash_distances(kept: DataFrame, others: DataFrame, k: int) -> DataFrame:
    """(s, o, d): the Mash distance of each kept record from each candidate, 1 where they share nothing.

    Both: (accession, seq), drafts of a few records per group, so every pair is a row.
    """
    sk = {side: cut(sketch.kmer_sketch(df, "accession", "seq", k, 1)) for side, df in (("s", kept), ("o", others))}
    size = {side: x.groupBy(F.col("id").alias(side)).agg(F.count("*").alias(f"n{side}")) for side, x in sk.items()}
    both = sk["s"].withColumnRenamed("id", "s").join(sk["o"].withColumnRenamed("id", "o"), "h").groupBy("s", "o").agg(F.count("*").alias("n"))
    every = kept.select(F.col("accession").alias("s")).withColumn("_", F.lit(0)).join(others.select(F.col("accession").alias("o")).withColumn("_", F.lit(0)), "_").drop("_")
    j = every.join(both, ["s", "o"], "left").join(size["s"], "s", "left").join(size["o"], "o", "left")
    share = F.coalesce(F.col("n") / (F.col("ns") + F.col("no") - F.col("n")), F.lit(0.0))
    return j.select("s", "o", F.when(share > 0, -F.log(2 * share / (1 + share)) / k).otherwise(1.0).alias("d"))


def _chosen(kept: DataFrame, drafts: DataFrame, k: int) -> str | None:
    """The accession of the outgroup, by the distances of the drafts from some of the kept."""
    found = distances.outgroup(mash_distances(cut(kept), cut(drafts), k)).first()
    return found["o"] if found else None


def _named(rows: DataFrame) -> DataFrame:
    file = names.file_name(F.col("family"), F.col("genus"), F.col("species"), F.col("accession"))
    return rows.select("accession", file.alias("filename"), "family", "genus", "species", "seq")


def select_records(records: DataFrame, sequences: DataFrame, p: Select) -> Selected:
    """Genomes of the records that fit the targets.

    records: viral records with ord; sequences: ord, accession, description, seq. Without segments the kept lie in the band of
    lengths around the species of all that fit, have a sequence and no tag to discard. With segments lengths don't
    matter and the sequences of an isolate are joined. The outgroup is drawn from species that are not kept: of those with
    enough records up to three each, of like length as the band's middle, by distance from the first twelve kept.
    """
    records = cut(records)
    fits = cut(records.where(select.matches(p.targets, records.columns, p.any_custom)))
    if fits.isEmpty():
        raise InputError("no record has the taxa that are wanted")
    seqs = unique_sequences(sequences.where("accession is not null"), "accession", "ord", p.ignore_duplicates).select("accession", "description", "seq")
    if p.group_segments:
        kept = fits.join(seqs, "accession")
        joined = select.segments(kept, "isolate", "length", "ord", "accession", "seq")
        taxa = kept.select(F.explode(F.array("accession", text.isolate_token(F.col("isolate")))).alias("accession"), "ord", "family", "genus", "species")
        first = taxa.groupBy("accession").agg(F.min_by(F.struct("family", "genus", "species"), "ord").alias("t")).select("accession", "t.*")
        return Selected(_named(joined.join(first, "accession")), None)
    lo, hi = _bounds(fits, "species", p)
    kept = cut(select.without_tags(fits.where(F.col("length").between(lo, hi)).join(seqs, "accession"), "description", p.discard))
    if kept.isEmpty():
        raise InputError("no record has a length and a description that are wanted")
    if p.no_outgroup:
        return Selected(_named(kept), None)
    have = records.join(seqs, "accession")
    pool = cut(select.pool(have, kept, "species", p.min_genomes))
    mid = (lo + hi) / 2
    like = F.col("length").between(mid * 0.85, mid * 1.15)
    drafts = viral.outgroup_draft(pool, "species", "length", mid, 0.15, EACH, "ord")
    own = kept.where(like).orderBy("ord").limit(KEPT)
    chosen = _chosen(own.select("accession", "seq"), drafts.select("accession", "seq"), p.k)
    return Selected(_named(kept), _named(pool.where(F.col("accession") == chosen).limit(1)) if chosen else None)


def select_tagged(headers: DataFrame, base: DataFrame, lineages: DataFrame, p: Select) -> Selected:
    """Genomes of a FASTA table whose headers carry taxon ids.

    headers: ord, header, seq, of which functions.text.header_struct reads id and taxon id; base: lengths per taxid (taxid, num,
    seq_med); lineages: (taxid, level, level_name, level_taxid). A taxon fits if, for every wanted level, a row
    of that level has a wanted name or id. A genome's name is its id; a repeated one is an error unless ignored. Outgroup
    candidates are taxa that are not kept and have enough genomes, up to four genomes each within a tenth of their own median.
    """
    rows = cut(headers.select("ord", "header", "seq", text.header_struct(F.col("header")).alias("h")).select(
        "ord", "header", "seq", "h.taxid", F.col("h.name").alias("accession"), F.length("seq").alias("length")))
    taxa = rows.select("taxid").distinct()
    for level, values in p.targets.items():
        wanted = [v.strip().lower() for v in values]
        hit = lineages.where((F.lower("level") == level) & (F.lower("level_name").isin(wanted) | F.col("level_taxid").isin(wanted)))
        taxa = taxa.join(hit.select("taxid").distinct(), "taxid", "left_semi")
    fits = cut(rows.join(taxa, "taxid", "left_semi"))
    if fits.isEmpty():
        raise InputError("no sequence has the taxa that are wanted")
    if p.length_range:
        lo, hi = p.length_range
    else:
        known = base.join(taxa, "taxid", "left_semi").select("taxid", F.col("seq_med").cast("long").alias("length"))
        lo, hi = _bounds(known, "taxid", p)
    kept = cut(select.without_tags(fits.where(F.col("length").between(lo, hi)), "header", p.discard))
    if kept.isEmpty():
        raise InputError("no sequence has a length and a header that are wanted")
    parts = [F.lit("").alias(c) for c in ("family", "genus", "species")]

    def named(df: DataFrame) -> DataFrame:
        return df.select("accession", F.concat("accession", F.lit(".fasta")).alias("filename"), *parts, "seq")

    genomes = named(unique_sequences(kept, "accession", "ord", p.ignore_duplicates))
    if p.no_outgroup:
        return Selected(genomes, None)
    own = kept.select("taxid").distinct()
    others = base.where(F.col("num") >= p.min_genomes).join(own, "taxid", "left_anti").select("taxid", "seq_med")
    if others.isEmpty():
        raise InputError("no taxon outside the selection has enough genomes to be the outgroup")
    med = base.select("taxid", F.col("seq_med").alias("m"))
    near = rows.join(med, "taxid").where(F.col("length").between(F.col("m") * 0.9, F.col("m") * 1.1))
    near = cut(select.capped(near, "taxid", EACH_TAXID, "ord").dropDuplicates(["accession"]))
    chosen = _chosen(near.join(own, "taxid", "left_semi").select("accession", "seq"), near.join(others, "taxid", "left_semi").select("accession", "seq"), p.k)
    if chosen is None:
        raise InputError("no outgroup can be assigned; name one")
    return Selected(genomes, named(near.where(F.col("accession") == chosen).limit(1)))
