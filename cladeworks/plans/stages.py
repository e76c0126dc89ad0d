"""The stages from a taxonomy table to a taxonomy of representatives, as functions over the tables of a work folder.

Each takes a Context and its parameters, reads the tables the stages before it wrote and writes its own;
`run` chains them through the ledger, so a stage whose parameters have not changed is not run again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..operators import alignment, compose, cover, manifest, select, similarity, sketch, trees
from ..session import cut, small
from ..sources import sinks, tables
from . import dereplicate
from .pipeline import Context, run_stage
from .registry import InputError, tree_builders

#: Columns of the manifest and the version of their layout.
MANIFEST = "accession string, filename string, family string, genus string, species string, is_outgroup boolean, derep_status string, representative string"
SCHEMA_VERSION = 1


def one_of(value: str, choices: tuple[str, ...], what: str) -> str:
    if value not in choices:
        raise InputError(f"{what} is one of {', '.join(choices)}, not {value!r}")
    return value


def release_name(value: str) -> str:
    """A release as two numbers with a point."""
    if not re.fullmatch(r"[0-9]+[.][0-9]+", value):
        raise InputError(f"a release is written like 214.1, not {value!r}")
    return value


def open_manifest(ctx: Context) -> DataFrame:
    """The manifest of a work folder; an absent one is empty, one without a version is taken over, a newer one is refused."""
    try:
        df = ctx.read("manifest")
    except InputError:
        return ctx.spark.createDataFrame([], MANIFEST)
    if "schema_version" in df.columns:
        newest = df.agg(F.max("schema_version")).first()[0] or SCHEMA_VERSION
        if newest > SCHEMA_VERSION:
            raise InputError(f"the manifest has layout {newest}; this version reads up to {SCHEMA_VERSION}")
    have = {c.split(" ")[0]: c.split(" ")[1] for c in MANIFEST.split(", ")}
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in have.items()))


def save_manifest(ctx: Context, df: DataFrame) -> DataFrame:
    return ctx.write("manifest", cut(df.withColumn("schema_version", F.lit(SCHEMA_VERSION)))).drop("schema_version")


def manifest_rows(taxa: DataFrame, outgroup: bool = False) -> DataFrame:
    """Rows of a taxonomy table (accession, family, genus, species) as manifest rows."""
    name = names.file_name(*(F.coalesce(c, F.lit("")) for c in ("family", "genus", "species")), F.col("accession"))
    return taxa.select(
        "accession", name.alias("filename"), "family", "genus", "species", F.lit(outgroup).alias("is_outgroup"),
        F.lit(None).cast("string").alias("derep_status"), F.lit(None).cast("string").alias("representative"),
    )


@dataclass
class Metadata:
    """Which records are taken: a taxon, all of it or its representatives, and an outgroup."""

    level: str
    family: str | None = None
    genus: str | None = None
    species: str | None = None
    dataset: str = "all"
    outgroup: str | None = None
    no_outgroup: bool = False
    limit: int | None = None

    def __post_init__(self):
        one_of(self.level, select.LEVELS, "a level")
        one_of(self.dataset, ("all", "rep"), "a dataset")
        if not getattr(self, self.level):
            raise InputError(f"level {self.level} needs a {self.level} as target")
        if self.level == "species" and not self.genus:
            raise InputError("a species needs its genus")


def metadata(ctx: Context, p: Metadata) -> None:
    """From the table taxa (ord, accession, family, genus, species, is_rep) to manifest, selection and outgroup_accession.

    dataset rep keeps representatives and the outgroup that is named. Without a named outgroup the first representative
    outside the taxon that shares the rank above it is taken.
    """
    rows = ctx.read("taxa", "It is the taxonomy to select from.").where("accession is not null")
    target = cut(select.resolve_target(rows, p.family, p.genus, p.species))
    if target.isEmpty():
        raise InputError(f"no record has the target {p.family or ''} {p.genus or ''} {p.species or ''}".rstrip())
    inside = cut(select.select_taxon(rows, target, p.level))
    kept = inside.where("is_rep") if p.dataset == "rep" else inside
    kept = cut(kept if p.limit is None else kept.orderBy("ord").limit(p.limit))
    out = rows.limit(0)
    if p.outgroup:
        out = rows.where(F.col("accession") == p.outgroup).orderBy("ord").limit(1)
    elif not p.no_outgroup:
        out = select.pick_outgroup(rows, target, p.level, inside, rep=F.col("is_rep"))
    out = cut(out)
    if p.outgroup and out.isEmpty():
        raise InputError(f"there is no record {p.outgroup} to be the outgroup")
    own = kept.join(out.select("accession"), "accession", "left_anti")
    new = manifest_rows(own).unionByName(manifest_rows(out, True)).dropDuplicates(["accession"])
    m = save_manifest(ctx, new)
    ctx.write("selection", tables.selection(m))
    ctx.write("outgroup_accession", out.select("accession"))


@dataclass
class Genome:
    """Sequences of the selected records; with allow_missing those without one are left out."""

    allow_missing: bool = False


def genome(ctx: Context, p: Genome) -> None:
    """From selection and sequences (accession, seq) to genomes (accession, filename, is_outgroup, seq).

    A sequence that is not letters, gaps and stops is an error when it is read; of several of one accession the greatest counts.
    """
    chosen = ctx.read("selection", "Run the stage metadata first.")
    seqs = ctx.read("sequences").where("accession is not null and seq != ''").groupBy("accession").agg(F.max("seq").alias("seq"))
    bad = F.raise_error(F.concat(F.lit("no sequence of letters: "), "accession"))
    sound = F.when(F.rlike("seq", F.lit(r"^[A-Za-z*\-]+$")), F.col("seq")).otherwise(bad)
    got = ctx.write("genomes", chosen.join(seqs, "accession").select("accession", "filename", "is_outgroup", sound.alias("seq")))
    lost = chosen.join(got, "accession", "left_anti").select("accession")
    if not p.allow_missing and (some := [r[0] for r in lost.limit(5).collect()]):
        raise InputError(f"{lost.count()} selected records have no sequence, such as {', '.join(some)}")


@dataclass
class Dereplicate:
    """How representatives are chosen. reduce: keep one per taxon of that level afterwards; target: how many are wanted."""

    threshold: float = 0.9
    pre_threshold: float | None = None
    chunk_size: int | None = None
    target: int | None = None
    reduce: str | None = None
    size: int = 31
    scaled: int = 1000

    def __post_init__(self):
        self.threshold = dereplicate.fraction(self.threshold)
        if self.pre_threshold is not None:
            self.pre_threshold = dereplicate.fraction(self.pre_threshold)
        if self.reduce is not None:
            one_of(self.reduce, select.LEVELS, "a level")
        if self.target is not None and (self.target < 1 or self.chunk_size):
            raise InputError("a target is at least 1 and is searched without chunks")


def sketches(ctx: Context, genomes: DataFrame, size: int, scaled: int) -> DataFrame:
    """(id, h) of the genomes, kept in the work folder by sketch parameters: only genomes not sketched yet are read.

    A genome's entry goes by its accession and a hash of its sequence, so a changed sequence is sketched anew.
    """
    table = f"sketches-{size}-{scaled}"
    keyed = genomes.select(F.concat_ws("-", "accession", F.md5("seq")).alias("key"), "accession", "seq")
    try:
        have = ctx.read(table)
    except InputError:
        have = ctx.spark.createDataFrame([], "key string, h bigint")
    fresh = keyed.join(have.select("key").distinct(), "key", "left_anti")
    made = cut(sketch.kmer_sketch(fresh.select("key", "seq"), "key", "seq", size, scaled).withColumnRenamed("id", "key"))
    # a genome too short to have a hash keeps an empty entry, so it isn't tried again
    none = fresh.select("key").join(made.select("key").distinct(), "key", "left_anti").select("key", F.lit(None).cast("bigint").alias("h"))
    made.unionByName(none).write.mode("append").parquet(ctx.path(table))
    return ctx.read(table).where("h is not null").join(keyed.select("key", F.col("accession").alias("id")), "key").select("id", "h")


def chosen_clusters(sk: DataFrame, everyone: DataFrame, p: Dereplicate) -> DataFrame:
    """(representative, member) by the parameters, before any reduction by taxon."""
    if p.target is not None:
        members = cut(similarity.classes(sk))
        edges = cut(similarity.class_edges(sk, members, min(p.threshold, 0.8)))
        alone = everyone.join(members.select("id"), "id", "left_anti").count()
        t = dereplicate.search_target(edges, members, max(0, p.target - alone))[0]
        return dereplicate.cover_edges(members, cut(edges.where(F.col("jaccard") >= t)), everyone)
    if p.chunk_size:
        return dereplicate.chunked(sk, everyone, p.chunk_size, p.threshold, p.pre_threshold).clusters
    return dereplicate.cover_sketch(sk, everyone, p.threshold)


def dereplicate_stage(ctx: Context, p: Dereplicate) -> None:
    """From genomes to clusters, genome_status and the manifest's statuses; the outgroup takes no part."""
    genomes = ctx.read("genomes", "Run the stage genome first.").where("is_outgroup = '0'")
    everyone = cut(genomes.select(F.col("accession").alias("id")).distinct())
    found = cut(chosen_clusters(cut(sketches(ctx, genomes, p.size, p.scaled)), everyone, p))
    m = open_manifest(ctx)
    if p.reduce:
        levels = list(select.LEVELS[: select.LEVELS.index(p.reduce) + 1])
        found = cut(compose.reduce_by_taxon(found, m.select(F.col("accession").alias("name"), *levels), levels))
    ctx.write("clusters", found)
    ctx.write("genome_status", cover.statuses(found).orderBy("genome"))
    rows = found.select(F.col("member").alias("accession"), F.when(F.col("member") == F.col("representative"), "representative").otherwise("contained").alias("derep_status"), "representative")
    save_manifest(ctx, manifest.set_status(m, rows))


def scatter(sk: DataFrame, everyone: DataFrame, size: int, threshold: float) -> DataFrame:
    """(chunk, representative, member): each chunk of `size` records dereplicated by itself, all chunks in one job."""
    placed = cut(compose.chunks(everyone.select("id").where("id is not null").distinct(), size, "id")).select("id", "chunk")
    part = cut(sk.join(placed, "id").select("id", F.xxhash64("h", "chunk").alias("h")))
    found = dereplicate.cover_sketch(part, placed.select("id"), threshold)
    return found.join(placed.withColumnRenamed("id", "member"), "member").select("chunk", "representative", "member")


def gather(chunks: DataFrame, sk: DataFrame, threshold: float) -> DataFrame:
    """(representative, member) of the whole: the chunks' representatives dereplicated and their members taken along."""
    if chunks.isEmpty():
        raise InputError("there are no chunk results to gather")
    left = cut(chunks.select(F.col("representative").alias("id")).distinct())
    second = dereplicate.cover_sketch(cut(sk.join(left, "id", "left_semi")), left, threshold)
    return compose.compose(chunks.select("representative", "member"), second)


def read_chunks(spark, paths: list[str]) -> DataFrame:
    """The clusters in the folders of chunk results; a folder without them is an error."""
    out = None
    for path in paths:
        one = Context(spark, path).read("clusters", "It is not a chunk result.")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise InputError("there are no chunk results to gather")
    return out


def snptype(ctx: Context, ignore: str = "") -> None:
    """From alignment (name, seq) to core_snps (name, seq) and snp_distances (a, b, d)."""
    core = ctx.write("core_snps", alignment.core_alignment(ctx.read("alignment", "It is an alignment of the genomes."), ignore=ignore))
    ctx.write("snp_distances", alignment.hamming(core))


@dataclass
class Phylo:
    """all_genomes: build over all genomes instead of representatives. source: distances of sketches, or of the rows of the table alignment (name, seq), whose names are leaves."""

    builder: str = "neighbour-joining"
    all_genomes: bool = False
    source: str = "sketch"
    size: int = 31
    scaled: int = 1000


def sketch_distances(sk: DataFrame, everyone: DataFrame) -> DataFrame:
    """(a, b, d): 1 - Jaccard similarity of every pair that shares a hash, and 0 of each record with itself.

    For the representatives a tree is built of, in the thousands; pairs that share nothing are 1 by definition and not listed.
    """
    n = sk.groupBy("id").agg(F.count("*").alias("n"))
    a, b = sk.withColumnRenamed("id", "a"), sk.withColumnRenamed("id", "b")
    shared = a.join(b, "h").where("a < b").groupBy("a", "b").agg(F.count("*").alias("s"))
    d = shared.join(n.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
    d = d.select("a", "b", (1 - F.col("s") / (F.col("na") + F.col("nb") - F.col("s"))).alias("d"))
    return d.unionByName(everyone.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("d")))


def advice(taxa: DataFrame) -> str | None:
    """What to say of a set of genomes that an alignment of whole genomes will hardly cover."""
    r = alignment.spread_of(taxa).first()
    if r["genera"] > 1:
        return f"{r['genera']} genera: little of their genomes will align; distances without an alignment suit better"
    return f"{r['species']} species in a genus: the alignment may be short" if r["species"] > 1 else None


def phylo(ctx: Context, p: Phylo) -> None:
    """From genomes and clusters to tree (newick), over representatives and the outgroup."""
    genomes = ctx.read("genomes", "Run the stage genome first.")
    if not p.all_genomes:
        reps = ctx.read("clusters", "Run the stage dereplicate first.").select(F.col("representative").alias("accession")).distinct()
        genomes = genomes.where("is_outgroup = '1'").unionByName(genomes.where("is_outgroup = '0'").join(reps, "accession", "left_semi"))
    genomes = cut(genomes)
    n = genomes.count()
    if warning := tree_builders.warning(p.builder, n):
        raise InputError(warning)
    leaf = genomes.select("accession", names.strip_suffix(F.col("filename")).alias("leaf"))
    if one_of(p.source, ("sketch", "alignment"), "a source") == "alignment":
        rows = ctx.read("alignment", "It is an alignment of the genomes.").join(leaf.select(F.col("leaf").alias("name")), "name", "left_semi")
        width = rows.agg(F.min(F.length("seq"))).first()[0] or 1
        d = alignment.hamming(rows).select("a", "b", (F.col("d") / width).alias("d"))
        d = d.unionByName(rows.select(F.col("name").alias("a"), F.col("name").alias("b"), F.lit(0.0).alias("d")))
    else:
        sk = sketches(ctx, genomes, p.size, p.scaled).join(small(leaf.withColumnRenamed("accession", "id")), "id").select(F.col("leaf").alias("id"), "h")
        d = sketch_distances(cut(sk), leaf.select(F.col("leaf").alias("id")))
    ctx.write("tree", tree_builders.get(p.builder)(d, missing=1.0).select("newick"))


@dataclass
class Tree2Tax:
    """How the tree becomes a taxonomy: names of nodes and root, and whether the outgroup leaves it."""

    basename: str | None = None
    root_name: str = "root"
    remove_outgroup: bool = True


def tree2tax(ctx: Context, p: Tree2Tax) -> None:
    """From tree, clusters and manifest to tree2tax (child, parent) and genomes_map (accession, leaf)."""
    m = open_manifest(ctx)
    first = m.where("is_outgroup").select(names.strip_suffix(F.col("filename"))).first()
    out = first[0] if first else None
    nodes = cut(trees.tree_table(ctx.read("tree", "Run the stage phylo first."), outgroup=out))
    ctx.write("tree2tax", trees.relations(nodes, p.basename, out if p.remove_outgroup else None, p.root_name))
    file = m.select("accession", "filename")
    pairs = ctx.read("clusters").join(file.withColumnsRenamed({"accession": "representative", "filename": "r"}), "representative")
    pairs = pairs.join(file.withColumnsRenamed({"accession": "member", "filename": "m"}), "member").select(F.col("r").alias("representative"), F.col("m").alias("member"))
    leaves = nodes.join(nodes.select(F.col("parent").alias("node")).distinct(), "node", "left_anti").where("label != ''").select(F.col("label").alias("leaf"))
    if out and p.remove_outgroup:
        leaves = leaves.where(F.col("leaf") != out)
    ctx.write("genomes_map", trees.genome_map(leaves, pairs))


@dataclass
class Run:
    """The parameters of a whole run."""

    metadata: Metadata
    genome: Genome = field(default_factory=Genome)
    dereplicate: Dereplicate = field(default_factory=Dereplicate)
    phylo: Phylo = field(default_factory=Phylo)
    tree2tax: Tree2Tax = field(default_factory=Tree2Tax)


STAGES = {"metadata": metadata, "genome": genome, "dereplicate": dereplicate_stage, "phylo": phylo, "tree2tax": tree2tax}


def run(ctx: Context, p: Run, dry_run: bool = False, force: bool = False) -> dict[str, str]:
    """Stage -> ran, skipped or planned. Once a stage is run those after it are run too, as their input has changed."""
    out: dict[str, str] = {}
    for name, work in STAGES.items():
        fresh = force or "ran" in out.values() or "planned" in out.values()
        out[name] = run_stage(ctx, name, getattr(p, name), work, fresh, dry_run)
    return out


def export(ctx: Context, folder: str) -> None:
    """The results of a run as the text tables other programs read."""
    tables.write_tsv(ctx.read("selection"), f"{folder}/selection")
    tables.write_tsv(tables.clusters(ctx.read("clusters")).orderBy("representative", "ord", "member").drop("ord"), f"{folder}/clusters", header=True)
    tables.write_tsv(ctx.read("genome_status").orderBy("genome"), f"{folder}/genome_status")
    tables.write_tsv(ctx.read("tree2tax").orderBy("child", "parent"), f"{folder}/tree2tax")
    tables.write_tsv(ctx.read("genomes_map").orderBy("accession", "leaf"), f"{folder}/genomes_map", header=False)
    sinks.newick(ctx.read("tree"), f"{folder}/tree")
    sinks.lines(ctx.read("outgroup_accession"), f"{folder}/outgroup_accession", "accession")
    sinks.versions(ctx.ledger(), f"{folder}/versions")
