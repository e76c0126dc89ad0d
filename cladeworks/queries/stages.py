"""Queries that run stages and steps over the test tables, and write files and read them again."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import alignment, compose, manifest, sketch
from ..plans import stages
from ..plans.pipeline import Context
from ..session import cut, shared_dir, table
from ..sources import fasta, sinks, tables
from .base import COVER, SKETCH, acc, query, rank, species
from .relational import _CUR_SQL


def _context(spark) -> Context:
    return Context(spark, f"{shared_dir(spark)}/work-{uuid.uuid4().hex}")


def _sketch(spark, sf):
    return cut(sketch.word_sketch(table(spark, sf, "documents")))


# ---- scatter and gather

_AFTER = COVER[len(SKETCH):].lstrip().lstrip(",")
_NAMES = ("sketch", "sets", "members", "heads", "shared", "edges", "sizes", "ends", "deg", "ranked", "around", "walk", "reps", "cover", "clusters")
#: The cover again under other names, over the representatives of the first.
_SECOND = re.sub(r"\b(" + "|".join(_NAMES) + r")\b", r"\g<1>_2", _AFTER.replace(
    "from documents where doc_id is not null and doc_id not in", "from (select distinct representative as doc_id from one) where doc_id not in"))


@query(f"""with recursive {SKETCH.replace('sketch as', 'every as')},
ids as (select doc_id as id, row_number() over (order by doc_id) - 1 as pos, count(*) over () as n from (select distinct doc_id from documents where doc_id is not null)),
placed as (select id, case when n > 400 and n % 400 = 1 and pos = n - 1 then pos // 400 - 1 else pos // 400 end as chunk from ids),
sketch as (select e.id, e.h || '/' || p.chunk as h from every e join placed p using (id)),{_AFTER},
one as (select representative, member from clusters),
sketch_2 as (select id, h from every where id in (select representative from one)),{_SECOND}
select coalesce(b.representative, a.representative) as representative, a.member from one a left join clusters_2 b on b.member = a.representative""")
def derep_scatter_gather(spark, sf):
    """Documents in chunks of 400, each covered by itself, and the cover of their representatives."""
    sk, everyone = _sketch(spark, sf), table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    parts = cut(stages.scatter(sk, everyone, 400, 0.8))
    return stages.gather(parts, sk, 0.8)


_TAXA_OF = "taxa as (select doc_id as name, source from documents)"


@query(f"""with recursive {COVER}, {_TAXA_OF},
sized as (select c.representative as name, count(*) filter (c.member != c.representative) as members, max(t.source) as source from clusters c join taxa t on t.name = c.representative group by c.representative),
keep as (select source, arg_max(name, (members, name)) as keeper from sized where trim(source) != '' group by source)
select coalesce(k.keeper, c.representative) as representative, c.member from clusters c join sized s on s.name = c.representative left join keep k on k.source = s.source""")
def stage_dereplicate(spark, sf):
    """The cover of the documents and, as the stage does with taxa, one representative for each source."""
    docs = table(spark, sf, "documents")
    p = stages.Dereplicate(threshold=80)
    found = cut(stages.chosen_clusters(_sketch(spark, sf), docs.select(F.col("doc_id").alias("id")), p))
    return compose.reduce_by_taxon(found, docs.select(F.col("doc_id").alias("name"), "source"), ["source"])


# ---- the stages of a run


def _taxa(spark, sf):
    """The current manifest as a taxonomy table, in canonical names."""
    g = manifest.latest(table(spark, sf, "genomes"), "accession", "updated_at", "ingested_at", "row_id")
    return g.select(
        F.col("row_id").alias("ord"), "accession", names.rank_name(F.col("family")).alias("family"), names.rank_name(F.col("genus")).alias("genus"),
        names.species_name(F.col("species"), F.col("genus")).alias("species"), F.coalesce(F.lower(F.trim("derep_status")) == "representative", F.lit(False)).alias("is_rep"),
    )


def _genus(taxa) -> str:
    first = taxa.where("family is not null and genus is not null").orderBy("ord").first()
    return first["genus"] if first else "none"


@query(f"""with {_CUR_SQL}, rows as (select row_id as ord, accession, {rank('family')} as family, {rank('genus')} as genus, {species('species', 'genus')} as species, coalesce(lower(trim(derep_status)) = 'representative', false) as is_rep from cur),
tgt as (select family, genus from rows where family is not null and genus is not null order by ord limit 1),
inside as (select r.* from rows r join tgt t on r.family = t.family and r.genus = t.genus),
out as (select r.* from rows r join tgt t on r.family = t.family where r.genus != t.genus and r.is_rep and r.accession not in (select accession from inside) order by r.ord limit 1),
every as (select *, false as o from inside where is_rep union all select *, true from out)
select accession, coalesce(family, '') as family, coalesce(genus, '') as genus, coalesce(species, '') as species, case when o then '1' else '0' end as is_outgroup,
 coalesce(family, '') || '_' || coalesce(genus, '') || '_' || coalesce(species, '') || '_' || accession || '.fasta' as filename from every""")
def stage_metadata(spark, sf):
    """The representatives of a genus and an outgroup from the rank above, selected by the stage."""
    ctx = _context(spark)
    taxa = cut(_taxa(spark, sf))
    ctx.write("taxa", taxa)
    stages.metadata(ctx, stages.Metadata("genus", genus=_genus(taxa), dataset="rep"))
    return ctx.read("selection")


def _run(spark, sf):
    """A whole run over a genus of the manifest; the letters of the documents about a genome are its sequence."""
    ctx = _context(spark)
    taxa = cut(_taxa(spark, sf).where("family is not null and genus is not null and species is not null"))
    ctx.write("taxa", taxa)
    d = table(spark, sf, "documents").where("accession is not null and text is not null")
    letters = F.regexp_replace(F.upper("text"), "[^ACGT]", "")
    ctx.write("sequences", d.groupBy("accession").agg(F.max(F.struct(F.length(letters).alias("n"), letters.alias("seq")))["seq"].alias("seq")))
    p = stages.Run(
        stages.Metadata("genus", genus=_genus(taxa)), stages.Genome(allow_missing=True), stages.Dereplicate(0.9, size=15, scaled=1),
        stages.Phylo(size=15, scaled=1), stages.Tree2Tax(),
    )
    return ctx, p


@query()
def run_plan(spark, sf):
    """(accession, leaf) at the end of all stages: every selected genome with a sequence under the leaf of its representative."""
    ctx, p = _run(spark, sf)
    stages.run(ctx, p)
    return ctx.read("genomes_map")


@query("select unnest(range(5))::int as ord, unnest(['metadata', 'genome', 'dereplicate', 'phylo', 'tree2tax']) as stage, unnest(['ran', 'skipped', 'skipped', 'skipped', 'skipped']) as first, 'skipped' as again".replace("'ran', 'skipped', 'skipped', 'skipped', 'skipped'", "'ran', 'ran', 'ran', 'ran', 'ran'"))
def run_ledger(spark, sf):
    """What a run and its repetition do with each stage."""
    ctx, p = _run(spark, sf)
    one, two = stages.run(ctx, p), stages.run(ctx, p)
    return spark.createDataFrame([(i, s, one[s], two[s]) for i, s in enumerate(stages.STAGES)], "ord int, stage string, first string, again string")


# ---- files, written from a table and read again


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"


def _csv(df, path: str, sep: str = ",", header: bool = True) -> str:
    df.write.options(sep=sep, header=header, quote='"', emptyValue="").csv(path)
    return path


@query(f"""with {_CUR_SQL} select accession, coalesce(family, '') as family, coalesce(genus, '') as genus, coalesce(species, '') as species, is_outgroup, coalesce(filename, '') as filename from cur""")
def file_selection(spark, sf):
    g = manifest.latest(table(spark, sf, "genomes"), "accession", "updated_at", "ingested_at", "row_id")
    path = _folder(spark)
    tables.write_tsv(tables.selection(g), path)
    return tables.read_selection(spark, path)


_PAIRS = f"select distinct {acc('representative')} as representative, {acc('member')} as member from derep_clusters where {acc('representative')} is not null and {acc('member')} is not null"


@query(f"select representative, member from ({_PAIRS}) where representative != member")
def file_clusters(spark, sf):
    d = table(spark, sf, "derep_clusters").select(names.accession_of(F.col("representative")).alias("representative"), names.accession_of(F.col("member")).alias("member")).dropna()
    path = _folder(spark)
    tables.write_tsv(tables.clusters(d).drop("ord"), path)
    return tables.read_clusters(spark, path)


@query(f"select representative, member from ({_PAIRS})")
def file_pair_clusters(spark, sf):
    """A headerless list of pairs with folders before the names."""
    d = table(spark, sf, "derep_clusters").select(names.accession_of(F.col("representative")).alias("r"), names.accession_of(F.col("member")).alias("m")).dropna().distinct()
    path = _csv(d.select(F.concat(F.lit("/x/y/"), "r"), F.concat(F.lit("z/"), "m")), _folder(spark), "\t", False)
    return tables.pair_clusters(spark, path)


_QC = """select qc_id::varchar as genome, coalesce(case when isfinite(try_cast(completeness as double)) then try_cast(completeness as double) end, 0.0) as completeness,
 coalesce(case when isfinite(try_cast(contamination as double)) then try_cast(contamination as double) end, 0.0) as contamination, (qc_id % 1000)::double as length, {0} as n50, {1} as centrality from genome_information"""


def _quality(spark, sf, wide: bool):
    q = table(spark, sf, "genome_information")

    def plain(c):
        x = F.col(c).try_cast("double")
        return F.coalesce(F.when(F.abs(x) < float("inf"), x).cast("string"), F.lit("none")).alias(c)

    cols = [F.col("qc_id").cast("string").alias("genome"), plain("completeness"), plain("contamination"), (F.col("qc_id") % 1000).alias("length")]
    more = [(F.col("qc_id") % 77).alias("N50"), F.lit("0.5").alias("centrality")] if wide else []
    return tables.quality(spark, _csv(q.select(*cols, *more), _folder(spark)))


@query(_QC.format("(qc_id % 77)::double", "0.5::double"))
def file_quality_seven(spark, sf):
    return _quality(spark, sf, True)


@query(_QC.format("0.0::double", "0.0::double"))
def file_quality_five(spark, sf):
    """A table without the columns for N50 and centrality."""
    return _quality(spark, sf, False)


@query("""select l_orderkey::varchar as a, l_partkey::varchar as b, l_quantity::double as score, l_discount::double as fa, l_tax::double as fb from lineitem where l_linenumber != 7""")
def file_ani_edges(spark, sf):
    """Edges with fields that are no numbers, which are skipped."""
    e = table(spark, sf, "lineitem").select(
        F.concat(F.lit("/d/"), F.col("l_orderkey")).alias("Ref"), F.col("l_partkey").cast("string").alias("Query"),
        F.when(F.col("l_linenumber") == 7, "?").otherwise(F.col("l_quantity").cast("string")).alias("ANI"), F.col("l_discount").cast("string").alias("f1"), F.col("l_tax").cast("string").alias("f2"),
    )
    return tables.ani_edges(spark, _csv(e, _folder(spark), "\t")).select("a", "b", "score", "fa", "fb")


@query("select n_name as genome, coalesce(case when n_nationkey % 3 = 0 then null else '2_' || n_regionkey end, '1_' || n_nationkey) as cluster from nation")
def file_cluster_table(spark, sf):
    n = table(spark, sf, "nation")
    second = F.when(F.col("n_nationkey") % 3 == 0, "").otherwise(F.concat(F.lit("2_"), "n_regionkey"))
    return tables.cluster_table(spark, _csv(n.select(F.col("n_name").alias("genome"), F.concat(F.lit("1_"), "n_nationkey").alias("cluster"), second.alias("secondary_cluster")), _folder(spark)))


@query("select s_suppkey::varchar as a, s_nationkey::varchar as b, s_acctbal::double as s from supplier")
def file_similarities(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("genome1"), F.col("s_nationkey").alias("genome2"), F.col("s_acctbal").alias("similarity"))
    return tables.similarities(spark, _csv(s, _folder(spark)))


@query("select trim(p_name) as path from part where trim(p_name) != ''")
def file_names(spark, sf):
    path = _folder(spark)
    sinks.lines(table(spark, sf, "part").withColumn("p", F.concat(F.lit("  "), "p_name")), path, "p")
    return tables.name_list(spark, path)


_LETTERS = "regexp_replace(upper(text), '[^ACGT]', '', 'g')"


@query(f"select 'd' || doc_id as name, {_LETTERS} as seq from documents where {_LETTERS} != ''")
def file_fasta(spark, sf):
    """Records wrapped at 80 letters and read again."""
    path = _folder(spark)
    d = table(spark, sf, "documents").select(F.concat(F.lit("d"), "doc_id").alias("name"), F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("seq")).where("seq != ''")
    fasta.write(d, path)
    return fasta.records(spark, path).select("name", "seq")


@query("""select 'S' || s.s_suppkey as s, 'N' || n.n_nationkey as o, (s.s_suppkey % 10 + n.n_nationkey)::double as d from supplier s, nation n where s.s_suppkey between 1 and 20""")
def file_distance_matrix(spark, sf):
    """Distances of twenty suppliers from all nations, as the square tables of sketching programs hold them."""
    n = table(spark, sf, "nation").select(F.concat(F.lit("O_N"), "n_nationkey").alias("row"), "n_nationkey")
    wide = n.select("row", *((F.lit(i % 10) + F.col("n_nationkey")).alias(f"S_S{i}") for i in range(1, 21)))
    return tables.distance_matrix(spark, _csv(wide, _folder(spark), "\t"))


@query("select s_suppkey as name, sum(d) as total, count(*) as n from (select a.s_suppkey, case when a.s_suppkey = b.s_suppkey then 0 else hamming(lpad(a.s_suppkey::varchar, 5, '0'), lpad(b.s_suppkey::varchar, 5, '0')) end as d from supplier a, supplier b where a.s_suppkey <= 100 and b.s_suppkey <= 100) group by 1".replace("s_suppkey as name, sum(d) as total", "s_suppkey::varchar as name, sum(d)::bigint as total"))
def snp_matrix(spark, sf):
    """The square matrix of the first hundred suppliers' numbers: a sum over each row of its columns."""
    s = table(spark, sf, "supplier").where("s_suppkey <= 100").select(F.col("s_suppkey").alias("name"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("seq"))
    w = sinks.square(alignment.hamming(s), s)
    heads = [c for c in w.columns if c != "name"]
    total = sum((F.col(f"`{c}`") for c in heads), F.lit(0))
    return w.select("name", total.cast("bigint").alias("total"), F.lit(len(heads)).cast("bigint").alias("n"))




@query("select s_suppkey, printf('%g', case when s_acctbal::double / 10000 <= 1 then s_acctbal::double / 10000 * 100 else s_acctbal::double / 10000 end) as percent from supplier")
def percent_texts(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select("s_suppkey", text.percent_text(F.col("s_acctbal").cast("double") / 10000).alias("percent"))


_VERSION = "select p_partkey, p_size::int as major, (p_partkey % 100)::int as minor, (case when p_partkey % 3 = 0 then 0 else p_partkey % 7 end)::int as patch from part"


@query(f"select *, (major, minor, patch) >= (20, 50, 3) as reached from ({_VERSION})")
def version_parse(spark, sf):
    """Versions in a program's text, some without a third number, and whether they reach 20.50.3."""
    key = F.col("p_partkey")
    last = F.when(key % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("."), (key % 7).cast("string")))
    told = F.concat(F.lit("tool v"), F.col("p_size").cast("string"), F.lit("."), (key % 100).cast("string"), last, F.lit(" (build)"))
    v = table(spark, sf, "part").select("p_partkey", text.version_struct(told).alias("v"))
    return v.select("p_partkey", "v.*", text.at_least(F.col("v"), (20, 50, 3)).alias("reached"))


@query("select p_partkey, p_size::varchar as a, p_type as b, n from (select p_partkey, p_size, p_type, 2 as n from part)")
def option_pairs(spark, sf):
    """Options written key=value, with repeated keys of which the last counts."""
    p = table(spark, sf, "part")
    m = text.key_values(F.concat(F.lit(" a = 0, b="), "p_type", F.lit(",a="), F.col("p_size").cast("string")))
    o = p.select("p_partkey", m.alias("m"))
    return o.select("p_partkey", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"), F.size("m").alias("n"))


@query(f"with p as ({_PAIRS}) select representative, count(*) filter (member != representative) as n from p group by representative")
def clusters_by_size(spark, sf):
    """Clusters in the order a report lists them: by falling number of members."""
    d = table(spark, sf, "derep_clusters").select(names.accession_of(F.col("representative")).alias("representative"), names.accession_of(F.col("member")).alias("member")).dropna().distinct()
    return d.groupBy("representative").agg(F.count_if(F.col("member") != F.col("representative")).alias("n")).orderBy(F.desc("n"), "representative")


@query("select cluster, list(genome order by genome) as members from (select s_name as genome, s_nationkey || '_1' as cluster from supplier) group by cluster")
def file_cluster_members(spark, sf):
    """A cluster table written and read, its genomes gathered by cluster."""
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("genome"), F.concat("s_nationkey", F.lit("_1")).alias("secondary_cluster"))
    t = tables.cluster_table(spark, _csv(s, _folder(spark)))
    return t.groupBy("cluster").agg(F.sort_array(F.collect_set("genome")).alias("members"))


@query("select qc_id::varchar as genome, coalesce(nullif(trim(completeness), ''), 'NA') as completeness, coalesce(nullif(trim(contamination), ''), 'NA') as contamination, (qc_id % 1000)::varchar as length, 'NA' as n50, 'NA' as centrality from genome_information")
def file_quality_text(spark, sf):
    q = table(spark, sf, "genome_information")
    path = _csv(q.select(F.col("qc_id").alias("genome"), "completeness", "contamination", (F.col("qc_id") % 1000).alias("length")), _folder(spark))
    return tables.quality_text(spark, path)


@query("select n_nationkey as id, n_name as name, n_regionkey as region from nation")
def file_records(spark, sf):
    path = _folder(spark)
    sinks.records(table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")), path)
    return tables.read_records(spark, path, "id bigint, name string, region bigint")
