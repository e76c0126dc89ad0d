"""Queries over vectors, alignments and trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alignment, distances, sketch, trees
from ..session import cut, table
from .base import EDGES, query
from .derep import _classes

_CENT = """long as (select label, unnest(range(len(embedding))) as i, unnest(embedding)::double as x from embeddings where label is not null),
cent as (select label, i, round(avg(x), 9) as x from long group by all),
dist as (select a.label as a, b.label as b, round(sqrt(sum((a.x - b.x) ** 2)), 6) as d from cent a join cent b on a.i = b.i and a.label != b.label group by all)"""


def _dist(spark, sf):
    return distances.euclidean(distances.centroids(table(spark, sf, "embeddings"), "label", "embedding"))


@query(f"with {_CENT} select a, b, round(d, 4) as d from dist")
def distance_matrix(spark, sf):
    return _dist(spark, sf).select("a", "b", F.round("d", 4).alias("d"))


@query(f"""with {_CENT}, so as (select a as s, b as o, d from dist where a < 5 and b >= 5), lim as (select greatest(avg(d) - stddev_samp(d), median(d)) as l from so),
c as (select o, min(d) as lo, max(d) as hi from so group by o) select o, round(lo, 4) as lo, round(hi, 4) as hi from c, lim order by lo < l, hi desc, lo, o limit 1""")
def outgroup_by_distance(spark, sf):
    so = _dist(spark, sf).where("a < 5 and b >= 5").select(F.col("a").alias("s"), F.col("b").alias("o"), "d")
    return distances.outgroup(so).select("o", F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"))


@query(f"""with {_CENT} select case when a < 5 and b < 5 then 'S-S' when a >= 5 and b >= 5 then 'O-O' else 'S-O' end as kind, count(*) as n, round(median(d), 4) as median, round(avg(d), 4) as mean, round(stddev_samp(d), 4) as stdev
from dist where a < b group by 1""")
def pair_kind_stats(spark, sf):
    return distances.pair_kinds(_dist(spark, sf).where("a < b"), lambda c: c < 5, 4)


_SIMS = EDGES + ", sims as (select a, b, jaccard as s from edges union all select b, a, jaccard from edges)"
#: The same between all documents: across the two classes of an edge, and 1 within a class.
_DOCUMENT_SIMS = EDGES + """,
once as (select x.id as a, y.id as b, jaccard as s from edges join members x on x.class_id = a join members y on y.class_id = b
 union all select x.id, y.id, 1.0::double from members x join members y on x.class_id = y.class_id and x.id < y.id),
sims as (select a, b, s from once union all select b, a, s from once)"""


def _pairs(members, edges):
    """(a, b, s, w): similarities in both directions, each row for w pairs of different documents.

    An edge stands for all pairs across its two classes, a class for the pairs within it, which have
    similarity 1; no pair is made.
    """
    sizes = members.groupBy("class_id").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    na, nb = (sizes.select(F.col("class_id").alias(c), F.col("n").alias(f"w{c}")) for c in "ab")
    e = edges.select("a", "b", F.col("jaccard").alias("s")).join(na, "a").join(nb, "b").select("a", "b", "s", (F.col("wa") * F.col("wb")).alias("w"))
    inside = sizes.where("n > 1").select(F.col("class_id").alias("a"), F.col("last").alias("b"), F.lit(1.0).alias("s"), F.expr("n * (n - 1) div 2").alias("w"))
    e = e.unionByName(inside)
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "s", "w"))


def _head_sims(spark, sf):
    """Similarities of the heads of different classes in both directions."""
    e = _classes(spark, sf)[2].select("a", "b", F.col("jaccard").alias("s"))
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))


def _sims(spark, sf):
    """Similarities of different documents in both directions, weighted."""
    _, members, edges = _classes(spark, sf)
    return _pairs(members, edges)


@query(f"with {_SIMS} select least(floor((s - 0.8::double) / ((1.0::double - 0.8::double) / 100)), 99)::int as bin, count(*) as n from sims where a != b and s between 0.8 and 1.0 group by 1")
def glance_hist(spark, sf):
    """Pairs of class heads, as the SQL counts them; pairs of documents are in glance_hist_documents."""
    return distances.overview(_head_sims(spark, sf), 0.8, 1.0)


@query(f"with {_DOCUMENT_SIMS} select least(floor((s - 0.8::double) / ((1.0::double - 0.8::double) / 100)), 99)::int as bin, count(*) as n from sims where a != b and s between 0.8 and 1.0 group by 1")
def glance_hist_documents(spark, sf):
    return distances.overview(_sims(spark, sf), 0.8, 1.0, weight="w")


@query(f"with {_SIMS} select count(*) as n, round(min(s), 9) as least, round(quantile_cont(s, 0.25), 9) as q1, round(median(s), 9) as q2, round(quantile_cont(s, 0.75), 9) as q3, round(max(s), 9) as most from sims where a != b and s between 0.8 and 1.0")
def glance_box(spark, sf):
    """Pairs of class heads, as the SQL counts them; pairs of documents are in glance_box_documents."""
    return distances.five_numbers(_head_sims(spark, sf), 0.8, 1.0).select("n", *(F.round(c, 9).alias(c) for c in ("least", "q1", "q2", "q3", "most")))


@query(f"with {_DOCUMENT_SIMS} select count(*) as n, round(min(s), 9) as least, round(quantile_cont(s, 0.25), 9) as q1, round(median(s), 9) as q2, round(quantile_cont(s, 0.75), 9) as q3, round(max(s), 9) as most from sims where a != b and s between 0.8 and 1.0")
def glance_box_documents(spark, sf):
    return distances.five_numbers(_sims(spark, sf), 0.8, 1.0, weight="w").select("n", *(F.round(c, 9).alias(c) for c in ("least", "q1", "q2", "q3", "most")))


@query(f"""with {_CENT}, r as (select a, sum(d) as r from dist group by a), n as (select count(*) as n from r)
select d.a, d.b, round((n - 2) * d - ra.r - rb.r, 6) as q from dist d join r ra on ra.a = d.a join r rb on rb.a = d.b, n where d.a < d.b order by q, d.a, d.b limit 1""".replace("order by q,", "order by 3,"))
def nj_first_join(spark, sf):
    return trees.nj_first_pair(_dist(spark, sf))


@query()
def nj_tree(spark, sf):
    return trees.nj_tree(_dist(spark, sf))


@query()
def nj_relations(spark, sf):
    """Child-parent relations of the neighbour-joining tree, rooted at one label."""
    return trees.relations(cut(trees.tree_table(trees.nj_tree(_dist(spark, sf)), outgroup="9")))


# a tree of regions, nations and suppliers


_TREE = """leafs as (select 'supplier-' || s_suppkey as leaf, n_name as n, r_name as r from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
clade as (select 'n' || n as node, md5(string_agg(leaf, ' ' order by leaf)) as name from leafs group by n union all select 'r' || r, md5(string_agg(leaf, ' ' order by leaf)) from leafs group by r)"""


def _nodes(spark, sf):
    """The node table of the tree: root, regions, nations, suppliers."""
    r, n, s = (table(spark, sf, t) for t in ("region", "nation", "supplier"))
    root = spark.createDataFrame([(0, -1, "")], "node int, parent int, label string")
    used = s.select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    nn = n.join(used, "n_nationkey")
    regions = r.join(nn.select(F.col("n_regionkey").alias("r_regionkey")).distinct(), "r_regionkey").select((F.col("r_regionkey") + 1).cast("int").alias("node"), F.lit(0).alias("parent"), F.lit("").alias("label"))
    nations = nn.select((F.col("n_nationkey") + 100).cast("int").alias("node"), (F.col("n_regionkey") + 1).cast("int").alias("parent"), F.lit("").alias("label"))
    leaves = s.select((F.col("s_suppkey") + 1000).cast("int").alias("node"), (F.col("s_nationkey") + 100).cast("int").alias("parent"), F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")).alias("label"))
    return cut(root.unionAll(regions).unionAll(nations).unionAll(leaves))


@query(f"with {_TREE} select name from clade union all select 'root'")
def clade_md5(spark, sf):
    return trees.clade_names(_nodes(spark, sf)).select("name")


@query(f"""with {_TREE} select leaf as child, c.name as parent from leafs join clade c on c.node = 'n' || n
union select a.name, b.name from leafs join clade a on a.node = 'n' || n join clade b on b.node = 'r' || r union select a.name, 'root' from leafs join clade a on a.node = 'r' || r""")
def tree2tax_edges(spark, sf):
    return trees.relations(_nodes(spark, sf))


@query("""with g as (select distinct accession, filename as f from genomes where filename is not null), c as (select distinct representative as r, member as m from derep_clusters where representative is not null and member is not null and representative != member),
leaf as (select distinct regexp_replace(f, '([.]fasta[.]gz|[.]fasta|[.]fa|[.]fna|[.]fas)$', '') as leaf from g),
names as (select leaf, leaf as name from leaf union select regexp_replace(r, '([.]fasta[.]gz|[.]fasta|[.]fa|[.]fna|[.]fas)$', '') as l, regexp_replace(m, '([.]fasta[.]gz|[.]fasta|[.]fa|[.]fna|[.]fas)$', '') from c where l in (select leaf from leaf)),
st as (select leaf, regexp_replace(regexp_replace(trim(name), '^.*/', ''), '([.]fasta[.]gz|[.]fasta|[.]fa|[.]fna|[.]fas)$', '') as s from names)
select distinct case when len(string_split(s, '_')) >= 4 then array_to_string(string_split(s, '_')[4:], '_') else s end as accession, leaf from st""")
def genome_map(spark, sf):
    from ..functions.names import strip_suffix

    leaves = table(spark, sf, "genomes").where("filename is not null").select(strip_suffix(F.col("filename")).alias("leaf")).distinct()
    return trees.genome_map(leaves, table(spark, sf, "derep_clusters"))


# alignments of the nations' names


_MSA = "msa as (select n_nationkey as name, substr(n_name || '            ', 1, 12) as seq from nation)"
_SITES = _MSA + ", sites as (select name, i as pos, substr(seq, i + 1, 1) as c from msa, range(12) t(i)), var as (select pos from sites group by pos having count(distinct c) > 1)"


def _msa(spark, sf):
    """The nations' names as rows of equal width."""
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("name"), F.rpad("n_name", 12, " ").alias("seq"))


@query(f"with {_SITES} select pos::int as pos from var")
def core_snp_columns(spark, sf):
    return alignment.variable_sites(_msa(spark, sf))


@query(f"with {_SITES} select name, string_agg(c, '' order by pos) as seq from sites where pos in (select pos from var) group by name")
def core_snp_alignment(spark, sf):
    return alignment.core_alignment(_msa(spark, sf))


@query(f"with {_SITES} select a.name as a, b.name as b, count(*) filter (a.c != b.c) as d from sites a join sites b on a.pos = b.pos and a.name < b.name group by all")
def hamming_matrix(spark, sf):
    return alignment.hamming(_msa(spark, sf))


@query("select count(distinct lower(genus)) filter (genus != '') as genera, count(distinct lower(genus) || '|' || lower(coalesce(species, ''))) filter (genus != '') as species from genomes")
def taxonomic_spread(spark, sf):
    return alignment.spread_of(table(spark, sf, "genomes"))


_MAF = """m as (select n_regionkey as block, n_nationkey as row, 'g' || (n_nationkey % 5) as genome, (100 - n_regionkey) as start, replace(substr(n_name || '------------', 1, 12), 'A', '-') as text from nation),
f as (select block, genome, arg_min(text, row) as text, arg_min(start, row) as start from m group by all),
ref as (select block, start, list_filter(range(1, 13), lambda i: substr(text, i, 1) != '-') as keep from f where genome = 'g0'),
cells as (select g.genome, r.block, r.start, coalesce(array_to_string(list_transform(r.keep, lambda i: substr(f.text, i, 1)), ''), repeat('-', len(r.keep))) as t
 from (select distinct genome from f) g cross join (select * from ref where len(keep) > 0) r left join f on f.genome = g.genome and f.block = r.block)"""


@query(f"with {_MAF} select case when genome = 'g0' then 0 else 1 end as ord, genome, string_agg(t, '' order by start, block) as seq from cells group by genome")
def msa_project(spark, sf):
    """Blocks made from the nations' names, one per region, projected on one of them."""
    n = table(spark, sf, "nation")
    rows = n.select(
        F.col("n_regionkey").cast("bigint").alias("block"), F.col("n_nationkey").alias("row"), F.concat(F.lit("g"), (F.col("n_nationkey") % 5).cast("string")).alias("genome"),
        (100 - F.col("n_regionkey")).cast("bigint").alias("start"), F.replace(F.rpad("n_name", 12, "-"), F.lit("A"), F.lit("-")).alias("text"),
    )
    return alignment.project_blocks(rows, "g0")


# alignments of many rows: names of parts, names and numbers of suppliers; sketches of the letters of documents


_PARTS = "msa as (select p_partkey as name, rpad(p_type, (select max(length(p_type)) from part)::int, '-') as seq from part)"
_PART_SITES = _PARTS + """, wide as (select min(length(seq)) as w from msa), sites as (select name, i as pos, substr(seq, i + 1, 1) as c from (select name, seq, unnest(range(w)) as i from msa, wide)),
var as (select pos from sites group by pos having count(distinct c) > 1)"""


def _parts(spark, sf):
    """The types of parts as rows of equal width."""
    p = table(spark, sf, "part")
    width = p.agg(F.max(F.length("p_type"))).first()[0] or 0
    return p.select(F.col("p_partkey").alias("name"), F.rpad("p_type", width, "-").alias("seq"))


@query(f"with {_PART_SITES} select pos::int as pos from var")
def part_snp_columns(spark, sf):
    return alignment.variable_sites(_parts(spark, sf))


@query(f"with {_PART_SITES} select name, string_agg(c, '' order by pos) as seq from sites where pos in (select pos from var) group by name")
def part_snp_alignment(spark, sf):
    return alignment.core_alignment(_parts(spark, sf))


_SUPPLIERS = "(select s_suppkey as name, lpad((s_suppkey * 7919 % 100003)::varchar, 6, '0') || lpad((s_nationkey * s_suppkey % 1009)::varchar, 4, '0') as seq from supplier)"


@query(f"select a.name as a, b.name as b, hamming(a.seq, b.seq)::bigint as d from {_SUPPLIERS} a join {_SUPPLIERS} b on a.name < b.name")
def supplier_hamming(spark, sf):
    s = table(spark, sf, "supplier")
    k, n = F.col("s_suppkey").cast("bigint"), F.col("s_nationkey").cast("bigint")
    seq = F.concat(F.lpad((k * 7919 % 100003).cast("string"), 6, "0"), F.lpad((n * k % 1009).cast("string"), 4, "0"))
    return alignment.hamming(s.select(F.col("s_suppkey").alias("name"), seq.alias("seq")))


_KMERS = """seqs as (select doc_id as id, regexp_replace(upper(text), '[^ACGT]', '', 'g') as s from documents where doc_id is not null and text is not null),
parts as (select id, unnest(list_transform(range(greatest(length(s) - 30, 0)), lambda i: substr(s, i + 1, 31))) as k from seqs),
ends as (select id, least(k, reverse(translate(k, 'ACGT', 'TGCA'))) as k from parts)"""


@query(f"with {_KMERS} select distinct id, ('0x' || substr(md5(k), 1, 15))::bigint as h from ends where substr(md5(k), 1, 8) < '{sketch.fraction_bound(10)}'")
def kmer_sketches(spark, sf):
    """Scaled sketches of the DNA letters of each document, both strands as one."""
    d = table(spark, sf, "documents").where("doc_id is not null and text is not null")
    seq = d.select("doc_id", F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("seq"))
    return sketch.kmer_sketch(seq, "doc_id", "seq", 31, 10)


_XMFA = """x as (select (o_orderkey % 3)::int as g, (o_orderkey // 3)::bigint as block, rpad(replace(o_orderpriority, ' ', '-'), 12, 'N') as text from orders),
r as (select block, text as ref from x where g = 0),
c as (select x.g, r.block, r.ref, x.text, unnest(range(1, 13)) as i from x join r using (block)),
cells as (select g, block * 12 + row_number() over (partition by g, block order by i) as pos, substr(text, i, 1) as c from c where substr(ref, i, 1) != '-')"""


@query(f"with {_XMFA} select 'g' || g as genome, count(*) filter (c != '-') as filled, sum(pos) filter (c = 'I')::bigint as at_i, sum(pos) filter (c = 'N')::bigint as at_n, (select max(block) * 12 + 12 from r)::bigint as width from cells group by g")
def xmfa_project(spark, sf):
    """Where letters come to stand when blocks of orders' priorities are put on the coordinates of their first genome."""
    o = table(spark, sf, "orders")
    block = F.floor(F.col("o_orderkey") / 3).cast("bigint")
    rows = o.select(
        block.alias("block"), F.concat(F.lit("g"), (F.col("o_orderkey") % 3).cast("string")).alias("genome"), (block * 12 + 1).alias("p1"), (block * 12 + 12).alias("p2"),
        F.lit("+").alias("sign"), F.rpad(F.replace("o_orderpriority", F.lit(" "), F.lit("-")), 12, "N").alias("text"),
    )
    c = alignment.project_xmfa(rows, "g0").select("genome", F.length("seq").cast("bigint").alias("width"), F.posexplode(F.split("seq", "")).alias("i", "c"))
    pos = (F.col("i") + 1).cast("bigint")
    return c.groupBy("genome", "width").agg(
        F.count_if((F.col("c") != "-") & (F.col("c") != "")).alias("filled"), F.sum(F.when(F.col("c") == "I", pos)).alias("at_i"), F.sum(F.when(F.col("c") == "N", pos)).alias("at_n"),
    ).select("genome", "filled", "at_i", "at_n", "width")
