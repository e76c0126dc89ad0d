"""Queries of the dereplication family, over documents and over the genome tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import compose, cover, manifest, select, similarity, sketch
from ..plans import dereplicate
from ..session import cut, table
from .base import COVER, EDGES, SKETCH, acc, query, rank, species

T = 0.8


def _sketch(spark, sf):
    return cut(sketch.word_sketch(table(spark, sf, "documents")))


def _classes(spark, sf):
    sk = _sketch(spark, sf)
    members = cut(similarity.classes(sk))
    return sk, members, cut(similarity.class_edges(sk, members, T))


def _clusters(spark, sf):
    _, members, edges = _classes(spark, sf)
    return dereplicate.cover_edges(members, edges, table(spark, sf, "documents").select(F.col("doc_id").alias("id")))


@query(f"with {SKETCH} select id, h from sketch")
def shingle_sketch(spark, sf):
    return sketch.word_sketch(table(spark, sf, "documents"))


@query(f"with {SKETCH} select id, h from sketch where lpad(to_hex(h), 15, '0')[1:8] < '40000000'".replace("lpad(to_hex(h), 15, '0')[1:8]", "substr(lpad(lower(to_hex(h)), 15, '0'), 1, 8)"))
def scaled_sketch(spark, sf):
    return sketch.word_sketch(table(spark, sf, "documents"), scaled=4)


@query(f"with {SKETCH} select id, count(*) as n from sketch group by id")
def sketch_sizes(spark, sf):
    return sketch.word_sketch(table(spark, sf, "documents")).groupBy("id").agg(F.count("*").alias("n"))


@query(f"with {EDGES} select id, class_id from members")
def sketch_classes(spark, sf):
    return similarity.classes(_sketch(spark, sf)).select("id", "class_id")


@query(f"with {EDGES} select a, b, shared, round(jaccard, 9) as jaccard from edges")
def jaccard_edges(spark, sf):
    return _classes(spark, sf)[2].select("a", "b", "shared", F.round("jaccard", 9).alias("jaccard"))


@query(f"""with {EDGES} select a, b, round(shared / na, 9) as in_a, round(shared / nb, 9) as in_b, round(greatest(shared / na, shared / nb), 9) as max_containment,
 round((shared / na + shared / nb) / 2, 9) as average_containment, round(-ln(2 * jaccard / (1 + jaccard)), 9) as mash from edges""")
def containment_edges(spark, sf):
    e = similarity.containment(_classes(spark, sf)[2])
    cols = ("in_a", "in_b", "max_containment", "average_containment")
    return e.select("a", "b", *(F.round(c, 9).alias(c) for c in cols), F.round(F.col("mash") + 0.0, 9).alias("mash"))


@query(f"with recursive {COVER} select id as class_id, size, degree from deg")
def node_degree(spark, sf):
    _, members, edges = _classes(spark, sf)
    return cover.degrees(members, edges)


@query(f"with recursive {COVER} select id, degree, row_number() over (order by degree desc, id) as rk from deg")
def greedy_rank(spark, sf):
    _, members, edges = _classes(spark, sf)
    d = cover.degrees(members, edges).select(F.col("class_id").alias("id"), "degree", (-F.col("degree")).alias("neg"))
    return compose.positions(d, "neg", "id").select("id", "degree", (F.col("pos") + 1).alias("rk"))


@query(f"with recursive {COVER} select distinct representative from clusters")
def greedy_reps(spark, sf):
    return _clusters(spark, sf).select("representative").distinct()


@query(f"with recursive {COVER} select representative, member from clusters")
def greedy_clusters(spark, sf):
    return _clusters(spark, sf)


@query(f"with recursive {COVER} select member as genome, case when member = representative then 'representative' else 'contained' end as status from clusters")
def genome_status(spark, sf):
    return cover.statuses(_clusters(spark, sf))


@query(f"""with recursive {COVER} select representative, count(*) filter (member != representative) as num_contained,
 coalesce(list(member order by member) filter (member != representative), []) as contained from clusters group by representative""")
def cluster_summary(spark, sf):
    return compose.summary(_clusters(spark, sf))


@query(f"with recursive {COVER} select representative, member, (representative = member) as is_self from clusters")
def self_edges(spark, sf):
    return _clusters(spark, sf).select("representative", "member", (F.col("representative") == F.col("member")).alias("is_self"))


@query(f"with recursive {COVER} select representative, member from clusters where representative != member")
def unpack_clusters(spark, sf):
    return _clusters(spark, sf).where("representative != member")


@query("select doc_id, min(doc_id) over (partition by md5(text), text) as class_id from documents where text is not null")
def exact_dup_clusters(spark, sf):
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", F.md5("text").alias("m"), F.xxhash64("text").alias("x"))
    return d.join(d.groupBy("m", "x").agg(F.min("doc_id").alias("class_id")), ["m", "x"]).select("doc_id", "class_id")


@query("""select accession, case when n > 1000 and n % 1000 = 1 and pos = n - 1 then pos // 1000 - 1 else pos // 1000 end as chunk
 from (select accession, row_number() over (order by accession) - 1 as pos, count(*) over () as n from (select distinct accession from genomes where accession is not null))""")
def chunk_assign(spark, sf):
    g = table(spark, sf, "genomes").where("accession is not null").select("accession").distinct()
    return compose.chunks(g, 1000, "accession").select("accession", "chunk")


@query()
def chunked_derep(spark, sf):
    everyone = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return dereplicate.chunked(_sketch(spark, sf), everyone, 400, T).clusters


@query()
def target_reps_search(spark, sf):
    """The threshold for as many representatives as 95 percent of the classes, with the trace of the search."""
    _, members, edges = _classes(spark, sf)
    want = int(members.select("id").distinct().count() * 0.95)
    t, n, trace = dereplicate.search_target(edges, members, want)
    return spark.createDataFrame([(i, a, b, a == t) for i, (a, b) in enumerate(trace)], "step int, threshold double, representatives bigint, chosen boolean")


@query(" union all ".join(f"select * from (with recursive {COVER.replace('>= 0.8', f'>= {t}')} select {t}::double as threshold, count(distinct representative) as n from clusters)" for t in (0.8, 0.9, 0.95)))
def reps_per_threshold(spark, sf):
    _, members, edges = _classes(spark, sf)
    everyone = cut(table(spark, sf, "documents").select(F.col("doc_id").alias("id")))
    out = None
    for t in (0.8, 0.9, 0.95):
        c = dereplicate.cover_edges(members, cut(edges.where(F.col("jaccard") >= t)), everyone)
        row = c.agg(F.lit(t).alias("threshold"), F.count_distinct("representative").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


_STAGES = f"""
links as (select stage, recorded_at, link_id, {acc('representative')} as r, {acc('member')} as m from derep_clusters),
last as (select stage, m, arg_max(r, (recorded_at, link_id)) as r from links where r is not null and m is not null group by stage, m)
"""


def _stage(spark, sf, stage):
    """The last representative each member was given in a stage."""
    d = table(spark, sf, "derep_clusters").where(F.col("stage") == stage).select(
        names.accession_of(F.col("representative")).alias("representative"), names.accession_of(F.col("member")).alias("member"), "recorded_at", "link_id"
    ).dropna(subset=["representative", "member"])
    return d.groupBy("member").agg(F.max_by("representative", F.struct("recorded_at", "link_id")).alias("representative")).select("representative", "member")


@query(f"""with {_STAGES},
s1 as (select r, m from last where stage = 1 union select r, r from last where stage = 1), s2 as (select r, m from last where stage = 2 and r != m)
select distinct coalesce(s2.r, s1.r) as representative, s1.m as member from s1 left join s2 on s2.m = s1.r""")
def two_stage_compose(spark, sf):
    return compose.compose(_stage(spark, sf, 1), _stage(spark, sf, 2))


@query(f"""with {_STAGES},
st as (select stage, m as genome, 'contained' as status from last where r != m union select stage, r, 'representative' from last),
s as (select stage, genome, max(status) as status from st group by all)
select g.genome, coalesce(a.status, 'NA') = 'representative' and coalesce(b.status, 'NA') in ('representative', 'NA') as is_rep,
 coalesce(a.status, 'NA') as s1, coalesce(b.status, 'NA') as s2
from (select distinct accession as genome from genomes) g left join s a on a.genome = g.genome and a.stage = 1 left join s b on b.genome = g.genome and b.stage = 2""")
def status_matrix(spark, sf):
    everyone = table(spark, sf, "genomes").select(F.col("accession").alias("genome"))
    return compose.status_matrix(everyone, cover.statuses(_stage(spark, sf, 1)), cover.statuses(_stage(spark, sf, 2)))


@query(f"""with links as (select distinct {acc('representative')} as r, {acc('member')} as m from derep_clusters)
select m as member, count(distinct r) as parents from links where r != m and m is not null group by m having count(distinct r) > 1""")
def members_of_many(spark, sf):
    d = table(spark, sf, "derep_clusters").select(names.accession_of(F.col("representative")).alias("representative"), names.accession_of(F.col("member")).alias("member"))
    return compose.two_parents(d.where("member is not null"))


_CURRENT = """current as (select accession, arg_max(genus, (updated_at, ingested_at, row_id)) as genus from genomes where accession is not null and genus is not null group by accession)"""


def _taxa_of(spark, sf):
    g = table(spark, sf, "genomes").where("genus is not null")
    rows = manifest.latest(g, "accession", "updated_at", "ingested_at", "row_id")
    return rows.select(F.col("accession").alias("name"), names.rank_name(F.col("genus")).alias("genus"))


def _reduce_sql(select_: str) -> str:
    return f"""with {_STAGES},
c0 as (select r as representative, m as member from last where stage = 1 union select r, r from last where stage = 1),
taxa as (select accession as name, arg_max({rank('genus')}, (updated_at, ingested_at, row_id)) as genus, arg_max(genus, (updated_at, ingested_at, row_id)) as g0 from genomes where genus is not null group by accession),
taxa2 as (select accession as name, {rank('genus')} as genus from (select *, row_number() over (partition by accession order by updated_at desc, ingested_at desc, row_id desc) as rn from genomes where genus is not null and accession is not null) where rn = 1),
sizes as (select representative as name, count(*) filter (member != representative) as members from c0 group by all),
sized as (select s.*, t.genus from sizes s left join taxa2 t using (name)),
keep as (select genus, arg_max(name, (members, name)) as keeper from sized where trim(genus) != '' group by genus)
{select_}"""


@query(_reduce_sql("select genus, keeper as name from keep union all select genus, name from sized where coalesce(trim(genus), '') = ''"))
def taxon_keepers(spark, sf):
    c = _stage(spark, sf, 1)
    c = c.unionByName(c.select("representative", F.col("representative").alias("member"))).distinct()
    sizes = c.groupBy(F.col("representative").alias("name")).agg(F.sum((F.col("member") != F.col("representative")).cast("int")).alias("members"))
    return compose.keepers(sizes.join(_taxa_of(spark, sf), "name", "left"), ["genus"])


@query(_reduce_sql("select coalesce(k.keeper, c.representative) as representative, c.member from c0 c join sized s on s.name = c.representative left join keep k on k.genus = s.genus"))
def taxonomy_reduce(spark, sf):
    c = _stage(spark, sf, 1)
    c = cut(c.unionByName(c.select("representative", F.col("representative").alias("member"))).distinct())
    return compose.reduce_by_taxon(c, _taxa_of(spark, sf), ["genus"])


@query(f"""with recursive {COVER},
e as (select a as member, b as representative, jaccard from edges union all select b, a, jaccard from edges),
r as (select distinct representative from clusters)
select member, arg_max(representative, (jaccard, -representative)) as representative, round(max(jaccard), 9) as score
from e where representative in (select representative from r) and member not in (select representative from r) group by member""")
def best_edge_membership(spark, sf):
    _, members, edges = _classes(spark, sf)
    reps = cut(dereplicate.cover_edges(members, edges).select(F.col("representative").alias("id")).distinct())
    e = edges.select("a", "b", F.col("jaccard").alias("score"))
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    # the order of edges is by their representative
    found = compose.best_edges(both.withColumn("ord", F.col("b")).join(reps.withColumnRenamed("id", "b"), "b", "left_semi"), reps, T)
    return found.select("member", "representative", F.round("score", 9).alias("score"))


_NUM = "try_cast(trim({0}) as double)"


@query(f"""with q as (select qc_id, try_cast(genome_length as double) as l, try_cast(completeness as double) as c, try_cast(contamination as double) as x from genome_information)
select qc_id, list_filter([case when l < 5000 then 'length' end, case when c < 75 then 'completeness' end, case when not isnan(x) and x > 25 then 'contamination' end], lambda r: r is not null) as reasons from q""")
def qc_reject_reasons(spark, sf):
    q = table(spark, sf, "genome_information")
    return q.select("qc_id", select.reject_reasons(F.col("genome_length"), F.col("completeness"), F.col("contamination")).alias("reasons"))


_QC = f"""with {_STAGES},
st as (select m as genome, 0 as rep from last where stage = 1 and r != m union all select r, 1 from last where stage = 1),
placed as (select genome, case when max(rep) = 1 then 'representative' else 'contained' end as status from st group by genome),
bad as (select distinct {acc('genome')} as genome from genome_information where try_cast(centrality as double) = 0),
known as (select distinct accession as genome from genomes where accession is not null)
"""


@query(_QC + "select genome, status from placed union all select genome, 'fail_qc' from bad where genome is not null and genome not in (select genome from placed) "
       "union all select genome, 'contained' from known where genome not in (select genome from placed) and genome not in (select genome from bad where genome is not null)")
def qc_status(spark, sf):
    """A genome that no cluster holds and whose centrality is 0 fails; others without a place are contained."""
    q = table(spark, sf, "genome_information").where(F.col("centrality").try_cast("double") == 0)
    failed = q.select(names.accession_of(F.col("genome")).alias("genome"))
    everyone = table(spark, sf, "genomes").select(F.col("accession").alias("genome"))
    return cover.statuses(_stage(spark, sf, 1), failed, everyone)


_SUFFIX = "'([.]fasta[.]gz|[.]fasta|[.]fa|[.]fna|[.]fas)$'"


@query(f"""with f as (select distinct filename as name from genomes where filename is not null), st as (select regexp_replace(name, {_SUFFIX}, '') as s, min(name) as name from f group by 1),
l as (select distinct member as label, regexp_replace(member, '^.*/', '') as b from derep_clusters where member is not null)
select label, coalesce(f.name, st.name, b) as name from l left join f on f.name = b left join st on st.s = regexp_replace(b, {_SUFFIX}, '')""")
def label_match(spark, sf):
    files = table(spark, sf, "genomes").select(F.col("filename").alias("name")).where("name is not null").distinct()
    return compose.match_labels(table(spark, sf, "derep_clusters").select(F.col("member").alias("label")).where("label is not null"), files)


@query(f"""with {_STAGES}, two as (select r, m from last where stage = 2 and r != m), one as (select r, m from last where stage = 1 and r != m),
e as (select r, m from two union select two.r, one.m from two join one on one.r = two.m union select two.r, one.m from two join one on one.r = two.r)
select r as representative, list(m order by m) as members from (select distinct r, m from e where r != m) group by r""")
def reuse_rule(spark, sf):
    return compose.reused(_stage(spark, sf, 1), _stage(spark, sf, 2))
