"""Queries over the virus reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import compose, nested, select, viral
from ..plans import viral as plan
from ..session import cut, table
from .base import query
from .p_sql import _RECORDS


def _token(x: str) -> str:
    return f"coalesce(nullif(regexp_replace(replace(replace(trim({x}), ' ', '-'), '_', '-'), '[^A-Za-z0-9.-]', '', 'g'), ''), 'NA')"


def _norm(x: str) -> str:
    return f"lower(replace(replace(replace({x}, '-', ''), '_', ''), ' ', ''))"


_VIRUS = f"""{_RECORDS},
v1 as (select line_id as id, record_pos, coalesce(x->>'$.accession', '') as accession, taxid, coalesce(nullif(x->>'$.virus.organismName', ''), x->>'$.virus.organism_name', '') as organism,
 coalesce(try_cast(x->>'$.length' as bigint), 0) as length, upper(coalesce(x->>'$.completeness', '')) as completeness, segment, isolate,
 list_filter(coalesce(list_transform(json_extract(x, '$.virus.lineage[*]'), lambda y: coalesce(y->>'$.name', '')), []), lambda n: n != '') as n from r2),
v2 as (select *, coalesce(nullif(organism, ''), n[-1], '') as sp from v1),
v3 as (select *, list_filter(n, lambda y: not contains(y, ' ') and ends_with(lower(y), 'virus') and y != sp) as one from v2),
vr as (select id, record_pos, accession, taxid, organism, {_token("coalesce(list_filter(n, lambda y: ends_with(lower(y), 'viridae'))[1], '')")} as family,
 {_token("coalesce(one[-1], case when not contains(n[-2], ' ') then n[-2] end, '')")} as genus, {_token('sp')} as species, length, completeness, segment, isolate from v3)"""


def _nodes(spark, sf):
    return cut(nested.report_nodes(table(spark, sf, "virus_reports")))


def _records(spark, sf):
    return cut(viral.virus_records(_nodes(spark, sf)))


@query(f"with {_VIRUS} select * from vr")
def virus_records(spark, sf):
    return viral.virus_records(_nodes(spark, sf))


@query(f"""with {_VIRUS} select species, count(*) as num, min(length) as seq_min, max(length) as seq_max, trunc(median(length))::bigint as seq_med, trunc(avg(length))::bigint as seq_mean,
 arg_min(organism, id * 1000000 + record_pos) as description from vr group by species""")
def virus_length_stats(spark, sf):
    r = _records(spark, sf).withColumn("o", F.col("id") * 1_000_000 + F.col("record_pos"))
    return select.length_stats(r, "species", "length", "organism", "o")


@query(f"with {_VIRUS}, m as (select trunc(median(length))::bigint as m from vr group by species) select trunc(mid * 0.9)::bigint as lo, trunc(mid * 1.1)::bigint as hi from (select median(m)::double as mid from m)")
def virus_length_band(spark, sf):
    return select.length_band(_records(spark, sf), "species", "length")


@query(f"with {_VIRUS}, m as (select species, trunc(median(length))::bigint as m from vr where length > 0 group by species) select id, record_pos from vr join m using (species) where length between m * 0.9::double and m * 1.1::double")
def virus_near_median(spark, sf):
    return viral.near_median(_records(spark, sf), "species", "length", 0.1).select("id", "record_pos")


@query(f"""with {_VIRUS}, g as (select isolate, count(*) as n, string_agg(accession, '' order by -length, id, record_pos) as seq, min(accession) as a from vr where trim(isolate) != '' group by isolate)
select case when n > 1 then 'iso-' || {_token('isolate')} else a end as accession, n::int as n_segments, seq from g union all select accession, 1, accession from vr where trim(isolate) = ''""")
def virus_isolates(spark, sf):
    """Segments of one isolate joined, longest first, by their accessions."""
    r = _records(spark, sf).withColumn("o", F.struct("id", "record_pos"))
    return select.segments(r, "isolate", "length", "o", "accession", "accession")


_ENTRIES = f"""{_RECORDS},
le as (select line_id as id, record_pos, unnest(json_extract(x, '$.virus.lineage[*]')) as y from r2),
ent as (select id, record_pos, y->>'$.name' as name, coalesce(nullif(y->>'$.tax_id', ''), y->>'$.taxId') as taxid, y->>'$.rank' as rank from le where coalesce(y->>'$.name', '') != '')"""


@query(f"with {_ENTRIES} select rank, name, count(*) as n, count(taxid) as with_id from ent where rank is not null group by all")
def virus_rank_summary(spark, sf):
    return viral.rank_summary(viral.lineage_entries(_nodes(spark, sf)))


_WIDE = ", ".join(f"coalesce(min(name) filter (rank = '{r}'), '') as \"{r}\", coalesce(arg_min(taxid, name) filter (rank = '{r}'), '') as \"{r}_taxid\"" for r in ("order", "family", "genus", "species"))


@query(f"with {_ENTRIES} select id, record_pos, {_WIDE} from ent where rank in ('order', 'family', 'genus', 'species') group by id, record_pos")
def virus_wide_lineage(spark, sf):
    return viral.wide_lineage(viral.lineage_entries(_nodes(spark, sf)), ["id", "record_pos"], ["order", "family", "genus", "species"])


@query(f"""with {_VIRUS}, kept as (select distinct species from vr where completeness = 'COMPLETE' and segment = 'L'), big as (select species from vr where species not in (select species from kept) group by species having count(*) >= 5),
md as (select median(length) as mid from vr where length > 0),
p as (select vr.*, row_number() over (partition by species order by accession, id, record_pos) as n from vr, md where species in (select species from big) and length between mid * 0.85::double and mid * 1.15::double)
select species, accession from p where n <= 3""")
def virus_outgroup_draft(spark, sf):
    """Three per species that is not kept, of like length."""
    r = _records(spark, sf)
    mid = r.where("length > 0").agg(F.median("length")).first()[0] or 0.0
    pool = select.pool(r, r.where("completeness = 'COMPLETE' and segment = 'L'"), "species", 5)
    return viral.outgroup_draft(pool.withColumn("o", F.struct("accession", "id", "record_pos")), "species", "length", mid, order="o").select("species", "accession")


@query(f"with {_VIRUS} select id, record_pos from vr where lower(replace(replace(replace(genus, '-', ''), '_', ''), ' ', '')) = (select lower(replace(replace(replace(min(genus) filter (genus != 'NA'), '-', ''), '_', ''), ' ', '')) from vr)")
def virus_select(spark, sf):
    r = _records(spark, sf)
    first = r.where("genus != 'NA'").agg(F.min("genus")).first()[0] or "-"
    return r.where(select.matches({"genus": [first]}, r.columns)).select("id", "record_pos")


@query(f"with {_VIRUS}, g as (select distinct accession from vr) select accession, count(*) as n from vr group by accession having count(*) > 1")
def virus_duplicate_ids(spark, sf):
    return _records(spark, sf).groupBy("accession").agg(F.count("*").alias("n")).where("n > 1")


# ---- whole selections; an accession stands for its sequence


def _sequences(r):
    return r.where("accession != ''").groupBy("accession").agg(F.min(F.col("id") * 1_000_000 + F.col("record_pos")).alias("ord")).select(
        "ord", "accession", F.concat("accession", F.lit(" description")).alias("description"), F.repeat("accession", 3).alias("seq"))


_TOP_GENUS = "(select genus as g from vr where genus != 'NA' group by genus order by count(*) desc, genus limit 1)"
_KEPT = f"""fits as (select vr.* from vr, {_TOP_GENUS} f where {_norm('genus')} = {_norm('f.g')}),
band as (select trunc(median(m) * 0.9::double)::bigint as lo, trunc(median(m) * (1 + 10 / 100.0::double))::bigint as hi from (select trunc(median(length))::bigint as m from fits where length > 0 group by species)),
seqs as (select distinct accession from vr where accession != '')"""


@query(f"with {_VIRUS}, {_KEPT} select accession, family || '_' || genus || '_' || species || '_' || accession || '.fasta' as filename, family, genus, species, repeat(accession, 3) as seq from fits, band where length between lo and hi and accession in (select accession from seqs)")
def viral_selection(spark, sf):
    """Records of the genus with most records, with a sequence and a length in the band."""
    r = _records(spark, sf)
    top = r.where("genus != 'NA'").groupBy("genus").count().orderBy(F.desc("count"), "genus").first()
    p = plan.Select({"genus": [top["genus"] if top else "-"]}, no_outgroup=True)
    return plan.select_records(r.withColumn("ord", F.col("id") * 1_000_000 + F.col("record_pos")), _sequences(r), p).genomes


_EDGES = "(select 's' || l_suppkey as a, 'p' || l_partkey as b, l_quantity::double * 2 as score, l_discount::double * 1000 as fa, l_tax::double * 1000 as fb, l_orderkey * 10 + l_linenumber as ord from lineitem)"


@query(f"select b as member, arg_max(a, (score, -ord)) as representative, max(score) as score from {_EDGES} where score >= 90 and fa >= 50 and fb >= 50 group by b")
def aligned_membership(spark, sf):
    """The best representative of each member over edges that cover half of both ends."""
    li = table(spark, sf, "lineitem")
    e = li.select(
        F.concat(F.lit("s"), "l_suppkey").alias("a"), F.concat(F.lit("p"), "l_partkey").alias("b"), (F.col("l_quantity").cast("double") * 2).alias("score"),
        (F.col("l_discount").cast("double") * 1000).alias("fa"), (F.col("l_tax").cast("double") * 1000).alias("fb"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"),
    )
    reps = li.select(F.concat(F.lit("s"), "l_suppkey").alias("id")).distinct()
    return compose.best_edges(e, reps, 90, 50).select("member", "representative", "score")
