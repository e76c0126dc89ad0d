"""Queries of selection, parsing, lengths, manifest and control, over all tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import manifest, select
from ..session import table
from .base import acc, query, rank, species

G = "genomes"
_CUR_SQL = """cur as (select * from (select *, row_number() over (partition by accession order by updated_at desc, ingested_at desc, row_id desc) as rn
 from genomes where accession is not null) where rn = 1)"""


def _current(spark, sf):
    return manifest.latest(table(spark, sf, G), "accession", "updated_at", "ingested_at", "row_id")


# ---- names and taxa


@query(f"select row_id, {acc('representative')} as carried, {acc('filename')} as own from genomes")
def name_accessions(spark, sf):
    g = table(spark, sf, G)
    return g.select("row_id", names.accession_of(F.col("representative")).alias("carried"), names.accession_of(F.col("filename")).alias("own"))


_STEM = "regexp_replace(regexp_replace(trim(filename), '^.*/', ''), '([.]fasta[.]gz|[.]fasta|[.]fa|[.]fna|[.]fas)$', '')"


@query(f"""with p as (select row_id, {_STEM} as stem, string_split({_STEM}, '_') as t from genomes where filename is not null)
select row_id, case when len(t) >= 4 then t[1] else '' end as family, case when len(t) >= 4 then t[2] else '' end as genus, case when len(t) >= 4 then t[3] else '' end as species,
 case when len(t) >= 4 then array_to_string(t[4:], '_') else stem end as accession, case when len(t) >= 4 then stem || '.fasta' end as again from p""")
def name_roundtrip(spark, sf):
    g = table(spark, sf, G).where("filename is not null").select("row_id", names.parse_file_name(F.col("filename")).alias("p"))
    again = F.when(F.col("family") != "", names.file_name(*(F.col(c) for c in ("family", "genus", "species", "accession"))))
    return g.select("row_id", "p.*").withColumn("again", again)


@query(f"select row_id, {rank('family')} as family, {rank('genus')} as genus, {species('species', 'genus')} as species from genomes")
def taxon_spellings(spark, sf):
    return table(spark, sf, G).select(
        "row_id", names.rank_name(F.col("family")).alias("family"), names.rank_name(F.col("genus")).alias("genus"),
        names.species_name(F.col("species"), F.col("genus")).alias("species"),
    )


def _part(letter: str) -> str:
    """SQL of a rank of a lineage string: its last part with that letter, without rank prefixes."""
    return f"regexp_replace(coalesce(list_filter(p, lambda x: starts_with(x, '{letter}__'))[-1], ''), '^(\\s*[A-Za-z]__)+', '')"


def _dashed(x: str) -> str:
    return f"replace(replace({x}, ' ', ''), '_', '-')"


@query(f"""with t as (select row_id, string_split('f__' || coalesce(family, '') || ';g__' || coalesce(genus, '') || ';s__' || coalesce(genus, '') || ' ' || coalesce(species, ''), ';') as p from genomes),
u as (select row_id, {_part('d')} as d, {_part('p')} as ph, {_part('c')} as c, {_part('o')} as o, {_part('f')} as f, {_part('g')} as g, regexp_replace({_part('s')}, '(^|\\s)(\\s*[A-Za-z]__)+', '\\1', 'g') as s from t)
select row_id, d as domain, ph as phylum, c as "class", o as "order", {_dashed('f')} as family, {_dashed('g')} as genus, {_dashed("case when g = '' then s else replace(s, g, '') end")} as species from u""")
def lineage_parse(spark, sf):
    """Ranked lineage strings as a taxonomy table writes them, taken apart again."""
    f, g, s = (F.coalesce(c, F.lit("")) for c in ("family", "genus", "species"))
    rows = table(spark, sf, G)
    raw = F.concat(F.lit("f__"), f, F.lit(";g__"), g, F.lit(";s__"), g, F.lit(" "), s)
    return rows.select("row_id", text.lineage_struct(raw).alias("t")).select("row_id", "t.*")


@query("""select row_id, 'g__' || upper(substr(n, 1, 1)) || substr(n, 2) as taxon from (select row_id, replace(trim(genus), '_', ' ') as n from genomes)""")
def taxon_strings(spark, sf):
    return table(spark, sf, G).select("row_id", text.taxon_string("genus", F.col("genus")).alias("taxon"))


@query("""select p_partkey, coalesce(nullif(regexp_replace(replace(replace(trim(p_name), ' ', '-'), '_', '-'), '[^A-Za-z0-9.-]', '', 'g'), ''), 'NA') as token,
 lower(replace(replace(replace(p_type, '-', ''), '_', ''), ' ', '')) as norm, replace(replace(replace(p_name, ' ', '_'), ',', '_'), ':', '_') as label from part""")
def token_sanitize(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", text.token(F.col("p_name")).alias("token"), text.norm(F.col("p_type")).alias("norm"), text.tree_label(F.col("p_name")).alias("label"))


@query("""select doc_id, split_part(split_part(h, ']', 1), '| ', -1) as genome_id, split_part(split_part(split_part(h, ']', 1), '| ', -1), '.', 1) as taxid,
 trim(split_part(split_part(h, '[', 2), ' | ', 1)) as species, split_part(h, ' ', 1) as name from (select doc_id, 'x | ' || doc_id || '.' || (n_chars % 7) || '] [' || source || ' | tag' as h from documents)""")
def header_parse(spark, sf):
    d = table(spark, sf, "documents")
    h = F.concat(F.lit("x | "), F.col("doc_id").cast("string"), F.lit("."), (F.col("n_chars") % 7).cast("string"), F.lit("] ["), "source", F.lit(" | tag"))
    return d.select("doc_id", text.header_struct(h).alias("p")).select("doc_id", "p.*")


@query("""with t as (select row_id, [coalesce(family, ''), coalesce(genus, '') || 'virus', coalesce(genus, '') || ' ' || coalesce(species, '')] as l from genomes),
u as (select row_id, list_filter(l, lambda n: n != '') as n from t), v as (select row_id, n, n[-1] as sp, list_filter(n, lambda x: not contains(x, ' ') and ends_with(lower(x), 'virus') and x != n[-1]) as one from u)
select row_id, coalesce(nullif(regexp_replace(replace(replace(trim(coalesce(list_filter(n, lambda x: ends_with(lower(x), 'viridae'))[1], '')), ' ', '-'), '_', '-'), '[^A-Za-z0-9.-]', '', 'g'), ''), 'NA') as family,
 coalesce(nullif(regexp_replace(replace(replace(trim(coalesce(one[-1], case when not contains(n[-2], ' ') then n[-2] end, '')), ' ', '-'), '_', '-'), '[^A-Za-z0-9.-]', '', 'g'), ''), 'NA') as genus,
 coalesce(nullif(regexp_replace(replace(replace(trim(sp), ' ', '-'), '_', '-'), '[^A-Za-z0-9.-]', '', 'g'), ''), 'NA') as species from v""")
def lineage_classify(spark, sf):
    f, g, s = (F.coalesce(c, F.lit("")) for c in ("family", "genus", "species"))
    lineage = F.array(f, F.concat(g, F.lit("virus")), F.concat(g, F.lit(" "), s))
    return table(spark, sf, G).select("row_id", text.classify(lineage, F.lit("")).alias("c")).select("row_id", "c.*")


@query("select s_suppkey, case when s_acctbal / 10000 <= 1 then s_acctbal / 10000 * 100 else s_acctbal / 10000 end as percent from supplier")
def percent_normalise(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", text.as_percent(F.col("s_acctbal") / 10000).alias("percent"))


@query("""select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def props_parse(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("""select p_partkey, reverse(translate(substr(regexp_replace(upper(p_name), '[^ACGT]', '', 'g'), 1, 40), 'ACGT', 'TGCA')) as rc from part""")
def reverse_complements(spark, sf):
    seq = F.regexp_replace(F.upper("p_name"), "[^ACGT]", "")
    return table(spark, sf, "part").select("p_partkey", text.reverse_complement(seq).alias("rc"))


@query("""select p_partkey, list_filter(list_transform(string_split(p_type, ' '), lambda v: lower(trim(v))), lambda v: v != '') as options,
 try_cast(regexp_extract(p_brand, '([0-9]+)', 1) as int) as major from part""")
def option_parse(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", text.option_list(F.replace("p_type", F.lit(" "), F.lit(","))).alias("options"), text.version_struct(F.col("p_brand"))["major"].alias("major"))


# ---- selection


def _rows(spark, sf):
    return table(spark, sf, G).select(
        F.col("row_id").alias("ord"), "accession", names.rank_name(F.col("family")).alias("family"), names.rank_name(F.col("genus")).alias("genus"),
        names.species_name(F.col("species"), F.col("genus")).alias("species"), (F.lower(F.trim("derep_status")) == "representative").alias("is_rep"),
    )


#: The target of the selection queries is the genus of the first complete row, named at run time.
_FIRST = f"""rows as (select row_id as ord, accession, {rank('family')} as family, {rank('genus')} as genus, {species('species', 'genus')} as species, coalesce(lower(trim(derep_status)) = 'representative', false) as is_rep from genomes),
first as (select genus as g from rows where family is not null and genus is not null order by ord limit 1),
tgt as (select family, genus, species from rows, first where genus = g and family is not null order by ord limit 1)"""


def _target(rows):
    first = rows.where("family is not null and genus is not null").orderBy("ord").first()
    return select.resolve_target(rows.where("family is not null"), genus=first["genus"] if first else "-")


@query(f"with {_FIRST} select r.ord, r.accession from rows r join tgt t on r.family = t.family and r.genus = t.genus")
def taxon_select(spark, sf):
    rows = _rows(spark, sf)
    return select.select_taxon(rows, _target(rows), "genus").select("ord", "accession")


@query(f"with {_FIRST} select r.ord, r.accession from rows r join tgt t on r.family = t.family and r.genus = t.genus order by r.ord limit 25")
def taxon_select_limit(spark, sf):
    rows = _rows(spark, sf)
    return select.select_taxon(rows, _target(rows), "genus", 25).select("ord", "accession")


@query(f"""with {_FIRST}, sel as (select r.accession from rows r join tgt t on r.family = t.family and r.genus = t.genus)
select r.accession, r.genus from rows r join tgt t on r.family = t.family where r.genus != t.genus and trim(r.genus) != '' and r.is_rep and r.accession not in (select accession from sel) order by r.ord limit 1""")
def outgroup_by_rank(spark, sf):
    rows = _rows(spark, sf)
    t = _target(rows)
    return select.pick_outgroup(rows, t, "genus", select.select_taxon(rows, t, "genus"), rep=F.col("is_rep")).select("accession", "genus")


@query(f"""with r as (select {rank('family')} as family, {rank('genus')} as genus from genomes)
select 'family' as level, family as name, count(*) as n from r where family is not null group by family union all select 'genus', genus, count(*) from r where genus is not null group by genus""")
def taxon_summary(spark, sf):
    r = table(spark, sf, G).select(names.rank_name(F.col("family")).alias("family"), names.rank_name(F.col("genus")).alias("genus"))
    return r.groupingSets([[F.col("family")], [F.col("genus")]], "family", "genus").agg(F.count("*").alias("n"), F.grouping("family").alias("g")).select(
        F.when(F.col("g") == 0, "family").otherwise("genus").alias("level"), F.when(F.col("g") == 0, F.col("family")).otherwise(F.col("genus")).alias("name"), "n"
    ).where("name is not null")


@query(f"select count(distinct {rank('family')}) as families, count(distinct {rank('genus')}) as genera, count(distinct {rank('genus')} || ' ' || {species('species', 'genus')}) as species from genomes")
def taxa_per_level(spark, sf):
    g = names.rank_name(F.col("genus"))
    r = table(spark, sf, G).select(names.rank_name(F.col("family")).alias("f"), g.alias("g"), F.concat(g, F.lit(" "), names.species_name(F.col("species"), F.col("genus"))).alias("s"))
    return r.agg(F.count_distinct("f").alias("families"), F.count_distinct("g").alias("genera"), F.count_distinct("s").alias("species"))


@query("""select p_partkey from part where (lower(replace(replace(replace(p_brand, '-', ''), '_', ''), ' ', '')) in ('brand#11', 'brand#23')) and contains(lower(replace(replace(replace(p_type, '-', ''), '_', ''), ' ', '')), 'a')""")
def record_match(spark, sf):
    """AND over levels, OR within one: genus among two brands, serotype a part of the type."""
    p = table(spark, sf, "part").withColumnsRenamed({"p_brand": "genus", "p_type": "organism"})
    return p.where(select.matches({"genus": ["Brand #11", "brand_#23"], "serotype": ["A"]}, p.columns)).select("p_partkey")


@query("select p_partkey from part where p_size = 7")
def custom_match(spark, sf):
    p = table(spark, sf, "part")
    return p.where(select.matches({"custom": ["p_size:7", "ignored"]}, p.columns)).select("p_partkey")


@query("select p_partkey from part where p_size = 7 or p_size = 9")
def custom_match_any(spark, sf):
    p = table(spark, sf, "part")
    return p.where(select.matches({"custom": ["p_size:7", "p_size: 9"]}, p.columns, any_custom=True)).select("p_partkey")


# ---- lengths, tags, caps


@query("""select source, count(*) as num, min(n_chars) as seq_min, max(n_chars) as seq_max, trunc(median(n_chars))::bigint as seq_med, trunc(avg(n_chars))::bigint as seq_mean,
 arg_min(lang, doc_id) filter (lang is not null) as description from documents where n_chars is not null group by source""")
def length_stats(spark, sf):
    return select.length_stats(table(spark, sf, "documents").withColumn("o", F.when(F.col("lang").isNotNull(), F.col("doc_id"))), "source", "n_chars", "lang", "o")


def _band(mid: str, frm: str) -> str:
    return f"select trunc(mid * 0.9)::bigint as lo, trunc(mid * (1 + 10 / 100.0))::bigint as hi from (select {mid} as mid from {frm})"


_MED = "(select source, trunc(median(n_chars))::bigint as m, avg(n_chars) as a from documents where n_chars is not null group by source)"


@query(f"select trunc(mid * 0.9)::bigint as lo, trunc(mid * 1.1)::bigint as hi from (select median(m)::double as mid from {_MED})")
def length_band_median(spark, sf):
    return select.length_band(table(spark, sf, "documents"), "source", "n_chars")


@query("select trunc(mid * 0.9)::bigint as lo, trunc(mid * 1.1)::bigint as hi from (select avg(n_chars) as mid from documents where n_chars is not null)")
def length_band_mean(spark, sf):
    return select.length_band(table(spark, sf, "documents"), "source", "n_chars", method="mean")


@query(f"select trunc(mid * 0.9)::bigint as lo, trunc(mid * 1.1)::bigint as hi from (select avg(a) as mid from {_MED})")
def length_band_mean_of_means(spark, sf):
    return select.length_band(table(spark, sf, "documents"), "source", "n_chars", method="mean_of_means")


@query(f"with b as (select trunc(mid * 0.9)::bigint as lo, trunc(mid * 1.1)::bigint as hi from (select median(m)::double as mid from {_MED})) select doc_id from documents, b where n_chars between lo and hi")
def length_filter(spark, sf):
    d = table(spark, sf, "documents")
    return select.within(d, select.length_band(d, "source", "n_chars"), "n_chars").select("doc_id")


@query("select doc_id from documents where not contains(coalesce(text, ''), 'GCA_') and not contains(coalesce(text, ''), 'Notes')")
def discard_tags(spark, sf):
    return select.without_tags(table(spark, sf, "documents"), "text", ["GCA_", "Notes"]).select("doc_id")


@query("select o_orderkey, o_custkey from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as n from orders) where n <= 3")
def capped_per_group(spark, sf):
    return select.capped(table(spark, sf, "orders"), "o_custkey", 3, "o_orderdate", "o_orderkey").select("o_orderkey", "o_custkey")


@query("select o_orderkey from (select *, row_number() over (partition by o_orderpriority order by o_orderkey) as n from orders) where n <= 4")
def capped_per_taxid(spark, sf):
    """Four per key, as the viral outgroup draft takes."""
    return select.capped(table(spark, sf, "orders"), "o_orderpriority", 4, "o_orderkey").select("o_orderkey")


@query("""select doc_id from documents where source not in (select source from documents where lang = 'ru' and source is not null) and source in (select source from documents group by source having count(*) >= 5)""")
def outgroup_pool(spark, sf):
    d = table(spark, sf, "documents")
    return select.pool(d, d.where("lang = 'ru'"), "source", 5).select("doc_id")


@query("""select p_name as name, arg_min(p_partkey, p_partkey) as taxid, arg_min(p_type, p_partkey) as level, list(distinct p_brand order by p_brand) as datasets from part where p_name is not null group by p_name""")
def name_dictionary(spark, sf):
    return select.name_dictionary(table(spark, sf, "part").withColumnRenamed("p_name", "name"), "name", "p_partkey", "p_type", "p_brand", "p_partkey")


@query("""with s as (select l_orderkey, l_linenumber, l_quantity, l_returnflag || l_linestatus || l_linenumber::varchar as seq, count(*) over (partition by l_orderkey) as n from lineitem)
select case when n > 1 then 'iso-' || l_orderkey else 'acc' || l_orderkey || '-' || min(l_linenumber) end as accession, n::int as n_segments, string_agg(seq, '' order by -l_quantity, l_linenumber, seq) as seq
from s group by l_orderkey, n""")
def segment_concat(spark, sf):
    d = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("iso"), "l_quantity", "l_linenumber",
        F.concat(F.lit("acc"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("acc"),
        F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("seq"),
    )
    return select.segments(d, "iso", "l_quantity", "l_linenumber", "acc", "seq")


# ---- manifest and ledger


_COLS = "accession, filename, family, genus, species, derep_status, representative"


@query(f"with {_CUR_SQL} select {_COLS} from cur")
def manifest_upsert(spark, sf):
    """The manifest after all writes before 2024, then all later ones."""
    g = table(spark, sf, G)
    order = ("updated_at", "ingested_at", "row_id")
    old = manifest.latest(g.where("updated_at < timestamp'2024-01-01'"), "accession", *order)
    new = g.where("updated_at >= timestamp'2024-01-01'")
    return manifest.upsert(old, new, "accession", *order).select(*_COLS.split(", "))


@query(f"""with {_CUR_SQL}, st as (select {acc('member')} as accession, arg_max({acc('representative')}, (recorded_at, link_id)) as r from derep_clusters where {acc('representative')} is not null group by 1)
select c.accession, case when s.accession is not null then case when s.r = s.accession then 'representative' else 'contained' end else derep_status end as derep_status,
 case when s.accession is not null then s.r else representative end as representative from cur c left join st s on s.accession = c.accession""")
def status_update(spark, sf):
    d = table(spark, sf, "derep_clusters").select(names.accession_of(F.col("member")).alias("accession"), names.accession_of(F.col("representative")).alias("r"), "recorded_at", "link_id")
    s = d.where("r is not null and accession is not null").groupBy("accession").agg(F.max_by("r", F.struct("recorded_at", "link_id")).alias("representative"))
    s = s.withColumn("derep_status", F.when(F.col("representative") == F.col("accession"), "representative").otherwise("contained"))
    return manifest.set_status(_current(spark, sf), s).select("accession", "derep_status", "representative")


@query(f"with {_CUR_SQL} select count(*) filter (not is_outgroup) as genomes, count(*) filter (lower(trim(derep_status)) = 'representative') as representatives, count(*) as everyone from cur")
def manifest_scans(spark, sf):
    c = _current(spark, sf)
    return c.agg(F.count_if(~F.col("is_outgroup")).alias("genomes"), F.count_if(F.lower(F.trim("derep_status")) == "representative").alias("representatives"), F.count("*").alias("everyone"))


@query(f"""with {_CUR_SQL} select accession, coalesce(family, '') as family, coalesce(genus, '') as genus, coalesce(species, '') as species, case when is_outgroup then '1' else '0' end as is_outgroup, coalesce(filename, '') as filename from cur""")
def selection_table(spark, sf):
    from ..sources.tables import selection

    return selection(_current(spark, sf))


CHAIN = ["click", "view", "purchase", "refund", "signup", "login"]
_PLAN = "plan as (select unnest(range(6))::int as ord, unnest(['" + "', '".join(CHAIN) + "']) as stage), got as (select p.ord, p.stage, max(e.ts) as completed from plan p left join events e on e.event_type = p.stage group by all)"


@query(f"with {_PLAN} select ord, stage, completed, coalesce(ord = (select min(ord) from got where completed is null), false) as next from got")
def stage_status(spark, sf):
    return manifest.ledger_status(table(spark, sf, "events"), CHAIN, "event_type", "ts")


@query(f"with {_PLAN} select a.stage, b.stage as upstream from got a join got b on b.ord < a.ord and b.completed > a.completed")
def stale_stages(spark, sf):
    return manifest.stale_stages(table(spark, sf, "events"), CHAIN, "event_type", "ts")


@query("""select n_name as child, r_name as parent, min(n_nationkey) as ord from nation join region on n_regionkey = r_regionkey group by all""")
def edges_once(spark, sf):
    from ..sources.tables import sorted_once

    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    twice = n.unionAll(n).join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"), "n_nationkey")
    return sorted_once(twice, "n_nationkey")


@query(f"""with known as (select distinct accession from genomes) select distinct {acc('member')} as accession from derep_clusters where {acc('member')} is not null and {acc('member')} not in (select accession from known where accession is not null)""")
def missing_genomes(spark, sf):
    from ..sources.tables import accessions

    return accessions(table(spark, sf, "derep_clusters"), "member").join(table(spark, sf, G).select("accession").where("accession is not null"), "accession", "left_anti")


@query("""select source, count(*) filter (contains(text, 'GCA_')) as num, min(n_chars) filter (contains(text, 'GCA_')) as seq_min, max(n_chars) filter (contains(text, 'GCA_')) as seq_max,
 trunc(median(n_chars) filter (contains(text, 'GCA_')))::bigint as seq_med, coalesce(list(distinct accession order by accession) filter (accession is not null), []) as ids from documents group by source""")
def tagged_length_stats(spark, sf):
    """Lengths of the tagged records of each source, and the ids of all its records."""
    tagged = F.when(F.contains("text", F.lit("GCA_")), F.col("n_chars"))
    return table(spark, sf, "documents").groupBy("source").agg(
        F.count_if(F.contains("text", F.lit("GCA_"))).alias("num"), F.min(tagged).alias("seq_min"), F.max(tagged).alias("seq_max"),
        F.median(tagged).cast("bigint").alias("seq_med"), F.sort_array(F.collect_set("accession")).alias("ids"),
    )


@query("select row_id, array_to_string([coalesce(family, ''), coalesce(genus, ''), coalesce(species, '')], ',') as lineage, not is_outgroup as selected from genomes")
def lineage_joined(spark, sf):
    parts = F.array(*(F.coalesce(c, F.lit("")) for c in ("family", "genus", "species")))
    return table(spark, sf, G).select("row_id", F.array_join(parts, ",").alias("lineage"), (~F.col("is_outgroup")).alias("selected"))


@query("select n_nationkey, rtrim(regexp_replace(repeat(n_name, 20), '(.{80})', '\\1\n', 'g'), chr(10)) as wrapped from nation")
def sequence_wrap(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", text.wrap(F.repeat(F.col("n_name"), 20)).alias("wrapped"))
