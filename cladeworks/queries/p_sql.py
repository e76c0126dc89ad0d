"""SQL of the p-queries of the core."""

from __future__ import annotations

from .base import rank, species

TAXA = f"(select *, {rank('genus')} as g, {species('species', 'genus')} as s from genomes)"
SQL = {
    "p3_found": f"select g as genus, s as species from {TAXA} where g is not null and s is not null group by g, s having count(*) >= 0.02 * (select count(*) from genomes)",
    "p3_taxa": f"""select g as genus, s as species, count(*) as n_rows, count(*) filter (is_outgroup) as n_outgroup, count(*) filter (lower(trim(derep_status)) = 'contained') as n_contained,
 epoch_us(min(updated_at)) as first_update, epoch_us(max(updated_at)) as last_update from {TAXA} where g is not null and s is not null group by g, s""",
}
_RECORDS = """lines as (select line_id, report::json as j from virus_reports where json_valid(report) and json_type(report) = 'OBJECT'),
pages as (select line_id, case when json_exists(j, '$.reports') then json_extract(j, '$.reports[*]') else [j] end as r from lines),
recs as (select line_id, unnest(range(len(r)))::int as record_pos, unnest(r) as x from pages),
r2 as (select line_id, record_pos, x, coalesce(x->>'$.virus.taxId', x->>'$.virus.tax_id', '') as taxid,
 coalesce(case when json_type(x, '$.isolate') = 'OBJECT' then x->>'$.isolate.name' else x->>'$.isolate' end, '') as isolate, coalesce(nullif(x->>'$.segment', ''), 'ANONYMOUS') as segment from recs)"""
SQL["p5_records"] = f"with {_RECORDS} select line_id, record_pos, taxid, isolate, segment from r2"
SQL["p5_found"] = f"""with {_RECORDS},
lin as (select r2.*, unnest(range(len(json_extract(x, '$.virus.lineage[*]'))))::int as child_pos, unnest(json_extract(x, '$.virus.lineage[*]')) as y from r2),
gen as (select line_id, record_pos, taxid, isolate, segment, unnest(range(len(json_extract(x, '$.annotation.genes[*]'))))::int as parent_pos, unnest(json_extract(x, '$.annotation.genes[*]')) as y from r2),
cl as (select * exclude (y), case when json_type(y, '$.cds') = 'OBJECT' then [json_extract(y, '$.cds')] else json_extract(y, '$.cds[*]') end as c from gen),
cds as (select * exclude (c), unnest(range(len(c)))::int as child_pos, unnest(c) as z from cl)
select line_id, record_pos, taxid, isolate, segment, 'lineage' as child, -1 as parent_pos, child_pos, y->>'$.name' as child_key from lin where coalesce(y->>'$.name', '') != ''
union all select line_id, record_pos, taxid, isolate, segment, 'cds', parent_pos, child_pos, coalesce(z->>'$.proteinAccession', z->>'$.protein_accession') from cds where coalesce(z->>'$.proteinAccession', z->>'$.protein_accession', '') != ''"""
