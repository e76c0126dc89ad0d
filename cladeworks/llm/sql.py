"""The same queries in SQL, where SQL can express them."""

from __future__ import annotations

from ..queries.base import acc, rank, species

_CELLS = f"""placed as (select distinct trim(accession) as accession, {rank('family')} as family, {rank('genus')} as genus, {species('species', 'genus')} as species from genomes),
recs as (select * from placed where accession != '' and family is not null and genus is not null and species is not null),
tgt as (select target_id, lower(trim(scope_rank)) as sr, case when lower(trim(scope_rank)) = 'all' then '' else {rank('scope_name')} end as sn, subset_size as k from subset_targets where subset_size > 0),
inscope as (select t.target_id, t.k, r.* from recs r join tgt t on t.sr = 'all' or (t.sr = 'family' and t.sn = r.family) or (t.sr = 'genus' and t.sn = r.genus))"""
SQL: dict[str, str] = {
    "p1_found": f"""with {_CELLS}, taxa as (select target_id, k, genus, species, count(*) over (partition by target_id) as n from (select distinct target_id, k, genus, species from inscope))
select target_id, genus, species from taxa where k >= n""",
    "p1_subset": f"""with {_CELLS},
g as (select family, genus, row_number() over (partition by family order by md5(genus), genus) as g_no from (select distinct family, genus from recs)),
s as (select family, genus, species, row_number() over (partition by family, genus order by md5(species), species) as s_no from (select distinct family, genus, species from recs)),
ranked as (select *, row_number() over (partition by target_id, family, genus, species order by md5(accession), accession) as pick_rank from inscope),
counted as (select target_id, family, genus, species, count(*) as n from inscope group by target_id, family, genus, species),
cells as (select *, row_number() over (partition by target_id, genus, species order by n desc, family) as again from counted),
sizes as (select target_id, count(distinct genus || ' ' || species) as n_taxa from inscope group by target_id),
ordered as (select r.*, row_number() over (partition by r.target_id order by pick_rank, again, s_no, g_no, md5(r.family), r.family, r.genus, r.species) as place
 from ranked r join cells using (target_id, family, genus, species) join g using (family, genus) join s using (family, genus, species))
select target_id, k as subset_size, n_taxa, accession, family, genus, species, pick_rank from ordered join sizes using (target_id) where place <= k""",
    "p2_found": f"""with recursive known as (select distinct accession as a from genomes where accession is not null),
l as (select accession as x, {acc('representative')} as y from genomes union all select {acc('representative')}, {acc('member')} from derep_clusters),
good as (select distinct x, y from l where x != y and x in (select a from known) and y in (select a from known)),
e as (select x, y from good union select y, x from good),
reach(v, w) as (select x, y from e union select r.v, e.y from reach r join e on e.x = r.w)
select min(w) as group_key, v as accession from reach group by v""",
}


def _survivors(height: str, more: str) -> str:
    def ok(f, test):
        x = f"try_cast(case when regexp_full_match({f}, '\\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*') then trim({f}) end as double)"
        return test.replace("#", f"(case when isfinite({x}) then {x} end)")

    tests = {
        "completeness": "# >= 0 and # <= 100", "contamination": "# >= 0 and # <= 100", "genome_length": "# > 0", "n50": "# > 0", "centrality": "# > 0 and # <= 1",
    }
    values = " union all ".join(f"select qc_id, accession, trust, assessed_at, source, '{f}' as field_name from info where {ok(f, t)}" for f, t in tests.items())
    return f"""with cur as (select * from (select *, row_number() over (partition by accession order by updated_at desc, ingested_at desc, row_id desc) as rn from genomes where accession is not null) where rn = 1),
held as (select accession, {acc('representative')} as rep from cur where lower(trim(derep_status)) = 'contained'),
pairs as (select accession, rep from held where rep != accession and rep in (select accession from cur)),
member as (select accession, rep from pairs union select rep, rep from pairs),
src as (select lower(trim(qc_source)) as source, max(trust) as trust from qc_sources group by 1),
info as (select i.*, {acc('genome')} as accession, s.trust, s.source from genome_information i left join src s on s.source = lower(trim(i.qc_source))),
raw as (select distinct {acc('genome')} as e, lower(trim(qc_source)) as v, assessed_at as t from genome_information where genome is not null and qc_source is not null and assessed_at is not null),
vals as ({values}){more}
select representative, field_name, qc_id from (select m.rep as representative, v.field_name, v.qc_id,
 row_number() over (partition by m.rep, v.field_name order by v.trust desc nulls last, v.assessed_at desc nulls last, {height} v.qc_id) as n
 from vals v join member m on m.accession = v.accession{' left join prec p on p.v = v.src' if more else ''}) where n = 1"""


SQL["p4_found"] = _survivors("", "")


def _currency() -> str:
    """p4_currency by its definition: net steps between values of dated rows, who is reached from whom, values that reach
    each other made one, and the longest chain below each."""
    def value(f, test):
        x = f"try_cast(case when regexp_full_match({f}, '\\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*') then trim({f}) end as double)"
        return f"(select x from (select case when isfinite({x}) then {x} end as x) where {test.replace('#', 'x')})"

    tests = {
        "completeness": ("# >= 0 and # <= 100", "floor(x * 0.2::double)"), "contamination": ("# >= 0 and # <= 100", "floor(x * 0.2::double)"), "genome_length": ("# > 0", "D"), "n50": ("# > 0", "D"),
        "centrality": ("# > 0 and # <= 1", "floor(x * 20.0::double)"),
    }
    values = " union all ".join(
        f"select qc_id, accession, trust, assessed_at, '{f}' as field_name, {b.replace('D', 'length(bin(floor(least(x, 9e18::double))::bigint))')}::bigint as v from (select *, {value(f, t)} as x from info) where x is not null"
        for f, (t, b) in tests.items()
    )
    more = """,
lagged as (select field_name as f, v, lag(v) over (partition by accession, field_name order by assessed_at, v) as prev from (select distinct accession, field_name, assessed_at, v from vals where assessed_at is not null and accession is not null)),
steps as (select f, prev as a, v as b, count(*) as n from lagged where prev is not null and prev != v group by all),
net as (select f, a, b from (select f, a, b, n from steps union all select f, b, a, -n from steps) group by all having sum(n) > 0),
reach(f, a, b) as (select f, a, b from net union select r.f, r.a, n.b from reach r join net n on n.f = r.f and n.a = r.b),
ends as (select distinct f, unnest([a, b]) as v from net),
one as (select e.f, e.v, least(e.v, min(r.b)) as c from ends e left join (select x.f, x.a, x.b from reach x join reach y on x.f = y.f and x.a = y.b and x.b = y.a) r on r.f = e.f and r.a = e.v group by e.f, e.v),
dag as (select distinct n.f, p.c as a, q.c as b from net n join one p on p.f = n.f and p.v = n.a join one q on q.f = n.f and q.v = n.b where p.c != q.c),
up(f, c, h) as (select distinct f, c, 0 from one union select u.f, d.b, u.h + 1 from up u join dag d on d.f = u.f and d.a = u.c),
prec as (select o.f, o.v, max(u.h) as height from one o join up u on u.f = o.f and u.c = o.c group by o.f, o.v)"""
    return f"""with recursive cur as (select * from (select *, row_number() over (partition by accession order by updated_at desc, ingested_at desc, row_id desc) as rn from genomes where accession is not null) where rn = 1),
held as (select accession, {acc('representative')} as rep from cur where lower(trim(derep_status)) = 'contained'),
pairs as (select accession, rep from held where rep != accession and rep in (select accession from cur)),
member as (select accession, rep from pairs union select rep, rep from pairs),
src as (select lower(trim(qc_source)) as source, max(trust) as trust from qc_sources group by 1),
info as (select i.*, {acc('genome')} as accession, s.trust from genome_information i left join src s on s.source = lower(trim(i.qc_source))),
vals as ({values}){more}
select representative, field_name, qc_id from (select m.rep as representative, v.field_name, v.qc_id,
 row_number() over (partition by m.rep, v.field_name order by v.trust desc nulls last, v.assessed_at desc nulls last, case when v.assessed_at is null then coalesce(p.height, -1) else 0 end desc, v.qc_id) as n
 from vals v join member m on m.accession = v.accession left join prec p on p.f = v.field_name and p.v = v.v) where n = 1"""


SQL["p4_currency"] = _currency()
