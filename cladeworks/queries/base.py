"""The register of queries and the SQL pieces their counterparts share."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def acc(c: str) -> str:
    """SQL of names.accession_of."""
    stem = f"regexp_replace(regexp_replace(trim({c}), '^.*/', ''), '([.]fasta[.]gz|[.]fasta|[.]fa|[.]fna|[.]fas)$', '')"
    bare = f"case when len(string_split({stem}, '_')) >= 4 then regexp_replace({stem}, '^[^_]*_[^_]*_[^_]*_', '') else {stem} end"
    return f"nullif(regexp_replace({bare}, '^(GB|RS)_', ''), '')"


def bare(c: str) -> str:
    return f"lower(trim(regexp_replace(trim({c}), '^[A-Za-z]__', '')))"


def rank(c: str) -> str:
    """SQL of names.rank_name."""
    return f"nullif(regexp_replace({bare(c)}, '[ _]+', '-', 'g'), '')"


def species(s: str, g: str) -> str:
    """SQL of names.species_name."""
    a, b = bare(s), bare(g)
    rest = f"case when length({b}) > 0 and starts_with({a}, {b}) and substr({a}, length({b}) + 1, 1) in (' ', '_', '') then substr({a}, length({b}) + 2) else {a} end"
    return f"nullif(regexp_replace(trim({rest}), '[ _]+', '-', 'g'), '')"


#: Words of any script: runs of letters, marks and digits, and in scripts without spaces each letter with its marks.
_APART = "regexp_replace(lower(text), '([\\p{Han}\\p{Hiragana}\\p{Katakana}\\p{Thai}\\p{Lao}\\p{Khmer}\\p{Myanmar}]\\p{M}*)', ' \\1 ', 'g')"
WORDS = f"list_filter(string_split(regexp_replace({_APART}, '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w != '')"
#: (id, h) of the documents' word shingles.
SKETCH = f"""
words as (select doc_id as id, {WORDS} as w from documents where doc_id is not null and text is not null),
parts as (select id, unnest(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' '))) as p from words where len(w) >= 5),
sketch as (select distinct id, ('0x' || substr(md5(p), 1, 15))::bigint as h from parts)
"""
#: Classes of equal sketches and the pairs of classes at 0.8 or more.
EDGES = SKETCH + """,
sets as (select id, count(*) as n, list(h order by h) as hs from sketch group by id),
members as (select id, n, min(id) over (partition by hs) as class_id from sets),
heads as (select s.id, s.h, m.n from sketch s join members m on s.id = m.id and m.id = m.class_id),
shared as (select a.id as a, b.id as b, a.n as na, b.n as nb, count(*) as shared from heads a join heads b on a.h = b.h and a.id < b.id group by all),
edges as (select a, b, shared, na, nb, shared::double / (na + nb - shared) as jaccard from shared where shared::double / (na + nb - shared) >= 0.8)
"""
#: Greedy cover of the classes, with the classes without a neighbour.
COVER = EDGES + """,
sizes as (select class_id, count(*) as size from members group by class_id),
ends as (select a, b from edges union all select b, a from edges),
deg as (select s.class_id as id, s.size - 1 + coalesce((select sum(z.size) from ends join sizes z on z.class_id = ends.b where ends.a = s.class_id), 0)::bigint as degree, s.size from sizes s),
ranked as (select id, degree, row_number() over (order by degree desc, id) as rk from deg where id in (select a from ends)),
around as (select a as id, list(b) as nb from ends group by a),
walk(i, reps) as (
  select 0::bigint, []::bigint[]
  union all
  select w.i + 1, case when list_has_any(n.nb, w.reps) then w.reps else list_append(w.reps, r.id) end
  from walk w join ranked r on r.rk = w.i + 1 join around n on n.id = r.id
),
reps as (select unnest(reps) as id from walk where i = (select max(i) from walk)),
cover as (
  select id, id as rep from reps
  union all select id, id from deg where id not in (select a from ends)
  union all
  select b.a, arg_min(b.b, r.rk) from ends b join ranked r on r.id = b.b where b.b in (select id from reps) and b.a not in (select id from reps) group by b.a
),
clusters as (
  select c.rep as representative, m.id as member from members m join cover c on c.id = m.class_id
  union all select doc_id, doc_id from documents where doc_id is not null and doc_id not in (select id from members)
)
"""
