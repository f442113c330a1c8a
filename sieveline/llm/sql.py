"""DuckDB SQL for what SQL can tell of the subpackage's queries."""

from __future__ import annotations

#: Words are runs of bytes other than 0x20 and 0x09-0x0D.
_SPLIT = r"string_split_regex({text}, '[\x20\x09-\x0D]+')"
_WORDS = "list_filter(" + _SPLIT + ", lambda w: w <> '')"

OP5 = """
with rows as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1]::bigint * p[2]::bigint))::bigint as score
    from rows q join rows c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
)
select query_id, rank, vec_id, score
from (select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
where rank <= 5
"""

OP7 = f"""
with recursive words as (
    select doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w
    from documents
),
shingles as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]] else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s
    from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as a, b.doc_id as b, count(*) as n
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
    group by a.doc_id, b.doc_id
),
links as (
    select a, b from common c join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * c.n >= 80 * (x.n + y.n - c.n)
),
linked as (select a, b from links union select b, a from links),
reached(doc_id, other) as (
    select doc_id, doc_id from words
    union
    select r.doc_id, l.b from reached r join linked l on l.a = r.other
)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from words d left join sizes s using (doc_id) join (select doc_id, min(other) as component_id from reached group by doc_id) c using (doc_id)
"""

QUALITY_BASE = f"""
with words as (
    select doc_id, coalesce(text, '') as t, {_WORDS.format(text="coalesce(text, '')")} as w from documents
),
grams as (
    select doc_id, i, list_aggregate(list_slice(w, i, i + 7), 'string_agg', ' ') as g
    from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from words where len(w) >= 8)
),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from grams) where n > 1),
covered as (select doc_id, count(distinct place) as n from (select doc_id, unnest(range(i, i + 8)) as place from twice) group by doc_id),
lines as (
    select doc_id, count(*) - count(distinct line) as n
    from (select doc_id, unnest(string_split(t, chr(10))) as line from words)
    where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols, coalesce(lines.n, 0)::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
    len(w) < 20 or 100 * coalesce(covered.n, 0) > 30 * len(w) as base_failed
from words left join covered using (doc_id) left join lines using (doc_id)
"""

#: Row counts at most one apart, slots without gaps, and every document once; of the sizes, what all shards have together.
SHARDING_LAWS = """
select 'rows' as law, n // 16 as least_rows, (n + 15) // 16 as most_rows, n as n_rows, n as n_places, 0::bigint as gaps, bytes
from (select count(*) as n, sum(octet_length(encode(coalesce(text, ''))) + 1)::bigint as bytes from documents)
"""

DEVIATIONS = """
with v as (
    select vec_id, list_transform(embedding, lambda c: cast(floor(256 * cast(c as double)) as hugeint)) as x
    from embeddings where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
),
fit as (select distinct x from v),
n as (select count(*) as n from fit),
sums as (select i, sum(x[i]) as s from fit, (select unnest(range(1, (select max(len(x)) from fit) + 1)) as i) group by i),
parts as (select vec_id, x, i, (n.n * x[i] - s) as y from v, sums, n)
select vec_id, cast((select n from n) as bigint) as n, cast(sum(y * y) as bigint) as deviation from parts group by vec_id
"""
