"""SQL twins whose text is put together: rounds of vector codes, and spelling groups with a CRC in SQL."""

from __future__ import annotations

from marketlens.llm import spelling_groups, vector_codes


def vector_codes_sql() -> str:
    """One pair of steps per round: nearest entries, then floored means; vec_id is unique in the table."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    text = f"""
with k as materialized (select * from embeddings where embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
d as (select len(embedding) as d from k where len(embedding) > 0 order by vec_id limit 1),
u as (select vec_id, embedding from k, d where len(embedding) = d.d and d.d % {parts} = 0),
c as materialized (select vec_id, i // (d.d // {parts}) as p, i, floor({vector_codes.SCALE} * embedding[i + 1]::double)::bigint as x
  from (select vec_id, embedding, unnest(range(len(embedding))) as i from u), d),
f as (select vec_id, row_number() over (order by vec_id) - 1 as e from u order by vec_id limit {entries}),
b0 as materialized (select p, e, i, x as y from c join f using (vec_id))"""
    for r in range(vector_codes.ROUNDS + 1):
        text += f""",
a{r} as materialized (select vec_id, p, min((s, e)) as best from (
  select vec_id, c.p, b.e, sum((x - y) * (x - y))::bigint as s from c join b{r} b on c.p = b.p and c.i = b.i group by all) group by all)"""
        if r < vector_codes.ROUNDS:
            text += f""",
b{r + 1} as materialized (select b.p, b.e, b.i, coalesce(m.y, b.y) as y from b{r} b left join (
  select c.p, best[2] as e, c.i, floor(sum(x)::double / count(*))::bigint as y from c join a{r} a on c.vec_id = a.vec_id and c.p = a.p group by all) m
  on b.p = m.p and b.e = m.e and b.i = m.i)"""
    last = vector_codes.ROUNDS
    return text + f""",
o as (select vec_id, string_agg(printf('%02x', best[2]), '' order by p) as code, sum(best[1])::bigint as error from a{last} group by vec_id)
select k.vec_id, o.code, o.error, (sum(o.error) over (partition by k.label))::bigint as label_error,
       (select sha256(string_agg(y::varchar, ',' order by p, e, i)) from b{last}) as codebooks_sha256
from k left join o using (vec_id)
"""


def spelling_groups_sql() -> str:
    """CRC by its table of 256 steps; near words share the word without one letter."""
    run = f"[a-zÀ-ÿ]{{{spelling_groups.SHORTEST},}}"
    return f"""
with recursive crc as (select list(x order by i) as steps from (
  select i, list_reduce(list_prepend(i, range(8)), lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as x
  from (select unnest(range(256))::bigint as i))),
t as (select coalesce(doc_id::varchar, '') as doc, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
r as (select doc, run, count(*) as n from (select doc, unnest(regexp_extract_all(text, '{run}')) as run from t) group by all),
b as (select doc, run, n, encode(doc || ':' || run) as bytes from r),
h as materialized (select run, n, xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(octet_length(bytes)), lambda i: ('0x' || substr(hex(bytes), 2 * i::int + 1, 2))::bigint)),
    lambda c, x: xor(c >> 8, steps[xor(c & 255, x) + 1])), 4294967295) as h from b, crc),
g as (select case when h % {spelling_groups.MODULUS} = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, n from h),
w as materialized (select word, sum(n)::bigint as n from g where length(word) >= {spelling_groups.SHORTEST} group by word having sum(n) >= 2),
v as materialized (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as less from (select *, unnest(range(length(word))) as i from w)),
p as (select a.word, b.word as near, b.n as near_n from v a join v b on a.less = b.less and a.i = b.i and a.word <> b.word
  union select v.word, w.word, w.n from v join w on v.less = w.word union select w.word, v.word, v.n from w join v on v.less = w.word),
q as (select word, count(*)::bigint as n_near, min((-near_n, encode(near), near)) as best from p group by word),
f as materialized (select w.word, w.n, coalesce(n_near, 0) as n_near, case when -best[1] >= {spelling_groups.FACTOR} * w.n then best[3] end as form,
  case when -best[1] >= {spelling_groups.FACTOR} * w.n then -best[1] end as form_n from w left join q using (word)),
walk as (select word, word as root, 0 as step from f union all select k.word, f.form, step + 1 from walk k join f on k.root = f.word where f.form is not null)
select f.word, n, n_near, form, form_n::bigint as form_n, root from f join (select word, arg_max(root, step) as root from walk group by word) using (word)
"""
