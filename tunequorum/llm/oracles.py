"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""

QUALITY = r"""
with d as (select doc_id, lang, source, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
windows as (select doc_id, unnest(range(1, len(ws) - 6)) as i, ws from w where len(ws) >= 8),
texts as (select doc_id, i, ws[i : i + 7] as x from windows),
twice as (select doc_id, i from texts qualify count(*) over (partition by doc_id, x) > 1),
steps as (select doc_id, least(coalesce(lead(i) over (partition by doc_id order by i) - i, 8), 8) as step from twice),
repeats as (select doc_id, sum(step)::bigint as n from steps group by doc_id),
m as (select w.doc_id, lang, source, len(ws) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(ls) as n_lines,
             len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
      from w left join repeats using (doc_id)),
f as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
             case when n_words > 0 then 100 * word_chars // n_words else 0 end as v0,
             case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end as v1,
             case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as v2,
             case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as v3 from m),
v as (select lang, source, unnest([0, 1, 2, 3]) as rule, unnest([v0, v1, v2, v3]) as value from f where not base_failed),
b as (select lang, source, rule, (value >> greatest(length(bin(value)) - 7, 0)) << greatest(length(bin(value)) - 7, 0) as bucket from v),
g as (select *, grouping(source) as no_source, grouping(lang) as no_lang, count(*) as n from b
      group by grouping sets ((lang, source, rule, bucket), (lang, rule, bucket), (rule, bucket))),
c as (select *, sum(n) over (partition by no_lang, no_source, lang, source, rule order by bucket) as seen,
             sum(n) over (partition by no_lang, no_source, lang, source, rule) as total from g),
q as (select no_lang, no_source, lang, source, rule, max(total) as total, min(bucket) filter (4 * seen >= total) as q1,
             min(bucket) filter (4 * seen >= 3 * total) as q3 from c group by all),
t as (select p.lang, p.source, p.rule,
             case when p.total >= 200 then p.q1 when l.total >= 200 then l.q1 else e.q1 end as q1,
             case when p.total >= 200 then p.q3 when l.total >= 200 then l.q3 else e.q3 end as q3
      from q p join q l on l.no_source = 1 and l.no_lang = 0 and l.lang is not distinct from p.lang and l.rule = p.rule
      join q e on e.no_lang = 1 and e.rule = p.rule where p.no_source = 0),
x as (select lang, source, max(q3 + greatest(3 * (q3 - q1), 200)) filter (rule = 0) as hi0,
             max(q1 - greatest(3 * (q3 - q1), 200)) filter (rule = 0) as lo0,
             max(q3 + greatest(3 * (q3 - q1), 50)) filter (rule = 1) as hi1,
             max(q3 + greatest(3 * (q3 - q1), 400)) filter (rule = 2) as hi2,
             max(q3 + greatest(3 * (q3 - q1), 300)) filter (rule = 3) as hi3 from t group by lang, source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(not base_failed and v0 <= hi0 and v0 >= lo0 and v1 <= hi1 and v2 <= hi2 and v3 <= hi3, false) as kept
from f left join x on f.lang is not distinct from x.lang and f.source is not distinct from x.source
"""

def packing_sql(max_tokens: int = 4096, buckets: int = 16, batch_tokens: int = 65536, table: str = "documents") -> str:
    """The dynamic program level by level; a level takes the best last bucket of every prefix of the lengths."""
    head = rf"""
with recursive d as (select doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as total from {table}),
p as (select doc_id, total, unnest(range(0, greatest((total - 1) // {max_tokens}, 0) + 1)) as piece from d),
c as (select doc_id, piece, piece * {max_tokens} as start, least(total - piece * {max_tokens}, {max_tokens}) as n_tokens from p),
g as (select n_tokens as len, count(*) as n from c group by 1),
h as (select row_number() over (order by len) as j, len, (sum(n) over (order by len))::bigint as cnt,
             (sum(n * len) over (order by len))::bigint as tot from g),
z as (select 0 as j, 0 as cnt, 0 as tot union all select j, cnt, tot from h),
l1 as (select j, len * cnt - tot as cost, 0 as came from h)"""
    levels = [f"""
l{k} as (select h.j, min(x.cost + h.len * (h.cnt - x.cnt) - (h.tot - x.tot)) as cost,
      arg_min(x.j, (x.cost + h.len * (h.cnt - x.cnt) - (h.tot - x.tot)) * 100000 + x.j) as came
      from h join (select z.j, z.cnt, z.tot, case when z.j = 0 then 0 else l.cost end as cost
                   from z left join l{k - 1} l on l.j = z.j) x on x.j < h.j group by h.j)""" for k in range(2, buckets + 1)]
    every = " union all ".join(f"select {k} as k, * from l{k}" for k in range(1, buckets + 1))
    tail = f"""
a as ({every}),
top as (select k, j, came from a where j = (select max(j) from h) order by cost, k limit 1),
walk as (select k, j, came from top union all select a.k, a.j, a.came from walk w join a on a.k = w.k - 1 and a.j = w.came and w.came > 0),
bounds as (select len as padded_to, row_number() over (order by len) - 1 as bucket from walk join h using (j)),
b as (select c.*, (select min(padded_to) from bounds where padded_to >= n_tokens) as padded_to from c),
r as (select b.*, bucket, row_number() over (partition by bucket order by doc_id nulls first, piece, n_tokens) - 1 as number,
             greatest({batch_tokens} // greatest(b.padded_to, 1), 1) as room from b join bounds using (padded_to))
select doc_id, piece, start, n_tokens, bucket, padded_to, number // room as batch, number % room as slot from r"""
    return ",".join([head, *levels, tail])


PREFERENCES = """
with t as (select distinct conv_id // 2 as pair_id, conv_id % 2 = 0 as side, turn, role, text from conversations where conv_id is not null),
n as (select *, row_number() over (partition by pair_id, side order by turn nulls first, role nulls first, text nulls first) as k,
             '<|' || coalesce(role, '') || '|>' || chr(10) as head, coalesce(text, '') || '<|end|>' || chr(10) as body from t),
s as (select pair_id, count(*) filter (side) as na, count(*) filter (not side) as nb from n group by 1),
d as (select a.pair_id, min(a.k) as k from n a join n b on a.pair_id = b.pair_id and a.k = b.k and a.side and not b.side
      where a.role is distinct from b.role or a.text is distinct from b.text group by 1),
c as (select s.pair_id, coalesce(d.k - 1, least(na, nb)) as n_common from s left join d using (pair_id)),
r as (select n.*, n_common, head || body as shown,
             length(head) || ':0,' || length(body) || ':' || case when role = 'assistant' then 1 else 0 end as runs from n join c using (pair_id))
select pair_id, any_value(n_common) as n_common,
       coalesce(string_agg(shown, '' order by k) filter (side and k <= n_common), '') as prompt,
       coalesce(string_agg(shown, '' order by k) filter (side and k > n_common), '') as chosen,
       coalesce(string_agg(shown, '' order by k) filter (not side and k > n_common), '') as rejected,
       coalesce(string_agg(runs, ',' order by k) filter (side and k > n_common), '') as chosen_mask,
       coalesce(string_agg(runs, ',' order by k) filter (not side and k > n_common), '') as rejected_mask
from r group by pair_id
"""

NEAR_VECTORS = """
with recursive w as (select vec_id, label, cast(embedding as double[]) as e, row_number() over () as r from embeddings),
v as (select vec_id, label, r, case when len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 then e end as e from w),
ok as (select *, sqrt(list_sum(list_transform(e, lambda x: x * x))) as norm from v where label is not null and len(list_filter(e, lambda x: x <> 0)) > 0),
p as (select a.r as x, b.r as y from ok a join ok b on a.label = b.label and a.r <> b.r and len(a.e) = len(b.e)
      and list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) / (a.norm * b.norm) >= 0.98),
reach(x, y) as (select x, y from p union select reach.x, p.y from reach join p on reach.y = p.x),
least as (select x, min(vec_id) as id from reach join v on v.r = reach.y group by x),
links as (select x, count(*) as n from p group by x)
select vec_id, coalesce(n, 0) as n_links, coalesce(id, vec_id) as component_id, vec_id is not distinct from coalesce(id, vec_id) as kept
from v left join links on links.x = r left join least on least.x = r
"""

PREFIX_TRIE = """
with t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
g as (select c, length(text) as w, substr(sha256(length(role) || ':' || role || text), 1, 32) as digest, turn from t),
n as (select c, w, digest, row_number() over (partition by c order by turn nulls first, digest) - 1 as p from g),
k as (select c, count(*) as own, c - c % 100 as base, xor(list_reduce(
          flatten(list_transform(string_split(c::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
          lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, 4294967295::bigint
      ), 4294967295) % 6 as h from n group by c),
f as (select k.c, k.base, k.h, least(k.h, coalesce(b.own, 0)) as given from k left join k b on b.c = k.base),
r as (select f.c, p, digest, w from f join n on n.c = f.base and p < h
      union all select f.c, given + p - h, digest, w from f join n on n.c = f.c and p >= h),
s as (select f.c, coalesce(list(digest order by p) filter (p is not null), []) as ds, list(w order by p) as ws from f left join r on r.c = f.c group by f.c),
m as (select c, len(ds) as length, unnest(range(0, len(ds) + 1)) as d, ds, ws from s),
e as (select c, length, d, array_to_string(ds[1:d], '') as key, array_to_string(ds[1:d - 1], '') as above, ws[d] as w from m),
nodes as (select d, key, max(above) as above, min(c) as conv_id, count(*) as n_convs, max(w) as w,
                 sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (length = d), '')) as ends_sha256 from e group by d, key),
kids as (select above as key, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all),
own as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (d, key)),
under as (select a.d, a.key, sum(case when o.n_children = 0 then 1 else 0 end)::bigint as n_leaves,
                 sum(case when o.d > 0 then (o.n_convs - 1) * o.w else 0 end)::bigint as saved_tokens
          from own o join e a on a.c = o.conv_id and a.d <= o.d group by a.d, a.key)
select o.conv_id, o.d as depth, parent.conv_id as parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, o.ends_sha256
from own o join under using (d, key) left join nodes parent on o.d > 0 and parent.d = o.d - 1 and parent.key = o.above
"""

ORACLE_SQL: dict[str, str] = {
    "op2_packing": packing_sql(), "op5_preference_format": PREFERENCES,
    "op7_quality_rules": QUALITY, "op10_exact_dedup": EXACT_DEDUP,
    "op11_embedding_near_dedup": NEAR_VECTORS, "op13_prefix_trie": PREFIX_TRIE,
}
