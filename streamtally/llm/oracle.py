"""DuckDB SQL for those queries of this package that SQL can express."""

from __future__ import annotations

NEAR_DUPLICATES = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
  from words
), items as (
  select doc_id, unnest(s) as x from sets
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common from items a join items b on a.x = b.x and a.doc_id < b.doc_id group by all
), links as (
  select a, b from pairs join sets l on l.doc_id = a join sets r on r.doc_id = b
  where 100 * common >= 85 * (len(l.s) + len(r.s) - common)
), edges as (
  select a, b from links union all select b, a from links
), reached(doc_id, other) as (
  select doc_id, doc_id from documents union select r.doc_id, e.b from reached r join edges e on e.a = r.other
), named as (
  select doc_id, min(other) as component_id from reached group by doc_id
)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept from sets join named using (doc_id)
"""

REPEATS = """
with docs as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), windows as (
  select doc_id, unnest(range(greatest(length(h) // 2 - 49, 0))) as i,
    unnest(list_transform(range(greatest(length(h) // 2 - 49, 0)), lambda i: substring(h, 2 * i + 1, 100))) as w
  from docs
), firsts as (
  select w, min(doc_id) as first_doc from windows group by w having min(doc_id) < max(doc_id)
), hits as (
  select doc_id, i from windows join firsts using (w) where first_doc < doc_id
), marked as (
  select *, case when i - lag(i) over (partition by doc_id order by i) <= 50 then 0 else 1 end as new from hits
), runs as (
  select doc_id, min(i) as a, max(i) + 50 as b
  from (select *, sum(new) over (partition by doc_id order by i) as run from marked) group by doc_id, run
), gaps as (
  select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a, a as b from runs
  union all select doc_id, max(b), 1000000000 from runs group by doc_id
), kept as (
  select doc_id, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' order by a) as k from gaps join docs using (doc_id) group by doc_id
), totals as (
  select doc_id, sum(b - a) as removed, count(*) as n from runs group by doc_id
)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed,
  cast(coalesce(n, 0) as bigint) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256
from docs left join totals using (doc_id) left join kept using (doc_id)
"""

SEARCH = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
), tf as (
  select doc_id, term, count(*) as tf from words group by all
), lengths as (
  select doc_id, cast(count(*) as bigint) as n from words group by doc_id
), corpus as (
  select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as total from lengths
), weights as (
  select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w
  from tf cross join corpus group by term, docs
), factors as (
  select doc_id, 75 + ((25 * n * docs) // total) as m from lengths cross join corpus
), asked as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), scores as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
  from asked join tf using (term) join weights using (term) join factors using (doc_id) group by item_id, doc_id
)
select item_id, cast(rank as integer) as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0
) where rank <= 20
"""

AUDIT = r"""
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), masks as (
  select doc_id, part,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: case f
      when 'A' then len(w) < 200
      when 'B' then 100 * len(list_distinct(w)) < 50 * len(w)
      when 'C' then 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text)
      when 'D' then regexp_matches(text, '[#$%&*|]')
      else doc_id > first_id end) as fails
  from (select *, min(doc_id) over (partition by text) as first_id from words)
), labelled as (
  select m.part, m.fails, coalesce(l.quality = 1, false) as good, coalesce(l.toxic = 1, false) as toxic
  from masks m left join labels l using (doc_id)
), kinds as (
  select part, fails, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
  from labelled group by all
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as f
), orders as (
  select [a.f, b.f, c.f, d.f, e.f] as o from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps as (
  select o, unnest(range(1, 6)) as step from orders
), counted as (
  select part, o, step,
    sum(case when len(list_intersect(fails, o[1:step])) = 0 then n else 0 end) as kept,
    sum(case when list_contains(fails, o[step]) and len(list_intersect(fails, o[1:step - 1])) = 0 then n else 0 end) as removed,
    sum(case when list_contains(fails, o[step]) and len(list_intersect(fails, o[1:step - 1])) > 0 then n else 0 end) as redundant,
    sum(case when fails = [o[step]] then n else 0 end) as unique_fails,
    sum(case when list_contains(fails, o[step]) and len(list_intersect(fails, o[1:step - 1])) = 0 then good else 0 end) as good_lost,
    sum(case when list_contains(fails, o[step]) and len(list_intersect(fails, o[1:step - 1])) = 0 then toxic else 0 end) as toxic_lost
  from kinds cross join steps group by all
)
select part, array_to_string(o, '') as filter_order, cast(step as integer) as step, cast(kept as bigint) as kept,
  cast(removed as bigint) as removed, cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, o[step]) as bigint) as shapley
from counted
"""

LEAKS = r"""
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(len(w), 10) as m, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
    lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) as x
  from items where len(w) > 0
), sizes as (
  select distinct m from windows
), places as (
  select doc_id, m, unnest(range(1, len(w) - m + 2)) as p,
    unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as x
  from docs cross join sizes where len(w) >= m
), hits as (
  select doc_id, item_id, p, m from places join windows using (m, x)
), hit_words as (
  select distinct doc_id, unnest(range(p, p + m)) as p from (select distinct doc_id, p, m from hits)
), n_hits as (
  select doc_id, count(*) as n_hit from hit_words group by doc_id
), found as (
  select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from hits group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join n_hits using (doc_id) left join found using (doc_id)
"""

ORACLE = {
    "op4_repeat_intervals": REPEATS,
    "op5_lsh_forest": NEAR_DUPLICATES,
    "op11_geometric_search": SEARCH,
    "op12_potential_audit": AUDIT,
    "op13_window_decontamination": LEAKS,
}
