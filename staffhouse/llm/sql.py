"""DuckDB SQL for the operators that SQL can express, over the whole tables."""

CONTAMINATION = r"""
with doc as (select doc_id, row_number() over () as uid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as s
        from (select item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) as i from item where len(w) > 0)),
own as (select uid, n, i, array_to_string(w[i:i + n - 1], ' ') as s
        from (select uid, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from doc, (select distinct n from win) where len(w) >= n)),
hit as (select own.uid, own.n, own.i, win.item_id from own join win on own.s = win.s and own.n = win.n),
covered as (select uid, count(*) as n_hit from (select distinct uid, unnest(generate_series(i, i + n - 1)) as p from hit) group by uid),
items as (select uid, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct uid, item_id::varchar as id from hit) group by uid)
select doc.doc_id, len(doc.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join covered using (uid) left join items using (uid)
"""

NEAR_DUPLICATES = r"""
with recursive doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') as w from documents),
sh as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
       from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as i from doc where len(w) > 0)),
size as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by all),
link as (select x, y from common join size p on p.doc_id = x join size q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)),
reach(doc_id, r) as (select doc_id, doc_id from doc union select reach.doc_id, link.y from reach join link on link.x = reach.r)
select doc.doc_id, coalesce(size.n, 0)::bigint as n_shingles, c.component_id, doc.doc_id = c.component_id as kept
from doc left join size using (doc_id) join (select doc_id, min(r) as component_id from reach group by doc_id) c using (doc_id)
"""

NGRAM_JACCARD = r"""
with recursive doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') as w from documents),
sh as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s
       from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) as i from doc where len(w) > 0)),
size as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by all),
link as (select x, y from common join size p on p.doc_id = x join size q on q.doc_id = y where 100 * c >= 90 * (p.n + q.n - c)),
reach(doc_id, r) as (select doc_id, doc_id from doc union select reach.doc_id, link.y from reach join link on link.x = reach.r)
select doc.doc_id, coalesce(size.n, 0)::bigint as n_shingles, c.component_id
from doc left join size using (doc_id) join (select doc_id, min(r) as component_id from reach group by doc_id) c using (doc_id)
"""
