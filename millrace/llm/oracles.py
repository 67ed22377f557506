"""SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(kind: str) -> str:
    pattern = {"alnum": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "spaced": r"[^\x20\x09-\x0D]+"}[kind]
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


OP5 = f"""with d as (select doc_id, {_words('alnum')} as w from documents), b as (select item_id::varchar as item_id, {_words('alnum')} as w from benchmark),
iw as (select distinct item_id, least(len(w), 10) as n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as x from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
dw as (select doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') as x from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from iw))),
hit as (select doc_id, i, dw.n, item_id from dw join iw on dw.x = iw.x and dw.n = iw.n),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by 1),
it as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as s from (select distinct doc_id, item_id from hit) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated from d left join pos using (doc_id) left join it using (doc_id)"""

OP6 = f"""with d as (select doc_id, {_words('spaced')} as w from documents),
x as (select doc_id, i, md5(array_to_string(list_slice(w, i + 1, i + 50), ' ')) as h from (select doc_id, w, unnest(range(0, len(w) - 49)) as i from d)),
r as (select doc_id, i from x where h in (select h from x group by h having count(distinct doc_id) > 1)),
s as (select doc_id, i, sum(new) over (partition by doc_id order by i) as span from (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new from r))
select doc_id, min(i)::bigint as start_word, (max(i) + 50 - min(i))::bigint as n_words from s group by doc_id, span"""

OP7 = f"""with recursive d as (select doc_id, {_words('spaced')} as w from documents),
s as (select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as x from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id, doc_id as c from d union select e.b, r.c from r join e on e.a = r.doc_id)
select doc_id, coalesce(n, 0) as n_shingles, min(c) as component_id from r left join n using (doc_id) group by 1, 2"""

SQL = {"op5_winnowing_decontamination": OP5, "op6_sparse_suffix_repeats": OP6, "op7_parity_jaccard_join": OP7}
