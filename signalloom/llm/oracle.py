"""DuckDB SQL of the corpus queries."""

ORACLE: dict[str, str] = {}

ORACLE["op1_decontamination"] = r"""
with item as (
  select cast(item_id as varchar) item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark),
win as (
  select distinct item_id, least(len(w), 10) n, w[i : i + least(len(w), 10) - 1] ws
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) i from item where len(w) > 0)),
doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from documents),
sizes as (select distinct n from win),
pos as (select doc_id, n, i, w[i : i + n - 1] ws from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from doc, sizes where len(w) >= n)),
hit as (select distinct doc_id, i, p.n, item_id from pos p join win using (ws)),
word as (select doc_id, count(distinct k) n_hit from (select doc_id, unnest(range(i, i + n)) k from (select distinct doc_id, i, n from hit)) group by doc_id),
items as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) ids from (select distinct doc_id, item_id from hit) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items,
       sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from doc d left join word using (doc_id) left join items using (doc_id)
"""

ORACLE["op5_substrings"] = r"""
with doc as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
win as (
  select doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) h
  from (select doc_id, w, unnest(range(1, len(w) - 48)) i from doc where len(w) >= 50)),
least as (select h, min(doc_id) first from win group by h),
gone as (select distinct doc_id, unnest(range(i, i + 50)) k from win join least using (h) where doc_id > first),
word as (select doc_id, unnest(w) x, unnest(range(1, len(w) + 1)) k from doc),
kept as (select doc_id, string_agg(x, ' ' order by k) t from word left join gone using (doc_id, k) where gone.k is null group by doc_id),
n as (select doc_id, count(*) c from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(c, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256
from doc d left join kept using (doc_id) left join n using (doc_id)
"""
