"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# Digests and crc32 over bytes have no counterpart for op2, op3, op4 and op8 to
# op10 in part; those are tested against brute force in tests/llm.
SQL = {
    "op5_similar_lines": r"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (
  select doc_id, i, l[i + 1] as line,
         list_sort(list_distinct(regexp_extract_all(lower(l[i + 1]), '[^\x20\x09-\x0D]+'))) as w
  from (select doc_id, l, unnest(range(len(l))) as i from split)),
sets as (
  select row_number() over (order by min((doc_id, i))) as id, w, len(w) as n
  from (select doc_id, i, w from lines where len(w) > 0) group by w),
words as (select id, n, unnest(w) as word from sets),
alike as (
  select distinct id from (
    select a.id, b.id as earlier, any_value(a.n) as an, any_value(b.n) as bn, count(*) as common
    from words a join words b on a.word = b.word and b.id < a.id
      and 5 * a.n >= 4 * b.n and 5 * b.n >= 4 * a.n
    group by a.id, b.id)
  where 5 * common >= 4 * (an + bn - common)),
judged as (
  select l.doc_id, l.i, l.line, s.id is not null and (
         s.id in (select id from alike)
         or row_number() over (partition by s.id order by l.doc_id, l.i) > 1) as gone
  from lines l left join sets s on s.w = l.w)
select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_removed,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), ''))
         as text_sha256
from judged group by doc_id""",
    "op6_chunked_records": """
with hashed as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
         sha1(coalesce(html, '')) as payload_digest
  from pages),
ranked as (
  select *, max(page_id) over (partition by payload_digest) as last_id from hashed)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < last_id then 'revisit'
            else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < last_id then last_id end as refers_to
from ranked""",
    "op9_quotient_filters": r"""
with hashed as (
  select doc_id, length(coalesce(text, '')) as points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
  from documents),
grouped as (
  select doc_id, body, count(*) over (partition by body) as group_size,
         first_value(doc_id) over (partition by body order by points desc, doc_id) as keep_id
  from hashed)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
from grouped""",
    "op10_bbit_minhash": r"""
with recursive split as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
                 else list_distinct(list_transform(range(1, len(w) - 2), lambda i:
                        array_to_string(list_slice(w, i, i + 3), ' '))) end as s
  from split),
items as materialized (select doc_id, len(s) as n, md5(unnest(s)) as gram from sets),
links as materialized (
  select a, b from (
    select x.doc_id as a, y.doc_id as b, any_value(x.n) as an, any_value(y.n) as bn,
           count(*) as common
    from items x join items y on x.gram = y.gram and x.doc_id <> y.doc_id
      and 5 * x.n >= 4 * y.n and 5 * y.n >= 4 * x.n
    group by x.doc_id, y.doc_id)
  where 100 * common >= 80 * (an + bn - common)),
reach as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, l.b from reach r join links l on l.a = r.other),
components as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id,
       doc_id = component_id as kept
from sets join components using (doc_id)""",
    "op12_threshold_resampling": r"""
with crc_table as (
  select list(crc order by byte) as t from (
    select byte, list_reduce(list_prepend(byte, range(8)), lambda c, n:
             case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as crc
    from (select unnest(range(256)) as byte))),
words as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select doc_id, text from documents
        union all select null, text from benchmark)),
features as (select doc_id, unnest(w) as word from words),
coded as (
  select word, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(octet_length(encode(word))), lambda i:
             ('0x' || substr(hex(encode(word)), cast(2 * i + 1 as bigint), 2))::bigint)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 as bucket
  from (select distinct word from features), crc_table),
counts as (
  select bucket, count(doc_id) as s, count(*) - count(doc_id) as t
  from features join coded using (word) group by bucket),
totals as (select sum(s) as s_all, sum(t) as t_all from counts),
gains as (
  select bucket, cast(floor(1000 * ln((t + 1)::double * (s_all + 10000)
           / ((s + 1)::double * (t_all + 10000)))) as bigint) as gain
  from counts, totals),
weights as (
  select doc_id, sum(gain) as weight
  from features join coded using (word) join gains using (bucket)
  where doc_id is not null group by doc_id),
scored as (
  select doc_id, cast(len(w) as bigint) as n_features,
         cast(coalesce(weight, 0) as bigint) as weight,
         cast(coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5) / 4294967296)))
           as bigint) as score
  from words left join weights using (doc_id) where doc_id is not null),
apt as (
  select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n
  from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from scored left join apt using (doc_id)""",
    "op13_window_repeats": r"""
with split as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, n, md5(array_to_string(list_slice(w, n, n + 12), ' ')) as grams
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as n from split)),
firsts as (select grams, min(doc_id) as first from windows group by grams),
gone as (
  select distinct doc_id, unnest(range(n, n + 13)) as place
  from windows join firsts using (grams) where first < doc_id),
words as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from split),
kept as (
  select doc_id, string_agg(word, ' ' order by place) as text, count(*) as left_over
  from words anti join gone using (doc_id, place) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words,
       cast(len(w) - coalesce(left_over, 0) as bigint) as n_removed,
       sha256(coalesce(text, '')) as kept_sha256
from split left join kept using (doc_id)""",
}
