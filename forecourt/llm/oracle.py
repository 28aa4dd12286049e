"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

# The reversed polynomial of CRC-32 and the interleaving's seed.
_CRC = "3988292384"
_SEED = 17

_OP1 = f"""
with recursive bits as (
  select range as byte, range as c, 0 as step from range(256)
  union all
  select byte, case when c % 2 = 1 then xor(c >> 1, {_CRC}::bigint) else c >> 1 end, step + 1
  from bits where step < 8
), crc as (
  select list(c order by byte) as t from bits where step = 8
), docs as (
  select doc_id, source, coalesce(text, '') as body,
    md5('{_SEED}:' || coalesce(doc_id::varchar, '')) as h,
    coalesce('s' || source, '') as stratum
  from documents
), ranked as (
  select *, row_number() over (partition by stratum order by h, doc_id) as rank,
    count(*) over (partition by stratum) as n_stratum, count(*) over () as n
  from docs
), placed as (
  select *, row_number() over (order by frac, stratum, rank) - 1 as place
  from (
    select *, (rank - 1 + ('0x' || substr(md5('{_SEED}:phase:' || stratum), 1, 8))::bigint
        / 4294967296.0::double)::double / n_stratum as frac
    from ranked
  )
)
select doc_id, source, strlen(body)::bigint + 16 as size,
  xor(list_reduce(
      list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: ('0x' || h)::bigint),
      lambda c, b: xor(c >> 8, crc.t[(xor(c & 255, b) + 1)::int]), 4294967295::bigint),
    4294967295) as text_crc32,
  'rows' as law, (place * 40 // n)::int as shard,
  (place - ((place * 40 // n) * n + 39) // 40)::bigint as slot, null::int as grown_shard
from placed, crc
"""

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_OP2 = f"""
with docs as (select doc_id, {_LOWER} as body from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(body) as text_sha256
from docs window same as (partition by body)
"""

_OP6 = """
with vectors as (
  select row_number() over () as nr, vec_id,
    list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.nr, q.vec_id as query_id, c.vec_id,
    coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1),
      lambda i: q.v[i] * c.v[i])), 0)::bigint as score
  from vectors q join vectors c on q.vec_id % 20 = 0 and c.nr <> q.nr
), ranked as (
  select *, row_number() over (partition by nr order by score desc, vec_id nulls last)::int as rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

# Base32 takes 5 bits at a time; a SHA-1 sum of 40 hexadecimal digits has 32 of them.
_OP8 = """
with rows as (
  select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n,
    max(page_id) over (partition by coalesce(html, '')) as keep
  from pages
), hashed as (
  select *, array_to_string(list_transform(string_split(sha1(body), ''), lambda c:
    right('000' || (('0x' || c)::int)::bit::varchar, 4)), '') as bits
  from rows
)
select page_id, n as payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(
      list_reduce(list_transform(string_split(substr(bits, (5 * i + 1)::bigint, 5), ''),
        lambda b: b::int), lambda a, b: 2 * a + b)) + 1]), '') as payload_digest,
  case when page_id = keep then 'response' else 'revisit' end as record_type,
  case when page_id < keep then keep end as refers_to
from hashed
"""

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

_OP11 = f"""
with docs as (
  select doc_id, row_number() over () as nr, regexp_extract_all({_LOWER}, {_WORDS}) as w
  from documents
), items as (
  select item_id, regexp_extract_all({_LOWER}, {_WORDS}) as w from benchmark
), windows as (
  select distinct item_id, least(10, len(w)) as size,
    unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2),
      lambda i: array_to_string(w[i:i + 9], ' '))) as passage
  from items where len(w) > 0
), places as (
  select nr, w, unnest(range(1, len(w) + 1)) as first from docs
), hits as (
  select nr, first, size, item_id
  from (select nr, first, size, array_to_string(w[first:first + size - 1], ' ') as passage
    from places, (select distinct size from windows) where first + size - 1 <= len(w))
  join windows using (size, passage)
), covered as (
  select nr, count(distinct place) as n_hit
  from (select nr, unnest(range(first, first + size)) as place from hits) group by nr
), named as (
  select nr, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct nr, item_id::varchar as item from hits where item_id is not null) group by nr
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (nr) left join named using (nr)
"""

_OP12 = f"""
with recursive bits as (
  select range as byte, range as c, 0 as step from range(256)
  union all
  select byte, case when c % 2 = 1 then xor(c >> 1, {_CRC}::bigint) else c >> 1 end, step + 1
  from bits where step < 8
), crc as (
  select list(c order by byte) as t from bits where step = 8
), docs as (
  select row_number() over () as nr, doc_id, regexp_extract_all({_LOWER}, {_WORDS}) as w
  from documents
), source as (
  select nr, unnest(w) as word from docs
), target as (
  select unnest(regexp_extract_all({_LOWER}, {_WORDS})) as word from benchmark
), hashed as (
  select word, xor(list_reduce(
      list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: ('0x' || h)::bigint),
      lambda c, b: xor(c >> 8, crc.t[(xor(c & 255, b) + 1)::int]), 4294967295::bigint),
    4294967295) % 10000 as bucket
  from (select word from source union select word from target), crc
), counted as (
  select bucket, sum(s) as s, sum(t) as t from (
    select bucket, count(*) as s, 0 as t from source join hashed using (word) group by bucket
    union all
    select bucket, 0, count(*) from target join hashed using (word) group by bucket)
  group by bucket
), gains as (
  select bucket, floor(1000 * ln(((t + 1) * (sum(s) over () + 10000))::double
    / ((s + 1) * (sum(t) over () + 10000))::double))::bigint as gain
  from counted
), weights as (
  select nr, count(*) as n, sum(gain)::bigint as weight
  from source join hashed using (word) join gains using (bucket) group by nr
), scored as (
  select doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln(((
      '0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
      / 4294967296::double)))::bigint as score
  from docs left join weights using (nr)
), ranked as (
  select *, row_number() over (partition by n_features >= 20
    order by score desc, doc_id nulls last, n_features) as place,
    count(*) over (partition by n_features >= 20) as n
  from scored
)
select doc_id, n_features, weight, score,
  case when n_features >= 20 and place <= 10 * n // 100 then place end::bigint as rank
from ranked
"""

_OP13 = """
with vectors as (
  select row_number() over () as nr, vec_id as id,
    case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.nr, a.id as anchor, c.nr as other, c.id, a.label = c.label as same,
    coalesce(list_sum(list_transform(range(1, least(len(a.v), len(c.v)) + 1),
      lambda i: a.v[i] * c.v[i])), 0)::bigint as score
  from vectors a join vectors c on a.id % 50 = 0 and a.nr <> c.nr
), positives as (
  select nr, anchor, id, score, other from (
    select *, row_number() over (partition by nr order by score desc, id nulls last, other) as place
    from scored where same)
  where place <= 5
), mined as (
  select p.anchor as anchor_id, p.id as positive_id, n.id as negative_id,
    p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.nr, p.other order by n.score desc, n.id nulls last) as rank
  from positives p join scored n on p.nr = n.nr and not n.same
    and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score
from mined where rank <= 3
"""

ORACLES = {
    "op1_interleave": _OP1,
    "op2_stream_dedup": _OP2,
    "op6_bit_sliced": _OP6,
    "op8_dictionary_warc": _OP8,
    "op11_automaton_decontamination": _OP11,
    "op12_median_resampling": _OP12,
    "op13_sorted_negatives": _OP13,
}
