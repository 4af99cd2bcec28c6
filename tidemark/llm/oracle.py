"""DuckDB SQL of the corpus queries that SQL can express, over the whole tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# crc32 by its table, which the first two steps build from the polynomial
QUALITY = rf"""
with bytes_table as (
  select list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text, {WORDS} as ws from documents
), words as (
  select r, unnest(ws) as w, unnest(range(len(ws))) as i from docs
), coded as (
  select w, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(strlen(w)), lambda b: ('0x' || substr(hex(encode(w)), 2 * b + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as code
  from (select distinct w from words), bytes_table
), placed as (
  select r, i, w, code, lead(code) over (partition by r order by i) as after,
    lead(w) over (partition by r order by i) as w2, lead(w, 2) over (partition by r order by i) as w3
  from words join coded using (w)
), grams as (
  select r, code % 16384 as b from placed
  union all select r, (code * 1000003 + after) % 16384 from placed where after is not null
), trusted as (
  select doc_id from (select distinct doc_id from labels where quality = 1 and toxic = 0 and doc_id is not null)
  order by md5(doc_id::varchar), doc_id limit 50000
), counts as (
  select range as b, count(r) as raw, count(good) as good
  from range(16384) left join (
    select g.r, g.b, case when d.doc_id in (select doc_id from trusted) then 1 end as good
    from grams g join docs d using (r)
  ) g on g.b = range
  group by range
), ratios as (
  select b, case when (select sum(good) from counts) = 0 then 0 else floor(1000000 * (ln(good + 1) - ln(raw + 1)
    + (ln((select sum(raw) from counts) + 16384) - ln((select sum(good) from counts) + 16384))) + 0.5) end::bigint as v
  from counts
), scores as (
  select r, sum(v)::bigint as llr_sum from grams join ratios using (b) group by r
), windows as (
  select r, i, count(*) over (partition by r, w, w2, w3) as n from placed where w3 is not null
), repeated as (
  select r, count(distinct i + k) as n from windows, range(3) t(k) where n > 1 group by r
), figures as (
  select doc_id, len(ws)::bigint as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - list_unique(lines))::bigint as n_dup_lines,
    coalesce(repeated.n, 0)::bigint as n_repeat_words, coalesce(llr_sum, 0)::bigint as llr_sum
  from (select *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from docs) left join repeated using (r) left join scores using (r)
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from figures
)
select *, not base_failed and llr_sum >= -55000 * greatest(2 * n_words - 1, 0) as kept from judged
"""

MIXING = """
with docs as (
  select doc_id, source, text, coalesce(doc_id::varchar, 'text ' || md5(text), 'null') as ident from documents
), sizes as (
  select source, coalesce(sum(length(text)), 0)::bigint as chars from docs group by source
), shares as (
  select source, case when chars > 0 then floor(
    pow(chars::double, 0.5) / sum(pow(chars::double, 0.5)) over () * sum(chars) over () / chars * 1e9 + 0.5)
    else 1e9 end as nanos
  from sizes
), means as (
  select source, greatest(ceil(nanos / 8e9), 1)::bigint as parts, nanos / 1e9 / greatest(ceil(nanos / 8e9), 1) as mean
  from shares
), steps as (
  with recursive s as (
    select source, 0 as k, mean, exp(-mean) as p, exp(-mean) as cdf from means
    union all select source, k + 1, mean, p * mean / (k + 1), cdf + p * mean / (k + 1) from s where k < 64
  ) select source, list(cdf order by k) as cdf from s group by source
), draws as (
  select d.*, cdf, unnest(range(1, parts + 1)) as j
  from docs d join means m on d.source is not distinct from m.source join steps s on d.source is not distinct from s.source
), counted as (
  select doc_id, source, text, ident, sum(len(list_filter(cdf, lambda c: c <=
    ('0x' || substr(md5(concat_ws('|', 'mix', ident, j)), 1, 13))::bigint / 4503599627370496.0::double))) as n
  from draws group by all
), copies as (
  select *, unnest(range(1, n::bigint + 1)) as copy from counted
)
select doc_id, source, copy, strlen(text)::bigint as n_bytes,
  ('0x' || substr(md5(concat_ws('|', 'mix-order', ident, copy)), 1, 13))::bigint / 4503599627370496.0::double as place
from copies
"""

SUFFIXES = """
with d as (
  select row_number() over () as r, doc_id, encode(coalesce(text, '')) as h, strlen(coalesce(text, '')) as n from documents
), w as (
  select r, p, md5(h[p + 1 : p + 400]) as m from (select r, h, unnest(range(0, n - 399)) as p from d where n >= 400)
), hits as (
  select r, p from w where m in (select m from w group by m having count(*) > 1)
), cut as (
  select *, coalesce(p > lag(p) over (partition by r order by p) + 400, true) as opens from hits
), islands as (
  select r, min(p) as a, max(p) + 400 as b from (
    select *, sum(opens::int) over (partition by r order by p) as k from cut) group by r, k
), gone as (
  select r, sum(b - a)::bigint as n_removed, count(*) as n_spans from islands group by r
), pieces as (
  select r, coalesce(lag(b) over (partition by r order by a), 0) as s, a as e from islands
  union all select r, max(b), null from islands group by r
  union all select r, 0, null from d where r not in (select r from islands)
), kept as (
  select r, string_agg(piece, '' order by s) as left_over, string_agg(
    regexp_replace(regexp_replace(piece, case when s > 0 then '^([89AB][0-9A-F]){1,3}' else '^$' end, ''),
      case when e is not null then '([CD][0-9A-F]|E[0-9A-F]([89AB][0-9A-F])?|F[0-9A-F]([89AB][0-9A-F]){0,2})$' else '^$' end, ''), '' order by s
  ) as whole_chars
  from (select r, s, e, hex(h[s + 1 : coalesce(e, n)]) as piece from pieces join d using (r)) group by r
)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(left_over)) as kept_sha256, (n - coalesce(n_removed, 0))::bigint as n_kept, decode(unhex(whole_chars)) as text
from d left join gone using (r) join kept using (r)
"""

WARC = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as s from pages),
first as (select html, min(page_id) as first_id from p group by html)
select page_id, strlen(html)::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(s, 10 * (i // 8) + 1, 10))::bigint >> (35 - 5 * (i % 8))) & 31)::int + 1, 1)), '') as payload_digest,
  case when page_id = first_id or first_id is null then 'response' else 'revisit' end as record_type,
  case when page_id = first_id then null else first_id end as refers_to
from p join first using (html)
"""

NEAR = rf"""
with recursive d as (
  select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') as ws
  from documents
), s as (
  select distinct r, array_to_string(ws[i + 1 : i + 5], ' ') as g
  from (select r, ws, unnest(range(greatest(1, len(ws) - 4))) as i from d where len(ws) > 0)
), sizes as (select r, count(*) as n from s group by r),
links as (
  select x.r as a, y.r as b from s x join s y using (g)
  join sizes nx on nx.r = x.r join sizes ny on ny.r = y.r
  where x.r <> y.r group by x.r, y.r, nx.n, ny.n having 100 * count(*) >= 75 * (nx.n + ny.n - count(*))
), reach as (
  select r, r as other from d union select reach.r, links.b from reach join links on links.a = reach.other
), told as (
  select reach.r, min(o.doc_id) as component_id from reach join d o on o.r = reach.other group by reach.r
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id is not distinct from component_id as kept
from d join told using (r) left join sizes using (r)
"""

VECTORS = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 5
"""

# crc32 of a text, given the byte table above as t: its bytes are taken one by one
CRC_TABLE = """
  select list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
"""


def crc(text: str) -> str:
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::bigint)"
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, {codes}),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


RESAMPLING = rf"""
with bytes_table as ({CRC_TABLE}), texts as (
  select row_number() over () as r, doc_id, text, true as is_doc from documents
  union all select -row_number() over (), null, text, false from benchmark
), split as (
  select r, doc_id, is_doc, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from texts
), grams as (
  select r, is_doc, unnest(ws) as g from split
  union all select r, is_doc, ws[i] || ' ' || ws[i + 1] from (select *, unnest(range(1, len(ws))) as i from split)
), coded as (
  select g, {crc('g')} % 10000 as b from (select distinct g from grams), bytes_table
), placed as (select r, is_doc, b from grams join coded using (g)),
counts as (
  select range as b, count(*) filter (is_doc) as s, count(*) filter (not is_doc) as t
  from range(10000) left join placed on b = range group by range
), gains as (
  select b, floor(1000 * ln((t + 1)::double * ((select sum(s) from counts) + 10000)::double
    / ((s + 1)::double * ((select sum(t) from counts) + 10000)::double)))::bigint as gain from counts
), weights as (
  select r, floor(sum(gain) / count(*)::double)::bigint as weight from placed join gains using (b) group by r
), scored as (
  select r, doc_id, len(ws) as n_words, greatest(2 * len(ws) - 1, 0)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint::double + 0.5)
      / 4294967296)))::bigint as score
  from split left join weights using (r) where is_doc
), ranked as (
  select r, row_number() over (order by score desc, doc_id nulls last) as place, count(*) over () as n from scored where n_words >= 20
)
select doc_id, n_features, weight, score, case when place <= 25 * n // 100 then place end as rank
from scored left join ranked using (r)
"""

AUDIT = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents
), w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from d),
judged as (
  select r, part, doc_id in (select doc_id from labels where quality = 1) as good, doc_id in (select doc_id from labels where toxic = 1) as toxic,
    case when len(ws) < 200 then 'A' else '' end
    || case when 100 * list_unique(ws) < 50 * len(ws) then 'B' else '' end
    || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) then 'C' else '' end
    || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
    || case when exists (select 1 from d e where e.text = w.text and e.doc_id < w.doc_id) then 'E' else '' end as fails
  from w
), letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as c),
every as (
  select a.c || b.c || c.c || d.c || e.c as filter_order from letters a, letters b, letters c, letters d, letters e
  where list_unique([a.c, b.c, c.c, d.c, e.c]) = 5
), walked as (
  select part, filter_order, step, substr(filter_order, step::int, 1) as own, good, toxic, fails,
    case when fails = '' then 6 else list_min(list_transform(string_split(fails, ''), lambda c: strpos(filter_order, c))) end as falls
  from judged, every, range(1, 6) s(step)
), steps as (
  select part, filter_order, step::int as step, any_value(own) as own, count(*) filter (falls > step) as kept, count(*) filter (falls = step) as removed,
    count(*) filter (falls < step and contains(fails, own)) as redundant, count(*) filter (fails = own) as unique_fails,
    count(*) filter (falls = step and good) as good_lost, count(*) filter (falls = step and toxic) as toxic_lost
  from walked group by part, filter_order, step
)
select * exclude (own), sum(removed) over (partition by part, own)::bigint as shapley from steps
"""

SHARDS = rf"""
with bytes_table as ({CRC_TABLE}), d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), crcs as (select text, {crc('text')} as text_crc32 from (select distinct text from d), bytes_table),
draws as (
  select r, k, ('0x' || substr(md5(concat_ws('|', 'shard', coalesce(doc_id::varchar, 'null'), k)), 1, 13))::bigint as h from d, range(41) s(k)
), chosen as (
  select r, arg_max(k, (h, -k)) filter (k < 40) as shard, arg_max(k, (h, -k)) as grown_shard from draws group by r
)
select doc_id, (strlen(text) + 16)::bigint as size, text_crc32, 'key' as law, shard::int as shard,
  row_number() over (partition by shard order by doc_id nulls last, text_crc32, strlen(text)) - 1 as slot, grown_shard::int as grown_shard
from d join crcs using (text) join chosen using (r)
"""

ORACLES = {
    "op1_quality_llr": QUALITY,
    "op2_mixing": MIXING,
    "op3_suffix_dedup": SUFFIXES,
    "op4_warc": WARC,
    "op8_near_duplicates": NEAR,
    "op9_top_vectors": VECTORS,
    "op11_resampling": RESAMPLING,
    "op12_filter_audit": AUDIT,
    "op13_sharding": SHARDS,
}
