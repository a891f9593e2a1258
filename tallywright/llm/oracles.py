"""DuckDB SQL of the operators' contracts, written from the contracts and not from the Spark plans."""

from __future__ import annotations


def _bid(shard: int) -> str:
    digits = f"substr(md5(concat(doc_id, ':', {shard})), 1, 13)"
    return f"-ln((('0x' || {digits})::bigint::double + 0.5) / 4503599627370496.0)"


def _winner(shards: int) -> str:
    bids = ", ".join(_bid(i) for i in range(shards))
    return f"(list_position([{bids}], list_min([{bids}])) - 1)::int"


#: CRC-32 byte by byte: the register after each byte comes from the table of the reflected polynomial.
_CRC = """
crc_table as (
  select list(list_reduce(list_prepend(i, range(8)),
    lambda c, e: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) t
  from range(256) r(i)
)"""

OP7 = f"""
with {_CRC},
bytes as (
  select doc_id, coalesce(text, '') body,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint) b
  from documents
),
sized as (
  select doc_id, (len(b) + 1)::bigint size,
    xor(list_reduce(list_prepend(4294967295::bigint, b),
      lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295)::bigint text_crc32
  from bytes, crc_table
),
dealt as (select *, {_winner(8)} shard, {_winner(9)} grown_shard from sized)
select doc_id, size, text_crc32, 'key' law, shard, grown_shard,
  row_number() over (
    partition by shard order by ('0x' || substr(md5(concat('slice:', doc_id)), 1, 13))::bigint % 4096, doc_id, text_crc32
  ) - 1 slot
from dealt
"""

_SHARES = (
    ("n_symbols", "n_words", 20, 700),
    ("n_dup_lines", "n_lines", 45, 700),
    ("n_repeat_words", "n_words", 45, 500),
    ("word_chars", "n_words", 100, 20000),
)

_SHARE_ROWS = " union all ".join(
    f"select *, {k} k, case when {b} > 0 then {a} * 1000 // {b} else 0 end v, {unit} unit, {high} high from base"
    for k, (a, b, unit, high) in enumerate(_SHARES)
)

OP8 = f"""
with words as (
  select doc_id, lang, source, coalesce(text, '') body,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w
  from documents
),
lines as (
  select doc_id, count(*) n_lines, count(*) - count(distinct line) n_dup_lines
  from (select doc_id, unnest(string_split(body, chr(10))) line from words)
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id
),
places as (select doc_id, w, unnest(range(1, len(w) - 1)) i from words),
windows as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) n from places),
hits as (
  select doc_id, count(distinct p) n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) p from windows where n > 1) group by doc_id
),
counted as (
  select doc_id, lang, source, len(w)::bigint n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
    coalesce(n_dup_lines, 0)::bigint n_dup_lines, coalesce(n_lines, 0) n_lines, coalesce(n_repeat_words, 0)::bigint n_repeat_words
  from words left join lines using (doc_id) left join hits using (doc_id)
),
base as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from counted),
shares as ({_SHARE_ROWS}),
good as (select *, least(v, 2 * high) // 5 bin from shares where not base_failed),
ranked as (
  select lang, source, k, bin,
    row_number() over (partition by lang, source, k order by bin) r_s, count(*) over (partition by lang, source, k) n_s,
    row_number() over (partition by lang, k order by bin) r_l, count(*) over (partition by lang, k) n_l,
    row_number() over (partition by k order by bin) r_e, count(*) over (partition by k) n_e
  from good
),
every as (
  select k, min(bin) filter (4 * r_e >= n_e) * 5 a, min(bin) filter (4 * r_e >= 3 * n_e) * 5 b from ranked group by k
),
langs as (
  select lang, k, min(bin) filter (4 * r_l >= n_l) * 5 a, min(bin) filter (4 * r_l >= 3 * n_l) * 5 b, max(n_l) n
  from ranked group by lang, k
),
sources as (
  select lang, source, k, min(bin) filter (4 * r_s >= n_s) * 5 a, min(bin) filter (4 * r_s >= 3 * n_s) * 5 b, max(n_s) n
  from ranked group by lang, source, k
),
drawn as (
  select s.lang, s.source, s.k, (s.n * s.a + 200 * l.a + 20 * e.a) // (s.n + 220) a, (s.n * s.b + 200 * l.b + 20 * e.b) // (s.n + 220) b
  from sources s join langs l on s.lang is not distinct from l.lang and s.k = l.k join every e on s.k = e.k
),
verdict as (
  select doc_id, bool_and(coalesce(v <= least(high, b + 8 * greatest(b - a, unit)), false)) fits
  from shares s left join drawn c on s.lang is not distinct from c.lang and s.source is not distinct from c.source and s.k = c.k
  group by doc_id
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and fits kept
from base join verdict using (doc_id)
"""

OP6 = """
with doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w
  from documents
),
item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w
  from benchmark
),
sizes as (select distinct least(len(w), 10) k from item where len(w) > 0),
wanted as (
  select distinct item_id, k, array_to_string(w[i : i + k - 1], ' ') body
  from (select item_id, w, least(len(w), 10) k, unnest(range(1, len(w) - least(len(w), 10) + 2)) i from item where len(w) > 0)
),
found as (
  select doc_id, i, k, item_id
  from (
    select doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') body
    from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) i from doc, sizes where len(w) >= k)
  ) join wanted using (k, body)
),
hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + k)) p from found) group by doc_id),
items as (
  select doc_id, count(*) n_items, string_agg(id, ',' order by id) ids
  from (select distinct doc_id, item_id::varchar id from found) group by doc_id
)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from doc left join hit using (doc_id) left join items using (doc_id)
"""

OP10 = """
with line as (
  select doc_id, i, l, md5(l) h
  from (
    select doc_id, unnest(range(1, len(ls) + 1)) i, unnest(ls) l
    from (select doc_id, string_split(text, chr(10)) ls from documents where text is not null)
  )
),
cut as (
  select *, coalesce(lag(ends) over (partition by doc_id order by i), 1) begins
  from (
    select doc_id, i, l, case when ('0x' || substr(md5(concat(coalesce(lag(h) over w, ''), h)), 1, 8))::bigint % 3 = 0
      then 1 else 0 end ends
    from line window w as (partition by doc_id order by i)
  )
),
part as (select doc_id, i, l, sum(begins) over (partition by doc_id order by i) k from cut),
chunk as (select doc_id, k, count(*) n, string_agg(l, chr(10) order by i) body from part group by doc_id, k),
judged as (
  select *, n >= 2 and row_number() over (partition by body, n >= 2 order by doc_id, k) > 1 gone from chunk
),
result as (
  select doc_id, sum(n)::bigint n_lines, coalesce(sum(n) filter (gone), 0)::bigint n_removed_lines,
    count(*) filter (gone) n_removed_chunks, coalesce(string_agg(body, chr(10) order by k) filter (not gone), '') kept
  from judged group by doc_id
)
select doc_id, coalesce(n_lines, 0)::bigint n_lines, coalesce(n_removed_lines, 0)::bigint n_removed_lines,
  coalesce(n_removed_chunks, 0)::bigint n_removed_chunks, sha256(coalesce(kept, '')) kept_sha256
from documents left join result using (doc_id)
"""

OP2 = """
with payload as (
  select page_id, strlen(coalesce(html, '')) payload_bytes, sha1(coalesce(html, '')) payload_digest,
    max(page_id) over (partition by coalesce(html, '')) top
  from pages
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and top <> page_id then 'revisit' else 'response' end record_type,
  case when payload_bytes >= 1000 and top <> page_id then top end refers_to
from payload
"""

SQL = {
    "op2_warc_ranges": OP2,
    "op10_line_chunks": OP10,
    "op6_suffix_automaton": OP6,
    "op7_rendezvous_sharding": OP7,
    "op8_quality_rules": OP8,
}
