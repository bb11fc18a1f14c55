"""DuckDB SQL for the queries that SQL can express, written from the contracts and not from the operators."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = """
with recursive crc(i, k, c) as (
  select i, 0, i from range(256) t(i)
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc where k < 8),
polynomial as (select list(c order by i) as entries from crc where k = 8),
ids as (select distinct doc_id, (doc_id::hugeint + 18446744073709551616) % 18446744073709551616 as id from documents),
jumps(doc_id, state, first_state, shard, after) as (
  select doc_id, id, null::hugeint, -1::bigint, 0::bigint from ids
  union all
  select doc_id, state1, coalesce(first_state, state1), after,
    floor((after + 1) * (2147483648.0::double / ((state1 >> 33) + 1)::double))::bigint
  from (select *, (state * 2862933555777941757 + 1) % 18446744073709551616 as state1 from jumps where after < 24)),
placed as (
  select doc_id, shard::integer as shard, (case when after = 24 then 24 else shard end)::integer as grown_shard,
    ((first_state >> 12) & 2097151) % 1024 as cell
  from jumps where after >= 24),
texts as (select doc_id, coalesce(text, '') as text from documents),
sums as (
  select doc_id, (octet_length(encode(text)) + 8)::bigint as size,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::bigint)),
      lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295)::bigint as text_crc32
  from texts, polynomial)
select doc_id, size, text_crc32, 'key' as law, shard, row_number() over (partition by shard order by cell, doc_id, text_crc32, size) - 1 as slot, grown_shard
from sums join placed using (doc_id)
"""

OP4 = f"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
lines as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as place from split),
keyed as (select *, {LOWER.format("regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')")} as key from lines),
common as (select key, max(doc_id) as owner from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
marked as (select k.*, c.key is not null and k.doc_id < c.owner as dropped from keyed k left join common c on k.key = c.key)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '')) as kept_sha256
from marked group by doc_id
"""

WORDS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP7 = f"""
with items as (select item_id, {WORDS} as ws from benchmark where text is not null),
windows as (
  select distinct item_id, least(len(ws), 10) as size, array_to_string(list_slice(ws, pos, pos + least(len(ws), 10) - 1), ' ') as words
  from (select *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as pos from items where len(ws) > 0)),
docs as (select doc_id, {WORDS} as ws from documents),
sizes as (select distinct size from windows),
grams as (
  select doc_id, size, pos, array_to_string(list_slice(ws, pos, pos + size - 1), ' ') as words
  from (select doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) as pos from docs, sizes where len(ws) >= size)),
hits as (select doc_id, item_id, pos, size from grams join windows using (size, words)),
hit_words as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(pos, pos + size)) as place from hits) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit_words using (doc_id) left join hit_items using (doc_id)
"""

_KINDS = (
    (1, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 0.9, "mail|contact|write|reach"),
    (2, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda p: p::hugeint)) <= 255", 0.6, "address|host|server|login"),
    (3, "card", r"[0-9](?:[\x20-]?[0-9])+", "length(digits) between 13 and 19 and luhn % 10 = 0", 0.8, "card|visa|credit|payment"),
    (4, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) between 9 and 15", 0.6, "phone|call|mobile|fax"),
    (5, "iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?", "mod97 = 1 and not regexp_matches(around, '[A-Za-z0-9]')", 0.8, "iban|account|bank|transfer"),
    (6, "identity", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "not regexp_matches(m, '^(000|666|9)|-00-|0000$') and not regexp_matches(around, '[0-9-]')", 0.3, "social security|identity"),
)


def _found(place: int, kind: str, pattern: str, check: str, score: float, words: str) -> str:
    return f"""
select doc_id, kind, place, start_at, end_at, score from (
  select *, {score}::double + case when regexp_matches(substr(text, greatest(start_at - 40, 0)::bigint + 1, start_at::bigint - greatest(start_at - 40, 0)::bigint), '(?i){words}')
    then 0.3::double else 0 end as score,
    regexp_replace(m, '[^0-9]', '', 'g') as digits,
    list_sum(list_transform(range(length(digits)), lambda i: case when i % 2 = 0 then substr(reverse(digits), i + 1, 1)::bigint
      else (substr(reverse(digits), i + 1, 1)::bigint * 2) // 10 + (substr(reverse(digits), i + 1, 1)::bigint * 2) % 10 end)) as luhn,
    replace(m, ' ', '') as plain,
    case when place = 5 then list_reduce(list_prepend(0::bigint, list_transform(regexp_extract_all(substr(plain, 5) || substr(plain, 1, 4), '.'), lambda c: ascii(c)::bigint)),
      lambda a, c: (case when c >= 65 then a * 100 + c - 55 else a * 10 + c - 48 end) % 97) end as mod97,
    (case when start_at > 0 then substr(text, start_at::bigint, 1) else '' end) || substr(text, end_at::bigint + 1, 1) as around
  from (
    select *, sum(length(gap) + length(m)) over (partition by doc_id order by i) as end_at, end_at - length(m) as start_at
    from (
      select doc_id, text, '{kind}' as kind, {place} as place, unnest(ms) as m, unnest(list_slice(gaps, 1, len(ms))) as gap, generate_subscripts(ms, 1) as i
      from (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{pattern}') as ms,
        regexp_split_to_array(coalesce(text, ''), '{pattern}') as gaps from documents))))
where {check}"""


OP8 = f"""
with found as ({" union all ".join(_found(*kind) for kind in _KINDS)}),
kept as (select *, concat_ws(':', kind, start_at::bigint, end_at::bigint) as span from found where place <= 4 or score >= 0.5),
joined as (
  select doc_id, string_agg(span, ',' order by place, start_at) as spans, string_agg(span, ',' order by place, start_at) filter (place <= 4) as base,
    {", ".join(f"count(*) filter (place = {n}) as n_{kind}" for n, kind, *_ in _KINDS[:4])}, least(max(score), 1.0::double) as max_score
  from kept group by doc_id)
select doc_id, {", ".join(f"coalesce(n_{kind}, 0)::bigint as n_{kind}" for _, kind, *_ in _KINDS[:4])},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, max_score
from documents left join joined using (doc_id)
"""

ORACLES = {"op2_jump_shards": OP2, "op4_line_dedup": OP4, "op7_decontamination": OP7, "op8_personal_data": OP8}
