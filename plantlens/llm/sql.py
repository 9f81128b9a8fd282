"""DuckDB texts that must give the rows of the queries.

Names in braces are fixed pieces of SQL, filled in below.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
WORD = r"[^\x20\x09-\x0D]+"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANKS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

MIX = rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 8))::bigint as u
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as n, row_number() over (order by source nulls last) - 1 as rank
  from sized group by source),
weighed as (select *, ([3, 1, 2])[rank % 3 + 1] as w from sources),
levels as (
  select *, (sum(n) over () * 1.5::double
             - 2 * coalesce(sum(n) over (order by n::double / w, rank
                                         rows between unbounded preceding and 1 preceding), 0))::double
            / (sum(w) over () - coalesce(sum(w) over (order by n::double / w, rank
                                         rows between unbounded preceding and 1 preceding), 0)) as level
  from weighed),
chosen as (select max(level) as level from levels),
targets as (
  select l.source, n, least((2 * n)::double, coalesce(w * c.level, (2 * n)::double)) as target
  from levels l, chosen c),
needs as (
  select *, case when n > 0 then cast(floor(target / n) as bigint) else 0 end as whole from targets),
ranked as (
  select d.doc_id, d.size, t.n, t.target, t.whole,
         cast(floor(t.target + 0.5) as bigint) - t.whole * t.n as need,
         coalesce(sum(d.size) over (partition by d.source order by d.u, d.doc_id, d.size
                                    rows between unbounded preceding and 1 preceding), 0) as ahead
  from sized d join needs t on d.source is not distinct from t.source)
select doc_id, cast(size as bigint) as size, n as source_size, target,
       cast(whole * size + greatest(0, least(size, need - ahead)) as bigint) as taken
from ranked
"""

LINE_DEDUP = rf"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') as key from lines),
shared as (
  select key, min(doc_id) as keeper from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2),
marked as (
  select k.*, s.key is not null and k.doc_id <> s.keeper as dropped
  from keyed k left join shared s on k.key = s.key)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""

DECONTAMINATE = rf"""
with d as (select doc_id, regexp_extract_all({FOLDED}, '{ITEM_WORD}') as w from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all({FOLDED}, '{ITEM_WORD}') as w from benchmark),
windows as (
  select item, len(w) as size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as pos, w from b where len(w) > 0),
phrases as (
  select distinct item, least(size, 10) as size, array_to_string(w[pos:pos + 9], ' ') as phrase from windows),
sizes as (select distinct size from phrases),
places as (
  select doc_id, s.size, unnest(range(1, len(w) - s.size + 2)) as pos, w
  from d, sizes s where len(w) >= s.size),
hits as (
  select p.doc_id, p.pos, p.size, x.item
  from (select doc_id, pos, size, array_to_string(w[pos:pos + size - 1], ' ') as phrase from places) p
  join phrases x on p.phrase = x.phrase and p.size = x.size),
words as (
  select doc_id, count(distinct word) as n_hit
  from (select distinct doc_id, pos, size, unnest(range(pos, pos + size)) as word from hits) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words on d.doc_id = words.doc_id left join items on d.doc_id = items.doc_id
"""

_FENCES = {"symbols": 0.05, "dup_lines": 0.50, "repeat_words": 0.25, "word_length": 3.0}

QUALITY_RULES = rf"""
with d as (
  select doc_id, lang, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) as line from d)
  where regexp_matches(line, '{WORD}') group by doc_id),
spots as (
  select doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] as gram
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as p from d where len(w) >= 3)),
twice as (select doc_id, gram from spots group by doc_id, gram having count(*) >= 2),
inside as (
  select doc_id, count(distinct word) as n_repeat_words
  from (select doc_id, unnest(range(p, p + 3)) as word from spots semi join twice using (doc_id, gram))
  group by doc_id),
m as (
  select d.doc_id, lang, source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, coalesce(n_lines, 0) as n_lines,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from d left join lines using (doc_id) left join inside using (doc_id)),
r as (
  select doc_id, lang, source, unnest(['symbols', 'dup_lines', 'repeat_words', 'word_length']) as rule,
         unnest([n_symbols::double / greatest(word_chars, 1), n_dup_lines::double / greatest(n_lines, 1),
                 n_repeat_words::double / greatest(n_words, 1), word_chars::double / greatest(n_words, 1)]) as ratio
  from m),
sketch as (
  select lang, source, rule, case when ratio > 0 then cast(ceil(ln(ratio) / ln(1.02::double)) as int) end as bucket,
         count(*) as n
  from r group by all),
ranked as (
  select *, sum(n) over (partition by lang, source, rule order by bucket nulls first
                         rows between unbounded preceding and current row) as upto,
         sum(n) over (partition by lang, source, rule) as total,
         coalesce(2 * pow(1.02::double, bucket) / 2.02::double, 0) as v
  from sketch),
quartiles as (
  select lang, source, rule, min(v) filter (where upto >= 0.25 * total) as q1,
         min(v) filter (where upto >= 0.5 * total) as q2, min(v) filter (where upto >= 0.75 * total) as q3
  from ranked group by lang, source, rule),
bounds as (
  select *, case rule {" ".join(f"when '{k}' then {v}::double" for k, v in _FENCES.items())} end as slack
  from quartiles),
bad as (
  select distinct r.doc_id from r join bounds f
  on r.rule = f.rule and r.lang is not distinct from f.lang and r.source is not distinct from f.source
  where ratio > q2 + greatest(4 * (q3 - q2), slack)
     or r.rule = 'word_length' and ratio < q2 - greatest(4 * (q2 - q1), slack))
select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and bad.doc_id is null as kept
from m left join bad on m.doc_id = bad.doc_id
"""

NGRAM_JOIN = rf"""
with recursive d as materialized (select doc_id, regexp_extract_all({FOLDED}, '{WORD}') as w from documents),
shingles as materialized (
  select distinct doc_id, case when len(w) >= 4 then array_to_string(w[p:p + 3], ' ')
                               else 'short ' || array_to_string(w, ' ') end as gram
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as p from d where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as common
  from shingles x join shingles y on x.gram = y.gram and x.doc_id < y.doc_id group by x.doc_id, y.doc_id),
links as materialized (
  select a, b from shared join sizes p on a = p.doc_id join sizes q on b = q.doc_id
  where 100 * common >= 85 * (p.n + q.n - common)),
both_ways as materialized (select a, b from links union select b, a from links),
reach as (
  select doc_id as node, doc_id as other from d
  union
  select r.node, e.b from reach r join both_ways e on r.other = e.a)
select d.doc_id, coalesce(n, 0) as n_shingles, c.component_id
from d left join sizes using (doc_id)
join (select node, min(other) as component_id from reach group by node) c on d.doc_id = c.node
"""


def _license_sql() -> str:
    from plantlens.llm import license_scan as L

    templates = ", ".join(
        f"('{label}', {L.tokens(text)}, {L.need(L.tokens(text))})" for label, text in L.TEMPLATES
    )
    spots = " union all ".join(
        f"select doc_id, '{label}' as label, p - 1 as spot from places where array_to_string(w[p:p + {n - 1}], ' ') = '{phrase}'"
        for phrase, label in L.PHRASES for n in [len(phrase.split())]
    )
    return rf"""
with d as (select doc_id, {FOLDED} as t, regexp_extract_all({FOLDED}, '{ITEM_WORD}') as w from documents),
places as (select doc_id, w, unnest(range(1, len(w) + 1)) as p from d where list_contains(w, 'license')),
spots as ({spots}),
base as (
  select doc_id, count(*) as n_base, min(spot) as first_word, max(spot) as last_word,
         string_agg(distinct label, ',' order by label) as base_labels from spots group by doc_id),
lines as (
  select doc_id, regexp_extract_all(line, '{ITEM_WORD}') as w
  from (select doc_id, unnest(string_split(t, chr(10))) as line from d)),
blocks as (
  select doc_id, list_distinct(w[p:p + {2 * L.LONGEST - 1}]) as held
  from (select doc_id, w, unnest(range(1, greatest(len(w) - {L.LONGEST}, 1) + 1, {L.LONGEST})) as p from lines)),
templates(label, words, need) as (values {templates}),
met as (
  select doc_id, label, len(list_intersect(held, words))::double / len(words) as share
  from blocks, templates where len(list_intersect(held, words)) >= need),
found as (select doc_id, max(share) as share from met group by doc_id),
every as (
  select doc_id, string_agg(label, ',' order by label) as labels
  from (select distinct doc_id, label from met union select distinct doc_id, label from spots) group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       case when n_base > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from d left join base on d.doc_id = base.doc_id left join found on d.doc_id = found.doc_id
left join every on d.doc_id = every.doc_id
"""


LICENSE_SCAN = _license_sql()

FILL_MIDDLE = r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as hex
  from documents),
drawn as (
  select *, cast(len(units) as bigint) as n,
         ('0x' || substr(hex, 1, 8))::bigint as h1, ('0x' || substr(hex, 9, 8))::bigint as h2,
         ('0x' || substr(hex, 17, 8))::bigint as h3, ('0x' || substr(hex, 25, 8))::bigint as h4
  from d),
cut as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn),
parts as (
  select doc_id, n, form, t,
         case when form <> 'plain' then array_to_string(units[1:a], '') end as prefix,
         case when form <> 'plain' then array_to_string(units[a + 1:b], '') end as middle,
         case when form <> 'plain' then array_to_string(units[b + 1:], '') end as suffix
  from cut)
select doc_id, n, form, cast(length(prefix) as bigint) as prefix_chars, cast(length(middle) as bigint) as middle_chars,
       sha256(case form when 'plain' then t
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from parts
"""

COLLOCATIONS = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({FOLDED}, '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
places as (select lang, w, unnest(range(1, len(w) + 1)) as pos from words where len(w) > 0),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
found as (
  select lang, s.size, array_to_string(w[pos:pos + s.size - 1], ' ') as phrase, count(*) as f
  from places, (values (1), (2), (3)) s(size) where pos + s.size - 1 <= len(w)
  group by all having count(*) >= 10),
cuts as (
  select lang, size, phrase, f, string_split(phrase, ' ') as w, unnest(range(1, size)) as k from found where size > 1),
scored as (
  select c.lang, c.size, c.phrase, c.f as a, k, x.f as l, y.f as r,
         cast(1000000::hugeint * c.f * c.f // (x.f::hugeint * y.f) as bigint) as score
  from cuts c
  join found x on x.lang = c.lang and x.phrase = array_to_string(w[1:k], ' ')
  join found y on y.lang = c.lang and y.phrase = array_to_string(w[k + 1:], ' ')),
lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, f
  from (select distinct lang, phrase, f, w from cuts where size = 3)),
longest as (select lang, phrase, max(f) as f from inside group by all),
alone as (
  select s.* from lowest s left join longest x on s.size = 2 and x.lang = s.lang and x.phrase = s.phrase
  where x.f is null or 100 * x.f < 50 * s.a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from alone)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
