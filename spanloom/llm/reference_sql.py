"""DuckDB SQL for the queries of this subpackage."""

from __future__ import annotations

from spanloom.llm.license_scan import TEMPLATES

#: Words [^\x20\x09-\x0D]+ of a text as a list, in DuckDB.
WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP3 = rf"""
with d as (select doc_id, source, coalesce(text, '') as text, {WORDS} as w from documents),
g as (
  select doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: list_aggregate(w[i:i+4], 'string_agg', ' '))) as g,
         unnest(range(1, greatest(len(w) - 3, 1))) as i
  from d where len(w) >= 5),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from g) where n > 1),
covered as (select doc_id, count(distinct i + k) as n from twice, range(0, 5) r(k) group by doc_id),
lines as (select doc_id, source, unnest(string_split(text, chr(10))) as line from d),
norm as (
  select doc_id, source, line,
         trim(translate(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as k
  from lines),
filled as (select *, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) as n from norm where k <> ''),
common as (select coalesce(source, '') as source, k from filled group by 1, 2 having count(distinct doc_id) > 20),
by_doc as (
  select f.doc_id, count(*) - count(distinct line) as n_dup_lines, sum(case when c.k is null then n else 0 end) as n_left
  from filled f left join common c on coalesce(f.source, '') = c.source and f.k = c.k group by f.doc_id),
s as (
  select d.doc_id, len(w)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words, coalesce(n_left, 0)::bigint as n_words_left
  from d left join by_doc using (doc_id) left join covered c using (doc_id)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and n_words_left >= 10 and n_words_left >= 0.5 * n_words as kept, n_words_left
from b
"""

_ESCAPED = "replace(replace(replace(replace(replace({0}, '\\', '\\\\'), '<s>', '<\\s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]'), '</s>', '<\\/s>')"
OP1 = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(20 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::bigint as formatted_chars
from c group by conv_id
"""

OP8 = rf"""
with d as (select doc_id, {WORDS} as w from documents),
g as (
  select doc_id, unnest(range(1, greatest(len(w) - 11, 1))) as i,
         unnest(list_transform(range(1, greatest(len(w) - 11, 1)), lambda i: list_aggregate(w[i:i+12], 'string_agg', ' '))) as g
  from d where len(w) >= 13),
later as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by g) as f from g) where f < doc_id),
gone as (select distinct doc_id, i + k as i from later, range(0, 13) r(k)),
words as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from d),
kept as (
  select w.doc_id, count(g.i) as n_removed, coalesce(string_agg(word, ' ' order by w.i) filter (g.i is null), '') as t
  from words w left join gone g on w.doc_id = g.doc_id and w.i = g.i group by w.doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""

OP7 = rf"""
with recursive d as (select doc_id, {WORDS} as w from documents),
s as (
  select distinct doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i+4], 'string_agg', ' '))) as s from d where len(w) >= 5
  union all select doc_id, list_aggregate(w, 'string_agg', ' ') from d where len(w) between 1 and 4),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 10 * c >= 8 * (x.n + y.n - c)
  union all select x.doc_id, y.doc_id from d x join d y on x.doc_id <> y.doc_id and len(x.w) = 0 and len(y.w) = 0),
reach as (select doc_id as a, doc_id as b from d union select r.a, l.b from reach r join links l on r.b = l.a)
select a as doc_id, min(b) as class_id, coalesce((select count(*) from links l where l.a = reach.a), 0)::bigint as n_links from reach group by a
"""

_LICENSES = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))
_SCANNED = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2C\x2E\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
_SHINGLES = "list_distinct(list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: list_aggregate(w[i:i+4], 'string_agg', ' ')))"
OP10 = rf"""
with t as (select template, license, {_SCANNED} as w from (values {_LICENSES}) v(template, license, text)),
ts as (select template, license, len({_SHINGLES}) as n, unnest({_SHINGLES}) as s from t),
ds as (select doc_id, unnest({_SHINGLES}) as s from (select doc_id, {_SCANNED} as w from documents)),
found as (select doc_id, template, license, n, round(count(distinct s) / n, 6) as containment from ds join ts using (s) group by doc_id, template, license, n having round(count(distinct s) / n, 6) >= 0.8),
rivals as (select a.template, b.template as rival from ts a join ts b on a.s = b.s and a.template <> b.template group by a.template, b.template, a.n having count(*) >= 0.8 * a.n),
best as (select * from found f where not exists (select 1 from rivals r join found g on g.template = r.rival and g.doc_id = f.doc_id where r.template = f.template and (g.containment > f.containment or g.containment = f.containment and g.n > f.n)))
select doc_id, license, count(*) as n_templates, max(containment) as containment from best group by doc_id, license
"""

_FOLDED = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
OP6 = rf"""
with d as (select doc_id, {_FOLDED} as w from documents), b as (select item_id, {_FOLDED} as w from benchmark),
dw as (select doc_id, len(w) as doc_size, unnest(w) as word, unnest(range(len(w))) as i from d),
bw as (select item_id, len(w) as item_size, least(13, len(w)) as size, case when len(w) >= 13 then 2 else 2 * len(w) // 13 end as allowed, unnest(w) as word, unnest(range(len(w))) as j from b),
m as (select doc_id, item_id, i - j as shift, i, size, allowed, greatest(i - j, 0) as low, least(doc_size, i - j + item_size) as high from dw join bw using (word)),
close as (select doc_id, item_id, shift from m group by all having count(*) >= any_value(size - allowed)),
same as (select m.* from m join close using (doc_id, item_id, shift)),
windows as (
  select doc_id, item_id, shift, any_value(size) as size, i - k as start from same, range(0, 13) r(k)
  where k < size and i - k >= low and i - k + size <= high group by doc_id, item_id, shift, i - k having count(*) >= any_value(size - allowed)),
covered as (select distinct doc_id, item_id, shift, start + k as i from windows, range(0, 13) r(k) where k < size),
found as (
  select c.doc_id, c.item_id, c.shift, min(c.i) as first_word, count(*) as n_words, count(s.i) as n_same
  from covered c left join same s on s.doc_id = c.doc_id and s.item_id = c.item_id and s.shift = c.shift and s.i = c.i group by c.doc_id, c.item_id, c.shift),
best as (select *, row_number() over (partition by doc_id, item_id order by n_same desc, first_word, shift) as k from found)
select doc_id, item_id, first_word, n_words, n_same from best where k = 1
"""

OP12 = r"""
with d as (select row_number() over () as r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
q as (select row_number() over () as i, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from benchmark),
words as (select r, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
asked as (
  select i, term, count(*) as k
  from (select i, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from q) group by i, term),
tf as (select r, term, count(*) as tf from words group by r, term),
size as (select r, count(*) as n from words group by r),
s as (select count(*) as docs, coalesce(sum(n), 0)::bigint as all_terms from size),
w as (select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from tf, s group by term),
m as (select r, 75 + ((25 * n * docs) // all_terms) as m from size, s),
scored as (
  select i, r, sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from asked join w using (term) join tf using (term) join m using (r) group by i, r),
ranked as (
  select item_id, row_number() over (partition by i order by score desc, doc_id nulls last)::integer as rank, doc_id, score
  from scored join d using (r) join q using (i) where score > 0)
select * from ranked where rank <= 20
"""
