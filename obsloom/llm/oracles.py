"""DuckDB texts that say the same as the queries."""

from obsloom.llm.line_dedup import UNSPACED
from obsloom.llm.secrets import BASE_RULES, RULES

EXACT_DEDUP = r"""
with n as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
)
select doc_id,
  min(doc_id) over (partition by norm) as keep_id,
  count(*) over (partition by norm) as group_size,
  row_number() over (partition by norm order by doc_id nulls last) = 1 as kept,
  sha256(norm) as text_sha256
from n
"""

QUALITY = r"""
with d as (
  select doc_id, source, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
),
win as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)
),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as n from win) where n > 1),
covered as (select doc_id, count(distinct i + k) as n from twice, (select unnest([0, 1, 2]) as k) group by doc_id),
raw as (
  select doc_id, source, text, generate_subscripts(l, 1) as place, unnest(l) as line
  from (select *, string_split(text, chr(10)) as l from d)
),
dup as (
  select doc_id, count(*) - count(distinct line) as n from raw where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
),
tidy as (
  select doc_id, source, text, place, trim(lower(regexp_replace(line, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), ' ') as line from raw
),
spoken as (select *, len(string_split(line, ' ')) as words from tidy where line <> ''),
texts as (select source, line, count(distinct text) as n from spoken group by source, line),
frequent as (select source, line from texts where n > 10),
removed as (
  select s.doc_id, count(*) as n_lines, sum(s.words) as words
  from spoken s join frequent f on s.source is not distinct from f.source and s.line = f.line group by s.doc_id
),
counts as (
  select d.doc_id, len(w) as n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    length(d.text) - length(translate(d.text, '#*$%&|<>', '')) as n_symbols,
    coalesce(dup.n, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
    coalesce(removed.words, 0)::bigint as removed_words, coalesce(removed.n_lines, 0) as n_removed_lines
  from d left join dup using (doc_id) left join covered using (doc_id) left join removed using (doc_id)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 2 * removed_words <= n_words as kept
from counts
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_spans() -> str:
    """Spans of each rule from the lengths of the pieces between matches."""
    parts = []
    for rank, rule in enumerate(RULES):
        pattern = _quoted(rule.pattern)
        parts.append(f"""
  select doc_id, {rank} as rank, '{rule.kind}' as kind, k,
    (list_sum(list_transform(gaps[1:k], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: len(x))), 0))::bigint as a,
    len(m[k]) as n
  from (
    select *, unnest(range(1, len(m) + 1)) as k from (
      select doc_id, string_split_regex(text, {pattern}) as gaps, regexp_extract_all(text, {pattern}, 0) as m,
        regexp_extract_all(text, {pattern}, {rule.group}) as held
      from d where regexp_matches(text, {pattern})
    )
  ) where len(held[k]) >= {rule.least}""")
    return " union all ".join(parts)


SECRETS = f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
spans as ({_secret_spans()}),
text_of as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || a || ':' || (a + n), ',' order by a, rank) filter (rank < {len(BASE_RULES)}) as base,
    string_agg(kind || ':' || a || ':' || (a + n), ',' order by a, rank) as spans
  from spans group by doc_id
)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, sha256(d.text) as blob
from d left join text_of using (doc_id)
"""

MIXING = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    substr(md5('9:' || coalesce(doc_id::varchar, '')), 1, 15) as key
  from documents
),
sources as (select source, sum(size)::bigint as source_size from d group by source),
weighed as (
  select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w, (sum(source_size) over () * 150)::bigint as mix
  from sources
),
turns as (
  select *, coalesce(sum(source_size * 200) over o, 0)::bigint as cap_before,
    (sum(w) over () - coalesce(sum(w) over o, 0))::bigint as w_left
  from weighed window o as (order by source_size / w, source nulls last rows between unbounded preceding and 1 preceding)
),
capped as (select *, (mix - cap_before) * w > source_size * 200 * w_left as capped from turns),
shared as (
  select *, (mix - coalesce(sum(case when capped then source_size * 200 end) over (), 0))::bigint as rest,
    (coalesce(sum(case when not capped then w end) over (), 0) * 100)::bigint as sharing
  from capped
),
goals as (
  select source, source_size,
    case when capped then source_size * 2.0::double else (rest * w)::double / sharing::double end as target,
    case when capped then source_size * 2 else (rest * w) // sharing end as budget
  from shared
),
sums as (
  select d.doc_id, d.size, g.source_size, g.target, g.budget,
    (sum(d.size) over (partition by d.source order by d.key, d.doc_id, d.size rows unbounded preceding) - d.size)::bigint as before,
    case when g.source_size > 0 then g.budget // g.source_size else 0 end as passes
  from d join goals g on d.source is not distinct from g.source
)
select doc_id, size, source_size, target, budget,
  (passes * size + greatest(least(budget - passes * source_size - before, size), 0))::bigint as taken
from sums
"""

LINES = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
hashed as (select *, list_transform(l, lambda x: md5(x)) as h from d),
rolled as (select *, list_transform(range(1, len(l) + 1), lambda i: md5(coalesce(h[i - 1], '') || h[i])) as r from hashed),
ended as (
  select *, list_filter(range(1, len(l) + 1), lambda i: i = len(l) or length(l[i]) >= 200
    or coalesce(length(l[i + 1]) >= 200, false)
    or (i > 1 and i < len(l) and r[i] < r[i - 1] and r[i] <= r[i + 1])) as e
  from rolled
),
spans as (select *, unnest(range(1, len(e) + 1)) as k from ended),
pieces as (
  select doc_id, case when k = 1 then 1 else e[k - 1] + 1 end as a, e[k] as b, array_to_string(l[(case when k = 1 then 1 else e[k - 1] + 1 end):e[k]], chr(10)) as chunk
  from spans
),
ranked as (
  select *, count(*) over (partition by chunk) as n, row_number() over (partition by chunk order by doc_id nulls last, a) as nth,
    len(regexp_extract_all(chunk, '[^\x20\x09-\x0D]+')) as words
  from pieces
),
weighed as (
  select doc_id, i, line, case when strlen(line) = length(line) then 2 * len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))
    else 2 * len(regexp_extract_all(regexp_replace(line, '[UNSPACED]', ' ', 'g'), '[^\x20\x09-\x0D]+'))
      + length(regexp_replace(line, '[^UNSPACED]', '', 'g')) end as w
  from (select doc_id, unnest(l) as line, generate_subscripts(l, 1) as i from d)
),
spoken as (select doc_id, i, w, sum(w) over (partition by doc_id order by i) as upto from weighed where w > 0),
reached as (
  select s.doc_id, s.i as a, t.i as b from spoken s asof join spoken t on s.doc_id = t.doc_id and s.upto - s.w + 100 <= t.upto
  union
  select s.doc_id, t.i as a, s.i as b from spoken s asof join (select *, upto - w as before from spoken) t
    on s.doc_id = t.doc_id and s.upto - 100 >= t.before
),
run as (select r.doc_id, a, b, array_to_string(d.l[a:b], chr(10)) as run from reached r join d using (doc_id)),
first_run as (
  select run, arg_min(doc_id, (doc_id, a)) as doc, arg_min(b, (doc_id, a)) as b from run group by run having count(*) > 1
),
gone as (
  select doc_id, a, b from ranked where n > 1 and nth > 1 and (words >= 50 or (b - a + 1 >= 2 and words >= 10))
  union
  select run.doc_id, run.a, run.b from run join first_run f using (run) where run.doc_id <> f.doc or run.a > f.b
),
places as (select distinct doc_id, unnest(range(a, b + 1)) as i from gone),
per_doc as (select doc_id, count(*) as n_lines from places group by doc_id),
kept as (
  select x.doc_id, string_agg(x.line, chr(10) order by x.i) as t
  from (select doc_id, unnest(l) as line, generate_subscripts(l, 1) as i from d) x
  left join places p on x.doc_id = p.doc_id and x.i = p.i where p.i is null group by x.doc_id
)
select d.doc_id, len(d.l) as n_lines, coalesce(g.n_lines, 0) as n_removed_lines, coalesce(k.t, '') as clean_text
from d left join per_doc g using (doc_id) left join kept k using (doc_id)
"""
LINES = LINES.replace("UNSPACED", UNSPACED[1:-1])

COLLOCATIONS = r"""
with t as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
),
piece as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from t),
said as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from piece),
run as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from said, (select unnest([1, 2, 3, 4, 5]) as k)
),
f as (select lang, k, phrase, string_split(phrase, ' ') as w, count(*) as n from run group by lang, k, phrase having count(*) >= 100),
total as (select lang, count(*) as n from run where k = 1 group by lang),
cut as (
  select p.lang, p.phrase, p.n as a, p.c, l.n as l, r.n as r, total.n,
    ((1000::hugeint * p.n * total.n) // (l.n::hugeint * r.n))::bigint as score
  from (select *, unnest(range(1, k)) as c from f where k > 1) p
  join f l on l.lang = p.lang and l.phrase = array_to_string(p.w[1:p.c], ' ')
  join f r on r.lang = p.lang and r.phrase = array_to_string(p.w[p.c + 1:p.k], ' ')
  join total on total.lang = p.lang
),
lowest as (select * from cut qualify row_number() over (partition by lang, phrase order by score, c) = 1),
part as (
  select lang, n, array_to_string(w[i:i + z - 1], ' ') as phrase
  from (select *, unnest(range(1, k - z + 2)) as i from (select *, unnest(range(2, k)) as z from f where k > 2))
),
cover as (select lang, phrase, max(n) as n from part group by lang, phrase),
kept as (
  select lowest.* from lowest left join cover on cover.lang = lowest.lang and cover.phrase = lowest.phrase
  where cover.n is null or 100 * cover.n < 100 * lowest.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept qualify rank <= 2000
"""

RESAMPLING = r"""
with steps as (
  select list_transform(range(256), lambda b: list_reduce(
    list_prepend(b, range(8)), lambda c, _: xor(c >> 1, (c & 1) * 3988292384::bigint))) as steps
),
d as (
  select row_number() over () as row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
),
source as (select row, unnest(w) as w from d),
target as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
  from benchmark
),
word as (
  select w, xor(4294967295::bigint, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(0, len(h) // 2), lambda i:
      (16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)::bigint)),
    lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1]))) % 10000 as bucket
  from (select w, hex(encode(w)) as h from (select w from source union select w from target)), steps
),
s as (select bucket, count(*) as n from source join word using (w) group by bucket),
t as (select bucket, count(*) as n from target join word using (w) group by bucket),
gain as (
  select bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select count(*) from source) + 10000)::double
    / ((coalesce(s.n, 0) + 1)::double * ((select count(*) from target) + 10000)::double)))::bigint as gain
  from s full join t using (bucket)
),
summed as (select row, count(*) as n, sum(gain) as gain from source join word using (w) join gain using (bucket) group by row),
scored as (
  select doc_id, len(w) as n_features, coalesce(floor(summed.gain::double / n), 0)::bigint as weight, len(w) >= 20 as fits,
    floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::varchar, ''))[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint as luck
  from d left join summed using (row)
)
select doc_id, n_features, weight, weight + luck as score,
  case when fits and place <= (select count(*) * 10 // 100 from scored where fits) then place end as rank
from (
  select *, row_number() over (partition by fits order by weight + luck desc, doc_id nulls last, n_features) as place from scored
)
"""
