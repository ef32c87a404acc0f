"""DuckDB SQL with the same rows as the registered queries, written from their contracts."""

from __future__ import annotations

import math

from stockroom.llm import decontaminate, licenses, quality, ranked_search

_WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
with picked as (
    select doc_id from labels where doc_id is not null group by doc_id
    having min((quality = 1 and coalesce(toxic, 0) = 0)::int) = 1
    order by md5(doc_id::varchar), doc_id limit {quality.TARGET_ROWS}),
docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
words as (
    select r, unnest(w) as word, generate_subscripts(w, 1) as spot
    from (select r, regexp_extract_all(text, '{_WORD}') as w from docs)),
known as (select word, md5_number_upper(word) % 4294967296 as low from (select distinct word from words)),
line as (
    select r, spot, word, low, lead(low) over d as following,
           lead(word) over d as w2, lead(word, 2) over d as w3, lead(word, 3) over d as w4, lead(word, 4) over d as w5
    from words join known using (word) window d as (partition by r order by spot)),
found as (
    select r, (low % {quality.BUCKETS})::bigint as bucket from line
    union all select r, ((low::hugeint * 31 + following::hugeint) % {quality.BUCKETS})::bigint from line where following is not null),
counted as (
    select bucket, count(*) as n_raw, count(*) filter (doc_id in (select doc_id from picked)) as n_good
    from found join docs using (r) group by bucket),
sums as (select sum(n_raw)::double as all_raw, sum(n_good)::double as all_good from counted),
ratio as (
    select bucket, case when all_good = 0 then 0 else
        floor(ln((n_good + {quality.PRIOR}) / (n_raw::double * all_good / all_raw + {quality.PRIOR})) * 1000000 + 0.5) end::bigint as micro
    from counted, sums),
scores as (select r, count(*) as n_features, sum(micro) as score_micro from found join ratio using (bucket) group by r),
spots as (select r, spot, count(*) over (partition by r, word, w2, w3, w4, w5) as times from line where w5 is not null),
hit as (select distinct r, spot + k as spot from spots, (select unnest([0, 1, 2, 3, 4]) as k) where times > 1),
repeats as (select r, count(*) as n from hit group by r),
lines as (
    select r, count(*) - count(distinct l) as n
    from (select r, unnest(string_split(text, chr(10))) as l from docs) where regexp_matches(l, '{_WORD}') group by r),
sizes as (select r, count(*) as n, sum(length(word)) as chars from words group by r),
base as (
    select r, doc_id, coalesce(s.n, 0) as n_words, coalesce(s.chars, 0) as word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
           coalesce(l.n, 0) as n_dup_lines, coalesce(p.n, 0) as n_repeat_words,
           coalesce(c.n_features, 0) as n_features, coalesce(c.score_micro, 0) as score_micro
    from docs left join sizes s using (r) left join lines l using (r) left join repeats p using (r) left join scores c using (r)),
judged as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from base)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and score_micro >= {math.floor(quality.THRESHOLD * quality.MICRO)} * n_features as kept,
       n_features::bigint as n_features, score_micro::bigint as score_micro
from judged
"""

OP3 = """
with rows as (select page_id, encode(coalesce(html, '')) as payload from pages),
hashed as (select page_id, octet_length(payload) as n, sha1(payload) as hex from rows),
firsts as (select hex, min(page_id) as first from hashed group by hex),
fives as (
    select hex, i, ('0x' || substr(hex, i * 5 + 1, 5))::int as v
    from (select distinct hex from hashed), (select unnest(range(8)) as i)),
text as (
    select hex, string_agg(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10) % 32 + 1, 1)
        || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1), '' order by i) as digest
    from fives group by hex)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
       case when first is not distinct from page_id or first is null then 'response' else 'revisit' end as record_type,
       case when first is distinct from page_id then first end as refers_to
from hashed join firsts using (hex) join text using (hex)
"""


def _rows(wordings: tuple[tuple[str, str], ...]) -> str:
    return ", ".join(f"({i}, '{label}', {text.split()})" for i, (text, label) in enumerate(wordings))


# Phrases are looked up word by word. A notice is aligned by the places where three words in a row
# agree with the template; alignments that are shifted by up to three words belong together.
OP4 = rf"""
with docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as said
    from documents),
phrases (phrase, label, words) as (values {_rows(licenses.PHRASES)}),
stands as (
    select r, label, i - 1 as start from (select r, said, label, words, unnest(range(1, len(said) - len(words) + 2)) as i from docs, phrases)
    where said[i] = words[1] and said[i : i + len(words) - 1] = words),
base as (select r, count(*) as n, min(start) as first, max(start) as last, string_agg(distinct label, ',' order by label) as labels from stands group by r),
notices (notice, label, words) as (values {_rows(licenses.TEMPLATES)}),
asked as (select notice, i as place, array_to_string(words[i : i + 2], ' ') as trio from notices, unnest(range(1, len(words) - 1)) as t(i)),
heard as (select r, i as spot, array_to_string(said[i : i + 2], ' ') as trio from docs, unnest(range(1, len(said) - 1)) as t(i)),
agreed as (select r, notice, spot - place as shift, place, spot from heard join asked using (trio)),
shifts as (select distinct r, notice, shift from agreed),
steps as (
    select *, case when shift - lag(shift) over (partition by r, notice order by shift) > {licenses.NEAR} then 1 else 0 end as step from shifts),
aligned as (select r, notice, shift, sum(step) over (partition by r, notice order by shift) as part from steps),
words as (
    select r, notice, part, place + k as wanted, spot + k as found
    from agreed join aligned using (r, notice, shift), (select unnest([0, 1, 2]) as k)),
spans as (
    select r, notice, part, count(distinct wanted) as covered, min(found) as lo, max(found) as hi,
           max(found) - min(found) + 1 - count(distinct found) as alien
    from words group by r, notice, part),
fitting as (
    select r, notice, label, len(n.words) as length, covered, lo, hi, alien from spans join notices n using (notice)
    where greatest(len(n.words) - covered, alien) * {licenses.FAULT} <= len(n.words)),
touching as (
    select *, case when lo > max(hi) over (partition by r order by lo, hi, notice rows between unbounded preceding and 1 preceding) then 1 else 0 end as opens from fitting),
clusters as (select *, sum(opens) over (partition by r order by lo, hi, notice rows unbounded preceding) as cluster from touching),
best as (
    select r, label, covered / (length + alien) as share from clusters
    qualify row_number() over (partition by r, cluster order by covered - greatest(length - covered, alien) desc, notice, lo) = 1),
every as (select r, label, 1.0::double as share from stands union all select r, label, share from best),
named as (select r, string_agg(distinct label, ',' order by label) as labels, max(share) as score from every group by r)
select doc_id, len(said)::bigint as n_words, coalesce(b.n, 0)::bigint as n_base, b.first::bigint as first_word, b.last::bigint as last_word,
       coalesce(b.labels, '') as base_labels, coalesce(m.labels, '') as labels, coalesce(m.score, 0)::double as score
from docs left join base b using (r) left join named m using (r)
"""

OP5 = rf"""
with recursive docs as (
    select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{_WORD}') as said
    from documents),
spoken as (select r, unnest(said) as word, generate_subscripts(said, 1) as spot from docs),
five as (
    select r, concat_ws(' ', word, lead(word) over d, lead(word, 2) over d, lead(word, 3) over d, lead(word, 4) over d) as shingle, spot, count(*) over (partition by r) as n
    from spoken window d as (partition by r order by spot)),
sets as (select distinct r, shingle from five where spot <= greatest(n - 4, 1)),
sizes as (select r, count(*) as n from sets group by r),
pairs as (select a.r as a, b.r as b, count(*) as n from sets a join sets b using (shingle) where a.r < b.r group by a.r, b.r),
links as (
    select a, b from pairs join sizes sa on sa.r = a join sizes sb on sb.r = b where 100 * pairs.n >= 75 * (sa.n + sb.n - pairs.n)),
edges as (select a, b from links union all select b, a from links),
reach as (select a as r, b as o from edges union select reach.r, edges.b from reach join edges on edges.a = reach.o),
least as (select reach.r, min(d.doc_id) as first from reach join docs d on d.r = reach.o group by reach.r)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(l.first, d.doc_id)) as component_id,
       d.doc_id = least(d.doc_id, coalesce(l.first, d.doc_id)) as kept
from docs d left join sizes s using (r) left join least l using (r)
"""

OP6 = rf"""
with docs as (select distinct doc_id, text, md5(text) as m, string_split(text, chr(10)) as l from documents),
lines as (select doc_id, m, unnest(l) as line, generate_subscripts(l, 1) - 1 as spot from docs),
said as (select * from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
trios as (
    select doc_id, m, spot as first_line, lead(spot, 2) over d as last_line, line as w1, lead(line) over d as w2, lead(line, 2) over d as w3
    from said window d as (partition by doc_id, m order by spot)),
ranked as (
    select *, row_number() over (partition by w1, w2, w3 order by doc_id nulls first, m, first_line) as nth from trios where last_line is not null),
gone as (select distinct doc_id, m, unnest(range(first_line, last_line + 1)) as spot from ranked where nth > 1),
kept as (
    select l.doc_id, l.m, count(*) as n_lines, count(g.spot) as n_removed,
           coalesce(string_agg(l.line, chr(10) order by l.spot) filter (g.spot is null), '') as text
    from lines l left join gone g on l.doc_id is not distinct from g.doc_id and l.m = g.m and l.spot = g.spot group by l.doc_id, l.m)
select d.doc_id, k.text, coalesce(k.n_lines, 0)::bigint as n_lines, coalesce(k.n_removed, 0)::bigint as n_removed
from documents d left join kept k on d.doc_id is not distinct from k.doc_id and md5(d.text) = k.m
"""

OP8 = rf"""
with docs as (
    select doc_id, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size, case when source is null then '1' else '0' || source end as key,
           md5('0:' || coalesce(doc_id::varchar, 'null')) as ord
    from documents),
sources as (
    select key, sum(size)::bigint as source_size, 3 * sum(size)::bigint as cap,
           list_extract([5, 2, 1], ((row_number() over (order by key) - 1) % 3 + 1)::int)::bigint as w
    from docs group by key),
sorted as (
    select *, sum(cap) over c as caps, sum(w) over c as ws, sum(source_size) over () as total, sum(w) over () as weights
    from sources window c as (order by cap / w, key rows unbounded preceding)),
tried as (select *, (total - caps + cap)::double / (weights - ws + w)::double as level from sorted),
leveled as (select min_by(level, (cap / w, key)) filter (cap / w >= level) as level from tried),
targets as (
    select key, source_size, case when t.cap / t.w >= t.level then t.w * l.level else t.cap::double end as target
    from tried t, leveled l),
placed as (
    select d.doc_id, d.size, t.source_size, t.target, round(t.target)::bigint as quota,
           coalesce(sum(d.size) over (partition by key order by ord, doc_id, size rows between unbounded preceding and 1 preceding), 0) as start
    from docs d join targets t using (key))
select doc_id, size, source_size, target,
       (case when source_size = 0 then 0 else
           (quota // source_size) * size + greatest(0, least(start + size, quota % source_size) - start) end)::bigint as taken
from placed
"""

OP10 = """
with recursive good as (
    select row_number() over () as r, vec_id, label, embedding::double[] as x
    from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
      and len(list_filter(embedding, lambda v: v <> 0)) > 0),
links as (
    select a.r as a, b.r as b from good a join good b on a.label = b.label and len(a.x) = len(b.x) and a.r <> b.r
    where list_cosine_similarity(a.x, b.x) >= 0.93),
reach as (select a as r, b as o from links union select reach.r, links.b from reach join links on links.a = reach.o),
first as (select reach.r, min(g.vec_id) as first from reach join good g on g.r = reach.o group by reach.r),
numbers as (select a as r, count(*) as n from links group by a),
found as (
    select g.vec_id, coalesce(n, 0)::bigint as n_links, least(g.vec_id, coalesce(first, g.vec_id)) as component_id
    from good g left join numbers using (r) left join first using (r)
    union all
    select vec_id, 0, vec_id from embeddings
    where not coalesce(label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
      and len(list_filter(embedding, lambda v: v <> 0)) > 0, false))
select *, vec_id = component_id as kept from found
"""

_LOWER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower_words(column: str) -> str:
    return f"regexp_extract_all(translate(coalesce({column}, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '{_LOWER_WORD}')"


OP11 = rf"""
with docs as (select row_number() over () as r, doc_id, {_lower_words("text")} as said from documents),
items as (select coalesce(item_id::varchar, '') as item, {_lower_words("text")} as said from benchmark),
windows as (
    select distinct item, array_to_string(said[i : i + {decontaminate.WIDTH - 1}], ' ') as phrase, least(len(said), {decontaminate.WIDTH}) as length
    from items, unnest(range(1, greatest(len(said) - {decontaminate.WIDTH}, 0) + 2)) as t(i) where len(said) > 0),
lengths as (select distinct length from windows),
starts as (select r, said, length, unnest(range(1, len(said) - length + 2)) as i from docs, lengths where len(said) >= length),
met as (
    select r, i, length, item from (select r, i, length, array_to_string(said[i : i + length - 1], ' ') as phrase from starts)
    join windows using (length, phrase)),
hit as (select r, count(*) as n from (select distinct r, unnest(range(i, i + length)) as spot from met) group by r),
named as (select r, count(*) as n, string_agg(item, ',' order by item) as names from (select distinct r, item from met) group by r)
select doc_id, len(said)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit, coalesce(m.n, 0)::bigint as n_items,
       sha256(coalesce(m.names, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from docs left join hit h using (r) left join named m using (r)
"""

# each order's figures are counted from the documents themselves, step by step
OP12 = rf"""
with docs as (
    select row_number() over () as r, doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') as said from documents),
firsts as (select text, min(doc_id) as first from docs group by text),
marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
facts as (
    select r, part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           map {{'A': len(said) < 100, 'B': 100 * len(list_distinct(said)) < 80 * len(said),
                 'C': 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text),
                 'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > first, false)}} as fails
    from docs join firsts using (text) left join marks using (doc_id)),
alike as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from facts group by part, fails),
letters (l) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
    select a.l || b.l || c.l || d.l || e.l as filter_order from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps as (
    select filter_order, step, filter_order[step] as own, string_split(filter_order[: step - 1], '') as earlier
    from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
judged as (
    select part, filter_order, step, own, n, good, toxic, fails[own] as fail,
           len(list_filter(earlier, lambda x : x <> '' and fails[x])) > 0 as gone,
           len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x : fails[x])) as n_fails
    from alike, steps),
figures as (
    select part, filter_order, step, own,
           coalesce(sum(n) filter (not gone and not fail), 0) as kept, coalesce(sum(n) filter (not gone and fail), 0) as removed,
           coalesce(sum(n) filter (gone and fail), 0) as redundant, coalesce(sum(n) filter (fail and n_fails = 1), 0) as unique_fails,
           coalesce(sum(good) filter (not gone and fail), 0) as good_lost, coalesce(sum(toxic) filter (not gone and fail), 0) as toxic_lost
    from judged group by part, filter_order, step, own)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from figures
"""

OP13 = rf"""
with docs as (select row_number() over () as r, doc_id, {_lower_words("text")} as said from documents),
items as (select row_number() over () as i, item_id, {_lower_words("text")} as said from benchmark),
asked as (select distinct i, unnest(said) as term from items),
sizes as (select r, doc_id, len(said)::bigint as n from docs where len(said) > 0),
whole as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from sizes),
found as (select r, term, count(*) as tf from (select r, unnest(said) as term from docs) where term in (select term from asked) group by r, term),
weights as (
    select term, floor({ranked_search.WEIGHT_UNIT} * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::bigint as w
    from found, whole group by term),
scores as (
    select i, r, sum(w * (({ranked_search.UNIT} * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) as score
    from asked join found using (term) join weights using (term) join sizes using (r), whole group by i, r),
ranked as (select i, doc_id, score, row_number() over (partition by i order by score desc, doc_id nulls last) as rank from scores join sizes using (r) where score > 0)
select item_id, rank::int as rank, doc_id, score::bigint as score from ranked join items using (i) where rank <= {ranked_search.TOP}
"""

SQL: dict[str, str] = {
    "op2_quality_rules": OP2,
    "op3_warc": OP3,
    "op4_licenses": OP4,
    "op5_minhash": OP5,
    "op6_line_dedup": OP6,
    "op8_mixing": OP8,
    "op10_embeddings": OP10,
    "op11_decontaminate": OP11,
    "op12_filter_audit": OP12,
    "op13_ranked_search": OP13,
}
