"""DuckDB statements for the registered queries that SQL can express, written apart from the operators."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

#: Brute force: every run of five words of every distinct text, joined with itself.
JACCARD = f"""
with recursive texts as (
  select text, min(doc_id) as copy_of, count(*) as copies, {WORDS.format(LOWER.format("text"))} as w
  from {{docs}} where regexp_matches(text, '[^\\x20\\x09-\\x0D]') group by text
), runs as materialized (
  select copy_of, copies, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) as run from texts
), sizes as (select copy_of, count(*) as n from runs group by copy_of),
common as (
  select a.copy_of as x, b.copy_of as y, any_value(b.copies) as copies, count(*) as c
  from runs a join runs b on a.run = b.run and a.copy_of <> b.copy_of group by 1, 2
), links as materialized (
  select x, y, copies from common join sizes s on s.copy_of = x join sizes t on t.copy_of = y where 5 * c >= 4 * (s.n + t.n - c)
), reach as (
  select copy_of as x, copy_of as y from texts union select r.x, l.y from reach r join links l on r.y = l.x
), classes as (select x as copy_of, min(y) as class_id from reach group by x),
counted as (select x as copy_of, sum(copies) as c from links group by x)
"""

OP7 = JACCARD.format(docs="documents") + """
select d.doc_id, coalesce(k.class_id, d.doc_id) as class_id, coalesce(t.copy_of, d.doc_id) as copy_of,
  cast(coalesce(c.c, 0) + coalesce(t.copies - 1, 0) as bigint) as n_links
from documents d left join texts t on d.text = t.text left join classes k on k.copy_of = t.copy_of left join counted c on c.copy_of = t.copy_of
"""

#: Water-filling by raising the level, then the documents of each source in the order of their hashes.
MIX = r"""
with recursive rows as materialized (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as u, coalesce(cast(doc_id as varchar), '') as id
  from {docs}
), sources as (
  select source, source_size, cast((row_number() over (order by source is null, source) - 1) % 3 + 1 as double) as weight, 3 * source_size as cap
  from (select source, cast(sum(size) as bigint) as source_size from rows group by source)
), level as (
  select 0 as k, cast(0 as double) as x
  union all
  select k + 1, (select (sum(source_size) - sum(case when cap < weight * x then cap else 0 end)) / sum(case when cap < weight * x then 0 else weight end) from sources)
  from level where k < 100 and (select (sum(source_size) - sum(case when cap < weight * x then cap else 0 end)) / sum(case when cap < weight * x then 0 else weight end) from sources) > x
), goals as (
  select *, coalesce(floor(target / nullif(source_size, 0)), 0) as whole, target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size as rest
  from (select *, least(cast(cap as double), weight * (select max(x) from level)) as target from sources)
), marked as (
  select r.*, g.source_size, g.target, g.whole, g.rest, r.size > (select avg(size) from rows) as large
  from rows r join goals g on r.source is not distinct from g.source
), first as (
  select *, large and whole < 3 and coalesce(sum(size) over (partition by source, large order by u, id, size rows between unbounded preceding and 1 preceding), 0) + size / 2.0
    <= rest * (sum(case when large then size else 0 end) over (partition by source)) / greatest(source_size, 1) as one
  from marked
), second as (
  select *, rest - sum(case when one then size else 0 end) over (partition by source) as small_rest from first
), taken as (
  select *, one or (not large and whole < 3 and coalesce(sum(size) over (partition by source, large order by u, id, size rows between unbounded preceding and 1 preceding), 0) + size / 2.0 <= small_rest) as more
  from second
)
"""

OP9 = MIX.format(docs="documents") + """
select doc_id, size, source_size, target, cast((whole + cast(more as int)) * size as bigint) as taken from taken
"""

#: The triples of symbols of a URL: edges, letters, digits as 0, / . -, and _ for all else.
OP3 = r"""
with parsed as (
  select page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path,
    '^^' || translate(regexp_replace(lower(regexp_replace(coalesce(url, ''), '(?s)^.*?://', '')), '[^a-z0-9/.\-]', '_', 'g'), '123456789', '000000000') || '^' as plain
  from pages
), ruled as materialized (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
  from parsed
), kinds as materialized (
  select *, case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block' end as kind, row_number() over () as row
  from ruled
), grams as materialized (
  select row, page_id, kind, unnest(list_transform(range(1, length(plain) - 1), lambda i: substr(plain, i, 3))) as g from kinds
), counts as materialized (
  select g, sum(case when kind = 'allow' then 1 else 0 end) as good, sum(case when kind = 'block' then 1 else 0 end) as bad
  from grams where kind is not null and cast('0x' || substr(md5(coalesce(cast(page_id as varchar), '')), 1, 8) as bigint) % 5 <> 0 group by g
), c0 as (select substr(g, 3, 1) as g, sum(good) as good, sum(bad) as bad from counts group by 1),
n0 as (select sum(good) as ng, sum(bad) as nb, count(*) filter (good > 0) as tg, count(*) filter (bad > 0) as tb from c0),
c1 as (select substr(g, 2, 2) as g, sum(good) as good, sum(bad) as bad from counts group by 1),
n1 as (select g[1] as c, sum(good) as ng, sum(bad) as nb, count(*) filter (good > 0) as tg, count(*) filter (bad > 0) as tb from c1 group by 1),
n2 as (select g[1:2] as c, sum(good) as ng, sum(bad) as nb, count(*) filter (good > 0) as tg, count(*) filter (bad > 0) as tb from counts group by 1),
seen as (select distinct g from grams),
p0 as (select g, (coalesce(good, 0) + tg / 32.0) / (ng + tg) as pg, (coalesce(bad, 0) + tb / 32.0) / (nb + tb) as pb from (select distinct substr(g, 3, 1) as g from seen) left join c0 using (g), n0),
p1 as (
  select s.g, case when coalesce(ng, 0) > 0 then (coalesce(good, 0) + tg * p0.pg) / (ng + tg) else p0.pg end as pg, case when coalesce(nb, 0) > 0 then (coalesce(bad, 0) + tb * p0.pb) / (nb + tb) else p0.pb end as pb
  from (select distinct substr(g, 2, 2) as g from seen) s join p0 on p0.g = substr(s.g, 2, 1) left join c1 on c1.g = s.g left join n1 on n1.c = s.g[1]
), p2 as (
  select s.g, case when coalesce(ng, 0) > 0 then (coalesce(good, 0) + tg * p1.pg) / (ng + tg) else p1.pg end as pg, case when coalesce(nb, 0) > 0 then (coalesce(bad, 0) + tb * p1.pb) / (nb + tb) else p1.pb end as pb
  from seen s join p1 on p1.g = substr(s.g, 2, 2) left join counts on counts.g = s.g left join n2 on n2.c = s.g[1:2]
), scores as (
  select row, any_value(kind) as kind, any_value(page_id) as page_id, coalesce(avg(ln(pg) - ln(pb)), 0) as score from grams join p2 using (g) group by row
), bins as (
  select floor(greatest(least(score, 8), -8) * 100) as bin, count(*) filter (kind = 'allow') as good, count(*) filter (kind = 'block') as bad
  from scores where kind is not null and cast('0x' || substr(md5(coalesce(cast(page_id as varchar), '')), 1, 8) as bigint) % 5 = 0 group by 1
), errors as (
  select bin, abs(coalesce(sum(good) over (order by bin rows between unbounded preceding and 1 preceding), 0) / sum(good) over () - sum(bad) over (order by bin rows between current row and unbounded following) / sum(bad) over ()) as gap,
    sum(good) over () as g, sum(bad) over () as b
  from bins
), edge as (select coalesce((select bin / 100 from errors where g > 0 and b > 0 order by gap, bin limit 1), 0.0) as t)
select page_id, host, path, rule, coalesce(kind, case when score >= t then 'allow' else 'block' end) as verdict
from kinds join (select row, score from scores) using (row), edge
"""

#: Brute force over all pairs of equal label.
OP4 = """
with recursive v as materialized (
  select vec_id, label, case when fit then cast(embedding as double[]) end as e, fit from (select *, label is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), false) and coalesce(list_bool_or(list_transform(embedding, lambda x: x <> 0)), false) as fit
  from embeddings)
), links as materialized (
  select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and a.fit and b.fit and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93
), reach as (select vec_id as x, vec_id as y from v union select r.x, l.y from reach r join links l on r.y = l.x),
counted as (select x, count(*) as n from links group by x)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from v join (select x, min(y) as component_id from reach group by x) k on k.x = vec_id left join counted c on c.x = vec_id
"""

SQL: dict[str, str] = {"op3_url_filter": OP3, "op4_embedding_dedup": OP4, "op7_jaccard_join": OP7, "op9_mixing": OP9}

#: Every phrase of one to five words is counted; all longer candidates of a candidate are looked at.
SQL["op12_collocations"] = r"""
with pieces as (
  select row_number() over () as pid, lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') as ws
  from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) as piece from documents)),
words as (select pid, lang, generate_subscripts(ws, 1) as i, unnest(ws) as w from pieces),
runs as (select lang, w as w1, lead(w, 1) over o as w2, lead(w, 2) over o as w3, lead(w, 3) over o as w4, lead(w, 4) over o as w5
  from words window o as (partition by pid order by i)),
phrases as (
  select lang, [w1] as p from runs
  union all select lang, [w1, w2] from runs where w2 is not null
  union all select lang, [w1, w2, w3] from runs where w3 is not null
  union all select lang, [w1, w2, w3, w4] from runs where w4 is not null
  union all select lang, [w1, w2, w3, w4, w5] from runs where w5 is not null),
f as (select lang, p, count(*) as f from phrases group by all),
totals as (select lang, count(*) as n from words group by lang),
candidates as (select lang, p, f as a from f where len(p) >= 2 and f >= 100),
inside as (
  select distinct c.lang, c.p[s.s : s.s + m.m - 1] as p, max(c.a) as most
  from candidates c, range(2, 5) m(m), range(1, 5) s(s)
  where m.m < len(c.p) and s.s + m.m - 1 <= len(c.p) group by all),
kept as (select c.* from candidates c left join inside i on i.lang = c.lang and i.p = c.p where i.most is null or 100 * i.most < 100 * c.a),
cuts as (select kept.*, k.k, p[1 : k.k] as lp, p[k.k + 1 :] as rp from kept, range(1, 5) k(k) where k.k < len(p)),
scored as (
  select cuts.lang, cuts.p, cuts.a, cuts.k, fl.f as l, fr.f as r, n,
    cast((1000::hugeint * cuts.a * n) // (fl.f::hugeint * fr.f) as bigint) as score
  from cuts join f fl on fl.lang = cuts.lang and fl.p = cuts.lp join f fr on fr.lang = cuts.lang and fr.p = cuts.rp join totals on totals.lang = cuts.lang),
weakest as (select * from scored qualify row_number() over (partition by lang, p order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank,
  array_to_string(p, ' ') as phrase, a, l, r, n, score
from weakest qualify rank <= 2000
"""

#: All pairs of words are compared. Each code point is one byte there, as the distance counts bytes.
SQL["op11_spelling_variants"] = r"""
with recursive poly(i, k, c) as (
  select i, 0, i from range(256) t(i)
  union all select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from poly where k < 8),
crc as materialized (select list(c order by i) as t from poly where k = 8),
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as w from documents),
each as materialized (select doc_id, w, count(*) as n from runs group by all),
hashed as (select w, n, xor(4294967295, list_reduce(
    list_concat([4294967295::bigint], list_transform(flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || w, ''),
      lambda x: case when unicode(x) < 128 then [unicode(x)] else [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] end)), lambda x: x::bigint)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) as h from each, crc),
slipped as (select case when h % 97 = 0 then left(w, (h % length(w))::int) || substr(w, (h % length(w))::int + 2) else w end as word, n from hashed),
words as materialized (select word, sum(n)::bigint as n, translate(word, (select string_agg(chr(i::int), '' order by i) from range(192, 256) t(i)),
    (select string_agg(chr(i::int), '' order by i) from range(1, 65) t(i))) as bytes from slipped where length(word) >= 5 group by word having sum(n) >= 3),
pairs as materialized (select a.word, b.word as near, b.n as near_n from words a join words b on length(b.word) between length(a.word) - 1 and length(a.word) + 1
  where a.word <> b.word and levenshtein(a.bytes, b.bytes) = 1),
counted as (select word, count(*) as n_near from pairs group by word),
best as (select * from pairs qualify row_number() over (partition by word order by near_n desc, near) = 1),
formed as materialized (select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 2 * w.n then near end as form, case when near_n >= 2 * w.n then near_n end as form_n
  from words w left join counted using (word) left join best using (word)),
chain(word, here, steps) as (select word, word, 0 from formed union all select chain.word, form, steps + 1 from chain join formed on formed.word = here where form is not null)
select word, form, (select max_by(here, steps) from chain c where c.word = formed.word) as root, n, n_near, form_n from formed
"""
