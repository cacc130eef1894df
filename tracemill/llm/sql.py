"""SQL of the queries whose results SQL can express."""

from __future__ import annotations

_ESCAPED = r"regexp_replace(replace({}, '\', '\\'), '(<|\[)(/?s>|/?INST\]|\|turn\|>|</?SYS>>)', '\1\\\2', 'g')"

CHAT = f"""with t as (
 select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
 union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
 s as (select *, lag(role) over (partition by conv_id order by turn) is distinct from role as opens from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
 coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
 sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
 sum(length({_ESCAPED.format('text')}) + case when opens then 20 + length({_ESCAPED.format('role')}) else 8 end)::bigint as formatted_chars
from s group by conv_id"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""with p as (select page_id, encode(coalesce(html, '')) as body, sha1(coalesce(html, '')) as h from pages),
 m as (select h, max(page_id) as last from p group by h)
select page_id, octet_length(body) as payload_bytes,
 list_aggregate([substr('{_BASE32}', 1 + (('0x' || substr(p.h, 1 + 5 * (i // 4), 5))::int >> (15 - 5 * (i % 4)) & 31), 1) for i in range(32)], 'string_agg', '') as payload_digest,
 case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id < last then last end as refers_to
from p join m on p.h = m.h"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""with d as (select doc_id, {_WORDS} as w from documents),
 b as (select item_id, w, least(10, len(w)) as n from (select item_id, {_WORDS} as w from benchmark) where len(w) > 0),
 windows as (select distinct item_id, n, array_to_string(w[i : i + n - 1], ' ') as g from (select *, unnest(range(1, len(w) - n + 2)) as i from b)),
 placed as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as g from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from windows))),
 hit as (select doc_id, item_id, placed.n, i from placed join windows on placed.n = windows.n and placed.g = windows.g),
 covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by 1),
 named as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item_id::varchar as item from hit) group by 1)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered on d.doc_id = covered.doc_id left join named on d.doc_id = named.doc_id"""

_SPLIT = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

NEARDUP = f"""with recursive w as (select doc_id, {_SPLIT} as w from documents),
 s as (select distinct doc_id, array_to_string(w[i : i + k - 1], ' ') as g from (select doc_id, w, least(5, len(w)) as k, unnest(range(1, len(w) - least(5, len(w)) + 2)) as i from w where len(w) > 0)),
 c as (select doc_id, count(*) as n from s group by 1),
 shared as (select a.doc_id as u, b.doc_id as v, count(*) as x from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
 link as (select u, v from shared join c cu on cu.doc_id = u join c cv on cv.doc_id = v where 100 * x >= 85 * (cu.n + cv.n - x)),
 reach(id, other) as (select u, v from link union select v, u from link union select r.id, l.v from reach r join (select u, v from link union all select v, u from link) l on l.u = r.other),
 least_of as (select id, min(other) as m from reach group by 1)
select w.doc_id, coalesce(n, 0) as n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) as component_id, w.doc_id <= coalesce(m, w.doc_id) as kept
from w left join c on c.doc_id = w.doc_id left join least_of on least_of.id = w.doc_id"""

# The level up to which sources share by weight is the largest that any number of full sources gives.
TARGETS = r"""with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
 s as (select source, sum(size) as words, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w from d group by source),
 p as (select sum(3.0 * words) over o as full_words, sum(w) over o as full_weight, (select sum(words) from s) as t, (select sum(w) from s) as all_weight from s window o as (order by 3.0 * words / w, source nulls last rows unbounded preceding)),
 l as (select greatest(max(t / all_weight), coalesce(max((t - full_words) / (all_weight - full_weight)) filter (all_weight > full_weight), 0)) as level from p)
select doc_id, size, words::bigint as source_size, round(least(3.0 * words, w * level), 4) as target from d join s on s.source is not distinct from d.source, l"""

EDITED = """with t as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n from documents),
 p as (select *, coalesce(lead(text) over (order by doc_id desc), first_value(text) over (order by doc_id desc)) as next from t)
select doc_id, n as n_chars, sha256(substr(text, 1, n - n // 2) || substr(next, 1, n // 2)) as edited_sha256 from p"""

_WORD = r"'[^\x20\x09-\x0D]+'"

# A host's rate of failures under a rule is shrunk by a beta prior from moments of all hosts.
HOST_RULES = rf"""with t as (select row_number() over () as r, doc_id, source as host, coalesce(text, '') as text from documents),
 w as (select *, regexp_extract_all(text, {_WORD}) as w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORD})) as l from t),
 g as (select r, i, array_to_string(w[i : i + 7], ' ') as g from (select r, w, unnest(range(1, len(w) - 6)) as i from w)),
 twice as (select r, g from g group by r, g having count(*) > 1),
 again as (select r, count(distinct p) as n from (select g.r, unnest(range(i, i + 8)) as p from g join twice on g.r = twice.r and g.g = twice.g) group by r),
 d as (select doc_id, host, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
  len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words from w left join again on w.r = again.r),
 f as (select *, n_words < 20 as short, 100 * n_repeat_words > 30 * n_words as repeats, 10 * n_symbols > n_words as symbols, 100 * n_dup_lines > 30 * n_lines as lines,
  word_chars < 2 * n_words or word_chars > 12 * n_words as word_length from d),
 h as (select host, count(*) as n, unnest(['short', 'repeats', 'symbols', 'lines', 'word_length']) as rule,
  unnest([sum(short::int), sum(repeats::int), sum(symbols::int), sum(lines::int), sum(word_length::int)])::double as k from f group by host),
 m as (select rule, count(*) - 1.0 as df, sum(n)::double as nn, sum(k) / sum(n) as mean, sum(k * k / n) - sum(n) * (sum(k) / sum(n)) * (sum(k) / sum(n)) as b, sum(n) - sum(n::double * n) / sum(n) as weight from h group by rule),
 p as (select rule, mean, greatest(least(coalesce((b - mean * (1 - mean) * df) / nullif(mean * (1 - mean) * (weight - df), 0), 1 / (1 + nn)), 1), 1 / (1 + nn)) as share from m),
 rates as (select host, max((k + mean * (1 - share) / share) / (n + (1 - share) / share)) as rate from h join p on h.rule = p.rule group by host)
select doc_id, f.host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short or repeats as base_failed, round(rate, 6) as host_rate, not (short or repeats) and rate <= 0.5 as kept
from f join rates on f.host is not distinct from rates.host"""

DIVERGENCE = r"""with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
 w as (select lang, source, r, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
 kept as (select lang, term, count(*) as c from w group by all having count(distinct r) >= 3),
 g as (select distinct lang, source from d),
 n as (select w.lang, w.source, w.term, count(*) as c from w join kept k on w.lang = k.lang and w.term = k.term group by all),
 v as (select lang, count(*) as v, sum(c) as n from kept group by lang),
 total as (select g.lang, g.source, coalesce(sum(c), 0) as n from g left join n on g.lang = n.lang and g.source = n.source group by all),
 p as (select t.lang, t.source, k.term, coalesce(n.c, 0) as c, 1 + 1000000000::hugeint * (coalesce(n.c, 0) + 1) // (t.n + v.v) as p, 1 + 1000000000::hugeint * (k.c + 1) // (v.n + v.v) as q
  from total t join kept k on t.lang = k.lang join v on v.lang = t.lang left join n on n.lang = t.lang and n.source = t.source and n.term = k.term),
 pair as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join p x on x.lang = a.lang and x.source = a.source left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term group by all),
 term as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value from p where c > 0 and p > q)
select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from (select * from pair union all select * from term)
qualify part = 'pair' or rank <= 200"""

# crc32 bit by bit; runs are islands of words that are equal q apart, each with its smallest q.
RUNS = rf"""with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) as w,
  xor(list_reduce([4294967295]::bigint[] || [ascii(c)::bigint for c in string_split(doc_id::varchar, '')],
   lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) as h from documents),
 a as (select *, len(w) as n, h % 10 = 0 and len(w) > 0 as plant, (h // 10) % greatest(len(w), 1) as a, 3 + (h // 10) % 8 as k from d),
 b as (select r, doc_id, n, case when plant then [w[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // k) end] for i in range(n)] else w end as w from a),
 t as (select r, n, unnest(w) as x, unnest(range(n)) as i from b),
 e as (select s.r, s.i, u.i - s.i as q, s.n from t s join t u on s.r = u.r and s.x = u.x and u.i > s.i and 3 * (u.i - s.i) <= s.n),
 l as (select r, q, min(i) as s, count(*) + q as len from (select *, i - row_number() over (partition by r, q order by i) as island from e) group by r, q, island having count(*) + q >= greatest(24, 3 * q)),
 m as (select r, s, len, min(q) as q from l group by r, s, len),
 top as (select * from m qualify row_number() over (partition by r order by len::double / q desc, s, q) = 1),
 told as (select r, count(*) as n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) as told from m group by r),
 gone as (select distinct r, unnest(range(s + q, s + len)) as i from m),
 left_over as (select t.r, string_agg(x, ' ' order by t.i) as kept from t anti join gone on t.r = gone.r and t.i = gone.i group by t.r)
select b.doc_id, b.n as n_words, coalesce(n_runs, 0) as n_runs, s as start, len as length, q as period, 1000 * len // q as exponent_milli, sha256(coalesce(told, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from b left join top on b.r = top.r left join told on b.r = told.r left join left_over on b.r = left_over.r"""

# Not op4: over every 50-byte string it takes DuckDB over a minute at the smallest checked size.
# Of op1 and op3 SQL tells a part each, which queries of their own return.
ORACLE_SQL = {"mixing_targets": TARGETS, "fingerprint_edits": EDITED, "op2_warc": WARC, "op5_chat": CHAT, "op7_decontamination": DECONTAMINATION, "op8_neardup": NEARDUP, "op11_host_rules": HOST_RULES, "op12_divergence": DIVERGENCE, "op13_runs": RUNS}
