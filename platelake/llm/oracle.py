"""SQL counterparts, written from the contracts and not from the Spark code."""

QUALITY_RULES = r"""
with words as (
  select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), windows as (
  select r, unnest(range(len(w) - 4)) as pos, unnest(list_transform(range(len(w) - 4), lambda i: list_slice(w, i + 1, i + 5))) as g
  from words where len(w) >= 5
), often as (
  select r, pos from (select r, pos, count(*) over (partition by r, g) as n from windows) where n > 1
), covered as (
  select r, count(distinct pos + j) as n from often, range(5) as k(j) group by r
), parts as (
  select r, unnest(string_split(t, chr(10))) as line from words
), dup as (
  select r, cast(sum(n) as bigint) as n_lines, cast(sum(n - 1) as bigint) as n_dup
  from (select r, line, count(*) as n from parts where regexp_matches(line, '[^\x20\x09-\x0D]') group by r, line) group by r
), base as (
  select doc_id, lang, source, cast(len(w) as bigint) as n_words,
         cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(length(regexp_replace(t, '[^!?]', '', 'g')) as bigint) as n_marks,
         cast(length(regexp_replace(t, '[^A-Z]', '', 'g')) as bigint) as n_capitals,
         coalesce(n_lines, 0) as n_lines, coalesce(n_dup, 0) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words
  from words left join dup using (r) left join covered using (r)
), flagged as (
  select *, (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed from base
), ratios as (
  select *, case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end as symbols,
         case when word_chars > 0 then 1000 * n_marks // word_chars else 0 end as marks,
         case when word_chars > 0 then 1000 * n_capitals // word_chars else 0 end as capitals,
         case when n_words > 0 then 1000 * word_chars // n_words else 0 end as exact_length,
         case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as dup_lines,
         case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as repeats
  from flagged
), rounded as (
  select *, exact_length - exact_length % (cast(1 as bigint) << greatest(length(bin(exact_length)) - 10, 0)) as word_length from ratios
), tall as (
  unpivot (select lang, source, symbols, marks, capitals, word_length, dup_lines, repeats from rounded where not base_failed)
  on symbols, marks, capitals, word_length, dup_lines, repeats into name feature value value
), grouped as (
  select lang, source, feature, count(*) as n, quantile_disc(value, 0.25) as low, quantile_disc(value, 0.75) as high,
         quantile_disc(value, 0.995) as top
  from tall group by all
), langs as (
  select lang, feature, count(*) as n, quantile_disc(value, 0.25) as low, quantile_disc(value, 0.75) as high,
         quantile_disc(value, 0.995) as top
  from tall group by all
), everything as (
  select feature, quantile_disc(value, 0.25) as low, quantile_disc(value, 0.75) as high, quantile_disc(value, 0.995) as top
  from tall group by all having count(*) >= 200
), chosen as (
  select g.lang, g.source, g.feature,
         case when g.n >= 200 then g.low when l.n >= 200 then l.low else e.low end as low,
         case when g.n >= 200 then g.high when l.n >= 200 then l.high else e.high end as high,
         case when g.n >= 200 then g.top when l.n >= 200 then l.top else e.top end as top
  from grouped g join langs l on g.lang is not distinct from l.lang and g.feature = l.feature
  left join everything e on g.feature = e.feature
), fences as (
  select lang, source,
         max(case when feature = 'symbols' then high + 5 * greatest(high - low, 1) end) as symbols_limit,
         max(case when feature = 'marks' then high + 5 * greatest(high - low, 1) end) as marks_limit,
         max(case when feature = 'capitals' then high + 5 * greatest(high - low, 1) end) as capitals_limit,
         max(case when feature = 'word_length' then high + 5 * greatest(high - low, 1) end) as word_length_limit,
         max(case when feature = 'dup_lines' then top end) as dup_lines_limit,
         max(case when feature = 'repeats' then top end) as repeats_limit
  from chosen group by lang, source
)
select r.doc_id, r.lang, r.source, n_words, word_chars, n_symbols, n_marks, n_capitals, n_lines, n_dup_lines,
       n_repeat_words, base_failed,
       (not base_failed and coalesce(symbols <= symbols_limit, true) and coalesce(marks <= marks_limit, true)
        and coalesce(capitals <= capitals_limit, true)
        and coalesce(word_length <= word_length_limit, true) and coalesce(dup_lines <= dup_lines_limit, true)
        and coalesce(repeats <= repeats_limit, true)) as kept
from rounded r left join fences f on r.lang is not distinct from f.lang and r.source is not distinct from f.source
"""

DECONTAMINATION = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents where doc_id is not null
), b as (
  select item_id, text, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from (select distinct item_id, text from benchmark) where item_id is not null
), lengths as (
  select distinct least(len(w), 5) as k from b where len(w) > 0
), dg as (
  select distinct doc_id, unnest(list_transform(range(len(w) - k + 1), lambda i: array_to_string(list_slice(w, i + 1, i + k), ' '))) as g
  from d join lengths on len(w) >= k
), bg as (
  select distinct item_id, text,
         unnest(list_transform(range(len(w) - least(len(w), 5) + 1), lambda i: array_to_string(list_slice(w, i + 1, i + least(len(w), 5)), ' '))) as g
  from b where len(w) > 0
), sizes as (select item_id, text, count(*) as n_item from bg group by all)
select doc_id, item_id, max(n_shared) as n_shared, max(n_item) as n_item, max(n_shared / n_item) as containment
from (select doc_id, item_id, text, count(*) as n_shared from dg join bg using (g) group by all) join sizes using (item_id, text)
where n_shared >= 0.8 * n_item group by doc_id, item_id
"""

URL_FILTER = r"""
with parts as (
  select page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1) as query
  from pages
), cleaned as (
  select *, list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' and string_split(p, '=')[1] not in
    ('ref', 'fbclid', 'gclid', 'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content'))) as kept
  from parts
), forms as (
  select page_id, url, host, path, case when host = '' then '' else
    concat(regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', ''), regexp_replace(path, '/+$', ''),
           case when len(kept) > 0 then concat('?', array_to_string(kept, '&')) else '' end) end as canonical
  from cleaned
), listed as (
  select distinct canonical as entry from forms where regexp_matches(url, '[?&]ref=') and canonical <> ''
), ruled as (
  select *, case
    when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
    when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
    when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
    when (host = 'com' or host like '%.com') and path like '/%' then 'com/' end as rule
  from forms
)
select page_id, host, path, rule, canonical,
       case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block'
            when entry is not null then 'block' else 'allow' end as verdict
from ruled left join listed on canonical = entry
"""

MIXING = r"""
with recursive rows as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as t,
         cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as bigint) as size,
         length(regexp_replace(coalesce(text, ''), '[^A-Za-z\x{80}-\x{10FFFF}]', '', 'g')) + 1.0 as letters,
         length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) + 1.0 as visible
  from documents
), keyed as (
  select *, cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || t), 1, 13) as bigint) as draw,
         -ln((draw + 0.5::double) / 4503599627370496::double) / pow(letters::double / visible::double, 4) as key
  from rows
), sources as (
  select source, cast(sum(size) as bigint) as source_size, 3 * source_size as cap,
         [5, 2, 1][cast((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1 as int)] as weight
  from keyed group by source
), whole as (select cast(sum(source_size) as bigint) as total, sum(weight) as weights from sources
), shares as (
  select total as rest, weights as open_weight, 0 as round from whole
  union all
  select total - (select coalesce(sum(cap), 0) from sources where cap < weight * rest / open_weight)::bigint,
         weights - (select coalesce(sum(weight), 0) from sources where cap < weight * rest / open_weight), round + 1
  from shares, whole where round < 100 and total > 0
), aims as (
  select source, source_size, case when total = 0 then 0.0 when cap < weight * rest / open_weight then cap::double else weight * rest / open_weight end as target,
         case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs, target - epochs * source_size as budget
  from sources, whole, (select rest, open_weight from shares order by round desc limit 1)
), summed as (
  select r, doc_id, k.source, size, source_size, target, epochs, budget, key,
         cast(sum(size) over (partition by k.source order by key, doc_id, r rows unbounded preceding) as bigint) as upto
  from keyed k join aims a on k.source is not distinct from a.source
), gaps as (
  select source, any_value(budget) - coalesce(max(upto) filter (where upto <= budget), 0) as missing from summed group by source
), closers as (
  select s.source, arg_min(r, row(abs(size - missing), key, doc_id)) as closing
  from summed s join gaps g on s.source is not distinct from g.source
  where not upto <= budget and abs(size - missing) < missing group by s.source
)
select doc_id, s.source, size, source_size, target,
       cast(case when size = 0 then 0 else epochs + (upto <= budget or coalesce(closing = r, false))::int end as bigint) as times, size * times as taken
from summed s left join closers c on s.source is not distinct from c.source
"""

FILTER_AUDIT = r"""
with texts as (
  select row_number() over () as r, doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), marks as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
), judged as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
          regexp_matches(t, '[#$%&*|]'), coalesce(texts.doc_id > min(texts.doc_id) over (partition by t), false)] as fails
  from texts left join marks on texts.doc_id = marks.doc_id
), counted as (select part, fails, count(*) as n, sum(good) as n_good, sum(toxic) as n_toxic from judged group by all
), letters as (select unnest(range(1, 6)) as i, unnest(['A', 'B', 'C', 'D', 'E']) as l
), orders as (
  select concat(a.l, b.l, c.l, d.l, e.l) as filter_order, [a.i, b.i, c.i, d.i, e.i] as seq
  from letters a, letters b, letters c, letters d, letters e where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps as (
  select part, filter_order, step::int as step, seq[step] as f, n, n_good, n_toxic, fails[seq[step]] as here,
         list_bool_or(list_transform(list_slice(seq, 1, step - 1), lambda i: fails[i])) is true as earlier,
         len(list_filter(fails, lambda x: x)) as n_fails
  from counted, orders, range(1, 6) s(step)
), summed as (
  select part, filter_order, step, f,
         sum(case when not here and not earlier then n else 0 end)::bigint as kept, sum(case when here and not earlier then n else 0 end)::bigint as removed,
         sum(case when here and earlier then n else 0 end)::bigint as redundant, sum(case when here and n_fails = 1 then n else 0 end)::bigint as unique_fails,
         sum(case when here and not earlier then n_good else 0 end)::bigint as good_lost, sum(case when here and not earlier then n_toxic else 0 end)::bigint as toxic_lost
  from steps group by part, filter_order, step, f
)
select * exclude (f), (sum(removed) over (partition by part, f))::bigint as shapley from summed
"""
