"""One query per operator over its whole table, and check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    chat_quotes,
    conversation_repair,
    decontamination,
    exact_dedup,
    html_extraction,
    language_id,
    lm_scoring,
    mixing,
    near_dedup,
    source_divergence,
    suffix_dedup,
    token_counts,
    url_rules,
)
from footfall.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@_query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op3_url_filters"] = r"""
with cut as (
  select page_id, case when contains(url, '://') then regexp_extract(url[position('://' in url) + 3:], '^[^?#]*') else '' end as rest
  from pages),
parts as (
  select page_id, regexp_extract(rest, '^[^/]*') as raw, rest from cut),
urls as (
  select page_id, translate(coalesce(raw, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(rest[length(raw) + 1:], '') as path from parts),
rules(name, rhost, rpath, act) as (values
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fits as (
  select page_id, host, path, name, act from urls left join rules
    on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, arg_max(name, length(name)) as rule,
  coalesce(arg_max(act, length(name)),
    case when regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|poker|porn|spam|xxx)([.-]|$)') then 'block' else 'allow' end) as verdict
from fits group by page_id, host, path"""


@_query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))"""


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op10_mixing"] = r"""
with sized as (
  select doc_id, source, length(bin(size)) as importance, size, row_number() over (partition by doc_id, source, size) - 1 as nth from (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents)),
sources as (select source, cast(sum(size) as bigint) as source_size, count(*) as n from sized group by source),
weighted as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight
  from sources),
filled as (select *, source_size * 2.0::double as most, source_size * 2.0::double / weight as fill from weighted),
levelled as (
  select *, (sum(source_size) over () * 1.5::double - coalesce(sum(most) over earlier, 0)) / (sum(weight) over () - coalesce(sum(weight) over earlier, 0)) as level
  from filled window earlier as (order by fill, source nulls last rows between unbounded preceding and 1 preceding)),
targets as (
  select source, source_size, case when level > fill then most else max(case when level <= fill then level end) over () * weight end as target
  from levelled),
parts as (
  select source, source_size, target, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole from targets),
classes as (
  select c.source, importance, words, p.target - p.whole * p.source_size as rest,
    coalesce(sum(words) over (partition by c.source order by importance desc rows between unbounded preceding and 1 preceding), 0) as certain,
    sum(words * importance) over (partition by c.source order by importance desc rows between current row and unbounded following) as open
  from (select source, importance, cast(sum(size) as bigint) as words from sized where size > 0 group by source, importance) c
  join parts p on p.source is not distinct from c.source),
scaled as (select *, (rest - certain) / open as scale from classes),
odds as (
  select source, importance, rest, case when scale * importance >= 1 then 1.0::double
    else greatest(max(case when scale * importance < 1 then scale end) over (partition by source) * importance, 0) end as odds from scaled),
drawn as (
  select s.*, rest, odds, (cast(('0x' || substr(md5('mix' || coalesce(cast(doc_id as varchar), '') || case when nth > 0 then ':' || size || ':' || nth else '' end), 1, 13)) as bigint) + 0.5::double) / pow(16, 13) as u
  from sized s join odds o on o.source is not distinct from s.source and o.importance = s.importance where size > 0),
ranked as (
  select *, case when odds >= 1 then 0.0 when odds <= 0 then 1.0 else u * (1 - odds) / (u * (1 - odds) + odds * (1 - u)) end as rank,
    coalesce(doc_id, -9223372036854775808) as tie from drawn),
taking as (
  select doc_id, source, size, case when 2 * sum(size) over (partition by source order by rank, tie, size, nth) - size <= 2 * rest then 1 else 0 end as more from ranked)
select t.doc_id, t.size, p.source_size, p.target, cast((p.whole + t.more) * t.size as bigint) as taken, p.whole + t.more as copies
from taking t join parts p on p.source is not distinct from t.source
union all
select s.doc_id, s.size, p.source_size, p.target, 0, 0 from sized s join parts p on p.source is not distinct from s.source where s.size = 0"""


@_query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(token_counts.MODEL))


@_query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_copies(table(spark, sf_dir, "documents"))


ORACLES["op2_minhash_near_dedup"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
runs as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words)),
sizes as (select doc_id, count(*) as n from runs group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as c from runs a join runs b using (s) where a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)),
reach(doc_id, other) as (
  select doc_id, doc_id from documents union select r.doc_id, l.y from reach r join links l on l.x = r.other),
parts as (select doc_id, min(other) as component_id from reach group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join parts using (doc_id) left join sizes using (doc_id)"""


@_query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"))


@_query
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_quotes.format_chat(table(spark, sf_dir, "conversations"))


ORACLES["op4_chat_formatting"] = r"""
with recursive messages as (
  select conv_id, turn, role, t, row_number() over () as m from (
    select conv_id, turn, role, replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) as t from conversations)),
split as (
  select m, conv_id, turn, unnest(string_split(t, chr(10))) as line, generate_subscripts(string_split(t, chr(10)), 1) as spot from messages),
marked as (
  select *, regexp_extract(line, '^([ \t>]*>)', 1) as mark from split),
lines as (
  select m, conv_id, turn, spot, length(regexp_replace(mark, '[^>]', '', 'g')) as level,
         trim(lower(regexp_replace(line[length(mark) + 1:], '[ \t\n\v\f\r]+', ' ', 'g'))) as said from marked),
runs as (
  select *, sum(fresh) over (partition by m order by spot) as passage from (
    select *, case when lag(level) over (partition by m order by spot) = level then 0 else 1 end as fresh from lines)),
quoted as (select * from runs where level > 0 and said <> ''),
sources as (
  select q.m, q.conv_id, q.turn, q.passage, q.level, q.spot, max(o.turn) as source
  from quoted q left join lines o on o.conv_id = q.conv_id and o.said = q.said and o.level = 0 and o.turn < q.turn
  group by all),
votes as (select m, conv_id, turn, passage, source, count(*) as n from sources where source is not null group by all),
best as (select m, passage, arg_max(source, (n, source)) as source, max(n) as n from votes group by all),
passages as (
  select q.m, q.conv_id, q.turn, q.passage, any_value(q.level) as level,
         case when 2 * any_value(b.n) >= count(*) then any_value(b.source) end as source
  from quoted q left join best b on b.m = q.m and b.passage = q.passage group by q.m, q.conv_id, q.turn, q.passage),
answers as (
  select m, conv_id, turn, count(*) as passages, count(source) as linked,
         arg_min(source, (level, passage)) filter (where source is not null) as reply_to from passages group by all),
above as (select conv_id, turn, max(reply_to) as up from answers where reply_to is not null group by all),
chain(conv_id, turn, top, depth) as (
  select conv_id, turn, up, 1 from above
  union all select c.conv_id, c.turn, a.up, c.depth + 1 from chain c join above a on a.conv_id = c.conv_id and a.turn = c.top),
roots as (select conv_id, turn, arg_max(top, depth) as thread, max(depth) as depth from chain group by all)
select x.conv_id, x.turn, x.role, coalesce(passages, 0) as passages, coalesce(linked, 0) as linked, reply_to,
  case when reply_to is null then x.turn else thread end as thread, case when reply_to is null then 0 else depth end as depth,
  regexp_replace(regexp_replace(t, '(?m)^[ \t]*>[^\n]*\n?', '', 'g'), '^[ \t\n\v\f\r]+|[ \t\n\v\f\r]+$', '', 'g') as body,
  '<|' || coalesce(x.role, 'unknown') || '|>' || chr(10) ||
  regexp_replace(regexp_replace(t, '(?m)^[ \t]*>[^\n]*\n?', '', 'g'), '^[ \t\n\v\f\r]+|[ \t\n\v\f\r]+$', '', 'g') as formatted
from messages x left join answers using (m) left join roots r on r.conv_id = x.conv_id and r.turn = x.turn"""


@_query
def op11_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.audit_report(rows, F.col("copies"))


ORACLES["op11_conversation_structure_repair"] = r"""
with recursive hurt as (
  select *, crc % 20 as fate from (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
      -- crc32 by its definition: bits of the key from the lowest, polynomial 0xEDB88320
      xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(k)) * 8), lambda i:
          ((ord(k[(i // 8 + 1)::bigint]) >> (i % 8)) & 1)::bigint)),
        lambda c, b: case when xor(c, b) & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end), 4294967295::bigint) as crc
    from (select *, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations))),
rows_ as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
    case fate when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case fate when 0 then 0 when 3 then 2 else 1 end)) as copy, n from (select *, row_number() over () as n from hurt)),
placed as (
  select *, row_number() over w as pos, row_number() over (partition by conv_id, role, text order by turn nulls first, copy, n) as seen,
    lag(role) over w as before
  from rows_ window w as (partition by conv_id order by turn nulls first, role, sha256(text), copy, n)),
faults as (
  select *, case when not regexp_matches(text, '[^ 	-
]') then 'blank' when seen > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][ 	-
]*$') then 'truncated' else 'none' end as fault,
    case when role[1] in ('s', 'u', 'a') then role[1] else 'o' end as r from placed),
sizes as (select conv_id, max(pos) as n from faults group by conv_id),
walk(conv_id, pos, b0, b1, b2, b3) as (
  select conv_id, 0::bigint, {'c': 0, 'a': ''}, {'c': 1000000, 'a': ''}, {'c': 1000000, 'a': ''}, {'c': 1000000, 'a': ''} from sizes
  union all
  select conv_id, pos,
    {'c': e0.c + 4, 'a': e0.a || 'D'},
    least({'c': e1.c + 4, 'a': e1.a || 'D'}, case when not gone and r = 's' then {'c': e0.c + t, 'a': e0.a || 'K'} else {'c': 1000000, 'a': ''} end),
    least({'c': e2.c + 4, 'a': e2.a || 'D'}, case when gone then {'c': 1000000, 'a': ''} else {'c': toward_u.c + t + ku, 'a': toward_u.a || case ku when 0 then 'K' else 'R' end} end),
    least({'c': e3.c + 4, 'a': e3.a || 'D'}, case when gone then {'c': 1000000, 'a': ''} else {'c': e2.c + t + ka, 'a': e2.a || case ka when 0 then 'K' else 'R' end} end)
  from (
    select *, least(e0, e1, e3) as toward_u from (
      select *, least(b3, {'c': e2.c + 3, 'a': e2.a || 'I'}) as e3 from (
        select w.conv_id, f.pos, b0 as e0, b1 as e1, b3, f.r, fault in ('blank', 'duplicate') as gone,
          case when fault = 'truncated' then 3 else 0 end as t, case when r = 'u' then 0 else 3 end as ku, case when r = 'a' then 0 else 3 end as ka,
          least(b2, {'c': b0.c + 3, 'a': b0.a || 'I'}, {'c': b1.c + 3, 'a': b1.a || 'I'}, {'c': b3.c + 3, 'a': b3.a || 'I'}) as e2
        from walk w join faults f on f.conv_id is not distinct from w.conv_id and f.pos = w.pos + 1)))),
done as (
  select conv_id, least(b0, b3, {'c': e2.c + 3, 'a': e2.a || 'I'}) as best from (
    select w.*, least(b2, {'c': b0.c + 3, 'a': b0.a || 'I'}, {'c': b1.c + 3, 'a': b1.a || 'I'}, {'c': b3.c + 3, 'a': b3.a || 'I'}) as e2
    from walk w join sizes s on s.conv_id is not distinct from w.conv_id and w.pos = s.n)),
edits as (
  select conv_id, op, e, count(*) filter (where op <> 'I') over w as pos, count(*) filter (where op <> 'D') over w as place,
    count(*) filter (where op <> 'D') over (partition by conv_id) as kept
  from (select conv_id, unnest(string_split(best.a, '')) as op, generate_subscripts(string_split(best.a, ''), 1) as e from done where best.a <> '')
  window w as (partition by conv_id order by e)),
said as (
  select x.conv_id, string_agg(case op when 'K' then role else case when (place + kept) % 2 = 1 then 'user' else 'assistant' end end
      || ':' || case op when 'I' then '' else text end, chr(10) order by e) as said
  from edits x left join faults f on f.conv_id is not distinct from x.conv_id and f.pos = x.pos and x.op <> 'I' where op <> 'D' group by x.conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where before is not null and before[1] || role[1] not in ('su', 'ua', 'au')) as illegal
  from faults group by conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(best.c, 0) as bigint) as cost, coalesce(best.a, '') as audit,
  sha256(coalesce(said, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join counts k on k.conv_id is not distinct from c.conv_id left join done d on d.conv_id is not distinct from c.conv_id
left join said s on s.conv_id is not distinct from c.conv_id"""


@_query
def op12_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence_audit"] = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
uses as (select d, lang, source, term, count(*) as n from (select d, lang, source, unnest(w) as term from docs) group by all),
kept as (select lang, term, cast(sum(n) as hugeint) as lang_count from uses group by lang, term having count(*) >= 30),
langs as (select lang, count(*) as v, sum(lang_count) as lang_total from kept group by lang),
groups as (select distinct lang, source from docs),
cells as (
  select g.lang, g.source, k.term, lang_count, coalesce(sum(n), 0) as c
  from groups g join kept k using (lang) left join uses u on u.lang = g.lang and u.source = g.source and u.term = k.term group by all),
shares as (
  select *, cast(1 + 1000000000::hugeint * (c + 5) // (sum(c) over (partition by lang, source) + 5 * v) as bigint) as p,
    cast(1 + 1000000000::hugeint * (lang_count + 5) // (lang_total + 5 * v) as bigint) as q
  from cells join langs using (lang)),
pairs as (
  select a.lang, a.source, b.source as item, cast(coalesce(sum(abs(x.p - y.p)), 0) as bigint) as value
  from groups a join groups b on b.lang = a.lang and b.source <> a.source
  left join shares x on x.lang = a.lang and x.source = a.source left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all),
terms as (select lang, source, term as item, p - q as value from shares where c > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over w as rank from pairs window w as (partition by lang, source order by value desc, encode(item))
  union all
  select lang, source, 'term', item, value, row_number() over w from terms window w as (partition by lang, source order by value desc, encode(item)))
select lang, source, part, item, value, cast(rank as int) as rank from ranked where part = 'pair' or rank <= 50"""


@_query
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages).select("page_id", "url", "text", "n_chars")
