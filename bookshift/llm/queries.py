"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookshift.llm import (chat_format, decontaminate, exact_dedup, filter_audit, licenses, near_dedup, packing, quality, secrets,
                           spelling, substring_dedup, toxicity, warc)
from bookshift.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat_format.digest(turns.unionByName(probe))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_chat_format": op2_chat_format,
    "op3_license_scan": op3_license_scan,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_secret_scan": op8_secret_scan,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_filter_interactions": op13_filter_interactions,
}

_WORDS = (r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

_OP1 = r"""
with d as (select row_number() over () as rid, doc_id, {words} as w from documents),
b as (select row_number() over () as bid, item_id, {words} as w from benchmark),
grams as (
  select item_id, k, unnest(list_transform(range(1, greatest(len(w) - 13, 0) + 2),
    lambda i: array_to_string(w[i:i + k - 1], ' '))) as g
  from (select *, least(13, len(w)) as k from b where len(w) > 0)),
said as (
  select rid, k, generate_subscripts(s, 1) - 1 as spot, unnest(s) as g from (
    select rid, k, list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')) as s
    from d, (select distinct k from grams) where len(w) >= k)),
hit as (
  select rid, item_id, spot, said.k from said join (select distinct * from grams) grams
  on said.g = grams.g and said.k = grams.k),
covered as (select rid, count(*) as n from (
  select distinct rid, unnest(range(spot, spot + k)) as pos from hit) group by rid),
found as (
  select rid, count(*) as n, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct rid, cast(item_id as varchar) as item_id from hit) group by rid),
post as (select rid, unnest(w) as term, generate_subscripts(w, 1) as pos from d),
held as (select term, count(*) as held from post group by term),
item_terms as (select distinct bid, item_id, unnest(w) as term from b),
rare as (
  select *, count(*) over (partition by bid) as needed from (
    select t.*, coalesce(held, 0) as held,
      row_number() over (partition by bid order by coalesce(held, 0), t.term) as place
    from item_terms t left join held using (term)) where place <= 4),
seen as (
  select rid, item_id, needed, count(distinct term) over (
    partition by rid, bid order by pos range between 31 preceding and current row) as seen
  from post join rare using (term)),
near as (select rid, count(distinct item_id) as n from seen where seen = needed group by rid)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(covered.n, 0) as n_hit, coalesce(found.n, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(covered.n, 0) > 0 and 20 * coalesce(covered.n, 0) >= len(w) as contaminated,
  coalesce(near.n, 0) as n_near
from d left join covered using (rid) left join found using (rid) left join near using (rid)
""".replace("{words}", _WORDS)

_OP2 = r"""
with recursive c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p as (
  select *, '<|im_start|>' || replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '[', '%5B'), chr(10), '%0A')
    || chr(10) || replace(replace(replace(text, '%', '%25'), '<', '%3C'), '[', '%5B') || '<|im_end|>' || chr(10) as piece,
    row_number() over (partition by conv_id order by turn, role, text) as pos from c),
q as (
  select *, cast(strlen(piece) as bigint) as cost, pos = 1 and role = 'system' as is_system from p),
r as (
  select *, case when is_system then 0 else cost end as spent,
    greatest(1024 - sum(case when is_system then cost else 0 end) over (partition by conv_id), 2) as room from q),
s as (
  select *, sum(spent) over (partition by conv_id order by pos) - spent as before from r),
deal as (
  select conv_id, pos, cast(spent as bigint) as used, 1 as win from s where pos = 1
  union all
  select s.conv_id, s.pos, case when fits then deal.used + s.spent else s.spent end, deal.win + case when fits then 0 else 1 end
  from deal join s on s.conv_id is not distinct from deal.conv_id and s.pos = deal.pos + 1,
  lateral (select deal.used = 0 or deal.used + s.spent
    <= s.room - case when deal.win > 1 then least(256, s.room // 2) else 0 end as fits)),
t as (
  select s.*, deal.win from s join deal on s.conv_id is not distinct from deal.conv_id and s.pos = deal.pos),
w as (
  select conv_id, win, sum(spent) as own, min(before) as starts from t group by conv_id, win),
x as (
  select t.*, n.own as next_own, n.starts as next_starts,
    max(t.win) over (partition by t.conv_id) as windows
  from t left join w n on n.conv_id = t.conv_id and n.win = t.win + 1),
y as (
  select conv_id, pos, role, text,
    length(piece) * case when is_system then windows
      when next_own is not null and next_starts - before <= least(256, room - next_own) then 2 else 1 end as chars,
    windows from x)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by pos), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars, max(windows) as n_windows
from y group by conv_id
"""



def _values(rows: list[tuple]) -> str:
    said = [", ".join("null" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in r) for r in rows]
    return "(values " + ", ".join(f"({r})" for r in said) + ")"


_OP3 = r"""
with d as (select row_number() over () as rid, doc_id, {words} as w from documents),
post as (select rid, unnest(w) as word, generate_subscripts(w, 1) - 1 as pos from d),
phrases(phrase, label, j, word) as {phrases},
notices(notice, label, key, key_at, size, votes, j, word) as {notices},
places as (
  select rid, phrase, label, pos - j as spot from post join phrases using (word)
  group by rid, phrase, label, pos - j
  having count(*) = any_value((select count(*) from phrases p where p.phrase = phrases.phrase))),
base as (
  select rid, count(*) as n_base, min(spot) as first_word, max(spot) as last_word,
    list_sort(list(distinct label)) as labels
  from places where label is not null group by rid),
held as (select rid, pos, word from post where word in (select word from notices)),
rare as (
  select notice, j, word from (
    select notices.*, row_number() over (partition by notice order by df, word, j) as place
    from notices join (select word, count(distinct rid) as df from held group by word) using (word))
  where place <= size - votes + 1),
proposed as (select distinct rid, notice, pos - j as spot from held join rare using (word)),
keyed as (
  select distinct p.rid, p.notice, p.spot, n.label, n.size, n.votes
  from proposed p join (select distinct notice, label, key, key_at, size, votes from notices) n using (notice)
  join places k on k.rid = p.rid and k.phrase = n.key and abs(p.spot + n.key_at - k.spot) <= {slack}),
found as (
  select rid, max(stand / size) as cover, list(distinct keyed.label) as labels
  from (select rid, notice, pos - j as spot, count(*) as stand from held join notices using (word)
        group by rid, notice, pos - j) join keyed using (rid, notice, spot) where stand >= votes group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base,
  cast(first_word as double) as first_word, cast(last_word as double) as last_word, -- as pandas holds longs with nulls
  coalesce(array_to_string(base.labels, ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))),
    ','), '') as labels,
  coalesce(cover, case when n_base > 0 then {phrase} else 0 end) as score
from d left join base using (rid) left join found using (rid)
""".format(words=_WORDS, phrases=_values(licenses.rules()[0]), notices=_values(licenses.rules()[1]),
           slack=licenses.SLACK, phrase=licenses.PHRASE_SCORE)

_OP5 = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
  from documents)
select doc_id, max(doc_id) over (partition by norm) as keep_id,
  count(*) over (partition by norm) as group_size,
  doc_id = max(doc_id) over (partition by norm) as kept,
  sha256(norm) as text_sha256
from d
"""

_OP7 = r"""
with p as (
  select page_id, url, html,
    1700000000 + page_id % 5000 * 60 + page_id % 97 * 86400 as first,
    '"' || md5(coalesce(html, ''))[1:16] || '"' as tag,
    cast(1690000000 + page_id % 1000 * 3600 as varchar) as changed,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i)https?://', '') as u
  from pages),
k as (
  select *, lower(regexp_replace(regexp_extract(u, '^([^/?]*)', 1), '^(?i)(www|m)\.|:(80|443)$', '', 'g'))
    || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '')
    || case when q <> '' then '?' || q else '' end as url_key
  from (select *, coalesce(array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
    lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref)='))), '&'), '') as q from p)),
r as (
  select page_id * 4 as id, url_key, first as at_time, case when page_id % 3 <> 1 then tag end as etag, changed, html from k where page_id % 11 <> 5),
v as (
  select page_id * 4 + visit as id, url_key, visit, changed,
    first + (case visit when 1 then 3600 when 2 then 30 * 86400 else 45 * 86400 end
      - case when page_id % 13 = 7 then 50 * 86400 else 0 end) as at_time,
    case when visit = 3 then '"changed"' when page_id % 3 = 0 then 'W/' || tag end as etag
  from k, (values (1), (2), (3)) t(visit)),
j as (
  select v.*, r.id as rid, r.etag as retag, r.changed as rchanged, r.html,
    row_number() over (partition by v.id order by r.at_time desc nulls last, r.id desc nulls last) as place
  from v left join r on r.url_key = v.url_key and r.at_time < v.at_time),
o as (
  select *, case when rid is null then 'no-response'
    when etag is not null and retag is not null
      then case when regexp_replace(etag, '^W/', '') = regexp_replace(retag, '^W/', '') then 'resolved' else 'mismatch' end
    when changed = rchanged then 'resolved' else 'mismatch' end as outcome
  from j where place = 1)
select id, url_key, case when outcome = 'resolved' then rid else -1 end as response_id, outcome,
  case when outcome = 'resolved' then 'cache-control=max-age=' || visit || ';content-type=text/html;date='
    || at_time || coalesce(';etag=' || coalesce(etag, retag), '')
    || ';last-modified=' || rchanged end as headers,
  case when outcome = 'resolved' then coalesce(length(html), -1) else -1 end as body_chars,
  case when outcome = 'resolved' then md5(html) end as body_md5
from o
"""

_OP9 = r"""
with recursive d as (
  select doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') as w from documents),
sh as (
  select distinct doc_id, unnest(case when len(w) >= 5
    then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from d),
size as (select doc_id, count(*) as n from sh group by doc_id),
links as (
  select a.doc_id as u, b.doc_id as v
  from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id
  join size x on x.doc_id = a.doc_id join size y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n
  having 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reach as (
  select u as doc_id, v as other from links
  union
  select r.doc_id, l.v from reach r join links l on l.u = r.other),
top as (select doc_id, min(other) as other from reach group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(top.other, d.doc_id)) as component_id,
  d.doc_id = least(d.doc_id, coalesce(top.other, d.doc_id)) as kept
from d left join size using (doc_id) left join top using (doc_id)
"""

_BLANK_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_OP11 = r"""
with d as (select row_number() over () as rid, doc_id, {words} as w from documents),
grams as (
  select rid, doc_id, unnest(g) as g, generate_subscripts(g, 1) as spot from (
    select rid, doc_id, list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' ')) as g
    from d where len(w) >= 20)),
least as (select g, min(doc_id) as doc_id from grams group by g),
later as (
  select rid, spot from (
    select rid, spot, grams.doc_id, least.doc_id as least, min(spot) over (partition by rid, grams.g) as first
    from grams join least on grams.g = least.g) where first < spot or least < doc_id),
gone as (select distinct rid, unnest(range(spot, spot + 20)) as pos from later),
said as (select rid, unnest(w) as word, generate_subscripts(w, 1) as pos from d),
kept as (
  select rid, string_agg(word, ' ' order by pos) as text, count(*) as n
  from said anti join gone using (rid, pos) group by rid)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept using (rid)
""".format(words=_BLANK_WORDS)


def _crc_table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


_OP12 = r"""
with recursive runs as (
  select id, run, count(*) as n from (
    select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
    from documents) group by id, run),
checked as (
  select run, n, xor(list_reduce(list_concat([4294967295::bigint], bytes),
    lambda c, b: xor(c // 256, {table}[1 + (xor(c, b) & 255)])), 4294967295) as h
  from (select run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: case
    when unicode(c) < 128 then [unicode(c)::bigint]
    else [(192 + unicode(c) // 64)::bigint, (128 + unicode(c) % 64)::bigint] end)) as bytes from runs)),
vocab as (
  select word, cast(sum(n) as bigint) as n from (
    select n, case when h % 97 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word from checked)
  where length(word) >= 5 group by word having sum(n) >= 3),
cut as (
  select word, n, unnest(range(1, length(word) + 1)) as pos, word[1:pos - 1] || word[pos + 1:] as rest from vocab),
near as (
  select a.word, b.word as other, b.n from cut a join cut b on a.rest = b.rest and a.pos = b.pos and a.word <> b.word
  union select a.word, b.word, b.n from cut a join vocab b on a.rest = b.word
  union select b.word, a.word, a.n from cut a join vocab b on a.rest = b.word),
best as (
  select word, count(*) as n_near, first(other order by n desc, other) as other, max(n) as other_n from near group by word),
told as (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when other_n >= 2 * v.n then other end as form,
    case when other_n >= 2 * v.n then other_n end as form_n
  from vocab v left join best using (word)),
steps as (
  select word, word as at_word, 0 as far from told
  union all
  select s.word, t.form, far + 1 from steps s join told t on t.word = s.at_word where t.form is not null),
roots as (select word, arg_max(at_word, far) as root from steps group by word)
select word, form, root, n, n_near, cast(form_n as double) as form_n -- as pandas holds longs with nulls
from told join roots using (word)
""".replace("{table}", str(_crc_table()))

_OP13 = r"""
with recursive d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, {words} as w from documents),
f as (
  select d.doc_id, part, list_filter([
    case when len(w) < 200 then 'A' end, case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' end,
    case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) then 'C' end,
    case when regexp_matches(text, '[#$%&*|]') then 'D' end, case when d.doc_id > least then 'E' end],
    lambda x: x is not null) as fails,
    d.doc_id in (select doc_id from labels where quality = 1 and doc_id is not null) as good,
    d.doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null) as toxic
  from d join (select text, min(doc_id) as least from d group by text) using (text)),
orders as (
  select letter as filter_order from (select unnest(['A', 'B', 'C', 'D', 'E']) as letter)
  union all
  select filter_order || letter from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as letter)
  where not contains(filter_order, letter)),
steps as (
  select filter_order, step, filter_order[step] as letter, string_split(filter_order[1:step - 1], '') as before
  from orders, (select unnest(range(1, 6)) as step) where length(filter_order) = 5),
counted as (select part, fails, good, toxic, count(*) as n from f group by all),
told as (
  select part, filter_order, step, letter,
    sum(case when not list_has_any(fails, before) and not list_contains(fails, letter) then n else 0 end) as kept,
    sum(case when not list_has_any(fails, before) and list_contains(fails, letter) then n else 0 end) as removed,
    sum(case when list_has_any(fails, before) and list_contains(fails, letter) then n else 0 end) as redundant,
    sum(case when fails = [letter] then n else 0 end) as unique_fails,
    sum(case when good and not list_has_any(fails, before) and list_contains(fails, letter) then n else 0 end) as good_lost,
    sum(case when toxic and not list_has_any(fails, before) and list_contains(fails, letter) then n else 0 end) as toxic_lost
  from counted, steps group by part, filter_order, step, letter)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from told
""".format(words=_BLANK_WORDS)

ORACLE = {
    "op1_decontamination": _OP1,
    "op2_chat_format": _OP2,
    "op3_license_scan": _OP3,
    "op5_exact_dedup": _OP5,
    "op7_warc_revisits": _OP7,
    "op9_minhash_near_dedup": _OP9,
    "op11_substring_dedup": _OP11,
    "op12_spelling_variants": _OP12,
    "op13_filter_interactions": _OP13,
}
