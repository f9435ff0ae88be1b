"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cinestrata.llm import (
    bpe, digest, infill, interactions, language, licenses, lines, mixing, pii, quality, repeats,
    simhash, warc)
from cinestrata.llm.common import narrowed, table
from cinestrata.session import materialised, workspace

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    docs = narrowed(table(spark, sf_dir, "documents"), doc_id="long", source="string",
                    text="string")
    sizes = materialised(docs.select("doc_id", "source", mixing.word_count(F.col("text"))
                                     .alias("size")), "sizes")
    return mixing.mixed(sizes).select("doc_id", "size", "source_size", "target", "taken")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.identified(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def _template_rows() -> str:
    return ", ".join(f"('{name}', '{text}')" for name, text in licenses.TEMPLATES.items())


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op6_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return digest.compared_with_next(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the learned rules for every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to ids and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back."""
    folder = workspace(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that occur elsewhere."""
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without lines that several documents hold."""
    docs = narrowed(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    return lines.without_repeated_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their orders, by language."""
    return interactions.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for infilling, and restored."""
    docs = narrowed(table(spark, sf_dir, "documents"), doc_id="long", text="string")
    back = infill.restored(F.col("output"), F.col("form"))
    return infill.rearranged(docs).select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_licenses": op4_licenses,
    "op5_simhash": op5_simhash,
    "op6_digest": op6_digest,
    "op7_quality": op7_quality,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_warc": op9_warc,
    "op10_repeats": op10_repeats,
    "op11_lines": op11_lines,
    "op12_interactions": op12_interactions,
    "op13_infill": op13_infill,
}

ORACLES = {
    "op2_mixing": """
with recursive docs as (
  select doc_id, source, cast(coalesce(length(regexp_replace(regexp_replace(
    text, '[^\\x20\\x09-\\x0D]+', 'w', 'g'), '[\\x20\\x09-\\x0D]+', '', 'g')), 0) as bigint) as size
  from documents),
sized as (select source, cast(sum(size) as bigint) as source_size from docs group by source),
ranked as (
  select *, row_number() over (order by source nulls last) - 1 as rank,
    (select cast(sum(size) as bigint) from docs) as total from sized),
weighed as (
  select *, case rank % 3 when 0 then 5 when 1 then 2 else 1 end as weight,
    3 * source_size as cap from ranked),
by_ratio as (
  select *, cast(cap as double) / weight as ratio,
    (total - coalesce(sum(cap) over w, 0)) as left_over,
    sum(weight) over v as open_weight
  from weighed
  window w as (order by cast(cap as double) / weight, rank
               rows between unbounded preceding and 1 preceding),
         v as (order by cast(cap as double) / weight, rank
               rows between current row and unbounded following)),
level as (
  select cast(cast(left_over as bigint) as double) / cast(open_weight as bigint) as level
  from by_ratio where cast(left_over as double) / open_weight <= ratio
  order by ratio, rank limit 1),
claims as (
  select source, source_size, least(weight * level, cast(cap as double)) as target, rank,
    cast(floor(total / 64) as bigint) as seats,
    greatest(1, cast(ceil(source_size / 262144) as bigint)) as shards
  from weighed, level),
quotients as (
  select source, rank, seats, k, target / (2 * k + 1) as quotient
  from claims, unnest(range(0, seats)) as t(k) where target > 0),
source_seats as (
  select source, count(*) as source_seats from (
    select *, row_number() over (order by quotient desc, rank, k) as n from quotients)
  where n <= seats group by source),
dealt as (
  select d.*, c.source_size, c.target, coalesce(s.source_seats, 0) as source_seats,
    md5('vmix:' || coalesce('v' || d.doc_id, 'n')) as digest, c.shards
  from docs d join claims c on d.source is not distinct from c.source
  left join source_seats s on d.source is not distinct from s.source),
numbered as (
  select *, cast('0x' || substr(digest, 1, 8) as bigint) % shards as shard from dealt),
shards as (
  select source, shard, source_seats, cast(sum(size) as bigint) as words
  from numbered group by all),
shard_quotients as (
  select source, shard, source_seats, words / (2 * k + 1) as quotient, k
  from shards, unnest(range(0, source_seats)) as t(k) where words > 0),
quotas as (
  select source, shard, count(*) as quota from (
    select *, row_number() over (partition by source order by quotient desc, shard, k) as n
    from shard_quotients) where n <= source_seats group by source, shard),
filled as (
  select s.source, s.shard, cast(ceil(s.words / 64) as bigint) as blocks,
    least(coalesce(q.quota, 0), 3 * cast(ceil(s.words / 64) as bigint)) as quota
  from shards s left join quotas q
    on s.source is not distinct from q.source and s.shard = q.shard),
block_digests as (
  select source, shard, b, row_number() over (partition by source, shard order by
    md5('vmix:' || coalesce('v' || source, 'n') || ':v' || shard || ':v' || b)) as n
  from filled, unnest(range(0, blocks)) as t(b)),
placed as (
  select *, sum(size) over (partition by source, shard order by digest, doc_id, size
    rows between unbounded preceding and current row) - size as start from numbered),
once_more as (
  select p.doc_id, sum(least((b + 1) * 64, start + size) - greatest(b * 64, start)) as words
  from placed p
  join filled f on p.source is not distinct from f.source and p.shard = f.shard
  join block_digests d on d.source is not distinct from p.source and d.shard = p.shard
    and d.b between floor(start / 64) and floor((start + size - 1) / 64)
    and d.n <= f.quota % f.blocks
  where p.size > 0 group by p.doc_id)
select p.doc_id, p.size, p.source_size, p.target,
  cast(p.size * case when f.blocks > 0 then f.quota // f.blocks else 0 end
    + coalesce(o.words, 0) as bigint) as taken
from placed p
join filled f on p.source is not distinct from f.source and p.shard = f.shard
left join once_more o on p.doc_id = o.doc_id""",
    "op4_licenses": f"""
with texts as (
  select doc_id, coalesce(text, '') as text from documents),
words as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\pL\\pM\\pN]+'),
    lambda w: w <> '') as w from texts),
shingles as (
  select doc_id, p as start, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] as shingle
  from words, unnest(range(0, len(w) - 2)) as t(p)),
templates(license, t_text) as (values {_template_rows()}),
t_words as (
  select license, list_filter(regexp_split_to_array(lower(t_text), '[^\\pL\\pM\\pN]+'),
    lambda w: w <> '') as w from templates),
t_shingles as (
  select distinct license, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] as shingle
  from t_words, unnest(range(0, len(w) - 2)) as t(p)),
spans as (select license, count(*) as span from t_shingles group by license),
hits as (
  select s.doc_id, t.license, s.start, s.shingle, n.span
  from shingles s join t_shingles t using (shingle) join spans n using (license)),
places as (
  select h.doc_id, h.license, h.start, count(distinct o.shingle) / h.span as containment
  from hits h join hits o on h.doc_id = o.doc_id and h.license = o.license
    and o.start >= h.start and o.start < h.start + h.span
  group by h.doc_id, h.license, h.start, h.span)
select doc_id, license, max(containment) as containment,
  cast(arg_min(start, (-containment, start)) as bigint) as word_start
from places where containment >= 0.8 group by doc_id, license""",
    "op9_warc": """
with payloads as (select page_id, coalesce(html, '') as payload from pages),
digests as (
  select page_id, payload, sha1(payload) as sha, max(page_id) over (partition by payload) as first
  from payloads),
quints as (
  select *, list_transform(range(0, 8), lambda g:
    cast('0x' || substr(sha, cast(g * 5 + 1 as int), 5) as bigint)) as q from digests)
select page_id, cast(strlen(payload) as bigint) as payload_bytes,
  list_aggregate(list_transform(q, lambda v:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((v >> 15) & 31 as int) + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((v >> 10) & 31 as int) + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((v >> 5) & 31 as int) + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(v & 31 as int) + 1, 1)),
    'string_agg', '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from quints""",
    "op11_lines": r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) as pos from documents),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
repeated as (
  select key, max(doc_id) as last from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3),
marked as (
  select k.*, r.last is not null and k.doc_id <> r.last as dropped
  from keyed k left join repeated r using (key))
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from marked group by doc_id""",
    "op12_interactions": r"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')
      as w from documents),
firsts as (select text, min(doc_id) as least from texts group by text),
failed as (
  select doc_id, part, case when len(w) < 100 then 'A' else '' end
    || case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' else '' end
    || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text)
         then 'C' else '' end
    || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
    || case when least < doc_id then 'E' else '' end as fails
  from texts join firsts using (text)),
marks as (select doc_id, max(quality) = 1 as good, max(toxic) = 1 as toxic from labels group by 1),
cells as (
  select part, fails, count(*) as n, count(*) filter (good) as good,
    count(*) filter (toxic) as toxic
  from failed left join marks using (doc_id) group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where a.f not in (b.f, c.f, d.f, e.f) and b.f not in (c.f, d.f, e.f)
    and c.f not in (d.f, e.f) and d.f <> e.f),
steps as (
  select filter_order, cast(k as int) as step, filter_order[k] as f,
    substr(filter_order, 1, k - 1) as before, substr(filter_order, 1, k) as upto
  from orders, range(1, 6) as t(k)),
counted as (
  select part, filter_order, step, f,
    sum(case when translate(fails, upto, '') = fails then n else 0 end) as kept,
    sum(case when contains(fails, f) and translate(fails, before, '') = fails then n else 0 end)
      as removed,
    sum(case when contains(fails, f) and translate(fails, before, '') <> fails then n else 0 end)
      as redundant,
    sum(case when fails = f then n else 0 end) as unique_fails,
    sum(case when contains(fails, f) and translate(fails, before, '') = fails then good else 0 end)
      as good_lost,
    sum(case when contains(fails, f) and translate(fails, before, '') = fails then toxic else 0 end)
      as toxic_lost
  from cells, steps group by all)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, f) as bigint) as shapley
from counted""",
    "op13_infill": r"""
with units as (
  select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id) as h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u from documents),
numbers as (
  select *, len(u) as n, cast('0x' || substr(h, 1, 8) as bigint) % (len(u) + 1) as a,
    cast('0x' || substr(h, 9, 8) as bigint) % (len(u) + 1) as b,
    cast('0x' || substr(h, 17, 8) as bigint) % 100 as c,
    cast('0x' || substr(h, 25, 8) as bigint) % 100 as d from units),
parts as (
  select doc_id, n, text, case when text = '' or contains(text, '<P>') or contains(text, '<S>')
      or contains(text, '<M>') or c >= 90 then 'plain' when d < 20 then 'spm' else 'psm' end as form,
    array_to_string(u[1:least(a, b)], '') as prefix,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as middle,
    array_to_string(u[greatest(a, b) + 1:], '') as suffix
  from numbers)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts""",
}
