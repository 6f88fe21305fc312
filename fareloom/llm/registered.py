"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import exact_dedup, language_id, lm_scoring, mixing, packing, periodic_runs, pii, quality, search, simhash_dedup, source_audit, token_counts, toxicity
from fareloom.llm.common import documents, labels, remainder

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, sf_dir), remainder(F.col("doc_id"), 7) == 2)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(documents(spark, sf_dir)).drop("part_from", "part_words", "first_words")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = language_id.predict(documents(spark, sf_dir), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return search.search(docs, docs.where(F.col("doc_id") % 20 == 0).select(F.col("doc_id").alias("query_id"), "text"))


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), remainder(F.col("doc_id"), 4) == 2
    model = quality.learn(docs, labels(spark, sf_dir), ~held_out)
    return quality.scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir)).drop("print")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), remainder(F.col("doc_id"), 3) == 1
    model, tables = toxicity.learn(docs, labels(spark, sf_dir), ~held_out)
    return toxicity.scored(docs, model, tables).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_planted_repeats(documents(spark, sf_dir))))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.personal_data(documents(spark, sf_dir)))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_mixing": op3_mixing,
        "op4_language_id": op4_language_id,
        "op5_search": op5_search,
        "op6_packing": op6_packing,
        "op7_quality": op7_quality,
        "op8_token_counts": op8_token_counts,
        "op9_simhash_dedup": op9_simhash_dedup,
        "op10_toxicity": op10_toxicity,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_pii": op12_pii,
        "op13_source_audit": op13_source_audit,
    }


_OP2 = r"""
with norm as (
  select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body from documents
), ranked as (
  select *, first_value(doc_id) over w as keep_id, row_number() over w as place, count(*) over (partition by body) as n
  from norm window w as (partition by body order by chars desc, doc_id nulls last rows between unbounded preceding and unbounded following)
)
select doc_id, keep_id, n as group_size, place = 1 as kept, sha256(body) as text_sha256 from ranked
"""


_OP3 = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents
), marked as (
  select *, coalesce(doc_id::varchar, 'none') || '|' || size::varchar as mark from sized
), sizes as (
  select source, sum(size)::bigint as source_size, count(*) as docs from sized group by source
), weighed as (
  select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight, 3 * source_size as cap from sizes
), filled as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over w, 0)) / (sum(weight) over () - coalesce(sum(weight) over w, 0)) as level
  from weighed window w as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)
), leveled as (
  select *, (select level from filled where level <= cap / weight order by cap / weight, source nulls last limit 1) as chosen from filled
), targets as (
  select source, source_size, docs, least(cap::double, weight * chosen) as target from leveled
), seated as (
  select *, floor(sum(target) over () / 16 + 0.5)::bigint as seats from targets
), source_quotients as (
  select source, row_number() over (order by target / (2 * k + 1) desc, source nulls last, k) as place, seats
  from seated, unnest(range(0, (floor(target / 16) + 30)::bigint)) as u(k)
), source_quotas as (
  select s.source, s.source_size, s.target, s.docs, coalesce(q.quota, 0) as quota from seated s
  left join (select source, count(*) as quota from source_quotients where place <= seats group by source) q on s.source is not distinct from q.source
), placed as (
  select m.*, q.source_size, q.target, q.quota as source_quota,
    ('0x' || substr(md5('mix-1|shard|' || m.mark), 1, 8))::bigint % ceil(q.docs / 2000)::bigint as shard
  from marked m join source_quotas q on m.source is not distinct from q.source
), shards as (
  select source, shard, source_quota, sum(size)::bigint as shard_size from placed group by all
), shard_shares as (
  select *, sum(shard_size) over (partition by source) as whole from shards
), shard_quotients as (
  select source, shard, source_quota, row_number() over (partition by source order by shard_size / (2 * k + 1) desc, shard, k) as place
  from shard_shares, unnest(range(0, (case when whole = 0 then 0 else floor(source_quota * shard_size / whole) + 30 end)::bigint)) as u(k)
), shard_plan as (
  select s.source, s.shard, s.shard_size, greatest(floor(s.shard_size / 16 + 0.5)::bigint, 1) as blocks, coalesce(q.quota, 0) as seats
  from shards s left join (select source, shard, count(*) as quota from shard_quotients where place <= source_quota group by all) q
    on s.source is not distinct from q.source and s.shard = q.shard
), quotas as (
  select *, least(seats, 3 * blocks) // blocks as times, least(seats, 3 * blocks) % blocks as more,
    ('0x' || substr(md5('mix-1|start|' || coalesce(source, '') || '|' || shard::varchar), 1, 8))::bigint % blocks as start
  from shard_plan
), runs as (
  select *, floor(start * shard_size / blocks)::bigint as run_from, floor(least(start + more, blocks) * shard_size / blocks)::bigint as run_to,
    floor(greatest(start + more - blocks, 0) * shard_size / blocks)::bigint as wrap_to
  from quotas
), lined as (
  select *, sum(size) over (partition by source, shard order by ('0x' || substr(md5('mix-1|order|' || mark), 1, 8))::bigint, mark
    rows between unbounded preceding and current row)::bigint as ends from placed
)
select l.doc_id, l.size, l.source_size, l.target,
  (case when l.size = 0 then 0 else r.times * l.size + greatest(least(l.ends, r.run_to) - greatest(l.ends - l.size, r.run_from), 0)
    + greatest(least(l.ends, r.wrap_to) - (l.ends - l.size), 0) end)::bigint as taken
from lined l join runs r on l.source is not distinct from r.source and l.shard = r.shard
"""


_OP11 = r"""
with bytes as (
  select doc_id, text, list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)) as codes from documents
), sums as (
  select doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(codes, lambda c: c::bigint)), lambda crc, b:
    list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, step: xor(x >> 1, 3988292384 * (x & 1))))) as h from bytes
), original as (
  select doc_id, h, h // 10 as g, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words from sums
), sized as (
  select *, len(words) as n, case when len(words) > 0 then g % len(words) end as a from original
), bent as (
  select *, 1 + (n - a) // (3 + g % 8) as p from sized
), texts as (
  select doc_id, n, case when h % 10 = 0 and n > 0
    then list_transform(range(n), lambda i: words[1 + case when i < a then i else a + (i - a) % p end]) else words end as words from bent
), word as (
  select doc_id, n, unnest(range(n)) as i, unnest(words) as w from texts
), matches as (
  select b.doc_id, b.i, b.i - a.i as lag from word a join word b on a.doc_id = b.doc_id and a.w = b.w and a.i < b.i and 4 * (b.i - a.i) <= b.n
), grouped as (
  select *, i - row_number() over (partition by doc_id, lag order by i) as island from matches
), stretches as (
  select doc_id, lag, min(i) - lag as start, count(*) + lag as length from grouped group by doc_id, lag, island
), runs as (
  select doc_id, start, length, min(lag) as period from stretches where length >= greatest(6, 4 * lag) group by doc_id, start, length
), best as (
  select *, row_number() over (partition by doc_id order by length desc, start, period) as place from runs
), listed as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from runs group by doc_id
), kept as (
  select doc_id, string_agg(w, ' ' order by i) as body from word
  where not exists (select 1 from runs r where r.doc_id = word.doc_id and word.i >= r.start + r.period and word.i < r.start + r.length)
  group by doc_id
)
select t.doc_id, coalesce(l.n_runs, 0)::bigint as n_runs, b.start, b.length, b.period, (1000 * b.length // b.period)::bigint as exponent_milli,
  sha256(coalesce(l.lines, '')) as runs_sha256, sha256(coalesce(k.body, '')) as collapsed_sha256
from texts t left join listed l using (doc_id) left join best b on b.doc_id = t.doc_id and b.place = 1 left join kept k on k.doc_id = t.doc_id
"""


_OP13 = r"""
with numbered as (
  select row_number() over () as no, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as body from documents
), words as (
  select no, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as word from numbered
), terms as (
  select no, lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from words
), kept as (
  select lang, term, count(*) as total from terms group by lang, term having count(distinct no) >= 30
), langs as (
  select lang, count(*) as v, sum(total) as lang_total from kept group by lang
), counts as (
  select lang, source, term, count(*) as n from terms semi join kept using (lang, term) group by all
), groups as (
  select g.lang, g.source, coalesce(l.v, 0)::hugeint as v, coalesce(l.lang_total, 0)::hugeint as lang_total, coalesce(c.own, 0)::hugeint as own
  from (select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents) g
  left join langs l using (lang) left join (select lang, source, sum(n) as own from counts group by all) c using (lang, source)
), shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.own + 5 * g.v) as p,
    1 + (1000000000::hugeint * (k.total + 5)) // (g.lang_total + 5 * g.v) as lang_p
  from groups g join kept k using (lang) left join counts c using (lang, source, term)
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (
    select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value from shares x join shares y using (lang, term) group by all
  ) s on s.lang = a.lang and s.source = a.source and s.item = b.source
), ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
  union all
  select lang, source, 'term', term, (p - lang_p)::bigint, row_number() over (partition by lang, source order by p - lang_p desc, term)
  from shares where n > 0 and p > lang_p
)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": _OP2, "op3_mixing": _OP3, "op11_periodic_runs": _OP11, "op13_source_audit": _OP13}
