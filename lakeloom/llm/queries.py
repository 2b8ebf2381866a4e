"""Registered queries of the training-data operators: each applies its operator to the whole documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import decontamination, fingerprints, language_id, license_scan, mixing
from lakeloom.llm import merkle, near_dedup, periodic_runs, quality, secret_scan, substring_dedup, token_output, toxicity
from lakeloom.llm.common import shared_dir, written


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_dir(spark, "tokens")
    token_output.write_tokens(_read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 2)
    return token_output.token_digest(spark, path)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.NearDuplicates(_read(spark, sf_dir, "documents"), k=3, percent=85).groups()


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_read(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = license_scan.document_paths(_read(spark, sf_dir, "documents"))
    return license_scan.inherit(written(license_scan.scan_licenses(files), "licenses"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(_read(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(_read(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_report(_read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontamination_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.RepeatedPassages(_read(spark, sf_dir, "documents")).report()


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(_read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digest(_read(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def queries() -> dict:
    """Name to query, for the entry module."""
    every = (
        op1_token_output, op2_near_dedup, op3_mixing, op4_license_scan, op5_language_id,
        op6_secret_scan, op7_fingerprints, op8_toxicity, op9_decontamination, op10_substring_dedup,
        op11_periodic_runs, op12_merkle_manifest, op13_quality,
    )
    return {f.__name__: f for f in every}


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_LETTERED = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

#: All pairs that share a shingle, and what is reachable over those alike enough.
_NEAR_DEDUP = f"""
with recursive doc_words as (select doc_id, regexp_extract_all({_FOLDED}, {_SPACED}) as ws from documents),
 shingles as (
  select distinct doc_id, ws[i : i + 2] as s
  from doc_words, unnest(range(1, greatest(len(ws) - 1, 2))) t(i) where len(ws) > 0),
 sizes as (select doc_id, count(*) as n from shingles group by 1),
 shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
 links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 85 * (x.n + y.n - common)),
 edges as (select a, b from links union all select b, a from links),
 reached as (
  select doc_id, doc_id as other from documents
  union select r.doc_id, e.b from reached r join edges e on e.a = r.other),
 least_of as (select doc_id, min(other) as component_id from reached group by 1)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join least_of on least_of.doc_id = d.doc_id left join sizes on sizes.doc_id = d.doc_id"""

#: Every window of every document joined with every window of the benchmark by its words.
_DECONTAMINATION = f"""
with item_words as (select item_id, regexp_extract_all({_FOLDED}, {_LETTERED}) as ws from benchmark),
 known as (
  select distinct item_id, least(len(ws), 10) as n, ws[i : i + least(len(ws), 10) - 1] as w
  from item_words, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) t(i) where len(ws) > 0),
 doc_words as (select doc_id, regexp_extract_all({_FOLDED}, {_LETTERED}) as ws from documents),
 windows as (
  select doc_id, n, i, ws[i : i + n - 1] as w
  from doc_words, (select distinct n from known) lengths, unnest(range(1, len(ws) - n + 2)) t(i)),
 found as (select doc_id, windows.n, i, item_id from windows join known on known.w = windows.w),
 hit as (select doc_id, count(distinct p) as n_hit from found, unnest(range(i, i + n)) t(p) group by 1),
 items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as named
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by 1)
select d.doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
 sha256(coalesce(named, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hit on hit.doc_id = d.doc_id left join items on items.doc_id = d.doc_id"""

#: Every window numbered among those of the same words; what a later one covers goes.
_SUBSTRING_DEDUP = f"""
with doc_words as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) as ws from documents),
 windows as (
  select doc_id, i, hash(ws[i : i + 19]) as h, ws[i : i + 19] as w
  from doc_words, unnest(range(1, len(ws) - 18)) t(i)),
 several as (select h from windows group by 1 having count(*) > 1),
 ranked as (
  select doc_id, i, row_number() over (partition by w order by doc_id, i) as nth
  from windows where h in (select h from several)),
 gone as (select distinct doc_id, p from ranked, unnest(range(i, i + 20)) t(p) where nth > 1),
 kept as (
  select d.doc_id, string_agg(ws[p], ' ' order by p) as text, count(*) as n
  from doc_words d, unnest(range(1, len(ws) + 1)) t(p)
  where not exists (select 1 from gone g where g.doc_id = d.doc_id and g.p = t.p) group by 1)
select d.doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from doc_words d left join kept on kept.doc_id = d.doc_id"""


#: Unsigned crc32 of the decimal number ``d``, byte by byte and bit by bit.
_CRC = """case when d = '' then 0 else xor(list_reduce(list_transform(string_split(d, ''), lambda c: ascii(c)::bigint),
  lambda h, b: list_reduce(range(8), lambda x, _: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(h, b)),
  4294967295::bigint), 4294967295) end"""

#: Sixteen words come again at every period that a run may have, so islands of equal distances of those are the runs.
_PERIODIC_RUNS = f"""
with doc_words as (
  select doc_id, coalesce(cast(doc_id as varchar), '') as d, regexp_extract_all(coalesce(text, ''), {_SPACED}) as ws from documents),
 hashed as (select doc_id, ws, len(ws) as n, {_CRC} as h from doc_words),
 cut as (select *, (h // 10) % nullif(n, 0) as a, 3 + (h // 10) % 8 as parts from hashed),
 edited as (
  select doc_id, n, case when h % 10 = 0 and n > 0
   then list_transform(range(n), lambda i: ws[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // parts) end])
   else ws end as ws
  from cut),
 grams as (
  select doc_id, n, i, ws[i + 1 : i + 16] as w, hash(ws[i + 1 : i + 16]) as h from edited, unnest(range(n - 15)) t(i)),
 again as (
  select a.doc_id, a.i, b.i - a.i as q
  from grams a join grams b on a.doc_id = b.doc_id and a.h = b.h and a.i < b.i and 3 * (b.i - a.i) <= a.n and a.w = b.w),
 islands as (select *, i - row_number() over (partition by doc_id, q order by i) as island from again),
 stretches as (
  select doc_id, min(i) as start, max(i) - min(i) + 16 + q as length, q as period from islands group by doc_id, q, island),
 long as (select * from stretches where length >= greatest(24, 3 * period)),
 runs as (
  select * from long r where not exists (
   select 1 from long s where s.doc_id = r.doc_id and s.period < r.period and s.start <= r.start
    and s.start + s.length >= r.start + r.length)),
 best as (
  select * from runs r where not exists (
   select 1 from runs s where s.doc_id = r.doc_id and (s.length * r.period > r.length * s.period
    or s.length * r.period = r.length * s.period and (s.start < r.start or s.start = r.start and s.period < r.period)))),
 listed as (
  select doc_id, count(*) as n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as lines
  from runs group by 1),
 gone as (select distinct doc_id, p from runs, unnest(range(start + period, start + length)) t(p)),
 kept as (
  select e.doc_id, string_agg(ws[p + 1], ' ' order by p) as text
  from edited e, unnest(range(n)) t(p)
  where not exists (select 1 from gone g where g.doc_id = e.doc_id and g.p = t.p) group by 1)
select e.doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
 sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
from edited e left join best on best.doc_id = e.doc_id left join listed on listed.doc_id = e.doc_id
 left join kept on kept.doc_id = e.doc_id"""


def _leaf(n_chars: str) -> str:
    fields = ["cast(doc_id as varchar)", "source", "lang", f"cast({n_chars} as varchar)", "text"]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + "))"


#: Level by level over whole groups; then each leaf meets its sibling of each level.
_MERKLE = f"""
with recursive hashed as (
  select doc_id, lang, coalesce(cast(doc_id as varchar), '') as d, {_leaf("n_chars")} as leaf, {_leaf("(n_chars + 1)")} as struck
  from documents),
 leaves as (
  select doc_id, lang, leaf, case when {_CRC} % 7 = 0 then struck else leaf end as given,
   row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n
  from hashed),
 nodes as (
  select lang, 0 as level, i, n, leaf as d from leaves
  union all
  select lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' order by i)) from nodes
  where n > 1 group by lang, level, i // 2, n),
 subs as (
  select lang, d as subroot, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n from nodes where n = 1),
 crown as (
  select 0 as level, i, n, subroot as d from subs
  union all
  select level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' order by i)) from crown
  where n > 1 group by level, i // 2, n),
 ways as (
  select l.lang, l.i, x.level as step, l.i >> x.level as turn, s.d
  from leaves l join (select distinct lang, level from nodes where n > 1) x on x.lang is not distinct from l.lang
   left join nodes s on s.lang is not distinct from l.lang and s.level = x.level and s.i = xor(l.i >> x.level, 1)
  union all
  select l.lang, l.i, 1000 + x.level, u.i >> x.level, s.d
  from leaves l join subs u on u.lang is not distinct from l.lang
   join (select distinct level from crown where n > 1) x on true
   left join crown s on s.level = x.level and s.i = xor(u.i >> x.level, 1)),
 paths as (
  select lang, i, string_agg(d, '' order by step) as proof,
   list(coalesce(case when turn % 2 = 1 then 'L' else 'R' end || d, '-') order by step) as steps
  from ways group by lang, i),
 folded as (
  select l.doc_id, l.leaf, subroot, (select d from crown where n = 1) as root, sha256(coalesce(proof, '')) as proof_sha256,
   list_reduce(coalesce(steps, []), lambda node, step: sha256(case step[1] when 'L' then step[2:] || node else node || step[2:] end), given) as folded_root
  from leaves l join subs u on u.lang is not distinct from l.lang
   left join paths p on p.lang is not distinct from l.lang and p.i = l.i)
select *, folded_root = root as verified from folded"""


def oracle_sql() -> dict[str, str]:
    """Equivalent SQL where SQL can express a query; the tests compare the others with plain forms."""
    return {
        "op2_near_dedup": _NEAR_DEDUP, "op9_decontamination": _DECONTAMINATION, "op10_substring_dedup": _SUBSTRING_DEDUP,
        "op11_periodic_runs": _PERIODIC_RUNS, "op12_merkle_manifest": _MERKLE,
    }
