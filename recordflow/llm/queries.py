"""One query per operator over the given tables, with production parameters."""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, embedding_dups, fill_middle, fingerprints, langid, mixing, packing, pii, quality, repair, simhash, token_counts
from .common import QUERIES, SQL, cut, n_words, query, table

__all__ = ["QUERIES", "SQL"]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LISTED = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


@query("op3_byte_bpe")
def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = byte_bpe.round_trip(docs, RANKS, PATTERN)
    return both.select(
        "doc_id", (F.length("both.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("both.ids", 256).alias("ids_sha256"), F.sha2("both.decoded", 256).alias("decoded_sha256"))


@query("op4_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_token_counts")
def token_counts_of_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, LISTED, PATTERN).drop("text")


@query("op1_doc_fingerprints")
def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


MIX_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) :: bigint as size,
         md5(coalesce(doc_id :: varchar, '') || '|' || md5(coalesce(text, ''))) as mix_key
  from documents),
sources as (
  select source, sum(size) :: bigint as words,
         (row_number() over (order by source collate "C" nulls last) - 1) % 3 as place
  from sized group by source),
weighed as (select *, [3, 1, 2][place + 1] as weight, words * 2 as bound from sources),
levels as (
  select *, ((sum(words) over ()) :: double * 1.5 - coalesce(sum(bound) over (
             order by bound / weight, weight, bound rows between unbounded preceding and 1 preceding), 0) :: double)
            / (sum(weight) over (order by bound / weight, weight, bound
               rows between current row and unbounded following)) :: double as level
  from weighed),
chosen as (select (select first(level order by bound / weight, weight, bound)
                   from levels where level <= bound / weight) as level),
aims as (
  select source, words, place,
         case when c.level is null or c.level * weight > bound then bound :: double else c.level * weight end as target
  from weighed, chosen c),
placed as (
  select s.*, a.words as source_size, a.target, a.place,
         (sum(s.size) over (partition by s.source order by s.mix_key, s.size
          rows between unbounded preceding and current row) - s.size) :: double + s.size / 2.0 as middle
  from sized s join aims a on s.source is not distinct from a.source),
parts as (
  select *, case when middle < target then middle / target end as part_0,
         case when middle + source_size < target then (middle + source_size) / target end as part_1
  from placed)
select doc_id, size, source_size, target,
       size * ((part_0 is not null) :: int + (part_1 is not null) :: int) as taken,
       case when part_0 is not null then case place when 0 then @0:part_0@ when 1 then @1:part_0@ else @2:part_0@ end end as position,
       case when part_1 is not null then case place when 0 then @0:part_1@ when 1 then @1:part_1@ else @2:part_1@ end end as position_again
from parts
"""
for _i, _schedule in enumerate(mixing.SCHEDULES):
    for _part in ("part_0", "part_1"):
        _value = re.sub(r"(\d(?:\.\d+)?(?:e-?\d+)?)D", r"\1 :: double", mixing.position_sql(_part, _schedule))
        MIX_SQL = MIX_SQL.replace(f"@{_i}:{_part}@", _value)


@query("op2_source_mixing", MIX_SQL)
def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", n_words(F.col("text")).alias("size"),
        mixing.order_key(F.col("doc_id"), F.col("text")).alias("mix_key"))
    mixed = mixing.mix(cut(docs), F.col("size"), F.col("mix_key"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.get("positions", F.lit(0)).alias("position"), F.get("positions", F.lit(1)).alias("position_again"),
    ).orderBy("position", "doc_id")


CHAT_SQL = """
with convs as (
  select conv_id, list({'role': role, 'text': text} order by turn nulls first, role, text) as turns
  from (select distinct conv_id, turn, role, text from conversations) group by conv_id),
whole as (select min(conv_id) as conv_id, count(*) as n_copies, turns from convs group by turns),
inner_ as (select distinct turns[1 : k] as turns
           from (select turns, unnest(range(1, len(turns))) as k from whole)),
kept as (select * from whole w where not exists (select 1 from inner_ i where i.turns = w.turns))
select conv_id, len(turns) as n_turns, n_copies,
       list_aggregate(list_transform(turns, lambda t:
         '<|im_start|>' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '<|im_end|>' || chr(10)),
         'string_agg', '') as text
from kept
"""


@query("op10_chat_formatting", CHAT_SQL)
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.formatted(table(spark, folder, "conversations"))


@query("op9_pii_surrogates")
def pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.replaced(table(spark, folder, "documents").select("doc_id", "text"))


@query("op7_quality_votes")
def quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.scored(docs, model).select("doc_id", "held_out", "score", "predicted")


@query("op8_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dups.near_vectors(table(spark, folder, "embeddings"))


@query("op5_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    languages, logs = langid.fit(table(spark, folder, "documents"))
    return langid.identify(table(spark, folder, "pages"), languages, logs)


FILL_SQL = """
with units as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units,
         sha256('1:' || coalesce(doc_id :: varchar, '')) as digest
  from documents),
drawn as (
  select *, len(units) :: bigint as n, list_transform([1, 9, 17, 25], lambda i: ('0x' || digest[i : i + 7]) :: bigint) as h from units),
cut as (
  select *, least(h[1] % (n + 1), h[2] % (n + 1)) as one, greatest(h[1] % (n + 1), h[2] % (n + 1)) as two,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 90
              then 'plain' when h[4] % 100 < 20 then 'spm' else 'psm' end as form
  from drawn),
parts as (
  select *, coalesce(list_aggregate(units[1 : one], 'string_agg', ''), '') as prefix,
         coalesce(list_aggregate(units[one + 1 : two], 'string_agg', ''), '') as middle,
         coalesce(list_aggregate(units[two + 1 :], 'string_agg', ''), '') as suffix
  from cut)
select doc_id, n, form,
       case when form <> 'plain' then length(prefix) :: bigint end as prefix_chars,
       case when form <> 'plain' then length(middle) :: bigint end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""


@query("op12_fill_middle", FILL_SQL)
def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    docs = fill_middle.transformed(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("op13_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.pieces(docs, LISTED, PATTERN).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.packed(pieces, order=("doc_id", "piece", "ids_crc32"))


@query("op11_conversation_repair")
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found, after = repair.repaired(repair.damaged(rows))
    digests = repair.digests(after, F.concat("role", F.lit(":"), "text"))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    out = every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(digests, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    return out.select(
        F.col("id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
