"""The registered queries of this subpackage, each over its whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import automata, chat, classify, decontaminate, importance, media, mixing, personal, secret_scan, simhash, suffix_sort, turns
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_sort.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.store(table(spark, sf_dir, "documents"))).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classify.fit_quality(docs, table(spark, sf_dir, "labels"))
    return classify.score_quality(docs, model).select("doc_id", classify.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classify.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return classify.score_toxicity(docs, model).select("doc_id", classify.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.components(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automata.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op9_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"))), ",")
    return out.select("conv_id", "speaker", "part", "start", "text", spans.alias("mask"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.scan(table(spark, sf_dir, "documents")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(table(spark, sf_dir, "conversations"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {q.__name__: q for q in (op1_decontamination, op2_suffix_dedup, op3_media_columns, op4_quality_classifier, op5_toxicity, op6_simhash, op7_substring_dedup, op8_secret_scan, op9_chat_rotation, op10_mixing, op11_personal_data, op12_conversation_repair, op13_importance_resampling)}
SQL: dict[str, str] = {
    "op9_chat_rotation": """
with t as (
  select conv_id, turn, coalesce(turn, 9223372036854775807) as ord, cast(floor(turn / 64.0) as bigint) as part,
    replace(coalesce(role, 'unknown'), '<|', '< |') as who, replace(coalesce(text, ''), '<|', '< |') as body
  from conversations),
p as (select distinct conv_id, who as speaker from t where who <> 'system'),
s as (
  select t.conv_id, p.speaker, t.part, t.ord, t.who, t.body, t.who = p.speaker as mine,
    '<|im_start|>' || case when t.who = p.speaker then 'assistant' when t.who = 'system' then 'system' else 'user name=' || t.who end || chr(10) as head
  from t join p on t.conv_id is not distinct from p.conv_id),
w as (
  select *, coalesce(sum(length(head) + length(body) + 11) over (partition by conv_id, speaker, part order by ord, who, body rows between unbounded preceding and 1 preceding), 0) as off
  from s),
g as (
  select conv_id, speaker, part, string_agg(head || body || '<|im_end|>' || chr(10), '' order by off) as text,
    coalesce(string_agg((off + length(head))::bigint || '-' || (off + length(head) + length(body) + 10)::bigint, ',' order by off) filter (where mine), '') as mask
  from w group by all)
select conv_id, speaker, part,
  cast(coalesce(sum(length(text)) over (partition by conv_id, speaker order by part nulls last rows between unbounded preceding and 1 preceding), 0) as bigint) as start, text, mask
from g
""",
}
