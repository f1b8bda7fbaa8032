"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import archive, chat, collocations, decontamination, exact, mixing, pages, repeats, simhash, tokens, toxicity, urls, whitening

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
TARGETS = {"high": 0.95, "low": 0.05}
TOKENIZER = "byte_bpe_50k.json"
SAY = "<|im_end|><|im_start|>assistant ok"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op5_chat_examples", sql=rf"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{SAY}' union all select -1, 1, 'assistant', '{SAY}'),
sized as (
  select *, 32 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) as size from said),
placed as (
  select *, sum(size) over o as upto, row_number() over o as place, count(*) over (partition by conv_id) as turns
  from sized window o as (partition by conv_id order by turn nulls first, role, text rows unbounded preceding))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by place), '')) as loss_sha256,
  sum(case when role = 'assistant' or place = turns then upto end)::bigint as formatted_chars
from placed group by conv_id""")
def op5_chat_examples(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(SAY).alias("text"))
    return chat.read_back(chat.examples(turns.unionByName(extra))).withColumnRenamed("conv", "conv_id")


@query("op6_mixing")
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.mix(table(spark, folder, "documents"), domains(spark, folder), TARGETS, keep=("source",))
    return out.select(F.col("doc").alias("doc_id"), "source", "n_tokens", *[F.get("posteriors", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(TARGETS)], "rate", "copies")


def domains(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled table's domains: documents of high and of low quality."""
    return table(spark, folder, "labels").select("doc_id", F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low").alias("domain"))


@query("op7_exact_dedup", sql=r"""
with squeezed as (
  select doc_id, length(coalesce(text, '')) as chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
grouped as (
  select *, first_value(doc_id) over (partition by text_sha256 order by chars desc, doc_id) as keep_id, count(*) over (partition by text_sha256) as group_size from squeezed)
select doc_id, keep_id, group_size::bigint as group_size, doc_id = keep_id as kept, text_sha256 from grouped""")
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = exact.exact_duplicates(table(spark, folder, "documents"), hash_all=True)
    return out.select(F.col("doc").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op9_repeats")
def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    out = repeats.without_repeats(table(spark, folder, "documents"))
    return out.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_url_rules", sql="""
with parts as (
  select page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') as path from pages),
rules(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best as (
  select page_id, max_by(h || p, length(h || p)) as rule, max_by(v, length(h || p)) as v from parts join rules
  on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id)
select parts.page_id, host, path, rule, coalesce(v, 'allow') as verdict from parts left join best on parts.page_id = best.page_id""")
def op10_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    out = urls.judged(table(spark, folder, "pages"), RULES)
    return out.select(F.col("page").alias("page_id"), "host", "path", "rule", "verdict")


@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select(F.col("doc").alias("doc_id"), "contaminated", "n_items", "overlap", F.array_join("items", ",").alias("items"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.withColumnRenamed("doc", "doc_id")


@query("op3_main_text")
def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages")).withColumnRenamed("page", "page_id")


@query("op4_simhash")
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, radius=2)
    return out.select(F.col("doc").alias("doc_id"), simhash.as_hex("fingerprint").alias("fingerprint"), F.col("component").alias("component_id"))


@query("op8_token_files")
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encoded(table(spark, folder, "documents"), tokenizer_path()).withColumnRenamed("doc", "doc_id")


@query("op11_web_archive", sql="""
with paid as (select page_id, coalesce(html, '') as html from pages),
kept as (select html, max(page_id) as keep from paid where strlen(html) >= 1000 group by html)
select page_id, strlen(paid.html)::bigint as payload_bytes, sha1(paid.html) as payload_digest,
  case when keep is distinct from page_id and keep is not null then 'revisit' else 'response' end as record_type,
  case when keep is distinct from page_id then keep end as refers_to
from paid left join kept on paid.html = kept.html""")
def op11_web_archive(spark: SparkSession, folder: str) -> DataFrame:
    out = archive.archived(table(spark, folder, "pages"))
    return out.select(F.col("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


@query("op12_whitening")
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings")).withColumnRenamed("vec", "vec_id")


@query("op13_collocations")
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed public tokenizers have a file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
