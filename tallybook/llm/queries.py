"""The opN queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import (
    chat,
    decontaminate,
    exact_dedup,
    html_main,
    langid,
    merkle,
    near_dup,
    oracles,
    packing,
    part_codes,
    pii,
    quality,
    sharding,
    vector_links,
)
from tallybook.llm.common import bucket_of_id, table, text_or_empty


def tokenizer_file() -> str:
    """Place of the public vocabulary the packer counts tokens with."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model, limit=0.7)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it (no row: a clean document)."""
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"),
                                            table(spark, sf_dir, "benchmark"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign_shards(table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def conversation_log(rows: DataFrame) -> DataFrame:
    """Stand-in event log of finished conversation rows: each row becomes the stream that led to it,
    sent in two deltas, a third of them after a discarded draft, a third as an edit."""
    text = text_or_empty("text")
    half = F.floor(F.length(text) / 2).cast("int")
    one = F.substr(text, F.lit(1), half)
    two = F.substr(text, half + 1)

    def ev(k: int, kind: str, role, t) -> F.Column:
        return F.struct((F.coalesce(F.col("turn").cast("long"), F.lit(0)) * 8 + k).alias("seq"),
                        F.lit(kind).alias("kind"), role.cast("string").alias("role"), t.alias("text"))
    role, none, empty = F.col("role"), F.lit(None).cast("string"), F.lit("")
    opened = ev(0, "open", role, empty)
    events = (F.when(F.col("way") == 0, F.array(opened, ev(1, "delta", none, one),
                                                ev(2, "delta", none, two)))
              .when(F.col("way") == 1, F.array(opened, ev(1, "delta", none, F.reverse(text)),
                                               ev(2, "regenerate", none, empty),
                                               ev(3, "delta", none, one), ev(4, "delta", none, two)))
              .otherwise(F.array(opened, ev(1, "delta", none, two), ev(2, "edit", none, text))))
    return (rows.withColumn("msg", F.monotonically_increasing_id())
            .withColumn("way", F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)))
            .select("conv_id", "turn", "msg", F.explode(events).alias("e"))
            .select("conv_id", "turn", "msg", "e.*"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    back = chat.read_back(chat.format_chats(conversation_log(rows.unionByName(extra))))
    said_all = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said_all, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = langid.train(docs.filter(~langid.held_out()).select("doc_id", "text", "lang"))
    return langid.identify(docs, models)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_pages(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, limit=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, checked against documents of which every seventh has one character more."""
    tampered = F.coalesce(bucket_of_id("doc_id", 7) == 0, F.lit(False))
    shown = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.manifest(table(spark, sf_dir, "documents"), shown)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = part_codes.compress(table(spark, sf_dir, "embeddings"))
    return part_codes.with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(part_codes.books_digest(books)).alias("codebooks_sha256"))


def op13_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.near_vectors(table(spark, sf_dir, "embeddings"), limit=0.9)


OP3_SQL = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') as t from documents),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from d group by t)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256
from d join g on d.t = g.t
"""

OP5_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, replace(replace(replace(text, '\', '\b'), '### ', '\h'), '</turn>', '\t') as body,
         replace(replace(replace(replace(role, '\', '\b'), '### ', '\h'), '</turn>', '\t'),
                 ': ', '\c') as head
  from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), ''))
         as loss_sha256,
       cast(sum(length(head) + length(body) + 14) as bigint) as formatted_chars
from e group by conv_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_decontaminate": op2_decontaminate,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_sharding": op4_sharding,
    "op5_chat_format": op5_chat_format,
    "op6_pii": op6_pii,
    "op7_language": op7_language,
    "op8_html_text": op8_html_text,
    "op9_packing": op9_packing,
    "op10_near_dup": op10_near_dup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_vector_codes": op12_vector_codes,
    "op13_embedding_near_dup": op13_embedding_near_dup,
}

#: DuckDB SQL where SQL can express the operator's result.
ORACLES: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op5_chat_format": OP5_SQL,
    "op11_merkle_manifest": oracles.merkle_sql(),
    "op12_vector_codes": oracles.part_codes_sql(),
    "op13_embedding_near_dup": oracles.VECTOR_LINKS_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
