"""Queries of this subpackage's operators and their SQL twins, as the entry file registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.ngram_join import ngram_jaccard_components

    return ngram_jaccard_components(_table(spark, sf_dir, "documents"), words=4, num=85, den=100)


QUERIES["op1_ngram_jaccard_join"] = op1_ngram_jaccard_join


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from orrery.llm.substring_dedup import remove_spans, repeated_spans

    docs = _table(spark, sf_dir, "documents")
    kept = remove_spans(docs, repeated_spans(docs, n=50))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES["op2_substring_dedup"] = op2_substring_dedup


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from orrery.llm.chat_format import format_conversations, read_back

    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok").alias("text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said)
    back = read_back(format_conversations(rows.unionByName(extra)))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "state",
        "valid",
    )


QUERIES["op3_chat_format"] = op3_chat_format
ORACLES["op3_chat_format"] = r"""
with rows as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s as (select *, lag(role, 1, 'start') over w as before, row_number() over w as place from rows window w as (partition by conv_id order by turn, role, text)),
t as (
  select *, replace(replace(replace(text, '\', '\0'), '###', '\1'), '</turn>', '\2') as safe,
    coalesce(before || '>' || role in ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'), false) as allowed from s)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
  cast(sum(4 + length(role) + 2 + length(safe) + 8) as bigint) as formatted_chars,
  case when bool_and(allowed) then arg_max(role, place) else 'reject' end as state, bool_and(allowed) and arg_max(role, place) = 'assistant' as valid
from t group by conv_id
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.quality_rules import judge_quality

    return judge_quality(_table(spark, sf_dir, "documents"))


QUERIES["op4_quality_rules"] = op4_quality_rules


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from orrery.llm.language_id import fit_language_model, predict_language

    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = fit_language_model(docs.where(~held_out).select("doc_id", "text", "lang"), most_rows=6000)
    return predict_language(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES["op5_language_id"] = op5_language_id


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    from orrery.llm.shared import Workspace
    from orrery.llm.token_counts import CountCache

    cache = CountCache(spark, Workspace(spark, "counts").path("cache"))
    counts = cache.count(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


QUERIES["op7_token_counts"] = op7_token_counts


def op8_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from orrery.llm.token_binary import read_token_files, token_files

    root, files = token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_token_files(files, root)


QUERIES["op8_token_binary"] = op8_token_binary


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.warc import read_archives, write_archives

    return read_archives(*write_archives(_table(spark, sf_dir, "pages")))


QUERIES["op10_warc"] = op10_warc
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((v >> {s}) & 31 as integer) + 1, 1)" for s in (15, 10, 5, 0))
ORACLES["op10_warc"] = f"""
with p as (select page_id, coalesce(html, '') as html from pages where page_id is not null),
d as (select page_id, strlen(html) as payload_bytes, sha1(html) as h, min(page_id) over (partition by html) as first from p),
v as (select page_id, i, cast('0x' || substr(h, 5 * i + 1, 5) as bigint) as v from (select page_id, h, unnest(range(8)) as i from d)),
b as (select page_id, string_agg({_BASE32}, '' order by i) as payload_digest from v group by page_id)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to
from d join b using (page_id)
"""


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from orrery.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1, length=2048)


QUERIES["op6_packing"] = op6_packing


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orrery.llm.decontamination import benchmark_matches

    return benchmark_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES["op9_benchmark_decontamination"] = op9_benchmark_decontamination
