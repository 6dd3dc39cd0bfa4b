"""The training-data pipeline: quality, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result to the
shared folder and reads it again as the next one's documents. All but the last return the columns of
documents. Rows with a null doc_id leave in the first stage: no decision can name them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.decontamination import benchmark_matches
from orrery.llm.ngram_join import ngram_jaccard_components
from orrery.llm.packing import pack_documents
from orrery.llm.quality_rules import judge_quality
from orrery.llm.shared import Workspace, keep_ids
from orrery.llm.substring_dedup import remove_spans, repeated_spans


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_ids(docs, judge_quality(docs).where("kept").select("doc_id"), "doc_id")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of documents linked by 0.8 of their five-word shingles."""
    groups = ngram_jaccard_components(docs, words=5, num=80, den=100)
    return keep_ids(docs, groups.where("doc_id <> component_id").select("doc_id"), "doc_id", "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word windows that a smaller id has; those of which nothing is left go; rows that repeat an id stay rows."""
    spans = repeated_spans(docs, n=50)
    cut = remove_spans(keep_ids(docs, spans.select("doc_id"), "doc_id"), spans, carry=True).where("n_removed = 0 or n_removed < n_words")
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("carried.text")), "n_chars": F.when(changed, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("carried.n_chars"))}
    cut = cut.select(*[new.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])
    return keep_ids(docs, spans.select("doc_id"), "doc_id", "left_anti").unionByName(cut)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ws = Workspace(spark, "leaks")
    found = ws.save(benchmark_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "matches")
    return keep_ids(docs, found.select("doc_id").distinct(), "doc_id", "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row a piece."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, length=2048)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("packing", packing),
]

#: The retrieval and packing stages have no SQL form; a test compares near duplicates and
#: cut passages with brute force, leaks where a whole item or no item is held; quality and packing by their own tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = ws.save(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            ws.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
