"""Token counts through a digest cache.

The cache is a table (content, tokenizer, n_tokens): SHA-256 of the normalised text and of the tokenizer's
file. Normalised is: null as empty and, for a tokenizer that itself takes runs of spaces as one and none at
the ends, runs of spaces as one and none at the ends; nothing else, as it could change the count. A call joins its documents' digests to the stored counts, encodes one
document of each digest that is missing and appends those counts; the answer is then a join. A new
version of a tokenizer has another digest, so its counts never mix with older ones.

Defined results: null text counts as empty; repeated texts share one count; a null id keeps its row;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.shared import Workspace, keep_ids
from orrery.llm.wordhash import buffers, pieces

_MODELS: dict = {}


def _counter(path: str):
    """texts -> counts, by the library for the file: sentencepiece for .model, tokenizers for .json."""
    if path not in _MODELS:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _MODELS[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            _MODELS[path] = lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]
    return _MODELS[path]


def spaces_are_one(path: str) -> bool:
    """Whether the tokenizer gives the same for a text with more spaces between and around words."""
    if not path.endswith(".model"):
        return False
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    apart = "".join(f" {w}  " for w in ("one", "two", "\u00e9", "3.", "\n", "\t x", "<s>", "\u2581"))
    return model.encode(apart) == model.encode(re.sub(" +", " ", apart).strip(" "))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, F.lit(" +"), F.lit(" ")))


def _count(path: str):
    def run(batches):
        count = _counter(path)
        for batch in batches:
            _, at = buffers(batch.column(1))
            for lo, hi in pieces(at, 500_000):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(count(part.column(1).to_pylist()), pa.int64())], names=["content", "n_tokens"])

    return run


class CountCache:
    """Stored counts at ``path``, a folder that all executors and later calls can read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def stored(self, tokenizer: str) -> DataFrame:
        kind = "content binary, tokenizer string, n_tokens long"
        store = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not store.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(store):
            return self.spark.createDataFrame([], kind).select("content", "n_tokens")
        rows = self.spark.read.schema(kind).parquet(self.path).where(F.col("tokenizer") == tokenizer)
        return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))  # calls side by side may both have added one

    def count(self, docs: DataFrame, tokenizer_path: str) -> DataFrame:
        """(doc_id, n_bytes, n_tokens) of every row; misses are encoded and appended first."""
        ws = Workspace(self.spark, "counted")
        version = hashlib.sha256(Path(tokenizer_path).read_bytes()).hexdigest()
        text, plain = F.coalesce(F.col("text").cast("string"), F.lit("")), spaces_are_one(tokenizer_path)
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))

        def digested(df: DataFrame) -> DataFrame:
            return df.withColumn("content", F.unhex(F.sha2(normalised(F.col("text")) if plain else F.col("text"), 256)))

        asked = ws.save(digested(docs).select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")), "asked")
        first = asked.groupBy("content").agg(F.min("doc_id").alias("doc_id")).join(self.stored(version).select("content"), "content", "left_anti")
        first = ws.save(first, "first")
        texts = digested(keep_ids(docs, first.where("doc_id is not null").select("doc_id"), "doc_id"))
        nameless = first.where("doc_id is null").select("content")
        if nameless.limit(1).count():
            texts = texts.unionByName(digested(docs.where("doc_id is null")).join(nameless, "content", "left_semi").dropDuplicates(["content"]).select(*texts.columns))
        fresh = texts.select("content", "text").mapInArrow(_count(tokenizer_path), "content binary, n_tokens long")
        fresh.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(self.path)
        # Both sides are plain tables, so a content that a third of the rows have is split between tasks.
        known = ws.save(self.stored(version), "known")
        return asked.join(known, "content").select("doc_id", "n_bytes", "n_tokens")
