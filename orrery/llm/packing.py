"""Sequence packing as a cutting-stock problem, solved by column generation.

A document's ids (and its end id) are cut at multiples of the sequence length; the rest lengths are
counted in classes of ``unit`` tokens, so the linear program has at most length/unit rows whatever the
number of documents. Columns are patterns (how many pieces of each class fill a sequence): the program
over the known patterns gives prices, a knapsack by dynamic programming finds the pattern of best price,
until none beats 1. Counts of patterns are rounded down, what is left over is packed first fit decreasing,
and each pattern's slots are given to the pieces by their rank in their class. Ranks come from counts by
(class, bucket of ids), so no class has to be sorted in one task.

Defined results: null text is empty and gives its end id alone; rows with a null id are left out; rows
that repeat an id are packed each; no rows give no sequences; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.bpe import PieceEncoder
from orrery.llm.shared import BROADCAST_ROWS, Workspace, task_count
from orrery.llm.wordhash import buffers, pieces


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of highest price: an unbounded knapsack over the sizes."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        fit = sizes <= w
        value = np.where(fit, prices + best[np.where(fit, w - sizes, 0)], -1.0)
        k = int(value.argmax())
        best[w], pick[w] = (value[k], k) if value[k] > best[w - 1] + 1e-12 else (best[w - 1], -1)
    pattern, w = np.zeros(len(sizes), np.int64), capacity
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            pattern[pick[w]] += 1
            w -= int(sizes[pick[w]])
    return float(best[capacity]), pattern


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-4, most_rounds: int = 3000) -> tuple[np.ndarray, np.ndarray, float]:
    """(patterns, counts, bound): the final basis of the linear program and its value."""
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(np.float64)
    inverse = np.diag(1.0 / np.diag(basis))
    amount = inverse @ demand
    for k in range(most_rounds):
        value, pattern = best_pattern(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + gap:  # the program over all patterns is at least this one over value
            break
        step = inverse @ pattern
        up = step > 1e-10
        ratio = np.where(up, amount / np.where(up, step, 1.0), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        if k % 100 == 99:  # one Newton step against drift
            inverse += np.einsum("ij,jk->ik", inverse, np.eye(m) - np.einsum("ij,jk->ik", basis, inverse))
        amount = np.maximum(inverse @ demand, 0.0)
    return basis.T.round().astype(np.int64).reshape(m, m), amount, float(amount.sum())


def first_fit_decreasing(items: list[int], capacity: int) -> list[list[int]]:
    """Indices of items by bin."""
    room: list[int] = []
    bins: list[list[int]] = []
    for k in sorted(range(len(items)), key=lambda k: (-items[k], k)):
        at = next((b for b, r in enumerate(room) if r >= items[k]), None)
        if at is None:
            room.append(capacity)
            bins.append([])
            at = len(room) - 1
        room[at] -= items[k]
        bins[at].append(k)
    return bins


def plan_sequences(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int, float]:
    """(rows (size, first rank, after last rank, slots, first sequence), sequences, linear bound) for counts by size."""
    sizes = np.array(sorted(s for s, n in counts.items() if n), np.int64)
    demand = np.array([counts[s] for s in sizes.tolist()], np.float64)
    if not len(sizes):
        return [], 0, 0.0
    patterns, amount, bound = cutting_stock(sizes, demand, capacity)
    used = np.zeros(len(sizes), np.int64)
    rows, made = [], 0

    def lay(slots: np.ndarray, copies: int) -> None:
        nonlocal made
        for c in np.flatnonzero(slots):
            n = int(slots[c]) * copies
            rows.append((int(sizes[c]), int(used[c]), int(used[c]) + n, int(slots[c]), made))
            used[c] += n
        made += copies

    for pattern, x in zip(patterns, amount):
        copies = int(np.floor(x + 1e-9))
        over = np.where(pattern > 0, (demand.astype(np.int64) - used) // np.maximum(pattern, 1), copies)
        copies = max(0, min(copies, int(over.min())))
        if copies:
            lay(pattern, copies)
    left = [c for c in range(len(sizes)) for _ in range(int(demand[c]) - int(used[c]))]
    for group in first_fit_decreasing([int(sizes[c]) for c in left], capacity):
        lay(np.bincount([left[k] for k in group], minlength=len(sizes)), 1)
    return rows, made, bound


def _cut(tokenizer_path: str, end_id: int, length: int):
    def run(batches):
        encoder = PieceEncoder.of(tokenizer_path)
        for batch in batches:
            _, at = buffers(batch.column(1))
            ids = batch.column(0).to_pylist()
            for lo, hi in pieces(at, 1_000_000):
                rows = []
                for doc, found in zip(ids[lo:hi], encoder.encode(batch.column(1).slice(lo, hi - lo).to_pylist())):
                    whole = np.append(found, np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(whole), length):
                        part = whole[start : start + length]
                        rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(whole)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048, unit: int = 8) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    ws = Workspace(spark, "packing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
    cut = docs.mapInArrow(_cut(tokenizer_path, end_id, length), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    cut = cut.withColumn("size", F.expr(f"int((length + {unit - 1}) div {unit})"))
    cut = ws.save(cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(task_count(spark))).cast("int")), "pieces")
    groups = ws.save(cut.groupBy("size", "bucket").agg(F.count("*").alias("n")), "groups")
    counts = {r["size"]: r["n"] for r in groups.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # at most length / unit rows
    rows, _, _ = plan_sequences(counts, length // unit)
    plan = spark.createDataFrame(rows or [(0, 0, 0, 1, 0)], "size int, first long, after long, slots long, base long")
    ahead = groups.withColumn("ahead", F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    order = Window.partitionBy("size", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = cut.withColumn("place", F.row_number().over(order) - 1).join(F.broadcast(ahead) if (length // unit) * task_count(spark) <= BROADCAST_ROWS else ahead, ["size", "bucket"])
    ranked = ranked.withColumn("rank", F.col("place") + F.col("ahead")).drop("place", "ahead", "bucket")
    p = F.broadcast(plan.withColumnRenamed("size", "plan_size"))  # patterns are bounded by the classes and what rounding leaves
    laid = ranked.join(p, (F.col("size") == F.col("plan_size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("after")))
    laid = laid.withColumn("sequence_id", F.expr("base + (rank - first) div slots"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank").rowsBetween(Window.unboundedPreceding, 0)
    laid = laid.withColumn("offset", F.sum("length").over(inside) - F.col("length"))
    return laid.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
