"""Substring dedup over a log-structured fingerprint index.

Identity is a window of n consecutive words. Windows aren't stored: of each window one g-word gram,
the least hash among those inside, is its anchor, so equal windows have equal anchors and about one
word in (n - g) / 2 becomes an index row (fp, doc_id). An ingest

1. writes the batch's anchors as an immutable run sorted by fp,
2. merge-joins it with every historical run (distinct fps only, so a hot fp makes no pairs) and finds
   the anchors that history, or another document of the batch, holds as well,
3. verifies: documents with such anchors, new and historical, give BLAKE2b-128 of the words themselves of
   whole windows around them, and a window of the batch is repeated if a smaller id has it too,
4. compacts the runs into one when there are more than ``max_runs``.

Batches come in ascending ranges of ids, so the decisions are those over all documents at once;
decisions about earlier batches are never revised. Exact copies never reach the index: the smallest
id of equal word sequences stands for them, its copies repeat it from their first word to their last.

Defined results: null, empty or blank text has no words and no spans, nor has a text under n words;
rows with a null id are left out; rows that repeat an id are one document, that of the fewest words (ties by
digest): rows of its id with other words lend and lose nothing; remove_spans carries the row if asked to, other
columns are ignored elsewhere, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.shared import BROADCAST_ROWS, Workspace, few, keep_ids, task_count
from orrery.llm.wordhash import U, Words, buffers, chunks, forget, mix, pieces

SPANS = "array<struct<start:int,end:int>>"


def words_digest(words: list[bytes]) -> str:
    return hashlib.blake2b(b" ".join(words), digest_size=16).hexdigest()


def _profile(batches):
    for batch in batches:
        forget()
        counts, sums = [], []
        for k in range(batch.num_rows):  # the words of one text at a time
            words = (batch.column(1)[k].as_py() or "").encode().split()
            counts.append(len(words))
            sums.append(words_digest(words))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.string())], names=["doc_id", "n_words", "content"])


def _chosen(batches):
    """Rows (doc_id, text, content) whose words have that digest."""
    for batch in batches:
        hit = [words_digest((t.as_py() or "").encode().split()) == c for t, c in zip(batch.column(1), batch.column(2).to_pylist())]
        yield batch.filter(pa.array(hit, pa.bool_())).select(["doc_id", "text"])


def window_digests(words: Words, row: int, places: np.ndarray, n: int) -> np.ndarray:
    """(places, 2) 64-bit halves of BLAKE2b-128 of the n words from each place of a row on, joined by one space."""
    own = slice(words.of[row], words.of[row + 1])
    size = words.end[own] - words.start[own]
    text = b" ".join(bytes(words.data[words.at[row] : words.at[row + 1]]).split())
    at = np.concatenate(([0], np.cumsum(size + 1)))
    found = b"".join([hashlib.blake2b(text[lo:hi], digest_size=16).digest() for lo, hi in zip(at[places].tolist(), (at[places + n] - 1).tolist())])
    return np.frombuffer(found, "<i8").reshape(-1, 2)


def window_anchors(words: Words, n: int, g: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchor fp of each n-word window (the least hash of a g-word gram in it), the windows' place in their row, and row bounds."""
    grams, _, gram_bounds = words.spans(g)
    wide = n - g + 1
    made = np.maximum(words.counts - n + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(made)])
    inside = np.arange(bounds[-1]) - np.repeat(bounds[:-1], made)
    if not bounds[-1]:
        return np.zeros(0, U), inside, bounds
    step = 1
    while step * 2 <= wide:
        grams[: len(grams) - step] = np.minimum(grams[: len(grams) - step], grams[step:])
        step *= 2
    at = inside + np.repeat(gram_bounds[:-1], made)
    return np.minimum(grams[at], grams[at + wide - step]), inside, bounds


def _anchors(n: int, g: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, words in chunks(batch, False):
                fps, _, bounds = window_anchors(words, n, g)
                own = [np.unique(fps[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view(np.int64)), pa.array(np.repeat(ids[lo:hi], [len(x) for x in own]))], names=["fp", "doc_id"])

    return run


def progressions(window: np.ndarray, check: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first row, step, times) of runs of equally spaced places of one window in one document; rows sorted by all four."""
    m = len(window)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    gap = np.diff(at, prepend=at[:1])
    head = np.concatenate(([True], (window[1:] != window[:-1]) | (check[1:] != check[:-1]) | (doc[1:] != doc[:-1])))
    cut = head.copy()
    cut[1:] |= ~head[:-1] & (gap[1:] != gap[:-1])
    begin = np.flatnonzero(cut)
    times = np.diff(np.append(begin, m))
    step = np.where(times > 1, gap[np.minimum(begin + 1, m - 1)], 1)
    return begin, step.astype(np.int32), times.astype(np.int32)


def _windows(n: int, g: int):
    """Rows (window, check, doc_id, at, step, times, known) of windows whose anchor is one of the row's ``fps``.

    A row stands for ``times`` places of the window in its document, ``step`` words apart from ``at`` on,
    so a line that one document repeats makes a few rows however often it does. Of a window that several
    documents of an Arrow batch hold, the smallest document's rows are given; for the others come rows
    with ``known``: ``times`` neighbouring windows from ``at`` on that are repeated whatever the window.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = batch.column(2)
            wanted, first = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            got: list[list[np.ndarray]] = [[], [], [], []]
            for lo, hi, words in chunks(batch, False):
                fps, inside, bounds = window_anchors(words, n, g)
                for i in range(lo, hi):
                    a, b = bounds[i - lo], bounds[i - lo + 1]
                    pick = a + np.flatnonzero(np.isin(fps[a:b], wanted[first[i] : first[i + 1]]))
                    digest = window_digests(words, i - lo, inside[pick], n)
                    got[0].append(digest[:, 0])
                    got[1].append(digest[:, 1])
                    got[2].append(np.full(len(pick), ids[i]))
                    got[3].append(inside[pick].astype(np.int32))
                del words, fps, inside
            window, check, doc, at = (np.concatenate(x) for x in got)
            del got
            if not len(window):
                continue
            order = np.lexsort((at, doc, check, window))
            window, check, doc, at = window[order], check[order], doc[order], at[order]
            head = np.concatenate(([True], (window[1:] != window[:-1]) | (check[1:] != check[:-1])))
            least = doc[head][np.cumsum(head) - 1]
            known = doc > least
            # repeated windows of this batch as runs of neighbours
            d, p = doc[known], at[known]
            order = np.lexsort((p, d))
            d, p = d[order], p[order]
            cut = np.concatenate(([True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1))) if len(d) else np.zeros(0, bool)
            length = np.diff(np.concatenate((np.flatnonzero(cut), [len(d)]))).astype(np.int32) if len(d) else np.zeros(0, np.int32)
            d, p = d[cut], p[cut]
            window, check, doc, at = window[~known], check[~known], doc[~known], at[~known]
            begin, step, times = progressions(window, check, doc, at)
            window, check, doc, at = window[begin], check[begin], doc[begin], at[begin]
            spread = mix(d.view(U) * U(31) + p.astype(U))
            out = [
                pa.array(np.concatenate((window, spread.view(np.int64)))),
                pa.array(np.concatenate((check, np.zeros(len(d), np.int64)))),
                pa.array(np.concatenate((doc, d))),
                pa.array(np.concatenate((at, p)).astype(np.int32)),
                pa.array(np.concatenate((step, np.ones(len(d), np.int32)))),
                pa.array(np.concatenate((times, length))),
                pa.array(np.arange(len(window) + len(d)) >= len(window)),
            ]
            for k in range(0, len(out[0]), 100_000):
                yield pa.RecordBatch.from_arrays([x.slice(k, 100_000) for x in out], names=["window", "check", "doc_id", "at", "step", "times", "known"])

    return run


class FingerprintIndex:
    """Sorted immutable runs of anchors in the shared folder, and the texts they came from."""

    def __init__(self, spark: SparkSession, ws: Workspace, n: int = 50, g: int = 16, max_runs: int = 4):
        self.spark, self.ws, self.n, self.g, self.max_runs = spark, ws, n, min(g, n), max_runs
        self.runs: list[tuple[str, DataFrame]] = []
        self.made = 0

    def _write_run(self, anchors: DataFrame) -> None:
        name = f"run-{self.made}"
        self.made += 1
        spread = anchors.repartition(task_count(self.spark), "fp", "doc_id")  # an fp of many documents lies in many sorted files
        self.runs.append((name, self.ws.save(spread.sortWithinPartitions("fp", "doc_id"), name)))

    def ingest(self, batch: DataFrame, history: DataFrame | None = None, low: int | None = None) -> DataFrame:
        """(doc_id, found) of the batch's repeated windows, found as places (at, step, times).

        history: documents of earlier batches, all ids smaller; low: an id above theirs and not above the batch's.
        """
        anchors = batch.mapInArrow(_anchors(self.n, self.g), "fp long, doc_id long")
        past = [frame for _, frame in self.runs]
        self._write_run(anchors)
        name, run = self.runs[-1]
        shared = run.groupBy("fp").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        hits = shared.where("a <> b").select("fp")
        for old in past:
            hits = hits.union(shared.select("fp").join(old.select("fp").hint("merge"), "fp", "left_semi"))
        hits = self.ws.save(hits.distinct(), f"hits-{self.made}")
        rows = run
        for old in past:
            rows = rows.unionByName(old)
        wanted = self.ws.save(rows.join(hits, "fp", "left_semi").groupBy("doc_id").agg(F.collect_list("fp").alias("fps")), f"wanted-{self.made}")
        texts = batch.withColumn("fresh", F.lit(True)) if history is None else batch.withColumn("fresh", F.lit(True)).unionByName(history.withColumn("fresh", F.lit(False)))
        texts = keep_ids(texts, wanted.select("doc_id"), "doc_id").join(wanted, "doc_id").select("doc_id", "text", "fps")
        windows = texts.mapInArrow(_windows(self.n, self.g), "window long, check long, doc_id long, at int, step int, times int, known boolean")
        windows = windows.withColumn("least", F.min("doc_id").over(Window.partitionBy("window", "check")))
        found = windows.where("known or least < doc_id").select("doc_id", "at", "step", "times")
        if past:
            found = found.where(F.col("doc_id") >= low) if low is not None else found.join(run.select("doc_id").distinct(), "doc_id", "left_semi")
        found = self.ws.save(found.groupBy("doc_id").agg(F.collect_list(F.struct("at", "step", "times")).alias("found")), f"found-{self.made}")
        self.ws.drop(f"hits-{self.made}", f"wanted-{self.made}")
        if len(self.runs) > self.max_runs:
            self.compact()
        return found

    def compact(self) -> None:
        """Merges all runs into one sorted run and drops them."""
        old, self.runs = self.runs, []
        merged = old[0][1]
        for _, frame in old[1:]:
            merged = merged.unionByName(frame)
        self._write_run(merged)
        self.ws.drop(*(name for name, _ in old))


def merged_spans(row: np.ndarray, at: np.ndarray, step: np.ndarray, times: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the words that n-word windows at ``times`` places ``step`` apart cover, merged where they meet, sorted."""
    apart = step > n  # else there is no gap between a run's windows
    each = np.where(apart, times, 1)
    of = np.repeat(np.arange(len(at)), each)
    k = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
    lo = at[of] + k * step[of]
    hi = lo + np.where(apart, 0, (times - 1) * step)[of] + n
    row = row[of]
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    if not len(lo):
        return row, lo, hi
    wide = int(hi.max()) + 1  # rows end to end, so that one running maximum serves all
    reach = np.maximum.accumulate(hi + row * wide)
    cut = np.concatenate(([True], lo[1:] + row[1:] * wide > reach[:-1]))
    last = np.append(np.flatnonzero(cut)[1:], len(lo)) - 1
    return row[cut], lo[cut], reach[last] - row[last] * wide


def _spans(n: int):
    """Word spans covered by repeated windows: sorted, apart."""

    def run(batches):
        for batch in batches:
            forget()
            lists = batch.column(1)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            at, step, times = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.flatten().flatten())
            row, lo, hi = merged_spans(row, at, step, times, n)
            bounds = np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32)
            spans = pa.StructArray.from_arrays([pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["start", "end"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(bounds), spans)], names=["doc_id", "spans"])

    return run


def repeated_spans(docs: DataFrame, n: int = 50, g: int = 16, batches: int = 2, max_runs: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans, content) of the documents that repeat windows of smaller ids; spans [start, end) count words, content is their digest."""
    spark = docs.sparkSession
    ws = Workspace(spark, "substring")
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where("doc_id is not null")
    members = docs.mapInArrow(_profile, "doc_id long, n_words long, content string")
    members = members.groupBy("doc_id").agg(F.min(F.struct("n_words", "content")).alias("s"), F.count("*").alias("times"))
    members = ws.save(members.select("doc_id", "s.*", "times"), "members")
    again = members.where("times > 1").select("doc_id", "content")
    if again.limit(1).count():
        several = keep_ids(docs, again, "doc_id").join(again, "doc_id").mapInArrow(_chosen, "doc_id long, text string").dropDuplicates(["doc_id"])
        docs = keep_ids(docs, again, "doc_id", "left_anti").unionByName(several)
    long_ = members.where(F.col("n_words") >= n)
    shared = ws.save(long_.groupBy("content").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1").drop("copies"), "shared")
    copies = ws.save(long_.join(few(shared, BROADCAST_ROWS // 4), "content").where("doc_id <> rep").select("doc_id", "n_words", "content"), "copies")
    first = keep_ids(docs, copies.select("doc_id"), "doc_id", "left_anti")
    low, high = long_.agg(F.min("doc_id"), F.max("doc_id")).first()
    index = FingerprintIndex(spark, ws, n, g, max_runs)
    found = []
    if low is not None:
        edges = [low + (high + 1 - low) * k // batches for k in range(batches + 1)]
        for lo, hi in zip(edges, edges[1:]):
            if lo < hi:
                batch = first.where((F.col("doc_id") >= lo) & (F.col("doc_id") < hi))
                found.append(index.ingest(batch, first.where(F.col("doc_id") < lo) if found else None, lo))
    whole = copies.select("doc_id", F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))).cast(SPANS).alias("spans"))
    for part in found:
        whole = whole.unionByName(part.mapInArrow(_spans(n), f"doc_id long, spans {SPANS}"))
    out = ws.save(whole.join(members.select("doc_id", "content"), "doc_id"), "spans")
    ws.keep_only("spans", *(name for name, _ in index.runs))
    return out


def _cut(carry: bool):
    def run(batches):
        for batch in batches:
            forget()
            at = batch.schema.get_field_index
            for lo, hi in pieces(buffers(batch.column(at("text")))[1]):
                part = batch.slice(lo, hi - lo)
                texts = part.column(at("text"))
                spans, content = (part.column(at(c)).to_pylist() if c in batch.schema.names else [None] * (hi - lo) for c in ("spans", "content"))
                kept, total, removed = [], [], []
                for k, cut in enumerate(spans):  # the words of one text at a time
                    words = (texts[k].as_py() or "").encode().split()
                    total.append(len(words))
                    if cut and words_digest(words) == content[k]:  # else another text under this id
                        for x in reversed(cut):
                            del words[x["start"] : x["end"]]
                    removed.append(total[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                out = [part.column(at("doc_id")), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(out + [part.column(at("carried"))] * carry, names=["doc_id", "n_words", "n_removed", "kept_text"] + ["carried"] * carry)

    return run


def remove_spans(docs: DataFrame, spans: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): the words outside the spans, joined by one space; carry: the whole row as the struct ``carried``."""
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried")] * carry
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *whole).where("doc_id is not null")
    kind = "doc_id long, n_words long, n_removed long, kept_text string" + (f", carried {docs.schema['carried'].dataType.simpleString()}" if carry else "")
    ids = spans.select("doc_id")
    touched = keep_ids(docs, ids, "doc_id").join(spans, "doc_id").mapInArrow(_cut(carry), kind)
    return touched.unionByName(keep_ids(docs, ids, "doc_id", "left_anti").mapInArrow(_cut(carry), kind))
