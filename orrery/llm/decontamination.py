"""Benchmark decontamination by latent semantic retrieval.

Words are runs of letters and digits, ASCII folded. Passages are windows of ``window`` words, every
``stride`` words. Of each block of benchmark items

1. the document frequencies of the items' words are counted over all documents;
2. the products of the words of each TF-IDF passage, of the items and of all documents, are summed over the
   partitions and written to the shared folder, and a randomised SVD, which needs nothing else of the
   passages, gives the ``rank`` leading right singular vectors, a truncated space of those words;
3. every passage of every document is projected and its cosine with every item passage taken, in
   blocks; a passage needs ``least_words`` different weighted words of the items and ``least_share`` as many as
   the item passage it is compared with, or all of them where that has fewer;
4. a candidate is confirmed if the longest common subsequence of words between the item and the
   document around the passage has at least ``least_lcs`` of the item's words, and the item's answer
   (its last ``answer_share`` of words, or the text in ``answer_column``) at least ``least_answer`` of its own.

So exact and edited copies, and paraphrases that keep ``least_lcs`` of the words in order, are found, and texts
that share a topic only are not. All documents are counted, fit the space and are searched.

Defined results: null or empty texts and items give no pair; an item without a weighted word (all of its
words are in over ``most_df`` of the documents) keeps all its words; rows with null ids are left out;
repeated rows give their pairs once; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.shared import Workspace
from orrery.llm.wordhash import Words, buffers, chunks

BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Pairs of words that a task sums at once, and entries of a block of the products.
PAIRS = 1 << 20
PAIR = "doc_id long, item_id long, cosine double, lcs double, answer double, at long"


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    at: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        if m := at.get(x):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


class Items:
    """A block of benchmark items: words, answers, vocabulary; later its weights, basis and latent passages."""

    def __init__(self, rows: list[tuple[int, str, str | None]], answer_share: float):
        texts = pa.array([r[1] for r in rows], pa.string())
        words = Words(*buffers(texts), True, BREAKS)
        self.ids = [r[0] for r in rows]
        self.words = [words.hash[a:b] for a, b in zip(words.of[:-1], words.of[1:])]
        given = Words(*buffers(pa.array([r[2] for r in rows], pa.string())), True, BREAKS)
        tail = [w[len(w) - max(1, int(np.ceil(len(w) * answer_share))) :] if len(w) else w for w in self.words]
        self.answers = [given.hash[a:b] if b > a else t for a, b, t in zip(given.of[:-1], given.of[1:], tail)]
        self.vocabulary = np.unique(words.hash)
        # a table over 20 bits of the hash tells most foreign words at once
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocabulary & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of words of the vocabulary, their indices)."""
        at = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFFF)).astype(np.int64)])
        if not len(self.vocabulary):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.vocabulary, h[at]), len(self.vocabulary) - 1)
        same = self.vocabulary[k] == h[at]
        return at[same], k[same]

    def weigh(self, df: np.ndarray, n_docs: int, most_df: float) -> None:
        idf = np.log((1 + n_docs) / (1 + df)) + 0.1
        self.weights = np.where(df > max(most_df * n_docs, 1), 0.0, idf)
        for w in self.words:
            _, k = self.look_up(w)
            if len(k) and not self.weights[k].any():
                self.weights[k] = idf[k]

    def passages(self, window: int, stride: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(item index, word indices) of the items' passages."""
        cut = [(i, w[lo : lo + window]) for i, w in enumerate(self.words) for lo in range(0, max(1, len(w) - window + stride), stride) if len(w)]
        return np.array([i for i, _ in cut], np.int64), [self.look_up(w)[1] for _, w in cut]


class Passages:
    """Passages of the rows of some Words: ``doc``, ``begin`` and ``end`` words, ``first``..``last`` of the weighted words ``k``; all words of the items by ``spot`` and ``word``."""

    def __init__(self, block: Items, words: Words, window: int, stride: int):
        self.spot, self.word = block.look_up(words.hash)
        heavy = block.weights[self.word] > 0
        at, self.k = self.spot[heavy], self.word[heavy]
        made = np.where(words.counts > 0, np.maximum(1, -(-(words.counts - window) // stride) + 1), 0)
        bounds = np.concatenate([[0], np.cumsum(made)])
        self.doc = np.repeat(np.arange(len(made)), made)
        self.begin = words.of[self.doc] + (np.arange(bounds[-1]) - bounds[self.doc]) * stride
        self.end = np.minimum(self.begin + window, words.of[self.doc + 1])
        self.first, self.last = np.searchsorted(at, self.begin), np.searchsorted(at, self.end)


def _of_texts(block: Items, window: int, stride: int):
    """(sizes, word indices) of the passages of a batch of (id, text)."""

    def run(batch):
        for _, _, words in chunks(batch, True, text=1, breaks=BREAKS):
            p = Passages(block, words, window, stride)
            size = p.last - p.first
            yield size, p.k[np.repeat(p.first - np.cumsum(size) + size, size) + np.arange(size.sum())]

    return run


def _of_lists(batch):
    """(sizes, word indices) of a batch of lists."""
    yield batch.column(0).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), batch.column(0).flatten().to_numpy(zero_copy_only=False)


def unit_entries(sizes: np.ndarray, k: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, value) of rows of unit length, sorted by row, from the words of each row."""
    cell, times = np.unique(np.repeat(np.arange(len(sizes)), sizes) * len(weights) + k, return_counts=True)
    row, word = cell // len(weights), cell % len(weights)
    value = times * weights[word]
    return row, word, value / np.maximum(np.sqrt(np.bincount(row, value * value, minlength=len(sizes)))[row], 1e-12)


def _summed(cell: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct cells, sums of their values)."""
    order = np.argsort(cell, kind="stable")
    cell, value = cell[order], value[order]
    head = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    return cell[head], np.add.reduceat(value, head)


def _pairs(weights: np.ndarray, listed):
    """Sums of A^T A by cell (word times words plus word, the lesser first) over the passages of a partition."""

    def some(sizes, k):
        row, word, value = unit_entries(sizes, k, weights)
        mine = np.bincount(row, minlength=len(sizes))
        rest = np.repeat(np.cumsum(mine), mine) - np.arange(len(row))  # entries of the row from each one on
        first = np.repeat(np.arange(len(row)), rest)
        other = first + np.arange(len(first)) - np.repeat(np.cumsum(rest) - rest, rest)
        return _summed(word[first] * len(weights) + word[other], value[first] * value[other])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for sizes, k in listed(batch):
                total, ends = np.cumsum(sizes * (sizes + 1) // 2), np.concatenate(([0], np.cumsum(sizes)))
                cuts = np.searchsorted(total, np.arange(PAIRS, (int(total[-1]) if len(total) else 0) + PAIRS, PAIRS), side="left") + 1
                for lo, hi in zip(np.concatenate(([0], cuts)).tolist(), cuts.tolist()):
                    hi = min(hi, len(sizes))
                    if lo < hi and ends[hi] > ends[lo]:
                        held.append(some(sizes[lo:hi], k[ends[lo] : ends[hi]]))
                        n += len(held[-1][0])
                    if n > 4 * PAIRS:
                        held = [_summed(*map(np.concatenate, zip(*held)))]
                        n = len(held[0][0])
                    if n > 2 * PAIRS and len(held) == 1:
                        yield from _cells(held)
                        held, n = [], 0
        yield from _cells(held)

    return run


def _cells(held: list):
    if held:
        cell, value = _summed(*map(np.concatenate, zip(*held)))
        for lo in range(0, len(cell), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(cell[lo : lo + (1 << 16)]), pa.array(value[lo : lo + (1 << 16)])], names=["cell", "value"])


def _block(key, table):
    """The cells of some rows as one row."""
    cell, value = (np.ascontiguousarray(table.column(c).to_numpy()) for c in ("cell", "value"))
    return pa.table({"block": pa.array([key[0].as_py()]), "cell": pa.array([cell.tobytes()], pa.binary()), "value": pa.array([value.tobytes()], pa.binary())})


def products(passages: DataFrame, weights: np.ndarray, listed=_of_lists) -> DataFrame:
    """A^T A of all passages of unit length, a row a block of its rows: its cells and their values."""
    words, rows = len(weights), max(1, PAIRS // len(weights))
    half = passages.mapInArrow(_pairs(weights, listed), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    i, j = F.floor(F.col("cell") / words).cast("long"), F.col("cell") % words
    both = half.select(F.explode(F.when(i == j, F.array("cell")).otherwise(F.array("cell", j * words + i))).alias("cell"), "value")
    both = both.withColumn("block", F.floor(F.col("cell") / (words * rows)).cast("long"))
    return both.groupBy("block").applyInArrow(_block, "block long, cell binary, value binary")


def _times(q: np.ndarray):
    """Rows of A^T A q, a block at a time."""
    rows = max(1, PAIRS // len(q))

    def run(batches):
        for batch in batches:
            for block, cell, value in zip(*(c.to_pylist() for c in batch.columns)):
                lo = block * rows
                dense = np.zeros((min(rows, len(q) - lo), len(q)))
                dense.reshape(-1)[np.frombuffer(cell, np.int64) - lo * len(q)] = np.frombuffer(value, np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([(dense @ q).tobytes()], pa.binary())], names=["lo", "part"])

    return run


def latent_basis(passages: DataFrame, weights: np.ndarray, rank: int, more: int = 16, rounds: int = 2, listed=_of_lists, save=lambda df: df) -> tuple[np.ndarray, np.ndarray]:
    """((words, rank) right singular vectors, singular values) of all passages by a randomised SVD.

    ``rank + more`` random directions, multiplied by A^T A ``rounds`` times, span the range; the small
    matrix Q^T A^T A Q of one product more has the squared singular values and the rotation. ``save`` keeps
    A^T A between the products.
    """
    q = np.random.default_rng(11).standard_normal((len(weights), min(rank + more, len(weights))))
    blocks = save(products(passages, weights, listed))
    for k in range(rounds + 1):
        y = np.zeros(q.shape)
        for r in blocks.select("block", "cell", "value").mapInArrow(_times(q), "lo long, part binary").collect():  # words x directions
            part = np.frombuffer(r["part"], np.float64).reshape(-1, q.shape[1])
            y[r["lo"] : r["lo"] + len(part)] = part
        if k < rounds:
            q = np.linalg.qr(y)[0]
    squares, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
    best = [j for j in np.argsort(-squares)[:rank] if squares[j] > 1e-9 * max(squares.max(), 1e-300)]
    return q @ turn[:, best], np.sqrt(squares[best])


def _frequencies(block: Items):
    def run(batches):
        df, n = np.zeros(len(block.vocabulary), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for lo, hi, words in chunks(batch, True, text=1, breaks=BREAKS):
                at, k = block.look_up(words.hash)
                doc = np.searchsorted(words.of, at, side="right") - 1
                df += np.bincount(np.unique(doc * len(df) + k) % max(len(df), 1), minlength=len(df))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(df[seen], n))], names=["word", "n"])

    return run


def _search(block: Items, basis: np.ndarray, p: dict):
    basis32 = (basis * block.weights[:, None]).astype(np.float32)
    owner, parts = block.passages(p["window"], p["stride"])
    parts = [k[block.weights[k] > 0] for k in parts]
    latent32 = np.array([basis32[k].sum(axis=0) for k in parts]).reshape(len(parts), basis.shape[1])
    latent32 /= np.maximum(np.sqrt((latent32 * latent32).sum(axis=1, keepdims=True)), 1e-9)
    need = np.array([len(np.unique(k)) for k in parts])
    floor = np.maximum(np.minimum(p["least_words"], need), np.ceil(need * p["least_share"]))  # of each item passage, as a long item has several
    floor[need == 0] = np.inf
    sizes = np.array([len(w) for w in block.words])

    def run(batches):
        times = np.zeros((len(sizes), len(block.vocabulary)), np.uint16)  # of each word in each item
        for i, w in enumerate(block.words):
            times[i] = np.minimum(np.bincount(block.look_up(w)[1], minlength=times.shape[1]), 65535)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows: dict[tuple[int, int], tuple] = {}
            for lo, _, words in chunks(batch, True, text=1, breaks=BREAKS):
                own = Passages(block, words, p["window"], p["stride"])
                doc, begin, end, first, last, k = own.doc, own.begin, own.end, own.first, own.last, own.k
                for s in _blocks(np.flatnonzero(last - first >= max(1, floor.min())), last - first):
                    size = (last - first)[s]
                    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
                    flat = np.repeat(first[s] - starts, size) + np.arange(size.sum())
                    cell = np.repeat(np.arange(len(s)), size) * len(basis32) + k[flat]
                    kinds = np.bincount(np.unique(cell) // len(basis32), minlength=len(s))
                    y = np.add.reduceat(basis32[k[flat]], starts, axis=0)
                    y /= np.maximum(np.sqrt((y * y).sum(axis=1, keepdims=True)), 1e-9)
                    score = y @ latent32.T
                    hit = (score >= p["least_cosine"]) & (kinds[:, None] >= floor[None, :])
                    for r, c in _able(hit, owner, times, sizes, p["least_lcs"], own, s, words.of):
                        item, d = int(owner[c]), int(doc[s[r]])
                        size_i = int(sizes[item])
                        a = max(int(words.of[d]), int(begin[s[r]]) - size_i)
                        b = min(int(words.of[d + 1]), int(end[s[r]]) + size_i)
                        near = words.hash[a:b]
                        lcs = lcs_length(block.words[item], near) / max(size_i, 1)
                        if lcs < p["least_lcs"]:
                            continue
                        answer = lcs_length(block.answers[item], near) / max(len(block.answers[item]), 1)
                        if answer < p["least_answer"] or ids[lo + d] is None:
                            continue
                        key = (ids[lo + d], block.ids[item])
                        row = (lcs, answer, float(score[r, c]), int(begin[s[r]] - words.of[d]))
                        rows[key] = max(rows.get(key, row), row)
            if rows:
                cols = zip(*((d, i, cosine, lcs, answer, at) for (d, i), (lcs, answer, cosine, at) in sorted(rows.items())))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "item_id", "cosine", "lcs", "answer", "at"])

    return run


def _able(hit: np.ndarray, owner: np.ndarray, times: np.ndarray, sizes: np.ndarray, least: float, own: Passages, s: np.ndarray, of: np.ndarray):
    """Hits (row, item passage) whose item has ``least`` of its words around the passage in any order, without which no subsequence is as long."""
    for r in np.flatnonzero(hit.any(axis=1)).tolist():
        at, found = s[r], np.flatnonzero(hit[r])
        items = owner[found]
        reach, d = int(sizes[items].max()), own.doc[at]
        lo, hi = np.searchsorted(own.spot, (max(of[d], own.begin[at] - reach), min(of[d + 1], own.end[at] + reach)))
        there = times[np.ix_(items, np.unique(own.word[lo:hi]))].sum(axis=1)
        yield from ((r, c) for c in found[(there >= least * sizes[items]) | (sizes[items] > 65535)].tolist())


def _blocks(x: np.ndarray, size: np.ndarray, most: int = 16_000):
    """Runs of x of about ``most`` words each."""
    total = np.cumsum(size[x])
    cuts = np.searchsorted(total, np.arange(most, (int(total[-1]) if len(x) else 0) + most, most), side="left") + 1
    for lo, hi in zip(np.concatenate(([0], cuts)).tolist(), cuts.tolist()):
        if lo < len(x):
            yield x[lo:hi]


def benchmark_matches(
    docs: DataFrame,
    items: DataFrame,
    answer_column: str | None = None,
    rank: int = 128,
    window: int = 64,
    stride: int = 32,
    least_cosine: float = 0.2,
    least_words: int = 4,
    least_share: float = 0.4,
    least_lcs: float = 0.6,
    least_answer: float = 0.5,
    answer_share: float = 0.25,
    most_df: float = 0.05,
    items_at_once: int = 1000,
) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, at) of every document and item that match; at: the passage's first word."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
    answer = F.col(answer_column).cast("string") if answer_column else F.lit(None).cast("string")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), answer.alias("answer")).where("item_id is not null").dropDuplicates(["item_id"])
    ws, out, last = Workspace(spark, "decontamination"), spark.createDataFrame([], PAIR), None
    p = {"window": window, "stride": stride, "least_cosine": least_cosine, "least_words": least_words, "least_share": least_share, "least_lcs": least_lcs, "least_answer": least_answer}
    while True:
        own = items if last is None else items.where(F.col("item_id") > last)
        rows = own.orderBy("item_id").limit(items_at_once).collect()  # a block of the query set
        if not rows:
            return out.groupBy("doc_id", "item_id").agg(F.max(F.struct("lcs", "answer", "cosine", "at")).alias("s")).select("doc_id", "item_id", "s.cosine", "s.lcs", "s.answer", "s.at")
        last = rows[-1]["item_id"]
        block = Items([tuple(r) for r in rows], answer_share)
        if not len(block.vocabulary):
            continue
        df, n_docs = np.zeros(len(block.vocabulary), np.int64), 0
        for r in docs.mapInArrow(_frequencies(block), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():  # a row a word of the block
            if r["word"] < 0:
                n_docs = r["n"]
            else:
                df[r["word"]] = r["n"]
        block.weigh(df, n_docs, most_df)
        fit = docs.unionByName(items.where((F.col("item_id") >= rows[0]["item_id"]) & (F.col("item_id") <= last)).select(F.col("item_id").alias("doc_id"), "text"))
        basis, _ = latent_basis(fit, block.weights, rank, listed=_of_texts(block, window, stride), save=lambda df, name=f"products-{last}": ws.save(df, name))
        ws.drop(f"products-{last}")
        if basis.shape[1]:
            out = out.unionByName(docs.mapInArrow(_search(block, basis, p), PAIR))
