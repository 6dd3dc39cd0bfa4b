"""Language ID with error-correcting output codes over character n-grams.

Every language gets a codeword; each bit has a binary classifier over hashed byte n-grams of the
folded text (ridge regression to +-1, each bit's threshold at 0). A text is decoded to the codeword of
least loss, the logistic loss of each bit weighted by that bit's share of right answers on a part of
the sample that the classifiers haven't seen. The classifiers are fitted on a bounded sample
(``most_rows`` labelled rows, an equal bound for each language, one row at least), taken by a threshold on
the hash of the id, so no language's rows meet in one task; all rows are predicted, from the text alone.

Defined results: null text and text without a letter (Unicode category L) give ``und`` with score 0; no
labelled row gives ``und`` everywhere; every labelled language is learned; repeated rows are predicted each;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.wordhash import buffers, pieces

UNDETERMINED = "und"


def _fold() -> np.ndarray:
    """Bytes with ASCII letters in lower case, other ASCII as space, the rest unchanged."""
    out = np.arange(256, dtype=np.uint32)
    out[:128] = 32
    out[97:123] = np.arange(97, 123)
    out[65:91] = out[97:123]
    return out


FOLD = _fold()


def ngram_vectors(data: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
    """Rows of unit length: square roots of the counts of hashed byte bigrams and trigrams of each text."""
    b = FOLD[data]
    size = 1 << bits
    shift = np.uint32(32 - bits)
    two = ((b[:-1] * np.uint32(0x9E3779B1)) ^ (b[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D) >> shift if len(b) > 1 else b[:0]
    three = ((b[:-2] * np.uint32(0x27D4EB2F)) ^ (b[1:-1] * np.uint32(0x165667B1)) ^ (b[2:] * np.uint32(0xD3A2646D))) * np.uint32(0xFD7046C5) >> shift if len(b) > 2 else b[:0]
    out = np.zeros((len(at) - 1, size), np.float32)
    for i, (lo, hi) in enumerate(zip((at[:-1] - at[0]).tolist(), (at[1:] - at[0]).tolist())):
        counts = np.bincount(two[lo : max(lo, hi - 1)], minlength=size) + np.bincount(three[lo : max(lo, hi - 2)], minlength=size)
        counts[int(BLANKS[bits][0])] = 0
        out[i] = counts
    np.sqrt(out, out=out)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


def _blank(bits: int) -> tuple[int]:
    s = np.array([32], np.uint32)
    return (int((((s * np.uint32(0x27D4EB2F)) ^ (s * np.uint32(0x165667B1)) ^ (s * np.uint32(0xD3A2646D))) * np.uint32(0xFD7046C5) >> np.uint32(32 - bits))[0]),)


BLANKS = {bits: _blank(bits) for bits in range(8, 17)}


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """(k, bits) of +-1: all splits up to five classes, beyond that the random code of the largest least distance."""
    if k <= 5:
        return np.array([[1 if c == 0 or (split >> (c - 1)) & 1 else -1 for split in range((1 << max(k - 1, 0)) - 1)] for c in range(k)], np.float64).reshape(k, -1)
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], size=(k, int(np.ceil(12 * np.log2(k)))))
        alike = code @ code.T - 2 * code.shape[1] * np.eye(k)
        least = int(code.shape[1] - alike.max()) // 2 if (np.abs(code.sum(axis=0)) < k).all() else -1
        if least > apart:
            best, apart = code, least
    return best


def conjugate_gradients(a: np.ndarray, b: np.ndarray, rounds: int = 300, tolerance: float = 1e-6) -> np.ndarray:
    """x with a @ x = b, column by column, for a symmetric positive definite."""
    x, r = np.zeros_like(b), b.copy()
    p, size = r.copy(), (b * b).sum(axis=0)
    rr = size.copy()
    for _ in range(rounds):
        if (rr <= tolerance**2 * np.maximum(size, 1e-300)).all():
            break
        ap = a @ p
        step = rr / np.maximum((p * ap).sum(axis=0), 1e-300)
        x += step * p
        r -= step * ap
        new = (r * r).sum(axis=0)
        p = r + new / np.maximum(rr, 1e-300) * p
        rr = new
    return x


class CodeModel:
    """Weights of the bits, their reliabilities, the code and the languages; small enough for a closure."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, trust: np.ndarray, bits: int):
        self.languages, self.code, self.weights, self.trust, self.bits = languages, code, weights, trust, bits

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, languages: list[str], bits: int, ridge: float = 0.3) -> CodeModel:
        code = codewords(len(languages))
        if not code.shape[1]:
            return CodeModel(languages, code, np.zeros((x.shape[1], 0)), np.ones(0), bits)
        part = np.arange(len(x)) % 5 == 4 if len(x) >= 50 else np.zeros(len(x), bool)

        def solve(rows: np.ndarray) -> np.ndarray:
            a = x[rows].astype(np.float64)
            share = 1.0 / np.maximum(np.bincount(y[rows], minlength=len(languages)), 1)[y[rows]]
            share *= len(a) / share.sum()
            weighted = (a * share[:, None]).T
            return conjugate_gradients(weighted @ a + ridge * np.eye(a.shape[1]), weighted @ code[y[rows]])

        trust = np.ones(code.shape[1])
        if part.any():
            right = np.sign(x[part] @ solve(~part)) == code[y[part]]
            trust = np.maximum(right.mean(axis=0) - 0.5, 0.01)
        return CodeModel(languages, code, solve(np.ones(len(x), bool)), trust / trust.sum(), bits)

    def decode(self, x: np.ndarray, sharp: float = 4.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, ambiguous) of each row."""
        if len(self.languages) == 1:
            return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
        margin = sharp * (x @ self.weights)
        for_one, for_other = np.logaddexp(0.0, -margin) * self.trust, np.logaddexp(0.0, margin) * self.trust
        loss = (for_one + for_other).sum(axis=1, keepdims=True) / 2 + (for_one - for_other) / 2 @ self.code.T
        best = loss.argmin(axis=1)
        odds = np.exp(-sharp * (loss - loss.min(axis=1, keepdims=True)))
        two = np.sort(loss, axis=1)[:, :2]
        return best, 1.0 / odds.sum(axis=1), two[:, 1] - two[:, 0] < 0.1


def _vectors(bits: int):
    def run(batches):
        for batch in batches:
            data, at = buffers(batch.column(2))
            for lo, hi in pieces(at):
                x = ngram_vectors(data[at[lo] : at[hi]], at[lo : hi + 1], bits)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["place", "lang", "x"])

    return run


def fit_language_model(labelled: DataFrame, most_rows: int = 6000, bits: int = 11) -> CodeModel | None:
    """A model from rows (doc_id, text, lang); the sample is the first rows of each language by a hash of the id."""
    rows = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    languages = sorted(counts)
    if not languages:
        return None
    each = max(1, most_rows // len(languages))
    # somewhat more than enough rows of each language pass; the exact number of them is taken from those alone
    shares = [(lang, min(1.0, (1.3 * each + 60) / n)) for lang, n in counts.items()]
    shares = labelled.sparkSession.createDataFrame(shares, "lang string, share double")
    place = F.xxhash64("doc_id")
    near = rows.join(F.broadcast(shares), "lang").where(F.pmod(place, F.lit(1 << 32)) < F.col("share") * float(1 << 32))
    by = Window.partitionBy("lang").orderBy(place, "doc_id", "text")
    sample = near.withColumn("place", F.row_number().over(by)).where(F.col("place") <= each).select("place", "lang", "text")
    got = sample.mapInArrow(_vectors(bits), "place int, lang string, x binary").toArrow().to_pydict()  # at most most_rows, or one a language
    order = sorted(range(len(got["lang"])), key=lambda k: (got["place"][k], got["lang"][k]))
    x = np.stack([np.frombuffer(got["x"][k], np.float32) for k in order])
    y = np.array([languages.index(got["lang"][k]) for k in order])
    return CodeModel.fit(x, y, languages, bits)


def _predict(model: CodeModel | None):
    def run(batches):
        for batch in batches:
            data, at = buffers(batch.column(1))
            for lo, hi in pieces(at):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                known = np.array([model is not None and t is not None and any(c.isalpha() for c in t) for t in texts])
                lang, score, vague = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
                if known.any():
                    best, sure, vague = model.decode(ngram_vectors(data[at[lo] : at[hi]], at[lo : hi + 1], model.bits))
                    lang = [model.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
                    score, vague = np.where(known, sure, 0.0), vague & known
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(vague)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return run


def predict_language(docs: DataFrame, model: CodeModel | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_predict(model), "doc_id long, lang_pred string, score double, ambiguous boolean")
