"""Toxicity from class-conditional Kneser-Ney models over the letters of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import slices, sums_by_row, unique_words
from .common import crc_mod, text_of

ORDER = 5
START, STOP = 0x110000, 0x110001  # beyond all code points
ALPHABET = STOP + 1
STRIP = ".,;:!?\"'()[]{}*#%&$<>|"
CACHE = 500_000  # words whose scores a task remembers
SLICE = 4_000_000  # bytes of text worked on at a time
LEAST = 2.5  # a word speaks for toxicity if it is e ** LEAST times likelier there
SHORT = 100  # letters added to a text's length, so that one word of a short text doesn't decide
BINS = 500  # of the calibration, a unit of evidence
ODD = np.uint64(0x9E3779B97F4A7C15)


def grams_of(words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each letter of each word, and its stop: 64-bit hashes of the n-grams that end there, from one letter to ORDER;
    hashes of the letters before it in each (its contexts); and whose letter it is. Words are not empty."""
    gap = "\n" * (ORDER - 1)  # no word has a line end in it
    codes = np.frombuffer((gap + ("\n" + gap).join(words) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = codes == 10
    stop = end & ~np.r_[True, end[:-1]]
    codes[end] = START
    codes[stop] = STOP
    x = (codes + np.uint64(1)) * ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    real = np.flatnonzero(codes != START)
    hashes, contexts, h = [], [], np.zeros_like(x)
    for _ in range(ORDER):
        before = np.r_[np.uint64(0), h[:-1]]
        h = x + before * np.uint64(0xD6E8FEB86659FD93)
        hashes.append(h[real])
        contexts.append(before[real])
    return hashes, contexts, (np.cumsum(stop) - stop)[real]


def looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(asked))
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def table_of(grams: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(grams in order, their counts; contexts in order, what their grams' counts add up to, how many grams each has)."""
    order = np.argsort(grams)
    found, at = np.unique(contexts, return_inverse=True)
    return grams[order], counts[order].astype(float), found, np.bincount(at, counts, len(found)), np.bincount(at, minlength=len(found)).astype(float)


class KneserNey:
    """Interpolated Kneser-Ney for two classes. The longest n-grams are counted by class; every shorter order is a
    continuation count over both classes, so that rare expressions are smoothed alike in either."""

    def __init__(self, hashes: list[np.ndarray], contexts: list[np.ndarray], toxic: np.ndarray, ordinary: np.ndarray, discount: float = 0.75):
        """hashes, contexts: of different n-grams, as of grams_of; toxic, ordinary: how often each of the longest occurs."""
        self.discount = discount
        self.top = [table_of(hashes[-1][n > 0], contexts[-1][n > 0], n[n > 0]) for n in (toxic, ordinary)]
        self.lower = []  # of orders ORDER - 1 down to 1
        rows = np.flatnonzero(toxic + ordinary > 0)
        for k in range(ORDER - 2, -1, -1):
            grams, first, counts = np.unique(hashes[k][rows], return_index=True, return_counts=True)
            rows = rows[first]
            self.lower.append(table_of(grams, contexts[k][rows], counts))

    def _step(self, table, gram: np.ndarray, context: np.ndarray, below: np.ndarray) -> np.ndarray:
        grams, counts, contexts, sums, kinds = table
        c, n, k = looked_up(grams, counts, gram), looked_up(contexts, sums, context), looked_up(contexts, kinds, context)
        known = n > 0
        n = np.where(known, n, 1)
        return np.where(known, np.maximum(c - self.discount, 0) / n + self.discount * k / n * below, below)

    def probabilities(self, hashes: list[np.ndarray], contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """P(last letter | letters before) in the toxic class and in the ordinary one."""
        p = np.full(len(hashes[0]), 1 / ALPHABET)
        for k, table in enumerate(reversed(self.lower)):
            p = self._step(table, hashes[k], contexts[k], p)
        return self._step(self.top[0], hashes[-1], contexts[-1], p), self._step(self.top[1], hashes[-1], contexts[-1], p)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The log-likelihood of each word in the toxic class, less that in the ordinary one."""
        hashes, contexts, owner = grams_of(words)
        _, first, code = np.unique(hashes[-1], return_index=True, return_inverse=True)
        toxic, ordinary = self.probabilities([h[first] for h in hashes], [c[first] for c in contexts])
        return np.bincount(owner, (np.log(toxic) - np.log(ordinary))[code], len(words))


def evidence(texts: pa.Array, model: KneserNey, cache: dict[str, float]) -> np.ndarray:
    """Of each text the difference of its log-likelihoods in the two classes, of the expressions for which it is above LEAST
    (ordinary words of a toxic text tell nothing), over the root of its length in letters, as chance would add it up."""
    words, code, rows = unique_words(texts, STRIP)
    if len(cache) > CACHE:
        cache.clear()
    new = [w for w in words if w and w not in cache]
    if new:
        cache.update(zip(new, np.maximum(model.word_scores(new) - LEAST, 0).tolist(), strict=True))
    each = np.fromiter((cache[w] if w else 0.0 for w in words), float, len(words))
    size = np.fromiter((len(w) + 1 if w else 0 for w in words), float, len(words))
    return sums_by_row(each[code], rows) / np.sqrt(sums_by_row(size[code], rows) + SHORT)


def fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """(slope, constant) by Newton's steps, from values x with label y that occur n times; a slope is never negative."""
    z, w = np.c_[x, np.ones(len(x))], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (n * (p - y)) + ridge * n.sum() * np.array([w[0] / 100, 0])
        hess = (z * (n * p * (1 - p))[:, None]).T @ z + ridge * n.sum() * np.diag([1 / 100, 1e-3])
        w -= np.clip(np.linalg.solve(hess, grad), -5, 5)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (0.0, float(np.log((n @ y) / (n @ (1 - y)))))


def sample_labelled(labels: DataFrame, label_col: str, id_col: str, fold: int, folds: int, most: int) -> DataFrame:
    """At most `most` labelled ids of either label outside the fold, those of the least hashes: (id, label)."""
    out = None
    for label in (0, 1):
        part = labels.filter((F.col(label_col) == label) & (crc_mod(id_col, folds) != fold)).select(F.col(id_col).alias("id")).distinct()
        part = part.orderBy(F.xxhash64("id"), "id").limit(most).withColumn("label", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fold: int, folds: int, most: int):
    """(broadcast model, (slope, constant)) from at most `most` labelled documents of either class. The logistic comes from a
    third of them, by hash of the id, scored by a model of the other two thirds; the model that is returned counts all three.
    Letter n-grams are counted in Spark; the driver gets one row for each different one, and the calibration's histogram."""
    picked = F.broadcast(sample_labelled(labels, label_col, id_col, fold, folds, most))  # 2 * most rows
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(picked, "id")
    part = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(3)) < 2
    keys = [*(f"h{k}" for k in range(ORDER)), *(f"c{k}" for k in range(ORDER))]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(0), SLICE):
                words, code, places = unique_words(batch.column(0).slice(a, b - a), STRIP)
                kind = 2 * batch.column(1).slice(a, b - a).to_numpy() + batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False)
                n = np.bincount(code * 4 + np.repeat(kind, np.diff(places)), minlength=4 * len(words)).reshape(-1, 4)
                some = [i for i, w in enumerate(words) if w]
                if not some:
                    continue
                hashes, contexts, owner = grams_of([words[i] for i in some])
                _, first, gram = np.unique(hashes[-1], return_index=True, return_inverse=True)
                counts = [np.bincount(gram, n[some, c][owner], len(first)).astype(np.int64) for c in range(4)]
                yield pa.RecordBatch.from_arrays([*(pa.array(h[first].view(np.int64)) for h in (*hashes, *contexts)), *map(pa.array, counts)], [*keys, "n0", "n1", "n2", "n3"])

    schema = ", ".join(f"{k} long" for k in [*keys, "n0", "n1", "n2", "n3"])
    counted = rows.select("text", "label", part).mapInArrow(count, schema).groupBy(f"h{ORDER - 1}")
    seen = counted.agg(*(F.max(k).alias(k) for k in keys if k != f"h{ORDER - 1}"), *(F.sum(f"n{i}").alias(f"n{i}") for i in range(4))).toArrow()
    column = lambda name: seen.column(name).to_numpy()
    hashes, contexts = ([column(f"{x}{k}").view(np.uint64) for k in range(ORDER)] for x in "hc")
    n = [column(f"n{i}").astype(float) for i in range(4)]  # ordinary, then toxic; of the held third, then of the others
    broadcast = docs.sparkSession.sparkContext.broadcast
    trial, whole = broadcast(KneserNey(hashes, contexts, n[3], n[1])), broadcast(KneserNey(hashes, contexts, n[2] + n[3], n[0] + n[1]))

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in batches:
            for a, b in slices(batch.column(0), SLICE):
                x = np.sqrt(evidence(batch.column(0).slice(a, b - a), trial.value, cache))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(np.rint(x * BINS), 100 * BINS).astype(np.int64)), batch.column(1).slice(a, b - a)], ["bin", "label"])

    held = rows.filter(~part).select("text", "label").mapInArrow(bins, "bin long, label int").groupBy("bin", "label").agg(F.count("*").alias("n")).toArrow()
    x, y, times = (held.column(c).to_numpy().astype(float) for c in ("bin", "label", "n"))
    if len(np.unique(y)) < 2 or not (n[1] + n[3]).any():
        return whole, None
    return whole, fit_logistic(x / BINS, y, times)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fold: int = 1, folds: int = 3, most: int = 4000) -> DataFrame:
    """One row a document: id, held_out and score (0 to 1).

    Labels are learnt from rows with crc32(id as text) mod folds other than fold, at most `most` documents of either class.
    A text is scored by its evidence alone (the length-normalised difference of its log-likelihoods in the toxic and the
    ordinary model); a logistic function of its root makes it a probability. The model and its broadcast hold the
    different letter n-grams of the sample. Every text is read whole, however long, in its own task; there is no shuffle of
    documents. Null or empty text has no word, its evidence is 0. Without labels of both classes the score is 0. Ids are
    passed through, null and repeated ones too (a null id is not held out); an empty table gives an empty result; other
    columns are not read."""
    model, logistic = train(docs, labels, id_col, text_col, label_col, fold, folds, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for a, b in slices(batch.column(2), SLICE) if logistic else []:
                z = logistic[0] * np.sqrt(evidence(batch.column(2).slice(a, b - a), model.value, cache)) + logistic[1]
                scores[a:b] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], ["id", "held_out", "score"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(crc_mod(id_col, folds) == fold, F.lit(False)).alias("held_out"), text_of(text_col))
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, score double").withColumnRenamed("id", id_col)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_toxicity(docs, labels).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
