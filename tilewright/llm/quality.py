"""A quality classifier: nearest labelled documents vote, in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, text_of
from .toxicity import sample_labelled

#: classes of UTF-8 bytes: 0 lower case and others, 1 upper case, 2 digit, 3 blank, 4 line end, then marks, of which those
#: from the 19th on are one class
MARKS = ".,|!*#$%&<>{}[]()=/\\\"':;?-_@+~^`"
KINDS = 24
FORMS, LETTERS, FIGURES = KINDS**3, 1 << 12, 8  # columns: trigrams of classes, hashed letter 4-grams, figures of repetition
COLUMNS = FORMS + LETTERS + FIGURES
BATCH = 128  # documents whose vectors are made at a time
LETTER_WEIGHT = np.float32(0.5)  # of a letter 4-gram, beside a trigram of classes


def byte_classes() -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[65:91] = 1
    out[0x80:0xA0] = 1  # second bytes of upper-case letters of Latin-1
    out[48:58] = 2
    out[[32, 9, 11, 12, 13]] = 3
    out[10] = 4
    for i, c in enumerate(MARKS):
        out[ord(c)] = min(5 + i, KINDS - 1)
    return out


CLASSES = byte_classes()


def raw_features(text: str) -> np.ndarray:
    """Counts of byte-class trigrams and of letter 4-grams as shares of the text, then figures of repetition and form."""
    data = text.encode("utf-8", "surrogatepass")
    codes = CLASSES[np.frombuffer(data, np.uint8)]
    out = np.zeros(COLUMNS, np.float32)
    if len(codes) > 2:
        tri = codes[:-2] * (KINDS * KINDS) + codes[1:-1] * KINDS + codes[2:]
        out[:FORMS] = np.bincount(tri, minlength=FORMS) / len(tri)
    if len(codes) > 3:
        x = np.frombuffer(data.lower(), np.uint8).astype(np.uint32)
        four = (x[:-3] | x[1:-2] << np.uint32(8) | x[2:-1] << np.uint32(16) | x[3:] << np.uint32(24)) * np.uint32(0x9E3779B1)
        out[FORMS : FORMS + LETTERS] = np.bincount(four >> np.uint32(20), minlength=LETTERS) / len(four)
    words = data.split()
    n = len(words)
    if n:
        lines = [x for x in data.split(b"\n") if x.strip()]
        single = np.bincount(codes, minlength=KINDS) / max(1, len(codes))
        same = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
        triples = len(set(zip(words, words[1:], words[2:], strict=False))) / max(1, n - 2) if n > 2 else 1.0
        out[-FIGURES:] = (
            same, 1 - min(1.0, triples), 1 - len(set(words)) / n, 1 - len(set(lines)) / len(lines), single[1], single[5:].sum(), min(2.0, (len(data) - n) / n / 10), np.log1p(n) / 10,
        )
    return out


def main_axes(x: np.ndarray, size: int) -> np.ndarray:
    """The first right singular vectors of x, as columns: by repeated products with a random sketch, always the same one."""
    y = x @ np.random.default_rng(0).standard_normal((x.shape[1], min(size + 16, min(x.shape)))).astype(np.float32)
    for _ in range(6):
        y, _ = np.linalg.qr(x @ (x.T @ y))
    _, _, v = np.linalg.svd(y.T @ x, full_matrices=False)
    return np.ascontiguousarray(v[:size].T)


class Latent:
    """Latent semantic analysis: shares of n-grams by inverse frequency and scaled figures, reduced by singular vectors of the
    sample."""

    def __init__(self, rows: int, row: np.ndarray, at: np.ndarray, share: np.ndarray, size: int = 48):
        """row, at, share: the raw features that are not zero of a sample of so many rows, as of a sparse matrix. Only columns
        that two rows have are laid out."""
        present = np.bincount(at, minlength=COLUMNS)[:-FIGURES]
        self.used = np.flatnonzero(present >= 2)
        self.idf = np.log(1 + rows / present[self.used]).astype(np.float32)
        self.idf[self.used >= FORMS] *= LETTER_WEIGHT
        self.scale = np.float32(2.0)
        n = len(self.used)
        column = np.full(COLUMNS, -1)
        column[self.used], column[-FIGURES:] = np.arange(n), n + np.arange(FIGURES)
        at = column[at]
        x = np.zeros((rows, n + FIGURES), np.float32)
        x[row[at >= 0], at[at >= 0]] = share[at >= 0]
        np.sqrt(x[:, :n], out=x[:, :n])
        x[:, :n] *= self.idf
        x[:, n:] *= self.scale
        self.mean = x.mean(axis=0)
        x -= self.mean
        self.axes = main_axes(x, size)
        self.sample = self._unit(x @ self.axes)

    @staticmethod
    def _unit(y: np.ndarray) -> np.ndarray:
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)

    def weighted(self, raw: np.ndarray) -> np.ndarray:
        return np.c_[np.sqrt(raw[:, self.used]) * self.idf, raw[:, -FIGURES:] * self.scale].astype(np.float32)

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return self._unit((self.weighted(raw) - self.mean) @ self.axes)


def vote(x: np.ndarray, vectors: np.ndarray, labels: np.ndarray, weights: np.ndarray, k: int, power: float) -> np.ndarray:
    """The weighted share of label 1 among the k nearest by exact cosine."""
    out = np.zeros(len(x))
    k = min(k, len(vectors))
    for at in range(0, len(x), 512):
        sims = x[at : at + 512] @ vectors.T
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(sims, near, axis=1), 1e-3) ** power * weights[near]
        out[at : at + 512] = (w * labels[near]).sum(axis=1) / w.sum(axis=1)
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fold: int, folds: int, most: int):
    """The broadcast (Latent, vectors, labels, weights) of the sample, or None if there are too few labels."""
    picked = F.broadcast(sample_labelled(labels, label_col, id_col, fold, folds, most))  # 2 * most rows
    counted = labels.filter(crc_mod(id_col, folds) != fold).groupBy(F.col(label_col).alias("label")).agg(F.countDistinct(id_col).alias("n"))
    share = {r["label"]: r["n"] for r in counted.filter("label in (0, 1)").collect()}

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                x = [raw_features(t) for t in part.column(0).to_pylist()]
                places = [np.flatnonzero(v) for v in x]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([p.astype(np.int32) for p in places], pa.list_(pa.int32())), pa.array([v[p] for v, p in zip(x, places, strict=True)], pa.list_(pa.float32()))], ["label", "at", "v"])

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(picked, "id")
    rows = rows.groupBy("id", "label").agg(F.min("text").alias("text")).select("text", "label")  # one document of an id that repeats
    sample = rows.mapInArrow(raw, "label int, at array<int>, v array<float>").toArrow()  # 2 * most rows
    if len(sample) < 10:
        return None
    at, v = (sample.column(c).combine_chunks() for c in ("at", "v"))
    row = np.repeat(np.arange(len(sample)), np.diff(at.offsets.to_numpy()))
    latent = Latent(len(sample), row, at.flatten().to_numpy(), v.flatten().to_numpy())
    y = sample.column("label").to_numpy().astype(float)
    each = np.array([share.get(0, 0) / max(1, (y == 0).sum()), share.get(1, 0) / max(1, (y == 1).sum())])
    return docs.sparkSession.sparkContext.broadcast((latent, latent.sample, y, each[y.astype(int)]))


def scores_of(texts: list[str | None], model, k: int, power: float) -> np.ndarray:
    out = np.ones(len(texts))
    for at in range(0, len(texts) if model else 0, BATCH):
        latent, vectors, y, w = model.value
        out[at : at + BATCH] = vote(latent(np.stack([raw_features(t or "") for t in texts[at : at + BATCH]])), vectors, y, w, k, power)
    return out


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fold: int = 2, folds: int = 4, most: int = 2000, k: int = 15, power: float = 8.0) -> DataFrame:
    """One row a document: id, held_out and score (0 to 1; the similarity-weighted share of label 1 among k neighbours).

    Labels are learnt from rows with crc32(id as text) mod folds other than fold: at most `most` of either label, those
    of the least hashes, which bounds the broadcast. If one label is capped, its votes weigh more, so that both labels
    count as they occur. Vectors come from the whole text, however long (trigrams of byte classes, letter 4-grams and
    repetition figures, reduced by the sample's singular vectors); each batch of documents is multiplied with all labelled vectors in blocks. No shuffle.
    Null or empty text has the vector of no trigram and is scored like any other. Without labels the score is 1. Ids
    are passed through, null and repeated ones too (a null id is not held out; of a labelled id that repeats, one text is
    learnt); an empty table gives an empty result; other columns are not read."""
    model = fit(docs, labels, id_col, text_col, label_col, fold, folds, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores_of(part.column(2).to_pylist(), model, k, power))], ["id", "held_out", "score"])

    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col).alias("id"), F.coalesce(crc_mod(id_col, folds) == fold, F.lit(False)).alias("held_out"), F.col(text_col))
    return out.mapInArrow(run, f"id {kind}, held_out boolean, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fold: int = 2, folds: int = 4, most: int = 2000, k: int = 15, power: float = 8.0) -> DataFrame:
    """docs without those that score below least; rows and columns of the others stay as they are.

    What a filter drops is gone for good, so it drops a document only if bad neighbours outweigh the good ones (0.5); the
    prediction of op7, 1 from 0.7 on, is stricter. Null and empty texts are scored like any other, long ones whole; rows
    with null or repeated ids go by their own text. Without labels all rows stay; an empty table stays empty."""
    model = fit(docs, labels, id_col, text_col, label_col, fold, folds, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield part.filter(pa.array(scores_of(part.column(text_at).to_pylist(), model, k, power) >= least))

    text_at = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # names with dots stop mapInArrow
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_quality(docs, labels).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
