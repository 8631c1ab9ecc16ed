"""Operator 3, quality classifier: hashed word n-gram logistic regression trained by follow-the-regularised-leader.

Features are the words of a text, their shapes (letters and digits folded, so that unknown words still tell something) and
the 2-grams of both, hashed to ``DIMS`` columns with unit length. The model is fitted on a bounded sample of labelled rows
outside the held-out fold: those with the smallest hashes of their ids, at most ``TRAIN_ROWS`` rows and ``TRAIN_ENTRIES``
nonzero features in all, whatever ids repeat and however long texts are. It is a vector of fixed size that every task gets;
texts are then scored where they are read, as sparse dot products. Nothing shuffles but the sample.

Rates, penalties and passes were chosen inside the training fold of sf0.1, by the least logistic loss of 24 settings: fitted
on rows whose crc32 mod 5 is 2 to 4, compared on those where it is 1 (tests/llm/choose.py).

Only the text is an input of a score. Defined results: null and empty texts score by the bias alone; a null doc_id is in no
fold (held_out false) and is never trained on; repeated rows score alike; without usable labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import hashing as H
from wardline.llm.common import map_arrow, staged, table
from wardline.llm.tokens import in_parts

DIMS = 1 << 18
#: Labelled rows that the model is fitted on, their nonzero features in all, and passes over them.
TRAIN_ROWS, TRAIN_ENTRIES, EPOCHS = 8192, 1 << 24, 6
#: Learning rate, its offset, and the weights of the two penalties.
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.1, 0.02
CUT = 0.3

#: Shape of a byte: capitals, small letters and bytes beyond ASCII, digits; the rest stands for itself.
_SHAPE = np.array([1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 or b >= 128 else 3 if 48 <= b <= 57 else b for b in range(256)], np.uint8)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of unit length: row of each entry, its column, its value."""
    data, starts = H.join_texts(texts)
    first, stop = H.words(data)
    row = np.searchsorted(starts, first, "right") - 1
    exact = H.spans(H.prefix(H.BYTE_VALUES[data]), first, stop)
    # A shape keeps one byte of each run of like bytes.
    shape = _SHAPE[data]
    new = np.concatenate([[True], shape[1:] != shape[:-1]]) if len(shape) else np.zeros(0, bool)
    new[first] = True
    at = np.cumsum(new) - new
    runs = H.spans(H.prefix(H.BYTE_VALUES[shape[new]]), at[first], np.concatenate([at, [int(new.sum())]])[stop])
    same = np.concatenate([exact[1:] == exact[:-1], [False]])[: len(exact)].astype(np.uint64)
    found, rows = [], []
    for salt, h, n in ((1, exact, 1), (2, exact, 2), (3, runs, 1), (4, runs, 2), (5, same, 2)):
        grams = H.mix(H.combine(h, n) + np.uint64(salt))
        whole = row[: len(grams)] == row[n - 1 :] if n > 1 else slice(None)
        found.append(grams[whole] % np.uint64(DIMS))
        rows.append(row[: len(grams)][whole])
    key, count = np.unique(np.concatenate(rows).astype(np.int64) * DIMS + np.concatenate(found).astype(np.int64), return_counts=True)
    row, column, value = key // DIMS, key % DIMS, np.log1p(count)
    norm = np.sqrt(np.bincount(row, value * value, len(texts)))
    return row, column, value / norm[row]


def train(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias after EPOCHS passes of per-coordinate FTRL-proximal updates; rows are (columns, values, label)."""
    z, n = np.zeros(DIMS + 1), np.zeros(DIMS + 1)

    def weights(i):
        slack = np.abs(z[i]) - L1
        return np.where(slack > 0, -np.sign(z[i]) * slack / ((BETA + np.sqrt(n[i])) / ALPHA + L2), 0.0)

    for _ in range(EPOCHS):
        for columns, values, label in rows:
            i, x = np.append(columns, DIMS), np.append(values, 1.0)  # the last column is the bias
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    w = weights(slice(None))
    return w[:DIMS].astype(np.float32), float(w[DIMS])


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    usable = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id")))
    sample = usable.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_ROWS)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(sample), "_id").select("_id", "_y", F.coalesce("_t", F.lit("")).cast("binary"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values in in_parts(batch.column(2)):
                row, column, value = features(values)
                edges = np.searchsorted(row, np.arange(b - a + 1))
                cut = lambda x, kind: pa.array([x[i:j].astype(kind).tobytes() for i, j in zip(edges[:-1], edges[1:], strict=True)], pa.binary())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), cut(column, np.int32), cut(value, np.float32)], names=["id", "y", "columns", "values"])

    made = staged(map_arrow(texts, make, "id long, y int, columns binary, values binary"), "features")
    # Ids may repeat and texts be of any length: rows are taken in order while both bounds hold.
    order = [F.xxhash64("id"), F.xxhash64("columns"), F.col("y")]
    sizes = made.select(F.length("columns").alias("n"), *(c.alias(f"o{k}") for k, c in enumerate(order))).orderBy("o0", "o1", "o2").limit(TRAIN_ROWS).collect()
    taken = int(np.searchsorted(np.cumsum([r.n // 4 for r in sizes]), TRAIN_ENTRIES, "right")) if sizes else 0
    rows = sorted(made.orderBy(*order).limit(taken).collect(), key=lambda r: (r.id * 0x9E3779B97F4A7C15 & H.MASK, r.columns)) if taken else []
    return train([(np.frombuffer(r["columns"], np.int32), np.frombuffer(r["values"], np.float32), r.y) for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared, bias = docs.sparkSession.sparkContext.broadcast(model[0]), model[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for a, b, values in in_parts(batch.column(2)):
                row, column, value = features(values)
                total = np.bincount(row, w[column] * value, b - a) + bias
                p = np.round(1 / (1 + np.exp(-np.clip(total, -30, 30))), 6)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(p), pa.array((p >= CUT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    own = F.col(id_col).cast("long")
    texts = docs.select(own.alias("doc_id"), held_out(own).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    return map_arrow(texts, run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
