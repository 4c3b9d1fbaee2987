"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader, sparse dot products."""

import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import _alphabet, _power_tables, frugal, mix

#: Labelled rows that the model is fitted on at most, those first by a hash of the id.
SAMPLE = 6000
BITS = 18
EPOCHS = 4
HELD_OUT = 2
THRESHOLD = 0.7


@cache
def _kinds() -> np.ndarray:
    """For each code point: 0 white space, 1 mark, 2 lower or caseless letter, 3 upper-case letter, 4 digit."""
    kind = np.ones(0x110000, dtype=np.uint8)
    is_word, _ = _alphabet()
    kind[is_word] = 2
    for i in (*range(0x3000), *range(0x10400, 0x10500), *range(0x1E900, 0x1E960), *range(0xA640, 0xA7FF), *range(0xFF00, 0xFFEF), *range(0x1D400, 0x1D800)):
        c = chr(i)
        if c.isspace():
            kind[i] = 0
        elif c.isupper():
            kind[i] = 3
        elif unicodedata.category(c)[0] == "N":
            kind[i] = 4
    return kind


def _tokens(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word or run of marks, in lower case; and of its shape: case, digits and length class, or the run itself."""
    kinds, (_, value) = _kinds(), _alphabet()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = kinds[points]
    group = np.minimum(kind, 2)
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    end = np.r_[edge[1:], len(points)]
    token = group[edge] > 0
    start, end = edge[token], end[token]
    up, down = _power_tables(len(points) + 1)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(value[points] * up[: len(points)], out=sums[1:])
    surface = mix((sums[end] - sums[start]) * down[start])
    count = lambda k: (lambda s: s[end] - s[start])(np.r_[0, np.cumsum(kind == k)])
    upper, digit, length = count(3), count(4), end - start
    first = kind[start] == 3
    case = np.where(upper == 0, 0, np.where(upper == length, 1, np.where(first & (upper == 1), 2, 3)))
    shape = mix((case + 4 * (digit > 0) + 8 * np.minimum(np.log2(length).astype(np.int64), 6)).astype(np.uint64) + np.uint64(1))
    return surface, np.where(group[start] == 1, surface, shape)


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a whole text, with counts scaled to length 1; nothing for a null or blank text.

    The n-grams are single words and pairs, of words and of word shapes, shape triples, and whether a word repeats the
    one before.
    """
    if not text:
        return np.empty(0, np.int64), np.empty(0)
    surface, shape = _tokens(text)
    if not len(surface):
        return np.empty(0, np.int64), np.empty(0)
    u = np.uint64
    grams = [surface, shape + u(2), surface[1:] * u(3) + surface[:-1], shape[1:] * u(5) + shape[:-1], shape[2:] * u(7) + shape[1:-1] * u(11) + shape[:-2], (surface[1:] == surface[:-1]) + u(13)]
    where = [mix(g + u((i << 56) + 1)) >> u(64 - bits) for i, g in enumerate(grams)]
    index, count = np.unique(np.concatenate(where).astype(np.int64), return_counts=True)
    return index, count / np.sqrt((count * count).sum())


class FollowTheLeader:
    """Logistic regression by follow-the-regularised-leader-proximal updates; the last weight is the bias."""

    def __init__(self, bits: int = BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.02) -> None:
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        index, value = np.r_[index, len(self.z) - 1], np.r_[value, 1.0]
        w = self.weights(index)
        g = (sigmoid(float(w @ value)) - label) * value
        self.z[index] += g - (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / self.alpha * w
        self.n[index] += g * g


def sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -40.0), 40.0)))


def fit(labelled: DataFrame, text_col: str, label_col: str, bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from a bounded sample, learned in one task in the order of the texts and labels, so however the rows are partitioned."""

    @frugal
    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = [(zlib.crc32((t or "").encode("utf-8", "replace")), t or "", int(y)) for f in frames for t, y in zip(f["text"], f["label"], strict=True)]
        rows = [(*features(t, bits), y) for _, t, y in sorted(texts)]  # by a hash first, for order must not follow content
        model = FollowTheLeader(bits)
        for _ in range(epochs):
            for index, value, label in rows:
                model.update(index, value, label)
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        yield pd.DataFrame({"at": at, "w": w[at]})

    sample = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).repartition(1)
    w = np.zeros((1 << bits) + 1)
    for row in sample.mapInPandas(learn, "at long, w double").toPandas().itertuples():  # at most 2**bits + 1 rows
        w[row.at] = row.w
    return w


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, from the whole text alone; a text without words scores what the bias gives."""

    @frugal
    def dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("__text"):
                index, value = features(text.as_py(), bits)
                out.append(float(sigmoid(float(weights[index] @ value) + weights[-1])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], [*batch.schema.names[:-1], "score"])

    kept = [c for c in docs.columns if c != "score"]
    fields = docs.select(kept).withColumn("score", F.lit(0.0)).schema
    return docs.select(*kept, F.col(text_col).alias("__text")).mapInArrow(dot, fields)


def held_out(doc_id: str = "doc_id"):
    """The quarter of the ids that no model learns from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == HELD_OUT, F.lit(False))


def sample_labelled(docs: DataFrame, labels: DataFrame, label_col: str, limit: int = SAMPLE) -> DataFrame:
    """At most ``limit`` documents with a label outside the held-out quarter: ``text`` and ``label``. The bound makes the broadcast small."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out()).groupBy("doc_id").agg(F.max(label_col).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def classify_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from ``threshold`` on).

    The model learns ``labels.quality`` of at most ``sample`` rows outside the held-out quarter; labels with a null or
    other value are left out, and a document labelled twice has the larger label. A null or blank text scores what the
    bias gives; without any labels every score is 0.5. Rows keep their columns (one named ``score`` or ``predicted`` is
    replaced) and repeated rows stay.
    """
    weights = fit(sample_labelled(docs, labels, "quality", sample), "text", "label")
    return score(docs, weights).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
