"""Language of whole texts by a byte convolutional network: filters of several widths, max pooling and softmax, in numpy."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import held_out
from .words import frugal

#: Different labelled rows that the model is fitted on at most, those first by a hash of the id; their texts are read whole.
SAMPLE = 1200
#: Bytes of a window; neighbours share all but one byte of the widest filter.
LENGTH = 256
WIDTHS, FILTERS, CODE = (2, 3, 4), 12, 8
WIDEST = max(WIDTHS)
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    """Is there a character of Unicode's letter category."""
    return text is not None and any(map(str.isalpha, text))


def windows(text: str) -> np.ndarray:
    """All fixed-length windows of a text's bytes; the last one is padded with zero bytes."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    step = LENGTH - WIDEST + 1
    n = max(1, -(-(len(data) - WIDEST + 1) // step))
    padded = np.zeros((n - 1) * step + LENGTH, dtype=np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, LENGTH)[::step]


class ByteNet:
    def __init__(self, classes: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.mask = np.repeat(np.concatenate([np.arange(WIDEST)[:, None] < np.full(FILTERS, w) for w in WIDTHS], axis=1), CODE, axis=0).astype(np.float32)
        self.codes = rng.normal(0, 0.5, (256, CODE)).astype(np.float32)
        self.conv = (rng.normal(0, 0.3, (WIDEST * CODE, n)) * self.mask).astype(np.float32)
        self.shift = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.3, (n, classes)).astype(np.float32)
        self.bias = np.zeros(classes, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.codes, self.conv, self.shift, self.out, self.bias]

    def _columns(self, x: np.ndarray) -> np.ndarray:
        """Codes of the bytes under the widest filter at each place: (windows, places, WIDEST * CODE)."""
        code = self.codes[x].reshape(len(x), -1)
        view = np.lib.stride_tricks.sliding_window_view(code, WIDEST * CODE, axis=1)[:, ::CODE]
        return np.ascontiguousarray(view)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        columns = self._columns(x)
        made = (columns.reshape(-1, columns.shape[2]) @ self.conv).reshape(len(x), columns.shape[1], -1)
        return np.maximum(made.max(axis=1) + self.shift, 0), made, columns

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        logits = self.pooled(x)[0] @ self.out + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        hidden, made, columns = self.pooled(x)
        logits = hidden @ self.out + self.bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ self.out.T) * (hidden > 0)
        top = made.argmax(axis=1)  # (windows, filters)
        at = np.arange(len(x))[:, None]
        chosen = columns[at, top]  # (windows, filters, WIDEST * CODE)
        conv = np.einsum("nfc,nf->cf", chosen, back) * self.mask
        to_code = (back[:, :, None] * self.conv.T[None]).reshape(len(x), -1, WIDEST, CODE)
        bytes_at = x[at[:, :, None], top[:, :, None] + np.arange(WIDEST)]
        codes = np.zeros_like(self.codes)
        np.add.at(codes, bytes_at.ravel(), to_code.reshape(-1, CODE))
        return [codes, conv, back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> "ByteNet":
        rng, step = np.random.default_rng(seed), 0
        first, second = ([np.zeros_like(p) for p in self.parameters()] for _ in range(2))
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                part, step = order[i : i + batch], step + 1
                for p, g, m, v in zip(self.parameters(), self.gradients(x[part], y[part]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= (rate / (1 + epoch)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        return self

    def of_texts(self, texts: list[str]) -> np.ndarray:
        """Class probabilities of whole texts: the mean of the windows' log probabilities by the bytes they hold, made to sum to 1."""
        parts = [windows(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        x = np.concatenate(parts)
        weight = np.count_nonzero(x, axis=1) + 1.0
        logs = np.concatenate([self.log_probabilities(x[i : i + 64]) for i in range(0, len(x), 64)])
        total = np.stack([np.bincount(owner, logs[:, k] * weight, len(texts)) for k in range(logs.shape[1])], axis=1)
        p = np.exp(total / np.bincount(owner, weight, len(texts))[:, None])
        return p / p.sum(axis=1, keepdims=True)


def fit_languages(sample: DataFrame) -> tuple[list[str], ByteNet] | None:
    """Learned values and network from a bounded sample (``text``, ``lang``), fitted in one task.

    Of each text that has a letter all windows are learned from. Rows are learned in the order of their texts and values,
    so the model is the same however they are partitioned.
    """

    @frugal
    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted((text, lang) for f in frames for text, lang in zip(f["text"], f["lang"], strict=True) if has_letter(text))
        if not rows:
            return
        x, names = [], []
        for text, lang in rows:
            own = windows(text)
            x.append(own)
            names += [lang] * len(own)
        known = sorted(set(names))
        net = ByteNet(len(known)).fit(np.concatenate(x), np.searchsorted(known, names))
        yield pd.DataFrame({"known": [known], "net": [np.concatenate([p.ravel() for p in net.parameters()]).tolist()]})

    row = sample.repartition(1).mapInPandas(learn, "known array<string>, net array<double>").first()
    if row is None:
        return None
    net, at = ByteNet(len(row.known)), 0
    for p in net.parameters():
        p[:] = np.array(row.net[at : at + p.size], dtype=np.float32).reshape(p.shape)
        at += p.size
    return list(row.known), net


def sample_languages(docs: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """At most ``limit`` different rows with a language outside the held-out quarter: ``text`` and ``lang``.

    Repeated rows count once, so an id that a third of all rows have gives no more than its different texts.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out())
    known = known.select("doc_id", "lang", "text", F.xxhash64("text").alias("h"))
    chosen = known.select("doc_id", "lang", "h").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "h", "lang").limit(limit)
    return known.join(F.broadcast(chosen), ["doc_id", "lang", "h"]).groupBy("doc_id", "lang", "h").agg(F.min("text").alias("text")).select("text", "lang")


def identify_languages(docs: DataFrame, model: tuple[list[str], ByteNet] | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole text alone.

    A null text or one without a letter is ``und`` with score 0; so is every text if there was nothing to learn from.
    Values are the same however rows are partitioned; scores to about 1e-6, for sums run over batches.
    Rows keep their columns (one named ``lang_pred`` or ``score`` is replaced) and repeated rows stay.
    """

    @frugal
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("__text")]
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            some = [i for i, t in enumerate(texts) if model and has_letter(t)]
            for low in range(0, len(some), 64):
                part = some[low : low + 64]
                p = model[1].of_texts([texts[i] for i in part])
                for i, k, best in zip(part, p.argmax(axis=1), p.max(axis=1), strict=True):
                    langs[i], scores[i] = model[0][k], float(best)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "lang_pred", "score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    fields = docs.select(kept).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return docs.select(*kept, F.col(text_col).alias("__text")).mapInArrow(predict, fields)
