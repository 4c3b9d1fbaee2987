"""Embedding near-dedup: inverted lists with product-quantised residuals propose, exact cosines decide."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..tables import discard, materialise

#: Vectors that the codebooks are fitted on at most, those first by a hash of the id.
SAMPLE = 20_000
SUBSPACES, WORDS = 8, 64
#: Vectors of a list on average, and lists at most.
LIST_SIZE, LISTS = 8000, 1024
#: Members and probes of one comparison block.
BLOCK = 1024
SEED = 5


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * (x @ centres.T), 0)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres).argmin(1)
        size = np.bincount(own, minlength=len(centres))
        for j in np.flatnonzero(size):
            centres[j] = x[own == j].mean(0)
    return centres


class Codebook:
    """Coarse centres, and for each subspace the words of the residuals."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.centres = k_means(sample, lists)
        residual = sample - self.centres[_nearest(sample, self.centres).argmin(1)]
        self.edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.words = [k_means(residual[:, a:b], WORDS, seed=SEED + a) for a, b in zip(self.edges, self.edges[1:], strict=False)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List of each vector, its codes, and how far the decoded vector is from it."""
        own = _nearest(x, self.centres).argmin(1)
        residual = x - self.centres[own]
        codes, error = [], np.zeros(len(x))
        for (a, b), words in zip(zip(self.edges, self.edges[1:], strict=False), self.words, strict=True):
            d = _nearest(residual[:, a:b], words)
            codes.append(d.argmin(1))
            error += ((residual[:, a:b] - words[codes[-1]]) ** 2).sum(1)
        return own, np.stack(codes, axis=1), np.sqrt(error)

    def probes(self, x: np.ndarray, radius: float) -> np.ndarray:
        """For each vector, the lists that can hold a vector within ``radius``.

        Such a vector lies on the far side of the plane halfway between its own centre and each other centre, so the
        probing vector is at most ``radius`` on the near side of every such plane.
        """
        d = _nearest(x, self.centres)
        apart = np.sqrt(_nearest(self.centres, self.centres))
        np.fill_diagonal(apart, 1.0)
        own = d.argmin(1)
        out = (d - d.min(1)[:, None]) / (2 * apart[own]) <= radius + 1e-9  # by the plane to the own centre first
        for j in range(len(self.centres)):
            some = np.flatnonzero(out[:, j])
            gap = (d[some][:, [j]] - d[some]) / (2 * apart[j])  # how far x is on the side of each other centre
            out[some, j] = (gap <= radius + 1e-9).all(axis=1)
        return out

    def table(self, x: np.ndarray, j: int) -> list[np.ndarray]:
        """Squared distances of each vector's residual to list ``j`` from every word, by subspace."""
        residual = x - self.centres[j]
        return [_nearest(residual[:, a:b], w) for (a, b), w in zip(zip(self.edges, self.edges[1:], strict=False), self.words, strict=True)]


def fit_codebook(vectors: DataFrame, lists: int, sample: int = SAMPLE) -> Codebook | None:
    """Fitted in one task on the unit vectors of a bounded sample that have the most common length among it."""

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [np.asarray(v, dtype=np.float64) for f in frames for v in f["u"]]
        if not rows:
            return
        lengths = [len(r) for r in rows]
        dim = max(sorted(set(lengths)), key=lengths.count)
        x = np.stack([r for r in rows if len(r) == dim])
        book = Codebook(x[np.lexsort(x.T[:4])], lists)
        yield pd.DataFrame({"centres": [book.centres.ravel().tolist()], "words": [[w.ravel().tolist() for w in book.words]], "dim": [dim]})

    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("u").repartition(1)
    row = chosen.mapInPandas(learn, "centres array<double>, words array<array<double>>, dim long").first()
    if row is None:
        return None
    book = Codebook.__new__(Codebook)
    book.centres = np.array(row.centres).reshape(-1, row.dim)
    book.edges = np.linspace(0, row.dim, min(SUBSPACES, row.dim) + 1).astype(int)
    book.words = [np.array(w).reshape(-1, b - a) for w, a, b in zip(row.words, book.edges, book.edges[1:], strict=False)]
    return book


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``id``, ``label``, ``u`` (the vector at length 1, in doubles) and ``fp``, its fingerprint; rows that can link with nothing are left out."""

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, units, prints = [], [], []
            for i, v in enumerate(batch.column(2)):
                x = np.array(v.as_py(), dtype=np.float64) if v.is_valid else np.empty(0)  # a null component becomes NaN
                if len(x) and np.isfinite(x).all() and x.any():
                    x /= np.abs(x).max()
                    x /= np.sqrt((x * x).sum())
                    kept.append(i)
                    units.append(x)
                    prints.append(xxhash.xxh3_128_digest((x + 0.0).tobytes()))
            some = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(units, pa.list_(pa.float64())), pa.array(prints, pa.binary())], ["id", "label", "u", "fp"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("x"))
    return rows.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").mapInArrow(normalise, "id long, label string, u array<double>, fp binary")


def embedding_near_dedup(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", sample: int = SAMPLE) -> DataFrame:
    """Links between vectors of the same label with a cosine of at least ``threshold``, and their components.

    One row for each id: ``id``, ``n_links``, ``component_id`` (smallest id reachable, itself included), ``kept``.

    Vectors that point the same way exactly collapse into one, with a count. Each distinct vector is a member of one
    list, with its codes and how far they are off, and probes every list that can hold a partner, which the geometry of
    the centres tells, so no link is lost.
    Inside a list, table look-ups give the distance from the probe to the decoded member; members further than the
    radius plus their own decoding error leave, and exact cosines decide on the rest. Large lists are dealt into blocks
    of members and blocks of probes; a block hands on counts and a spanning forest.

    Vectors that are null, empty or zero or hold null or non-finite components, and rows with a null label, have no
    links; an empty table gives an empty result. Vectors of another length than the codebook's are compared in one list of their length. Rows that share an id
    count as one vertex with the links of all of them; a null id has null results. Other columns are ignored.
    """
    units = materialise(unit_vectors(vectors, id_col, vec_col, label_col), "units")
    distinct = units.groupBy("label", "fp").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("copies"), F.first("u").alias("u"))
    distinct = materialise(distinct.select("label", "fp", "u", F.col("rep").alias("id"), "copies"), "distinct-units")
    book = fit_codebook(distinct, min(LISTS, max(4, distinct.count() // LIST_SIZE)), sample)
    radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lists, probes, codes, errors = ([None] * len(frame) for _ in range(4))
            fits = np.array([book is not None and len(u) == book.centres.shape[1] for u in frame["u"]], dtype=bool)
            if fits.any():
                x = np.stack(frame["u"][fits].to_numpy())
                own, code, error = book.encode(x)
                near = book.probes(x, radius)
                for i, j, row, c, e in zip(np.flatnonzero(fits), own, near, code.astype(np.uint8), error, strict=True):
                    lists[i], probes[i] = int(j), np.flatnonzero(row | (np.arange(len(row)) == j)).tolist()
                    codes[i], errors[i] = c.tobytes(), float(e)
            for i in np.flatnonzero(~fits):
                lists[i] = -len(frame["u"].iloc[i])
                probes[i] = [lists[i]]
            yield frame[["id", "label", "u", "copies"]].assign(list=lists, probes=probes, codes=codes, error=errors)

    listed = materialise(distinct.mapInPandas(assign, "id long, label string, u array<double>, copies long, list int, probes array<int>, codes binary, error double"), "lists")
    sizes = listed.groupBy("label", "list").agg(F.count("*").alias("members"))
    asked = listed.select("label", F.explode("probes").alias("list")).groupBy("label", "list").agg(F.count("*").alias("asking"))
    blocks = sizes.join(asked, ["label", "list"]).select("label", "list", F.ceil(F.col("members") / BLOCK).alias("mb"), F.ceil(F.col("asking") / BLOCK).alias("pb"))
    blocks = F.broadcast(blocks) if blocks.count() <= 100_000 else blocks
    members = listed.select("id", "label", "u", "copies", "list", "codes", "error").join(blocks, ["label", "list"]).withColumn("m", F.pmod(F.xxhash64("id"), "mb")).withColumn("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pb") - 1)))
    probing = listed.select("id", "label", "u", F.explode("probes").alias("list")).join(blocks, ["label", "list"]).withColumn("p", F.pmod(F.xxhash64("id", F.lit(1)), "pb")).withColumn("m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """left: probes, right: members."""
        rep, other, count = [], [], []
        if len(left) and len(right):
            x, y = np.stack(left["u"].to_numpy()), np.stack(right["u"].to_numpy())
            x_ids, y_ids, copies, j = left["id"].to_numpy(), right["id"].to_numpy(), right["copies"].to_numpy(), int(right["list"].iloc[0])
            if j >= 0 and book is not None:
                codes = np.frombuffer(b"".join(right["codes"]), dtype=np.uint8).reshape(len(y), -1)
                error = right["error"].to_numpy()
                near = np.zeros((len(x), len(y)))
                for s, t in enumerate(book.table(x, j)):
                    near += t[:, codes[:, s]]
                near = np.sqrt(near) <= radius + error[None] + 1e-6
            else:
                near = np.ones((len(x), len(y)), dtype=bool)
            a, b = np.nonzero(near & (x_ids[:, None] != y_ids[None]))
            linked = np.zeros(near.shape, dtype=bool)
            for low in range(0, len(a), 65536):
                i, k = a[low : low + 65536], b[low : low + 65536]
                linked[i, k] = np.einsum("nd,nd->n", x[i], y[k]) >= threshold
            total = linked @ copies
            some = total > 0
            rep, other, count = x_ids[some].tolist(), [None] * int(some.sum()), total[some].tolist()
            seen_x, seen_y = np.zeros(len(x), bool), np.zeros(len(y), bool)
            for root in np.flatnonzero(some):  # breadth first over probes and members in turn
                if seen_x[root]:
                    continue
                seen_x[root], todo = True, [root]
                while todo:
                    i = todo.pop()
                    for k in np.flatnonzero(linked[i] & ~seen_y):
                        seen_y[k] = True
                        rep.append(x_ids[i]), other.append(y_ids[k]), count.append(0)
                        for i2 in np.flatnonzero(linked[:, k] & ~seen_x):
                            seen_x[i2] = True
                            todo.append(i2)
                            rep.append(x_ids[i2]), other.append(y_ids[k]), count.append(0)
        return pd.DataFrame({"rep": pd.array(rep, "Int64"), "other": pd.array(other, "Int64"), "links": pd.array(count, "Int64")})

    keys = ["label", "list", "m", "p"]
    renamed = lambda df, *more: df.select(*(F.col(c).alias(c) for c in (*keys, "id", "u", *more)))  # noqa: E731  both come from the same tables
    found = renamed(probing).groupBy(keys).cogroup(renamed(members, "copies", "codes", "error").groupBy(keys)).applyInPandas(compare, "rep long, other long, links long")
    found = materialise(found, "vector-links")
    discard(listed)
    linked = found.where("other is null").groupBy(F.col("rep").alias("id")).agg(F.sum("links").alias("links"))
    merged = connected_components(found.where("other is not null"), "rep", "other")
    per = distinct.join(linked, "id", "left").join(merged, "id", "left").select("label", "fp", F.coalesce("component", "id").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    each = units.select("id", "label", "fp").distinct().join(per, ["label", "fp"]).groupBy("id").agg(F.min("component").alias("component"), F.sum("links").alias("links"))
    out = vectors.select(F.col(id_col).cast("long").alias("id")).distinct().join(each, "id", "left")
    out = out.select("id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id") == F.col("component_id"))
