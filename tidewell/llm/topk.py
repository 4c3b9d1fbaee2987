"""Exact top-k inner products with bounds from segment means and deviations, coarse to fine."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Candidates of a block, and queries of a block.
BLOCK, QUERY_BLOCK = 4096, 4096
#: Segments of a vector at each resolution.
LEVELS = (1, 8, 32)
#: Vectors that the axes are fitted on, and that give each query its first floor, at most.
SAMPLE = 4096


def quantised(vectors: DataFrame, vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``q``: floor(scale * component) of every vector, at most what 64 bits hold.

    Vectors that are null or empty or hold null or non-finite components are left out.
    """
    x = F.col(vec_col)
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return vectors.where(x.isNotNull() & (F.size(x) > 0) & finite).withColumn("q", F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(scale)).cast("long"))).drop(vec_col)


def _statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each segment, each times the root of its length; a last segment may be shorter."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    length = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / length
    square = np.add.reduceat(x * x, edges[:-1], axis=1) / length
    root = np.sqrt(length)
    return mean * root, np.sqrt(np.maximum(square - mean * mean, 0)) * root


def fit_axes(sample: DataFrame) -> np.ndarray | None:
    """Principal axes of a bounded sample of ``q``, as columns, fitted in one task for the most common length.

    Turned to these axes, vectors keep their inner products, and what sets them apart comes first: the segments' means and
    deviations then tell more of it.
    """

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [np.asarray(v, dtype=np.float64) for f in frames for v in f["q"]]
        if rows:
            lengths = [len(r) for r in rows]
            dim = max(sorted(set(lengths)), key=lengths.count)
            x = np.stack([r for r in rows if len(r) == dim])
            x /= max(1.0, np.abs(x).max())
            axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
            yield pd.DataFrame({"axes": [axes.ravel().tolist()]})

    row = sample.select("q").coalesce(1).mapInPandas(learn, "axes array<double>").first()
    return None if row is None else np.array(row.axes).reshape(int(len(row.axes) ** 0.5), -1)


def best_of_block(q: np.ndarray, x: np.ndarray, x_ids: np.ndarray, q_ids: np.ndarray, k: int, axes: np.ndarray | None = None, floors: np.ndarray | None = None, left_at: list | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its ``k`` best (ids, scores) among a block, larger scores first and then smaller ids.

    For two vectors, the sum over segments of (product of means + product of deviations) * length bounds the inner
    product from above and is the inner product of the statistics. It bounds the distance from below alike, since the
    lengths of the vectors are known. Candidates under the floor leave level by level: the k-th exact score of a first
    guess, or of ``floors``, what a sample gave. A block whose best bound is under a query's floor is left at once.
    ``left_at`` takes how many are left at each level.
    """
    small = max(float(np.abs(q).max()), float(np.abs(x).max())) ** 2 * x.shape[1] < 2.0**52
    exact_x, exact_q = (x.astype(np.float64), q.astype(np.float64)) if small else (x, q)
    fx, fq = x.astype(np.float64), q.astype(np.float64)
    if axes is not None and axes.shape[0] == x.shape[1]:
        fx, fq = fx @ axes, fq @ axes
    levels = []
    for s in LEVELS:
        (mx, dx), (mq, dq) = _statistics(fx, s), _statistics(fq, s)
        levels.append((np.concatenate([mx, dx], axis=1), np.concatenate([mq, dq], axis=1)))
    slack = 1e-9 * (np.linalg.norm(fx, axis=1).max() * np.linalg.norm(fq, axis=1) + 1)
    fine_x, fine_q = levels[-1]
    for i in range(len(q)):
        bound = levels[0][0] @ levels[0][1][i]
        floor = -np.inf if floors is None else floors[i]
        if bound.max() < floor - slack[i]:
            continue
        if len(x) > 8 * k + 64:
            # A first guess: the exact scores of those that look best at the finest level among a few hundred of the coarsest.
            some = np.argpartition(-bound, 8 * k + 63)[: 8 * k + 64]
            look = some[np.argsort(-(fine_x[some] @ fine_q[i]))[: 4 * k + 1]]
            look = look[x_ids[look] != q_ids[i]]
            known = np.sort(exact_x[look] @ exact_q[i])
            floor = max(floor, known[-k] if len(known) >= k else -np.inf)
        floor -= slack[i]
        left = np.flatnonzero(bound >= floor)
        counts = [len(left)]
        for sx, sq in levels[1:]:
            left = left[sx[left] @ sq[i] >= floor]
            counts.append(len(left))
        if left_at is not None:
            left_at.append(counts)
        left = left[x_ids[left] != q_ids[i]]
        scores = exact_x[left] @ exact_q[i]
        order = np.lexsort((x_ids[left], -scores))[:k]
        yield i, x_ids[left][order], scores[order].astype(np.int64)


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id") -> DataFrame:
    """The ``k`` largest integer inner products of each query with all other vectors: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``vectors`` and ``queries`` hold an id and ``q``, an array of integers. A bounded sample of the vectors gives the axes
    and each query a floor. The stated queries go in blocks to blocks of all vectors; every pair of blocks keeps at most
    ``k`` rows for a query, and a window takes the best of these. Ties go to the smaller id.

    Only vectors of the query's own length are compared, and no row with the query's own id. Null ids take no part.
    Repeated rows of an id are candidates each; as queries they count once (the first in order of q). Sums beyond 64 bits
    wrap around. Other columns, whatever their names, are ignored; an empty table gives an empty result.
    """
    q = queries.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min("q").alias("q"))
    x = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), "q")
    n, m = x.count(), q.count()
    blocks, query_blocks = -(-n // BLOCK) or 1, -(-m // QUERY_BLOCK) or 1
    sample = x.orderBy(F.xxhash64("id", "q"), "id").limit(SAMPLE)
    axes = fit_axes(sample)
    sized = lambda df: df.withColumn("dim", F.size("q"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        if len(left) and len(right):
            a, b = np.stack(left["q"].to_numpy()), np.stack(right["q"].to_numpy())
            q_ids = left["id"].to_numpy()
            floors = left["floor"].fillna(-np.inf).to_numpy(np.float64) if "floor" in left else None
            for i, ids, scores in best_of_block(a, b, right["id"].to_numpy(), q_ids, k, axes, floors):
                found.append((np.full(len(ids), q_ids[i]), ids, scores))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    result = "query_id long, vec_id long, score long"
    dealt = sized(q).withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    some = sized(sample).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    first = dealt.groupBy("qb", "dim").cogroup(some.groupBy("qb", "dim")).applyInPandas(search, result)
    floors = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
    asked = dealt.join(floors, "id", "left").withColumn("xb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    held = sized(x).withColumn("xb", F.pmod(F.xxhash64("id", "q"), F.lit(blocks))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    keys = ["xb", "qb", "dim"]
    part = asked.groupBy(keys).cogroup(held.groupBy(keys)).applyInPandas(search, result)
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
