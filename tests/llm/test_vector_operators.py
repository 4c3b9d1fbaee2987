import numpy as np
import pytest

pytest.importorskip("tidewell.llm")

from tidewell.llm import pq, topk  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, rank int"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = [(i, rng.normal(size=16).tolist(), i % 3, 0) for i in range(600)]
    hub = rng.normal(size=16)
    out += [(600 + i, (hub + rng.normal(size=16) * 0.05).tolist(), 1, 0) for i in range(300)]
    out += [(900, out[5][1], 5 % 3, 0), (901, [2 * x for x in out[5][1]], 5 % 3, 0), (902, None, 1, 0), (903, [0.0] * 16, 1, 0), (904, [float("nan")] * 16, 1, 0), (905, [None] * 16, 1, 0)]
    out += [(906, out[5][1], None, 0), (907, [1.0, 2.0], 1, 0), (908, [2.0, 4.0], 1, 0), (909, [], 1, 0), (910, [float("inf")] + [0.0] * 15, 1, 0), (911, [3e38] + [0.0] * 15, 2, 0)]
    return out


def _fits(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def test_top_k_equals_brute_force(spark, rows):
    rows = [r for r in rows if r[0] != 911]
    vectors = topk.quantised(spark.createDataFrame(rows, SCHEMA))
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0")).collect()]
    q = {i: np.floor(256 * np.asarray(v, dtype=np.float32).astype(float)).astype(int) for i, v, *_ in rows if _fits(v)}
    want = []
    for a in q:
        if a % 50 == 0:
            best = sorted((-int(q[a] @ q[b]), b) for b in q if b != a and len(q[b]) == len(q[a]))[:5]
            want += [(a, k + 1, b, -s) for k, (s, b) in enumerate(best)]
    assert sorted(got) == sorted(want)


def test_top_k_over_many_blocks(spark, rows, monkeypatch):
    rows = [r for r in rows if r[0] != 911]
    one = topk.quantised(spark.createDataFrame(rows, SCHEMA))
    want = sorted(map(tuple, topk.exact_top_k(one, one.where("vec_id % 50 = 0")).collect()))
    monkeypatch.setattr(topk, "BLOCK", 90)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "SAMPLE", 60)
    assert sorted(map(tuple, topk.exact_top_k(one.repartition(5), one.where("vec_id % 50 = 0")).collect())) == want
    twice = one.unionByName(one.where("vec_id IN (3, 50)")).withColumn("xb", one["label"])  # rows are candidates each
    got = topk.exact_top_k(twice, twice.where("vec_id = 50")).collect()
    plain = topk.exact_top_k(one, one.where("vec_id = 50"), k=900).collect()
    every = sorted([(-r.score, r.vec_id) for r in plain] + [(-r.score, r.vec_id) for r in plain if r.vec_id == 3])
    assert [(r.rank, -r.score, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(i + 1, *e) for i, e in enumerate(every[:5])]


def test_bounds_leave_few_where_vectors_have_a_shape():
    rng = np.random.default_rng(8)
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    x = np.floor(256 * (rng.normal(size=(3000, 64)) * 0.8 ** np.arange(64)) @ axes).astype(int)
    left: list = []
    turned = np.linalg.eigh(x.T.astype(float) @ x)[1][:, ::-1]
    for i, ids, scores in topk.best_of_block(x[:20], x, np.arange(3000), np.arange(20), 5, turned, None, left):
        want = sorted((-int(x[i] @ x[j]), j) for j in range(3000) if j != i)[:5]
        assert [(-s, j) for s, j in zip(scores.tolist(), ids.tolist(), strict=True)] == want
    assert np.mean([c[1] for c in left]) < 0.2 * 3000 and np.mean([c[2] for c in left]) < 0.02 * 3000


def test_top_k_with_ties_few_rows_and_large_values(spark):
    tied = spark.createDataFrame([(i, [1.0, 0.0], 0, 0) for i in range(8)] + [(50, [3e12, 1.0], 0, 0)], SCHEMA)
    vectors = topk.quantised(tied)
    got = topk.exact_top_k(vectors, vectors.where("vec_id = 0")).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [50, 1, 2, 3, 4]
    one = vectors.where("vec_id = 0")
    assert topk.exact_top_k(one, one).count() == 0 and topk.exact_top_k(one.limit(0), one.limit(0)).count() == 0


def test_near_dedup_equals_brute_force(spark, rows):
    again = [*rows, rows[5], rows[900]]  # repeated rows count once
    got = {r.id: r for r in pq.embedding_near_dedup(spark.createDataFrame(again, SCHEMA)).collect()}
    assert set(got) == {r[0] for r in rows}
    unit = {i: (np.asarray(v, dtype=np.float32).astype(float), label) for i, v, label, _ in rows if label is not None and _fits(v) and np.any(np.asarray(v, dtype=np.float32))}
    unit = {i: (v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()), label) for i, (v, label) in unit.items()}
    near = {i: [j for j in unit if j != i and unit[j][1] == unit[i][1] and len(unit[j][0]) == len(unit[i][0]) and unit[i][0] @ unit[j][0] >= 0.98] for i in unit}
    assert all(got[i].n_links == len(near.get(i, ())) for i in got)
    for i in got:
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert got[i].component_id == min(seen) and got[i].kept == (i == min(seen))


def test_near_dedup_over_many_lists_and_blocks(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, pq.embedding_near_dedup(df).collect()))
    monkeypatch.setattr(pq, "LIST_SIZE", 40)
    monkeypatch.setattr(pq, "BLOCK", 32)
    assert sorted(map(tuple, pq.embedding_near_dedup(df.repartition(5)).collect())) == want


def test_near_dedup_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pq.embedding_near_dedup(none).count() == 0
    assert [tuple(r) for r in pq.embedding_near_dedup(spark.createDataFrame([(1, None, 1, 0), (1, None, 1, 0)], SCHEMA)).collect()] == [(1, 0, 1, True)]
