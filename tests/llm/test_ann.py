import numpy as np
import pytest

from lapsewise.llm import ann
from lapsewise.llm.queries import op3_ann

SCHEMA = "vec_id long, embedding array<float>, cell long, block string"


def brute(ids, vectors, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((vectors - vectors[ids.index(q)]) ** 2).sum(axis=1))
        out[q] = sorted((x, i) for i, x in zip(ids, d) if i != q)[:k]
    return out


def test_hadamard_is_orthogonal():
    h = ann.hadamard(np.eye(16)) / 4
    assert np.allclose(h @ h.T, np.eye(16))
    x = np.random.default_rng(0).normal(size=(50, 20))
    assert np.allclose(np.linalg.norm(ann.rotated(x, 1), axis=1), 1)


def test_probing_every_cell_is_exact(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 6)).astype(np.float32).astype(float)
    vectors[100:160] = vectors[100]  # a very common vector: ties
    rows = [(k, v.tolist(), 1, None) for k, v in enumerate(vectors)]
    bad = [(1000, None, 1, None), (1001, [0.0] * 6, 1, None), (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, None), (1003, [float("nan")] * 6, 1, None),
           (1004, [float("inf")] * 6, 1, None), (1005, [], 1, None), (None, [1.0] * 6, 1, None), (1100, [1.0, 2.0], 1, None)]
    frame = spark.createDataFrame(rows + bad, SCHEMA).repartition(3).select("vec_id", "embedding")
    got = ann.nearest(frame, frame.where("vec_id % 50 = 0"), probes=16, block=32).collect()
    expected = brute(list(range(300)), vectors, range(0, 300, 50))
    for q, best in expected.items():
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [i for _, i, _ in own] == [i for _, i in best]
        assert np.allclose([s for _, _, s in own], [x for x, _ in best], rtol=1e-14, atol=0)
        assert [r for r, _, _ in own] == list(range(1, 11))
    assert {r.query_id for r in got} == set(expected)


@pytest.mark.parametrize("spread", [0.0, 0.01])
def test_repeated_rows_of_one_id_take_one_place(spark, spread):
    rng = np.random.default_rng(2)
    vectors = np.array([5.0, 3.0, 1.0, 0.0, 0.0, 0.0]) + 0.2 * rng.normal(size=(40, 6))  # they share cells
    vectors[1] = vectors[0] + 0.01
    again = vectors[1] + spread * rng.normal(size=(20, 6))
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(1, v.tolist()) for v in again]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(frame, frame.where("vec_id = 0"), probes=16).orderBy("rank").collect()
    near = {1: min(np.linalg.norm(np.array([vectors[1], *again]) - vectors[0], axis=1))}
    best = sorted((near.get(k, np.linalg.norm(v - vectors[0])), k) for k, v in enumerate(vectors) if k)[:10]
    assert [r.vec_id for r in got] == [k for _, k in best]
    assert np.allclose([r.score for r in got], [d for d, _ in best])


@pytest.mark.parametrize("kind", ["twelve", "cluster"])
def test_every_query_gets_ten_or_all_candidates(spark, kind):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(12, 64))
    if kind == "cluster":  # and one vector opposite to it
        vectors = vectors[0] + 0.1 * rng.normal(size=(400, 64))
        vectors[0] = -vectors[0]
    odd = rng.normal(size=(4, 5))  # of another length: 3 candidates each
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(1000 + k, v.tolist()) for k, v in enumerate(odd)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wanted = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    got = ann.nearest(frame, frame.where("vec_id < 12 or vec_id >= 1000")).collect()
    for q in wanted:
        own = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
        assert [r for r, _ in own] == list(range(1, 11))
    for q, best in (brute(list(range(len(vectors))), vectors, [0] if kind == "cluster" else []) | brute(list(range(1000, 1004)), odd, range(1000, 1004))).items():
        assert [i for _, i in sorted((r.rank, r.vec_id) for r in got if r.query_id == q)] == [i for _, i in best]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(frame, frame).collect() == []


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall_of_the_query(spark, sf):
    rows = op3_ann(spark, f"/root/testdata/sf{sf}").collect()
    table = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").where("embedding is not null").collect()
    ids = [r.vec_id for r in table]
    expected = brute(ids, np.array([r.embedding for r in table], float), [i for i in ids if i % 100 == 0])
    got = {q: {r.vec_id for r in rows if r.query_id == q} for q in expected}
    hits = sum(len(got[q] & {i for _, i in best}) for q, best in expected.items())
    recall = hits / sum(map(len, expected.values()))
    print(f"sf{sf}: recall {recall:.3f}")
    assert recall >= 0.9
