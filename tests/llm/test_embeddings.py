import numpy as np
import pytest

from topicflow.llm import embeddings as E


def rows(count, seed=1):
    r = np.random.default_rng(seed)
    base = r.normal(size=(count, 16))
    near = base[: count // 2] + r.normal(size=(count // 2, 16)) * 0.25
    group = base[7] + r.normal(size=(count, 16)) * 0.05
    vectors = [*base, *near, *group, *([base[3]] * 30)]
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]


ODD = [
    (9000, None), (9001, [0.0] * 16), (9002, [float("nan")] + [1.0] * 15), (9003, [None] + [1.0] * 15),
    (9004, []), (9005, [1.0, 2.0]), (9006, [2.0, 4.0]), (9007, [float("inf")] + [1.0] * 15),
]


@pytest.mark.parametrize("block", [1024, 16])
def test_links_and_components_are_those_of_brute_force(spark, block):
    data = rows(60)
    df = spark.createDataFrame([(*r, "x") for r in data + ODD], "vec_id bigint, embedding array<float>, label string")
    found = {r.vec_id: r for r in E.near_duplicates(df, block=block).collect()}
    assert len(found) == len(data) + len(ODD)
    x = np.array([v for _, v in data], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    got = np.array([found[i].n_links for i, _ in data])
    assert (got <= linked.sum(1)).all() and got.sum() >= 0.9 * linked.sum()
    roots = E._roots(linked)
    assert np.mean([found[i].component_id == roots[i] for i, _ in data]) > 0.95
    assert all(found[i].kept == (found[i].component_id == i) for i in found)
    for i in (9000, 9001, 9002, 9003, 9004, 9007):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert (found[9005].n_links, found[9006].component_id) == (1, 9005)


def test_recall_at_the_threshold():
    r = np.random.default_rng(0)
    a = r.normal(size=(800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = r.normal(size=a.shape)
    o -= (o * a).sum(1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * o
    hashes = E.hashes_for(51_000, 64)
    x, y = E.buckets(a, E.TABLES, hashes), E.buckets(b, E.TABLES, hashes)
    assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= 0.95


@pytest.mark.parametrize("vectors, hashes", [(51_000, 3), (2_000_000, 4), (117_000_000, 5)])
def test_recall_does_not_fall_with_the_number_of_vectors(vectors, hashes):
    assert E.hashes_for(vectors, 64) == hashes
    tables = E.tables_for(hashes, 64)
    r = np.random.default_rng(4)
    a, o = r.normal(size=(2, 800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o -= (o * a).sum(1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    x, y = (E.buckets(v, tables, hashes) for v in (a, 0.9 * a + np.sqrt(1 - 0.81) * o))
    recall = (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean()
    print(hashes, tables, recall)
    assert recall >= 0.96


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(2).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(E.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(E.hadamard(E.hadamard(x)), x)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert E.near_duplicates(df).count() == 0
