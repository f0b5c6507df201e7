"""Embedding links against all pairs, the hash against its stated chances, and edge rows."""

import numpy as np
import pytest

from millrace.llm import embedding_dups
from millrace.llm.embedding_dups import MAX_SIGNS, near_embeddings, probe_keys, sign_words
from tests.helpers import rows


def at_cosine(base, cosine, rng):
    """Unit vectors at a cosine of the unit rows of ``base``."""
    other = rng.standard_normal(base.shape)
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return cosine * base + np.sqrt(1 - cosine**2) * other


def unit(rng, n, width=64):
    x = rng.standard_normal((n, width))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def expected(data, cosine=0.95):
    """(vec_id, n_links, component_id, kept) by all pairs; ids are distinct."""
    ids, v = [i for i, _ in data], np.array([x for _, x in data], float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= cosine
    np.fill_diagonal(near, False)
    root = np.array(ids)
    while True:
        low = np.array([min([root[i], *root[near[i]]]) for i in range(len(ids))])
        if (low == root).all():
            break
        root = low
    return [(i, int(n), int(r), i == r) for i, n, r in zip(ids, near.sum(1), root)]


@pytest.mark.parametrize("width", [64, 100])
def test_stated_chances(width):
    rng = np.random.default_rng(1)
    a = unit(rng, 4000, width)
    b = at_cosine(a, 0.95, rng)
    x, y = probe_keys(a), probe_keys(b)
    met = (x[:, :, :1] == y).any(2) | (y[:, :, :1] == x).any(2)
    assert met.mean() > 0.5 and met.any(1).mean() > 0.999
    differ = np.bitwise_count((sign_words(a) ^ sign_words(b)).view(np.uint64)).sum(1)
    assert differ.mean() < 15 and (differ <= MAX_SIGNS).all()
    apart = probe_keys(unit(rng, 4000, width))
    assert (x[:, :, :1] == apart).any(2).mean() < 0.001


def test_links_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "BLOCK", 12)
    rng = np.random.default_rng(2)
    centres = unit(rng, 8)
    parts = [unit(rng, 150)]
    parts += [at_cosine(np.repeat(centres[[k]], 12, 0), c, rng) for k, c in enumerate([0.999, 0.99, 0.98, 0.97, 0.965, 0.96])]
    parts.append(at_cosine(np.repeat(centres[[7]], 120, 0), 0.985, rng) * 7)  # one hot group, not of unit length
    v = np.concatenate(parts)
    data = [(int(i), x.tolist()) for i, x in zip(rng.permutation(len(v)) + 5, v)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(6)
    want = expected(data)
    got = rows(near_embeddings(df))
    assert sum(w[1] for w in want) > 2000
    assert got == sorted(want, key=repr)


def test_a_chain_is_one_component(spark):
    angles = np.arccos(0.96) * np.arange(30)
    data = [(100 - i, [float(np.cos(x)), float(np.sin(x)), 0.0]) for i, x in enumerate(angles[:9])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows(near_embeddings(df)) == sorted(expected(data), key=repr)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
        (7, [1.0, 2.0], 1), (9, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (None, [-1.0, -2.0], 1), (None, [-1.0, -2.0], 2),
        (10, [1e300, 2e300], 1), (11, [5e-324, 1e-323], 1), (12, [1.0, 2.0, 0.0], 1), (13, [0.0, 1.0, 0.0], 1),
        (14, [-0.0, 1.0, 0.0], 1), (None, None, 1),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, n_links long")
    got = rows(near_embeddings(df))
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 12, None)]
    same = [(7, 4, 7, True), (9, 4, 7, False), (9, 4, 7, False), (10, 4, 7, False), (11, 4, 7, False)]
    pair = [(13, 1, 13, True), (14, 1, 13, False)]
    assert got == sorted([*alone, *same, *pair, (None, 1, None, True), (None, 1, None, True)], key=repr)
    assert near_embeddings(df.where("false")).collect() == []
    floats = df.select("vec_id", df["embedding"].cast("array<float>").alias("embedding")).where("vec_id IN (7, 9)")
    assert rows(near_embeddings(floats), "n_links") == [(2,)] * 3


def test_many_equal_vectors_are_one_node(spark):
    data = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(3000)] + [(9000, [1.0, 2.0, 3.0, 4.1]), (9001, [-1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(7)
    got = rows(near_embeddings(df))
    assert got == sorted([(i, 3000, 0, i == 0) for i in [*range(3000), 9000]] + [(9001, 0, 9001, True)], key=repr)
