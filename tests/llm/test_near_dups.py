"""Near-duplicates against all pairs, components against a union-find, and edge rows."""

import random
from functools import partial
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import near_dups
from millrace.llm.common import wide_join
from millrace.llm.near_dups import components, drop_near_duplicates, near_duplicates, shingle_set
from tests.helpers import rows


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def edited(base, share, seed):
    rng = random.Random(seed)
    return [f"x{seed}{i}" if rng.random() < share else w for i, w in enumerate(base)]


def shingles(text, size):
    w = (text or "").encode().lower().split()
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*[w[i:] for i in range(size)]))


def expected(docs, percent=80, size=5):
    """doc_id -> (n_shingles, component_id) by comparing all pairs of documents."""
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("percent, size", [(80, 5), (85, 3)])
def test_links_are_those_of_all_pairs(spark, monkeypatch, percent, size):
    monkeypatch.setattr(near_dups, "BLOCK", 20)
    monkeypatch.setattr(near_dups, "wide_join", partial(wide_join, few=0))
    texts = []
    for group in range(6):
        base = words(120, group)
        texts += [" ".join(edited(base, share, 100 * group + k)) for k, share in enumerate([0, 0.01, 0.02, 0.03, 0.06, 0.2])]
    # One large group around a text that is close to all, while they are less close to each other.
    base = words(200, 77)
    texts += [" ".join(edited(base, 0.012 * (1 + k % 4), 9000 + k)) for k in range(90)]
    texts += [" ".join(base), "One two THREE", "one two three", "a b", "A  b", "a", " ", "", "\t\n"]
    docs = [(3 * i + 5, t) for i, t in enumerate(texts)]
    random.Random(1).shuffle(docs)
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], "doc_id long, text string, set_id string, root int")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, percent, size).collect()}
    assert found == expected(docs, percent, size)


def test_edge_rows(spark):
    long = " ".join(words(30_000, 5))
    df = spark.createDataFrame(
        [(1, long), (2, long + " end"), (2, long + " end"), (None, long), (None, "no one else"), (None, None),
         (7, None), (8, ""), (9, "same id"), (9, "other text of it")],
        "doc_id long, text string",
    )
    assert rows(near_duplicates(df), "doc_id", "component_id", "kept") == sorted(
        [(1, 1, True), (2, 1, False), (2, 1, False), (None, 1, False), (None, None, True),
         (None, None, True), (7, 7, True), (8, 8, True), (9, 9, True), (9, 9, True)], key=repr,
    )
    assert near_duplicates(df.where("false")).collect() == []


def test_one_of_each_group_stays(spark):
    base = words(100, 3)
    df = spark.createDataFrame(
        [(4, " ".join(base), "a"), (2, " ".join(base[:-1]), "b"), (9, "short one", "c"), (None, "no id", "d")],
        "doc_id long, text string, kept string",
    )
    assert rows(drop_near_duplicates(df), "doc_id", "kept") == [(2, "b"), (9, "c"), (None, "d")]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_pairs_within_the_distance_share_a_bucket():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 2**16, 40)
        b = a.copy()
        b[rng.choice(40, near_dups.MAX_DISTANCE, replace=False)] ^= 1
        wrong = (a != b).reshape(near_dups.CHUNKS, near_dups.LANES).sum(axis=1)
        assert wrong.min() <= 1


def test_shingles_lower_ascii_only():
    memory = near_dups.WordHashes()
    assert list(shingle_set("A B C".encode(), memory, 3)) == list(shingle_set("a\x0bb\x0cc".encode(), memory, 3))
    assert list(shingle_set("É b c".encode(), memory, 3)) != list(shingle_set("é b c".encode(), memory, 3))
    assert len(shingle_set("a b c".encode(), memory, 3)) == 1  # a no-break space does not end a word
