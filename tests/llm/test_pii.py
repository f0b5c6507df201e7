"""Patterns against plain regular expressions, messages against exact marginals, and edge rows."""

import itertools
import random
import re

import numpy as np
import pytest

from millrace.llm.pii import (
    KINDS, LABELS, NONE, Graph, SkipChain, added_spans, base_spans, build_graph, find_pii, fit_skip_chain,
    hidden_recall,
)

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        n = int(c) * (2 if i % 2 else 1)
        total += n // 10 + n % 10
    return total % 10 == 0


def expected(text):
    good = [
        lambda m: True,
        lambda m: all(int(p) <= 255 for p in m.split(".")),
        lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15,
    ]
    return [(k, *m.span()) for k, p in enumerate(PLAIN) for m in p.finditer(text) if good[k](m.group())]


def test_patterns():
    rng = random.Random(7)
    parts = ["a", "Zed", "@", "@", ".", ".", "-", "_", "+", "%", " ", "1", "25", "255", "256", "0", "4111111111111111", "4111 1111-1111 1111",
             "(", ")", "+1 (415) 555-2671", "é", "\n", "x.y@mail.example.com", "10.0.0.1"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert base_spans(text) == expected(text), text


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" + "(" * 200_000, "1" * 100_000 + ".2.3.4"])
def test_long_texts_take_linear_time(text):
    base_spans(text)


@pytest.mark.parametrize("found, other", [
    ("+44 20 7946 0958", "020-7946-0958"), ("+1 415 555 2671", "4155552671"), ("+1 (415) 555-2671", "415-555-2671"),
])
def test_numbers_in_groups_are_tied_to_later_mentions(spark, found, other):
    text = f"call {found} by noon, " + "quiet words " * 30 + f"or else {other} later"
    base = base_spans(text)
    assert [text[a:b] for _, a, b in base] == [found]
    model = fit_skip_chain(spark.createDataFrame([(text,)], "text string"))
    (added,) = added_spans([build_graph(text, base)], model)
    assert [(KINDS[k], text[a:b]) for k, a, b in added] == [("phone", other)]


def small_model(rng):
    shapes, before, after = (np.log(rng.dirichlet(np.ones(LABELS), size=6)) for _ in range(3))
    chain, skip = (rng.normal(size=(LABELS, LABELS)) for _ in range(2))
    return SkipChain(np.full((LABELS, LABELS), -9.0) + 9 * np.eye(LABELS), shapes, before, after, chain + chain.T, skip + skip.T)


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(2)
    for _ in range(10):
        model = small_model(rng)
        graph = Graph(spans=[(i, i + 1) for i in range(4)], seen=[(1, 0, 2), (2, 2, 5), (3, 1, 1), (4, 0, 0)], labels=[NONE, 2, NONE, NONE], chain=[(0, 1), (1, 2)], skip=[(0, 3)])
        node = [
            model.shown[l] if l != NONE else model.shapes[s] + model.before[b] + model.after[a]
            for (s, b, a), l in zip(graph.seen, graph.labels)
        ]
        exact = np.zeros((4, LABELS))
        for y in itertools.product(range(LABELS), repeat=4):
            score = sum(n[k] for n, k in zip(node, y)) + sum(model.chain[y[a], y[b]] for a, b in graph.chain)
            score += sum(model.skip[y[a], y[b]] for a, b in graph.skip)
            for i, k in enumerate(y):
                exact[i, k] += np.exp(score)
        exact /= exact.sum(axis=1, keepdims=True)
        # Graphs of a batch do not touch each other.
        for belief in model.solve([graph, Graph(), graph], rounds=200)[::2]:
            got = np.exp(belief - belief.max(axis=1, keepdims=True))
            assert np.allclose(got / got.sum(axis=1, keepdims=True), exact, atol=2e-3)


TEXT = "Call +1 (415) 555-2671 or mail jane.doe9@corp.example.com now. Later 415-555-2671, and jane.doe9 again. Others: 415-555-2672, 4111111111111112."


def test_field_adds_similar_mentions(spark):
    docs = spark.createDataFrame([(1, TEXT), (2, "Call +1 (415) 555-2671."), (3, "x 10.0.0.1 y 10.0.0.1")], "doc_id long, text string")
    model = fit_skip_chain(docs)
    base = base_spans(TEXT)
    (added,) = added_spans([build_graph(TEXT, base)], model)
    assert [(KINDS[k], TEXT[a:b]) for k, a, b in added] == [("phone", "415-555-2671"), ("email", "jane.doe9")]


def corpus(spark):
    """Numbers after "order" are none, those after "dial" are telephone numbers, those after "paid" cards."""
    rng = random.Random(4)
    texts = []
    for i in range(60):
        n = rng.randrange(10**9, 10**10)
        texts.append(f"your order {n} shipped, dial +1 {rng.randrange(200, 999)} 555 {rng.randrange(1000, 9999)} tonight")
        digits = f"4{rng.randrange(10**14, 10**15 - 1)}"
        digits = next(digits[:15] + c for c in "0123456789" if luhn(digits[:15] + c))
        texts.append(f"paid {digits} already {' filler' * i}")
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def added(model, text):
    (spans,) = added_spans([build_graph(text, base_spans(text))], model)
    return [(KINDS[k], text[a:b]) for k, a, b in spans]


def test_field_decides(spark):
    docs = corpus(spark)
    model = fit_skip_chain(docs)
    # Declined: the last seven digits are those of a found number, but shape and neighbours are an order's.
    far = "dial +1 415 555 2671 tonight, and with many quiet words between "
    assert added(model, f"{far} your order 9205552671 shipped") == []
    assert added(model, f"{far} or 415.555.2671 later") == [("phone", "415.555.2671")]
    # Added without any tie: the right neighbours, in a shape that was never seen.
    assert added(model, "dial 415 555 2671 tonight") == [("phone", "415 555 2671")]
    assert added(model, "then 415 555 2671 came") == []
    # Two found kinds share the end of a mention: the shape of a card settles it.
    card = next(f"41111111{k}5552671" for k in range(10) if luhn(f"41111111{k}5552671"))
    text = f"dial +1 415 555 2671 tonight, paid {card} already, and 9 {card} at last"
    base = base_spans(text)
    assert [KINDS[k] for k, *_ in base] == ["card", "phone"]
    assert added(model, text) == [("card", card)]


def test_hidden_mentions_are_found_again(spark):
    docs = corpus(spark)
    model = fit_skip_chain(docs.where("doc_id % 5 <> 0"))
    got = {r["kind"]: (r["n"], r["right"], r["wrong"]) for r in hidden_recall(docs.where("doc_id % 5 = 0"), model).collect()}
    assert got["phone"] == (12, 12, 0) and got["card"] == (12, 12, 0) and got["none"] == (12, 12, 0)
    assert got["email"] == got["ip"] == (0, 0, 0)


def test_edge_rows(spark):
    long = "word " * 60_000
    df = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (None, TEXT, 0), (None, TEXT, 0), (4, f"{long}a.b@c.de {long}", 0), (5, "no data", 0)],
        "doc_id long, text string, base_spans int",
    )
    model = fit_skip_chain(df)
    found = find_pii(df, model)
    assert found.columns.count("base_spans") == 1
    for r in found.collect():
        assert [(KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["base_spans"]] == expected(r["text"] or "")
        assert len(r["added_spans"]) == (2 if r["text"] == TEXT else 0)
    assert find_pii(df.where("false"), fit_skip_chain(df.where("false"))).collect() == []
