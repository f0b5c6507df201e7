"""Measures against plain definitions, the cascade against all rules, and edge rows."""

import random
import re
from collections import Counter

from millrace.llm.quality import RULES, Document, Rule, estimate_rules, judge_quality, order_rules


def plain(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(w, w[1:], w[2:]))
    again = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def test_measures():
    rng = random.Random(3)
    parts = ["a", "b", "cé", "D!", "#", "||", " ", " ", "\n", " ", " ", "\r", "\x0b", "\t", "\U0001f600"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 60)))
        d = Document(text)
        assert (d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words) == plain(text), text


def good(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


TEXTS = [good(80, 1), good(80, 2).upper(), good(10, 3), (good(5, 4) + " ") * 20, " | ".join(good(70, 5).split()),
         "!! ".join(good(70, 6).split()), "\n".join(["new " + good(12, 7), good(20, 8)] + [f"same line {i % 2}" for i in range(12)] + [good(60, 9)]), None, "",
         good(20_000, 10)]


def test_cascade_agrees_with_all_rules(spark):
    df = spark.createDataFrame([(i % 9, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, quality int")
    judged = judge_quality(df, counts=True)
    assert judged.columns == ["doc_id", "text", "quality"]
    for r in judged.collect():
        failing = {rule.name for rule in RULES if rule.rejects(Document(r["text"]))}
        q = r["quality"]
        assert q["kept"] == (not failing) and (q["rejected_by"] in failing or q["kept"])
        counts = (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"])
        assert counts == plain(r["text"] or "")
        assert q["tests"] == len(RULES) or not q["kept"]
    assert [i for i, t in enumerate(TEXTS) if not any(rule.rejects(Document(t)) for rule in RULES)] == [0, 9]
    assert judge_quality(df.where("false")).collect() == []


def test_order_is_by_rejection_per_cost(spark):
    rules = [
        Rule("dear", lambda d: bool(sum(range(20_000))) and len(d.text) % 2 == 0),
        Rule("cheap", lambda d: len(d.text) % 2 == 0),
        Rule("useless", lambda d: False),
    ]
    df = spark.createDataFrame([(i, "x" * i) for i in range(400)], "doc_id long, text string")
    estimates = estimate_rules(df, rules, sample_rows=200)
    seen = {r["rule"]: (r["seen"], r["rejected"]) for r in estimates.collect()}
    assert 100 < seen["cheap"][0] < 300 and seen["cheap"] == seen["dear"] and seen["useless"][1] == 0
    assert [r.name for r in order_rules(estimates, rules)] == ["cheap", "dear", "useless"]
    first = judge_quality(df, rules).select("quality.rejected_by").distinct().collect()
    assert {r[0] for r in first} == {"cheap", None}
