"""Collocations against plain n-gram counts, the parse against its stream, and edge rows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from millrace.llm import collocations
from millrace.llm.collocations import (
    _Beginnings,
    chunks,
    common_words,
    dictionary,
    mine_collocations,
    phrase_counts,
    stream,
)
from tests.helpers import rows

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def pieces(text):
    parts = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in parts]


def grams(texts, most):
    counts = Counter()
    for text in texts:
        for words in pieces(text):
            for size in range(1, most + 1):
                counts.update(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
    return counts


def expected(docs, most=3, least=10, percent=50, top=2000):
    out = []
    for lang in {x or "und" for x, _ in docs}:
        f = grams([t for x, t in docs if (x or "und") == lang], most)
        n = sum(v for k, v in f.items() if " " not in k)
        found = {p: a for p, a in f.items() if " " in p and a >= least}
        scored = []
        for phrase, a in found.items():
            w = phrase.split(" ")
            if any(f" {phrase} " in f" {x} " and x != phrase and 100 * b >= percent * a for x, b in found.items()):
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((10**6 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def sample(seed, docs=120):
    rng = random.Random(seed)
    words = ["Of", "the", "new", "York", "times", "\x01", "\x00", "\x01\x00the", "the\x02", "new\x01", "é", "É", "a-b", "ü"] + [f"w{i}" for i in range(12)]
    ends = ["", "", "", ".", ",", "\n", "\r\n", "!?", " ; ", "\x0b", "\t", "\xa0"]
    out = []
    for i in range(docs):
        text = " ".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(120)))
        out += [(rng.choice(["en", "de", None]), text)] * rng.choice([1, 1, 3])
    return out


def test_parse_is_prefix_free_and_whole():
    for _, text in sample(1, 40):
        words = stream(text.encode())
        assert b" ".join(words).replace(b" . ", b".").count(b"\n") == 0
        for window in (1, 2, 3):
            parts = [c.split(b" ") for c in chunks(words, window, collocations._WordHashes(), size=3)]
            assert all(a[-window:] == b[:window] for a, b in zip(parts, parts[1:]))
            own = [w for p in parts for w in p[:-window]]
            assert own == words
            # Equal passages are cut alike, wherever they occur.
            shifted = list(chunks([b"q", *words], window, collocations._WordHashes(), size=3))
            assert set(shifted[2:]) <= {b" ".join(p) for p in parts}


def test_all_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HELD", 50)
    docs = sample(2)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    for most in (2, 3, 4):
        found = phrase_counts(dictionary(df, max(1, most - 1)), most)
        got = {(r["lang"], r["phrase"]): r["n"] for r in found.collect() if r["phrase"]}
        want = {}
        for lang in ("en", "de", None):
            want |= {(lang or "und", p): n for p, n in grams([t for x, t in docs if x == lang], most).items()}
        assert got == want


def test_collocations(spark):
    docs = sample(3)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    assert rows(mine_collocations(df)) == sorted(expected(docs), key=repr)
    small = mine_collocations(df, max_words=4, min_count=2, cover_percent=80, top=7)
    assert rows(small) == sorted(expected(docs, 4, 2, 80, 7), key=repr)


def test_a_hot_text_and_a_very_long_one(spark):
    docs = [("en", "over and over again we go")] * 400 + [("en", "to be or not " * 20_000), ("en", "x " * 30_000)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    assert rows(mine_collocations(df)) == sorted(expected(docs), key=repr)


def test_edge_rows(spark):
    docs = [(None, None), ("en", None), ("en", ""), ("en", " \t.\n,"), ("en", "one"), ("de", "a b.c")] * 12
    df = spark.createDataFrame([(*d, 5, 6) for d in docs], "lang string, text string, n long, phrase int")
    assert rows(mine_collocations(df)) == sorted(expected(docs), key=repr) == [("de", 1, "a b", 12, 12, 12, 36, 10**6)]
    assert mine_collocations(df.where("false")).collect() == []
    numbers = df.select(df["n"].alias("lang"), df["phrase"].alias("text"))
    assert mine_collocations(numbers).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a = 3 * 10**9
    counts = spark.createDataFrame([(a, a + 1, a + 2)], "a long, l long, r long")
    up = collocations._exact("a") * collocations._exact("a") * 1_000_000
    from pyspark.sql import functions as F

    got = counts.withColumn("up", up).withColumn("down", collocations._exact("l") * collocations._exact("r"))
    assert got.select(F.expr("up div down")).first()[0] == 10**6 * a * a // ((a + 1) * (a + 2))


def test_beginnings_over_ranges_and_batches():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    keys = Counter()
    for _ in range(600):
        words = [rng.choice("abc") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 4))]
        keys["\x00".join([rng.choice(["", "de", "en"]), *words, *[""] * (3 - len(words))]).encode()] += rng.randrange(1, 4)
    want = Counter()
    for key, n in keys.items():
        parts = key.split(b"\x00")
        for level in range(4):
            if not level or parts[level]:
                want[b"\x00".join(parts[: level + 1])] += n
    rows_ = sorted(keys.items())
    for cuts in (0, 1, 5, 40):
        edges = sorted({0, len(rows_), *rng.sample(range(1, len(rows_)), cuts)})
        got, told = Counter(), 0
        for start, end in zip(edges, edges[1:]):
            sums = collocations._Beginnings(4, 30)
            size = rng.randrange(1, 9)
            tables = []
            for i in range(start, end, size):
                batch = rows_[i : min(i + size, end)]
                tables += sums.add(pa.array([k for k, _ in batch], pa.binary()), np.array([n for _, n in batch]))
            for table in [*tables, *sums.end()]:
                for row in table.to_pylist():
                    got[row["key"]] += row["n"]
                    told += 1
        frequent = {k: n for k, n in want.items() if n >= 30 or b"\x00" not in k}
        assert {k: n for k, n in got.items() if k in frequent} == frequent
        assert all(got[k] < 30 for k in got if k not in frequent)
        assert told <= len(frequent) + 8 * len(edges)


def test_mixed_first_words_are_told_and_ranges_not_sampled(spark, capsys):
    """Rows of two first words may mix by pairs; nothing is read twice to find ranges."""
    keys = [b"en\x00a\x00b\x00c", b"en\x00x\x00y\x00", b"en\x00a\x00d\x00"]
    sums = _Beginnings(4, 10)
    told = sums.add(pa.array(keys, pa.binary()), np.array([7, 20, 6])) + sums.end()
    found = Counter()
    for table in told:
        for row in table.to_pylist():
            found[row["key"]] += row["n"]
    assert (found[b"en\x00a"], found[b"en\x00x"], found[b"en\x00x\x00y"], found[b"en"]) == (13, 20, 20, 33)
    docs = spark.createDataFrame([("a b c. a b d " * 9, "en"), (None, "en"), ("a b c", None)], "text string, lang string")
    plain = phrase_counts(dictionary(docs, 2), 3)
    for common in ([], ["en\x00a"], common_words(docs)):
        counted = phrase_counts(dictionary(docs, 2), 3, common=common)
        assert rows(counted) == rows(plain) and rows(counted.where("phrase = 'a b' AND lang = 'en'"), "n") == [(18,)]
    plain.explain()
    assert "rangepartitioning" not in capsys.readouterr().out
