"""Pigeonhole edit matching against full edit-distance tables."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm.decontaminate import (
    ItemIndex, Pattern, cut_pieces, drop_contaminated, find_contamination, normal,
)
from tests.helpers import rows


def best_distance(item, text):
    """Edit distance of ``item`` to the nearest substring of ``text``, by the full table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def text_of(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))


def damaged(text, edits, seed):
    rng = random.Random(seed)
    for _ in range(edits):
        at = rng.randrange(1, len(text) - 1)
        kind = rng.randrange(3)
        text = text[:at] + ("" if kind == 0 else rng.choice("xyz")) + text[at + (kind != 1) :]
    return text


def test_bit_parallel_distance():
    rng = random.Random(2)
    for k in range(300):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        distance, end = Pattern(item).best(text)
        assert distance == best_distance(item, text)
        assert best_distance(item, text[:end]) == distance


def test_pieces_cover_the_item():
    for errors in range(7):
        pieces = cut_pieces("abcdefghij", errors)
        assert "".join(p for _, p in pieces) == "abcdefghij" and len(pieces) == errors + 1
        assert all("abcdefghij"[at : at + len(p)] == p for at, p in pieces)


@pytest.mark.parametrize("rate", [0.0, 0.05, 0.1])
def test_finds_what_the_full_table_finds(rate):
    items = [(i, text_of(12, i)) for i in range(12)]
    index = ItemIndex(items, rate)
    for k in range(60):
        item = items[k % 12][1]
        text = normal(text_of(30, 500 + k) + " " + damaged(item, k % 9, k) + " " + text_of(10, 900 + k))
        want = {}
        for i, t in items:
            d = best_distance(normal(t), text)
            if d <= int(rate * len(normal(t))):
                want[i] = d
        assert {i: d for i, d, *_ in index.find(text)} == want


def test_documents(spark):
    item = text_of(20, 1)
    long = text_of(40_000, 2)
    docs = spark.createDataFrame(
        [(1, f"Before,\n{item.upper().replace(' ', ' - ')}! After.", "a"), (2, long, "b"), (3, f"{long} {item} {long}", "c"),
         (3, f"{long} {item} {long}", "c"), (4, None, "d"), (5, "", "e"), (None, item, "f"), (6, "Three small WORDS.", "g"),
         (7, "Then three small words more", "h"),
         (8, "three small wordsmiths, a three small-words", "i"), (9, "nothree small words", "j")],
        "doc_id long, text string, item_id string",
    )
    items = spark.createDataFrame(
        [(10, item), (11, item), (12, None), (13, ""), (14, "three small words"), (15, text_of(20, 9))],
        "item_id long, text string",
    )
    found = find_contamination(docs, items)
    assert rows(found, "doc_id", "item_id", "distance") == sorted(
        [(d, i, 0) for d in (1, 3, 3, None) for i in (10, 11)] + [(6, 14, 0), (7, 14, 0), (8, 14, 0)], key=repr
    )
    spans = {(r["doc_id"], r["item_id"]): (r["start"], r["end"]) for r in found.collect()}
    assert spans[None, 10] == (0, len(item)) and spans[1, 10] == (8, 8 + len(item.replace(" ", " - ")))
    assert spans[7, 14] == (5, 22) and spans[8, 14] == (26, 43)
    kept = [(2, "b"), (4, "d"), (5, "e"), (7, "h"), (8, "i"), (9, "j")]
    assert rows(drop_contaminated(docs, items), "doc_id", "item_id") == kept
    assert rows(drop_contaminated(docs, items, least_words=1), "doc_id", "item_id") == kept[:3] + kept[5:]
    named = items.withColumn("item_id", F.concat(F.lit("item-"), F.col("item_id")))
    assert rows(find_contamination(docs.where("doc_id = 7"), named), "item_id") == [("item-14",)]
    assert find_contamination(docs, items.where("false")).collect() == []
    assert find_contamination(docs.where("false"), items).collect() == []


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    items = [(i, text_of(15, i)) for i in range(30)]
    docs = spark.createDataFrame([(i, f"{text_of(9, 70 + i)} {items[i][1]}") for i in range(0, 30, 4)], "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    from millrace.llm import decontaminate

    blocks = list(decontaminate.item_blocks(table, chars=300))
    assert len(blocks) > 3 and sorted(i for b in blocks for i in b) == sorted(items)
    def found():
        return {(r["doc_id"], r["item_id"]) for r in find_contamination(docs, table).collect()}

    assert found() == {(i, i) for i in range(0, 30, 4)}
    in_blocks = [(b, [(i, t) for i, t in items if i % 3 == b]) for b in range(3)]
    monkeypatch.setattr(decontaminate, "item_blocks", lambda benchmark: iter([b for _, b in in_blocks]))
    assert found() == {(i, i) for i in range(0, 30, 4)}
    assert rows(drop_contaminated(docs.unionByName(docs.selectExpr("doc_id + 100 AS doc_id", "'clean' AS text")), table), "doc_id") == [
        (100 + i,) for i in range(0, 30, 4)]
