"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared as lower-case words (runs of letters, digits and underscores)
joined by single blanks. An item of m characters may be found with up to ``k = rate * m`` edits. It is split
into k + 1 pieces: k edits leave one piece unhurt, so every occurrence shows at least one exact piece.
An automaton finds all exact pieces of all items in one pass over a text, and Myers'
bit-parallel algorithm gets the edit distance around each hit. In an item of a few words an
edit makes another statement, so such an item is one piece and is found where it stands as whole words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources import materialise

#: Edits allowed per character of an item.
RATE = 0.08
#: Items of fewer words are found without edits, as whole words.
LEAST_WORDS = 8
#: Items of fewer words make a document go only if it says nothing else.
DROP_WORDS = 8
#: Characters of items that one automaton holds, on average.
BLOCK_CHARS = 1_000_000

_WORDS = re.compile(r"\w+")


def normal(text: str | None) -> str:
    return " ".join(_WORDS.findall(text or "")).lower()


def cut_pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``errors`` + 1 pieces of nearly equal length."""
    cuts = [len(item) * j // (errors + 1) for j in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """An item as bit masks, one bit per character."""

    def __init__(self, text: str):
        self.length = len(text)
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(text):
            self.masks[c] |= 1 << i
        self.masks = dict(self.masks)

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the substring of ``text`` nearest to the item, the first of equals."""
        full, top = (1 << self.length) - 1, 1 << (self.length - 1)
        plus, minus, score = full, 0, self.length
        least, end = score, 0
        get = self.masks.get
        for j, c in enumerate(text, 1):
            same = get(c, 0)
            vertical = same | minus
            horizontal = (((same & plus) + plus) ^ plus) | same
            up = minus | (full & ~(horizontal | plus))
            down = plus & horizontal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < least:
                    least, end = score, j
            up, down = (up << 1) & full, (down << 1) & full
            plus = down | (full & ~(vertical | up))
            minus = up & vertical
        return least, end


def _as_words(item: str, part: str, before: str, after: str) -> int:
    """Where ``item`` first stands in ``part`` with no letter of a further word at either end, or -1."""
    at = part.find(item)
    while at >= 0:
        left = part[at - 1] if at else before
        right = part[at + len(item)] if at + len(item) < len(part) else after
        if left in ("", " ") and right in ("", " "):
            return at
        at = part.find(item, at + 1)
    return -1


class ItemIndex:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str | None]], rate: float, least_words: int = LEAST_WORDS):
        self.items: list[tuple[list[int], str, int, bool]] = []
        by_text: dict[str, list[int]] = defaultdict(list)
        for item_id, text in items:
            if item_text := normal(text):
                by_text[item_text].append(item_id)
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for text, ids in by_text.items():
            whole = text.count(" ") + 1 < least_words
            errors = 0 if whole else int(rate * len(text))
            for offset, piece in cut_pieces(text, errors):
                pieces[piece].append((len(self.items), offset + len(piece)))
            self.items.append((ids, text, errors, whole))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, places)
        if pieces:
            self.automaton.make_automaton()
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}

    def _windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item number, start, end) of the parts of ``text`` around the exact pieces."""
        shifts = defaultdict(set)
        for last, places in self.automaton.iter(text):
            for number, offset in places:
                shifts[number].add(last + 1 - offset)
        for number, found in shifts.items():
            _, item, errors, _ = self.items[number]
            run: list[int] = []
            for shift in [*sorted(found), None]:
                if run and (shift is None or shift > run[1] + len(item) + 2 * errors):
                    yield number, max(0, run[0] - errors), run[1] + len(item) + errors
                    run = []
                if shift is not None:
                    run = [run[0], shift] if run else [shift, shift]

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best occurrence of each item found."""
        out: list[tuple[int, int, int, int]] = []
        best: dict[int, tuple[int, int, int]] = {}
        for number, start, end in self._windows(text) if self.items else ():
            _, item, errors, whole = self.items[number]
            if whole:
                at = -1 if number in best else _as_words(item, text[start:end], text[:start][-1:], text[end : end + 1])
                if at >= 0:
                    best[number] = 0, start + at, start + at + len(item)
                continue
            if number not in self.patterns:
                self.patterns[number] = Pattern(item), Pattern(item[::-1])
            forth, back = self.patterns[number]
            part = text[start:end]
            distance, stop = forth.best(part)
            if distance <= errors and (number not in best or distance < best[number][0]):
                _, length = back.best(part[max(0, stop - len(item) - errors) : stop][::-1])
                best[number] = distance, start + stop - length, start + stop
        for number, (distance, start, end) in best.items():
            out += [(i, distance, start, end) for i in self.items[number][0]]
        return sorted(out)


def _original_spans(text: str, found: list[tuple[int, int, int, int]]) -> list[dict]:
    """Matches with their places in the normal text turned into code points of the text itself."""
    starts, ends, at = [], [], 0
    for word in _WORDS.finditer(text):
        starts.append((at, word.start()))
        at += len(word.group().lower())
        ends.append((at, word.end()))
        at += 1
    out = []
    for item_id, distance, start, end in found:
        first = max((s for s in starts if s[0] <= start), default=starts[0])[1]
        last = min((e for e in ends if e[0] >= end), default=ends[-1])[1]
        out.append({"item_id": item_id, "distance": distance, "start": first, "end": last})
    return out


def matches_column(items: list[tuple[int, str | None]], text: str = "text",
                   rate: float = RATE, id_type: str = "bigint") -> Column:
    """Array of (item_id, distance, start, end): the items of one block found in a text."""

    @F.pandas_udf(f"array<struct<item_id: {id_type}, distance: int, start: int, end: int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = ItemIndex(items, rate)
        for texts in batches:
            out = []
            for text in texts:
                found = index.find(normal(text))
                out.append(_original_spans(text, found) if found else [])
            yield pd.Series(out)

    return find(F.col(text))


def item_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of about ``chars`` characters, dealt by their hash."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(total // chars) + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for i in range(n):
        rows = benchmark.where(F.col("text").isNotNull() & (block == i)).select("item_id", "text")
        yield [(r["item_id"], r["text"]) for r in rows.collect()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The test items (``benchmark``: item_id, text) that documents (doc_id, text) contain.

    One row for each document and item: doc_id, item_id, distance (edits), start, end (code
    points of the text, end exclusive) of the best occurrence, the first of equals. Items of any length are searched. A
    benchmark of any size is taken in blocks of bounded size, each with a pass over the documents; with more
    than one, each pass is written before the next block is read. Ids of any simple type keep it.
    Null and empty texts and items have no matches, nor have empty tables; very long texts are searched whole;
    rows that repeat are reported as often; equal items are reported under each of their ids. Other columns are
    ignored, whatever their names.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def searched(items: list[tuple[int, str | None]]) -> DataFrame:
        found = docs.select("doc_id", F.explode(matches_column(items, "text", rate, kind)).alias("m"))
        return found.select("doc_id", "m.item_id", "m.distance", "m.start", "m.end")

    blocks = item_blocks(benchmark)
    out = searched(next(blocks))
    for n, items in enumerate(blocks):
        out = (materialise(out) if n == 0 else out).unionByName(materialise(searched(items)))
    return out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, least_words: int = DROP_WORDS
) -> DataFrame:
    """The rows of ``docs``, columns unchanged, in which no test item is found.

    Items of fewer than ``least_words`` words only count in a document that says nothing else: they are
    answers and names that clean texts use too. Pass 1 to have every item count wherever it stands. Nulls, empty
    and long texts, repeated rows and empty tables are as in :func:`find_contamination`; null and empty texts stay.
    With more than one block of items, each pass is written before the next block is read.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()
    for n, items in enumerate(item_blocks(benchmark)):
        docs = materialise(docs) if n else docs
        long = [i for i in items if len(normal(i[1]).split()) >= least_words]
        short = sorted({normal(text) for _, text in items} - {normal(text) for _, text in long} - {""})
        docs = docs.where(F.size(matches_column(long, "text", rate, kind)) == 0) if long else docs
        docs = docs.where(~_says_only(short)) if short else docs
    return docs


def _says_only(texts: list[str]) -> Column:
    """Whether a text has the words of one of ``texts`` and no others."""
    wanted = set(texts)

    @F.pandas_udf("boolean")
    def same(column: pd.Series) -> pd.Series:
        return pd.Series([normal(t) in wanted for t in column], dtype=bool)

    return same(F.col("text"))
