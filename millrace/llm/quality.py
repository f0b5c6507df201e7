"""Quality rules as a short-circuit cascade.

Each rule's cost and rejection rate are estimated on a sample, and the rules are ordered by
rejection per cost. A document goes through them until one rejects it; measures that no
rule has asked for by then are not taken. The order changes the time, never the verdict.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the sample that estimates costs and rejections, about.
SAMPLE_ROWS = 2_000
#: Symbols that hardly occur in prose, and Latin capitals.
SYMBOLS = "#*$%&|<>"
_CAPITALS = re.compile("[A-ZÀ-ÖØ-Þ]")
_SPACES = " \t\n\v\f\r"


class Document:
    """The measures of a text, each taken when first asked for. A null text has no words."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        # Splitting bytes knows ASCII white space only: blanks and the controls 9 to 13.
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, _SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_capitals(self) -> int:
        return len(_CAPITALS.findall(self.text))

    @cached_property
    def n_exclamations(self) -> int:
        return self.text.count("!")

    @cached_property
    def lines(self) -> list[str]:
        """Lines with a word."""
        return [line for line in self.text.split("\n") if line.strip(_SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in 3-word windows that occur twice or more."""
        if self.n_words < 4:
            return 0
        numbers: dict[bytes, int] = {}
        w = np.array([numbers.setdefault(x, len(numbers)) for x in self.words], np.int64)
        # Numbering pairs first keeps the windows' numbers within 64 bits.
        _, pair = np.unique(w[:-2] * len(numbers) + w[1:-1], return_inverse=True)
        _, window, count = np.unique(pair * len(numbers) + w[2:], return_inverse=True, return_counts=True)
        again = count[window] > 1
        covered = np.zeros(len(w), bool)
        for shift in range(3):
            covered[shift : len(w) - 2 + shift] |= again
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    """A name and a test that is true for documents to reject."""

    name: str
    rejects: Callable[[Document], bool]


def _few_words(d: Document) -> bool:
    return d.n_words < 50


def _repeated_words(d: Document) -> bool:
    return 100 * d.n_repeat_words > 50 * d.n_words


def _symbols(d: Document) -> bool:
    return 10 * d.n_symbols > d.n_words


def _capitals(d: Document) -> bool:
    return 2 * d.n_capitals > d.word_chars


def _exclamations(d: Document) -> bool:
    return 5 * d.n_exclamations > d.n_words


def _repeated_lines(d: Document) -> bool:
    return 10 * d.n_dup_lines > 4 * len(d.lines)


RULES = (
    Rule("few_words", _few_words),
    Rule("repeated_words", _repeated_words),
    Rule("symbols", _symbols),
    Rule("capitals", _capitals),
    Rule("exclamations", _exclamations),
    Rule("repeated_lines", _repeated_lines),
)


def estimate_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 5
) -> DataFrame:
    """rule, seen, rejected, nanoseconds: sums over a sample of about ``sample_rows`` rows.

    Each rule is timed on a document of its own, so that its cost holds all measures it needs.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select("text").sample(share, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rejected, spent = ([0] * len(rules) for _ in range(3))
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                for k, rule in enumerate(rules):
                    start = time.perf_counter_ns()
                    rejected[k] += bool(rule.rejects(Document(text)))
                    spent[k] += time.perf_counter_ns() - start
                    seen[k] += 1
        columns = [[r.name for r in rules], seen, rejected, spent]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["rule", "seen", "rejected", "nanoseconds"]
        )

    found = sample.mapInArrow(run, "rule string, seen long, rejected long, nanoseconds long")
    return found.groupBy("rule").agg(*[F.sum(c).alias(c) for c in ("seen", "rejected", "nanoseconds")])


def order_rules(estimates: DataFrame, rules: Sequence[Rule] = RULES) -> list[Rule]:
    """The rules by falling rejection per cost; one that rejects nothing comes by its cost."""
    known = {r["rule"]: r for r in estimates.collect()}

    def rank(rule: Rule) -> tuple[float, float, str]:
        row = known.get(rule.name)
        if row is None or not row["seen"]:
            return 0.0, 0.0, rule.name
        cost = max(1, row["nanoseconds"])
        return -row["rejected"] / cost, cost / row["seen"], rule.name

    return sorted(rules, key=rank)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cascade_column(ordered: Sequence[Rule], text: str = "text", counts: bool = False) -> Column:
    """struct of kept, rejected_by (the first rule to reject, or null) and tests (rules tried).

    With ``counts`` the counts of the text follow, for rejected documents too.
    """
    names = ["kept", "rejected_by", "tests", *(_COUNTS if counts else ())]
    kind = "kept boolean, rejected_by string, tests int" + "".join(f", {n} long" for n in _COUNTS if counts)

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                document, by, tests = Document(text), None, 0
                for rule in ordered:
                    tests += 1
                    if rule.rejects(document):
                        by = rule.name
                        break
                more = [getattr(document, n) for n in _COUNTS] if counts else []
                rows.append((by is None, by, tests, *more))
            yield pd.DataFrame(rows, columns=names)

    return judge(F.col(text))


def judge_quality(docs: DataFrame, rules: Sequence[Rule] = RULES, counts: bool = False) -> DataFrame:
    """Add (or replace) ``quality``, the struct of :func:`cascade_column`; no row is dropped.

    Null and empty texts have no words, which the first of :data:`RULES` rejects. Rows that repeat get
    equal verdicts; ``rejected_by`` may differ between runs as the order follows measured times.
    """
    ordered = order_rules(estimate_rules(docs, rules), rules)
    return docs.withColumn("quality", cascade_column(ordered, counts=counts))
