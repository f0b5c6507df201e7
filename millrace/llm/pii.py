"""Personal data: patterns, and a skip-chain conditional random field for what they miss.

The patterns find e-mail addresses, IP and card numbers and telephone numbers. The field then judges every
other mention that could be data: numbers of seven or more digits, also in groups, dotted numbers, words with an
at sign, and whatever is similar to something found, such as an address's name part alone. Its nodes are mentions,
its labels the four kinds and "none". Chain edges join neighbouring mentions, skip edges join consecutive mentions,
however distant, that share a key: the same letters, the same digits, the same last seven digits, or the same
name part. Loopy message passing makes the labels of a document agree. All graphs of a batch are solved together.

The factors are fitted piecewise, with the patterns as teachers: what they find has its kind, and counts by what is left
of it when the pattern is hidden (its shape and the words around it); a mention that they do not find and that no skip edges
tie to a found one counts as none. A mention that is tied to a found one is not known to be either and is not counted.
Similarity alone decides nothing: a tied mention is declined if its shape and neighbours say so, and one that is
not tied is added if they do.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order of reports; label 0 is none of them.
KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
#: Prior of each kind for a token that no pattern finds, and its weight against counts.
PRIOR, PRIOR_WEIGHT = 0.04, 5.0
#: Digits that make two numbers similar if they end in them, and that make a number a mention.
TAIL = 7
#: Digits with which a number stands for itself; shorter neighbours are groups of one number.
WHOLE = 10
#: Mentions at most so many words apart are neighbours.
NEAR = 3
#: Shapes, and words before and after, are told apart by their hash.
SHAPES, WORDS = 1 << 14, 1 << 12

_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL = re.compile(rf"{_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_START = re.compile(rf"(?<!{_LOCAL}){_EMAIL.pattern}")
_IP = re.compile(r"[0-9]++\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_IP_START = re.compile(rf"(?<![0-9]){_IP.pattern}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NUMBER = re.compile(r"[0-9+().\x2d/]*[0-9][0-9+().\x2d/]*")
_GROUP_GAP = re.compile(r"[\x20()]{1,3}")
_DOTTED = re.compile(r"[0-9]+\.[0-9]+\.[0-9]")
_HINT = re.compile(r"@|[0-9](?:[^0-9A-Za-z]{0,3}[0-9]){6}|[0-9]\.[0-9]+\.[0-9]")
_EDGE = ".,;:!?()[]{}<>\"'|#*$%&"


def _matches(plain: re.Pattern, start: re.Pattern, text: str) -> Iterator[re.Match]:
    """Leftmost non-overlapping matches in linear time.

    Whether a match can start in a run of the first class does not depend on where in the run, so only
    a run's first place is tried, and the place where the last match ended.
    """
    at = 0
    while match := plain.match(text, at) or start.search(text, at):
        yield match
        at = match.end()


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of what the patterns find, by kind and start."""
    out = []
    if "@" in text:
        out += [(0, *m.span()) for m in _matches(_EMAIL, _EMAIL_START, text)]
    if _DIGIT.search(text):
        for m in _matches(_IP, _IP_START, text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = "".join(_DIGIT.findall(m.group()))
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((3, *m.span()))
    return out


def _number_keys(text: str) -> list[str]:
    digits = "".join(_DIGIT.findall(text))
    return [f"#{digits}", f"~{digits[-TAIL:]}"] if len(digits) >= TAIL else []


def _keys(core: str) -> list[str]:
    """What similar tokens have in common."""
    lower = core.lower()
    keys = [f"={lower}"]
    keys += _number_keys(core)
    name = lower.partition("@")[0]
    if len(name) >= 5 and any(not c.isalpha() for c in name):
        keys.append(f"@{name}")
    return keys


def _shape(core: str) -> str:
    """Runs of letters and digits as one character each, the number of digits and whether they have a card's check digit."""
    runs = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", core))
    digits = "".join(_DIGIT.findall(core))
    check = 13 <= len(digits) <= 19 and _luhn(digits)
    return f"{runs[:12]}/{min(len(digits), 20)}/{int(check)}"


def _hashed(text: str, buckets: int) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % buckets


@dataclass
class Graph:
    """The mentions of one document: spans, hashed (shape, word before, word after), labels and edges."""

    spans: list[tuple[int, int]] = field(default_factory=list)
    seen: list[tuple[int, int, int]] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)


def _tokens(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _TOKEN.finditer(text):
        core = m.group().strip(_EDGE)
        if core:
            start = m.start() + m.group().index(core)
            out.append((start, start + len(core), core))
    return out


def _mentions(
    text: str, tokens: list[tuple[int, int, str]], base: list[tuple[int, int, int]]
) -> list[tuple[int, int, int, tuple[int, int], list[str]]]:
    """(first token, last token, label, span, keys) of the mentions of a text, in order."""
    spans: list[tuple[int, int] | None] = [None] * len(tokens)
    labels = [NONE] * len(tokens)
    starts = [t[0] for t in tokens]
    for kind, start, end in sorted(base, reverse=True):
        # Earlier kinds win where spans overlap.
        at = max(0, int(np.searchsorted(starts, start, "right")) - 1)
        while at < len(tokens) and tokens[at][0] < end:
            if tokens[at][1] > start:
                labels[at], spans[at] = kind, (start, end)
            at += 1
    digits = [len(_DIGIT.findall(c)) if _NUMBER.fullmatch(c) else 0 for _, _, c in tokens]
    part = [0 < n < WHOLE and not s and not _DOTTED.match(t[2]) for n, s, t in zip(digits, spans, tokens)]
    out, rest, i = [], [], 0
    while i < len(tokens):
        last = i
        if spans[i]:
            while last + 1 < len(tokens) and spans[last + 1] == spans[i]:
                last += 1
            out.append((i, last, labels[i], spans[i], _keys(text[slice(*spans[i])])))
        else:
            while part[i] and last + 1 < len(tokens) and part[last + 1] and _GROUP_GAP.fullmatch(
                text[tokens[last][1] : tokens[last + 1][0]]
            ):
                last += 1
            span = tokens[i][0], tokens[last][1]
            core = text[slice(*span)]
            if "@" in core or sum(digits[i : last + 1]) >= TAIL or _DOTTED.match(core):
                out.append((i, last, NONE, span, _keys(core)))
            else:
                rest += range(i, last + 1)
        i = last + 1
    found = {k for m in out if m[2] != NONE for k in m[4]}
    for i in rest if found else ():
        keys = [k for k in _keys(tokens[i][2]) if k in found]
        if keys:
            out.append((i, i, NONE, tokens[i][:2], keys))
    return sorted(out)


def build_graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    """The graph of a document; empty if it has no mention."""
    graph = Graph()
    if not base and not _HINT.search(text):
        return graph
    tokens = _tokens(text)
    last: dict[str, int] = {}
    before = None
    for n, (first, end, label, span, keys) in enumerate(_mentions(text, tokens, base)):
        around = [tokens[i][2].lower() if 0 <= i < len(tokens) else "" for i in (first - 1, end + 1)]
        graph.spans.append(span)
        graph.labels.append(label)
        graph.seen.append((_hashed(_shape(text[slice(*span)]), SHAPES), *[_hashed(w, WORDS) for w in around]))
        if before is not None and first - before <= NEAR:
            graph.chain.append((n - 1, n))
        for j in {last[k] for k in keys if k in last}:
            graph.skip.append((j, n))
        last.update(dict.fromkeys(keys, n))
        before = end
    return graph


@dataclass
class SkipChain:
    """Log factors: of a found mention's kind, of shapes and words around, of neighbours, of similar mentions."""

    shown: np.ndarray
    shapes: np.ndarray
    before: np.ndarray
    after: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def node(self, label: int, seen: tuple[int, int, int]) -> np.ndarray:
        if label != NONE:
            return self.shown[label]
        shape, before, after = seen
        return self.shapes[shape] + self.before[before] + self.after[after]

    def solve(self, graphs: list[Graph], rounds: int = 30, damping: float = 0.5) -> list[np.ndarray]:
        """Log beliefs of all nodes of each graph, by loopy sum-product messages."""
        sizes = [len(g.spans) for g in graphs]
        at = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
        if not at[-1]:
            return [np.empty((0, LABELS)) for _ in graphs]
        node = np.stack([self.node(*n) for g in graphs for n in zip(g.labels, g.seen)])
        edges = [
            np.array([(a + s, b + s) for g, s in zip(graphs, at) for a, b in pairs(g)], int).reshape(-1, 2)
            for pairs in (lambda g: g.chain, lambda g: g.skip)
        ]
        one = np.concatenate(edges)
        factor = np.concatenate(
            [np.broadcast_to(f, (len(e), LABELS, LABELS)) for f, e in zip((self.chain, self.skip), edges)]
        )
        source, target = np.concatenate([one[:, 0], one[:, 1]]), np.concatenate([one[:, 1], one[:, 0]])
        factor = np.concatenate([factor, factor.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(source)), -len(one))
        messages = np.zeros((len(source), LABELS))
        belief = node
        for _ in range(rounds if len(one) else 0):
            x = (belief[source] - messages[back])[:, :, None] + factor
            top = x.max(axis=1)
            new = top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = damping * messages + (1 - damping) * new
            belief = node.copy()
            np.add.at(belief, target, messages)
            if change < 1e-3:
                break
        return np.split(belief, at[1:-1])


def _tied(graph: Graph) -> list[bool]:
    """Whether a mention reaches a found one by skip edges; these only go through similar mentions."""
    root = list(range(len(graph.spans)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in graph.skip:
        root[find(a)] = find(b)
    good = {find(i) for i, label in enumerate(graph.labels) if label != NONE}
    return [find(i) in good for i in range(len(root))]


def added_spans(graphs: list[Graph], model: SkipChain) -> list[list[tuple[int, int, int]]]:
    """(kind number, start, end) that the field adds to each document: the likeliest label of what is not found."""
    out = []
    for graph, belief in zip(graphs, model.solve(graphs)):
        best = belief.argmax(axis=1) if len(belief) else []
        out.append(
            [
                (int(k), *span)
                for k, span, label in zip(best, graph.spans, graph.labels)
                if label == NONE and k != NONE
            ]
        )
    return out


def _count(rows: DataFrame) -> DataFrame:
    """factor, a, b, n: label counts of shapes, of words around, of neighbours and similar mentions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                graph = build_graph(text, base_spans(text))
                known = [label != NONE or not tied for label, tied in zip(graph.labels, _tied(graph))]
                for seen, label, sure in zip(graph.seen, graph.labels, known):
                    if sure:
                        counts.update((name, value, label) for name, value in zip(_SEEN, seen))
                for name, edges in (("chain", graph.chain), ("skip", graph.skip)):
                    for a, b in edges:
                        if known[a] and known[b]:
                            counts[name, graph.labels[a], graph.labels[b]] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string())]
            + [pa.array([k[i] for k in keys], pa.int32()) for i in (1, 2)]
            + [pa.array([counts[k] for k in keys], pa.int64())],
            names=["factor", "a", "b", "n"],
        )

    parts = rows.select("text").mapInArrow(run, "factor string, a int, b int, n long")
    return parts.groupBy("factor", "a", "b").agg(F.sum("n").alias("n"))


_SEEN = ("shape", "before", "after")


def fit_skip_chain(docs: DataFrame) -> SkipChain:
    """Fit the factors on all mentions of all documents (text).

    Shapes and words are counted by their hash, so the model has a fixed size and the driver gets at most
    :data:`LABELS` numbers for each of :data:`SHAPES` + 2 * :data:`WORDS` hashes. A shape that was never seen
    has a fixed prior, a word that was never seen says nothing. Without any row, similar mentions are simply
    taken to be alike.
    """
    likely = docs.select("text").where(F.col("text").rlike(r"[0-9]{3}|@|\+[0-9]|[0-9]\.[0-9]"))
    prior = np.array([PRIOR] * NONE + [1 - NONE * PRIOR])
    counts = {"shape": np.zeros((SHAPES, LABELS)), "before": np.zeros((WORDS, LABELS)), "after": np.zeros((WORDS, LABELS)),
              "chain": np.zeros((LABELS, LABELS)), "skip": np.zeros((LABELS, LABELS))}
    for r in _count(likely).collect():
        counts[r["factor"]][r["a"], r["b"]] += r["n"]

    def conditional(n: np.ndarray, pseudo: np.ndarray) -> np.ndarray:
        n = n + pseudo
        return np.log(n / n.sum(axis=1, keepdims=True))

    # How common the labels are among the mentions counted; words and neighbours only say what departs from that.
    usual = counts["shape"].sum(axis=0) + PRIOR_WEIGHT * prior
    usual = usual / usual.sum()
    around = [conditional(counts[n], PRIOR_WEIGHT * usual) - np.log(usual) for n in ("before", "after")]
    # An edge has no direction.
    chain, skip = ((counts[n] + counts[n].T) / 2 for n in ("chain", "skip"))
    chain = conditional(chain, PRIOR_WEIGHT * usual) - np.log(usual)
    # How much surer one makes the other than it is by itself.
    skip = conditional(skip, 0.5 + 2.0 * np.eye(LABELS)) - np.log(prior)
    shown = np.full((LABELS, LABELS), np.log(1e-6)) * (1 - np.eye(LABELS))
    shapes = conditional(counts["shape"], PRIOR_WEIGHT * prior)
    return SkipChain(shown, shapes, *around, (chain + chain.T) / 2, (skip + skip.T) / 2)


def hidden_recall(docs: DataFrame, model: SkipChain, parts: int = 5) -> DataFrame:
    """kind, n, right, wrong: how many found mentions the field finds again when their pattern is hidden.

    Of the found mentions of a document every ``parts``-th is hidden at a time, so each is hidden once. ``wrong`` counts
    those that get another kind. The row ``none`` has the mentions that no pattern finds and no skip edges tie to a
    found one; there ``wrong`` counts those that the field adds. ``docs`` should not be those of the fit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((LABELS, 3), np.int64)
        for batch in batches:
            graphs, asked = [], []
            for text in batch.column(0):
                text = text.as_py() or ""
                graph = build_graph(text, base_spans(text))
                found = [i for i, label in enumerate(graph.labels) if label != NONE]
                for k in range(min(parts, len(found))):
                    labels = list(graph.labels)
                    for i in found[k::parts]:
                        labels[i] = NONE
                    graphs.append(Graph(graph.spans, graph.seen, labels, graph.chain, graph.skip))
                    asked.append([(i, graph.labels[i]) for i in found[k::parts]])
                graphs.append(graph)
                asked.append([(i, NONE) for i, t in enumerate(_tied(graph)) if graph.labels[i] == NONE and not t])
            for belief, wanted in zip(model.solve(graphs), asked):
                for i, label in wanted:
                    got = int(belief[i].argmax())
                    counts[label] += (1, got == label, got not in (label, NONE))
        names = [*KINDS, "none"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names)] + [pa.array(counts[:, i]) for i in range(3)], names=["kind", "n", "right", "wrong"]
        )

    parted = docs.select("text").mapInArrow(run, "kind string, n long, right long, wrong long")
    return parted.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("n", "right", "wrong")])


_SPAN = "struct<kind: string, start: int, end: int>"


def pii_column(model: SkipChain, text: str = "text") -> Column:
    """struct of base and added spans (kind, start, end; by kind and start) of a text."""

    @F.pandas_udf(f"base array<{_SPAN}>, added array<{_SPAN}>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def told(spans: list[tuple[int, int, int]]) -> list[dict]:
            return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(spans)]

        for texts in batches:
            base = [base_spans(t or "") for t in texts]
            graphs = [build_graph(t or "", b) for t, b in zip(texts, base)]
            added = added_spans(graphs, model)
            yield pd.DataFrame({"base": [told(b) for b in base], "added": [told(a) for a in added]})

    return find(F.col(text))


def find_pii(docs: DataFrame, model: SkipChain) -> DataFrame:
    """Add (or replace) base_spans and added_spans (arrays of kind, start, end; code points, end exclusive).

    Spans are in the order of :data:`KINDS`, then of start. A null text is empty and has none. An added span never
    overlaps a base span. Equal texts get equal spans, whichever rows they are in; rows that repeat stay as they are. Very
    long texts are judged whole, in time linear in their length but for messages, which take 30 rounds at most. An
    empty table stays empty. Columns of the two names are replaced, all others, whatever their names, are kept.
    """
    found = docs.withColumn("_pii", pii_column(model))
    return (
        found.withColumn("base_spans", F.col("_pii.base")).withColumn("added_spans", F.col("_pii.added")).drop("_pii")
    )
