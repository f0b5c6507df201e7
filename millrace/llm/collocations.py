"""Phrase collocations by prefix-free parsing.

Texts are streams of words with marks between the pieces of a sentence. A hash of a short window
of words decides where a chunk ends and the next begins, so equal passages are cut alike wherever
they occur, and the chunks of repeated text are repeated chunks. Neighbouring chunks overlap by
the window. The dictionary is the distinct chunks with how often the parse uses each.

Phrases are counted inside the distinct chunks only, times the chunk's frequency. One that starts
in the last window of a chunk belongs to the next chunk, which begins there, so every occurrence
is counted once: a window is one word shorter than the longest phrase, so each phrase lies whole
in the chunk that it starts in. The end of a text is padded by a window of marks.

Scores are exact: products are decimals of 38 digits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators import lookup_join
from millrace.operators.counts import SLICES
from millrace.sources import materialise

#: A chunk has about so many words.
CHUNK_WORDS = 16
#: Counts, and bytes of them, that a task holds before it passes them on.
HELD = 400_000
HELD_BYTES = 64 << 20
#: So many of the most common words have their places dealt out by the word after, too.
COMMON = 2_000
#: Rows in a batch that a task passes on.
BATCH = 10_000
#: The mark between pieces; it ends pieces, so no word is like it.
MARK = b"."
#: Between the language and the words of a phrase while they are sorted. No (escaped) word has it, so
#: all phrases with the same first words are neighbours.
GAP = b"\x00"
#: A-Z in lower case, ends of pieces as line feeds, other bytes as they are.
_PLAIN = bytes(
    10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_U = np.uint64

Counts = dict[str, dict[bytes, int]]


def stream(text: bytes) -> list[bytes]:
    """The lower-case words of a text with a mark at every end of a piece.

    ``bytes.split`` would also end words at the control characters 10 to 13, but those are marks by then.
    The bytes 0 and 1 are escaped.
    """
    if b"\x00" in text or b"\x01" in text:
        text = text.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01")
    return text.translate(_PLAIN).replace(b"\n", b" . ").split()


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def chunks(words: list[bytes], window: int, hashes: dict[bytes, int], size: int = CHUNK_WORDS) -> Iterator[bytes]:
    """The overlapping chunks of a stream, words joined by blanks; the last ``window`` words of each
    are the first of the next one, or marks."""
    n = len(words)
    if not n:
        return
    words = words + [MARK] * window
    at = np.fromiter(map(hashes.__getitem__, words), _U, len(words))
    mixed = np.zeros(n, _U)
    for i in range(window):
        mixed = (mixed ^ at[i : i + n]) * _U(0x9E3779B97F4A7C15)
        mixed ^= mixed >> _U(29)
    cuts = np.flatnonzero(mixed % _U(size) == 0)
    starts = [0, *cuts[cuts > 0].tolist()]
    for start, end in zip(starts, [*starts[1:], n]):
        yield b" ".join(words[start : end + window])


def _rows(counts: Counts) -> pa.RecordBatch:
    langs = [lang for lang, held in counts.items() for _ in held]
    keys = [key for held in counts.values() for key in held]
    numbers = [n for held in counts.values() for n in held.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(keys, pa.binary()), pa.array(numbers, pa.int64())],
        names=["lang", "chunk", "n"],
    )


def dictionary(docs: DataFrame, window: int) -> DataFrame:
    """lang, chunk (bytes), n: the distinct chunks of each language and their parse frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, held = _WordHashes(), defaultdict(lambda: defaultdict(int)), 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                known = counts[lang]
                held -= len(known)
                for chunk in chunks(stream(text.as_py()), window, hashes):
                    known[chunk] += 1
                held += len(known)
                if held > HELD // 4:  # a chunk takes more room than a phrase
                    yield _rows(counts)
                    counts.clear()
                    held = 0
        yield _rows(counts)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    parts = docs.select(lang, text).mapInArrow(run, "lang string, chunk binary, n long")
    return parts.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def _unescaped(phrase: Column) -> Column:
    """The words as they stand in the text."""
    for escaped, plain in (("\x01\x01", "\x00"), ("\x01\x02", "\x01")):
        phrase = F.replace(phrase, F.lit(escaped), F.lit(plain))
    return phrase


def _escaped_lang(lang: Column) -> Column:
    return F.replace(F.replace(lang, F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01"))


def _joined(parts: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(GAP, pa.binary()))


def _places(langs: pa.Array, chunked: pa.Array, counts: np.ndarray, max_words: int) -> pa.Table:
    """key, n: one row for each word in the chunks that is not in a chunk's last window.

    A key is the language, the word and the words after it in its piece, ``max_words`` in all; where
    the piece ends before, the rest is empty.
    """
    window = max(1, max_words - 1)
    split = pc.split_pattern(chunked, " ")
    ends = np.diff(split.offsets.to_numpy()).cumsum()
    words = split.flatten()
    is_mark = pc.equal(words, pa.scalar(MARK, pa.binary())).to_numpy(zero_copy_only=False)
    own = ~is_mark
    for back in range(1, window + 1):
        own[ends - back] = False
    at = np.flatnonzero(own)
    chunk = np.searchsorted(ends, at, side="right")
    nothing = len(words)
    words = pa.concat_arrays([words, pa.array([b""], pa.binary())])
    parts, ended = [langs.take(pa.array(chunk)), words.take(pa.array(at))], np.zeros(len(at), bool)
    for k in range(1, max_words):
        ended |= is_mark[np.where(ended, 0, at + k)]
        parts.append(words.take(pa.array(np.where(ended, nothing, at + k))))
    return pa.table({"key": _joined(parts), "n": pa.array(counts[chunk])})


def _pieces_of(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of chunks."""
    ends = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _runs(chunked: DataFrame, max_words: int) -> DataFrame:
    """key, n: for each place in a chunk the longest phrase that starts there, after its language.

    Equal keys are added up as far as a task holds them at a time.
    """

    def summed(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        sums = pa.concat_tables(held).group_by("key", use_threads=False).aggregate([("n", "sum")])
        yield from sums.rename_columns(["key", "n"]).to_batches(max_chunksize=BATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            for part in _pieces_of(batch, HELD_BYTES // 16):
                counts = part.column(2).to_numpy(zero_copy_only=False)
                held.append(_places(part.column(0), part.column(1), counts, max_words))
                rows, size = rows + held[-1].num_rows, size + held[-1].nbytes
                if rows > HELD or size > HELD_BYTES:
                    yield from summed(held)
                    held, rows, size = [], 0, 0
        if held:
            yield from summed(held)

    lang = _escaped_lang(F.col("lang")).cast("binary").alias("lang")
    return chunked.select(lang, "chunk", "n").mapInArrow(run, "key binary, n long")


class _Beginnings:
    """Sums over keys of ``parts`` parts, equal beginnings next to each other, for all beginnings at once.

    Languages and single words may come again, here or in another task, so they are told whatever they add
    up to.
    """

    def __init__(self, parts: int, min_count: int):
        self.parts, self.min_count, self.first = parts, min_count, True
        #: The open beginning of each level (words in it): its parts, its sum, and if the range starts with it.
        self.open: list[tuple[list[bytes], int, bool] | None] = [None] * parts

    def _told(self, level: int, parts: list[pa.Array], sums: np.ndarray, at_end: np.ndarray) -> pa.Table:
        told = (sums >= self.min_count) | at_end | (level < 2)
        if level:
            # An empty part is no word: the phrase is shorter and has been told at its own level.
            told &= pc.binary_length(parts[level]).to_numpy(zero_copy_only=False) > 0
        at = pa.array(np.flatnonzero(told))
        return pa.table({"key": _joined([p.take(at) for p in parts[: level + 1]]), "n": pa.array(sums[told])})

    def _close(self, level: int, at_end: bool = False) -> list[pa.Table]:
        if self.open[level] is None:
            return []
        words, total, at_start = self.open[level]
        parts = [pa.array([w], pa.binary()) for w in words]
        return [self._told(level, parts, np.array([total]), np.array([at_start or at_end]))]

    def add(self, keys: pa.Array, counts: np.ndarray) -> list[pa.Table]:
        """Take the next sorted rows; the beginnings that end with them."""
        out, rows = [], len(keys)
        if not rows:
            return out
        flat = pc.split_pattern(keys, "\x00").flatten()
        parts = [flat.take(pa.array(np.arange(i, rows * self.parts, self.parts))) for i in range(self.parts)]
        new, first = np.zeros(rows, bool), [p[0].as_py() for p in parts]
        new[0] = True
        for level in range(self.parts):
            part = parts[level]
            new[1:] |= pc.not_equal(part[1:], part[:-1]).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(counts, starts)
            at_start = np.zeros(len(starts), bool)
            if self.open[level] is not None and self.open[level][0] == first[: level + 1]:
                sums[0] += self.open[level][1]
                at_start[0] = self.open[level][2]
            else:
                out += self._close(level)
                at_start[0] = self.first
            last = [p[int(starts[-1])].as_py() for p in parts[: level + 1]]
            self.open[level] = last, int(sums[-1]), bool(at_start[-1])
            if len(starts) > 1:
                ended = pa.array(starts[:-1])
                own = [p.take(ended) for p in parts[: level + 1]]
                out.append(self._told(level, own, sums[:-1], at_start[:-1]))
        self.first = False
        return out

    def end(self) -> list[pa.Table]:
        return [table for level in range(self.parts) for table in self._close(level, at_end=True)]


def common_words(docs: DataFrame) -> list[str]:
    """The ``COMMON`` most common words, after their languages as in keys, by a 64th of each text.

    They only balance the tasks, so fragments at either end and words of other splitting do no harm.
    """
    size = F.length("text")
    part = F.substr("text", (F.rand(1) * size).cast("int") + 1, (size / 64).cast("int") + 64)
    word = F.explode(F.split(F.lower(part), r"[\s.,;:!?]+")).alias("word")
    found = docs.where("text IS NOT NULL").select(_escaped_lang(F.coalesce("lang", F.lit("und"))).alias("lang"), word)
    most = found.groupBy("lang", "word").count().orderBy(F.desc("count")).limit(COMMON)
    return [f"{row['lang']}\x00{row['word']}" for row in most.collect()]


def phrase_counts(
    chunked: DataFrame, max_words: int, min_count: int = 1, common: list[str] | None = None
) -> DataFrame:
    """lang, phrase, words, n: the phrases of up to ``max_words`` words with ``min_count`` occurrences or more.

    The empty phrase has the number of all words. Each place is shuffled as one row, by its language and first
    word and, if that is one of :func:`common_words` (or these are not given), the second. There phrases that begin alike are made neighbours, so their beginnings are added up in the same
    pass, and only frequent phrases and single words leave it. A very common first word spans all tasks; of a
    very common pair a task gets as many rows as there are words after it, from each task before.

    Rows are sorted by a number, and only those of the same pair by their bytes: by language, first word and
    pair, each hashed. Should the hashes of two first words agree, their rows mix by pairs; the words are told
    several times then, and added up after.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Beginnings(max_words + 1, min_count)
        for batch in batches:
            for table in sums.add(batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)):
                yield from table.to_batches()
        for table in sums.end():
            yield from table.to_batches()

    def start(words: int) -> Column:
        return F.substring_index(F.col("key").cast("string"), "\x00", 1 + words)

    # 8, 28 and 28 bits.
    bits = [F.shiftleft(F.hash(start(words)).cast("long").bitwiseAND(F.lit(mask)), shift)
            for words, mask, shift in ((0, 0xFF, 56), (1, 0xFFFFFFF, 28), (2, 0xFFFFFFF, 0))]
    order = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])
    by = start(2) if common is None else F.when(start(1).isin(common), start(2)).otherwise(start(1))
    dealt = _runs(chunked, max_words).repartition(by).select("key", "n", order.alias("order"))
    parts = dealt.sortWithinPartitions("order", "key").select("key", "n").mapInArrow(run, "key binary, n long")
    sums = parts.groupBy("key").agg(F.sum("n").alias("n"))
    split = F.split(F.col("key").cast("string"), "\x00")
    words = (F.size(split) - 1).alias("words")
    found = sums.select(split.alias("parts"), words, "n").where((F.col("n") >= min_count) | (F.col("words") == 0))
    phrase = F.when(F.col("words") == 0, "").otherwise(F.array_join(F.slice("parts", 2, F.col("words")), " "))
    return found.select(
        _unescaped(F.get("parts", F.lit(0))).alias("lang"), _unescaped(phrase).alias("phrase"), "words", "n"
    )


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def mine_collocations(
    docs: DataFrame, max_words: int = 3, min_count: int = 10, cover_percent: int = 50, top: int = 2000
) -> DataFrame:
    """The ``top`` phrases of 2 to ``max_words`` words of each language.

    ``docs`` needs text and lang. Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and the
    control characters 10 to 13, pieces into words at blanks and tabs. A phrase is a run of words of one
    piece. Candidates occur ``min_count`` times or more (a). Cutting one in two parts that occur l and r
    times gives floor(10^6 a a / (l r)); its score is the lowest over all cuts, ties to the shortest
    first part. A candidate is left out if a longer one holds its words and occurs at least
    ``cover_percent`` / 100 times as often.

    Returns lang, rank, phrase, a, l, r, n (all words of the language), score; ranks from 1 by score,
    a (both descending) and phrase (bytes). So ties cannot change the result. A null language is
    ``und``, a null text is empty. Repeated rows count as often as they occur; ids are not looked at.
    A long text is one stream, cut into chunks; no phrases give no rows. Other columns are ignored.
    """
    window = max(1, max_words - 1)
    texts = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    chunked = dictionary(texts, window)
    frequent = materialise(phrase_counts(chunked, max_words, min_count, common_words(texts)))
    candidates = frequent.where("words >= 2").withColumnRenamed("n", "a")

    # Every part of a candidate is as frequent as the candidate, so it is in the table, too.
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    parts = candidates.select("lang", "phrase", "words", "a", cut).select(
        "*", F.expr("substring_index(phrase, ' ', k)").alias("head"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("tail"),
    )
    for part, name in (("head", "l"), ("tail", "r")):
        known = frequent.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
        parts = materialise(lookup_join(parts, known, ["lang", part]))
    squared = _exact("a") * _exact("a") * F.lit(1_000_000).cast("decimal(7,0)")
    scored = parts.withColumn("up", squared).withColumn("down", _exact("l") * _exact("r"))
    lowest = F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "words", "a").agg(lowest)

    # Phrases inside a longer candidate, with the largest count of such.
    split = F.split("phrase", " ")
    spans = candidates.where("words >= 3").select(
        "lang", "a", split.alias("w"), F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"), "words"
    ).select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("start"))
    inner = spans.select("lang", F.expr("array_join(slice(w, start, size), ' ')").alias("phrase"), "a")
    covers = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    open_ = best.join(covers, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("longest") * 100 < F.col("a") * cover_percent, F.lit(True))
    )

    flat = open_.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
    few = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", slice_).orderBy(*order)))
    few = few.where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    totals = frequent.where("words = 0").select("lang", "n")
    return lookup_join(ranked.where(F.col("rank") <= top), totals, ["lang"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
