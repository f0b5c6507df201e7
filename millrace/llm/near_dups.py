"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its distinct word shingles, of five words unless told otherwise. Its signature has 40 MinHash values of
16 bits, kept as 10 chunks of four values, each chunk one long. Two documents at signature
distance 19 or less (values that differ) have a chunk with at most one differing value
(pigeonhole: ten chunks with two or more would make 20), so they share one of the four keys
that this chunk gives with one of its values masked. Hence every pair within the distance meets
in a bucket. Of 40 values, a pair at Jaccard 0.85 differs in 6 on average and in 20 or more
with a chance of about 2e-7, a pair at 0.8 in 8 and with a chance of about 2e-5; lower thresholds need other sizes.

Every link is confirmed on the full shingle sets. Within a bucket not all pairs are formed:

1. Each member is checked against the bucket's hub, the member whose own buckets are largest: in a
   group of copies that is the text they were made from. The links found give components.
2. Only pairs of one bucket that lie in different components are still open. They are looked
   for in blocks of bounded size, and those within the signature distance are confirmed too.

After that, any two documents of a bucket are in one component or have been compared, so the
components are those of all pairs within the signature distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import wide_join
from millrace.operators import lookup_join
from millrace.sources import materialise

CHUNKS = 10
LANES = 4
MAX_DISTANCE = 2 * CHUNKS - 1
#: Members of a bucket that one task compares with as many others.
BLOCK = 1000
#: Shingles of these members, about.
BLOCK_SHINGLES = 1_000_000
#: Members that one task confirms against one and the same document.
PER_TASK = 200
#: Words whose hashes a Python worker remembers.
MEMORY = 400_000

_U = np.uint64
_PARTS = [f"s{i}" for i in range(CHUNKS)]
_SEEDS = np.random.default_rng(20240229).integers(1, 2**63, size=2 * CHUNKS * LANES, dtype=np.uint64)
_TIMES, _PLUS = _SEEDS[: CHUNKS * LANES] * _U(2) + _U(1), _SEEDS[CHUNKS * LANES :]


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: bytes | None, words: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words (two or more) of an UTF-8 text.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is what is asked for: A-Z are
    lower-cased and words end at blanks and the controls 9 to 13. Fewer words are a single shingle.
    """
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    if len(w) < size:
        odd = np.arange(3, 2 * len(w) + 3, 2).astype(np.uint64)
        return _mixed((w * odd).sum(keepdims=True) + _U(len(w)))
    h, n = w[: len(w) - size + 1], len(w) - size + 1
    for i in range(1, size - 1):
        h = _mixed(h * _U(0x9E3779B97F4A7C15) + w[i : i + n])
    return np.unique(_mixed(h * _U(0xD6E8FEB86659FD93) + w[size - 1 :]))


def signature(shingles: np.ndarray, step: int = 4096) -> np.ndarray:
    """The chunks of the signature, four 16-bit values in each."""
    low = np.full(CHUNKS * LANES, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), step):
        block = shingles[i : i + step, None] * _TIMES + _PLUS
        np.minimum(low, block.min(axis=0), out=low)
    return (_mixed(low) >> _U(48)).astype("<u2").view("<i8")


def _set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2**63


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_id (equal for equal sets, null for empty ones), s0 to s9."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            texts = batch.column(1)
            n = np.zeros(len(texts), np.int64)
            ids = np.zeros(len(texts), np.int64)
            parts = np.zeros((len(texts), CHUNKS), np.int64)
            for i, text in enumerate(texts):
                shingles = shingle_set(text.as_py(), words, size)
                n[i] = len(shingles)
                if n[i]:
                    ids[i] = _set_id(shingles)
                    parts[i] = signature(shingles)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(ids, mask=n == 0)]
                + [pa.array(parts[:, j]) for j in range(CHUNKS)],
                names=["doc_id", "n_shingles", "set_id", *_PARTS],
            )

    schema = "doc_id long, n_shingles long, set_id long, " + ", ".join(f"{p} long" for p in _PARTS)
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return slim.mapInArrow(run, schema)


def _bucket_keys() -> Column:
    masks = [-1 ^ (0xFFFF << (16 * lane)) for lane in range(LANES)]
    signed = [m + 2**64 if m < -(2**63) else m for m in masks]
    return F.array(*[F.col(p).bitwiseAND(F.lit(m).cast("long")) for p in _PARTS for m in signed])


def _distance(a: str, b: str) -> Column:
    """Signature values that differ between two aliased rows."""
    lanes = []
    for p in _PARTS:
        x = F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))
        for lane in range(LANES):
            lanes.append((F.shiftrightunsigned(x, 16 * lane) % 65536 != 0).cast("int"))
    return reduce(add, lanes)


def _close_sizes(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) within the signature distance whose set sizes allow a link."""
    narrow = sets.select("set_id", "n_shingles", *_PARTS)
    both = (
        pairs.alias("p")
        .join(narrow.alias("x"), F.col("p.a") == F.col("x.set_id"))
        .join(narrow.alias("y"), F.col("p.b") == F.col("y.set_id"))
    )
    sizes = _close_sizes(F.col("x.n_shingles"), F.col("y.n_shingles"), percent)
    return both.where(sizes & (_distance("x", "y") <= MAX_DISTANCE)).select("p.a", "p.b")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    The members b of one a are dealt to groups of about :data:`PER_TASK`, each with a copy of a's text.
    """
    many = materialise(pairs.groupBy("a").agg(F.ceil(F.count("b") / PER_TASK).alias("groups")))
    salted = lookup_join(pairs, many, ["a"]).withColumn(
        "salt", F.pmod(F.xxhash64("b"), F.col("groups"))
    )
    members = salted.select("a", "salt", F.col("b").alias("set_id"), F.lit(1).alias("member"))
    heads = salted.select("a", "salt", F.col("a").alias("set_id"), F.lit(0).alias("member"))
    wanted = materialise(members.unionByName(heads.distinct()))
    rows = (
        wide_join(texts, wanted, ["set_id"], "inner")
        .repartition("a", "salt")
        .sortWithinPartitions("a", "salt", "member")
        .select("a", "salt", "member", "set_id", F.col("text").cast("binary").alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, head, of = WordHashes(), np.empty(0, np.uint64), None
        for batch in batches:
            left, right = [], []
            for a, salt, member, b, text in zip(*[c.to_pylist() for c in batch.columns]):
                shingles = shingle_set(text, words, size)
                if _set_id(shingles) != b:
                    continue  # another text with the same id
                if not member:
                    head, of = shingles, (a, salt)
                    continue
                if of != (a, salt):
                    raise ValueError(f"the text of set {a} is missing")
                common = len(np.intersect1d(head, shingles, assume_unique=True))
                if 100 * common >= percent * (len(head) + len(shingles) - common):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return rows.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest reachable node, itself included) for all nodes of ``edges`` (a, b).

    Large-star and small-star rounds on written tables until nothing changes. A node with very
    many neighbours is one row after the partial sums, and its rows are joined by :func:`lookup_join`.
    """

    def summary(e: DataFrame) -> tuple:
        hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(e.agg(F.count(F.lit(1)), F.sum(hashed)).first())

    def star(e: DataFrame, large: bool) -> DataFrame:
        rows = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            rows = rows.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = rows.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = materialise(least)
        spread = lookup_join(rows, least, ["u"])
        if large:
            out = spread.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = spread.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        return materialise(out.where("a <> b").select(*down).distinct())

    down = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = materialise(edges.where("a <> b").select(*down).distinct())
    before = summary(edges)
    while before[0]:
        edges = star(star(edges, large=True), large=False)
        now = summary(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


_GROUP = ["slot", "key", "i", "j"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows of a partition as tables that never cut a group of :data:`_GROUP`."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not len(table):
            continue
        last = np.ones(len(table), bool)
        for c in _GROUP:
            values = table.column(c).to_numpy()
            last &= values == values[-1]
        start = int(last.argmax())
        if start:
            yield table.slice(0, start)
        rest = table.slice(start)
    if rest is not None and len(rest):
        yield rest


class _Block:
    """Rows of some groups (two blocks of one bucket each) and their pairs that may be links."""

    def __init__(self, table: pa.Table, percent: int):
        get = {c: table.column(c).to_numpy() for c in table.column_names if c != "text"}
        self.ids, self.root, self.size = get["set_id"], get["root"], get["n_shingles"]
        new = np.zeros(len(table), bool)
        for c in _GROUP:
            new[1:] |= get[c][1:] != get[c][:-1]
        self.group = np.cumsum(new)
        self.left = np.flatnonzero(get["block"] == get["i"])
        self.right = np.flatnonzero(get["block"] == get["j"])
        self.same = get["i"] == get["j"]
        self.chunk, self.lane = np.divmod(get["slot"], LANES)
        self.parts = [get[p].view(np.uint64) for p in _PARTS]
        self.percent = percent

    def pairs(self, step: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(xs, ys, distances): different components, sizes and distances that allow a link.

        Only pairs whose first common bucket this is, so that no pair is looked at twice: no
        chunk before the bucket's has at most one differing value, and if its chunk agrees in
        full, so that all the chunk's buckets are common, it is the first of these.
        """
        low, high = _U(0x7FFF7FFF7FFF7FFF), _U(0x8000800080008000)
        of_right = self.group[self.right]
        for at in range(0, len(self.left), step):
            x = self.left[at : at + step]
            first, last = np.searchsorted(of_right, self.group[x[[0, -1]]] + [0, 1])
            x, y = x[:, None], self.right[first:last]
            a, b = self.size[x], self.size[y]
            fits = (self.group[x] == self.group[y]) & (self.root[x] != self.root[y])
            fits &= np.minimum(a, b) * 100 >= np.maximum(a, b) * self.percent
            fits &= (x < y) | ~self.same[x]
            if not fits.any():
                continue
            own, lane = self.chunk[x], self.lane[x]
            distance = np.zeros(fits.shape, np.uint8)
            for chunk, part in enumerate(self.parts):
                bits = part[x] ^ part[y]
                wrong = np.bitwise_count((((bits & low) + low) | bits) & high)
                distance += wrong
                fits &= (wrong > 1) | (own <= chunk)
                fits &= (own != chunk) | (wrong == 1) | (lane == 0)
            i, j = np.nonzero(fits & (distance <= MAX_DISTANCE))
            if len(i):
                yield x[i, 0], y[j], distance[i, j]


def _open_links(
    members: DataFrame, roots: DataFrame, sets: DataFrame, texts: DataFrame, percent: int, size: int
) -> DataFrame:
    """Links (a, b) between different components within buckets, enough to join what belongs together.

    A bucket is cut into blocks of at most about :data:`BLOCK` members and :data:`BLOCK_SHINGLES`
    shingles, and each pair of blocks is one group. First the members that have an open pair are told
    from narrow rows, then only they get their texts. Nearest pairs are confirmed first; what a
    link has joined is not compared again.
    """
    named = roots.withColumnRenamed("node", "set_id")
    rooted = (
        members.join(sets.select("set_id", "n_shingles", *_PARTS), "set_id")
        .join(named, "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    mixed = (
        rooted.groupBy("slot", "key")
        .agg(
            F.min("root").alias("least"), F.max("root").alias("most"),
            F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"),
        )
        .where("least <> most")
        .select("slot", "key", F.ceil("blocks").cast("int").alias("blocks"))
    )
    carried = [*_GROUP, "block", "set_id", "root", "n_shingles", *_PARTS]
    # Block pairs (i, j), i <= j: a row of block k goes to the pairs (k, j) and (i, k).
    block = F.pmod(F.xxhash64("set_id", F.lit("block")), F.col("blocks")).cast("int")
    rows = (
        lookup_join(rooted, materialise(mixed), ["slot", "key"])
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select(*carried)
    )

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            seen = np.zeros(len(table), bool)
            for xs, ys, _ in _Block(table, percent).pairs():
                seen[xs] = seen[ys] = True
            yield from table.filter(pa.array(seen)).to_batches()

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for table in _whole_groups(batches):
            yield from confirmed(table, words).to_batches()

    def confirmed(table: pa.Table, words: WordHashes) -> pa.Table:
        ids = table.column("set_id").to_pylist()
        shingles = [shingle_set(t.as_py(), words, size) for t in table.column("text")]
        right = np.array([_set_id(s) == i for s, i in zip(shingles, ids)], bool)
        table, shingles = table.filter(pa.array(right)), [s for s, r in zip(shingles, right) if r]
        block = _Block(table, percent)
        joined = {r: r for r in block.root.tolist()}

        def find(x: int) -> int:
            while joined[x] != x:
                joined[x] = x = joined[joined[x]]
            return x

        found = [np.stack([d, x, y]) for x, y, d in block.pairs()]
        found = np.concatenate([np.empty((3, 0), np.int64), *found], axis=1)
        out: tuple[list, list] = ([], [])
        for _, x, y in found[:, np.lexsort(found[::-1])].T.tolist():
            p, q = find(int(block.root[x])), find(int(block.root[y]))
            if p == q:
                continue
            common = len(np.intersect1d(shingles[x], shingles[y], assume_unique=True))
            if 100 * common >= percent * (len(shingles[x]) + len(shingles[y]) - common):
                joined[max(p, q)] = min(p, q)
                out[0].append(int(block.ids[x]))
                out[1].append(int(block.ids[y]))
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    kinds = {"slot": "int", "i": "int", "j": "int", "block": "int"}
    schema = ", ".join(f"{c} {kinds.get(c, 'long')}" for c in carried)

    def grouped(df: DataFrame) -> DataFrame:
        return df.repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    wanted = materialise(grouped(rows).mapInArrow(involved, schema))
    full = wide_join(texts, wanted, ["set_id"], "inner").withColumn("text", F.col("text").cast("binary"))
    return grouped(full.select(*carried, "text")).mapInArrow(links, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """Cluster documents whose sets of ``size``-word shingles have a Jaccard similarity of ``percent`` / 100 or more.

    ``percent`` should be 80 or more, as the signatures are made for that.
    ``docs`` needs doc_id and text; other columns are ignored. Returns one row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id of the component), kept.
    A null or empty text has no shingles and its row is a component of its own. Rows that repeat
    an id are judged each by its own text. A null doc_id gets the smallest id of its component,
    null if there is none, and is kept only then; an empty text without an id is kept.
    An empty table stays empty, very long texts are taken whole.
    Equal sets are one node of the graph, so copies are never paired. Sets are equal if their
    64-bit fingerprints are.
    """
    rows = materialise(signatures(docs, size))
    sets = materialise(
        rows.where("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(
            F.min("doc_id").alias("least_id"), F.min("n_shingles").alias("n_shingles"),
            *[F.min(p).alias(p) for p in _PARTS],
        )
    )
    # 1. Buckets with two members or more, each member with the bucket's hub.
    keyed = sets.select("set_id", F.posexplode(_bucket_keys()).alias("slot", "key"))
    sizes = keyed.groupBy("slot", "key").agg(F.count("*").alias("n")).where("n > 1")
    sizes = materialise(sizes.withColumn("rows", F.col("n")))
    members = materialise(lookup_join(keyed, sizes, ["slot", "key"], rows_per_key="rows"))
    reach = materialise(members.groupBy("set_id").agg(F.sum("n").alias("reach")))
    ranked = members.join(reach, "set_id").select("slot", "key", F.struct("reach", "set_id").alias("hub"))
    hubs = ranked.groupBy("slot", "key").agg(
        F.max("hub")["set_id"].alias("hub"), F.count("*").alias("rows")
    )
    stars = (
        lookup_join(members, materialise(hubs), ["slot", "key"], rows_per_key="rows")
        .where("set_id <> hub")
        .select(F.col("hub").alias("a"), F.col("set_id").alias("b"))
    )
    candidates = materialise(members.select("set_id").distinct())
    first = rows.join(candidates, "set_id").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    texts = _texts(docs, materialise(first))
    links = materialise(_confirmed(materialise(_near(stars.distinct(), sets, percent)), texts, percent, size))
    roots = materialise(components(links))
    # 2. What is still open within buckets.
    more = materialise(_open_links(members.drop("n"), roots, sets, texts, percent, size))
    if not more.isEmpty():
        roots = materialise(components(links.unionByName(more)))
    rooted = materialise(
        sets.select("set_id", "least_id")
        .join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    smallest = materialise(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")))
    named = materialise(lookup_join(rooted, smallest, ["root"]).select("set_id", "component_id"))
    clustered = lookup_join(rows.where("set_id IS NOT NULL"), named, ["set_id"])
    alone = rows.where("set_id IS NULL").withColumn("component_id", F.col("doc_id"))
    return clustered.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _texts(docs: DataFrame, first: DataFrame) -> DataFrame:
    """set_id and text for the document of each wanted set (``first``: set_id, doc_id).

    Where an id repeats, this gives a row for each of its texts; the reader tells them apart.
    """
    found = wide_join(docs.select("doc_id", "text"), first, ["doc_id"], "inner")
    return materialise(found.select("set_id", "text"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The rows of ``docs`` but for those that repeat a document with a smaller id.

    Rows with equal ids stay or go together; a row without an id stays.
    """
    found = near_duplicates(docs.select("doc_id", "text"), percent, size)
    gone = materialise(found.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct())
    return wide_join(docs, gone, ["doc_id"], "left_anti")
