"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; its hash is the
signed axis that it then lies closest to. Three such hashes make the key of one of 12 tables. Every
vector is filed under its own key of each table and looks into four keys of each: its own and the
three next best combinations of its largest axes (multiprobe). Two unit vectors of 64 components at
cosine 0.95 meet in a table with a chance of 0.59, so 0.41^12 = 2e-5 of such pairs are missed, fewer
of closer ones, and none of equal vectors, which are one node from the start.

What meets is checked in two steps, so that vectors travel only where it pays:

1. Narrow rows (node, bucket, 128 signs of the turned vector) are grouped by bucket. A bucket is cut
   into blocks of bounded size and each pair of blocks is one group, so no task sees a whole hot
   bucket. Signs of vectors at cosine 0.95 differ in 13 of 128 places on average, sd 3.4; members with
   a partner at 40 places or fewer go on.
2. These get their vectors, and exact cosines decide. A pair that meets in several buckets counts in the
   first only. A block pair returns the number of links per member and a spanning forest of its links,
   never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.near_dups import components
from millrace.operators import lookup_join
from millrace.sources import materialise

TABLES = 12
HASHES = 3
PROBES = 4
#: Largest axes of each hash that probes are made of.
AXES = 4
#: Words of 64 signs, and places of them that may differ.
WORDS = 2
MAX_SIGNS = 40
#: Members of a bucket that one task compares with as many others.
BLOCK = 1000
#: Links that wait in a task until the buckets that they meet in are compared.
PAIRS = 500_000

_U = np.uint64
_RANKS = np.array(list(product(range(AXES), repeat=HASHES)))


def _signs(width: int) -> np.ndarray:
    """Random signs: table, hash, round, component; the tables' are followed by those of the sign words."""
    rng = np.random.default_rng([20240513, width])
    extra = -(-64 * WORDS // (width * HASHES))
    return rng.choice(np.array([-1.0, 1.0]), size=(TABLES + extra, HASHES, 3, width))


def _turned(units: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """rows x hashes x width: the rows under each rotation, up to a common factor.

    Components lie on the first axis meanwhile, so that each step of the transform adds long runs.
    Only sums and differences are formed, so the result is the same on every machine.
    """
    width = units.shape[1]
    flat = signs.reshape(-1, *signs.shape[-2:])
    x = np.repeat(units.T[:, :, None], len(flat), axis=2)
    for i in range(flat.shape[1]):
        x *= flat[:, i].T[:, None, :]
        step = 1
        while step < width:
            pair = x.reshape(width // (2 * step), 2, step, -1)
            low, high = pair[:, 0], pair[:, 1]
            less = low - high
            low += high
            high[...] = less
            step *= 2
    return np.ascontiguousarray(np.moveaxis(x, 0, 2))


def _padded(units: np.ndarray) -> np.ndarray:
    width = max(AXES, 1 << (units.shape[1] - 1).bit_length())
    return np.pad(units, ((0, 0), (0, width - units.shape[1])))


def _extremes(values: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` largest values of the last axis, in order; ``values`` is used up."""
    places = []
    for _ in range(k):
        at = values.argmax(axis=-1)[..., None]
        places.append(at)
        np.put_along_axis(values, at, -np.inf, axis=-1)
    return np.concatenate(places, axis=-1)


def probe_keys(units: np.ndarray, step: int = 256) -> np.ndarray:
    """rows x tables x probes: the keys that unit vectors look into; the first is their own."""
    keys = np.empty((len(units), TABLES, PROBES), np.int64)
    for at in range(0, len(units), step):
        part = _padded(units[at : at + step])
        rows, width = part.shape
        x = _turned(part, _signs(width)[:TABLES]).reshape(rows, TABLES, HASHES, width)
        axes = _extremes(np.abs(x), AXES)
        value = np.take_along_axis(x, axes, axis=-1)
        code = 2 * axes + (value < 0)
        cost = (np.abs(value[..., :1]) - np.abs(value)) ** 2
        total, joint = 0.0, 0
        for h in range(HASHES):
            total = total + cost[:, :, h][:, :, _RANKS[:, h]]
            joint = joint * (2 * width) + code[:, :, h][:, :, _RANKS[:, h]]
        keys[at : at + step] = np.take_along_axis(joint, _extremes(-total, PROBES), axis=-1)
    return keys


def sign_words(units: np.ndarray) -> np.ndarray:
    """rows x words: the signs of further turned components, 64 to a word."""
    units = _padded(units)
    bits = _turned(units, _signs(units.shape[1])[TABLES:]).reshape(len(units), -1) < 0
    return np.packbits(bits[:, : 64 * WORDS], axis=1).view("<i8")


def _units(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, unit vectors) for each length of the given lists of numbers."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        rows = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        rows = rows.astype(float).reshape(len(at), n)
        rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
        yield at, rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _identified(vectors: DataFrame) -> DataFrame:
    """vec_id, vector, h1, h2 (128 bits that tell vectors apart; null where there can be no link)."""
    values = F.col("embedding")
    finite = F.forall(values, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    usable = F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))
    # Adding 0 turns -0.0 into 0.0.
    kind = vectors.schema["embedding"].dataType.simpleString()
    vector = F.transform(values, lambda x: x.cast("double") + 0.0).cast(kind)
    marked = vectors.select("vec_id", F.when(usable, vector).alias("vector"))
    hashes = [F.when(F.col("vector").isNotNull(), F.xxhash64(F.lit(i), "vector")).alias(f"h{i}") for i in (1, 2)]
    return marked.select("*", *hashes)


def _nodes(rows: DataFrame) -> DataFrame:
    """node, h1, h2, vector, least_id, copies: the distinct vectors that can have links."""
    distinct = rows.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("vector").alias("vector"), F.min("vec_id").alias("least_id"), F.count("*").alias("copies")
    )
    return materialise(distinct.withColumn("node", F.monotonically_increasing_id()))


def _filed(nodes: DataFrame) -> DataFrame:
    """node, width, words, keys (for each table those that it looks into, its own first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            keys, words = np.empty((n, TABLES * PROBES), np.int64), np.empty((n, WORDS), np.int64)
            for at, units in _units(batch.column(1)):
                keys[at] = probe_keys(units).reshape(len(at), -1)
                words[at] = sign_words(units)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))
                for m in (words, keys)
            ]
            width = batch.column(1).value_lengths()
            yield pa.RecordBatch.from_arrays([batch.column(0), width, *lists], names=["node", "width", "words", "keys"])

    schema = "node long, width int, words array<long>, keys array<long>"
    return nodes.select("node", "vector").mapInArrow(run, schema)


_GROUP = ["slot", "key", "i", "j"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows of a partition as tables that never cut a group of :data:`_GROUP`."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
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


def _groups(table: pa.Table) -> Iterator[slice]:
    new = np.zeros(len(table), bool)
    for c in _GROUP:
        values = table.column(c).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    starts = np.concatenate([[0], np.flatnonzero(new), [len(table)]])
    for a, b in zip(starts, starts[1:]):
        yield slice(a, b)


def _sides(block: np.ndarray, own: np.ndarray, i: int, j: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(left, right, same): the members that are compared, one of each pair filed under the key.

    ``same`` says that both sides hold the same members, so that pairs come twice.
    """
    filed, looking = np.flatnonzero(own), np.flatnonzero(~own)
    if i == j:
        yield filed, filed, True
        yield filed, looking, False
        return
    a, b = block == i, block == j
    yield filed[a[filed]], np.flatnonzero(b), False
    yield looking[a[looking]], filed[b[filed]], False


def _near_signs(words: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    differ = np.zeros((len(left), len(right)), np.uint16)
    for w in range(WORDS):
        differ += np.bitwise_count(words[left, w][:, None] ^ words[right, w][None, :])
    return differ <= MAX_SIGNS


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that have a partner in their block pair whose signs are near."""
    for table in _whole_groups(batches):
        words = np.stack([table.column(f"w{w}").to_numpy().view(_U) for w in range(WORDS)], axis=1)
        block, own = table.column("block").to_numpy(), table.column("own").to_numpy().astype(bool)
        keep = np.zeros(len(table), bool)
        for at in _groups(table):
            if at.stop - at.start < 2:
                continue
            i, j = (table.column(c)[at.start].as_py() for c in "ij")
            some, own_words = keep[at], words[at]
            for left, right, same in _sides(block[at], own[at], i, j):
                near = _near_signs(own_words, left, right)
                if same:
                    np.fill_diagonal(near, False)
                some[left[near.any(axis=1)]] = True
                some[right[near.any(axis=0)]] = True
        yield from table.filter(pa.array(keep)).to_batches()


def _meet_here(x: np.ndarray, y: np.ndarray, table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether bucket (table, key) is the first in which vectors with the keys x and y meet.

    That is the first table in which one is filed where the other looks, and there the smaller such key.
    """
    there = (x[:, :, :1] == y).any(axis=2)
    here = (y[:, :, :1] == x).any(axis=2)
    first = (there | here).argmax(axis=1)
    at, none = np.arange(len(x)), np.iinfo(np.int64).max
    own = np.where(there[at, first], x[at, first, 0], none)
    other = np.where(here[at, first], y[at, first, 0], none)
    return (first == table) & (np.minimum(own, other) == key)


def _forest(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int]]:
    """The links that join what was not joined before."""
    root: dict[int, int] = {}

    def find(a: int) -> int:
        while root.setdefault(a, a) != a:
            root[a] = a = root[root[a]]
        return a

    for a, b in zip(x.tolist(), y.tolist()):
        p, q = find(a), find(b)
        if p != q:
            root[max(p, q)] = min(p, q)
            yield a, b


class _Links:
    """Links found in some rows: their number per row and a spanning forest for each block pair."""

    def __init__(self, rows: pa.Table, units: np.ndarray):
        self.node, self.copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        self.slot, self.key = rows.column("slot").to_numpy(), rows.column("key").to_numpy()
        self.units = units
        self.links = np.zeros(len(rows), np.int64)
        self.edges = np.empty((0, 2), np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.known = np.full(len(rows), -1)
        self.keys = np.empty((0, TABLES, PROBES), np.int64)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        """Pairs of rows that are close and share a bucket."""
        self.pending.append((x, y))
        if sum(len(a) for a, _ in self.pending) > PAIRS:
            self.settle()

    def settle(self, step: int = 20_000) -> None:
        """Count the pending pairs whose first bucket this is."""
        x, y = (np.concatenate([np.empty(0, np.int64), *side]) for side in zip(*self.pending or [((), ())]))
        self.pending = []
        x, y = x.astype(np.int64), y.astype(np.int64)
        self._look_up(np.unique(np.concatenate([x, y])))
        new = np.zeros(len(x), bool)
        for at in range(0, len(x), step):
            a, b = x[at : at + step], y[at : at + step]
            keys = self.keys[self.known[a]], self.keys[self.known[b]]
            new[at : at + step] = _meet_here(*keys, self.slot[a] % TABLES, self.key[a])
        x, y = x[new], y[new]
        np.add.at(self.links, x, self.copies[y])
        np.add.at(self.links, y, self.copies[x])
        edges = np.concatenate([self.edges, np.stack([x, y], axis=1)])
        self.edges = np.array(list(_forest(*edges.T)), np.int64).reshape(-1, 2)

    def _look_up(self, rows: np.ndarray) -> None:
        rows = rows[self.known[rows] < 0]
        _, first, of = np.unique(self.node[rows], return_index=True, return_inverse=True)
        self.known[rows] = len(self.keys) + of
        self.keys = np.concatenate([self.keys, probe_keys(self.units[rows[first]])])

    def batch(self) -> pa.RecordBatch:
        """(a, null, links) for every row with links, and (a, b, null) for every edge of the forests."""
        self.settle()
        linked = np.flatnonzero(self.links)
        a = np.concatenate([self.node[linked], self.node[self.edges[:, 0]]])
        b = np.concatenate([np.zeros(len(linked), np.int64), self.node[self.edges[:, 1]]])
        links = np.concatenate([self.links[linked], np.zeros(len(self.edges), np.int64)])
        is_edge = np.arange(len(a)) >= len(linked)
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b, mask=~is_edge), pa.array(links, mask=is_edge)], names=["a", "b", "links"]
        )


def _linker(cosine: float, step: int = 256):
    """The function of a task: the links of its block pairs."""

    def linked(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        (_, units), = _units(table.column("vector").chunk(0))
        block, own = table.column("block").to_numpy(), table.column("own").to_numpy().astype(bool)
        links = _Links(table, units)
        for at in _groups(table):
            if at.stop - at.start < 2:
                continue
            i, j = (table.column(c)[at.start].as_py() for c in "ij")
            inside = units[at]
            for left, right, same in _sides(block[at], own[at], i, j):
                for start in range(0, len(left), step):
                    part = left[start : start + step]
                    a, b = np.nonzero(inside[part] @ inside[right].T >= cosine)
                    x, y = part[a], right[b]
                    if same:
                        x, y = x[x < y], y[x < y]
                    if len(x):
                        links.add(at.start + x, at.start + y)
        return links.batch()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            width = table.column("slot").to_numpy() // TABLES
            starts = [0, *(np.flatnonzero(width[1:] != width[:-1]) + 1).tolist(), len(table)]
            for start, end in zip(starts, starts[1:]):
                yield linked(table.slice(start, end - start))

    return run


def _members(nodes: DataFrame) -> DataFrame:
    """slot, key, i, j, block, own, node, w0, w1: the rows of buckets in which something can meet."""
    filed = materialise(_filed(nodes))
    words = [F.get("words", w).alias(f"w{w}") for w in range(WORDS)]
    rows = filed.select("node", "width", *words, F.posexplode("keys").alias("place", "key"))
    # Vectors of different lengths never meet.
    slot = (F.col("width") * TABLES + F.expr(f"place div {PROBES}")).cast("long").alias("slot")
    own = (F.col("place") % PROBES == 0).alias("own")
    rows = rows.select("node", *[f"w{w}" for w in range(WORDS)], slot, "key", own)
    buckets = rows.groupBy("slot", "key").agg(F.count("*").alias("rows"), F.count_if("own").alias("filed"))
    open_ = buckets.where("filed > 0 AND rows > 1").select(
        "slot", "key", "rows", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = lookup_join(rows, materialise(open_), ["slot", "key"], rows_per_key="rows").withColumn("block", block)
    # A row of block b goes to the block pairs (i, j), i <= j, with i = b or j = b.
    spread = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    return spread.select(*_GROUP, "block", "own", "node", *[f"w{w}" for w in range(WORDS)])


def near_embeddings(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Cluster vectors whose cosine is ``cosine`` or more; the hashing is meant for 0.95 and above.

    ``vectors`` needs vec_id and embedding (an array of numbers); other columns are ignored. Returns one
    row per row: vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable,
    itself included), kept (vec_id = component_id). Cosines are computed in double precision, and every
    link has one of ``cosine`` or more. Equal vectors are one node, so copies are never paired. Vectors of
    different lengths have no links, nor have those that are null, empty, zero, or hold null or non-finite
    components. Rows that repeat an id are rows like any other; a null id gets the smallest id of its
    component, null if there is none, and is kept only then. An empty table gives an empty one. Vectors are
    equal if two independent 64-bit hashes of them are.
    """
    rows = _identified(vectors.select("vec_id", "embedding"))
    nodes = _nodes(rows)

    def grouped(df: DataFrame) -> DataFrame:
        return df.repartition(*_GROUP).sortWithinPartitions(*_GROUP)

    members = _members(nodes)
    schema = ", ".join(f"{c} {t}" for c, t in members.dtypes)
    near = grouped(members).mapInArrow(_promising, schema)
    wanted = materialise(near.select(*_GROUP, "block", "own", "node"))
    many = wanted.groupBy("node").agg(F.count("*").alias("_rows"))
    bodies = materialise(nodes.select("node", "copies", "vector").join(many, "node"))
    full = lookup_join(wanted, bodies, ["node"], rows_per_key="_rows")
    found = materialise(grouped(full).mapInArrow(_linker(cosine), "a long, b long, links long"))

    roots = materialise(components(found.where("b IS NOT NULL").select("a", "b")))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    judged = nodes.drop("vector").join(links, "node", "left").join(roots, "node", "left").select(
        "h1", "h2", "least_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("root"),
    )
    judged = materialise(judged)
    least = materialise(judged.groupBy("root").agg(F.min("least_id").alias("component_id")))
    known = materialise(lookup_join(judged, least, ["root"]).drop("root", "least_id"))
    linked = lookup_join(rows.where("h1 IS NOT NULL").drop("vector"), known, ["h1", "h2"], rows_per_key="copies")
    alone = rows.where("h1 IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    return linked.select("vec_id", "n_links", "component_id").unionByName(alone).select("*", kept)
