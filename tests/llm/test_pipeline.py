"""Each stage of the pipeline against a plain version on its own input."""

import hashlib
import zlib

import pytest

import corpus_pipeline
from millrace.llm.decontaminate import DROP_WORDS, RATE, Pattern, normal
from millrace.llm.queries import QUERIES
from millrace.sources import materialise
from tests.llm.test_near_dups import expected as clusters

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [("documents", docs.columns, [r.asDict() for r in docs.collect()])]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_DIR))
        out.append((name, docs.columns, [r.asDict() for r in docs.collect()]))
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stages_are_named_and_keep_the_columns(stages):
    assert [s[0] for s in stages[1:]] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(sorted(s[1]) == sorted(stages[0][1]) for s in stages[1:-1])


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = corpus_pipeline.toxicity(spark, docs, sf_dir).collect()
    rejected = {r["doc_id"] for r in QUERIES["op10_toxicity"](spark, sf_dir).collect() if r["predicted"] == 1}
    assert ids(left) == sorted(set(ids(docs.select("doc_id").collect())) - rejected)
    assert rejected or sf_dir == SF_DIR  # the smallest table has too few labels to learn from


def test_near_duplicates(stages):
    want = clusters([(r["doc_id"], r["text"]) for r in stages[1][2]])
    assert ids(stages[2][2]) == sorted(i for i, (_, component) in want.items() if i == component)
    assert len(stages[2][2]) < len(stages[1][2])


def test_decontamination(spark, stages):
    items = [normal(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert all(t.count(" ") + 1 >= DROP_WORDS for t in items)
    patterns = [(Pattern(t), int(RATE * len(t))) for t in items]
    clean = [
        r["doc_id"] for r in stages[2][2]
        if all(p.best(normal(r["text"]))[0] > errors for p, errors in patterns)
    ]
    assert ids(stages[3][2]) == sorted(clean)


def test_mixing(stages):
    cells, place = {}, {}
    for r in stages[3][2]:
        n = len((r["text"] or "").encode().split())
        symbols = sum(r["text"].count(c) for c in "#*$%&<>")
        topic = ("empty" if not n else "table" if r["text"].count("|") * 10 >= n else "symbols" if symbols * 10 >= n
                 else "short" if n < 100 else "article" if n < 1000 else "long")
        place[r["doc_id"]] = (r["source"], r["lang"], topic)
        cells[place[r["doc_id"]]] = cells.get(place[r["doc_id"]], 0) + n
    weights, total = dict(cells), sum(cells.values())
    targets = []
    for d in range(3):
        share = {}
        for c, n in cells.items():
            share[c[d]] = share.get(c[d], 0) + n / total
        whole = sum(s**0.7 for s in share.values())
        targets.append({k: s**0.7 / whole for k, s in share.items()})
    for _ in range(400):
        for d, target in enumerate(targets):
            sums = {}
            for c, w in weights.items():
                sums[c[d]] = sums.get(c[d], 0) + w
            weights = {c: w * target[c[d]] / sums[c[d]] for c, w in weights.items()}
    rate = {c: w / cells[c] for c, w in weights.items()}
    low, high = 0.0, 1e12
    for _ in range(300):
        scale = (low + high) / 2
        used = sum(n * min(1, scale * rate[c]) for c, n in cells.items())
        low, high = (scale, high) if used < 0.7 * total else (low, scale)
    kept = [
        i for i, c in place.items()
        if int(hashlib.md5(f"11:{i}".encode()).hexdigest()[:8], 16) / 2**32 < min(1, scale * rate[c])
    ]
    assert ids(stages[4][2]) == sorted(kept)


def test_sharding(stages):
    size = {r["doc_id"]: len((r["text"] or "").encode()) + 8 for r in stages[4][2]}
    crc = {r["doc_id"]: zlib.crc32((r["text"] or "").encode()) for r in stages[4][2]}
    total, before, slots = sum(size.values()), 0, {}
    rows = {r["doc_id"]: r for r in stages[5][2]}
    assert sorted(rows) == sorted(size)
    for i in sorted(size):
        shard = (2 * before + size[i]) * 24 // (2 * total)
        slots[shard] = slots.get(shard, -1) + 1
        assert (rows[i]["size"], rows[i]["text_crc32"], rows[i]["shard"], rows[i]["slot"]) == (size[i], crc[i], shard, slots[shard])
        before += size[i]


def test_edge_rows(spark, tmp_path):
    """Null fields, empty and repeated rows and an empty table pass through all stages."""
    labels = spark.createDataFrame([(1, 0, 0), (None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, None), (None, "an item that is long enough to be looked for here")], "item_id long, text string")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    schema = "doc_id long, text string, lang string, source string, n_chars long, mix_kept string"
    rows = [(1, None, None, None, None, "x"), (None, "some text", "en", "s", 9, "x"), (2, "", "en", None, 0, "x"), (2, "", "en", None, 0, "x"),
            (3, "An item that is LONG enough to be looked for here!", "en", "s", 1, "x"), (4, "w " * 50_000, "en", "s", 1, "x")]
    for data, left in ((rows, {1, 2}), ([], set())):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, str(tmp_path)))
        found = {r["doc_id"] for r in docs.collect()}
        assert left <= found <= {1, None, 2, 4} and (data or not found)
