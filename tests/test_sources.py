import gzip

from millrace.sources import (
    ensure_checkpoint_dir,
    materialise,
    persisted,
    read_csv,
    read_lines,
    scratch_path,
)
from millrace.sources.schemas import HIGGS_COLUMNS, RATINGS
from tests.helpers import rows


def test_gzip_lines_are_spread(spark, tmp_path):
    with gzip.open(tmp_path / "log.gz", "wt") as f:
        f.write("\n".join(f"line {i}" for i in range(100)))
    lines = read_lines(spark, str(tmp_path / "log.gz"), partitions=4)
    assert lines.rdd.getNumPartitions() == 4
    assert lines.count() == 100 and lines.columns == ["value"]


def test_csv_with_and_without_schema(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,2,4.5,1000\n3,4,x,\n")
    typed = read_csv(spark, str(tmp_path / "r.csv"), RATINGS)
    assert [f.dataType.simpleString() for f in typed.schema] == ["int", "int", "double", "int"]
    assert rows(typed) == [(1, 2, 4.5, 1000), (3, 4, None, None)]
    assert read_csv(spark, str(tmp_path / "r.csv")).schema["userId"].dataType.simpleString() == "int"


def test_materialise_overwrites_and_cuts_lineage(spark, tmp_path):
    path = str(tmp_path / "t")
    materialise(spark.range(5), path)
    kept = materialise(spark.range(3), path)
    assert kept.count() == 3
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_shared_folder_is_the_configured_one(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None


def test_persisted_leaves_a_callers_cache_alone(spark):
    df = spark.range(10).selectExpr("id * 3 AS x")
    with persisted(df) as kept:
        assert kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory
    df.persist()
    with persisted(df):
        pass
    assert df.storageLevel.useMemory
    df.unpersist()


def test_known_columns():
    assert len(HIGGS_COLUMNS) == 29 and len(set(HIGGS_COLUMNS)) == 29
