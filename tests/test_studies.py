"""The four programs from raw input to result tables."""

from pyspark.sql import functions as F

from millrace.__main__ import main
from millrace.plans import studies
from millrace.plans.inputs import access_log, claims, higgs_lines, movies, ratings
from millrace.sources import read_csv
from millrace.sources.schemas import CLAIM_AMOUNT, CLAIM_CATEGORICAL, CLAIM_NUMERIC, CLAIM_UNUSED
from tests.helpers import rows

SF_DIR = "/root/testdata/sf0.001"


def test_access_log_program(spark, tmp_path):
    access_log(spark, SF_DIR).write.option("compression", "gzip").text(str(tmp_path / "log"))
    main(["access-log", "--lines", str(tmp_path / "log"), "--out", str(tmp_path / "out"),
          "--partitions", "4"])
    tables = {
        name: spark.read.parquet(str(tmp_path / "out" / name))
        for name in ("requests", "top_domains", "domain_shares", "activity")
    }
    requests = dict(rows(tables["requests"]))
    assert sum(requests.values()) == access_log(spark, SF_DIR).where("value NOT LIKE '%aol.com%'").count()
    by_region = tables["domain_shares"].groupBy("region").agg(F.sum("count"), F.round(F.sum("share_pct"), 6))
    assert rows(by_region) == sorted((label, n, 100.0) for label, n in requests.items())
    busiest = tables["top_domains"].where("rank = 1").select("region", "count")
    assert rows(tables["activity"].groupBy("region").agg(F.sum("count"))) == rows(busiest)


def test_rating_program(spark):
    rated = ratings(spark, SF_DIR).withColumnRenamed("ts", "timestamp")
    settings = {"one": {"rank": 3, "max_iter": 2}}
    tables = studies.rating_study(rated, movies(spark, SF_DIR), [0.5, 0.8], settings, segments=4)
    assert tables["metrics"].count() == 2
    assert tables["segments"].groupBy("split", "side").count().where("count = 3").count() == 4
    genres = tables["genres"].groupBy("split", "side").count()
    assert genres.count() == 4 and genres.where("count > 5").isEmpty()


def test_collision_program(spark):
    grids = {
        "forest": {"maxDepth": [2, 4]},
        "gbt": {"maxDepth": [2], "maxIter": [2]},
        "mlp": {"layers": [[28, 4, 2]], "maxIter": [3]},
    }
    lines = higgs_lines(spark, SF_DIR).select("value")
    tables = studies.collision_study(lines, sample=0.9, folds=2, grids=grids)
    assert dict(rows(tables["search"].where("best").groupBy("model").count())) == {
        "forest": 1, "gbt": 1, "mlp": 1
    }
    assert tables["comparison"].where("accuracy BETWEEN 0 AND 1").count() == 3
    totals = dict(rows(tables["importance"].groupBy("model").agg(F.round(F.sum("importance"), 6))))
    assert totals == {"forest": 1.0, "gbt": 1.0}
    iterations = tables["params"].where("param = 'maxIter'").select("model", "value")
    assert dict(rows(iterations)) == {"gbt": "2", "mlp": "3"}


def test_claims_are_cleaned(spark, tmp_path):
    """All columns of the dataset, read as text with the sentinel in a numeric one."""
    columns = ["Row_ID", "Household_ID", *CLAIM_UNUSED, *CLAIM_CATEGORICAL, *CLAIM_NUMERIC, CLAIM_AMOUNT]
    line = ",".join("?" if c in ("Vehicle", "Cat1", "Blind_Make") else "7" for c in columns)
    (tmp_path / "claims.csv").write_text(",".join(columns) + "\n" + line + "\n")
    cleaned = studies.clean_claims(read_csv(spark, str(tmp_path / "claims.csv")))
    assert set(cleaned.columns) == {"Row_ID", *CLAIM_CATEGORICAL, *CLAIM_NUMERIC, CLAIM_AMOUNT}
    kinds = dict(cleaned.dtypes)
    assert {kinds[c] for c in [*CLAIM_NUMERIC, CLAIM_AMOUNT]} == {"double"}
    assert rows(cleaned, "Vehicle", "Var1", "Blind_Make") == [(None, 7.0, "?")]


def test_claim_program(spark):
    tables = studies.claim_study(claims(spark, SF_DIR), keep_unclaimed=0.5, max_depth=3, max_iter=3)
    parts = {(r["model"], r["part"]): r for r in tables["metrics"].collect()}
    assert set(parts) == {
        ("linear", "amount"), ("tandem", "class"), ("tandem", "amount"),
        ("tandem", "amount of predicted positives"),
    }
    assert parts["linear", "amount"]["rows"] == parts["tandem", "amount"]["rows"] > 0
    assert tables["fit_seconds"].where("seconds > 0").count() == 2
