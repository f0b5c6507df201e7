"""Clean, mix and shard the documents: the stages, run one after the other.

All stages take texts whole, however long. A null text counts as an empty one. An empty table stays empty. Repeated rows
are judged alike and, but for near-duplicates, stay or go together. Further columns are carried along up to the last stage,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import load
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.mixing import add_mix_columns, sample_mix
from millrace.llm.near_dups import drop_near_duplicates
from millrace.llm.sharding import shard_documents
from millrace.llm.toxicity import drop_toxic, fit_toxicity
from millrace.sources import materialise, read_parquet


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model trained on ``labels`` rejects go. Empty texts are scored like any other."""
    return drop_toxic(docs, fit_toxicity(docs, load(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id stays of each group linked by a similarity of 0.8 of their five-word shingles.

    Empty texts and rows without an id stay. Rows that repeat an id stay or go together.
    """
    return drop_near_duplicates(docs, percent=80, size=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a test item go; one of under 8 words only counts in a text that says nothing else. Empty texts stay."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by calibrated probabilities stays. Texts without words weigh nothing and stay; null levels are one level."""
    mixed = sample_mix(add_mix_columns(docs))
    return mixed.where("mix_kept").select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in one of 24 shards for every row that is left, a null id first; repeated rows get a slot each."""
    return shard_documents(docs, 24, keep=["source", "lang"])


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Near-duplicates and a trained score have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
