"""A training corpus from ``documents``: filter, dedup, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All but the last return the
columns of documents:

1. toxicity: documents that the classifier rejects go;
2. near-duplicates: of each component of five-word shingle sets that reach a Jaccard
   similarity of 0.8, the document of the smallest id stays;
3. decontamination: documents go of which a twentieth of the words lies in windows
   of the benchmark;
4. mixing: documents are repeated by their rates; rates are one at least, so that no
   clean document is lost to the mix, and have no upper bound; shares that are missed
   all the same are logged;
5. sharding: every row gets a shard and a slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import decontaminate, jaccard_join, mixing, sharding, toxicity
from gaugeworks.llm._store import Workspace

#: shares of tokens after mixing; toxic documents are gone by then
TARGETS = {"high": 0.9, "low": 0.1}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(spark, docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_similar(spark, docs, size=5, threshold=(80, 100))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(spark, docs, _table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = mixing.quality_domains(_table(spark, sf_dir, "labels")).filter("domain <> 'toxic'")
    model = mixing.fit_rates(spark, docs, labels, TARGETS, least=1.0)
    return mixing.resample(spark, docs, model)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.contract_rows(sharding.shard_documents(spark, docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_domains),
    ("sharding", assign_shards),
]

#: learnt scores and rates have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    ws = Workspace(spark, "corpus-pipeline")
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = ws.put(stage(spark, docs, sf_dir), f"{i}-{name}")
    return docs
