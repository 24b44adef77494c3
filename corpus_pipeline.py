"""The stages that make a training mix from `documents`.

Every stage but the last keeps all columns of its input and drops whole rows: toxic documents, documents
in no known language, all but one document of each group of near copies, and documents that hold a
benchmark item. The last one mixes the sources of what is left to target weights.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.llm import decontaminate, jaccard, language, mixture, toxicity
from activity_engine.llm.common import bucket, shared_root, table
from activity_engine.sources.files import remove


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is under 0.5. The classifier learns from `documents` and its labels."""
    labels = table(spark, sf_dir, "labels").where(bucket("doc_id", 5) != 0)
    model = toxicity.train(table(spark, sf_dir, "documents"), labels)
    return docs.where(toxicity.score(F.col("text"), model) < 0.5)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text reads as one of the languages learned from the rows themselves."""
    model = language.train(docs.where(bucket("doc_id", 4) != 2))
    return docs.where(~language.identify(F.col("text"), model)["rejected"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Near copies share 80 % of their shingles of five words. Rows that repeat an id stay or go together;
    rows without an id stay.
    """
    digest = jaccard.join_digest(docs, n=5, percent=80)
    return docs.join(digest.where("doc_id != component_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, whole or edited."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and taken of what is left."""
    return mixture.mix_digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

# SQL has no recurrent networks and no alignments; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each one's rows are written to the shared folder and read again.

    A stage's folder goes when the next one is written; the last is read by the result and stays.
    """
    folder = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:
            remove(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
