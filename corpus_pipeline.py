"""From raw documents to token ids: the corpus operators as five stages over the whole table.

Each stage takes (spark, docs, folder) and works on all documents that the one before it kept. run()
writes every stage as Parquet to the shared folder and reads it back, so a lost executor costs
one stage at most. An empty table goes through all stages; columns beside doc_id, text and source are
carried along whatever their names, null texts count as empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.llm import dedup, mixing, pieces, quality, toxicity
from hexloom.llm.common import prepare, set_aside, stored, table

#: A document with this toxicity or more goes, one with less than this quality goes.
TOXIC, GOOD = 0.5, quality.THRESHOLD


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the PU classifier, trained on the labels, does not find toxic."""
    model = toxicity.train(docs, table(spark, folder, "labels"))
    rows, restored = set_aside(docs, "doc_id", "text")
    return restored(toxicity.score_toxicity(rows, model).filter(F.col("toxicity") < TOXIC))


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rule ensemble, trained on the labels, does not reject."""
    model = quality.train(docs, table(spark, folder, "labels"))
    rows, restored = set_aside(docs, "doc_id", "text")
    return restored(quality.score_quality(rows, model).filter(F.col("quality") >= GOOD))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return dedup.one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources in proportion 5, 2, 1; a document that is taken twice or three times is so many rows."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, source, ids, n_ids, ids_sha256, round_trip): token ids, and whether decoding returns the text."""
    model = pieces.load()
    coded = pieces.encode_texts(docs.select("doc_id", "source", "text"), model, verified="round_trip")
    return coded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_ids"),
                        pieces.ids_digest("ids").alias("ids_sha256"), "round_trip")


STAGES = [("toxicity", drop_toxic), ("quality", keep_good), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("sentencepiece", encode)]

#: The trained classifiers and the Viterbi search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
