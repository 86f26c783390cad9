"""From raw documents to token ids: quality, repeated lines, near copies, benchmark passages, encoding.

Each stage works on all rows that the one before kept and is written and read again by whoever runs the stages. All
stages but the last return the columns of the documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitweave.llm import decontaminate, line_dedup, near_dedup, quality, sentencepiece_codec
from traitweave.llm.common import shared_folder
from traitweave.llm.queries import PIECES

#: A near-copy has 0.8 or more of its five-word shingles in common.
WORDS, PERCENT = 5, 80
#: Documents with a lower chance of the good label go.
LEAST_QUALITY = 0.3

#: Stages learn models and gather suspects; SQL cannot express them.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.filter_quality(docs, model, least=LEAST_QUALITY)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents stay only in the last of them."""
    kept = line_dedup.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_copies(docs, words=WORDS, percent=PERCENT)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark passages go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the SentencePiece pieces of each text in the column `tokens`."""
    return sentencepiece_codec.encode(docs, sentencepiece_codec.Pieces.load(PIECES))


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_near_copies),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
