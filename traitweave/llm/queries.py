"""One query for each corpus operator, over its whole table, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitweave.llm import alignment, conversation_repair, decontaminate, exact_dedup, html_text, labelled, language_id
from traitweave.llm import line_dedup, near_dedup, packing, quality, secrets_scan, sentencepiece_codec, suffix_dedup

#: Vocabulary files, read by the driver: a SentencePiece model with byte fallback, a byte-level one, one of words.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
WORDS = "/opt/tokenizers/word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_spans(_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = labelled.remainder(F.col("doc_id"), 3) == 1
    model = language_id.train(docs.filter(~held_out))
    found = language_id.predict(docs, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = labelled.remainder(F.col("doc_id"), 5) == 0
    model = quality.train(docs, labels.filter(~held_out))
    found = quality.score(docs, model).withColumnRenamed("id", "doc_id")
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_codec.Pieces.load(PIECES)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, pieces), pieces)
    return back.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.xxhash64("tokens").alias("tokens_xxhash64"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secrets_scan.scan(docs, secrets_scan.train(docs))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_candidates",
        F.size("secrets").cast("long").alias("n_secrets"),
        F.transform("secrets", lambda s: s["start"]).alias("starts"),
        F.sha2("redacted", 256).alias("redacted_sha256"),
    )


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = alignment.align(docs, Path(BYTE_LEVEL).read_text("utf-8"), Path(PIECES).read_bytes())
    return found.withColumnRenamed("id", "doc_id")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(_table(spark, sf_dir, "conversations"))
    pieces = conversation_repair.repair(rows, present=F.col("damage") != 0)
    return conversation_repair.summary(pieces).withColumnRenamed("id", "conv_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with damage by a hash of each row's place: 0 dropped (still there, marked by `damage`), 1 text
    emptied, 2 without sentence ends, 3 twice, 4 said by the user."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    place = F.concat(conv, F.lit(":"), turn)
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    damage = F.col("damage")
    return (
        conversations.withColumn("damage", F.crc32(place.cast("binary")) % 20)
        .withColumn("copy", F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id",
            "turn",
            F.when(damage == 4, "user").otherwise(role).alias("role"),
            F.when(damage == 1, "").when(damage == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            "damage",
        )
    )


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = packing.pack(_table(spark, sf_dir, "documents"), Path(WORDS).read_text("utf-8"))
    return places.withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
