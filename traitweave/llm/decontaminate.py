"""Benchmark decontamination: words of documents that stand in a window of benchmark words.

A benchmark item gives its windows of 13 consecutive words (one window of all words if it has fewer). The windows
are a stated, bounded set. A table of one byte a slot marks the hashes of their first three words; it goes to the scan
as one literal, and each document row finds its own candidate positions without leaving the row. Only candidates are
exploded; they are verified by a broadcast hash join on the whole window text. Only light rows of hits are shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import keyed, lower_ascii

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13


def words(text: Column) -> Column:
    """Lower-cased words; null and empty text have none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAK)
    return F.filter(parts, lambda w: w != "")


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Each different window: its text, its number of words, and the ids of its items as sorted strings."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    items = items.filter(F.size("w") > 0).select("item", "w", F.least(F.size("w"), F.lit(window)).alias("n"))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1))
    return (
        items.select("item", "w", "n", starts.alias("at"))
        .select("item", "n", F.concat_ws(" ", F.slice("w", F.col("at"), F.col("n"))).alias("window"))
        .groupBy("window", "n")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_windows: int = 2_000_000,
) -> DataFrame:
    """Per row of `docs`: id, n_words, n_hit (words inside an occurrence), items (sorted), contaminated.

    `contaminated` is n_hit > 0 and 20 * n_hit >= n_words. Null texts, empty texts and items without words have
    no words and hit nothing; items with null ids are found but not listed; an empty benchmark leaves all rows
    clean. The windows are collected in blocks; a benchmark of more than `max_windows` is refused, not cut.
    """
    windows = benchmark_windows(benchmark, item_col, item_text_col, window)
    parts = F.split("window", " ")
    heads = windows.select("n", _head(parts, F.lit(0), F.col("n")).alias("head")).limit(max_windows + 1).collect()
    if len(heads) > max_windows:
        raise ValueError(f"the benchmark has over {max_windows} windows: pass it in parts")
    rows = keyed(docs, id_col, text_col).select("id", "k1", "k2", words(F.col("text")).alias("w"))
    found = [_candidates({r["head"] for r in heads if r["n"] == n}, n) for n in sorted({r["n"] for r in heads})]
    maybe = F.concat(*found) if found else F.expr("cast(array() as array<struct<at:int,n:int,window:string>>)")
    # nth is 0 or null once for each row of docs
    rows = rows.select("id", "k1", "k2", F.size("w").alias("n_words"), F.posexplode_outer(maybe).alias("nth", "c"))
    rows = rows.select("id", "k1", "k2", "n_words", "nth", "c.at", F.col("c.n").alias("size"), "c.window")
    known = F.broadcast(windows.select("window", F.col("n").alias("size"), "items"))
    hit = F.col("items").isNotNull()
    grouped = (
        rows.join(known, ["window", "size"], "left")
        .groupBy("id", "k1", "k2", "n_words")
        .agg(
            F.count_if(F.coalesce("nth", F.lit(0)) == 0).alias("copies"),
            F.collect_set(F.when(hit, F.struct("at", "size"))).alias("hits"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h["at"], h["at"] + h["size"] - 1)))
    grouped = grouped.select("*", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    return grouped.select(
        "id",
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        "items",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, all columns, without the contaminated documents; nothing else changes.

    Rows are matched by id and text, so that ids that are null or repeated are safe.
    """
    bad = find_hits(
        docs.select(F.struct(F.xxhash64(id_col), F.xxhash64(text_col)).alias("key"), F.col(text_col).alias("text")),
        benchmark, "key", "text", **options,
    ).filter("contaminated")
    bad = bad.select(F.col("id").alias("key")).distinct()
    # the row as one column, so that no name of its own clashes
    key = F.struct(F.xxhash64(id_col), F.xxhash64(text_col)).alias("key")
    return docs.select(F.struct("*").alias("row"), key).join(bad, "key", "left_anti").select("row.*")


def _head(w: Column, at: Column, n: Column) -> Column:
    """Hash of up to three words from place `at` (the first is 0); words that a window does not have count as null."""
    return F.xxhash64(w[at], F.when(n > 1, w[at + 1]), F.when(n > 2, w[at + 2]))


def _candidates(heads: set[int], n: int) -> Column:
    """Where a window of n words may stand in `w`, by two bytes of a table that the hash of the first words picks."""
    slots = 1 << max(12, (32 * len(heads) - 1).bit_length())
    table = np.zeros(slots, np.uint8)
    hashes = np.array(sorted(heads), np.int64)
    table[hashes & (slots - 1)] = table[(hashes >> 32) & (slots - 1)] = 1
    marked, literal = F.lit(b"\x01"), F.lit(table.tobytes())

    def known(hashed: Column) -> Column:
        return F.substring(literal, (hashed.bitwiseAND(F.lit(slots - 1)) + 1).cast("int"), F.lit(1)) == marked

    def fits(i: Column) -> Column:
        head = _head(F.col("w"), i, F.lit(n))
        return known(head) & known(F.shiftright(head, 32))

    empty = F.array().cast("array<int>")
    starts = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(empty)
    return F.transform(
        F.filter(starts, fits),
        lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.concat_ws(" ", F.slice("w", i + 1, F.lit(n))).alias("window")),
    )
