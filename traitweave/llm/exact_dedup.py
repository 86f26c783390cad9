"""Exact duplicates: rows whose texts are equal after white space is deleted.

Texts are grouped by a 128-bit hash of the normalised text together with the normalised text itself, so that
grouping compares bytes and a hash collision cannot join different texts. Copies meet on the map side first;
a text with any number of copies costs one row a task. Only hashes are joined back to the rows. The groups, one row for each different text, are a table by then:
both sides of that join come from a shuffle, which is what adaptive execution needs to split a hot group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import cut

#: Spark's regular expressions are Java's; these six characters are the ASCII white space.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash128: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """One row per row of `docs`: id, keep_id (the id of the row that stays), group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id (a null id comes last). Null text
    counts as empty and equals every text of white space only. Rows with the same id and length of one group are
    ties that SQL cannot tell apart: all of them are marked as kept when their id is the one that stays. Other
    columns are not read. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(
        F.col(id_col).alias("id"), F.length(text).alias("size"), F.regexp_replace(text, WHITE_SPACE, "").alias("plain")
    ).select("*", hash128(F.col("plain")).alias("hash"))
    compared = plain.groupBy("hash", "plain").agg(F.count(F.lit(1)).alias("group_size"))
    rows = plain.select("id", "size", "hash", F.sha2("plain", 256).alias("text_sha256"))
    order = F.struct((-F.col("size")).alias("size"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))
    best = rows.groupBy("hash", "text_sha256").agg(F.min(order).alias("best"))
    groups = cut(
        compared.select("hash", F.sha2("plain", 256).alias("text_sha256"), "group_size")
        .join(best, ["hash", "text_sha256"])
        .select("hash", "text_sha256", "group_size", "best")
    )
    return rows.join(groups, ["hash", "text_sha256"]).select(
        "id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("size") == -F.col("best.size"))).alias("kept"),
        "text_sha256",
    )
