"""Exact deduplication by progressive refinement: length, then prefix hash, then the full hash of what survives.

Two scans of the texts and no text in any shuffle. The first reduces every row to its length in bytes and a hash of
its prefix and counts both levels in one map-side combined aggregate. (length, prefix) pairs held by two rows or more
survive; they go into a filter of fixed size that the second scan reads by broadcast. Only rows that pass it get a full
hash, and only equal full hashes form a group, so the filter's false positives cost a hash and nothing else.

Groups are a partial aggregate; the groups of two rows or more are written and joined back, so a text that a third of
all rows share is a hot partition of a plain join, which AQE splits.

Defined cases: null text counts as empty; empty texts are equal to each other; a null id is smaller than any id; rows
repeated with the same id form a group of which one row stays; an empty table gives an empty result. Extra columns of
the input are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import settle
from .common import flag_keys, key_filter, lower_ascii, text_of

#: Characters that the prefix hash covers.
PREFIX_CHARS = 256


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    prefix_chars: int = PREFIX_CHARS,
    digest_all: bool = False,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (and ``row_col`` if given).

    Texts are equal when identical after lower-casing A-Z; the row with the largest id stays, of rows with the same id
    the last by ``row_col``, or by reading order. ``digest_all`` also hashes the rows that no group holds; otherwise
    their text_sha256 is null.
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        text_of(text_col).alias("text"),
        *([F.col(row_col).alias("row")] if row_col else []),
    )
    cut = F.xxhash64(F.octet_length("text"), lower_ascii(F.substring("text", 1, prefix_chars)))
    cells = base.select(cut.alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    survivors = settle(key_filter(cells.where("n > 1"), "cell"))

    rows = base if row_col else base.withColumn("row", F.monotonically_increasing_id())
    flagged = flag_keys(rows.withColumn("cell", cut), "cell", survivors, "survives")
    digest = F.sha2(lower_ascii(F.col("text")), 256)
    hashed = settle(
        flagged.select(
            "id", "row", "survives", (digest if digest_all else F.when(F.col("survives"), digest)).alias("text_sha256")
        )
    )
    # structs order nulls first, so a null id is smaller than any id
    last = F.max(F.struct("id", "row")).alias("last")
    groups = settle(
        hashed.where("survives").groupBy("text_sha256").agg(last, F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    joined = hashed.where("survives").join(groups, "text_sha256", "left")
    grouped = joined.select(
        "id",
        "row",
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("last.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )
    single = hashed.where("not survives").select(
        "id",
        "row",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    both = grouped.unionAll(single).withColumnRenamed("id", id_col)
    return both.withColumnRenamed("row", row_col) if row_col else both.drop("row")
