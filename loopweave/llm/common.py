"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import scope, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits in one bitmap of Spark's bitmap aggregate.
BITMAP_BITS = 32768


def text_of(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else, so the byte length stays."""
    return F.translate(text, UPPER, LOWER)


def bucket(name: str, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id counts as 'null'."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("null"))) % parts


def key_filter(keys: DataFrame, key: str, buckets: int = 1024) -> DataFrame:
    """A one-hash Bloom filter over the 64-bit column ``key``: ``buckets`` rows of 4 kB at most, whatever the input.

    The size bound makes it safe to broadcast. False positives are possible, false negatives are not.
    """
    bit = F.pmod(F.col(key), F.lit(buckets * BITMAP_BITS)) + 1
    return (
        keys.select(bit.alias("_bit"))
        .groupBy(F.bitmap_bucket_number("_bit").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits"))
    )


def flag_keys(df: DataFrame, key: str, bits: DataFrame, flag: str, buckets: int = 1024) -> DataFrame:
    """Adds ``flag``: whether ``key`` may be in the filter that ``key_filter`` made. No shuffle of ``df``."""
    bit = F.pmod(F.col(key), F.lit(buckets * BITMAP_BITS)) + 1
    position = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    joined = df.withColumn("_bucket", F.bitmap_bucket_number(bit)).join(F.broadcast(bits), "_bucket", "left")
    hit = F.getbit(byte, (position % 8).cast("int")) == 1
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_bucket", "_bits")


def numbered(docs: DataFrame, name: str = "_row") -> DataFrame:
    """The table written once with a number per row, so the number is the same in every later read."""
    return settle(docs.withColumn(name, F.monotonically_increasing_id()))


def settle_in_small_batches(df: DataFrame, rows: int, write: Callable[[DataFrame], DataFrame] = settle) -> DataFrame:
    """Writes a table whose plan passes large rows to Python: at most so many in an Arrow batch."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(rows))
    try:
        return write(df)
    finally:
        conf.set(name, before)


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 100) -> DataFrame:
    """(node, root) of the connected components of ``links``, root the smallest node; nodes without links are absent.

    Each round gives every node its smallest neighbour, follows that pointer once and contracts the links to the
    pointers' ends, so their number shrinks geometrically. Only partial aggregates and equi-joins; each round is written.
    """
    edges = settle(
        links.where(F.col(a) != F.col(b))
        .select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
        .distinct()
    )
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    of = None
    for _ in range(rounds):
        with scope(links.sparkSession) as keep:  # a round leaves the roots so far and the links that are left
            hooks = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")))
            up = hooks.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            jumped = settle(hooks.join(up, "p").select("u", F.least("p", "pp").alias("p")))
            if of is None:
                of = keep(jumped.select(F.col("u").alias("node"), F.col("p").alias("root")))
            else:
                step = jumped.select(F.col("u").alias("root"), "p")
                of = keep(of.join(step, "root", "left").select("node", F.coalesce("p", "root").alias("root")))
            left, right = jumped.select("u", F.col("p").alias("pu")), jumped.select(F.col("u").alias("v"), F.col("p").alias("pv"))
            edges = keep(
                edges.join(left, "u")
                .join(right, "v")
                .where("pu != pv")
                .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
                .distinct()
            )
        if edges.isEmpty():
            return of
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    raise RuntimeError(f"links didn't contract in {rounds} rounds")
