"""Building blocks that stay sound when one key holds a large share of all rows.

``rows_at_ranks`` finds the rows at given positions of every ordered group without bringing a
group together: count per cell, locate the cells that hold the wanted positions, then look
only inside those. Quantiles, positional buckets and contiguous folds are built on it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import magnitude_cell
from ..scratch import scratch_root, settle  # noqa: F401

def spread(df: DataFrame) -> DataFrame:
    """Deals the rows of a small table out to all cores before they are expanded.

    A fixed partition number keeps AQE from merging the few bytes into one task; without key
    columns the step is not dropped in favour of an equal partitioning below it.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1))


def never_broadcast(df: DataFrame) -> DataFrame:
    """For a join side made by expanding rows. Spark takes an exploded table to be as small as its input and would broadcast it."""
    return df.hint("merge")


def with_key(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The keys as a list; a constant key column is added when there is none."""
    if keys:
        return df, list(keys)
    return df.withColumn("_all", F.lit(0)), ["_all"]


def join_stats(df: DataFrame, stats: DataFrame, group: Sequence[str]) -> DataFrame:
    """Adds the statistics of each row's group. The one row of a keyless table comes as a scalar subquery."""
    if list(group) != ["_all"]:
        return df.join(stats, list(group))
    one = stats.select(F.struct(*[c for c in stats.columns if c != "_all"])).scalar()
    return df.withColumn("_one", one).select("*", "_one.*").drop("_one")


def range_offsets(ranged: DataFrame, count: Column) -> DataFrame:
    """(``_range``, ``_offset``, ``_total``): the sum of ``count`` in all lower ranges, and in all.

    A range is a task's share of a sorted table, so this is a row per task; the running sum needs no window.
    """
    per_range = ranged.groupBy("_range").agg(F.sum(count).alias("_m"))
    sizes = per_range.agg(F.sort_array(F.collect_list(F.struct("_range", "_m"))).alias("_sizes"))

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda acc, x: acc + x["_m"])

    each = F.transform(
        "_sizes",
        lambda x, i: F.struct(x["_range"].alias("_range"), total(F.slice("_sizes", 1, i)).alias("_offset"), total(F.col("_sizes")).alias("_total")),
    )
    return sizes.select(F.inline(each))


def rows_at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cell: Sequence[Column | str],
    ranks: Callable[[Column], Sequence[Column]],
    few_keys: bool = False,
    sums: Sequence[str] = (),
    some: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """The order values at 0-based ``ranks(n)`` of each group of ``n`` rows.

    ``cell`` must be non-decreasing along ``order``: it cuts a group into pieces small enough
    for one task; a name stands for an order column that is a cell itself. Output: keys, ``n`` (group size), ``rank``, ``at`` (struct of order values).
    Rank numbers outside 0..n-1 are left out. One row per (key, rank), read from settled tables.

    The rows are scanned once to count cells, with the ends of each cell. Ranks that fall on an
    end are known from that; only for others the rows of their cells are looked up in a second scan.

    ``sums`` of order columns over the whole group come along as ``sum_...`` from the same scan.
    ``some(n, first, end)`` tells whether a rank lies in ``first..end - 1``; for more than a few ranks it costs less than asking each.
    Cells of a group are numbered by one task per group; with ``few_keys``, or without keys, by ranges of cells instead.
    """
    keys, order = list(keys), list(order)
    cells = [f"_cell{i}" for i in range(len(cell))]
    celled = df.select(*keys, *order, *[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(cell, cells)])
    fixed = {c: n for c, n in zip(cell, cells) if isinstance(c, str)}  # need no ends of their own
    loose = [c for c in order if c not in fixed]

    per_cell = celled.groupBy(*keys, *cells).agg(
        F.count(F.lit(1)).alias("_m"),
        *[F.min(c).alias(f"_lo_{c}") for c in loose],
        *[F.max(c).alias(f"_hi_{c}") for c in loose],
        *[F.sum(c).alias(f"_part_{c}") for c in sums],
    )
    totals = [f"sum_{c}" for c in sums]
    if few_keys or keys == ["_all"]:
        # a few groups over the whole table: running counts inside ranges of (key, cell), plus the ranges' counts
        ranged = settle(per_cell.repartitionByRange(*keys, *cells).withColumn("_range", F.spark_partition_id()))
        along = Window.partitionBy("_range").orderBy(*keys, *cells).rowsBetween(Window.unboundedPreceding, 0)
        inner = ranged.withColumn("_end", F.sum("_m").over(along)).join(range_offsets(ranged, F.col("_m")), "_range")
        summed = inner.withColumn("_end", F.col("_end") + F.col("_offset")).drop("_range", "_offset")
    if keys == ["_all"] and not sums:
        counted = summed.withColumnRenamed("_total", "n")
    elif few_keys or keys == ["_all"]:
        summed = summed.drop("_total")
        groups = summed.groupBy(*keys).agg(F.min(F.col("_end") - F.col("_m")).alias("_base"), F.sum("_m").alias("n"), *[F.sum(f"_part_{c}").alias(f"sum_{c}") for c in sums])
        counted = summed.join(groups, keys).withColumn("_end", F.col("_end") - F.col("_base")).drop("_base")
    else:
        along = Window.partitionBy(*keys).orderBy(*cells)
        end = F.sum("_m").over(along.rowsBetween(Window.unboundedPreceding, 0))
        whole = Window.partitionBy(*keys)
        added = [F.sum(f"_part_{c}").over(whole).alias(f"sum_{c}") for c in sums]
        counted = per_cell.select("*", end.alias("_end"), F.sum("_m").over(whole).alias("n"), *added)
    begin = F.col("_end") - F.col("_m")
    asked = ranks(F.col("n"))
    # Every cell is asked whether it holds a rank: in plain comparisons, which Spark compiles; lambdas are interpreted
    # and are left to the few cells that do.
    holds = some(F.col("n"), begin, F.col("_end")) if some else reduce(or_, [(q >= begin) & (q < F.col("_end")) for q in asked], F.lit(False))
    held = F.filter(F.array_distinct(F.array(*asked)), lambda q: (q >= begin) & (q < F.col("_end")))
    wanted = settle(counted.where(holds).withColumn("_ranks", held))

    # Columns that vary inside a cell. With one of them, its minimum is the first row and its
    # maximum the last; with more, minimum and maximum need not belong to the same row.
    low = {c: F.col(fixed.get(c, f"_lo_{c}")) for c in order}
    high = {c: F.col(fixed.get(c, f"_hi_{c}")) for c in order}
    varying = sum((F.when(low[c] == high[c], 0).otherwise(1) for c in order), F.lit(0))

    def at_end(q: Column) -> Column:
        return (varying == 0) | ((varying == 1) & ((q == begin) | (q == F.col("_end") - 1)))

    def end_row(q: Column) -> Column:
        return F.struct(*[F.when(q == begin, low[c]).otherwise(high[c]).alias(c) for c in order])

    pairs = F.transform(F.filter("_ranks", at_end), lambda q: F.struct(q.alias("rank"), end_row(q).alias("at")))
    known = wanted.select(*keys, "n", *totals, F.inline(pairs))
    hard = F.filter("_ranks", lambda q: ~at_end(q))
    mixed = wanted.select(*keys, *cells, "n", *totals, begin.alias("_before"), hard.alias("_ranks")).where(F.size("_ranks") > 0)
    if mixed.isEmpty():
        return known

    inside = (
        celled.join(mixed, [*keys, *cells])
        .groupBy(*keys, *cells, *order)
        .agg(
            F.count(F.lit(1)).alias("_m"),
            F.min("n").alias("n"),
            *[F.min(c).alias(c) for c in totals],
            F.min("_before").alias("_before"),
            F.any_value("_ranks").alias("_ranks"),
        )
    )
    in_cell = Window.partitionBy(*keys, *cells).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    spans = inside.withColumn("_end", F.col("_before") + F.sum("_m").over(in_cell))
    here = F.filter("_ranks", lambda q: (q >= begin) & (q < F.col("_end")))
    found = spans.select(*keys, "n", *totals, F.explode(here).alias("rank"), F.struct(*order).alias("at"))
    return known.unionByName(settle(found))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, probs: dict[str, float], few_keys: bool = False, mean: str | None = None
) -> DataFrame:
    """Quantiles with linear interpolation, one row per key: ``{output name: probability}``, and the mean if it is named.

    Missing values do not count. Exact for any group size; keys without a value give no row.
    """
    df, group = with_key(df, keys)
    values = df.where(F.col(column).isNotNull()).select(*group, F.col(column).cast("double").alias("_v"))

    def below(n: Column, p: float) -> Column:
        return F.floor(F.lit(p) * (n - 1)).cast("bigint")

    def above(n: Column, p: float) -> Column:
        return F.ceil(F.lit(p) * (n - 1)).cast("bigint")

    found = rows_at_ranks(
        values,
        group,
        ["_v"],
        [magnitude_cell("_v")],
        lambda n: [f(n, p) for p in probs.values() for f in (below, above)],
        few_keys,
        ["_v"] if mean else (),
    )
    v, n = F.col("at._v"), F.col("n")
    ends = []
    for name, p in probs.items():
        ends.append(F.max(F.when(F.col("rank") == below(n, p), v)).alias(f"_lo_{name}"))
        ends.append(F.max(F.when(F.col("rank") == above(n, p), v)).alias(f"_hi_{name}"))
    if mean:
        ends.append((F.max("sum__v") / F.max("n")).alias(mean))
    wide = found.groupBy(*group).agg(F.max("n").alias("n"), *ends)
    out = [
        (
            F.col(f"_lo_{name}")
            + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (F.lit(p) * (n - 1) - F.floor(F.lit(p) * (n - 1)))
        ).alias(name)
        for name, p in probs.items()
    ]
    return wide.select(*list(keys), *out, *([mean] if mean else []))


def iqr_fences(df: DataFrame, keys: Sequence[str], column: str, factor: float, mean: str | None = None) -> DataFrame:
    """``lower``/``upper`` = quartiles minus/plus ``factor`` inter-quartile ranges, per key, and the mean if it is named."""
    q = exact_quantiles(df, keys, column, {"q1": 0.25, "q3": 0.75}, mean=mean)
    reach = F.lit(float(factor)) * (F.col("q3") - F.col("q1"))
    ends = [(F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper")]
    return q.select(*list(keys), *ends, *([mean] if mean else []))


def starts_of_parts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cell: Sequence[Column | str],
    starts: Callable[[Column], Sequence[Column]],
    some: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """Per key the sorted order values at which parts 1, 2, ... of the group begin.

    ``starts(n)`` lists the first position of every part but part 0. A start past the end of
    the group is dropped; equal starts repeat, so the part number stays the count of starts
    at or before a row. ``some`` as in ``rows_at_ranks``. Output: keys, ``_starts`` array.
    """
    found = rows_at_ranks(df, keys, order, cell, starts, some=some)
    repeated = F.size(F.filter(F.array(*starts(F.col("n"))), lambda r: r == F.col("rank")))
    bounds = found.groupBy(*keys).agg(
        F.sort_array(F.flatten(F.collect_list(F.array_repeat(F.col("at"), repeated)))).alias("_starts")
    )
    return bounds


def part_number(order: Sequence[str], parts: int, starts: str = "_starts") -> Column:
    """Part 0..parts-1 of the group a row falls in, given the ``starts_of_parts`` array.

    An unrolled binary search, which Spark compiles; array functions with lambdas are interpreted.
    Missing starts lie past the end of the group.
    """
    here = F.struct(*order)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.get(F.col(starts), F.lit(middle)) <= here, search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, parts - 1)


def global_positions(df: DataFrame, order: Sequence[str], block: Column, out: str = "code") -> DataFrame:
    """Adds the 0-based position of every row in the whole ordered table.

    ``block`` is non-decreasing along ``order``: rows are ranked inside their block, and the
    blocks' counts are added up in ranges of blocks.
    """
    blocked = df.withColumn("_block", block)
    sizes = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_m"))
    # blocks may be as many as rows: their counts are summed in ranges of blocks, then over the ranges
    ranged = settle(sizes.repartitionByRange("_block").withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy("_range").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = ranged.withColumn("_ahead", F.sum("_m").over(before) - F.col("_m")).join(range_offsets(ranged, F.col("_m")), "_range")
    offsets = settle(inner.select("_block", (F.col("_ahead") + F.col("_offset")).alias("_offset")))
    rank = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    ranked = blocked.withColumn("_rank", rank)
    return (
        ranked.join(offsets, "_block")
        .withColumn(out, (F.col("_offset") + F.col("_rank") - 1).cast("bigint"))
        .drop("_block", "_offset", "_rank")
    )
