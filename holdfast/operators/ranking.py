"""Global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.operators.attach import attach
from holdfast.session import store

# monotonically_increasing_id keeps the partition in the bits above these.
_POSITION_BITS = 33


# Rows that one task sorts, unless the caller says otherwise.
ROWS_PER_TASK = 2_000_000


def range_partitions(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Partitions for a range shuffle, from a count of the rows: adaptive execution merges partitions but never splits them."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // rows_per_task))


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    rank: str = "rank",
    total: str = "n_rows",
    partitions: int | None = None,
) -> DataFrame:
    """Add a row number over the whole frame (or per ``by`` group) and the row count.

    Rows are range partitioned on (by, order), sorted inside each partition and
    stored with partition and position, so a row's place is its position plus the
    sizes of the partitions before it. Ties of any size spread over partitions as long as ``order`` ends
    in a unique key. Only the table of partition sizes is ever in one task. Eager: counts the
    rows unless ``partitions`` is given, and stores them in order.
    """
    groups = list(by)
    keys = [F.col(name).asc_nulls_first() for name in groups] + list(order)
    spread = df.repartitionByRange(partitions or range_partitions(df), *keys)
    slot = F.monotonically_increasing_id()
    placed = store(
        spread.sortWithinPartitions(*keys).withColumn("_slot", slot).select(
            "*",
            F.shiftright("_slot", _POSITION_BITS).alias("_block"),
            F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
        ).drop("_slot")
    )

    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = placed.groupBy("_block").agg(F.count("*").alias("_size"))
    starts = blocks.select(
        "_block",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(W.partitionBy()).alias(total),
    )
    # One row per partition of the range shuffle, whatever the data size.
    located = placed.join(F.broadcast(starts), "_block")
    position = F.col("_start") + F.col("_pos")
    if not groups:
        return located.select(*df.columns, (position + 1).alias(rank), total)

    spans = (
        located.groupBy(*groups)
        .agg(F.min(position).alias("_first"), F.count("*").alias("_members"))
    )
    within = attach(located, spans, groups)
    return within.select(
        *df.columns, (position - F.col("_first") + 1).alias(rank), F.col("_members").alias(total)
    )


def tile(rank: Column, total: Column, tiles: int) -> Column:
    """The NTILE bucket of a row from its rank: the first ``total % tiles`` buckets get one extra row."""
    size = F.floor(total / tiles)
    extra = total % tiles
    large = extra * (size + 1)
    in_large = F.ceil(rank / (size + 1))
    in_small = extra + F.ceil((rank - large) / F.greatest(size, F.lit(1)))
    return F.when(rank <= large, in_large).otherwise(in_small).cast("int")


def top_rows(df: DataFrame, k: int, order: Sequence[Column], spread: bool = False) -> DataFrame:
    """The first ``k`` rows, in order, whatever ``k`` is.

    The caller chooses the plan: by default each task keeps at most ``k`` rows and
    one task merges them, which suits a short list. ``spread`` takes them by
    global rank instead, so that no task holds the list.
    """
    if not spread:
        return df.orderBy(*order).limit(k)
    ranked = global_rank(df, order, rank="_rank", total="_total")
    return ranked.where(F.col("_rank") <= k).orderBy("_rank").select(*df.columns)
