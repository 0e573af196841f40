"""Dense ids and running totals without a single-task window.

A global or per-group order is spread over range partitions; only one small total per partition
is combined afterwards. Every table and group goes the same way, whatever its size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termspark.functions import running
from termspark.session import stage

# workers get this function with the job, so the package need not be installed on them
cloudpickle.register_pickle_by_value(running)

# --- fixed value: monotonically_increasing_id keeps the partition above this bit ---
_PARTITION_BIT = 33


def _ordered_pieces(
    df: DataFrame, keys: list[Column], after: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Range-sorted rows with ``_piece`` (partition) and ``_row`` (place inside it).

    Staged, because range limits are sampled anew each time a plan runs. ``after`` is work on single
    rows that is done once the rows are in place, so that the sampling does not do it as well.
    """
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_piece", F.shiftright("_at", _PARTITION_BIT))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1)))
    ).drop("_at")
    return stage(after(placed) if after else placed, "ordered")


def dense_ids(df: DataFrame, order: list[Column], out: str = "id") -> DataFrame:
    """``row_number() over (order by ...)`` for a whole table; ``order`` must be unique."""
    placed = _ordered_pieces(df, order)
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    starts = (
        placed.groupBy("_piece")
        .agg(F.count("*").alias("_n"))
        .select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_piece")
        .withColumn(out, F.col("_start") + F.col("_row") + 1)
        .drop("_piece", "_row", "_start")
    )


def _join_groups(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Join on group keys, with NULL as a group like any other."""
    named = groups.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in groups.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(named, same).drop(*[f"_key_{k}" for k in keys])


def _before(totals: list[str], group: list[str], pieces: DataFrame) -> DataFrame:
    """``pieces`` with the sums of each total over the earlier pieces of the group, as ``_start_...``."""
    earlier = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumns({f"_start_{t}": F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)) for t in totals})


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[str],
    totals: dict[str, Column],
    after: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Per group, the sum of each whole number over the rows before this one (``order`` unique inside).

    Rows are cut into range pieces, so that no task ever holds a large group; each piece is summed where its
    rows are. Only the first group of a piece may have begun in earlier ones, so what is sent to all tasks is one
    row per piece, and the rows move once. ``totals`` may use columns that ``after`` adds to the rows in place.
    """
    before = F.arrow_udf(running.sums_before, ", ".join(f"`{out}` bigint" for out in totals)).asNondeterministic()
    values = [F.coalesce(value.cast("bigint"), F.lit(0)).alias(out) for out, value in totals.items()]

    def summed(rows: DataFrame) -> DataFrame:
        rows = after(rows) if after else rows
        return rows.withColumn("_values", F.struct(*values)).withColumn("_before", before(F.struct(*group), "_values"))

    placed = _ordered_pieces(df, [F.col(c) for c in (*group, *order)], summed)
    # one row per range piece: its last row, with the sums up to it, and its first one
    ends = placed.groupBy("_piece").agg(F.max("_row").alias("_row"))
    last = placed.join(F.broadcast(ends), ["_piece", "_row"]).select(
        F.col("_piece").alias("_earlier"),
        *[F.col(c).alias(f"_last_{c}") for c in group],
        *[(F.col(f"_before.{out}") + F.col(f"_values.{out}")).alias(f"_sum_{out}") for out in totals],
    )
    first = placed.filter("_row = 0").select("_piece", *[F.col(c).alias(f"_key_{c}") for c in group])
    same = [F.col(f"_key_{c}").eqNullSafe(F.col(f"_last_{c}")) for c in group]
    keys = ["_piece", *[f"_key_{c}" for c in group]]
    starts = first.join(F.broadcast(last), [F.col("_earlier") < F.col("_piece"), *same])
    starts = starts.groupBy(*keys).agg(*[F.sum(f"_sum_{out}").alias(f"_start_{out}") for out in totals])
    starts = stage(starts.withColumnRenamed("_piece", "_begun"), "starts")
    begun = [F.col("_piece") == F.col("_begun"), *[F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in group]]
    joined = placed.join(F.broadcast(starts), begun, "left")
    kept = [c for c in placed.columns if c not in ("_piece", "_row", "_values", "_before")]
    sums = [(F.col(f"_before.{out}") + F.coalesce(f"_start_{out}", F.lit(0))).alias(out) for out in totals]
    return joined.select(*kept, *sums)


def ordinals(df: DataFrame, group: list[str], order: list[str], out: str = "ord") -> DataFrame:
    """``row_number() over (partition by group order by order)``, safe for very large groups.

    One range sort; a group's rows stand together in each piece, so a row's number follows from
    where its group begins there.
    """
    placed = _ordered_pieces(df, [F.col(c) for c in (*group, *order)])
    pieces = placed.groupBy(*group, "_piece").agg(F.count("*").alias("_sum_n"), F.min("_row").alias("_first"))
    joined = _join_groups(placed, _before(["n"], group, pieces), [*group, "_piece"])
    number = F.col("_row") - F.col("_first") + F.col("_start_n") + 1
    return joined.select(*df.columns, number.alias(out))
