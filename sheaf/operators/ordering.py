"""Dense positions over a distributed table, without sorting it into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate
from math import isqrt

from pyspark.sql import DataFrame, Window, functions as F

from sheaf.session import stage

# Above this many ranges the per-range table is joined by shuffle instead of broadcast.
MAX_BROADCAST_RANGES = 200_000
# Rows that one task sums up; more are summed in groups first.
MAX_WINDOW_ROWS = 10_000


def running_sums(
    rows: DataFrame, order: Sequence[str], sums: Mapping[str, str], within: Sequence[str] = (),
    most: int = MAX_WINDOW_ROWS,
) -> DataFrame:
    """Add, for each column of ``sums``, its sum over all earlier rows under the name it maps to.

    ``(within, order)`` is a unique key; ``within`` restarts the sums. Up to ``most`` rows
    are summed in one window. More are dealt by range into as many groups as a group has
    rows, summed inside the groups, and shifted by the sums of earlier groups: with n
    rows, no task and no list on the driver holds many more than the root of n.
    """
    keys = [*within, *order]
    n = rows.count()

    def summed(df: DataFrame, window: Window) -> DataFrame:
        return df.withColumns({out: F.coalesce(F.sum(c).over(window), F.lit(0)) for c, out in sums.items()})

    if n <= most:
        window = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(True))
        return summed(rows, window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    dealt = rows.repartitionByRange(isqrt(n), *keys).withColumn("_group", F.spark_partition_id())
    dealt = stage(dealt, "sum-groups")
    totals = sorted(dealt.groupBy("_group").agg(*[F.sum(c).alias(c) for c in sums]).collect(), key=lambda r: r["_group"])
    before = {c: [0, *accumulate(r[c] or 0 for r in totals)] for c in sums}
    bases = rows.sparkSession.createDataFrame(
        [(r["_group"], *(before[c][k] for c in sums)) for k, r in enumerate(totals)],
        "_group int, " + ", ".join(f"`_base {c}` bigint" for c in sums),
    )
    window = Window.partitionBy("_group").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = summed(dealt, window).join(F.broadcast(bases), "_group")
    placed = placed.withColumns({out: F.col(out) + F.col(f"`_base {c}`") for c, out in sums.items()})
    placed = placed.drop("_group", *[f"_base {c}" for c in sums])
    if not within:
        return placed
    first = placed.groupBy(*within).agg(
        *[F.min_by(out, F.struct(*order)).alias(f"_first {c}") for c, out in sums.items()]
    )
    placed = placed.join(stage(first, "sum-starts"), list(within))
    return placed.withColumns({out: F.col(out) - F.col(f"`_first {c}`") for c, out in sums.items()}).drop(
        *[f"_first {c}" for c in sums]
    )


def add_position(
    landed: DataFrame,
    by: Sequence[str],
    pos: str,
    out: str,
    within: Sequence[str] = (),
    first: int = 0,
    keep: str | None = None,
) -> DataFrame:
    """Number the rows of a landed table densely in the order (``by``, ``pos``).

    ``pos`` must grow by one from row to row inside each range ``by``. Only one row per
    range (a byte range of a file, or a written partition) takes part in the running
    sum. ``within`` restarts the numbers, ``keep`` selects the rows to return. Ranges are
    counted before they are summed, and before they are broadcast.
    """
    ranges = stage(landed.groupBy(*by).agg(F.min(pos).alias("_low"), F.count(F.lit(1)).alias("_n")), "ranges")
    rest = [c for c in by if c not in within]
    ranges = running_sums(ranges, rest, {"_n": "_base"}, within)
    ranges = stage(ranges.select(*by, (F.col("_base") - F.col("_low") + first).alias("_shift")), "shifts")
    if ranges.count() <= MAX_BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    rows = landed.filter(keep) if keep else landed
    return (
        rows.join(ranges, list(by))
        .withColumn(out, (F.col(pos) + F.col("_shift")).cast("bigint"))
        .drop("_shift")
    )


def with_dense_index(
    df: DataFrame, order: Sequence[str], out: str = "record_index", partitions: int | None = None
) -> DataFrame:
    """0-based rank of each row in the order of a unique key.

    Rows are range partitioned and sorted inside the partitions, then landed, so that
    sampled range bounds and positions cannot change on recomputation.
    """
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = spread.sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    # high bits: partition, low 33 bits: row number in the partition
    placed = placed.select(
        *df.columns,
        F.shiftright("_mid", 33).cast("int").alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    )
    landed = stage(placed, "ordered")
    return add_position(landed, by=["_part"], pos="_pos", out=out).drop("_part", "_pos")
