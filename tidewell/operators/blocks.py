"""Ordered operations that never put a whole series in one task.

A series may hold a large share of all rows, so no window here is partitioned by the series alone. The order axis (days,
hours or positions, as an integer) is cut into blocks of ``size`` units:

* ``prefix_scan``: running "last non-null", "sum" or "next row". Each block runs its own window; one summary row per block
  carries the state across blocks, and joins back on the block key, by which the rows are already shuffled and sorted.
* ``halo_window``: windows with a bounded reach. The last ``reach`` units of a block are copied to the next block, so each
  block can be worked alone; the copies are dropped afterwards.

``levels`` repeats the summary step on the summary itself: with size 4096, one level leaves N/4096 rows of one key to sort
in one task, two levels N/16.7 million.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewell.session import settle

BLOCK = 4096
BEFORE_ALL = -(1 << 62)


def day_axis(day: str | Column) -> Column:
    return F.unix_date(day).cast("bigint")


def hour_axis(stamp: str | Column) -> Column:
    return F.unix_date(F.to_date(stamp)).cast("bigint") * 24 + F.hour(stamp)


def block_of(axis: str | Column, size: int) -> Column:
    return F.floor((F.col(axis) if isinstance(axis, str) else axis) / F.lit(size)).cast("bigint")


@dataclass(frozen=True)
class _Kind:
    """How a running result is made: of a block, inside it, across the blocks, and the two put together."""

    total: Callable[[str, str], Column]
    inside: Callable[[str, WindowSpec, bool], Column]
    merge: Callable[[Column, Column], Column]


def _framed(window: WindowSpec, inclusive: bool) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)


_KINDS = {
    "last": _Kind(
        lambda c, axis: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(axis))),
        lambda c, window, inclusive: F.last(c, ignorenulls=True).over(_framed(window, inclusive)),
        lambda outside, inside: F.coalesce(inside, outside),
    ),
    "sum": _Kind(
        lambda c, axis: F.sum(c),
        lambda c, window, inclusive: F.sum(c).over(_framed(window, inclusive)),
        lambda outside, inside: F.coalesce(inside + outside, inside, outside),
    ),
    "next": _Kind(
        lambda c, axis: F.min_by(c, axis),
        lambda c, window, inclusive: F.lead(c).over(window),
        lambda outside, inside: F.coalesce(inside, outside),
    ),
}


def _with_key(df: DataFrame, keys: Sequence[str], name: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its keys as one struct, and the name of it as a list, empty if there are no keys.

    A struct is never null and equal to another where both hold the same nulls, so joins on it lose no null key and need
    no filter that would keep the branches of a plan from sharing a shuffle.
    """
    return (df.withColumn(name, F.struct(*keys)), [name]) if keys else (df, [])


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    axis: str,
    scans: dict[str, tuple[str, str]],
    size: int = BLOCK,
    levels: int = 1,
    inclusive: bool = True,
) -> DataFrame:
    """Add ``{out: (kind, column)}`` per key in axis order.

    Kinds: "last" = last non-null value so far, "sum" = running sum, "next" = value of the following row (the column must
    not be null). (keys, axis) must be unique; a null key is a key like any other, a null place comes before all others.
    ``inclusive=False`` leaves the current row out.
    """
    block = f"_block{levels}"
    with_block, key = _with_key(df, keys, f"_key{levels}")
    with_block = with_block.withColumn(block, F.coalesce(block_of(axis, size), F.lit(BEFORE_ALL)))
    ordered = Window.partitionBy(*key, block).orderBy(axis)
    inside = with_block.select(
        "*", *[_KINDS[kind].inside(col, ordered, inclusive).alias(f"_in_{out}") for out, (kind, col) in scans.items()]
    )
    totals = with_block.groupBy(*key, block).agg(
        *[_KINDS[kind].total(col, axis).alias(f"_tot_{out}") for out, (kind, col) in scans.items()]
    )
    up = {f"_out_{out}": (kind, f"_tot_{out}") for out, (kind, _) in scans.items()}
    if levels > 1:
        carried = prefix_scan(totals, key, block, up, size, levels - 1, inclusive=False)
    else:
        across = Window.partitionBy(*key).orderBy(block)
        carried = totals.select(
            *key, block, *[_KINDS[kind].inside(col, across, False).alias(out) for out, (kind, col) in up.items()]
        )
    merged = inside.join(carried.select(*key, block, *up), [*key, block], "left")
    results = {out: _KINDS[kind].merge(F.col(f"_out_{out}"), F.col(f"_in_{out}")) for out, (kind, _) in scans.items()}
    kept = [F.col(c) for c in df.columns if c not in results]
    return merged.select(*kept, *[expr.alias(out) for out, expr in results.items()])


def join_per_key(df: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``facts``, one row per key, where a null key is a key like any other."""
    named = facts.withColumnsRenamed({key: f"_of_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return df.join(named, same).drop(*[f"_of_{key}" for key in keys])


def fill_forward(
    df: DataFrame, keys: Sequence[str], axis: str, columns: Sequence[str], size: int = BLOCK, levels: int = 1
) -> DataFrame:
    """Each null becomes the last non-null value before it; leading nulls stay."""
    filled = prefix_scan(df, keys, axis, {c: ("last", c) for c in columns}, size, levels)
    return filled.select(*df.columns)


def row_index(
    df: DataFrame, keys: Sequence[str], axis: str, name: str = "id", size: int = BLOCK, levels: int = 1
) -> DataFrame:
    """1-based position per key in axis order."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    return prefix_scan(ones, keys, axis, {name: ("sum", "_one")}, size, levels).drop("_one")


def with_halo(df: DataFrame, axis: str, reach: int, size: int = BLOCK) -> DataFrame:
    """Add ``_block`` and copy the last ``reach`` units of every block into the next one."""
    if not 0 <= reach <= size:
        raise ValueError(f"reach {reach} must lie within the block size {size}")
    own = block_of(axis, size)
    near_end = F.pmod(F.col(axis), F.lit(size)) >= size - reach
    return df.withColumn("_block", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))))


def halo_window(
    df: DataFrame,
    keys: Sequence[str],
    axis: str,
    reach: int,
    exprs: dict[str, Callable[[WindowSpec], Column]],
    size: int = BLOCK,
) -> DataFrame:
    """Window expressions that look back at most ``reach`` units of the axis.

    ``exprs`` maps an output name to a function from the ordered window to a column. Frames must count units, not rows
    (``rangeBetween``, as ``back`` does), so that gaps in the axis give the same answer wherever a block ends. A row without a place on
    the axis stays and has no past: its outputs are null.
    """
    spread = with_halo(df, axis, reach, size)
    ordered = Window.partitionBy(*keys, "_block").orderBy(axis)
    placed = F.col(axis).isNotNull()
    computed = spread.select("*", *[F.when(placed, make(ordered)).alias(f"_w_{out}") for out, make in exprs.items()])
    own_rows = computed.where(F.col("_block").eqNullSafe(block_of(axis, size)))
    kept = [c for c in df.columns if c not in exprs]
    return own_rows.select(*kept, *[F.col(f"_w_{out}").alias(out) for out in exprs])


def ranged_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Add ``upto`` = running sum of ``value`` in the order of any columns, and ``total``, per ``by``.

    For orders that are no integer axis: rows are range-partitioned, so a chunk is one stretch of the order, and each chunk
    needs the sum of the chunks before it. The chunks are written once, since their numbers must not change on a retry.
    (by, order) is unique; a null in ``by`` is a value like any other.
    """
    settled = settle(df.repartitionByRange(*by, *order).withColumn("_chunk", F.spark_partition_id()), "chunks")
    chunks, key = _with_key(settled, by, "_by")
    inside = Window.partitionBy("_chunk", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = chunks.groupBy(*key, "_chunk").agg(F.sum(value).alias("_sum"))
    offsets = sums.select(
        *key, "_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_sum").over(Window.partitionBy(*key)).alias("total"),
    )
    merged = chunks.withColumn("_in", F.sum(value).over(inside)).join(offsets, [*key, "_chunk"])
    return merged.select(*df.columns, (F.col("_in") + F.col("_before")).alias("upto"), "total")


def back(column: str, units: int) -> Callable[[WindowSpec], Column]:
    """Value of the row exactly ``units`` earlier, null if there is none."""
    return lambda window: F.max(column).over(window.rangeBetween(-units, -units))
