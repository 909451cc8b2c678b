"""Merging a new batch into a stored table, and publishing it by (year, month) partition."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.scalars import calendar_columns
from tidewell.operators import clean
from tidewell.sources.published import Month, PublishedTable, State, fitted

MODES = ("range_replace", "upsert")


def _stored_keys(existing: DataFrame, batch: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join of ``existing`` with the keys of ``batch``; a null key equals a null key."""
    left, right = existing.alias("l"), batch.select(*keys).alias("r")
    same = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
    return left.join(right, same, how)


def updates(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is stored already. A semi join, so repeated stored keys do not multiply them."""
    return _stored_keys(batch, existing, keys, "left_semi")


def inserts(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not stored yet."""
    return _stored_keys(batch, existing, keys, "left_anti")


def range_replace(existing: DataFrame, batch: DataFrame, day: str = "date") -> DataFrame:
    """Stored rows outside the days the batch spans, and the whole batch.

    Stored rows inside that span which the batch lacks are dropped: the batch is the truth for its span.
    """
    span = batch.agg(F.struct(F.min(day).alias("low"), F.max(day).alias("high"))).scalar()
    outside = F.col(day).between(span["low"], span["high"])
    return existing.where(~F.coalesce(outside, F.lit(False))).unionByName(batch.select(*existing.columns))


def merge(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows win by key; every other stored row stays."""
    untouched = _stored_keys(existing, batch, keys, "left_anti")
    return untouched.unionByName(batch.select(*existing.columns))


def months_between(low: date, high: date) -> list[tuple[int, int]]:
    first, last = low.year * 12 + low.month - 1, high.year * 12 + high.month - 1
    return [(m // 12, m % 12 + 1) for m in range(first, last + 1)]


def publish(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    mode: str = "range_replace",
    day: str = "date",
    newer_by: str | None = None,
) -> None:
    """Upsert ``batch`` into the published table at ``path``, see ``sources.published``; ``read`` gives its rows.

    Rows without a day have a month of their own. They lie in no span, so they are merged by key in every mode.

    The span of the batch (one row) becomes literals, so only the touched months are read, and they are written once, to new folders.
    The list that names them comes last: until then, and after a failure, readers see the old rows. With ``newer_by``, a stored row
    gives way only to a batch row that is greater in that column, so repeated or late batches do no harm.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    table = PublishedTable(batch.sparkSession, path)
    state = table.state()
    if state.added:
        if not newer_by:
            raise ValueError(f"batches were added to {path}: say by which column the newest row is found")
        table.compact(keys, newer_by)
        state = table.state()
    batch = fitted(calendar_columns(batch, day), state.schema)
    if not state.version:
        table.flip(State(0, batch.schema, table.write(batch)))
        return
    dated = F.col(day).isNotNull()
    low, high, undated = batch.agg(F.min(day), F.max(day), F.count_if(~dated)).first()
    if low is None and not undated:
        return
    span: set[Month] = {*(months_between(low, high) if low else ()), *([(None, None)] if undated else ())}
    touched = table.scan(state.schema, [folder for m, folder in state.months.items() if m in span])
    if newer_by:
        merged = clean.latest_per_key(touched.unionByName(batch), keys, newer_by)
    elif mode == "range_replace":
        merged = range_replace(touched.where(dated), batch.where(dated), day)
        if undated:
            merged = merged.unionByName(merge(touched.where(~dated), batch.where(~dated), keys))
    else:
        merged = merge(touched, batch, keys)
    kept = {m: folder for m, folder in state.months.items() if m not in span}
    table.flip(State(state.version, state.schema, kept | table.write(merged)))


def read(spark: SparkSession, path: str, keys: Sequence[str] = (), newer_by: str | None = None) -> DataFrame:
    """The rows of a published table; ``keys`` and ``newer_by`` for one that a stream appends to."""
    return PublishedTable(spark, path).read(keys, newer_by)
