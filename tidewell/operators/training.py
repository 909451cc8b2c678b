"""Data-parallel fitting and scoring of networks on sliding windows.

Windows are dealt by hash into shards of a bounded number of rows, one row of a written table per shard. A pass is one Spark job: each
task starts from the shared parameters and Adam moments, makes a move per batch of 32 windows of its shard, and Spark averages
parameters and moments over the shards, weighted by their rows, in two rounds. Only vectors of the size of the parameters leave
the tasks, and no result depends on how the table is partitioned. Candidate networks are fitted side by side in concurrent jobs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.networks import ENTROPY_WEIGHT, MULTIPLIER, RHO, Network
from tidewell.session import settle
from tidewell.sources import tables

# Defaults of the fits.
EPOCHS, LEARNING_RATE, PATIENCE, BATCH = 100, 0.001, 10, 32
# Windows worked on at a time in a task, windows of a shard, and width of the first round of the sum over tasks.
ROWS_AT_ONCE = 1024
SHARD_ROWS = 16384
SUM_WIDTH = 64
# Candidates fitted at the same time.
SIDE_BY_SIDE = 4


@dataclass
class Fit:
    """A fitted network: best parameters, their validation loss, and the loss history."""

    name: str
    network: Network
    params: np.ndarray
    loss: float = float("inf")
    history: list[tuple[int, float, float]] = field(default_factory=list)


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An array column, all rows of one length, as a matrix without copying row by row."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


SHARD_SCHEMA = "shard int, n int, x binary, y binary, held binary"


def _packed(table: pa.Table) -> pa.Table:
    """The windows of a shard as one row, in order of their hashes."""
    table = table.sort_by([("order", "ascending"), ("t", "ascending")]).combine_chunks()
    batch = table.to_batches()[0]
    held = batch.column(batch.schema.get_field_index("held")).to_numpy(zero_copy_only=False).astype(bool)
    cells = [[batch.column(batch.schema.get_field_index("shard"))[0].as_py()], [len(held)]]
    cells += [[np.ascontiguousarray(matrix(batch, name), dtype=float).tobytes()] for name in ("x", "y")]
    names = [f.split()[0] for f in SHARD_SCHEMA.split(", ")]
    return pa.table([*[pa.array(c, pa.int32()) for c in cells[:2]], *[pa.array(c, pa.binary()) for c in cells[2:]], pa.array([held.tobytes()], pa.binary())], names)


def window_samples(windows: DataFrame, fold: str = "fold", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Windows in shards of about ``shard_rows`` with a validation mark, written once for all passes.

    A window's shard and its place there follow from its content, so batches are the same wherever the rows lie.
    """
    hashed = F.xxhash64("t", "x", "y")
    flat = settle(windows.select("t", F.flatten("x").alias("x"), "y", (F.col(fold) == "validation").alias("held")), "windows")
    shards = max(1, -(-flat.count() // shard_rows))
    dealt = flat.select("t", "x", "y", "held", hashed.alias("order"), F.pmod(F.xxhash64(hashed), F.lit(shards)).cast("int").alias("shard"))
    return settle(dealt.groupBy("shard").applyInArrow(_packed, SHARD_SCHEMA), "samples")


def summed(partials: DataFrame, by: Sequence[str], parts: int) -> DataFrame:
    """Element-wise sum of the array column ``v`` per ``by``.

    With more than SUM_WIDTH parts they are summed in groups first, so that no task gets them all.
    """
    half = partials.withColumn("v", array_to_vector("v"))
    if parts > SUM_WIDTH:
        first = half.withColumn("part", F.col("part") % SUM_WIDTH)
        half = first.groupBy(*by, "part").agg(Summarizer.sum(F.col("v")).alias("v"))
    return half.groupBy(*by).agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("v"))


@dataclass
class _State:
    """What a pass starts from: parameters, Adam moments, and moves made so far."""

    params: np.ndarray
    first: np.ndarray
    second: np.ndarray
    moves: int = 0


def _loss(stats: np.ndarray) -> tuple[float, float]:
    """Mean loss of a batch with the graph penalty, and the penalty."""
    n = max(stats[3], 1.0)
    penalty = stats[2] / n
    return float((stats[0] + ENTROPY_WEIGHT * stats[1]) / n + RHO / 2 * penalty**2 + MULTIPLIER * penalty), float(penalty)


def _local_moves(network: Network, state: _State, x: np.ndarray, y: np.ndarray, rate: float, batch: int, passes: int) -> tuple[_State, float]:
    """Adam moves on one batch after the other, and the mean loss of the last pass over them."""
    own = _State(state.params.copy(), state.first.copy(), state.second.copy(), state.moves)
    loss = 0.0
    for _ in range(passes):
        loss = 0.0
        for start in range(0, len(x), batch):
            sums = network.sums(own.params, x[start : start + batch], y[start : start + batch])
            value, penalty = _loss(sums["stats"])
            n = sums["stats"][3]
            loss += value * n
            own.moves += 1
            grad = sums["grad"] / n + (RHO * penalty + MULTIPLIER) * sums["grad_penalty"] / n
            own.params -= _adam_move((own.first, own.second), grad, own.moves, rate)
    return own, loss


def _pass(samples: DataFrame, network: Network, state: _State, p: int, parts: int, rate: float, batch: int, passes: int, all_rows: bool, train: bool) -> np.ndarray:
    """Sums over all shards: rows times (parameters, moments, moves) after the local moves, rows, loss, and validation stats of ``state``."""
    size = len(state.params)

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 * size + 7)
        for piece in batches:
            for row in piece.to_pylist():
                x, y = (np.frombuffer(row[c]).reshape(row["n"], -1) for c in ("x", "y"))
                x, held = x.reshape(row["n"], p, -1), np.frombuffer(row["held"], dtype=bool)
                for start in range(0, int(held.sum()), ROWS_AT_ONCE):
                    some = np.flatnonzero(held)[start : start + ROWS_AT_ONCE]
                    total[3 * size + 3 :] += network.sums(state.params, x[some], y[some], want_grad=False)["stats"]
                own = np.ones(len(held), dtype=bool) if all_rows else ~held
                if train and own.any():
                    after, loss = _local_moves(network, state, x[own], y[own], rate, batch, passes)
                    n = own.sum()
                    total[: 3 * size + 3] += np.concatenate([n * after.params, n * after.first, n * after.second, [n * after.moves, n, loss]])
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "v": pa.array([total], pa.list_(pa.float64()))})

    rows = summed(samples.mapInArrow(partials, "part int, v array<double>").withColumn("candidate", F.lit(0)), ["candidate"], parts).collect()
    return np.array(rows[0]["v"]) if rows else np.zeros(3 * size + 7)


def _fit_one(samples: DataFrame, fitted: Fit, p: int, parts: int, epochs: int, rate: float, patience: int, batch: int, local: int, all_rows: bool) -> Fit:
    network, size = fitted.network, len(fitted.params)
    state = _State(fitted.params.copy(), np.zeros(size), np.zeros(size))
    best, stale, losses = fitted.params.copy(), 0, []
    for epoch in range(epochs + 1):
        sums = _pass(samples, network, state, p, parts, rate, batch, local, all_rows, train=epoch < epochs)
        if epoch:
            held = sums[3 * size + 3 :]
            held_loss = float((held[0] + ENTROPY_WEIGHT * held[1]) / max(held[3], 1.0))
            fitted.history.append((epoch, losses[-1], held_loss))
            if held_loss < fitted.loss:
                fitted.loss, best, stale = held_loss, state.params.copy(), 0
            else:
                stale += 1
            if stale >= patience:
                break
        rows = sums[3 * size + 1]
        losses.append(float(sums[3 * size + 2] / max(rows, 1.0)))
        if rows:
            mean = sums[: 3 * size + 1] / rows
            state = _State(mean[:size], mean[size : 2 * size], mean[2 * size : 3 * size], int(round(mean[3 * size])))
    fitted.params = best
    return fitted


def fit(
    samples: DataFrame,
    candidates: dict[str, Network],
    p: int,
    epochs: int = EPOCHS,
    rate: float = LEARNING_RATE,
    patience: int = PATIENCE,
    seed: int = 42,
    batch: int = BATCH,
    local: int = 1,
    start: dict[str, np.ndarray] | None = None,
    all_rows: bool = False,
) -> list[Fit]:
    """Fit every candidate with Adam on batches of ``batch`` windows; stop one after ``patience`` passes without a better
    validation loss, and keep the best parameters.

    ``local`` is how often a task goes over its shard before parameters are averaged; an entry of the history is one averaging.
    The validation loss of an entry is that of the averaged parameters. ``start`` has parameters to start from; with ``all_rows`` the
    held-back windows are learned from too and still decide which parameters are kept. Without held-back windows all losses are
    zero, so give few passes then.
    """
    fits = [Fit(name, network, (start or {}).get(name, network.initial(seed))) for name, network in candidates.items()]
    samples = samples.persist()
    parts = samples.rdd.getNumPartitions()
    one = lambda f: _fit_one(samples, f, p, parts, epochs, rate, patience, batch, local, all_rows)
    try:
        if len(fits) == 1:
            return [one(fits[0])]
        with ThreadPool(min(len(fits), SIDE_BY_SIDE)) as pool:
            return pool.map(inheritable_thread_target(samples.sparkSession)(one), fits, chunksize=1)
    finally:
        samples.unpersist()


def _adam_move(moments: tuple[np.ndarray, np.ndarray], grad: np.ndarray, count: int, rate: float) -> np.ndarray:
    first, second = moments
    first[:] = 0.9 * first + 0.1 * grad
    second[:] = 0.999 * second + 0.001 * grad**2
    return rate * (first / (1 - 0.9**count)) / (np.sqrt(second / (1 - 0.999**count)) + 1e-8)


def best_fit(fits: Sequence[Fit]) -> Fit:
    return min(fits, key=lambda f: f.loss)


def refit(samples: DataFrame, chosen: Fit, p: int, **options) -> Fit:
    """The chosen network fitted on from its parameters, now on the held-back windows too.

    The parameters it starts with stay if no pass makes the loss on the held-back windows smaller.
    """
    again = fit(samples, {chosen.name: chosen.network}, p, start={chosen.name: chosen.params}, all_rows=True, **options)[0]
    last = chosen.history[-1][0] if chosen.history else 0
    history = chosen.history + [(last + epoch, train, held) for epoch, train, held in again.history]
    better = again if again.loss < chosen.loss else chosen
    return Fit(chosen.name, chosen.network, better.params, better.loss, history)


def history_frame(spark: SparkSession, fits: Sequence[Fit]) -> DataFrame:
    rows = [(f.name, *line) for f in fits for line in f.history]
    return spark.createDataFrame(rows, "model string, epoch int, train_loss double, val_loss double")


def with_forecast(windows: DataFrame, fitted: Fit, p: int) -> DataFrame:
    """Add ``predicted`` to rows with a flat window ``x``."""
    network, params = fitted.network, fitted.params

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            made = network.predict(params, matrix(piece, "x").reshape(piece.num_rows, p, -1))
            yield piece.append_column("predicted", pa.array(list(made), pa.list_(pa.float64())))

    schema = ", ".join(f"`{name}` {kind}" for name, kind in windows.dtypes) + ", predicted array<double>"
    return windows.mapInArrow(run, schema)


def score(windows: DataFrame, fitted: Fit, p: int, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep, variable, actual, predicted) for flat windows ``x`` with target ``y``."""
    scored = with_forecast(windows.select(*keep, "x", "y"), fitted, p)
    names = F.array(*[F.lit(n) for n in features])
    cells = F.arrays_zip(names.alias("variable"), F.col("y").alias("actual"), "predicted")
    return scored.select(*keep, F.inline(cells).alias("variable", "actual", "predicted"))


PARAM_SCHEMA = "model string, domain string, run_date date, name string, i int, j int, value double"


def params_frame(spark: SparkSession, fitted: Fit, domain: str, run_date) -> DataFrame:
    """Parameters as rows (model, domain, run_date, name, i, j, value)."""
    rows = []
    for name, array in fitted.network.unflatten(fitted.params).items():
        table = np.atleast_2d(array)
        i, j = np.indices(table.shape)
        rows.append(pd.DataFrame({"name": name, "i": i.ravel(), "j": j.ravel(), "value": table.ravel()}))
    frame = pd.concat(rows)
    frame.insert(0, "run_date", run_date)
    frame.insert(0, "domain", domain)
    frame.insert(0, "model", fitted.name)
    return spark.createDataFrame(frame.astype({"i": "int32", "j": "int32"}), PARAM_SCHEMA)


def save_params(params: DataFrame, path: str) -> None:
    """Stores the parameters; those of the same model, domain and day give way, so that a run can be repeated."""
    tables.write_partitions(params, path, ["domain", "run_date", "model"])


def load_params(spark: SparkSession, path: str, network: Network, model: str, domain: str, run_date) -> Fit:
    stored = spark.read.schema(PARAM_SCHEMA).parquet(path)
    mine = stored.where((F.col("model") == model) & (F.col("domain") == domain) & (F.col("run_date") == F.lit(run_date)))
    frame = mine.select("name", "i", "j", "value").toPandas()
    return Fit(model, network, network.flatten(arrays_of(frame, network)))


def arrays_of(frame: pd.DataFrame, network: Network) -> dict[str, np.ndarray]:
    """The parameter arrays of a network from rows (name, i, j, value)."""
    arrays = {}
    for name, shape in network.shapes.items():
        part = frame[frame["name"] == name].sort_values(["i", "j"])
        arrays[name] = part["value"].to_numpy().reshape(shape)
    return arrays
