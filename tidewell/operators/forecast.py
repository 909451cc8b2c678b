"""Scoring and forecasting with vector autoregressions, regimes, forecast dates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.networks import LOG_FLOOR, Network, matrix_exp
from tidewell.functions.numeric import least_squares
from tidewell.operators import blocks, prep, training


class LinearModel(Network):
    """A VAR as a network: ``weights`` by lag, then source, and ``bias``."""

    def __init__(self, p: int, k: int):
        super().__init__({"weights": (p * k, k), "bias": (k,)})

    def predict(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        a = self.unflatten(flat)
        return x[:, ::-1].reshape(len(x), -1) @ a["weights"] + a["bias"]


class VarModel:
    """Coefficients of a VAR(p): ``const[target]`` and ``lags[lag - 1][source][target]``."""

    def __init__(self, const: np.ndarray, lags: np.ndarray):
        self.const, self.lags = np.asarray(const, dtype=float), np.asarray(lags, dtype=float)
        self.p, self.k = self.lags.shape[0], self.lags.shape[1]

    @classmethod
    def from_rows(cls, params: DataFrame, features: Sequence[str], p: int) -> VarModel:
        """From the parameter rows of one fitted key."""
        at = {c: i for i, c in enumerate(features)}
        const, lags = np.zeros(len(at)), np.zeros((p, len(at), len(at)))
        for r in params.select("term", "lag", "target", "value").collect():
            if r["lag"] == 0:
                const[at[r["target"]]] = r["value"]
            else:
                lags[r["lag"] - 1, at[r["term"]], at[r["target"]]] = r["value"]
        return cls(const, lags)

    def as_fit(self, name: str = "var") -> training.Fit:
        """The same model as a network without hidden layer, to be stored and loaded like any other."""
        network = LinearModel(self.p, self.k)
        return training.Fit(name, network, network.flatten({"weights": self.output_layer()[0], "bias": self.const}))

    def output_layer(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights (rows by lag, then source) and bias, as the frozen last layer of a network."""
        return self.lags.reshape(self.p * self.k, self.k), self.const

    def step(self, window: np.ndarray) -> np.ndarray:
        """Next row after a window of p rows, oldest first."""
        return self.const + sum(window[-lag] @ self.lags[lag - 1] for lag in range(1, self.p + 1))

    def columns(self, window: str, features: Sequence[str]) -> dict[str, Column]:
        """The forecast of each series as an expression over an array of p arrays, oldest first."""
        flat = F.flatten(F.col(window))
        out = {}
        for target, name in enumerate(features):
            weights = [float(self.lags[self.p - 1 - at, s, target]) for at in range(self.p) for s in range(self.k)]
            products = F.zip_with(flat, F.array(*[F.lit(w) for w in weights]), lambda v, w: v * w)
            out[name] = F.aggregate(products, F.lit(float(self.const[target])), lambda total, v: total + v)
        return out


def var_score(windows: DataFrame, model: VarModel, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Forecast per series beside each window, without leaving the JVM."""
    return windows.select(*keep, *[expr.alias(c) for c, expr in model.columns("x", features).items()])


def last_rows(df: DataFrame, axis: str, n: int) -> DataFrame:
    """The last n positions of a dense axis, found by a bound and not by a sort."""
    return df.where(F.col(axis) > df.agg(F.max(axis)).scalar() - n)


def last_rows_by(df: DataFrame, keys: Sequence[str], axis: str, n: int) -> DataFrame:
    """The last n positions of each key of a dense axis: one bound per key, joined back, and no sort of a key's rows."""
    bounds = df.groupBy(*keys).agg(F.max(axis).alias("_end"))
    return blocks.join_per_key(df, bounds, keys).where(F.col(axis) > F.col("_end") - n).drop("_end")


def _ahead(rows: pd.DataFrame, day: str, names: Sequence[str], step: Callable, horizon: int, key: Mapping) -> pd.DataFrame:
    """``horizon`` forecasts after a window of rows, each one part of the window of the next."""
    rows = rows.sort_values(day)
    window = rows[list(names)].to_numpy(dtype=float)
    made = []
    for _ in range(horizon):
        following = np.asarray(step(window), dtype=float)
        made.append(following)
        window = np.vstack([window[1:], following])
    out = pd.DataFrame(np.vstack(made), columns=list(names))
    start = pd.Timestamp(rows[day].iloc[-1])
    out.insert(0, day, [(start + pd.Timedelta(days=h + 1)).date() for h in range(horizon)])
    out.insert(0, "step", np.arange(1, horizon + 1, dtype="int32"))
    for position, (name, value) in enumerate(key.items()):
        out.insert(position, name, value)
    return out


def _ahead_schema(history: DataFrame, keys: Sequence[str], day: str, names: Sequence[str]) -> str:
    kinds = dict(history.dtypes)
    return ", ".join([*(f"{k} {kinds[k]}" for k in keys), "step int", f"{day} date", *(f"{c} double" for c in names)])


def recursive_forecast(
    history: DataFrame, keys: Sequence[str], day: str, features: Sequence[str], step: Callable, horizon: int
) -> DataFrame:
    """(keys, step, date, features): each forecast joins the window of the next one.

    ``history`` holds only the window of each key (as many rows as the model looks back), so a group is tiny; keys run in
    parallel.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _ahead(rows, day, features, step, horizon, dict(zip(keys, key)))

    return history.groupBy(*keys).applyInPandas(run, _ahead_schema(history, keys, day, features))


def domain_forecast(
    history: DataFrame, params: DataFrame, keys: Sequence[str], day: str, features: Sequence[str], horizon: int
) -> DataFrame:
    """(keys, step, date, features): recursive forecasts of many domains in one job, each domain by its own VAR.

    ``params`` are the rows of ``regress.var_fit`` for the same keys, ``history`` the last rows of each key (``last_rows_by``). Both are
    shuffled by key and meet in one group per domain, whose size is that of a window and a model; no model passes the driver or a
    closure. Lag lengths may differ between domains. A domain without a model, without rows, or with fewer rows than its model looks
    back has no forecast.
    """
    names = list(features)
    at = {c: i for i, c in enumerate(names)}
    schema = _ahead_schema(history, keys, day, names)
    columns = [part.split()[0] for part in schema.split(", ")]

    def run(key: tuple, rows: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        p = int(model["lag"].max()) if len(model) else 0
        if not len(model) or len(rows) < max(p, 1):
            return pd.DataFrame(columns=columns)
        const, lags = np.zeros(len(at)), np.zeros((p, len(at), len(at)))
        for term, lag, target, value in model[["term", "lag", "target", "value"]].itertuples(index=False):
            if lag == 0:
                const[at[target]] = value
            else:
                lags[lag - 1, at[term], at[target]] = value
        window = rows.sort_values(day).tail(max(p, 1))
        return _ahead(window, day, names, VarModel(const, lags).step, horizon, dict(zip(keys, key)))

    return history.groupBy(*keys).cogroup(params.groupBy(*keys)).applyInPandas(run, schema)


def network_step(network, params: np.ndarray) -> Callable:
    return lambda window: network.predict(params, window[np.newaxis])[0]


def future_dates(df: DataFrame, keys: Sequence[str], day: str, horizon: int) -> DataFrame:
    """(keys, step, date): the ``horizon`` days after the last one of each key."""
    last = df.groupBy(*keys).agg(F.max(day).alias("_last"))
    stepped = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return stepped.select(*keys, "step", F.date_add("_last", F.col("step")).alias(day))


def _times(weight: float) -> Callable[[Column], Column]:
    return lambda v: v * weight


def _latest_window(
    df: DataFrame, day: str, features: Sequence[str], p: int, bounds: Column, pad: bool, order: int
) -> DataFrame:
    """One row (_last day, _level, x): what the next difference is added to, and the last p differences, oldest first."""
    placed = prep.with_position(df.select(day, *features), day, "_t")
    recent = last_rows(placed, "_t", p + order)
    levels = recent.select(
        day, F.array(*[prep.scale(F.col(c), bounds[c]["low"], bounds[c]["high"]) for c in features]).alias("_level")
    )
    rows = levels.agg(F.sort_array(F.collect_list(F.struct(day, "_level"))).alias("_rows"))
    rows = rows.select(F.element_at("_rows", -1)[day].alias("_last"), F.transform("_rows", lambda r: r["_level"]).alias("_l0"))
    for at in range(order):
        later, earlier = F.slice(f"_l{at}", 2, p + order), F.slice(f"_l{at}", 1, F.greatest(F.size(f"_l{at}") - 1, F.lit(0)))
        change = F.zip_with(later, earlier, lambda a, b: F.zip_with(a, b, lambda v, w: v - w))
        rows = rows.withColumn(f"_l{at + 1}", change)
    zero = F.array_repeat(F.lit(0.0), len(features))
    found = F.col(f"_l{order}")
    if pad:
        found = F.concat(F.array_repeat(zero, F.greatest(F.lit(p) - F.size(found), F.lit(0))), found)
    base = zero
    for back in range(1, order + 1):
        weight = float((-1) ** (back + 1) * comb(order, back))
        row = F.coalesce(F.try_element_at("_l0", F.lit(-back)), zero)
        base = F.zip_with(base, F.transform(row, _times(weight)), lambda total, v: total + v)
    return rows.select("_last", base.alias("_level"), F.slice(found, -p, p).alias("x"))


def next_step(
    df: DataFrame,
    day: str,
    features: Sequence[str],
    model: VarModel | training.Fit,
    p: int,
    scaler: Column | None = None,
    pad: bool = False,
    order: int = 1,
) -> DataFrame:
    """One-shot forecast after the last day of a dense wide table: (date, features).

    Scale, difference ``order`` times, forecast the next difference from the last p, add the levels before it, unscale. Without a
    stored ``scaler`` the bounds of the table itself are used. With ``pad`` differences of zero stand for missing ones.
    """
    bounds = scaler if scaler is not None else prep.wide_scaler(df, features, F.lit(True))
    ready = _latest_window(df, day, features, p, bounds, pad, order)
    if isinstance(model, VarModel):
        made = list(model.columns("x", features).values())
    else:
        ready = training.with_forecast(ready.withColumn("x", F.flatten("x")), model, p)
        made = [F.col("predicted")[i] for i in range(len(features))]
    return ready.select(
        F.date_add("_last", 1).alias(day),
        *[
            prep.unscale(made[i] + F.col("_level")[i], bounds[c]["low"], bounds[c]["high"]).alias(c)
            for i, c in enumerate(features)
        ],
    )


def entropy(weights: Column) -> Column:
    """Entropy of an array of state weights that sum to one."""
    return -F.aggregate(weights, F.lit(0.0), lambda total, a: total + a * F.log(a + F.lit(LOG_FLOOR)))


def softmax(scores: Column, tau: float = 1.0) -> Column:
    top = F.array_max(scores)
    grown = F.transform(scores, lambda s: F.exp((s - top) / F.lit(tau)))
    total = F.aggregate(grown, F.lit(0.0), lambda t, v: t + v)
    return F.transform(grown, lambda v: v / total)


def acyclicity(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, h): trace of exp(A * A) minus the size, for the weights ``src, dst, weight`` of each key. 0 = no cycle."""
    kinds = dict(edges.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", h double"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(rows["src"]) | set(rows["dst"]))
        graph = rows.pivot_table(index="dst", columns="src", values="weight", aggfunc="sum", fill_value=0.0)
        a = graph.reindex(index=names, columns=names, fill_value=0.0).to_numpy()
        return pd.DataFrame([(*key, float(np.trace(matrix_exp(a * a)) - len(names)))], columns=[*keys, "h"])

    return edges.groupBy(*keys).applyInPandas(run, schema)


def _first_means(pairs: DataFrame, states: int, seed: int) -> np.ndarray:
    """Rows of the data that lie apart, chosen by hashes of their content: the first at random, each further one with a chance that grows
    with the square of its distance to those chosen. One aggregate each, the same however the rows are partitioned."""
    chosen: list[list[float]] = []
    for at in range(states):
        u = (F.pmod(F.xxhash64("x", F.lit(seed), F.lit(at)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
        apart = [F.aggregate(F.zip_with("x", F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v) for c in chosen]
        distance = F.least(*apart) if len(apart) > 1 else apart[0] if apart else F.lit(1.0)
        race = F.when(distance > 0, -F.log(u) / distance)
        row = pairs.agg(F.min(F.struct(race.isNull().alias("last"), race.alias("race"), "x")).alias("least")).first()["least"]
        if row is None:
            break
        chosen.append(list(row["x"]))
    return np.array(chosen)


@dataclass
class Mixture:
    """Gaussian states: weights (s), means (s, k), covariances (s, k, k)."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    def soft(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State weights of each row, and its log density."""
        logs = np.empty((len(x), len(self.weights)))
        for s, (weight, mean, covariance) in enumerate(zip(self.weights, self.means, self.covariances)):
            lower = np.linalg.cholesky(covariance)
            z = np.linalg.solve(lower, (x - mean).T)
            logs[:, s] = np.log(max(weight, 1e-300)) - 0.5 * (z**2).sum(axis=0) - np.log(np.diag(lower)).sum() - 0.5 * len(mean) * np.log(2 * np.pi)
        top = logs.max(axis=1, keepdims=True)
        grown = np.exp(logs - top)
        total = grown.sum(axis=1, keepdims=True)
        return grown / total, (top + np.log(total)).ravel()


def _added(rows: DataFrame, make: Callable[[pa.RecordBatch], np.ndarray], size: int, parts: int) -> np.ndarray:
    """The sum of a vector of a fixed size over all slices; tasks add up first."""

    def partials(batches):
        total = np.zeros(size)
        for piece in training.slices(batches):
            total += make(piece)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "v": pa.array([total], pa.list_(pa.float64()))})

    made = rows.mapInArrow(partials, "part int, v array<double>").withColumn("one", F.lit(1))
    found = training.summed(made, ["one"], parts).collect()
    return np.array(found[0]["v"]) if found else np.zeros(size)


def mixture(pairs: DataFrame, k: int, states: int, seed: int = 42, rounds: int = 100, tolerance: float = 1e-4) -> Mixture:
    """A Gaussian mixture on the arrays ``x`` of a written table, by expectation and maximization: one job per round, whose sums are weights,
    means and products. It starts from rows that lie apart and ends when the mean log density rises by less than ``tolerance``. States are
    in order of their means, so neither they nor their numbers depend on how the table is partitioned.
    """
    rows = pairs.select("x")
    parts = rows.rdd.getNumPartitions()
    sums = _added(rows, lambda piece: _moments(training.matrix(piece, "x"), np.ones((piece.num_rows, 1))), 1 + k + k * k, parts)
    n = max(sums[0], 1.0)
    mean = sums[1 : 1 + k] / n
    spread = sums[1 + k :].reshape(k, k) / n - np.outer(mean, mean)
    floor = np.eye(k) * max(1e-6 * np.trace(spread) / k, 1e-12)
    means = _first_means(rows, states, seed)
    if len(means) < states:  # an empty table
        means = np.zeros((states, k))
    width, last = 1 + k + k * k, -np.inf

    def of_sums(table: np.ndarray) -> Mixture:
        held = np.maximum(table[:, 0], 1e-12)
        means = table[:, 1 : 1 + k] / held[:, None]
        products = table[:, 1 + k :].reshape(states, k, k) / held[:, None, None]
        return Mixture(table[:, 0] / n, means, products - np.einsum("si,sj->sij", means, means) + floor)

    def nearest(piece: pa.RecordBatch) -> np.ndarray:
        x = training.matrix(piece, "x")
        closest = ((x[:, None, :] - means) ** 2).sum(axis=2).argmin(axis=1)
        return _moments(x, np.eye(states)[closest])

    now = of_sums(_added(rows, nearest, states * width, parts).reshape(states, width))

    def step(piece: pa.RecordBatch) -> np.ndarray:
        x = training.matrix(piece, "x")
        soft, density = now.soft(x)
        return np.append(_moments(x, soft), density.sum())

    for _ in range(rounds):
        sums = _added(rows, step, states * width + 1, parts)
        density = sums[-1] / n
        now = of_sums(sums[:-1].reshape(states, width))
        if density - last < tolerance:
            break
        last = density
    order = np.lexsort(now.means.T[::-1])
    return Mixture(now.weights[order], now.means[order], now.covariances[order])


def _moments(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per state: sum of weights, of weighted rows, of weighted products."""
    products = np.einsum("ns,ni,nj->sij", weights, x, x).reshape(weights.shape[1], -1)
    return np.hstack([weights.sum(axis=0)[:, None], weights.T @ x, products]).ravel()


def regimes(pairs: DataFrame, features: Sequence[str], states: int, seed: int = 42, rounds: int = 100) -> DataFrame:
    """Soft regimes and a VAR(1) in each: (state, term, target, value, share).

    ``pairs`` is a written table with arrays ``x`` (previous row) and ``y`` (row). A Gaussian mixture on ``x`` gives each
    row its state weights; cross products weighted by them are summed by Spark, and each state's small system is solved.
    """
    names, k = list(features), len(features)
    fitted = mixture(pairs, k, states, seed, rounds)
    soft = pairs.select("x", "y")

    def products(batches):
        total = np.zeros((states, 1 + k, 1 + 2 * k))
        for piece in training.slices(batches):
            x, y = (training.matrix(piece, c) for c in ("x", "y"))
            weights = fitted.soft(x)[0]
            z = np.hstack([np.ones((len(x), 1)), x])
            full = np.hstack([z, y])
            for s in range(states):
                total[s] += (z * weights[:, [s]]).T @ full
        s, i, j = (a.ravel().astype("int32") for a in np.indices(total.shape))
        yield pa.RecordBatch.from_pydict({"state": s, "i": i, "j": j, "v": total.ravel()})

    sums = soft.mapInArrow(products, "state int, i int, j int, v double").groupBy("state", "i", "j").agg(F.sum("v").alias("v"))
    total = pairs.agg(F.count("*").cast("double")).scalar()

    def solve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((1 + k, 1 + 2 * k))
        table[rows["i"], rows["j"]] = rows["v"]
        beta, _ = least_squares(table[:, : 1 + k], table[:, 1 + k :])
        out = [
            (key[0], "const" if i == 0 else names[i - 1], names[j], float(beta[i, j]), float(table[0, 0]))
            for i in range(1 + k)
            for j in range(k)
        ]
        return pd.DataFrame(out, columns=["state", "term", "target", "value", "weight"])

    solved = sums.groupBy("state").applyInPandas(solve, "state int, term string, target string, value double, weight double")
    return solved.withColumn("share", F.col("weight") / total).drop("weight")
