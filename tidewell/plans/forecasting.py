"""A gold table to a fitted model, its errors on the last days and a forecast."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.networks import FeedForward, Network, RegimeNetwork
from tidewell.operators import evaluate, forecast, prep, regress, training
from tidewell.session import settle

# Share of days to train on, held-back percentage, states tried, and the settings of each model.
TRAIN_SHARE, HELD_PERCENT, STATES = 0.8, 20, (2, 3, 4, 5)
SETTINGS = {
    "srvar": {"rate": 0.0001, "patience": 5},
    "varnn": {"rate": 0.001, "patience": 10},
    "varnn_frozen": {"rate": 0.001, "patience": 10},
}


@dataclass
class Forecast:
    """What a run makes: all frames are lazy or written tables."""

    fitted: training.Fit
    p: int
    order: int
    scaler: DataFrame
    history: DataFrame
    predicted: DataFrame
    errors: DataFrame
    future: DataFrame


def _differences(scaled: DataFrame, features: Sequence[str], order: int) -> DataFrame:
    """``order`` first differences per fold, with real dates; rows without enough past go."""
    out = scaled
    for _ in range(order):
        out = settle(prep.difference_wide(out, ["fold"], "t", features, 1), "differences")
    return out


def _from_zero(df: DataFrame, fold: str, features: Sequence[str]) -> DataFrame:
    rows = df.where(F.col("fold") == fold)
    first = rows.agg(F.min("t")).scalar()
    return rows.select(F.lit("all").alias("domain"), "date", (F.col("t") - first).alias("t"), *features)


def _long(df: DataFrame, features: Sequence[str], keep: Sequence[str], value: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias(value)) for c in features])
    return df.select(*keep, F.inline(cells))


def candidates(model: str, p: int, k: int, frozen: Callable) -> Mapping[str, Network]:
    if model == "srvar":
        return {f"srvar_{s}": RegimeNetwork(k, s) for s in STATES}
    return {model: FeedForward(p, k, frozen() if model == "varnn_frozen" else None)}


def _future(differences, scaled, features, fitted, p, order, horizon, anchor) -> DataFrame:
    """Forecast differences after the last day brought back to scaled levels, (variable, date, value)."""
    tail = forecast.last_rows(_from_zero(differences, "test", features), "t", p)
    step = forecast.network_step(fitted.network, fitted.params)
    ahead = settle(forecast.recursive_forecast(tail, ["domain"], "date", features, step, horizon), "ahead")
    steps = _long(ahead.withColumn("step", F.col("step").cast("bigint")), features, ["date", "step"], "value")
    if order == 0:
        return steps.select("variable", "date", "value")
    levels = scaled.where(F.col("fold") == "test")
    if anchor == "aligned":
        past = forecast.last_rows(levels, "t", horizon + 1)
        first = past.agg(F.min("t")).scalar()
        numbered = _long(past.withColumn("step", F.col("t") - first), features, ["step"], "value")
        back = prep.restore_aligned(steps, numbered, ["variable"], "step", "value", "restored", periods=1)
        return back.select("variable", "date", F.col("restored").alias("value"))
    for lower in range(order - 1, -1, -1):
        base = _differences(levels, features, lower)
        start = _long(forecast.last_rows(base, "t", 1), features, [], "level")
        back = prep.restore_cumulative(steps, start, ["variable"], "step", "value", "restored")
        steps = back.select("variable", "date", "step", F.col("restored").alias("value"))
    return steps.select("variable", "date", "value")


def run(
    gold: DataFrame,
    features: Sequence[str],
    model: str = "srvar",
    epochs: int = training.EPOCHS,
    longest_lag: int = regress.MAX_VAR_LAG,
    most_differences: int | None = None,
    anchor: str = "cumulative",
    horizon: int | None = None,
    local: int = 1,
) -> Forecast:
    """Split, scale on the training days, difference until stationary, choose the lag, fit, score, forecast.

    ``anchor`` says what a forecast difference is added to: the level before it (``cumulative``), or the level as many days
    back as the horizon (``aligned``). Of several candidates the winner is fitted on over all training windows. Training and
    test rows are disjoint. ``local``: see ``training.fit``. Series that no number of differences makes stationary are an error;
    with ``most_differences`` the run goes on with that many.
    """
    if model not in SETTINGS or anchor not in ("cumulative", "aligned"):
        raise ValueError(f"unknown model {model} or anchor {anchor}")
    k = len(features)
    placed = prep.with_position(settle(gold.select("date", *features), "gold"), "date", "t")
    split = settle(prep.chronological_split(placed, "t", TRAIN_SHARE), "split")
    train = F.col("fold") == "train"
    scaler = settle(
        prep.series_scaler(_long(split, features, ["fold"], "value"), ["variable"], "value", train), "scaler"
    )
    scaled = settle(prep.scale_wide(split, features, train), "scaled")

    series = settle(_long(scaled.where(train), features, ["t"], "value"), "series")
    found = regress.stationary_order(series, ["variable"], "value", most_differences)
    if not found.reached and most_differences is None:
        untested = [r["variable"] for r in found.tests.where(f"order = {found.order} and p_value is null").collect()]
        raise ValueError(f"no number of differences makes {untested} stationary")
    order = found.order
    differences = _differences(scaled, features, order)
    rows = settle(_from_zero(differences, "train", features), "train-rows")
    p = regress.best_lag(regress.var_lag_choice(rows, ["domain"], features, longest_lag), ["domain"]).first()["p"]

    def frozen():
        return forecast.VarModel.from_rows(regress.var_fit(rows, ["domain"], features, p), features, p).output_layer()

    windows = prep.sliding_windows(rows, ["domain"], "t", features, p)
    if model == "srvar":
        marked = prep.hash_split(windows, F.col("t"), HELD_PERCENT)
    else:
        moved = windows.withColumn("t", F.col("t") - p)
        total = rows.agg(F.count("*") - p).scalar()
        marked = prep.chronological_split(moved, "t", 1 - HELD_PERCENT / 100, ("train", "validation"), total)
    samples = training.window_samples(marked)
    settings = {"epochs": epochs, "local": local, **SETTINGS[model]}
    fits = training.fit(samples, dict(candidates(model, p, k, frozen)), p, **settings)
    fitted = training.best_fit(fits)
    if len(fits) > 1:
        fitted = training.refit(samples, fitted, p, **settings)
        fits = [fitted if f.name == fitted.name else f for f in fits]

    test = prep.sliding_windows(_from_zero(differences, "test", features), ["domain"], "t", features, p)
    scored = training.score(test.withColumn("x", F.flatten("x")), fitted, p, features, ["date"])
    levels = _long(scaled, features, ["date"], "level")
    shift = F.col("level") - F.col("actual")
    restored = scored.join(levels, ["date", "variable"]).select(
        "variable", "date", F.col("level").alias("actual"), (F.col("predicted") + shift).alias("predicted")
    )
    restored = settle(restored, "restored")
    both = restored.withColumn("scale", F.lit("scaled")).unionByName(
        _unscaled(restored, scaler, ["actual", "predicted"]).withColumn("scale", F.lit("original"))
    )
    ahead = _future(differences, scaled, features, fitted, p, order, horizon or p, anchor)
    return Forecast(
        fitted,
        p,
        order,
        scaler,
        training.history_frame(gold.sparkSession, fits),
        both.where(F.col("scale") == "original").drop("scale"),
        evaluate.forecast_errors(both, ["scale"]),
        _unscaled(ahead, scaler, ["value"]),
    )


def _unscaled(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    joined = df.join(scaler, "variable")
    return joined.withColumns({c: prep.unscale(F.col(c), F.col("low"), F.col("high")) for c in columns}).drop("low", "high")


