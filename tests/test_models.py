"""Networks, training, scoring and forecasts."""

import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.functions.networks import ENTROPY_WEIGHT, RHO, FeedForward, RegimeNetwork, matrix_exp
from tidewell.operators import evaluate, forecast, prep, regress, stored, training

NAMES = ["a", "b"]


def total_loss(network, flat, x, y):
    stats = network.sums(flat, x, y, want_grad=False)["stats"]
    n, penalty = stats[3], stats[2] / stats[3]
    return (stats[0] + ENTROPY_WEIGHT * stats[1]) / n + RHO / 2 * penalty**2


@pytest.mark.parametrize(
    "network",
    [FeedForward(3, 2), FeedForward(3, 2, (np.linspace(-1, 1, 12).reshape(6, 2), np.array([0.1, 0.2]))), RegimeNetwork(2, 3, hidden=4)],
    ids=["free output", "frozen output", "regimes"],
)
def test_gradient(network):
    rng = np.random.default_rng(0)
    x, y = rng.standard_normal((7, 3, 2)) * 0.5, rng.standard_normal((7, 2)) * 0.5
    flat = network.initial(1)
    if isinstance(network, RegimeNetwork):
        flat = flat * 0.5
    sums = network.sums(flat, x, y)
    n, penalty = sums["stats"][3], sums["stats"][2] / sums["stats"][3]
    grad = sums["grad"] / n + RHO * penalty * sums["grad_penalty"] / n
    for at in range(0, len(flat), max(1, len(flat) // 60)):
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-6
        down[at] -= 1e-6
        numeric = (total_loss(network, up, x, y) - total_loss(network, down, x, y)) / 2e-6
        assert grad[at] == pytest.approx(numeric, rel=1e-4, abs=1e-7)


def test_sums_of_parts_add_up():
    rng = np.random.default_rng(0)
    network = RegimeNetwork(2, 3, hidden=4)
    x, y, flat = rng.standard_normal((9, 3, 2)), rng.standard_normal((9, 2)), network.initial(1) * 0.5
    whole, first, second = network.sums(flat, x, y), network.sums(flat, x[:4], y[:4]), network.sums(flat, x[4:], y[4:])
    for name in whole:
        np.testing.assert_allclose(whole[name], first[name] + second[name], rtol=1e-9, atol=1e-12)


def test_matrix_exp():
    a = np.array([[[0.0, 1.0], [0.0, 0.0]], [[math.log(2), 0.0], [0.0, math.log(3)]], [[0.0, -4.0], [4.0, 0.0]]])
    want = [[[1, 1], [0, 1]], [[2, 0], [0, 3]], [[math.cos(4), -math.sin(4)], [math.sin(4), math.cos(4)]]]
    np.testing.assert_allclose(matrix_exp(a), want, rtol=1e-10, atol=1e-10)


def series(n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = np.zeros((n, 2))
    for t in range(1, n):
        x[t] = [0.6 * x[t - 1, 0] + 0.2 * x[t - 1, 1], -0.5 * x[t - 1, 1]] + rng.standard_normal(2) * 0.1
    return x


def frame(spark, x):
    return spark.createDataFrame([("d", t, *map(float, r)) for t, r in enumerate(x)], "domain string, t bigint, a double, b double")


def samples(spark, x, p, partitions):
    windows = prep.sliding_windows(frame(spark, x), ["domain"], "t", NAMES, p, 32)
    marked = prep.hash_split(windows, F.col("t"), 20).repartition(partitions, "t")
    return training.window_samples(marked)


def test_fit_learns_and_does_not_depend_on_partitions(spark):
    x = series()
    fits = [training.fit(samples(spark, x, 2, n), {"v": FeedForward(2, 2)}, 2, 8, 0.02)[0] for n in (1, 5)]
    np.testing.assert_allclose(fits[0].params, fits[1].params, rtol=1e-7, atol=1e-9)
    history = fits[0].history
    assert len(history) == 8
    assert history[-1][1] < history[0][1]


def test_early_stop_keeps_best(spark):
    fit = training.fit(samples(spark, series(60), 2, 2), {"v": FeedForward(2, 2)}, 2, 30, 5.0, patience=2)[0]
    losses = [line[2] for line in fit.history]
    assert len(losses) < 30
    assert fit.loss == min(losses)
    again = training.fit(samples(spark, series(60), 2, 2), {"v": FeedForward(2, 2)}, 2, losses.index(min(losses)) + 1, 5.0)[0]
    np.testing.assert_allclose(fit.params, again.params)


def test_candidates_share_passes(spark):
    data = samples(spark, series(80), 2, 2)
    together = training.fit(data, {f"s{s}": RegimeNetwork(2, s, hidden=4) for s in (2, 3)}, 2, 3, 0.01)
    alone = training.fit(data, {"s3": RegimeNetwork(2, 3, hidden=4)}, 2, 3, 0.01)[0]
    np.testing.assert_allclose(together[1].params, alone.params, rtol=1e-8)
    assert training.best_fit(together).loss == min(f.loss for f in together)


def test_params_round_trip(spark, tmp_path):
    network = RegimeNetwork(2, 2, hidden=3)
    fitted = training.Fit("srvar", network, network.initial(0))
    path = str(tmp_path / "params")
    for day in (date(2025, 6, 9), date(2025, 6, 10), date(2025, 6, 10)):  # a day saved twice counts once
        training.save_params(training.params_frame(spark, fitted, "macro", day), path)
    loaded = training.load_params(spark, path, network, "srvar", "macro", date(2025, 6, 10))
    np.testing.assert_array_equal(loaded.params, fitted.params)


def test_var_model_scores_and_forecasts(spark):
    x, p = series(), 2
    rows = frame(spark, x)
    model = forecast.VarModel.from_rows(regress.var_fit(rows, ["domain"], NAMES, p), NAMES, p)
    windows = prep.sliding_windows(rows, ["domain"], "t", NAMES, p, 32)
    scored = {r["t"]: (r["a"], r["b"]) for r in forecast.var_score(windows, model, NAMES, ["t"]).collect()}
    for t in (2, 31, 32, 33, 299):
        np.testing.assert_allclose(scored[t], model.step(x[t - p : t]), rtol=1e-9)
    weights, bias = model.output_layer()
    np.testing.assert_allclose(bias + np.concatenate([x[9], x[8]]) @ weights, model.step(x[8:10]))
    dated = rows.withColumn("date", F.date_add(F.to_date(F.lit("2024-01-01")), F.col("t").cast("int")))
    ahead = forecast.recursive_forecast(forecast.last_rows(dated, "t", p), ["domain"], "date", NAMES, model.step, 3).orderBy("step").collect()
    window = x[-p:]
    for r in ahead:
        want = model.step(window)
        np.testing.assert_allclose((r["a"], r["b"]), want, rtol=1e-9)
        window = np.vstack([window[1:], want])
    assert [str(r["date"]) for r in ahead] == ["2024-10-27", "2024-10-28", "2024-10-29"]


@pytest.mark.parametrize("pad", [False, True])
def test_next_step(spark, pad):
    x, p = series(12) + 3.0, 3
    x = x[: p + (0 if pad else 1)]
    model = forecast.VarModel(np.array([0.1, -0.1]), np.arange(12).reshape(3, 2, 2) / 20)
    rows = spark.createDataFrame([(t, *map(float, r)) for t, r in enumerate(x)], "t int, a double, b double")
    dated = rows.withColumn("date", F.date_add(F.to_date(F.lit("2025-06-09")), F.col("t")))
    got = forecast.next_step(dated, "date", NAMES, model, p, pad=pad).first()
    low, high = x.min(axis=0), x.max(axis=0)
    scaled = (x - low) * 2 / (high - low) - 1
    steps = np.diff(scaled, axis=0)
    if pad:
        steps = np.vstack([np.zeros((1, 2)), steps])
    want = (model.step(steps[-p:]) + scaled[-1] + 1) / 2 * (high - low) + low
    np.testing.assert_allclose((got["a"], got["b"]), want, rtol=1e-9)
    network = RegimeNetwork(2, 2, hidden=3)
    fitted = training.Fit("srvar", network, network.initial(0))
    got = forecast.next_step(dated, "date", NAMES, fitted, p, pad=pad).first()
    want = (network.predict(fitted.params, steps[np.newaxis, -p:])[0] + scaled[-1] + 1) / 2 * (high - low) + low
    np.testing.assert_allclose((got["a"], got["b"]), want, rtol=1e-9)
    assert got["date"] == date(2025, 6, 9 + len(x))


def test_passes_between_averagings(spark):
    data = samples(spark, series(), 2, 3)
    once = training.fit(data, {"v": FeedForward(2, 2)}, 2, 5, 0.01)[0]
    often = training.fit(data, {"v": FeedForward(2, 2)}, 2, 5, 0.01, local=4)[0]
    assert [line[0] for line in often.history] == [1, 2, 3, 4, 5]
    assert often.history[-1][1] < once.history[-1][1]
    longer = training.fit(data, {"v": FeedForward(2, 2)}, 2, 4, 0.01)[0]
    assert longer.history[-1][2] == pytest.approx(often.history[0][2])  # one shard: four passes are one averaging of four


def test_regimes_recover_separate_dynamics(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        x = rng.standard_normal(2) * 0.1 + (3 if i % 2 else -3)
        y = (0.9 if i % 2 else -0.4) * x
        rows.append((x.tolist(), y.tolist()))
    got = forecast.regimes(spark.createDataFrame(rows, "x array<double>, y array<double>"), NAMES, 2).collect()
    own = sorted(r["value"] for r in got if r["term"] == r["target"] == "a")
    assert own == pytest.approx([-0.4, 0.9], abs=1e-3)
    assert {round(r["share"], 3) for r in got} == {0.5}


def test_acyclicity(spark):
    edges = [(0, "a", "b", 2.0), (1, "a", "b", 1.0), (1, "b", "a", 1.0), (1, "a", "c", 5.0)]
    got = {r["state"]: r["h"] for r in forecast.acyclicity(spark.createDataFrame(edges, "state int, src string, dst string, weight double"), ["state"]).collect()}
    assert got[0] == pytest.approx(0.0, abs=1e-12)
    assert got[1] == pytest.approx(2 * math.cosh(1) - 2)


def test_metrics_total(spark):
    rows = [("m", "a", 1.0, 2.0), ("m", "a", 1.0, 0.0), ("m", "b", 5.0, 8.0)]
    got = {r["variable"]: r for r in evaluate.forecast_errors(spark.createDataFrame(rows, "model string, variable string, actual double, predicted double")).collect()}
    assert (got["a"]["mse"], got["b"]["mse"], got["Total"]["mse"]) == (1.0, 9.0, 5.0)
    assert got["Total"]["rmse"] == math.sqrt(5.0)
    assert got["Total"]["mae"] == 2.0


# Published errors of one model, per variable and in total.
PUBLISHED = {
    "gold": (327.65662, 18.101288, 10.571769), "russell2000": (592.49713, 24.341265, 15.235763),
    "dow_jones": (96080.61, 309.96872, 174.79758), "msci_world": (607.2192, 24.641817, 14.351362),
    "nasdaq100": (32177.646, 179.38129, 105.66627), "s_p500": (1789.5302, 42.302837, 24.440968),
}
PUBLISHED_TOTAL = (21929.164, 148.08499, 57.5106)


def test_published_totals_follow_the_same_rule(spark):
    """Gaps with the published mse of every variable give the published total mse and rmse."""
    rows = []
    for name, (mse, _, mae) in PUBLISHED.items():
        spread = math.sqrt(mse - mae**2)
        rows += [("m", name, 0.0, mae + spread), ("m", name, 0.0, mae - spread)]
    frame_ = spark.createDataFrame(rows, "model string, variable string, actual double, predicted double")
    got = {r["variable"]: r for r in evaluate.forecast_errors(frame_).collect()}
    for name, (mse, rmse, _) in PUBLISHED.items():
        assert (got[name]["mse"], got[name]["rmse"]) == (pytest.approx(mse, rel=1e-6), pytest.approx(rmse, rel=1e-6))
    # The published numbers were summed in single precision.
    assert got["Total"]["mse"] == pytest.approx(PUBLISHED_TOTAL[0], rel=5e-6)
    assert got["Total"]["rmse"] == pytest.approx(PUBLISHED_TOTAL[1], rel=5e-6)


def test_persistence(spark):
    rows = spark.createDataFrame([("a", t, float(t * t)) for t in range(9)], "s string, t bigint, v double")
    got = sorted((r["actual"], r["predicted"]) for r in evaluate.persistence(rows, ["s"], "t", "v", 4).collect())
    assert got == [(float(t * t), float((t - 1) ** 2)) for t in range(1, 9)]


def test_the_fit_beats_forecasting_nothing(spark):
    """At default settings, on windows that the fit has not seen; also of the chosen regime network fitted on."""
    x, p = series(2500), 2
    data = samples(spark, x, p, 3)
    held = [r for r in data.collect()]
    y = np.vstack([np.frombuffer(r["y"]).reshape(r["n"], -1)[np.frombuffer(r["held"], dtype=bool)] for r in held])
    nothing = float((y**2).mean())
    plain = training.fit(data, {"v": FeedForward(p, 2)}, p)[0]
    assert plain.loss < 0.8 * nothing
    regime = training.fit(data, {f"s{s}": RegimeNetwork(2, s, hidden=16) for s in (2, 3)}, p, rate=0.001, local=5, epochs=10)
    chosen = training.best_fit(regime)
    again = training.refit(data, chosen, p, rate=0.001, local=5, epochs=6)
    assert again.loss <= chosen.loss and len(again.history) > len(chosen.history)
    assert again.loss - ENTROPY_WEIGHT * math.log(3) < nothing


def test_shards_are_averaged(spark):
    """Many shards learn too, whatever the partitions; a shard's moves are those of plain mini-batches."""
    x, p = series(1500), 2
    windows = prep.hash_split(prep.sliding_windows(frame(spark, x), ["domain"], "t", NAMES, p, 32), F.col("t"), 20)
    many = [training.window_samples(windows.repartition(n), shard_rows=100) for n in (1, 7)]
    assert many[0].count() > 10
    fits = [training.fit(s, {"v": FeedForward(p, 2)}, p, 12, 0.005)[0] for s in many]
    np.testing.assert_allclose(fits[0].params, fits[1].params, rtol=1e-7, atol=1e-9)
    assert fits[0].history[-1][1] < 0.9 * fits[0].history[0][1]
    one = training.window_samples(windows).collect()
    assert len(one) == 1
    rows, held = one[0], np.frombuffer(one[0]["held"], dtype=bool)
    a, b = np.frombuffer(rows["x"]).reshape(rows["n"], p, 2)[~held], np.frombuffer(rows["y"]).reshape(rows["n"], 2)[~held]
    network = FeedForward(p, 2)
    flat, first, second = network.initial(42), 0.0, 0.0
    for move, at in enumerate(range(0, len(a), 32), 1):
        sums = network.sums(flat, a[at : at + 32], b[at : at + 32])
        grad = sums["grad"] / sums["stats"][3]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        flat = flat - 0.01 * (first / (1 - 0.9**move)) / (np.sqrt(second / (1 - 0.999**move)) + 1e-8)
    fitted = training.fit(training.window_samples(windows), {"v": network}, p, 1, 0.01)[0]
    np.testing.assert_allclose(fitted.params, flat, rtol=1e-9)


def test_regimes_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(600):
        x = rng.standard_normal(2) * 0.5 + [(-2, 0, 2)[i % 3], (1, -1, 1)[i % 3]]
        rows.append((x.tolist(), ((0.9, -0.4, 0.1)[i % 3] * x).tolist()))
    pairs = spark.createDataFrame(rows, "x array<double>, y array<double>")
    made = [sorted((r["state"], r["term"], r["target"], r["value"], r["share"]) for r in forecast.regimes(pairs.repartition(n), NAMES, 3).collect()) for n in (1, 6)]
    assert [r[:3] for r in made[0]] == [r[:3] for r in made[1]] and len(made[0]) == 18
    np.testing.assert_allclose([r[3:] for r in made[0]], [r[3:] for r in made[1]], rtol=1e-7, atol=1e-9)
    fitted = forecast.mixture(pairs, 2, 3)
    assert (np.diff(fitted.means[:, 0]) > 0).all() and np.abs(fitted.means[:, 0] - [-2, 0, 2]).max() < 0.3
    soft, density = fitted.soft(np.array([r[0] for r in rows[:9]]))
    np.testing.assert_allclose(soft.sum(axis=1), 1)
    direct = [sum(w * np.exp(-0.5 * (r[0] - m) @ np.linalg.inv(c) @ (r[0] - m)) / (2 * np.pi * np.sqrt(np.linalg.det(c))) for w, m, c in zip(fitted.weights, fitted.means, fitted.covariances)) for r in rows[:9]]
    np.testing.assert_allclose(np.exp(density), direct)
    same = spark.createDataFrame([([1.0, 1.0], [1.0, 1.0])] * 5, "x array<double>, y array<double>")
    assert forecast.regimes(same, NAMES, 2).count() == 12


@pytest.mark.parametrize("kind", ["var", "varnn", "varnn_frozen", "srvar"])
def test_a_stored_model_says_what_it_is(spark, tmp_path, kind):
    """Loaded by its path alone, it makes the forecast of the model in memory; saved again over itself, it is stored once."""
    x, p, path = series(20) + 3.0, 2, f"file:{tmp_path}/model"
    var = forecast.VarModel(np.array([0.1, -0.1]), np.arange(8).reshape(2, 2, 2) / 10)
    networks = {"varnn": FeedForward(p, 2), "varnn_frozen": FeedForward(p, 2, var.output_layer()), "srvar": RegimeNetwork(2, 3, hidden=4)}
    fitted = var.as_fit() if kind == "var" else training.Fit(kind, networks[kind], networks[kind].initial(3))
    for order in (1, 0, 2):
        low, high = x.min(axis=0), x.max(axis=0)
        model = stored.ForecastModel(kind, fitted, p, order, NAMES, {c: (low[i], high[i]) for i, c in enumerate(NAMES)})
        model.write().overwrite().save(path)
        rows = spark.createDataFrame([(t, *map(float, r)) for t, r in enumerate(x)], "t int, a double, b double")
        dated = rows.withColumn("date", F.date_add(F.to_date(F.lit("2025-06-09")), F.col("t")))
        loaded = stored.ForecastModel.load(path)
        assert loaded.describe() == model.describe()
        got = loaded.transform(dated).first()
        scaled = (x - low) * 2 / (high - low) - 1
        steps = np.diff(scaled, n=order, axis=0)
        base = {0: 0, 1: scaled[-1], 2: 2 * scaled[-1] - scaled[-2]}[order]
        want = (fitted.network.predict(fitted.params, steps[None, -p:])[0] + base + 1) / 2 * (high - low) + low
        np.testing.assert_allclose((got["a"], got["b"]), want, rtol=1e-9)
    with pytest.raises(Exception, match="exists"):
        model.save(path)
    with pytest.raises(ValueError, match="unknown kind"):
        stored.ForecastModel("arima")


def test_domains_are_forecast_by_their_own_models(spark):
    def model(domain, p, own, const):
        rows = [(domain, "const", 0, c, const) for c in "ab"]
        return rows + [(domain, s, lag, t, own if s == t else 0.0) for lag in range(1, p + 1) for s in "ab" for t in "ab"]

    day = lambda n: date(2024, 1, n)
    history = [("one", day(n), n, float(n), 2.0 * n) for n in range(1, 5)] + [("two", day(n), n, 1.0, float(n)) for n in range(1, 9)]
    history += [(None, day(1), 1, 5.0, 6.0), ("no model", day(1), 1, 1.0, 1.0), ("too short", day(1), 1, 1.0, 1.0)]
    rows = spark.createDataFrame(history, "domain string, date date, t bigint, a double, b double")
    params = model("one", 1, 0.5, 1.0) + model("two", 2, 0.25, 0.0) + model(None, 1, 2.0, 0.0) + model("too short", 2, 1.0, 0.0) + model("no rows", 1, 1.0, 0.0)
    params = spark.createDataFrame(params, "domain string, term string, lag int, target string, value double")
    window = forecast.last_rows_by(rows, ["domain"], "t", 3)
    made = forecast.domain_forecast(window, params, ["domain"], "date", ["a", "b"], 2)
    got = {(r["domain"], r["step"]): (r["date"], r["a"], r["b"]) for r in made.collect()}
    assert got == {
        ("one", 1): (day(5), 3.0, 5.0), ("one", 2): (day(6), 2.5, 3.5),
        ("two", 1): (day(9), 0.5, 3.75), ("two", 2): (day(10), 0.375, 2.9375),
        (None, 1): (day(2), 10.0, 12.0), (None, 2): (day(3), 20.0, 24.0),
    }
    assert forecast.domain_forecast(window.limit(0), params, ["domain"], "date", ["a", "b"], 2).count() == 0
