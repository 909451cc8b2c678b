"""Lag regressions against direct least squares on the whole series."""

import math

import numpy as np
import pytest

from tidewell.functions import numeric
from tidewell.operators import regress

NAMES = ["a", "b", "c"]


def simulate(seed=1, n=300):
    rng = np.random.default_rng(seed)
    x = np.zeros((n, 3))
    for t in range(1, n):
        x[t] = [0.5 * x[t - 1, 0], 0.3 * x[t - 1, 1] + 0.6 * x[t - 1, 0], -0.2 * x[t - 1, 2]] + rng.standard_normal(3)
    return x


def frame(spark, x):
    return spark.createDataFrame([("d", t, *map(float, r)) for t, r in enumerate(x)], "domain string, t bigint, a double, b double, c double")


def direct(y, z):
    beta, *_ = np.linalg.lstsq(z, y, rcond=None)
    return beta, ((y - z @ beta) ** 2).sum(axis=0)


@pytest.mark.parametrize("p,size", [(1, 16), (4, 16), (4, 65536)])
def test_var_fit(spark, p, size):
    x = simulate()
    z = regress.var_terms(x, p)
    beta, _ = direct(z[:, -3:], z[:, :-3])
    got = regress.var_fit(frame(spark, x), ["domain"], NAMES, p, size).collect()
    assert len(got) == (1 + 3 * p) * 3
    for r in got:
        row = 0 if r["lag"] == 0 else 1 + (r["lag"] - 1) * 3 + NAMES.index(r["term"])
        assert r["value"] == pytest.approx(beta[row, NAMES.index(r["target"])], abs=1e-9)
        assert not r["ill_conditioned"]


def test_var_lag_choice(spark):
    x, longest = simulate(), 6
    got = {r["p"]: r["aic"] for r in regress.var_lag_choice(frame(spark, x), ["domain"], NAMES, longest, 32).collect()}
    assert sorted(got) == list(range(1, longest + 1))
    for p, aic in got.items():
        z = regress.var_terms(x, p)
        beta, _ = direct(z[:, -3:], z[:, :-3])
        errors = z[:, -3:] - z[:, :-3] @ beta
        n = len(z)
        want = math.log(np.linalg.det(errors.T @ errors / n)) + 2.0 * (p * 9 + 3) / n
        assert aic == pytest.approx(want, abs=1e-9)
    chosen = regress.best_lag(regress.var_lag_choice(frame(spark, x), ["domain"], NAMES, longest), ["domain"]).first()
    assert chosen["p"] == min(got, key=got.get)


def test_lag_longer_than_series(spark):
    x = simulate(n=12)
    got = regress.var_lag_choice(frame(spark, x), ["domain"], NAMES, 29).collect()
    assert {r["p"] for r in got} <= {1, 2}


def test_axis_with_gap_is_refused(spark):
    rows = frame(spark, simulate(n=30)).where("t <> 11")
    with pytest.raises(Exception, match="gaps"):
        regress.var_fit(rows, ["domain"], NAMES, 1).collect()


def adf_direct(y):
    limit = regress.adf_max_lag(len(y))
    steps = np.diff(y)

    def fit(lag, first):
        rows = range(first, len(steps))
        z = np.array([[1.0, y[t], *[steps[t - i] for i in range(1, lag + 1)]] for t in rows])
        target = steps[first:]
        beta, ssr = direct(target, z)
        return z, beta, ssr, len(target)

    scores = []
    for lag in range(limit + 1):
        z, _, ssr, n = fit(lag, limit)
        scores.append(n * math.log(ssr / n) + 2 * z.shape[1])
    lag = int(np.argmin(scores))
    z, beta, ssr, n = fit(lag, lag)
    error = math.sqrt(ssr / (n - z.shape[1]) * np.linalg.inv(z.T @ z)[1, 1])
    return beta[1] / error, lag, n


def test_adf(spark):
    rng = np.random.default_rng(7)
    walk = np.cumsum(rng.standard_normal(400))
    mean_back = np.zeros(150)
    for t in range(1, 150):
        mean_back[t] = 0.4 * mean_back[t - 1] + rng.standard_normal()
    series = {"walk": walk, "back": mean_back, "short": walk[:3]}
    rows = spark.createDataFrame([(s, t, float(v)) for s, y in series.items() for t, v in enumerate(y)], "s string, t bigint, v double")
    for size in (64, 65536):
        got = {r["s"]: r for r in regress.adf_test(rows, ["s"], "v", size).collect()}
        for name in ("walk", "back"):
            statistic, lag, n = adf_direct(series[name])
            assert got[name]["statistic"] == pytest.approx(statistic, abs=1e-8)
            assert (got[name]["lag"], got[name]["n"]) == (lag, n)
        assert got["walk"]["p_value"] > 0.05 > got["back"]["p_value"]
        assert got["short"]["statistic"] is None


def test_stationary_order(spark):
    rng = np.random.default_rng(3)
    series = {"walk": np.cumsum(rng.standard_normal(400)), "noise": rng.standard_normal(400)}
    rows = spark.createDataFrame([(s, t, float(v)) for s, y in series.items() for t, v in enumerate(y)], "s string, t bigint, v double")
    found = regress.stationary_order(rows, ["s"], "v")
    assert found.order == 1 and found.reached
    assert found.tests.count() == 4
    assert regress.stationary_order(rows.where("s = 'noise'"), ["s"], "v").order == 0


def test_differencing_goes_on_until_all_pass_or_none_can_be_tested(spark):
    rng = np.random.default_rng(4)
    four = rng.standard_normal(500)
    for _ in range(4):
        four = np.cumsum(four)
    series = {"four": four, "noise": rng.standard_normal(300)}

    def run(series, **options):
        rows = spark.createDataFrame([(s, t, float(v)) for s, y in series.items() for t, v in enumerate(y)], "s string, t bigint, v double")
        return regress.stationary_order(rows, ["s"], "v", **options)

    found = run(series)
    assert found.reached and found.order >= 4
    capped = run(series, most=1)
    assert capped.order == 1 and not capped.reached
    stuck = run({"flat": np.zeros(40), "line": np.arange(40.0), "short": rng.standard_normal(3)})
    assert not stuck.reached and stuck.order <= 2


def test_nearly_collinear_levels_fit_like_lstsq(spark):
    """Levels whose cross products have lost their digits: coefficients, lag choice and tests keep them."""
    rng = np.random.default_rng(6)
    level = 1000 + np.cumsum(rng.standard_normal(900))
    x = np.column_stack([level, level + 1e-6 * np.cumsum(rng.standard_normal(900)), 0.5 * level + 1e-5 * rng.standard_normal(900)])
    p, n = 2, len(x) - 2
    z = np.hstack([np.ones((n, 1)), x[1:-1], x[:-2]])
    assert np.linalg.cond((z / np.linalg.norm(z, axis=0)).T @ (z / np.linalg.norm(z, axis=0))) > 1e14
    want = np.linalg.lstsq(z / np.linalg.norm(z, axis=0), x[2:], rcond=None)[0]
    for size in (64, 7):  # 7: more blocks than one task merges
        rows = regress.var_fit(frame(spark, x), ["domain"], NAMES, p, size).collect()
        assert not any(r["ill_conditioned"] for r in rows)
        got = np.zeros((7, 3))
        for r in rows:
            got[0 if r["lag"] == 0 else 1 + 3 * (r["lag"] - 1) + NAMES.index(r["term"]), NAMES.index(r["target"])] = r["value"]
        fitted = z @ got
        np.testing.assert_allclose(fitted, (z / np.linalg.norm(z, axis=0)) @ want, rtol=1e-8)
    lags = {r["p"] for r in regress.var_lag_choice(frame(spark, x), ["domain"], NAMES, 4).collect()}
    assert lags == {1, 2, 3, 4}
    assert all(r["p_value"] is not None for r in regress.granger(frame(spark, x), ["domain"], NAMES, 2).collect() if r["x"] != r["y"])


def test_a_gap_that_empties_a_halo_is_refused(spark):
    rows = frame(spark, simulate(n=60)).where("t < 17 or t >= 20")
    with pytest.raises(Exception, match="gaps"):
        regress.var_fit(rows, ["domain"], NAMES, 2, 20).collect()


@pytest.mark.parametrize("value,p", [(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)])
def test_adf_p_value(value, p):
    assert numeric.adf_p_value(value) == pytest.approx(p, abs=1e-3)


def test_adf_p_value_is_clamped():
    assert numeric.adf_p_value(5.0) == 1.0
    assert numeric.adf_p_value(-30.0) == 0.0


@pytest.mark.parametrize(
    "f,d1,d2,p", [(4.9646, 1, 10, 0.05), (4.1028, 2, 10, 0.05), (2.8661, 4, 20, 0.05), (6.6349, 1, 1e6, 0.01), (1.0, 7, 7, 0.5)]
)
def test_f_tail(f, d1, d2, p):
    assert numeric.f_tail(f, d1, d2) == pytest.approx(p, rel=2e-3)


def test_granger(spark):
    x, longest = simulate(), 3
    got = {(r["y"], r["x"]): r["p_value"] for r in regress.granger(frame(spark, x), ["domain"], NAMES, longest, 40).collect()}
    for i, y in enumerate(NAMES):
        assert got[y, y] is None
        for j, cause in enumerate(NAMES):
            if i == j:
                continue
            values = []
            for p in range(1, longest + 1):
                n = len(x) - p
                own = [np.ones(n)] + [x[p - lag : p - lag + n, i] for lag in range(1, p + 1)]
                both = own + [x[p - lag : p - lag + n, j] for lag in range(1, p + 1)]
                _, ssr_own = direct(x[p:, i], np.array(own).T)
                _, ssr_both = direct(x[p:, i], np.array(both).T)
                free = n - 2 * p - 1
                values.append(round(numeric.f_tail((ssr_own - ssr_both) / ssr_both / p * free, p, free), 4))
            assert got[y, cause] == pytest.approx(min(values), abs=1e-4)
    assert got["b", "a"] == 0.0
    matrix = regress.granger_matrix(regress.granger(frame(spark, x), ["domain"], NAMES, longest), ["domain"], NAMES)
    assert matrix.columns == ["domain", "variable", "a_x", "b_x", "c_x"]


def test_singular_system_is_flagged(spark):
    x = simulate()
    x[:, 2] = 2 * x[:, 0]
    assert all(r["ill_conditioned"] for r in regress.var_fit(frame(spark, x), ["domain"], NAMES, 1).collect())
