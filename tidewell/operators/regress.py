"""Regressions on lags: triangular factors of blocks merged in a tree, small systems solved per key.

Rows live on a dense 0-based axis ``t`` with a column per series. ``lag_factors`` gives, per key and block, the triangular factor of
the block's regression terms over all rows that have every lag, plus the first raw vectors. Factors of blocks merge by one more
factorization, and any shorter lag length follows exactly from some columns of the merged factor and the few early rows. So one
pass over the data serves every lag length, pair and test, what is left per key is bounded by the number of terms squared, and
nearly collinear levels keep the digits that their cross products would lose.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.numeric import Solution, adf_p_value, f_tail, solve_factor, triangle
from tidewell.operators import blocks, prep
from tidewell.session import settle

# Rows per block of a cross-product task, and rows worked on at a time.
PRODUCT_BLOCK = 65536
SLICE = 4096
# Factors that one task merges.
FAN = 64

# Longest lag length tried, significance level and digits of the reported tests.
MAX_VAR_LAG = 29
SIGNIFICANCE = 0.05
ADF_DIGITS, GRANGER_DIGITS = 5, 4

Design = Callable[[np.ndarray, int], np.ndarray]


def var_terms(x: np.ndarray, lags: int) -> np.ndarray:
    """Rows ``1, x[t-1], ..., x[t-lags], x[t]`` for every t with all lags."""
    n = len(x) - lags
    parts = [np.ones((n, 1))] + [x[lags - lag : lags - lag + n] for lag in range(1, lags + 1)] + [x[lags:]]
    return np.hstack(parts)


def adf_terms(x: np.ndarray, lags: int) -> np.ndarray:
    """Rows ``1, y[t-1], dy[t-1], ..., dy[t-lags+1], dy[t]``; ``lags`` counts levels, one more than differences."""
    n = len(x) - lags
    steps = np.diff(x, axis=0)
    parts = [np.ones((n, 1)), x[lags - 1 : lags - 1 + n]]
    parts += [steps[lags - 1 - lag : lags - 1 - lag + n] for lag in range(1, lags)]
    return np.hstack([*parts, steps[lags - 1 : lags - 1 + n]])


def _blocks_of(df: DataFrame, keys: Sequence[str], features: Sequence[str], lags: int, size: int) -> tuple[DataFrame, list[str]]:
    names = [f"x{i}" for i in range(len(features))]
    flat = df.select(*keys, "t", *[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)])
    return blocks.with_halo(flat, "t", lags, size), names


def lag_products(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], lags: int, design: Design, size: int = PRODUCT_BLOCK
) -> DataFrame:
    """(keys, i, j, v): sums of products of terms i <= j; rows with i < 0 hold x[-1 - i][j] of the first ``lags`` rows.

    Tasks get plain double columns, a block with its halo at a time, and return one matrix per block; Spark adds these up,
    first inside each task.
    """
    schema = ", ".join(f"{k} {dict(df.dtypes)[k]}" for k in keys) + ", i int, j int, v double"
    spread, names = _blocks_of(df, keys, features, lags, size)

    def products(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("t")
        t = rows["t"].to_numpy()
        if len(t) > 1 and (np.diff(t) != 1).any():
            raise ValueError(f"the axis of {key} has gaps")
        x = rows[names].to_numpy(dtype=float)
        total = None
        for start in range(0, max(len(x) - lags, 0), SLICE):
            z = design(x[start : start + SLICE + lags], lags)
            total = z.T @ z if total is None else total + z.T @ z
        out = []
        if total is not None:
            i, j = np.triu_indices(len(total))
            out.append(pd.DataFrame({"i": i, "j": j, "v": total[i, j]}))
        early = x[t < lags] if key[-1] == 0 else x[:0]
        if len(early):
            i, j = np.indices(early.shape)
            out.append(pd.DataFrame({"i": -1 - i.ravel(), "j": j.ravel(), "v": early.ravel()}))
        if not out:
            out.append(pd.DataFrame({"i": [], "j": [], "v": []}))
        result = pd.concat(out).astype({"i": "int32", "j": "int32", "v": "float64"})
        for position, name in enumerate(keys):
            result.insert(position, name, key[position])
        return result

    return spread.groupBy(*keys, "_block").applyInPandas(products, schema).groupBy(*keys, "i", "j").agg(F.sum("v").alias("v"))


def lag_factors(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], lags: int, design: Design, size: int = PRODUCT_BLOCK
) -> DataFrame:
    """(keys, part, width, factor, early): triangular factors of the terms, at most FAN per key, as flat row-major arrays of ``width``
    columns; ``early`` holds the first ``lags`` rows of a key, in one of its parts.

    A block is factored a slice at a time, so a task holds one block and one triangle. More than FAN blocks are merged in rounds.
    """
    spread, names = _blocks_of(df, keys, features, lags, size)
    types = dict(df.dtypes)
    schema = ", ".join([*(f"{k} {types[k]}" for k in keys), "part bigint, width int, factor array<double>, early array<double>"])

    def frame(key: Sequence, part: int, factor: np.ndarray, early: np.ndarray) -> pd.DataFrame:
        cells = [*key, part, factor.shape[1], factor.ravel(), early.ravel()]
        return pd.DataFrame({name: [cell] for name, cell in zip([*keys, "part", "width", "factor", "early"], cells)})

    def factor_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("t")
        t, block = rows["t"].to_numpy(), int(key[-1])
        if (len(t) > 1 and (np.diff(t) != 1).any()) or (block > 0 and t[0] != block * size - lags):
            raise ValueError(f"the axis of {key} has gaps")
        x = rows[names].to_numpy(dtype=float)
        factor = np.zeros((0, design(np.zeros((lags + 1, len(names))), lags).shape[1]))
        for start in range(0, max(len(x) - lags, 0), SLICE):
            factor = triangle([factor, design(x[start : start + SLICE + lags], lags)])
        return frame(key[:-1], block, factor, x[t < lags] if block == 0 else x[:0])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        factors, early = _unpack(rows)
        return frame(key[:-1], int(key[-1]), triangle(factors), early)

    made = spread.groupBy(*keys, "_block").applyInPandas(factor_block, schema)
    last = df.agg(F.max("t")).first()[0] or 0
    parts = last // size + 1
    while parts > FAN:
        made = made.withColumn("part", F.floor(F.col("part") / FAN)).groupBy(*keys, "part").applyInPandas(merge, schema)
        parts = -(-parts // FAN)
    return made


def _unpack(rows: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """The factors of some parts, in order, and the early vectors."""
    rows = rows.sort_values("part")
    early = [e for e in rows["early"] if len(e)]
    factors = [np.asarray(f, dtype=float).reshape(-1, w) for f, w in zip(rows["factor"], rows["width"])]
    return factors, np.asarray(early[0], dtype=float) if early else np.zeros(0)


@dataclass
class Terms:
    """The merged factor of a key's regression terms and its early rows; ``of`` gives the factor of some columns of a lag length."""

    factor: np.ndarray
    early: np.ndarray
    design: Design

    def of(self, keep: Sequence[int], lags: int) -> np.ndarray:
        """The factor of the columns ``keep`` of the longest lag length, with the early rows that ``lags`` lags have too.

        ``keep`` are the columns of the shorter lag length, in its order.
        """
        parts = [self.factor[:, list(keep)]]
        if lags < len(self.early):
            parts.append(self.design(self.early, lags))
        return triangle(parts)


def _per_key(factors: DataFrame, keys: Sequence[str], k: int, design: Design, solve: Callable[[Terms], Iterable[tuple]], schema: str) -> DataFrame:
    """Run ``solve(terms) -> rows`` for each key; its input is bounded by FAN times the number of terms squared."""
    types = dict(factors.dtypes)
    columns = [part.split()[0] for part in schema.split(", ")]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        parts, early = _unpack(rows)
        out = pd.DataFrame(list(solve(Terms(triangle(parts), early.reshape(-1, k), design))), columns=columns)
        for position, name in enumerate(keys):
            out.insert(position, name, key[position])
        return out

    return factors.groupBy(*keys).applyInPandas(run, ", ".join([*(f"{k} {types[k]}" for k in keys), schema]))


def _rows_of(factor: np.ndarray) -> int:
    """How many rows a factor stands for: its first column is the constant."""
    return int(round(factor[0, 0] ** 2)) if factor.size else 0


def _var_factor(terms: Terms, k: int, longest: int, p: int) -> np.ndarray:
    """The factor of a lag length p <= longest over all rows t >= p."""
    return terms.of([*range(1 + k * p), *range(1 + k * longest, 1 + k * (longest + 1))], p)


def var_fit(df: DataFrame, keys: Sequence[str], features: Sequence[str], p: int, size: int = PRODUCT_BLOCK) -> DataFrame:
    """VAR(p) with a constant by least squares: (keys, term, lag, target, value, ill_conditioned).

    ``term`` is ``const`` (lag 0) or the name of the lagged series. A singular system gets its solution of least norm, and the mark.
    """
    names, k = list(features), len(features)
    factors = lag_factors(df, keys, features, p, var_terms, size)

    def solve(terms: Terms) -> Iterable[tuple]:
        m = 1 + k * p
        found = solve_factor(_var_factor(terms, k, p, p), m)
        for row in range(m):
            term, lag = ("const", 0) if row == 0 else (names[(row - 1) % k], (row - 1) // k + 1)
            for column in range(k):
                yield term, lag, names[column], float(found.beta[row, column]), found.ill

    return _per_key(factors, keys, k, var_terms, solve, "term string, lag int, target string, value double, ill_conditioned boolean")


def var_lag_choice(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], longest: int = MAX_VAR_LAG, size: int = PRODUCT_BLOCK
) -> DataFrame:
    """(keys, p, aic) for p = 1..longest, each on all rows it can use; lag lengths that cannot be fitted are left out."""
    k = len(features)
    factors = lag_factors(df, keys, features, longest, var_terms, size)

    def solve(terms: Terms) -> Iterable[tuple]:
        for p in range(1, longest + 1):
            factor = _var_factor(terms, k, longest, p)
            m, n = 1 + k * p, _rows_of(factor)
            if n <= m:
                continue
            found = solve_factor(factor, m)
            spread = np.abs(np.diag(triangle([found.residual])))
            if not found.ill and len(spread) == k and spread.min() > 0:
                yield p, float(2.0 * np.log(spread).sum() - k * math.log(n) + 2.0 * (p * k * k + k) / n)

    return _per_key(factors, keys, k, var_terms, solve, "p int, aic double")


def best_lag(choice: DataFrame, keys: Sequence[str]) -> DataFrame:
    return choice.groupBy(*keys).agg(F.min_by("p", "aic").alias("p"))


def adf_max_lag(n: int) -> int:
    """Longest difference lag tried for a series of n values."""
    return max(min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2), 0)


def adf_test(
    df: DataFrame, keys: Sequence[str], value: str, size: int = PRODUCT_BLOCK, longest: int | None = None
) -> DataFrame:
    """Augmented Dickey-Fuller per key with a constant and the lag length of least AIC: (keys, statistic, p_value, lag, n).

    Lag lengths are tried up to ``longest``, by default the usual limit for the length of each series.
    """
    if longest is None:
        longest = adf_max_lag(df.groupBy(*keys).count().agg(F.max("count")).first()[0])
    factors = lag_factors(df, keys, [value], longest + 1, adf_terms, size)

    def terms_from(terms: Terms, lag: int) -> np.ndarray:
        """The factor of ``1, y[t-1], dy[t-1..t-lag], dy[t]`` over every row that has them."""
        return terms.of([*range(2 + lag), 2 + longest], lag + 1)

    def solve(terms: Terms) -> Iterable[tuple]:
        n_values = _rows_of(terms.factor) + len(terms.early)
        limit = min(adf_max_lag(n_values), longest)
        if n_values < 4:
            yield None, None, None, n_values
            return
        common = terms_from(terms, limit)
        n, rest = _rows_of(common), common[:, -1] ** 2
        scores = [n * math.log(max(rest[2 + lag :].sum(), 1e-300) / n) + 2.0 * (2 + lag) for lag in range(limit + 1)]
        lag = int(np.argmin(scores))
        own = terms_from(terms, lag)
        m, n_own = 2 + lag, _rows_of(own)
        found = solve_factor(own, m)
        ssr = float((found.residual**2).sum())
        if found.ill or n_own <= m or ssr <= (1e-12 * np.linalg.norm(own[:, -1])) ** 2:
            yield None, None, lag, n_own
            return
        statistic = float(found.beta[1, 0] / (math.sqrt(ssr / (n_own - m)) * found.spread[1]))
        yield statistic, round(adf_p_value(statistic), ADF_DIGITS), lag, n_own

    return _per_key(factors, keys, 1, adf_terms, solve, "statistic double, p_value double, lag int, n bigint")


@dataclass
class Stationary:
    """How often to difference, whether every key then passes the test, and all the tests made on the way."""

    order: int
    reached: bool
    tests: DataFrame


def stationary_order(
    df: DataFrame, keys: Sequence[str], value: str, most: int | None = None, size: int = PRODUCT_BLOCK
) -> Stationary:
    """The least number of first differences after which every key passes the test.

    The search ends when all keys pass, or when the sample is used up: no key that fails can be tested any more, being too short or
    without any variation. ``most`` ends it earlier. ``reached`` says which it was.
    """
    current, log, order = df.select(*keys, "t", value), None, 0
    while True:
        result = settle(adf_test(current, keys, value, size).withColumn("order", F.lit(order)), "adf")
        log = result if log is None else log.unionByName(result)
        failed = ~F.coalesce(F.col("p_value") <= SIGNIFICANCE, F.lit(False))
        n_failed, testable = result.agg(F.count_if(failed), F.count_if(failed & F.col("p_value").isNotNull())).first()
        if not testable or order == most:
            return Stationary(order, not n_failed, log)
        moved = prep.difference_wide(current, keys, "t", [value], 1)
        current = settle(moved.withColumn("t", F.col("t") - 1), "differences")
        order += 1


def granger_tests(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], longest: int, size: int = PRODUCT_BLOCK
) -> DataFrame:
    """(keys, y, x, lag, n, statistic, p_value): the F test of each lag length that x's past does not help y's own past.

    Lag lengths that cannot be tested are left out. A series against itself has no test: one row with nulls.
    """
    names, k = list(features), len(features)
    factors = lag_factors(df, keys, features, longest, var_terms, size)

    def solve(terms: Terms) -> Iterable[tuple]:
        of_lag = {p: _var_factor(terms, k, longest, p) for p in range(1, longest + 1)}
        for y in range(k):
            for x in range(k):
                if x == y:
                    yield names[y], names[x], None, None, None, None
                    continue
                for p, factor in of_lag.items():
                    own = [0] + [1 + k * lag + y for lag in range(p)]
                    n = _rows_of(factor)
                    free = n - (2 * p + 1)
                    if free <= 0:
                        continue
                    columns = own + [1 + k * lag + x for lag in range(p)] + [1 + k * p + y]
                    joint = triangle([factor[:, columns]])
                    found: Solution = solve_factor(joint, 2 * p + 1)
                    rest = joint[:, -1] ** 2
                    restricted, full = rest[1 + p :].sum(), rest[2 * p + 1 :].sum()
                    if found.ill or full <= 0:
                        continue
                    statistic = float((restricted - full) / full / p * free)
                    yield names[y], names[x], p, n, statistic, round(f_tail(statistic, p, free), GRANGER_DIGITS)

    schema = "y string, x string, lag int, n bigint, statistic double, p_value double"
    return _per_key(factors, keys, k, var_terms, solve, schema)


def granger(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], longest: int, size: int = PRODUCT_BLOCK
) -> DataFrame:
    """(keys, y, x, p_value): least p over lags 1..longest of ``granger_tests``; null for a series against itself and without any test."""
    tests = granger_tests(df, keys, features, longest, size)
    pairs = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in features for x in features])
    grouped = tests.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("p_value").isNotNull(), F.struct("y", "x", "p_value"))).alias("tests")
    )
    spread = grouped.select(*keys, "tests", F.explode(pairs).alias("pair"))
    mine = F.filter("tests", lambda t: (t["y"] == F.col("pair.y")) & (t["x"] == F.col("pair.x")))
    return spread.select(*keys, "pair.y", "pair.x", F.array_min(F.transform(mine, lambda t: t["p_value"])).alias("p_value"))


def granger_matrix(pairs: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """The pairs as a matrix: a row ``{y}_y`` per series, a column ``{x}_x`` per series."""
    cells = [F.max(F.when(F.col("x") == c, F.col("p_value"))).alias(f"{c}_x") for c in features]
    return pairs.groupBy(*keys, F.concat("y", F.lit("_y")).alias("variable")).agg(*cells)
