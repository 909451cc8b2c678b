"""Shared parts of the check SQL: the derived tables, written as the plainest SQL that defines them."""

from __future__ import annotations

from tidewell.sources.fixtures import BATCH_FROM, FEATURES, STORED_UNTIL, WIDE

_SERIES = "lower(regexp_replace(o_orderpriority, '[^A-Za-z0-9]+', '_', 'g'))"
_LAGS = ", ".join(f"{c} - lag({c}) OVER w AS {c}" for c in FEATURES)
_SCALED = ", ".join(
    f"(x.{c} - b.{c}_lo) * 2 / CASE WHEN b.{c}_hi = b.{c}_lo THEN 1 ELSE b.{c}_hi - b.{c}_lo END - 1 AS {c}"
    for c in FEATURES
)
_BOUNDS = ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in FEATURES)

# name -> (tables it reads, definition)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "quotes": (
        (),
        f"SELECT {_SERIES} AS series, o_orderdate::DATE AS date, o_totalprice AS price, o_orderstatus AS status,"
        " o_orderkey AS arrival FROM orders",
    ),
    "quotes_raw": (
        ("quotes",),
        "SELECT series, strftime(date, '%m/%d/%Y') AS d, format('{:,.2f}', price) AS p, arrival, status FROM quotes",
    ),
    "quotes_dirty": (
        ("quotes_raw",),
        "SELECT series, d, CASE WHEN status = 'P' THEN NULL WHEN length(p) > 9 THEN 'n/a' ELSE p END AS p, arrival,"
        " status FROM quotes_raw, generate_series(1, 2) AS g(copy) WHERE copy = 1 OR status = 'F'",
    ),
    "folder_paths": (
        (),
        f"SELECT o_orderkey AS file_no, '/raw/' || o_orderpriority || '/' || {_SERIES} || '_' ||"
        " strftime(o_orderdate, '%d_%m_%Y') || '.csv' AS path FROM orders",
    ),
    "px": (
        ("quotes",),
        "SELECT series, date, arg_max(price, arrival) AS price, arg_min(price, arrival) AS open, max(price) AS high,"
        " min(price) AS low FROM quotes GROUP BY series, date",
    ),
    "px_gaps": (
        ("quotes",),
        "SELECT series, date, (list(CASE WHEN status <> 'P' THEN price END ORDER BY arrival DESC))[1] AS price,"
        " (list(CASE WHEN status <> 'P' THEN price END ORDER BY arrival))[1] AS open FROM quotes GROUP BY series, date",
    ),
    "calendar": (
        ("px",),
        "SELECT series, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM px GROUP BY series",
    ),
    "dense": (
        ("px", "calendar"),
        "SELECT series, date, last_value(price IGNORE NULLS) OVER w AS price, last_value(open IGNORE NULLS) OVER w AS open,"
        " last_value(high IGNORE NULLS) OVER w AS high, last_value(low IGNORE NULLS) OVER w AS low"
        " FROM calendar LEFT JOIN px USING (series, date) WINDOW w AS (PARTITION BY series ORDER BY date)",
    ),
    "days": (
        ("px",),
        "SELECT unnest(generate_series(max(first), max(last), INTERVAL 1 DAY))::DATE AS date FROM"
        " (SELECT min(date) AS first, max(date) AS last FROM px GROUP BY series)",
    ),
    "wide": (
        ("px", "days"),
        "SELECT date, "
        + ", ".join(
            f"(SELECT arg_max(price, px.date) FROM px WHERE px.series = '{s}' AND px.date <= days.date) AS {c}"
            for s, c in WIDE.items()
        )
        + ", year(date)::BIGINT AS year, month(date)::BIGINT AS month,"
        " (date - (SELECT min(date) FROM days) + 1)::BIGINT AS id FROM days",
    ),
    "split": (
        ("wide",),
        "SELECT *, id - 1 AS t, CASE WHEN id - 1 < (SELECT floor(count(*) * 0.8) FROM wide) THEN 'train' ELSE 'test' END"
        " AS fold FROM wide",
    ),
    "bounds": (("split",), f"SELECT {_BOUNDS} FROM split WHERE fold = 'train'"),
    "scaled": (("split", "bounds"), f"SELECT x.date, x.t, x.fold, {_SCALED} FROM split x, bounds b"),
    "scaled_diff": (
        ("scaled",),
        "SELECT * FROM (SELECT date, t - 1 AS t, fold, " + _LAGS + " FROM scaled"
        f" WINDOW w AS (PARTITION BY fold ORDER BY t)) WHERE {FEATURES[0]} IS NOT NULL",
    ),
    "monthly": (
        (),
        "SELECT l_returnflag AS indicator, date_trunc('month', l_shipdate)::DATE AS date, round(avg(l_discount) + 1e-10, 6) + 0.0 AS rate"
        " FROM lineitem GROUP BY 1, 2",
    ),
    "shipping": (
        (),
        "SELECT l_returnflag AS indicator, l_shipdate::DATE AS date, count(*) AS n_lines FROM lineitem GROUP BY 1, 2",
    ),
    "existing": (("px",), f"SELECT series, date, price FROM px WHERE date < DATE '{STORED_UNTIL}'"),
    "batch": (
        ("quotes",),
        "SELECT series, date, arg_max(price, arrival) + 1 AS price FROM quotes"
        f" WHERE status = 'F' AND date >= DATE '{BATCH_FROM}' GROUP BY series, date",
    ),
    "span": (("batch",), "SELECT min(date) AS low, max(date) AS high FROM batch"),
    "forecasts": (
        ("dense",),
        "SELECT model, variable, date, actual, CASE model WHEN 'srvar' THEN lag1 ELSE (lag1 + lag2) / 2 END AS predicted"
        " FROM (SELECT series AS variable, date, price AS actual, lag(price) OVER w AS lag1, lag(price, 2) OVER w AS lag2"
        " FROM dense WINDOW w AS (PARTITION BY series ORDER BY date)), (VALUES ('srvar'), ('varnn')) AS m(model)"
        " WHERE lag2 IS NOT NULL",
    ),
    "errors": (
        ("forecasts",),
        "SELECT model, variable, avg((actual - predicted) ** 2) AS mse, sqrt(avg((actual - predicted) ** 2)) AS rmse,"
        " avg(abs(actual - predicted)) AS mae FROM forecasts GROUP BY model, variable",
    ),
    "hour_bars": (
        (),
        "SELECT event_type AS series, date_trunc('hour', ts) AS hour, arg_max(value, (ts, event_id)) AS price,"
        " arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low FROM events GROUP BY 1, 2",
    ),
    "audit": (
        (),
        "SELECT event_id AS snapshot_id, event_type AS branch, user_id AS author, ts, props AS op FROM events",
    ),
    "snap_a": ((), "SELECT c_custkey AS account, c_name AS name, c_acctbal AS balance FROM customer"),
    "snap_b": (
        (),
        "SELECT c_custkey AS account, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal"
        " END AS balance FROM customer WHERE c_acctbal >= 0"
        " UNION ALL SELECT s_suppkey + 1000000000000, s_name, s_acctbal FROM supplier",
    ),
}


def check_sql(body: str, *parts: str, extra: str = "", recursive: bool = False) -> str:
    """``body`` preceded by the parts it names, each once, and by ``extra`` definitions of its own."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in PARTS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for part in parts:
        add(part)
    definitions = [f"{name} AS ({PARTS[name][1]})" for name in ordered] + ([extra] if extra else [])
    if not definitions:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(definitions)} {body}"


def rounded(column: str, digits: int, alias: str | None = None) -> str:
    """Rounded without a negative zero, halfway values up, as ``scalars.tidy`` does."""
    return f"round({column} + 1e-{digits + 4}, {digits}) + 0.0 AS {alias or column}"


def rounded_all(columns, digits: int) -> str:
    return ", ".join(rounded(c, digits) for c in columns)


def products_sql(rows: list[str], columns: list[str]) -> str:
    """Matrix of the sums of products of columns, as a list of lists."""
    return "[" + ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in columns) + "]" for a in rows) + "]"


def elimination_sql(source: str, by: str, steps: str) -> str:
    """Gauss-Jordan elimination of the matrix ``m`` of each row of ``source``, a step per row of the result.

    Row ``k`` holds the matrix after k - 1 steps; ``steps`` is the number of steps of a row.
    """
    reduced = (
        "list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m[1]) + 1), lambda j:"
        " CASE WHEN i = k THEN m[k][j] / m[k][k] ELSE m[i][j] - m[i][k] * m[k][j] / m[k][k] END))"
    )
    return (
        f"solve AS (SELECT 1 AS k, {by}, m FROM {source} UNION ALL SELECT k + 1, {by}, {reduced} FROM solve WHERE k <= {steps})"
    )
