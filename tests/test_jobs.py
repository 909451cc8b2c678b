"""The end-to-end jobs."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import forecast, prep, training, upsert
from tidewell.operators.versions import VersionedTable
from tidewell.plans import forecasting, medallion, publishing
from tidewell.sources import quotes

HEADER = "Date,Close,High,Low,Open,Volume\n"
HISTORY = "Date,Price,Open,High,Low,Vol.,Change %\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def quote_text(ticker, rows):
    return HEADER + f",{ticker},{ticker},{ticker},{ticker},{ticker}\n" + "".join(f"{d},{p},{p},{p},{p},1\n" for d, p in rows)


def test_load_from_both_layouts(spark, tmp_path):
    new, old = tmp_path / "new", tmp_path / "old"
    write(new / "US Dollar" / "f_05_06_2025.csv", quote_text("DX", [("2025-06-03", 99.0), ("2025-06-05", 98.5)]))
    write(new / "US Dollar" / "f_06_06_2025.csv", quote_text("DX", [("2025-06-05", 98.75)]))
    write(new / "US Dollar" / "f_30_05_2025.csv", quote_text("DX", [("2025-06-05", 1.0)]))
    write(old / "Gold" / "history.csv", HISTORY + '06/02/2025,"3,300.5",1,1,1,1K,0.1%\n06/04/2025,"3,310.0",1,1,1,1K,0.1%\n')
    roots = [(str(new), quotes.VENDOR_LAYOUT), (str(old), quotes.HISTORY_LAYOUT), (str(tmp_path / "none"), quotes.VENDOR_LAYOUT)]
    warehouse = f"file:{tmp_path}/warehouse"
    columns = {"us_dollar": "us_dollar", "gold": "gold"}
    check = medallion.load(spark, roots, warehouse, columns, "macro").first()
    assert (check["n_rows"], check["null_gold"]) == (3, 0)
    table = VersionedTable(spark, f"{warehouse}/macro")
    got = [tuple(r) for r in table.read().orderBy("date").select("id", "date", "gold", "us_dollar").collect()]
    assert got == [
        (1, date(2025, 6, 3), 3300.5, 99.0),
        (2, date(2025, 6, 4), 3310.0, 99.0),
        (3, date(2025, 6, 5), 3310.0, 98.75),
    ]
    write(new / "Oil" / "f_06_06_2025.csv", quote_text("CL", [("2025-06-05", "n/a")]))
    heads = {name: VersionedTable(spark, f"{warehouse}/{name}").head() for name in ("bronze", "silver", "macro")}
    with pytest.raises(ValueError, match="oil"):
        medallion.load(spark, roots, warehouse, columns, "macro")
    assert heads == {name: VersionedTable(spark, f"{warehouse}/{name}").head() for name in heads}


def gold_table(spark, n=260):
    rng = np.random.default_rng(11)
    walk = np.cumsum(rng.standard_normal((n, 2)), axis=0) + 100
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(walk)]
    frame = spark.createDataFrame(rows, "i int, gold double, oil double")
    return frame.select(F.date_add(F.to_date(F.lit("2024-01-01")), F.col("i")).alias("date"), "gold", "oil"), walk


@pytest.mark.parametrize("model,anchor", [("varnn", "cumulative"), ("varnn_frozen", "aligned"), ("srvar", "cumulative")])
def test_forecast_run(spark, model, anchor):
    table, walk = gold_table(spark)
    result = forecasting.run(table, ["gold", "oil"], model, epochs=2, longest_lag=3, anchor=anchor)
    assert result.order == 1
    assert 1 <= result.p <= 3
    predicted = result.predicted.toPandas()
    assert predicted.groupby("variable").size().to_dict() == {v: 52 - 1 - result.p for v in ("gold", "oil")}
    truth = {(d, v): walk[(d - date(2024, 1, 1)).days, i] for i, v in enumerate(("gold", "oil")) for d in predicted["date"]}
    for _, row in predicted.iterrows():
        assert row["actual"] == pytest.approx(truth[row["date"], row["variable"]])
    errors = {(r["scale"], r["variable"]): r for r in result.errors.collect()}
    assert len(errors) == 6
    assert 0.1 < errors["original", "Total"]["rmse"] < 20
    future = result.future.orderBy("variable", "date").collect()
    assert len(future) == 2 * result.p
    assert future[0]["date"] == date(2024, 9, 17)
    assert all(abs(r["value"] - walk[-1, 0 if r["variable"] == "gold" else 1]) < 40 for r in future)


def test_publish_forecasts(spark, tmp_path):
    root, warehouse, day = f"file:{tmp_path}/files", f"file:{tmp_path}/gold", date(2025, 6, 10)
    frames = {
        folder: spark.createDataFrame([(float(i + bias), date(2025, 6, 11 + i)) for i in range(3)], "gold double, date date")
        for folder, bias in (("SrVAR", 0), ("VARNN", 10))
    }
    args = (spark, root, warehouse, "macro", "future", ["gold"], day)
    assert publishing.publish_forecasts(*args) is None
    publishing.write_forecast(frames["SrVAR"], root, "future", "SrVAR", "macro", day)
    assert publishing.publish_forecasts(*args) is None
    publishing.write_forecast(frames["VARNN"], root, "future", "VARNN", "macro", day)
    for _ in range(2):
        assert publishing.publish_forecasts(*args).first()["n_rows"] == 3
    stored = upsert.read(spark, f"{warehouse}/macro_future").orderBy("date")
    assert [(r["id"], r["gold_srvar"], r["gold_varnn"], r["year"], r["month"]) for r in stored.collect()] == [
        (20250, 0.0, 10.0, 2025, 6), (20251, 1.0, 11.0, 2025, 6), (20252, 2.0, 12.0, 2025, 6),
    ]


def test_publish_metrics(spark, tmp_path):
    rows = [(m, v, 1.0, 1.0, 1.0) for m in ("srvar", "varnn") for v in ("gold", "Total")]
    target = f"file:{tmp_path}/eval"
    publishing.publish_metrics(spark.createDataFrame(rows, "model string, variable string, mse double, rmse double, mae double"), target)
    got = spark.read.parquet(target)
    assert got.count() == 2
    assert {"id", "variable", "mse_srvar", "mae_var"} <= set(got.columns)


def test_two_models_from_gold_to_gold(spark, tmp_path):
    table, walk = gold_table(spark)
    features, root, warehouse, day = ["gold", "oil"], f"file:{tmp_path}/files", f"file:{tmp_path}/gold", date(2025, 6, 10)
    results = {}
    for folder, model in (("SrVAR", "srvar"), ("VARNN", "varnn")):
        results[model] = forecasting.run(table, features, model, epochs=1, longest_lag=2, horizon=4)
        publishing.write_run(results[model], features, root, folder, "macro", day)
    future = publishing.publish_forecasts(spark, root, warehouse, "macro", "future", features, day).first()
    assert future["n_rows"] == 4
    predict = publishing.publish_forecasts(spark, root, warehouse, "macro", "predict", features, day).first()
    assert predict["n_rows"] == 51 - results["srvar"].p
    publishing.publish_metrics(publishing.read_metrics(spark, root, "macro"), f"{warehouse}/macro_eval")
    assert spark.read.parquet(f"{warehouse}/macro_eval").count() == 3
    # The stored scaler and parameters give the first forecast again.
    fitted = results["varnn"].fitted
    path = f"{root}/model/VARNN"
    loaded = training.load_params(spark, f"{path}/params", fitted.network, "varnn", "macro", day)
    scaler = prep.stored_scaler(spark.read.parquet(f"{path}/scaler").where("domain = 'macro'"), features)
    got = forecast.next_step(table, "date", features, loaded, results["varnn"].p, scaler).first()
    want = {r["variable"]: r["value"] for r in results["varnn"].future.where(f"date = '{got['date']}'").collect()}
    assert got["gold"] == pytest.approx(want["gold"])
    assert got["oil"] == pytest.approx(want["oil"])
