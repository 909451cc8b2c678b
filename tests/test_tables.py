"""Files, tables, upserts, versions and streams on hand-made rows."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidewell.functions import scalars
from tidewell.operators import clean, gold, semantic, upsert, versions
from tidewell.plans import medallion
from tidewell.sources import quotes, tables
from tidewell.sources.published import PublishedTable
from tidewell.streaming import ingest


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def quote_root(tmp_path):
    header = "Date,Close,High,Low,Open,Volume\n"
    write(tmp_path / "raw" / "Dow  Jones" / "a_05_06_2025.csv", header + ",^DJI,^DJI,^DJI,^DJI,^DJI\n2025-06-04,\"42,427.5\",2,1,1.5,10\n")
    write(tmp_path / "raw" / "Dow  Jones" / "a_06_06_2025.csv", header + ",^DJI,^DJI,^DJI,^DJI,^DJI\n2025-06-04,42430,2,1,1.5,10\n2025-06-05,n/a,2,1,1.5,10\n")
    write(tmp_path / "raw" / "Gold" / "only_ticker.csv", header + ",GC=F,GC=F,GC=F,GC=F,GC=F\n")
    write(tmp_path / "raw" / "Gold" / "notes.txt", "no quotes here\n")
    (tmp_path / "raw" / "Empty").mkdir()
    return str(tmp_path / "raw")


def test_quote_files_to_silver(spark, quote_root):
    scan = quotes.read_quote_files(spark, quote_root)
    assert {r["series"] for r in scan.select("series").collect()} == {"dow_jones", "gold"}
    rows = quotes.split_ticker_rows(scan, "Date", "Price", ["file"])
    assert {r["ticker"] for r in rows.collect()} == {"^DJI"}
    typed = clean.typed_quotes(rows, ["series", "file"])
    silver = clean.latest_per_key(typed, ["series", "date"], "file").orderBy("date").collect()
    assert [(r["series"], r["date"], r["price"]) for r in silver] == [
        ("dow_jones", date(2025, 6, 4), 42430.0),
        ("dow_jones", date(2025, 6, 5), None),
    ]


def test_other_layout_is_an_error(spark, quote_root, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        quotes.read_quote_files(spark, quote_root, quotes.HISTORY_LAYOUT).collect()
    write(tmp_path / "future" / "SrVAR" / "macro_future_01_06_2025.csv", "oil,gold,date\n1.0,2.0,2025-06-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        quotes.read_forecast_files(spark, str(tmp_path / "future"), ["gold", "oil"]).collect()
    got = quotes.read_forecast_files(spark, str(tmp_path / "future"), ["oil", "gold"]).select("gold", "kind", "model", "table").first()
    assert tuple(got) == (2.0, "future", "srvar", "macro")


def test_missing_root(spark, tmp_path):
    assert quotes.read_quote_files(spark, str(tmp_path / "nowhere")) is None


def test_name_clash_is_an_error(spark):
    with pytest.raises(ValueError):
        scalars.clean_columns(spark.createDataFrame([(1, 2)], "`Vol.` int, `Vol` int"))


def test_strict_union(spark):
    vendor = spark.createDataFrame([("d", "1")], "date string, close string")
    history = spark.createDataFrame([("e", "2")], "date string, price string")
    with pytest.raises(AnalysisException):
        quotes.union_layouts([vendor, history])
    both = quotes.merge_price_columns(quotes.union_layouts([vendor, history], strict=False), ["price", "close"])
    assert sorted((r["date"], r["price"]) for r in both.collect()) == [("d", "1"), ("e", "2")]


def test_bad_text_is_null(spark):
    rows = spark.createDataFrame([("13/45/2020", "1,234.5 "), ("06/05/2025", "abc"), ("2025-06-05", None)], "d string, p string")
    got = rows.select(scalars.parse_day(F.col("d")).alias("d"), scalars.parse_number(F.col("p")).alias("p")).collect()
    assert [(r["d"], r["p"]) for r in got] == [(None, 1234.5), (date(2025, 6, 5), None), (date(2025, 6, 5), None)]


def test_copy_refuses_existing_table(spark, tmp_path):
    tables.create_namespace(spark, "copy_test", f"file:{tmp_path}/ns")
    rows = spark.createDataFrame([(1,)], "a int")
    tables.copy_table(rows, "copy_test.t")
    with pytest.raises(AnalysisException):
        tables.copy_table(rows, "copy_test.t")
    assert [r["table_name"] for r in tables.list_tables(spark, "copy_test").collect()] == ["t"]


def prices(spark, pairs):
    return spark.createDataFrame([(date(2024, m, d), float(p)) for m, d, p in pairs], "date date, price double")


STORED = [(1, 1, 1), (1, 2, 2), (1, 3, 3), (1, 4, 4)]
BATCH = [(1, 2, 20), (1, 4, 40), (1, 5, 50)]


def test_range_replace_drops_days_the_batch_lacks(spark):
    got = upsert.range_replace(prices(spark, STORED), prices(spark, BATCH))
    assert sorted((r["date"].day, r["price"]) for r in got.collect()) == [(1, 1.0), (2, 20.0), (4, 40.0), (5, 50.0)]


def test_merge_keeps_them(spark):
    got = upsert.merge(prices(spark, STORED), prices(spark, BATCH), ["date"])
    assert sorted((r["date"].day, r["price"]) for r in got.collect()) == [(1, 1.0), (2, 20.0), (3, 3.0), (4, 40.0), (5, 50.0)]


def test_repeated_stored_keys_do_not_multiply_updates(spark):
    stored = prices(spark, STORED + STORED)
    assert upsert.updates(stored, prices(spark, BATCH), ["date"]).count() == 2
    assert upsert.inserts(stored, prices(spark, BATCH), ["date"]).count() == 1


def test_empty_batch_changes_nothing(spark):
    got = upsert.range_replace(prices(spark, STORED), prices(spark, STORED).limit(0))
    assert got.count() == 4


def stored_rows(spark, path):
    return sorted((r["date"].month, r["date"].day, r["price"]) for r in upsert.read(spark, path).collect())


def test_publish_removes_emptied_partition(spark, tmp_path):
    path = f"file:{tmp_path}/silver"
    upsert.publish(prices(spark, [(1, 30, 1), (2, 10, 2), (3, 1, 3), (5, 1, 5)]), path, ["date"])
    upsert.publish(prices(spark, [(1, 31, 10), (3, 2, 30)]), path, ["date"], "range_replace")
    assert stored_rows(spark, path) == [(1, 30, 1.0), (1, 31, 10.0), (3, 2, 30.0), (5, 1, 5.0)]
    upsert.publish(prices(spark, [(3, 2, 31), (4, 1, 4)]), path, ["date"], "upsert")
    assert stored_rows(spark, path) == [(1, 30, 1.0), (1, 31, 10.0), (3, 2, 31.0), (4, 1, 4.0), (5, 1, 5.0)]
    with pytest.raises(ValueError):
        upsert.publish(prices(spark, BATCH), path, ["date"], "append")


UNDATED = "series string, date date, price double"


@pytest.mark.parametrize("mode", upsert.MODES)
def test_publish_keeps_undated_rows(spark, tmp_path, mode):
    path = f"file:{tmp_path}/silver"
    first, day = [("a", None, 1.0), ("b", None, 2.0)], date(2024, 1, 1)
    upsert.publish(spark.createDataFrame([*first, ("a", day, 3.0)], UNDATED), path, ["series", "date"], mode)
    batch = spark.createDataFrame([("c", None, 4.0), ("d", None, 5.0), ("a", day, 6.0)], UNDATED)
    for _ in range(2):  # a repeated batch changes nothing
        upsert.publish(batch, path, ["series", "date"], mode)
    upsert.publish(spark.createDataFrame([("b", None, 7.0), (None, None, 8.0)], UNDATED), path, ["series", "date"], mode)
    got = {(r["series"], r["date"], r["price"]) for r in upsert.read(spark, path).collect()}
    want = {("a", None, 1.0), ("b", None, 7.0), ("c", None, 4.0), ("d", None, 5.0), (None, None, 8.0), ("a", day, 6.0)}
    assert got == want and upsert.read(spark, path).count() == len(want)


def test_publish_only_undated_rows(spark, tmp_path):
    path = f"file:{tmp_path}/silver"
    for price in (1.0, 2.0):
        upsert.publish(spark.createDataFrame([("a", None, price)], UNDATED), path, ["series", "date"])
    assert [tuple(r)[:3] for r in upsert.read(spark, path).select("series", "date", "price").collect()] == [("a", None, 2.0)]


def folders(tmp_path, name="silver"):
    return sorted(str(f.relative_to(tmp_path)) for f in (tmp_path / name / "rows").glob("*/_year=*/_month=*"))


def test_publish_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = f"file:{tmp_path}/silver"
    upsert.publish(prices(spark, STORED), path, ["date"])
    before, reader = stored_rows(spark, path), upsert.read(spark, path)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(PublishedTable, "flip", fails)
        with pytest.raises(RuntimeError, match="lost"):
            upsert.publish(prices(spark, [(1, 2, 20), (2, 4, 40)]), path, ["date"])
    assert stored_rows(spark, path) == before and len(folders(tmp_path)) == 3  # the failed one is not named by a list
    upsert.publish(prices(spark, [(1, 2, 20), (2, 4, 40)]), path, ["date"], "upsert")
    assert stored_rows(spark, path) == [(1, 1, 1.0), (1, 2, 20.0), (1, 3, 3.0), (1, 4, 4.0), (2, 4, 40.0)]
    assert reader.count() == 4  # who read the list before still finds its folders
    assert len(folders(tmp_path)) == 3  # January twice, February once; what the failure left is gone
    upsert.publish(prices(spark, [(2, 4, 41)]), path, ["date"], "upsert")
    assert len(folders(tmp_path)) == 3  # January once, February twice


def test_versions_know_their_parents(spark, tmp_path):
    table = versions.VersionedTable(spark, f"file:{tmp_path}/accounts")
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "account int, balance int")
    first = table.commit(rows((1, 10), (2, 20)), "one")
    second = table.commit(rows((1, 11), (2, 20)), "two")
    table.rollback(first)
    table.mark("checked")
    third = table.commit(rows((2, 20), (3, 30)), "three")
    assert len({first, second, third}) == 3
    line = {r["depth"]: r["snapshot_id"] for r in versions.ancestors(table.log(), third).collect()}
    assert line == {0: third, 1: first}  # the second was rolled back and is no ancestor
    assert table.resolve("HEAD") == third and table.resolve("HEAD~1") == table.resolve(f"{second}~1") == first
    for missing in ("HEAD~2", "s1", f"{first}~1"):
        with pytest.raises(LookupError):
            table.resolve(missing)
    changes = lambda *name: {(r["account"], r["change"]) for r in table.diff_parent(["account"], *name).collect()}
    assert changes() == {(1, "removed"), (3, "added")} and changes(second) == {(1, "changed")}
    assert [r["n_rows"] for r in table.log().where("op = 'commit'").orderBy("seq").collect()] == [2, 2, 2]


def test_rejected_rows_are_kept_with_their_reason(spark):
    rows = [("2024-01-01", "1"), (None, "2"), ("x", "3"), ("2024-01-02", "n/a"), ("2024-01-03", None), (" ", "4")]
    raw = spark.createDataFrame(rows, "Date string, Price string")
    found = medallion.sort_quotes(raw)
    assert sorted((r["Price"], r["reason"]) for r in found.rejected.collect()) == [("2", "no date"), ("3", "unread date"), ("4", "no date"), ("n/a", "unread price")]
    assert found.counts == {"read": 6, "kept": 2, "no date": 2, "unread date": 1, "unread price": 1}
    assert found.kept.count() == 2 and found.kept.columns == raw.columns
    assert medallion.sort_quotes(raw.limit(0)).counts["read"] == 0


def test_only_a_code_makes_a_ticker_line(spark):
    lines = [(None, "GC=F", "f"), ("2024-01-01", "1", "f"), (None, "7", "f"), (None, None, "f"), ("", "12.5", "g")]
    got = quotes.split_ticker_rows(spark.createDataFrame(lines, "Date string, Price string, file string"), "Date", "Price", ["file"])
    assert sorted((r["file"], r["Price"] or "", r["ticker"]) for r in got.collect()) == [("f", "", "GC=F"), ("f", "1", "GC=F"), ("f", "7", "GC=F"), ("g", "12.5", None)]


def test_rows_that_a_wide_table_leaves_out(spark):
    rows = [("a", date(2024, 1, d)) for d in (1, 2, 5)] + [("b", date(2024, 1, d)) for d in (4, 5)] + [("z", date(2024, 1, 9)), (None, date(2024, 1, 1)), ("b", None)]
    got = gold.left_out(spark.createDataFrame(rows, "series string, date date"), {"a": "a", "b": "b"})
    assert {(r["series"], r["reason"], r["n_rows"]) for r in got.collect()} == {("a", "early", 2), ("z", "unlisted", 1), (None, "unlisted", 1), ("b", "undated", 1)}


def test_one_of_two_publishes_fails(spark, tmp_path):
    table = PublishedTable(spark, f"file:{tmp_path}/silver")
    upsert.publish(prices(spark, STORED), table.path, ["date"])
    state = table.state()
    upsert.publish(prices(spark, BATCH), table.path, ["date"])
    with pytest.raises(RuntimeError, match="another publish"):
        table.flip(state)
    assert len(stored_rows(spark, table.path)) == 4
    with pytest.raises(FileNotFoundError):
        upsert.read(spark, f"file:{tmp_path}/nowhere")


def test_publish_keeps_the_columns_of_the_table(spark, tmp_path):
    path = f"file:{tmp_path}/silver"
    upsert.publish(prices(spark, STORED), path, ["date"])
    upsert.publish(spark.createDataFrame([(7, date(2024, 1, 2), "x")], "price int, date date, note string"), path, ["date"], "upsert")
    got = upsert.read(spark, path)
    assert got.columns == ["date", "price", "year", "month"] and dict(got.dtypes)["price"] == "double"
    assert stored_rows(spark, path)[1] == (1, 2, 7.0)


def test_publish_of_nothing(spark, tmp_path):
    path = f"file:{tmp_path}/silver"
    upsert.publish(prices(spark, STORED).limit(0), path, ["date"])
    assert upsert.read(spark, path).count() == 0
    upsert.publish(prices(spark, STORED), path, ["date"])
    upsert.publish(prices(spark, STORED).limit(0), path, ["date"])
    assert len(stored_rows(spark, path)) == 4


def test_row_csv_digits(spark, tmp_path):
    path = f"file:{tmp_path}/out"
    tables.write_csv(prices(spark, [(1, 1, 1.23456789)]), path, digits=5)
    assert spark.read.option("header", True).csv(path).first()["price"] == "1.23457"


def test_preview_of_one_row_is_transposed(spark):
    got = semantic.preview(spark, "SELECT 1 AS a, 'x' AS b, CAST(NULL AS INT) AS c", 1, name="kept")
    assert [tuple(r) for r in got.collect()] == [("a", "1"), ("b", "x"), ("c", None)]
    assert spark.table("kept").count() == 1


def test_gold_cubes():
    cubes = semantic.gold_cubes()
    assert len(cubes) == 12
    assert "oil_varnn" in cubes["macro_future"].dimensions
    assert set(cubes["indices_eval"].dimensions) == {"id", "variable", *(f"{m}_{s}" for m in ("mse", "rmse", "mae") for s in ("srvar", "var"))}
    with pytest.raises(ValueError):
        semantic.cube_query(None, cubes["macro"], ["nasdaq100"])


def test_versions(spark, tmp_path):
    table = versions.VersionedTable(spark, f"file:{tmp_path}/t")
    with pytest.raises(LookupError):
        table.read()
    first = table.commit(prices(spark, STORED), "one", datetime(2025, 1, 1))
    table.guarded(lambda: table.commit(prices(spark, BATCH), "two", datetime(2025, 1, 2)), "load")
    assert table.read().count() == 3

    def failing():
        table.commit(prices(spark, STORED + BATCH), "three")
        raise RuntimeError("bad rows")

    with pytest.raises(RuntimeError):
        table.guarded(failing, "load")
    assert table.read().count() == 3
    assert table.read(first).count() == 4
    assert table.read_as_of(datetime(2025, 1, 1, 5)).count() == 4
    messages = [r["message"] for r in versions.commit_log(table.log().where("op <> 'commit'"), 10).collect()]
    assert sorted(messages) == ["load", "load", "load: rolled back", "load_COMPLETED"]


def test_commit_details(spark):
    rows = [("a", f"op{i}") for i in range(7)] + [("b", "x"), ("b", "x")]
    got = {r["who"]: r for r in versions.commit_details(spark.createDataFrame(rows, "who string, op string"), "who", "op").collect()}
    assert (got["a"]["n_ops"], got["a"]["first_ops"], got["a"]["n_more"]) == (7, [f"op{i}" for i in range(5)], 2)
    assert (got["b"]["n_ops"], got["b"]["first_ops"], got["b"]["n_more"]) == (2, ["x", "x"], 0)


def test_snapshot_diff_sees_null_changes(spark):
    before = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0)], "k int, v double")
    after = spark.createDataFrame([(1, 4.0), (2, 5.0), (4, None)], "k int, v double")
    got = {r["k"]: r["change"] for r in versions.snapshot_diff(before, after, ["k"]).collect()}
    assert got == {1: "changed", 3: "removed", 4: "added"}


QUOTE_SCHEMA = "series string, date date, price double, arrival bigint"


def quote_file(spark, root, name, rows):
    frame = spark.createDataFrame([(s, date(2024, m, d), float(p), a) for s, m, d, p, a in rows], QUOTE_SCHEMA)
    tables.write_csv(frame, f"{root}/{name}")


def run_upsert(spark, root, target, state):
    stream = ingest.quote_stream(spark, root, spark.createDataFrame([], QUOTE_SCHEMA).schema)
    ingest.upsert_available(stream, target, state, ["series", "date"], "arrival").awaitTermination()
    return sorted((r["series"], r["date"].month, r["date"].day, r["price"]) for r in upsert.read(spark, target, ["series", "date"], "arrival").collect())


def test_stream_upsert_in_several_runs(spark, tmp_path):
    root, target, state = (f"file:{tmp_path}/{n}" for n in ("in", "out", "state"))
    quote_file(spark, root, "one", [("a", 1, 1, 1, 1), ("a", 1, 2, 2, 2), ("b", 2, 1, 3, 3)])
    assert len(run_upsert(spark, root, target, state)) == 3
    quote_file(spark, root, "two", [("a", 1, 2, 20, 9), ("a", 3, 1, 4, 5), ("b", 2, 1, 0, 1)])
    want = [("a", 1, 1, 1.0), ("a", 1, 2, 20.0), ("a", 3, 1, 4.0), ("b", 2, 1, 3.0)]
    assert run_upsert(spark, root, target, state) == want
    assert run_upsert(spark, root, target, state) == want
    assert run_upsert(spark, root, target, f"file:{tmp_path}/fresh-state") == want


def test_stream_upsert_costs_its_batch_and_compacts_between_runs(spark, tmp_path, monkeypatch):
    root, target, state = (f"file:{tmp_path}/{n}" for n in ("in", "out", "state"))
    want = {}
    for i in range(4):
        rows = [("a", 1 + (i + d) % 3, d, 10 * i + d, (i * 7) % 5) for d in range(1, 9)]
        quote_file(spark, root, f"f{i}", rows)
        for series, month, day, price, arrival in rows:
            want[series, month, day] = max(want.get((series, month, day), (-1, 0)), (arrival, price))
    want = sorted((*k, float(v[1])) for k, v in want.items())
    schema = spark.createDataFrame([], QUOTE_SCHEMA).schema
    keys, order = ["series", "date"], "arrival"

    def run():
        stream = ingest.quote_stream(spark, root, schema, bytes_per_batch=1)
        ingest.upsert_available(stream, target, state, keys, order).awaitTermination()
        got = sorted((r["series"], r["date"].month, r["date"].day, r["price"]) for r in upsert.read(spark, target, keys, order).collect())
        return got, PublishedTable(spark, target).state()

    got, table = run()
    writes = len(list((tmp_path / "out" / "rows").iterdir()))
    assert got == want and not table.months and len(table.added) == writes >= 4  # nothing stored is written again
    with pytest.raises(ValueError, match="newest row"):
        upsert.read(spark, target)
    monkeypatch.setattr(ingest, "COMPACT_AFTER", 2)
    quote_file(spark, root, "late", [("a", 1, 1, 99, 99), ("a", 7, 1, 5, 0)])
    got, table = run()
    want = sorted([w for w in want if w[:3] != ("a", 1, 1)] + [("a", 1, 1, 99.0), ("a", 7, 1, 5.0)])
    assert got == want and len(table.months) == 3 and {m for _, months in table.added for m in months} == {(2024, 1), (2024, 7)}
    assert upsert.read(spark, target, keys, order).where("month = 2").count() == sum(w[1] == 2 for w in want)


def test_stream_dedupe_over_runs(spark, tmp_path):
    root, target, state = (f"file:{tmp_path}/{n}" for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], QUOTE_SCHEMA).schema

    def run():
        stream = ingest.quote_stream(spark, root, schema).withColumn("ts", F.col("date").cast("timestamp"))
        unique = ingest.first_within(stream, ["series", "date"], "ts", "7 days")
        ingest.append_available(unique, target, state).awaitTermination()
        return sorted((r["series"], r["date"].day) for r in spark.read.schema(unique.schema).parquet(target).collect())

    quote_file(spark, root, "one", [("a", 1, 5, 1, 1), ("a", 1, 6, 1, 2)])
    assert run() == [("a", 5), ("a", 6)]
    quote_file(spark, root, "two", [("a", 1, 6, 1, 3), ("a", 1, 9, 1, 4)])
    assert run() == [("a", 5), ("a", 6), ("a", 9)]


def test_stream_dedupe_of_small_batches_in_any_order(spark, tmp_path):
    schema = spark.createDataFrame([], QUOTE_SCHEMA).schema
    root = f"file:{tmp_path}/in"
    for i, month in enumerate((9, 1, 5, 12, 1, 9)):
        quote_file(spark, root, f"f{i}", [("a", month, d, d, i) for d in range(1, 6 + i)])

    def run(name, size):
        unique = ingest.first_of_each(ingest.quote_stream(spark, root, schema, size).select("series", "date"), ["series", "date"])
        target = f"file:{tmp_path}/{name}"
        ingest.append_available(unique, target, f"{target}-state").awaitTermination()
        return sorted((r["series"], r["date"]) for r in spark.read.schema(unique.schema).parquet(target).collect())

    batch = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(root)
    want = sorted((r["series"], r["date"]) for r in batch.select("series", "date").distinct().collect())
    assert run("small", 1) == run("large", 1 << 30) == want


def test_late_rows_are_an_output(spark, tmp_path):
    """Kept and late rows add up to the input, in any order of micro-batches; a key is known until its span is over."""
    schema = "series string, date date, price double"
    days = [1, 20, 2, 19, 20, 3, 28, 26, 20]  # one row a file, in this order; 7 days are allowed
    root, target = tmp_path / "in", f"file:{tmp_path}/out"
    for i, day in enumerate(days):
        write(root / f"{i}.csv", f"series,date,price\na,2024-01-{day:02d},{i}\n,2024-01-{day:02d},{i}\n")
        os.utime(root / f"{i}.csv", (1_600_000_000 + 100 * i,) * 2)
    stream = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", 1).csv(str(root))
    marked = ingest.first_or_late(stream, ["series", "date"], "date", "7 days")
    ingest.append_available(marked, target, f"file:{tmp_path}/state").awaitTermination()
    rows = spark.read.schema(marked.schema).parquet(target).collect()
    assert len(rows) == 2 * len(days)
    for series in ("a", None):
        got = {int(r["price"]): r["verdict"] for r in rows if r["series"] == series}
        assert got == {0: "first", 1: "first", 2: "late", 3: "first", 4: "repeat", 5: "late", 6: "first", 7: "first", 8: "late"}


def test_stream_equals_batch(spark, tmp_path):
    root, target = f"file:{tmp_path}/in", f"file:{tmp_path}/out"
    for i in range(3):
        quote_file(spark, root, f"f{i}", [("a", 1, d, d * i, i) for d in range(1, 20)])
    schema = spark.createDataFrame([], QUOTE_SCHEMA).schema
    stream = ingest.quote_stream(spark, root, schema, bytes_per_batch=200)
    ingest.append_available(stream, target, f"file:{tmp_path}/state").awaitTermination()
    batch = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(root)
    assert spark.read.schema(schema).parquet(target).exceptAll(batch).isEmpty()
    assert batch.count() == spark.read.schema(schema).parquet(target).count() == 57
