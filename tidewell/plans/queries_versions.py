"""Queries over snapshots and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidewell.functions import scalars
from tidewell.operators import upsert, versions
from tidewell.plans.checks import check_sql
from tidewell.plans.registry import query
from tidewell.session import scratch
from tidewell.sources import fixtures, tables
from tidewell.streaming import ingest


@query(
    "commit_log",
    check_sql("SELECT snapshot_id, branch, author, ts, op FROM audit ORDER BY ts DESC, snapshot_id DESC LIMIT 20", "audit"),
)
def commit_log(spark, sf_dir):
    return versions.commit_log(fixtures.audit(spark, sf_dir), 20)


@query(
    "commit_detail",
    check_sql(
        "SELECT author, count(*) AS n_ops, array_to_string((list(op ORDER BY op))[1:5], '|') AS first_ops,"
        " greatest(count(*) - 5, 0)::BIGINT AS n_more FROM audit GROUP BY author",
        "audit",
    ),
)
def commit_detail(spark, sf_dir):
    detail = versions.commit_details(fixtures.audit(spark, sf_dir), "author", "op")
    return detail.withColumn("first_ops", F.array_join("first_ops", "|"))


_DIFF = check_sql(
    "SELECT account, CASE WHEN a.account IS NULL THEN 'added' WHEN b.account IS NULL THEN 'removed' ELSE 'changed' END AS"
    " change FROM snap_a a FULL JOIN snap_b b USING (account) WHERE a.account IS NULL OR b.account IS NULL"
    " OR (a.name, a.balance) IS DISTINCT FROM (b.name, b.balance)",
    "snap_a",
    "snap_b",
)


@query("snapshot_diff", _DIFF)
def snapshot_diff(spark, sf_dir):
    return versions.snapshot_diff(fixtures.snap_a(spark, sf_dir), fixtures.snap_b(spark, sf_dir), ["account"])


@query("diff_parent", _DIFF)
def diff_parent(spark, sf_dir):
    """The head against its parent, which the log knows, after a rollback and a marker."""
    accounts = versions.VersionedTable(spark, scratch(spark, "accounts"))
    first = accounts.commit(fixtures.snap_a(spark, sf_dir), "first load")
    accounts.commit(fixtures.snap_b(spark, sf_dir).limit(0), "broken load")
    accounts.rollback(first)
    accounts.mark("checked")
    accounts.commit(fixtures.snap_b(spark, sf_dir), "second load")
    return accounts.diff_parent(["account"])


@query(
    "diff_except",
    check_sql(
        "(SELECT *, 'before' AS side FROM (SELECT * FROM snap_a EXCEPT ALL SELECT * FROM snap_b))"
        " UNION ALL (SELECT *, 'after' AS side FROM (SELECT * FROM snap_b EXCEPT ALL SELECT * FROM snap_a))",
        "snap_a",
        "snap_b",
    ),
)
def diff_except(spark, sf_dir):
    return versions.diff_rows(fixtures.snap_a(spark, sf_dir), fixtures.snap_b(spark, sf_dir))


@query(
    "branch_heads",
    check_sql("SELECT branch, arg_max(snapshot_id, (ts, snapshot_id)) AS head FROM audit GROUP BY branch", "audit"),
)
def branch_heads(spark, sf_dir):
    return versions.branch_heads(fixtures.audit(spark, sf_dir))


@query("rollback_state", check_sql("SELECT * FROM snap_a", "snap_a"))
def rollback_state(spark, sf_dir):
    """A job writes a new version and then fails, so the head goes back to the savepoint."""
    accounts = versions.VersionedTable(spark, scratch(spark, "accounts"))
    accounts.commit(fixtures.snap_a(spark, sf_dir), "first load")

    def job() -> None:
        accounts.commit(fixtures.snap_b(spark, sf_dir), "second load")
        raise RuntimeError("quality check failed")

    try:
        accounts.guarded(job, "nightly load")
    except RuntimeError:
        pass
    return accounts.read()


@query("as_of_read", check_sql("SELECT * FROM snap_a UNION ALL SELECT * FROM snap_b", "snap_a", "snap_b"))
def as_of_read(spark, sf_dir):
    """The version of each of two days, both read after the second was written."""
    accounts = versions.VersionedTable(spark, scratch(spark, "accounts"))
    accounts.commit(fixtures.snap_a(spark, sf_dir), "first load", datetime(2025, 6, 5))
    accounts.commit(fixtures.snap_b(spark, sf_dir), "second load", datetime(2025, 6, 6))
    return accounts.read_as_of(datetime(2025, 6, 5, 12)).unionByName(accounts.read_as_of(datetime(2025, 6, 6, 12)))


STREAM_SCHEMA = "d string, p string, arrival bigint, status string"


def _quote_stream(spark, rows, micro_batches=1):
    root = tables.round_trip(rows, "quote-files", by=["series"])
    schema = spark.createDataFrame([], STREAM_SCHEMA).schema
    stream = ingest.quote_stream(spark, root, schema, bytes_per_batch=tables.folder_bytes(spark, root) // micro_batches + 1)
    folder = scalars.series_from_path(scalars.decoded_path(F.col("_metadata.file_path")))
    return stream.select(
        F.substring_index(folder, "=", -1).alias("series"),
        scalars.parse_day(F.col("d")).alias("date"),
        scalars.parse_number(F.col("p")).alias("price"),
        "arrival",
    )


@query("stream_ingest", check_sql("SELECT series, date, price, arrival FROM quotes", "quotes"))
def stream_ingest(spark, sf_dir):
    stream = _quote_stream(spark, fixtures.quotes_raw(spark, sf_dir))
    target = scratch(spark, "stream-out")
    ingest.append_available(stream, target, scratch(spark, "stream-state")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


@query("stream_dedupe", check_sql("SELECT DISTINCT series, date FROM quotes", "quotes"))
def stream_dedupe(spark, sf_dir):
    """The files are in no order of time and arrive in several micro-batches, over which keys repeat."""
    stream = _quote_stream(spark, fixtures.quotes_dirty(spark, sf_dir), micro_batches=6)
    unique = ingest.first_of_each(stream.select("series", "date"), ["series", "date"])
    target = scratch(spark, "stream-out")
    ingest.append_available(unique, target, scratch(spark, "stream-state")).awaitTermination()
    return spark.read.schema(unique.schema).parquet(target)


@query(
    "stream_upsert",
    check_sql(
        "SELECT series, date, arg_max(price, arrival) AS price, max(arrival) AS arrival FROM quotes GROUP BY series, date",
        "quotes",
    ),
)
def stream_upsert(spark, sf_dir):
    """Several micro-batches, over which keys repeat."""
    stream = _quote_stream(spark, fixtures.quotes_raw(spark, sf_dir), micro_batches=5)
    target = scratch(spark, "stream-out")
    query = ingest.upsert_available(stream, target, scratch(spark, "stream-state"), ["series", "date"], "arrival")
    query.awaitTermination()
    return upsert.read(spark, target, ["series", "date"], "arrival").select(*stream.columns)
