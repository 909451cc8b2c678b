"""Snapshots of a table with an audit log, diffs between them, savepoint and rollback."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.sources.tables import path_exists

AUDIT_SCHEMA = (
    "seq bigint, snapshot_id string, branch string, message string, author string, ts timestamp, n_rows bigint, op string,"
    " parent string"
)


def commit_log(audit: DataFrame, limit: int = 20) -> DataFrame:
    """Newest commits first."""
    return audit.orderBy(F.col("ts").desc(), F.col("snapshot_id").desc()).limit(limit)


def commit_details(audit: DataFrame, by: str, op: str, shown: int = 5) -> DataFrame:
    """Per group: number of operations, the first ``shown`` in order and how many more there are.

    The rank filter is applied on the map side too, so at most ``shown`` rows per group and task are shuffled.
    """
    ranked = audit.select(by, op).withColumn("_rank", F.row_number().over(Window.partitionBy(by).orderBy(op)))
    first = ranked.where(F.col("_rank") <= shown).groupBy(by).agg(F.sort_array(F.collect_list(op)).alias("first_ops"))
    totals = audit.groupBy(by).agg(F.count("*").alias("n_ops"))
    return totals.join(first, by).select(
        by, "n_ops", "first_ops", F.greatest(F.col("n_ops") - shown, F.lit(0)).cast("bigint").alias("n_more")
    )


def branch_heads(audit: DataFrame) -> DataFrame:
    return audit.groupBy("branch").agg(F.max_by("snapshot_id", F.struct("ts", "snapshot_id")).alias("head"))


def ancestors(audit: DataFrame, snapshot_id: str, most: int | None = None) -> DataFrame:
    """(snapshot_id, parent, depth): a version, its parent, and so on, up to ``most`` steps or the first version.

    A version's parent is that of its commit; every step is a join with the log, which is as long as the history.
    """
    commits = audit.where((F.col("op") == "commit") & F.col("snapshot_id").isNotNull()).select("snapshot_id", "parent")
    steps = most if most is not None else commits.count()
    return audit.sparkSession.sql(
        f"""
        WITH RECURSIVE line (snapshot_id, parent, depth) MAX RECURSION LEVEL {steps + 2} AS (
            SELECT snapshot_id, parent, 0 FROM {{commits}} WHERE snapshot_id = :start
            UNION ALL
            SELECT c.snapshot_id, c.parent, depth + 1 FROM line JOIN {{commits}} c ON c.snapshot_id = line.parent WHERE depth < {steps}
        ) SELECT * FROM line""",
        args={"start": snapshot_id},
        commits=commits,
    )


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed between two versions."""
    value = [c for c in before.columns if c not in keys]
    sides = [df.select(*keys, F.struct(*value).alias(n)) for df, n in ((before, "_before"), (after, "_after"))]
    change = (
        F.when(F.col("_before").isNull(), "added")
        .when(F.col("_after").isNull(), "removed")
        .when(~F.col("_before").eqNullSafe(F.col("_after")), "changed")
    )
    both = sides[0].join(sides[1], list(keys), "full_outer").select(*keys, change.alias("change"))
    return both.where(F.col("change").isNotNull())


def diff_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of one version that the other lacks, counting duplicates, from one aggregate over both."""
    signed = before.withColumn("_n", F.lit(-1)).unionByName(after.withColumn("_n", F.lit(1)))
    surplus = signed.groupBy(*before.columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    copies = F.explode(F.array_repeat(F.when(F.col("_n") > 0, "after").otherwise("before"), F.abs("_n").cast("int")))
    return surplus.select(*before.columns, copies.alias("side"))


class VersionedTable:
    """A table whose every version is a folder of its own, and whose head is the last row of an audit log.

    A version is written first and named in the log last, so a failed job leaves the head where it was.
    """

    def __init__(self, spark: SparkSession, root: str, branch: str = "main", author: str = "job"):
        self.spark, self.root, self.branch, self.author = spark, root, branch, author

    def log(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/audit"):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(f"{self.root}/audit")

    def _last(self) -> tuple[int, str | None]:
        row = self.log().agg(F.max("seq"), F.max_by("snapshot_id", F.when(F.col("branch") == self.branch, F.col("seq")))).first()
        return (row[0] or 0, row[1])

    def head(self) -> str | None:
        return self._last()[1]

    def _record(
        self, snapshot_id: str | None, message: str, op: str, n_rows: int | None, ts: datetime | None, parent: str | None = None
    ) -> None:
        when = ts or datetime.now(timezone.utc)
        entry = (self._last()[0] + 1, snapshot_id, self.branch, message, self.author, when, n_rows, op, parent)
        self.spark.createDataFrame([entry], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/audit")

    def commit(self, df: DataFrame, message: str, ts: datetime | None = None) -> str:
        """Write ``df`` as a new version, whose parent is the head, and make it the head.

        No two writers share a folder, and rows are counted as they are written.
        """
        last, parent = self._last()
        snapshot_id = f"s{last + 1:09d}-{uuid.uuid4().hex[:8]}"
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("n_rows")).write.parquet(f"{self.root}/data/{snapshot_id}")
        self._record(snapshot_id, message, "commit", counted.get["n_rows"], ts, parent)
        return snapshot_id

    def resolve(self, name: str) -> str:
        """The version that ``id``, ``id~n`` or ``HEAD~n`` names: n steps to the parent."""
        start, _, steps = name.partition("~")
        start = (self.head() or "") if start == "HEAD" else start
        row = ancestors(self.log(), start, int(steps or 0)).where(F.col("depth") == int(steps or 0)).first()
        if row is None:
            raise LookupError(f"{self.root} has no version {name}")
        return row["snapshot_id"]

    def diff_parent(self, keys: Sequence[str], name: str = "HEAD") -> DataFrame:
        """Keys that a version added, removed or changed against its parent."""
        mine = self.resolve(name)
        return snapshot_diff(self.read(self.resolve(f"{mine}~1")), self.read(mine), keys)

    def mark(self, message: str, ts: datetime | None = None) -> None:
        """A log entry without a new version."""
        self._record(self.head(), message, "mark", None, ts)

    def rollback(self, snapshot_id: str | None, message: str = "rollback", ts: datetime | None = None) -> None:
        self._record(snapshot_id, message, "rollback", None, ts)

    def read(self, snapshot_id: str | None = None) -> DataFrame:
        chosen = snapshot_id or self.head()
        if chosen is None:
            raise LookupError(f"{self.root} has no version")
        return self.spark.read.parquet(f"{self.root}/data/{chosen}")

    def read_as_of(self, ts: datetime) -> DataFrame:
        """The version that was the head at ``ts``."""
        known = self.log().where((F.col("ts") <= F.lit(ts)) & (F.col("branch") == self.branch))
        row = known.agg(F.max_by("snapshot_id", "seq")).first()
        if row[0] is None:
            raise LookupError(f"{self.root} has no version at {ts}")
        return self.read(row[0])

    def guarded(self, job: Callable[[], None], name: str) -> None:
        """Run a job between a savepoint and an end marker; on failure go back to the savepoint and raise."""
        saved = self.head()
        self.mark(name)
        try:
            job()
        except Exception:
            self.rollback(saved, f"{name}: rolled back")
            raise
        self.mark(f"{name}_COMPLETED")
