"""Tables whose months are replaced all at once: new folders first, then one small list that names them.

A table is a folder with ``rows/<write>/_year=2024/_month=3``, ``rows/<write>`` for batches that a stream adds, and numbered lists. A list
names the folder of every month and the added batches with their months; readers take the highest list, so they see a publish whole or
not at all. A list is written under another name and renamed, and a number that is taken already is an error, so of two writers
one fails. Months that an added batch touches are read as the newest row per key of the month and the batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators import clean
from tidewell.sources.tables import NULL_FOLDER, file_system

Month = tuple[int | None, int | None]


@dataclass
class State:
    """What a list says: its number, the table's schema, the folder of each month, and (folder, months) of added batches, oldest first."""

    version: int = 0
    schema: StructType | None = None
    months: dict[Month, str] = field(default_factory=dict)
    added: list[tuple[str, list[Month]]] = field(default_factory=list)

    def folders(self) -> set[str]:
        return {*self.months.values(), *(folder for folder, _ in self.added)}

    def text(self) -> str:
        order = sorted(self.months.items(), key=lambda item: (item[0][0] is not None, item[0]))
        months = [[y, m, folder] for (y, m), folder in order]
        return json.dumps({"schema": json.loads(self.schema.json()), "months": months, "added": self.added})

    @staticmethod
    def of(version: int, text: str) -> State:
        found = json.loads(text)
        added = [(folder, [tuple(m) for m in months]) for folder, months in found["added"]]
        return State(version, StructType.fromJson(found["schema"]), {(y, m): folder for y, m, folder in found["months"]}, added)


class PublishedTable:
    """Rows with columns ``year`` and ``month``; rows without a day have a month (None, None)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _children(self, path: str) -> list[str]:
        files, place = file_system(self.spark, path)
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def state(self, version: int | None = None) -> State:
        """The highest list, or the one of a number; an empty state if there is none."""
        if version is None:
            numbers = [name.removesuffix(".json") for name in self._children(f"{self.path}/lists") if name.endswith(".json")]
            version = max((int(n) for n in numbers if n.isdigit()), default=0)
        if not version:
            return State()
        files, place = file_system(self.spark, f"{self.path}/lists/{version:09d}.json")
        stream = files.open(place)
        try:
            return State.of(version, self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, df: DataFrame) -> dict[Month, str]:
        """Writes rows by month to new folders that no list names yet; the folder of each of their months.

        The month stays in the files as well, so that folders of many writes are one scan. Rebalancing lets adaptive execution split
        a month that holds most rows.
        """
        name = f"rows/{uuid.uuid4().hex}"
        parts = {"_year": F.col("year"), "_month": F.col("month")}
        spread = df.withColumns(parts).hint("rebalance", *[F.col(c) for c in parts])
        spread.write.partitionBy(*parts).parquet(f"{self.path}/{name}")
        number = lambda folder: None if folder.endswith(NULL_FOLDER) else int(folder.split("=")[1])
        return {
            (number(y), number(m)): f"{name}/{y}/{m}"
            for y in self._children(f"{self.path}/{name}") if y.startswith("_year=")
            for m in self._children(f"{self.path}/{name}/{y}") if m.startswith("_month=")
        }

    def flip(self, new: State) -> None:
        """Makes ``new`` the list after ``new.version``, then removes folders that neither it nor the list before names."""
        target = f"{self.path}/lists/{new.version + 1:09d}.json"
        files, draft = file_system(self.spark, f"{self.path}/lists/draft-{uuid.uuid4().hex}")
        stream = files.create(draft)
        stream.write(bytearray(new.text().encode()))
        stream.close()
        place = file_system(self.spark, target)[1]
        if files.exists(place) or not files.rename(draft, place):
            files.delete(draft, False)
            raise RuntimeError(f"{target} was written by another publish")
        named = new.folders() | self.state(new.version).folders()
        older = self.state(new.version - 1).folders() if new.version > 1 else set()
        writes = {"/".join(folder.split("/")[:2]) for folder in named}
        unnamed = {f"rows/{w}" for w in self._children(f"{self.path}/rows")} - writes
        for folder in unnamed | {f for f in older - named if "/".join(f.split("/")[:2]) not in unnamed}:
            files.delete(file_system(self.spark, f"{self.path}/{folder}")[1], True)

    def scan(self, schema: StructType, folders: Sequence[str]) -> DataFrame:
        """The rows of some folders as one scan."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def rows(self, state: State, keys: Sequence[str] = (), newer_by: str | None = None) -> DataFrame:
        """The rows of a state. Months without added rows are read as they are, of the others the newest row per key."""
        touched = {m for _, months in state.added for m in months}
        plain = self.scan(state.schema, [folder for m, folder in state.months.items() if m not in touched])
        if not touched:
            return plain
        if not newer_by:
            raise ValueError(f"batches were added to {self.path}: say by which keys and column the newest row is found")
        several = [folder for m, folder in state.months.items() if m in touched] + [folder for folder, _ in state.added]
        return plain.unionByName(clean.latest_per_key(self.scan(state.schema, several), keys, newer_by))

    def read(self, keys: Sequence[str] = (), newer_by: str | None = None) -> DataFrame:
        """The whole table as of the highest list; ``keys`` and ``newer_by`` for tables that batches are added to."""
        state = self.state()
        if not state.version:
            raise FileNotFoundError(f"nothing is published at {self.path}")
        return self.rows(state, keys, newer_by)

    def append(self, batch: DataFrame) -> None:
        """Adds a batch as one more folder. It costs what the batch costs, whatever is stored."""
        state = self.state()
        batch = fitted(batch, state.schema)
        folder = f"rows/{uuid.uuid4().hex}"
        batch.write.parquet(f"{self.path}/{folder}")
        months = [tuple(r) for r in self.scan(batch.schema, [folder]).select("year", "month").distinct().collect()]
        added = state.added + ([(folder, months)] if months else [])
        self.flip(State(state.version, state.schema or batch.schema, state.months, added))

    def compact(self, keys: Sequence[str], newer_by: str, more_than: int = 0) -> bool:
        """Rewrites the months that added batches touch, if there are more than ``more_than`` batches."""
        state = self.state()
        if len(state.added) <= more_than:
            return False
        touched = {m for _, months in state.added for m in months}
        mine = State(state.version, state.schema, {m: f for m, f in state.months.items() if m in touched}, state.added)
        written = self.write(self.rows(mine, keys, newer_by))
        kept = {m: f for m, f in state.months.items() if m not in touched}
        self.flip(State(state.version, state.schema, kept | written))
        return True


def fitted(batch: DataFrame, schema: StructType | None) -> DataFrame:
    """The batch in the columns and types of the table."""
    return batch if schema is None else batch.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
