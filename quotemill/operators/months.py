"""Tables stored by month whose months are replaced without a moment of loss.

A load writes the months it replaces to a folder of its own. Only when that is complete is the catalog told, month by
month, to look there: readers see a month as it was or as it is, and a load that fails midway changes nothing. Months
that a load does not touch keep their files. The catalog is also what later work asks: which months there are, where
their files lie, how large these are and, from the files' footers, what the latest day is. None of it reads rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import month_key
from ..schemas import MONTH
from ..session import pinned
from ..sources.tables import ensure_database
from . import versions
from .dedup import last_version
from .joins import lookup_join

#: Rows whose day is unknown.
NO_MONTH = 0
#: Size that compaction aims at for a file.
FILE_BYTES = 128 << 20
# Partitions named in one statement.
_STATEMENT = 200


def _day_month(day: object) -> int:
    day = date.fromisoformat(str(day)[:10])
    return day.year * 100 + day.month


@dataclass(frozen=True)
class MonthTable:
    """A catalog table of parquet files with one location per month.

    ``day`` tells a row's month; without it, frames bring the month column themselves. ``sort`` is the order inside files.
    """

    spark: SparkSession
    name: str
    path: str
    schema: T.StructType
    day: str | None = None
    sort: tuple[str, ...] = ()

    # --- catalog ---------------------------------------------------------------------------------

    def ensure(self) -> None:
        """Create the catalog entry if it is absent. A catalog that forgot it, or never knew, learns the months from the folders."""
        if self.spark.catalog.tableExists(self.name):
            return
        database = self.name.split(".")[0]
        ensure_database(self.spark, database)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {MONTH} INT) USING parquet PARTITIONED BY ({MONTH}) LOCATION '{self.path}'"
        )
        self.point(self._found())

    def _months_in(self, folder: str) -> dict[int, str]:
        mark = f"{MONTH}="
        return {int(n[len(mark) :]): f"{folder}/{n}" for n in versions.children(self.spark, folder) if n.startswith(mark)}

    def _found(self) -> dict[int, str]:
        """Of each month the location in the last complete version that has it, or where an append first made it."""
        out = self._months_in(self.path)
        for folder in versions.versions(self.spark, self.path):
            out |= self._months_in(folder)
        return out

    def locations(self) -> dict[int, str]:
        """Where the catalog has the files of each month, by month."""
        self.ensure()
        database, table = self.name.lower().split(".")  # as the catalog stores names
        catalog = self.spark._jsparkSession.sharedState().externalCatalog()
        known = catalog.listPartitions(database, table, self.spark._jvm.scala.Option.empty()).iterator()
        out = {}
        while known.hasNext():
            entry = known.next()
            out[int(entry.spec().apply(MONTH))] = entry.location().toString()
        return dict(sorted(out.items()))

    def point(self, locations: dict[int, str], only: bool = False) -> None:
        """Look for these months there from now on; with ``only``, forget all others. Moves no data."""
        known = self.locations() if self.spark.catalog.tableExists(self.name) else {}

        def entry(month: int) -> str:
            return f"PARTITION ({MONTH}={month})"

        new = [f"{entry(m)} LOCATION '{at}'" for m, at in locations.items() if m not in known]
        for i in range(0, len(new), _STATEMENT):
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {' '.join(new[i : i + _STATEMENT])}")
        for month, at in locations.items():
            if month in known and known[month].split(":", 1)[-1].rstrip("/") != at.split(":", 1)[-1].rstrip("/"):
                self.spark.sql(f"ALTER TABLE {self.name} {entry(month)} SET LOCATION '{at}'")
        gone = [entry(m) for m in known if m not in locations] if only else []
        if gone:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(gone)}")
        self.spark.catalog.refreshTable(self.name)

    def referenced_by(self, name: str, months: Iterable[int] | None = None) -> MonthTable:
        """Another catalog table over this one's files, or over those of some months anew; no file is written."""
        other = MonthTable(self.spark, name, self.path, self.schema, self.day, self.sort)
        own = self.locations()
        if months is None or not self.spark.catalog.tableExists(name):
            other.ensure()
            other.point(own, only=True)
        else:
            other.point({m: own[m] for m in months if m in own})
        return other

    # --- reading ---------------------------------------------------------------------------------

    def exists(self) -> bool:
        """Whether a load of this table was ever completed."""
        return versions.newest(self.spark, self.path) is not None or bool(self._months_in(self.path))

    def read(self, months: Sequence[int] | None = None) -> DataFrame:
        """The table with its month column, or only some months of it."""
        self.ensure()
        df = self.spark.table(self.name)
        return df if months is None else df.where(F.col(MONTH).isin(list(months)))

    def on_day(self, day: object) -> DataFrame:
        """Rows of a day, from the files of its month."""
        return self.read([_day_month(day)]).where(F.col(self.day) == F.lit(day).cast("date"))

    def from_day(self, day: object) -> DataFrame:
        """Rows of a day and later, from the files of its month and later ones."""
        return self.read().where((F.col(MONTH) >= _day_month(day)) & (F.col(self.day) >= F.lit(day).cast("date")))

    def latest_day(self) -> date | None:
        """The latest day, from the footers of the last month's files; no row is read.

        A session of its own asks, because the setting that lets the scan answer from footers is a session's.
        """
        asking = self.spark.newSession()
        asking.conf.set("spark.sql.sources.useV1SourceList", "")
        asking.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        for at in reversed([at for month, at in self.locations().items() if month != NO_MONTH]):
            # All columns as the files have them: Spark finds a column's footer by its place in the schema.
            found = asking.read.schema(self.schema).parquet(at).agg(F.max(self.day).alias("d")).first()["d"]
            if found is not None:
                return found
        return None

    def sizes(self) -> DataFrame:
        """yyyymm, n_files, n_bytes of every month that has files; a listing that opens no file."""
        places = list(self.locations().values())
        empty = "yyyymm int, n_files long, n_bytes long"
        if not places:
            return self.spark.createDataFrame([], empty)
        files = self.spark.read.format("binaryFile").load(places).select("path", "length")
        month = F.regexp_extract("path", rf"{MONTH}=([0-9]+)/[^/]*$", 1).cast("int").alias(MONTH)
        return files.groupBy(month).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))

    # --- writing ---------------------------------------------------------------------------------

    def _month(self) -> Column:
        return F.coalesce(month_key(self.day), F.lit(NO_MONTH)) if self.day else F.col(MONTH)

    def months_of(self, df: DataFrame) -> list[int]:
        """The months of a frame, at most twelve per calendar year."""
        return sorted(r[0] for r in df.select(self._month().alias("m")).distinct().collect())

    def _rows(self, df: DataFrame) -> DataFrame:
        """The declared columns and the month; a month too large for one task is split, small ones share a task."""
        own = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        out = df.select(*own, self._month().alias(MONTH)).hint("rebalance", MONTH)
        return out.sortWithinPartitions(MONTH, *self.sort) if self.sort else out

    def append(self, df: DataFrame) -> None:
        """Add rows to their months, as files beside those that are there."""
        self.ensure()
        self._rows(df).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def replace(self, df: DataFrame, months: Iterable[int] = ()) -> None:
        """Make ``df`` the content of its months, and of ``months`` even where it has no row of them.

        ``df`` may be computed from the table itself.
        """
        self.ensure()
        folder = versions.next_version(self.spark, self.path)
        # A month that is emptied gets its empty folder before the load counts as complete.
        for month in months:
            versions.make_folder(self.spark, f"{folder}/{MONTH}={month}")
        self._rows(df).write.mode("append").partitionBy(MONTH).parquet(folder)
        self.point(self._months_in(folder))

    def delete_insert(self, batch: DataFrame, keys: Sequence[str]) -> list[int]:
        """Take in a batch, replacing rows of equal keys; returns the months replaced.

        ``keys`` determine the day and are the table's own key; NULL equals NULL. The batch is written first: it is used
        twice, and its months decide what is read. Running it again changes nothing.
        """
        batch = pinned(batch, "batch")
        months = self.months_of(batch)
        if months:
            stored, new = self.read(months).drop(MONTH).alias("stored"), batch.select(*keys).distinct().alias("new")
            same = reduce(and_, [F.col(f"stored.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
            columns = self.schema.names
            kept = stored.join(new, same, "left_anti").select(*columns)
            self.replace(kept.unionByName(batch.select(*columns)), months)
        return months

    def delete(self, keys: DataFrame, on: Sequence[str]) -> list[int]:
        """Delete the rows whose key is listed, rewriting only months that have such rows; returns these months.

        Finding the months reads the key columns alone.
        """
        listed = pinned(keys.select(*on).distinct(), "keys")
        hit = lookup_join(self.read().select(MONTH, *on), listed, on, "left_semi")
        months = sorted(r[0] for r in hit.select(MONTH).distinct().collect())
        if months:
            self.replace(lookup_join(self.read(months), listed, on, "left_anti"), months)
        return months

    def months_to_compact(self, file_bytes: int = FILE_BYTES) -> list[int]:
        """Months whose rows would fit in fewer files of this size."""
        needed = F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / file_bytes))
        return sorted(r[0] for r in self.sizes().where(F.col("n_files") > needed).select(MONTH).collect())

    def compact(self, keys: Sequence[str] = (), version: Sequence[str] = (), file_bytes: int = FILE_BYTES) -> list[int]:
        """Pack months that lie in needlessly many files; with ``keys``, to the last version of each key too.

        Other months keep their files. ``keys`` determine the day. Returns the months packed.
        """
        months = self.months_to_compact(file_bytes)
        if months:
            rows = self.read(months)
            self.replace(last_version(rows, keys, version) if keys else rows, months)
        return months

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions that no month points at, but for the newest ``keep``. For times when no query runs."""
        used = {at.split(":", 1)[-1].rsplit("/", 1)[0] for at in self.locations().values()}
        own = {v for v in versions.versions(self.spark, self.path) if v.split(":", 1)[-1] in used}
        return versions.drop_versions(self.spark, self.path, own, keep)
