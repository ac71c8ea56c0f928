"""Where tables of each layer live."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import versions
from ..operators.months import MonthTable
from ..operators.sinks import point_table, sorted_by
from ..schemas import BY_MONTH, GOLD_COLUMNS, GOLD_SORT_KEYS, MONTH, SWITCHED, layer_name, stored_schema
from ..sources.tables import ensure_database


@dataclass(frozen=True)
class Warehouse:
    """Layers of parquet tables below one root that every executor can reach.

    A table that is rebuilt gets a folder per version, and readers look at the last complete one. Bronze is appended to
    in place. Tables switched by month have an entry in the catalog, in the database ``prefix`` + layer; the prefix
    follows from the root unless it is given. Without a lasting catalog, entries are found again from the folders.
    """

    spark: SparkSession
    root: str
    prefix: str | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer_name(layer)}/{table}"

    def database(self, layer: str) -> str:
        prefix = f"wh_{hashlib.md5(self.root.encode()).hexdigest()[:10]}_" if self.prefix is None else self.prefix
        return layer_name(prefix + layer_name(layer))

    def location(self, layer: str, table: str) -> str:
        """Where a table's files lie now: its last version, or its path if it has none."""
        path = self.path(layer, table)
        return versions.newest(self.spark, path) or path

    def exists(self, layer: str, table: str) -> bool:
        path = self.path(layer, table)
        if versions.has_versions(self.spark, path):
            return versions.newest(self.spark, path) is not None
        return versions.exists(self.spark, path)

    def months(self, layer: str, table: str, schema: T.StructType | None = None, day: str | None = None) -> MonthTable:
        """The table as one switched by month."""
        known, of = SWITCHED.get((layer, table), (None, None))
        sort = GOLD_SORT_KEYS.get(table, ()) if layer == "gold" else ()
        return MonthTable(self.spark, f"{self.database(layer)}.{table}", self.path(layer, table), schema or known, day or of, sort)

    def read(self, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        if (layer, table) in SWITCHED:
            return self.months(layer, table).read()
        schema = schema or stored_schema(layer, table)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.location(layer, table))

    def write(self, layer: str, table: str, df: DataFrame, sort: Sequence[str] = ()) -> DataFrame:
        """Rebuild a table in full, sorted by key when one is given. ``df`` may be computed from the table itself."""
        out = sorted_by(df, sort) if sort else df
        out.write.parquet(versions.next_version(self.spark, self.path(layer, table)))
        return self.read(layer, table, df.schema)

    def gold(self) -> Mapping[str, DataFrame]:
        return Gold(self)

    def rebuild_mart(self, table: str, df: DataFrame) -> DataFrame:
        return self.write("gold", table, df.select(*GOLD_COLUMNS[table]), GOLD_SORT_KEYS[table])

    def register(self, layer: str, tables: Sequence[str], prefix: str = "") -> None:
        """Expose tables of a layer to SQL, one database per layer. Call it again after a run to see its versions."""
        database = ensure_database(self.spark, prefix + layer_name(layer))
        for table in tables:
            name = f"{database}.{table}"
            if (layer_name(layer), table) in SWITCHED:
                own = self.months(layer_name(layer), table)
                if own.name != name:
                    own.referenced_by(name)
                continue
            schema = None if (layer_name(layer), table) in BY_MONTH else stored_schema(layer_name(layer), table)
            point_table(self.spark, name, self.location(layer, table), schema)
            if MONTH in self.spark.table(name).columns:
                self.spark.catalog.recoverPartitions(name)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions of rebuilt tables that nothing looks at, but for the newest ``keep``. For times when no query runs."""
        out: list[str] = []
        for layer in versions.children(self.spark, self.root):
            for table in versions.children(self.spark, f"{self.root}/{layer}"):
                path = f"{self.root}/{layer}/{table}"
                if (layer, table) in SWITCHED:
                    out += self.months(layer, table).vacuum(keep)
                elif versions.has_versions(self.spark, path):
                    out += versions.drop_versions(self.spark, path, set(), max(1, keep))
        return out


class Gold(Mapping):
    """The gold tables by name; a table is opened when it is asked for."""

    def __init__(self, warehouse: Warehouse) -> None:
        self._warehouse = warehouse

    def __getitem__(self, name: str) -> DataFrame:
        if name not in GOLD_COLUMNS:
            raise KeyError(name)
        return self._warehouse.read("gold", name)

    def __iter__(self) -> Iterator[str]:
        return iter(GOLD_COLUMNS)

    def __len__(self) -> int:
        return len(GOLD_COLUMNS)
