"""Writers: typed append, create-replace, sorted copies, rejects, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import or_default
from ..session import fresh_path
from .dedup import last_version

_DEFAULTS: list[tuple[type, object]] = [
    (T.StringType, ""),
    (T.LongType, 0),
    (T.IntegerType, 0),
    (T.DoubleType, 0.0),
]


def typed(df: DataFrame, schema: T.StructType, ingested_at: str = "_ingested_at", as_of: object = None) -> DataFrame:
    """The declared columns in their declared types; unknown columns are dropped, absent ones NULL.

    The ingestion time of input that does not carry it is ``as_of``, or the server's clock if that is not given.
    """
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            columns.append(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name))
        elif field.name == ingested_at:
            moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
            columns.append(moment.alias(field.name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def with_defaults(df: DataFrame) -> DataFrame:
    """NULL becomes blank or zero by type; other types are left alone."""
    out = []
    for field in df.schema.fields:
        default = next((d for kind, d in _DEFAULTS if isinstance(field.dataType, kind)), None)
        column = F.col(f"`{field.name}`")
        if default is not None:
            column = or_default(column, field.dataType.simpleString(), default)
        out.append(column.alias(field.name))
    return df.select(*out)


def append_typed(df: DataFrame, schema: T.StructType, path: str, as_of: object = None) -> None:
    typed(df, schema, as_of=as_of).write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace a table's content. ``df`` must not read ``path`` itself; see ``rewrite_table``."""
    df.write.mode("overwrite").parquet(path)


def point_table(spark: SparkSession, table: str, path: str, schema: T.StructType | None = None, using: str = "parquet") -> None:
    """Make a catalog table show the files of ``path``; its entry is created, moved, or replaced when columns differ."""
    if spark.catalog.tableExists(table):
        known = spark.table(table).schema
        if schema is not None and [(f.name, f.dataType) for f in known] == [(f.name, f.dataType) for f in schema]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source=using, schema=schema)


def create_replace(df: DataFrame, table: str, using: str = "parquet") -> None:
    """Create a table with the schema of the data, or replace the one there is.

    The new files go to a path of their own first, so a failed job leaves the old table in place, and ``df`` may read
    it. Formats other than files, such as a lakehouse catalog whose jar is on the class path, replace the table in one
    step.
    """
    if using not in ("parquet", "orc", "csv", "json"):
        df.writeTo(table).using(using).createOrReplace()
        return
    path = fresh_path(df.sparkSession, table.replace(".", "-"))
    df.write.format(using).save(path)
    point_table(df.sparkSession, table, path, df.schema, using)


def bucketed_table(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> None:
    """Create a catalog table bucketed and sorted by key.

    Tables bucketed alike join and aggregate on the key without a shuffle. Meant for dimensions
    and yearly facts, whose keys are even; a dated fact would put a heavy company in one bucket.
    """
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    # One task per bucket, so that each bucket is one file.
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )


def rewrite_table(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Point an external table at new content, which may be computed from the table itself.

    The new files go to a path of their own, so readers see the old table or the new one, and a
    failed job leaves the old one in place. The old files are kept.
    """
    path = fresh_path(spark, table.replace(".", "-"))
    df.write.parquet(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def sorted_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-partitioned and sorted by key, so file statistics let readers skip most of a table."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def ctas_sorted(df: DataFrame, keys: Sequence[str], path: str) -> None:
    """Create a copy sorted by its key, replacing an earlier one."""
    sorted_by(df, keys).write.mode("overwrite").parquet(path)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Rejected rows with their reason as a headed ``;`` file."""
    rejects.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)


def compact(df: DataFrame, keys: Sequence[str], version: Sequence[str], path: str) -> None:
    """Write only the last version of each key, in files of even size, to a new path."""
    last_version(df, keys, version).hint("rebalance").write.mode("overwrite").parquet(path)
