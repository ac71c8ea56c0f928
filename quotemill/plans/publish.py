"""The gold tables for readers with full or limited access: masked copies, and references to everything else."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..functions.masking import RARE_BELOW
from ..operators.masking import limited_company, limited_rank
from ..operators.sinks import point_table
from ..schemas import GOLD, GOLD_COLUMNS, GOLD_SORT_KEYS, SWITCHED
from ..session import together
from ..sources.tables import ensure_database
from .warehouse import Warehouse

# Role -> (layer it may read, prefix of its tables).
ROLES = {
    "analyst_full": ("gold_full_views", "v_"),
    "analyst_limited": ("gold_limited_views", "v_limited_"),
}


def masked_tables(gold: Mapping[str, DataFrame], below: int = RARE_BELOW) -> dict[str, DataFrame]:
    """The tables that limited readers get in another form."""
    return {
        "DimCompany": limited_company(gold["DimCompany"].select(*GOLD_COLUMNS["DimCompany"]), below),
        "FactForbesRank": limited_rank(gold["FactForbesRank"].select(*GOLD_COLUMNS["FactForbesRank"])),
    }


def publish(
    warehouse: Warehouse, role: str, below: int = RARE_BELOW, months: Sequence[int] | None = None
) -> dict[str, DataFrame]:
    """Give a role its table set, as tables of its layer's database, and return it by table name.

    Only masked tables are written, sorted by key. All others are catalog entries over gold's own files: nothing is
    copied, and publishing again after a run moves the entries on, for the dated fact month by month, or with
    ``months`` these alone. Who may read which database and folder is for catalog and storage to enforce.
    """
    layer, prefix = ROLES[role]
    spark = warehouse.spark
    database = ensure_database(spark, warehouse.database(layer))
    masked = masked_tables(warehouse.gold(), below) if role == "analyst_limited" else {}

    def give(name: str) -> DataFrame:
        entry = f"{database}.{prefix}{name}"
        if ("gold", name) in SWITCHED:
            return warehouse.months("gold", name).referenced_by(entry, months).read().select(*GOLD_COLUMNS[name])
        if name in masked:
            schema = masked[name].schema
            warehouse.write(layer, prefix + name, masked[name], GOLD_SORT_KEYS[name])
            point_table(spark, entry, warehouse.location(layer, prefix + name), schema)
        else:
            point_table(spark, entry, warehouse.location("gold", name), GOLD[name])
        return spark.table(entry)

    given = together(*[lambda name=name: give(name) for name in GOLD_COLUMNS])
    return {prefix + name: df for name, df in zip(GOLD_COLUMNS, given)}
