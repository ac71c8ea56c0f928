"""What the registered queries share: the built warehouse and scratch places."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import classic, silver
from ..plans.pipeline import Run, run_pipeline
from ..plans.warehouse import Warehouse
from ..session import fresh_path, pinned, together
from ..sources import sample
from ..sources.tables import ensure_database

AS_OF = "2025-01-02 00:00:00"

# Keys any engine can recompute, so that key columns can be checked.
KEYS = "md5"

_built: dict[tuple[str, str], Warehouse] = {}
_classic: dict[tuple[str, str], dict[str, DataFrame]] = {}
_databases: dict[str, str] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over the tables of ``sf_dir``, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        wh = Warehouse(spark, fresh_path(spark, "warehouse"))
        companies, stocks = sample.companies_raw(spark, sf_dir), sample.stocks_raw(spark, sf_dir)
        run_pipeline(Run(wh, AS_OF, keys=KEYS), companies, stocks)
        _built[key] = wh
    return _built[key]


def gold(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return warehouse(spark, sf_dir).gold()


def classic_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The first form of the star, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _classic:
        companies = silver.companies_view(sample.companies_raw(spark, sf_dir))
        stocks = silver.stocks_view(sample.stocks_raw(spark, sf_dir))
        star = classic.star(*together(lambda: pinned(companies, "companies"), lambda: pinned(stocks, "stocks")))
        written = together(*[lambda name=name: pinned(star[name], name) for name in star])
        _classic[key] = dict(zip(star, written))
    return _classic[key]


def database(spark: SparkSession) -> str:
    """A database of this application, located in the shared folder."""
    app = spark.sparkContext.applicationId
    if app not in _databases:
        name = f"quotemill_{uuid.uuid4().hex[:12]}"
        _databases[app] = ensure_database(spark, name, fresh_path(spark, name))
    return _databases[app]


def shown(df: DataFrame) -> DataFrame:
    """Times as text, so that results do not depend on the reader's time zone."""
    return df.select(
        *[
            F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round sums of fractions, whose last bits depend on the order of addition."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})
