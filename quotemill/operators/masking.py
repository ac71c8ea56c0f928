"""Masked copies of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import masking as M
from .windows import group_count


def mask_rare(df: DataFrame, column: str, out: str, below: int = M.RARE_BELOW) -> DataFrame:
    """Replace values shared by fewer than ``below`` rows with one label."""
    counted = group_count(df, [column], "_members")
    return counted.withColumn(
        out, F.when(F.col("_members") < below, M.RARE_LABEL).otherwise(F.col(column))
    ).drop("_members")


def limited_company(dim_company: DataFrame, below: int = M.RARE_BELOW) -> DataFrame:
    """Companies with the name cut to its first characters and rare industries merged."""
    return mask_rare(dim_company, "Industry", "Industry_masked", below).select(
        "CompanyKey",
        M.mask_prefix(F.col("CompanyName")).alias("CompanyName_masked"),
        "Headquarters",
        "Industry_masked",
        "Sector",
        "ValidFrom",
        "ValidTo",
    )


def limited_rank(fact_rank: DataFrame) -> DataFrame:
    """Ranks as ranges of one hundred."""
    return fact_rank.select(
        "ForbesRankKey", "CompanyKey", "Year", M.mask_range(F.col("ForbesRank")).alias("ForbesRank_range")
    )
