"""Attributes of the run's date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each season; every other month is Autumn.
WINTER, SPRING, SUMMER = (12, 1, 2), (3, 4, 5), (6, 7, 8)


def season(day: Column) -> Column:
    month = F.month(day)
    return (
        F.when(month.isin(*WINTER), "Winter")
        .when(month.isin(*SPRING), "Spring")
        .when(month.isin(*SUMMER), "Summer")
        .when(month.isNotNull(), "Autumn")
    )


def date_attributes(moment: Column) -> dict[str, Column]:
    """trading_day, month, English day name, quarter and season of a timestamp."""
    day = F.to_date(moment)
    return {
        "trading_day": day,
        "month": F.month(day).cast("int"),
        "day_of_week": F.date_format(day, "EEEE"),
        "quarter": F.quarter(day).cast("int"),
        "season": season(day),
    }


def run_timestamp(text: Column) -> Column:
    """ISO text to a timestamp of whole seconds; NULL when it cannot be read."""
    return F.date_trunc("second", F.try_to_timestamp(text))


def run_timestamp_text(text: Column) -> Column:
    """The run's timestamp as 'yyyy-MM-dd HH:mm:ss' in UTC; text that cannot be read stays as is."""
    utc = F.to_utc_timestamp(F.try_to_timestamp(text), F.current_timezone())
    return F.coalesce(F.date_format(utc, "yyyy-MM-dd HH:mm:ss"), text)
