from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(value: Column) -> Column:
    """Zone-free timestamp; text that is no timestamp becomes NULL."""
    return value.try_cast("timestamp_ntz")


def day_number_sunday0(day: Column) -> Column:
    """Day of week counted from Sunday = 0 (Spark counts from Sunday = 1)."""
    return F.dayofweek(day) - 1


def days_between(earlier: Column, later: Column) -> Column:
    """Calendar days crossed, whatever the time of day."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def months_before(day: Column, months: int) -> Column:
    """Date some months earlier, clipped at the end of a shorter month."""
    return F.add_months(day, -months)
