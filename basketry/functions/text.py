from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(value: Column) -> Column:
    """True for empty or space-only text; NULL stays NULL."""
    return F.trim(value) == ""


def address_part(address: Column, position: int) -> Column:
    """Trimmed comma part, counted from the end for negatives; '' when there is none."""
    return F.trim(F.split_part(address, F.lit(","), F.lit(position)))
