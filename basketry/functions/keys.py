from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL stand-in of the published surrogate key formula.
KEY_SEPARATOR = "-"
KEY_NULL = "_dbt_utils_surrogate_key_null_"


def key_text(*columns: Column | str) -> Column:
    """The text under a surrogate key: all columns as text; NULL takes part as a placeholder."""
    parts = []
    for column in columns:
        value = F.col(column) if isinstance(column, str) else column
        parts.append(F.coalesce(value.cast("string"), F.lit(KEY_NULL)))
    return F.concat_ws(KEY_SEPARATOR, *parts)


def surrogate_key(*columns: Column | str) -> Column:
    """32-hex md5 over the text of all columns; the text of some may stand for them."""
    return F.md5(key_text(*columns))
