"""Tables with any column names inside operators that join helper columns to them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plain_names(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with all columns but ``used`` named x0, x1, ..., so that none clashes with a helper
    column, whatever it was called. The order of the columns stays, so that ``toDF`` with the old
    names brings them back."""
    return docs.toDF(*[c if c in used else f"x{i}" for i, c in enumerate(docs.columns)])
