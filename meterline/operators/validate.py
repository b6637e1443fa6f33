"""Required-column check, run on the schema before any job starts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


class MissingColumnsError(ValueError):
    """Raised when an input lacks required columns; lists all of them."""

    def __init__(self, missing: list[str], where: str = "input"):
        self.missing = missing
        super().__init__(f"{where} is missing required columns: {missing}")


def require_columns(df: DataFrame, required: Iterable[str], where: str = "input") -> DataFrame:
    """Return ``df`` unchanged, or raise listing every missing column."""
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise MissingColumnsError(missing, where)
    return df


def select_required(df: DataFrame, required: list[str], where: str = "input") -> DataFrame:
    """Validate, then project to exactly ``required`` in that order."""
    return require_columns(df, required, where).select(*required)
