"""Column names that cannot clash with the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unused(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def all_columns(df: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in df.columns]
