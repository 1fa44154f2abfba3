"""Column names that clash with none of the input's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
