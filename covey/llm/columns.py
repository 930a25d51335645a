"""Columns that an operator carries along."""

from pyspark.sql import DataFrame


def others(df: DataFrame, *names: str) -> list[str]:
    """df's columns but for the named ones, in whatever case, as Spark takes them for the same."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]
