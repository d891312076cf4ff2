"""Helpers that add columns to rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a costly column that is evaluated once per row.

    A filter on a projected column is pushed below the projection and repeats
    the expression there; a one-element explode keeps it above.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))
