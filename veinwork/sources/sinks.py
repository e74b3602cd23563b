"""Results as one long table of metrics, and its files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinwork.operators.shape import rows_from


def metrics(df: DataFrame, section: str, values: dict[str, Column]) -> DataFrame:
    """Aggregate a table once into `(section, metric, value)` rows."""
    one = df.agg(*[v.cast("double").alias(f"_{i}") for i, v in enumerate(values.values())])
    return rows_from(one, [
        F.struct(
            F.lit(section).alias("section"), F.lit(name).alias("metric"),
            F.round(F.col(f"_{i}"), 6).alias("value"),
        )
        for i, name in enumerate(values)
    ])


def metrics_report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def write_report(report: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Save a report as parquet, json or csv."""
    writer = report.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
