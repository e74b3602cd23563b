"""Label codes, one-hot columns, scaling, and the feature matrix."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veinwork.operators.cleaning import UNKNOWN
from veinwork.operators.shape import col, rows_from
from veinwork.session import discard, durable

# Values of a column whose codes are sent to every task, whatever other columns have.
FEW_VALUES = 10_000
ONE_HOT_LIMIT = 1_000


def _text(column: str):
    return F.coalesce(col(column).cast("string"), F.lit(UNKNOWN))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), _text(c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).distinct()


def _codes_by_ranges(values: DataFrame) -> DataFrame:
    """Rank distinct values of each column without sorting a column in one task. The stored table `values`
    is deleted, and the result is stored.

    A range partitioning sorts the values; a value's place in its task counts on from the values
    of its column in the tasks before.
    """
    # The number of a row is its task and its place there, and is fixed by writing it out.
    placed = durable(values.repartitionByRange("column", "value").sortWithinPartitions("column", "value").withColumn(
        "_at", F.monotonically_increasing_id()))
    discard(values)
    run = F.shiftright("_at", 33).alias("_run")
    earlier = W.partitionBy("column").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("column", run).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).select(
        "column", "_run", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_start"))
    # A row for each task and each column it has values of.
    labels = durable(placed.select("column", "value", "_at", run).join(F.broadcast(starts), ["column", "_run"]).select(
        "column", "value", (F.col("_start") + F.col("_at")).cast("int").alias("code")))
    discard(placed)
    return labels


def fit_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, value, code)`: 0-based rank of each distinct value, a null being `Unknown`; a stored table."""
    return _codes_by_ranges(durable(distinct_values(df, columns)))


def apply_labels(
    df: DataFrame,
    labels: DataFrame,
    columns: Sequence[str],
    suffix: str = "_encoded",
    unseen: int | None = None,
    mark_unseen: bool = False,
) -> DataFrame:
    """Add the code of each column. A value without a code gets `unseen` (null by default);
    `mark_unseen` also adds a boolean column per encoded one.

    Each column looks its codes up in the stored labels. A column of few values gets them sent,
    since Spark only knows the bytes of all columns' labels together; of the others Spark
    broadcasts what is small enough, and splits the rows of a hot value if not.
    """
    sizes = {r["column"]: r["count"] for r in labels.groupBy("column").count().collect()}  # a row per column
    out = df
    for c in columns:
        part = labels.filter(F.col("column") == c).select(F.col("value").alias("_text"), F.col("code").alias("_code"))
        if sizes.get(c, 0) <= FEW_VALUES:
            part = F.broadcast(part)
        code = F.col("_code") if unseen is None else F.coalesce("_code", F.lit(unseen))
        out = out.withColumn("_text", _text(c)).join(part, "_text", "left").withColumn(f"{c}{suffix}", code)
        if mark_unseen:
            out = out.withColumn(f"{c}_unseen", F.col("_code").isNull())
        out = out.drop("_text", "_code")
    return out


def unseen_report(encoded: DataFrame, columns: Sequence[str], split: str) -> DataFrame:
    """`(split, column, replaced)` after `apply_labels(..., mark_unseen=True)`."""
    one = encoded.groupBy(col(split)).agg(
        *[F.count_if(col(f"{c}_unseen")).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    return rows_from(one, [
        F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("replaced"))
        for i, c in enumerate(columns)
    ], split)


def one_hot(df: DataFrame, columns: Sequence[str], limit: int = ONE_HOT_LIMIT) -> DataFrame:
    """0/1 columns `<column>_<value>` for every value but the first in order.

    The width of the result is the number of categories, so more than `limit` in a column is an error.
    """
    values = durable(distinct_values(df, columns))
    for c, n in values.groupBy("column").count().collect():  # a row per column
        if n > limit:
            raise ValueError(f"{c} has {n} categories, more than {limit}; use label codes")
    found = values.collect()
    added = []
    for c in columns:
        for value in sorted(r["value"] for r in found if r["column"] == c)[1:]:
            added.append((_text(c) == value).cast("int").alias(f"{c}_{value}"))
    return df.select("*", *added)


@dataclass(frozen=True)
class Scaler:
    """Shift and width of each column; a width of zero scales to 0."""

    shift: dict[str, float]
    width: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        scaled = {}
        for c, shift in self.shift.items():
            v = col(c).cast("double")
            width = self.width[c]
            value = (v - F.lit(shift)) / F.lit(width) if width else F.when(v.isNotNull(), F.lit(0.0))
            scaled[c] = value
        if suffix:
            return df.select("*", *[v.alias(f"{c}{suffix}") for c, v in scaled.items()])
        return df.select(*[scaled[c].alias(c) if c in scaled else col(c) for c in df.columns])


def _fit(df: DataFrame, columns: Sequence[str], low, high) -> Scaler:
    v = [col(c).cast("double") for c in columns]
    row = df.agg(*[low(x) for x in v], *[high(x) for x in v]).first()
    n = len(columns)
    shift = {c: float(row[i] or 0.0) for i, c in enumerate(columns)}
    width = {c: float(row[n + i] or 0.0) for i, c in enumerate(columns)}
    return Scaler(shift, width)


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Mean 0 and population deviation 1."""
    return _fit(df, columns, F.avg, F.stddev_pop)


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Onto [0, 1]."""
    return _fit(df, columns, F.min, lambda x: F.max(x) - F.min(x))


def feature_matrix(
    df: DataFrame,
    keys: Sequence[str],
    numeric: Sequence[str] = (),
    boolean: Sequence[str] = (),
    encoded: Sequence[str] = (),
) -> DataFrame:
    """Key columns and all features as doubles: flags as 0/1, missing values as 0."""
    features = [col(c).cast("double") for c in numeric]
    features += [col(c).cast("int").cast("double") for c in boolean]
    features += [col(c).cast("double") for c in encoded]
    names = [*numeric, *boolean, *encoded]
    return df.select(
        *[col(k) for k in keys],
        *[F.coalesce(f, F.lit(0.0)).alias(n) for f, n in zip(features, names)],
    )


def matrix_quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing and infinite cells, and the averages of the column means and deviations."""
    def total(parts):
        return sum(parts[1:], parts[0])

    v = [col(c).cast("double") for c in columns]
    n = F.lit(float(len(columns)))
    return df.agg(
        total([F.count_if(x.isNull() | F.isnan(x)) for x in v]).alias("nan_cells"),
        total([F.count_if(F.abs(x) == float("inf")) for x in v]).alias("inf_cells"),
        F.round(total([F.avg(x) for x in v]) / n, 6).alias("mean_of_means"),
        F.round(total([F.stddev_samp(x) for x in v]) / n, 6).alias("mean_of_std"),
    )
