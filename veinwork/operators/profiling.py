"""Column profiles: counts, distributions, missing values, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veinwork.operators import quantiles
from veinwork.operators.shape import col, rows_from

QUARTILES = (0.25, 0.5, 0.75)
FIVE_NUMBERS = (0.0, 0.25, 0.5, 0.75, 1.0)

# How many top values a categorical profile shows, by distinct count.
SUMMARY_STEPS = ((20, 10), (100, 5))
SUMMARY_LAST = 1
HIGH_CARDINALITY = 100
# Size of a distinct-count sketch; at 14 an estimate is off by less than 3 % with high probability.
SKETCH_PRECISION = 14


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[col(o) for o in order]).limit(n)


def non_null_counts(df: DataFrame) -> DataFrame:
    """`(column, data_type, non_null)` for every column, from one aggregate."""
    one = df.agg(*[F.count(col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return rows_from(one, [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("data_type"), F.col(f"_{i}").alias("non_null"))
        for i, (c, t) in enumerate(df.dtypes)
    ])


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, value, n)` for all columns from one scan; values as text, null kept."""
    pairs = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, n_distinct)`, nulls ignored, most distinct first."""
    return (
        value_counts(df, columns)
        .groupBy("column").agg(F.count("value").alias("n_distinct"))
        .orderBy(F.desc("n_distinct"), "column")
    )


def high_cardinality_columns(df: DataFrame, columns: Sequence[str], above: int = HIGH_CARDINALITY) -> DataFrame:
    return distinct_counts(df, columns).filter(F.col("n_distinct") > above)


def _ranked(counts: DataFrame, most: int) -> DataFrame:
    """The `most` frequent non-null values of each column. The constant bound lets Spark cut
    each column's values before the shuffle."""
    # Nulls are ranked last rather than filtered before, so that the totals can reuse the
    # counts' shuffle.
    order = W.partitionBy("column").orderBy(F.col("value").isNull(), F.desc("n"), F.asc("value"))
    ranked = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.filter("value is not null")


def _per_column(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(
        F.count("value").alias("n_distinct"),
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
    )


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct, missing and the top values of each column; percentages over all rows.

    A column of up to 20 values shows ten, up to 100 five, else one.
    """
    counts = value_counts(df, columns)
    shown = F
    for bound, n in SUMMARY_STEPS:
        shown = shown.when(F.col("n_distinct") <= bound, n)
    shown = shown.otherwise(SUMMARY_LAST)
    top = _ranked(counts, max(n for _, n in SUMMARY_STEPS))
    # One row per profiled column: as many as the schema is wide.
    totals = F.broadcast(_per_column(counts))
    return (
        top.join(totals, "column").filter(F.col("rank") <= shown)
        .select(
            "column", "n_distinct", "missing",
            F.round(F.col("missing") * 100.0 / F.col("n_rows"), 6).alias("missing_pct"),
            F.col("rank").cast("long").alias("rank"), "value", "n",
            F.round(F.col("n") * 100.0 / F.col("n_rows"), 6).alias("pct"),
            (F.col("n_distinct") > HIGH_CARDINALITY).alias("high_cardinality"),
        )
    )


def category_bars(df: DataFrame, columns: Sequence[str], all_up_to: int = 20, else_top: int = 10) -> DataFrame:
    """Bar heights: every value of a column with few values, else the most frequent ones."""
    counts = value_counts(df, columns)
    totals = F.broadcast(_per_column(counts).select("column", "n_distinct"))
    shown = F.when(F.col("n_distinct") <= all_up_to, all_up_to).otherwise(else_top)
    return (
        _ranked(counts, max(all_up_to, else_top)).join(totals, "column")
        .filter(F.col("rank") <= shown)
        .select("column", F.col("rank").cast("long").alias("rank"), "value", "n")
    )


def boolean_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, value, n, pct)` with the percentage over non-null rows."""
    counts = value_counts(df, columns).filter("value is not null")
    total = F.sum("n").over(W.partitionBy("column"))
    return counts.select(
        "column", (F.col("value") == "true").alias("value"), "n",
        F.round(F.col("n") * 100.0 / total, 6).alias("pct"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    extent = quantiles.extents(df, columns)
    quartiles = quantiles.ranked_values(df, extent, columns, QUARTILES)
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    basic = every.join(extent, "column", "left").join(quartiles, "column", "left")
    return basic.select(
        "column", F.coalesce("n", F.lit(0)).alias("n"), F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"),
        F.col("lo").alias("min"),
        *[F.round(F.col("quantiles")[i], 6).alias(name) for i, name in enumerate(("q1", "median", "q3"))],
        F.col("hi").alias("max"),
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """`(bin, low, high, n)` for equal-width bins, empty ones included; the last bin is closed.

    A constant column is spread half a unit to both sides.
    """
    v = col(column).cast("double")
    clean = df.filter(v.isNotNull() & ~F.isnan(v))
    low, high = clean.agg(F.min(v), F.max(v)).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, low double, high double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = high - low
    place = F.floor((v - F.lit(low)) * F.lit(float(bins)) / F.lit(width)) + 1
    counts = clean.groupBy(F.least(place, F.lit(bins)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(1, bins + 1, numPartitions=1).select(F.col("id").cast("int").alias("bin"))
    edge = lambda k: F.lit(low) + k * F.lit(width) / F.lit(float(bins))
    # The counts have one row per bin.
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        F.round(edge(F.col("bin") - 1), 6).alias("low"),
        F.round(edge(F.col("bin")), 6).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; a null key is a value like any other."""
    groups = df.groupBy(*[col(k) for k in key]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def duplicate_keys(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The most repeated keys, and how many keys repeat at all."""
    repeated = (
        df.filter(col(key).isNotNull()).groupBy(col(key)).agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    top = repeated.orderBy(F.desc("n"), col(key)).limit(n)
    return top.withColumn(
        "repeated_keys", repeated.agg(F.count(F.lit(1)).alias("c")).scalar()
    )


def missing_report(df: DataFrame, columns: Sequence[str] | None = None, n: int | None = None) -> DataFrame:
    """`(column, missing, missing_pct)` of the columns that miss values, worst first."""
    columns = list(columns or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    report = (
        rows_from(one, [
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("missing"), F.col("_rows").alias("_rows"))
            for i, c in enumerate(columns)
        ])
        .filter("missing > 0")
        .select("column", "missing", F.round(F.col("missing") * 100.0 / F.col("_rows"), 6).alias("missing_pct"))
        .orderBy(F.desc("missing"), "column")
    )
    return report.limit(n) if n else report


def relative_frequency(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    counts = df.filter(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.round(F.col("n") / total, digits))


def imbalance_ratio(df: DataFrame, column: str) -> DataFrame:
    """Largest class over smallest class."""
    counts = df.filter(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.max("n").alias("largest"), F.min("n").alias("smallest"),
        F.round(F.max("n") / F.min("n"), 6).alias("ratio"),
    )


def class_distribution(
    df: DataFrame, column: str, split: str | None = None, n: int | None = None
) -> DataFrame:
    """Rows per class, within each split if one is named, the `n` largest classes of each."""
    groups = [split, column] if split else [column]
    counts = (
        df.filter(col(column).isNotNull()).groupBy(*[col(g) for g in groups])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if n is None:
        return counts
    if split is None:
        return counts.orderBy(F.desc("n"), col(column)).limit(n)
    order = W.partitionBy(col(split)).orderBy(F.desc("n"), col(column))
    return counts.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n).drop("_r")


def five_number_summary(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    names = ("min", "q1", "median", "q3", "max")
    found = quantiles.exact_quantiles(df, [column], FIVE_NUMBERS, by)
    return found.select(
        *[col(b) for b in by],
        *[F.round(F.col("quantiles")[i], 6).alias(name) for i, name in enumerate(names)],
    )


def distinct_sketches(df: DataFrame, column: str, by: Sequence[str], precision: int = SKETCH_PRECISION) -> DataFrame:
    """One HyperLogLog sketch of the column per group, of a size that does not grow with the rows."""
    text = col(column).cast("string")
    return df.groupBy(*[col(b) for b in by]).agg(F.hll_sketch_agg(text, precision).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored sketches merged into coarser groups: the approximate number of distinct values."""
    merged = sketches.groupBy(*[col(b) for b in by]).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*[col(b) for b in by], F.hll_sketch_estimate("sketch").alias("n_distinct"))
