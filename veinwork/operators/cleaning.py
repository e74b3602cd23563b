"""Dropping, de-duplicating, validating and imputing rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veinwork.functions.parsing import known_flag_word
from veinwork.operators.profiling import value_counts
from veinwork.operators.quantiles import exact_quantiles
from veinwork.operators.shape import col, columns_by_kind, rows_from
from veinwork.session import durable

UNKNOWN = "Unknown"
SPARSE_SHARE = 0.5


def frequent_classes(df: DataFrame, column: str, min_rows: int = 1000) -> DataFrame:
    """Keep the rows whose class has at least `min_rows` rows."""
    counts = df.groupBy(col(column)).agg(F.count(F.lit(1)).alias("_n"))
    # Stored: Spark broadcasts the classes if their size allows, and splits hot ones if not.
    return df.join(durable(counts.filter(F.col("_n") >= min_rows).select(col(column))), column, "left_semi")


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by `order`, which must be a total order.

    The constant bound on the row number makes Spark keep one row per key and task before
    the shuffle, so that a key holding much of the table does not travel whole.
    """
    first = W.partitionBy(*[col(k) for k in key]).orderBy(*[col(o) for o in order])
    return df.withColumn("_row", F.row_number().over(first)).filter("_row = 1").drop("_row")


@dataclass(frozen=True)
class Rule:
    """A validity rule: what counts as a violation, and what a valid row must meet.

    A null is no violation of a range but does not meet it either.
    """

    name: str
    violated: Column
    met: Column


def range_rule(name: str, value: Column, low, high) -> Rule:
    low, high = F.lit(low), F.lit(high)
    return Rule(name, (value < low) | (value > high), (value >= low) & (value <= high))


def present_rule(name: str, value: Column) -> Rule:
    return Rule(name, value.isNull(), value.isNotNull())


def flag_word_rule(name: str, raw: Column) -> Rule:
    """The raw text must be one of the accepted flag spellings."""
    known = known_flag_word(raw)
    return Rule(name, ~known, known)


def violation_counts(df: DataFrame, rules: Sequence[Rule], total: str = "total") -> DataFrame:
    """`(rule, violations)` for every rule, and their sum, from one aggregate."""
    one = df.agg(*[F.count_if(r.violated).alias(f"_{i}") for i, r in enumerate(rules)])
    records = [
        F.struct(F.lit(r.name).alias("rule"), F.col(f"_{i}").alias("violations"))
        for i, r in enumerate(rules)
    ]
    whole = reduce(lambda a, b: a + b, [F.col(f"_{i}") for i in range(len(rules))])
    return rows_from(one, [*records, F.struct(F.lit(total).alias("rule"), whole.alias("violations"))])


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.filter(reduce(and_, [r.met for r in rules]))


def cleaning_report(
    df: DataFrame, stages: Sequence[tuple[str, Column]], raw: DataFrame | None = None
) -> DataFrame:
    """`(step_no, step, rows_before, removed, rows_after)` per cleaning step.

    Each row is charged to the first step it fails, so all filters are accounted for in one
    pass. `raw` is the table that `df` was de-duplicated from; it adds that step in front.
    """
    failed = F
    for i, (_, keep) in enumerate(stages):
        failed = failed.when(~F.coalesce(keep, F.lit(False)), i)
    one = df.select(failed.otherwise(len(stages)).alias("_step")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col("_step") == i).alias(f"_{i}") for i in range(len(stages))],
    )
    names, removed = [s for s, _ in stages], [F.col(f"_{i}") for i in range(len(stages))]
    before = F.col("_rows")
    if raw is not None:
        one = one.withColumn("_raw", raw.agg(F.count(F.lit(1)).alias("c")).scalar())
        names, removed = ["duplicates", *names], [F.col("_raw") - F.col("_rows"), *removed]
        before = F.col("_raw")
    records = []
    for i, (name, gone) in enumerate(zip(names, removed)):
        records.append(F.struct(
            F.lit(i + 1).cast("long").alias("step_no"), F.lit(name).alias("step"),
            before.alias("rows_before"), gone.alias("removed"), (before - gone).alias("rows_after"),
        ))
        before = before - gone
    return rows_from(one, records)


def missing_counts(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Row count and nulls per column, from one aggregate."""
    row = df.agg(
        F.count(F.lit(1)), *[F.count_if(col(c).isNull()) for c in columns]
    ).first()
    return row[0], dict(zip(columns, row[1:]))


def drop_sparse_columns(df: DataFrame, max_share: float = SPARSE_SHARE) -> DataFrame:
    """Drop the columns that are null in more than `max_share` of the rows."""
    rows, missing = missing_counts(df, df.columns)
    return df.drop(*[c for c, n in missing.items() if rows and n / rows > max_share])


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent text of each column, the smallest on ties; `Unknown` when all are null."""
    order = W.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    best = (
        value_counts(df, columns).filter("value is not null")
        .withColumn("_r", F.row_number().over(order)).filter("_r = 1")
    )
    found = {r["column"]: r["value"] for r in best.collect()}  # one row per column
    return {c: found.get(c, UNKNOWN) for c in columns}


def median_values(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    found = exact_quantiles(df, columns, [0.5]).collect()  # one row per column
    return {r["column"]: r["quantiles"][0] for r in found}


def fill(df: DataFrame, values: dict) -> DataFrame:
    """Replace nulls by a constant per column, keeping each column's type where it fits."""
    types = dict(df.dtypes)
    filled = {
        c: F.coalesce(col(c), F.lit(v)).alias(c)
        if not (isinstance(v, float) and types[c] in ("int", "bigint", "smallint", "tinyint"))
        else F.coalesce(col(c).cast("double"), F.lit(v)).alias(c)
        for c, v in values.items()
    }
    return df.select(*[filled.get(c, col(c)) for c in df.columns])


def impute(
    df: DataFrame,
    constant: Sequence[str] = (),
    max_share: float = SPARSE_SHARE,
    exclude: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Impute every column that misses values and log what was done.

    Columns null in more than `max_share` of the rows are dropped. Text takes `Unknown` if
    listed in `constant`, else its mode; numbers and times take their median, flags the value of
    more than half of the rows (false on ties). The log is `(column, action, missing,
    missing_pct)`, worst first.
    """
    columns = [c for c in df.columns if c not in set(exclude)]
    rows, missing = missing_counts(df, columns)
    sparse = [c for c in columns if rows and missing[c] / rows > max_share]
    todo = [c for c in columns if missing[c] and c not in sparse]
    kinds = columns_by_kind(df)
    numbers = [c for c in todo if c in kinds["numeric"]]
    words = [c for c in todo if c in kinds["categorical"]]
    by_mode = [c for c in words if c not in set(constant)]

    values: dict = {c: UNKNOWN for c in words if c in set(constant)}
    values |= mode_values(df, by_mode) if by_mode else {}
    medians = median_values(df, numbers) if numbers else {}
    times, flags = [c for c in todo if c in kinds["date"]], [c for c in todo if c in kinds["boolean"]]
    seen = df.select(*[_as_number(df, c).alias(c) for c in times + flags])
    middles = median_values(seen, times + flags) if times + flags else {}
    moments = {c: _from_number(df, c, middles[c]) for c in times if c in middles}
    majority = {c: middles[c] > 0.5 for c in flags if c in middles}
    actions = {c: "dropped" for c in sparse}
    actions |= {c: f"filled with '{v}'" for c, v in values.items()}
    actions |= {c: f"filled with median ({v:.2f})" for c, v in medians.items()}
    actions |= {c: f"filled with median ({v[0]})" for c, v in moments.items()}
    actions |= {c: f"filled with {v}" for c, v in majority.items()}
    log = [
        (c, a, missing[c], round(missing[c] * 100.0 / rows, 6)) for c, a in actions.items()
    ]
    log_df = df.sparkSession.createDataFrame(
        log, "column string, action string, missing bigint, missing_pct double"
    ).orderBy(F.desc("missing"), "column")
    filled = fill(df, values | medians | majority)
    filled = filled.withColumns({c: F.coalesce(col(c), F.lit(v[0]).cast(v[1])) for c, v in moments.items()})
    return filled.drop(*sparse), log_df


def _as_number(df: DataFrame, name: str) -> Column:
    """A time as microseconds, a flag as 0 or 1."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return col(name).cast("int")
    return F.unix_micros(col(name).cast("timestamp")).cast("double")


def _from_number(df: DataFrame, name: str, micros: float) -> tuple[str, T.DataType]:
    """A time in microseconds as text in the session's zone, and the column's type."""
    spark, kind = df.sparkSession, df.schema[name].dataType
    moment = spark.range(1).select(F.timestamp_micros(F.lit(int(micros))).cast(kind).cast("string")).first()
    return moment[0], kind
