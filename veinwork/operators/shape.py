"""Small reshaping helpers used by several operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """A column by its literal name, also when the name holds spaces or dots."""
    return F.col(f"`{name}`")


def rows_from(df: DataFrame, records: Sequence[Column], *keep: str) -> DataFrame:
    """Turn each input row into one output row per struct in `records`."""
    return df.select(*[col(k) for k in keep], F.inline(F.array(*records)))


def columns_by_kind(df: DataFrame, exclude: Iterable[str] = ()) -> dict[str, list[str]]:
    """Names of the numeric, boolean, categorical and date columns. Reads the schema only."""
    skip = set(exclude)
    kinds: dict[str, list[str]] = {"numeric": [], "boolean": [], "categorical": [], "date": []}
    for field in df.schema:
        if field.name in skip and not isinstance(field.dataType, T.BooleanType):
            continue
        if isinstance(field.dataType, T.BooleanType):
            kinds["boolean"].append(field.name)
        elif isinstance(field.dataType, T.NumericType):
            kinds["numeric"].append(field.name)
        elif isinstance(field.dataType, T.StringType):
            kinds["categorical"].append(field.name)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kinds["date"].append(field.name)
    return kinds


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The wanted columns that the table has, in the wanted order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def drop_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows without a null, or a NaN, in the given columns (all by default). Written as plain
    conditions, which a parquet scan can use to skip row groups."""
    wanted = df.columns if columns is None else list(columns)
    kinds = {f.name: f.dataType for f in df.schema}
    for name in wanted:
        df = df.filter(col(name).isNotNull())
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            df = df.filter(~F.isnan(col(name)))
    return df


def project(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Select a list of columns, leaving out those the table lacks."""
    return df.select(*[col(n) for n in present(df, names)])


def feature_array(columns: Sequence[str]) -> Column:
    """One dense array of doubles out of feature columns."""
    return F.array(*[col(c).cast("double") for c in columns])
