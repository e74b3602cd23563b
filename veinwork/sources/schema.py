"""A declared schema applied to a raw table field by field."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veinwork.functions import parsing
from veinwork.operators.shape import col, rows_from
from veinwork.session import compile_wide

KINDS = ("text", "timestamp", "double", "whole", "flag")


@dataclass(frozen=True)
class FieldSpec:
    name: str
    kind: str

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r} of field {self.name!r}")


def _is_right_type(data_type: T.DataType, kind: str) -> bool:
    right = {
        "text": T.StringType,
        "timestamp": (T.TimestampType, T.TimestampNTZType, T.DateType),
        "double": (T.DoubleType, T.FloatType),
        "whole": T.IntegralType,
        "flag": T.BooleanType,
    }[kind]
    return isinstance(data_type, right)


def typed_column(raw: Column, data_type: T.DataType, kind: str) -> Column:
    """The raw column as the wanted kind; a column of the right type passes through."""
    if _is_right_type(data_type, kind):
        return raw
    text = raw.cast("string")
    if kind == "timestamp":
        return parsing.timestamp_from_text(text)
    if kind == "double":
        return parsing.double_from_text(text)
    if kind == "whole":
        return parsing.whole_from_text(text)
    if kind == "flag":
        if isinstance(data_type, T.StringType):
            return parsing.flag_from_words(raw)
        return parsing.flag_from_value(raw)
    return text


def coerce(df: DataFrame, specs: Sequence[FieldSpec]) -> DataFrame:
    """Type the declared fields in one projection. Fields the table lacks are skipped and
    columns that are not declared stay as they are."""
    compile_wide(df.sparkSession)
    types = {f.name: f.dataType for f in df.schema}
    kinds = {s.name: s.kind for s in specs if s.name in types}
    return df.select(*[
        typed_column(col(n), t, kinds[n]).alias(n) if n in kinds else col(n)
        for n, t in types.items()
    ])


def coercion_report(df: DataFrame, specs: Sequence[FieldSpec]) -> DataFrame:
    """`(field, target, converted, lost)` per declared field, from one aggregate.

    `lost` counts values present in the raw table that the typed one no longer holds: bad
    numbers and dates turned null, and words outside the flag vocabulary turned false.
    """
    types = {f.name: f.dataType for f in df.schema}
    fields = [s for s in specs if s.name in types]
    aggs = []
    for i, s in enumerate(fields):
        raw = col(s.name)
        if s.kind == "flag" and isinstance(types[s.name], T.StringType):
            kept = parsing.known_flag_word(raw)
        else:
            kept = typed_column(raw, types[s.name], s.kind).isNotNull()
        aggs.append(F.count_if(raw.isNotNull() & kept).alias(f"_k{i}"))
        aggs.append(F.count_if(raw.isNotNull() & ~kept).alias(f"_l{i}"))
    return rows_from(df.agg(*aggs), [
        F.struct(
            F.lit(s.name).alias("field"), F.lit(s.kind).alias("target"),
            F.col(f"_k{i}").alias("converted"), F.col(f"_l{i}").alias("lost"),
        )
        for i, s in enumerate(fields)
    ])
