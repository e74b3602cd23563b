"""Scans. A CSV is read as text with a declared schema, so no inference pass is needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veinwork.operators.shape import col
from veinwork.session import durable
from veinwork.sources.schema import FieldSpec, coerce


def read_csv(spark: SparkSession, path: str, specs: Sequence[FieldSpec]) -> DataFrame:
    """A headed CSV, typed by `specs`. The header decides which file column is which field."""
    header = spark.read.option("header", True).csv(path).columns
    raw = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in header])).csv(
        path, header=True, enforceSchema=False, quote='"', escape='"', multiLine=False
    )
    return coerce(raw, specs)


BAD_LINE = "_bad_line"


def read_csv_checked(spark: SparkSession, path: str, specs: Sequence[FieldSpec]) -> tuple[DataFrame, DataFrame]:
    """A CSV without a header whose fields are `specs` in order: the typed rows of its good lines, and
    its bad lines as `(line, fields)`, those with more or fewer fields than declared.

    The parsed lines are stored, so the text is parsed once, and with all of its fields: a scan that
    is pruned to some of them could not tell a bad line.
    """
    schema = T.StructType([*[T.StructField(s.name, T.StringType()) for s in specs], T.StructField(BAD_LINE, T.StringType())])
    raw = durable(spark.read.schema(schema).csv(
        path, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE, quote='"', escape='"'))
    given = F.size(F.array_compact(F.array(*[col(s.name) for s in specs])))
    bad = raw.filter(col(BAD_LINE).isNotNull()).select(col(BAD_LINE).alias("line"), given.alias("fields"))
    return coerce(raw.filter(col(BAD_LINE).isNull()).drop(BAD_LINE), specs), bad


def read_parquet(spark: SparkSession, path: str, specs: Sequence[FieldSpec] = ()) -> DataFrame:
    df = spark.read.parquet(path)
    return coerce(df, specs) if specs else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
