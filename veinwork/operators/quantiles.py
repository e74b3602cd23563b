"""Exact quantiles with linear interpolation, at any size.

A first pass finds the extent of each column, a second counts values in bins of a monotone scale.
Only the bins that hold a wanted rank are read again: while such a bin is large it is cut into
bins itself, and when it is small its values are counted. A bin of one value is settled as it is,
so a value that a third of all rows share costs one row per task.

Sketches that can be stored, merged and asked later are the approximate way, see `quantile_sketches`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veinwork.functions.binning import interval_code
from veinwork.operators.shape import col, drop_null
from veinwork.session import durable

BINS = 1024
# Rows of a bin whose values are counted one by one.
SMALL_BIN = 200_000
# Size of a quantile sketch; at 400 a rank is off by less than 1 % of the rows with high probability.
SKETCH_K = 400


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), col(c).cast("double").alias("v")) for c in columns]
    long = df.select(*[col(b) for b in by], F.inline(F.array(*pairs)))
    return drop_null(long, ["v", *by])


def _scaled(v: Column, scale: Column) -> Column:
    return F.signum(v) * F.log1p(F.abs(v) / scale)


def extents(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per group and column with values: n, lo, hi, mean, std, and the mean size of the values; a stored table."""
    return durable(_long(df, columns, by).groupBy(*by, "column").agg(
        F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"), F.avg(F.abs("v")).alias("size"),
    ))


def _listed(probs: Sequence[float]) -> Column:
    """The probabilities as one value, so that expressions do not grow with their number."""
    return F.array(*[F.lit(float(p)) for p in probs])


def _hits(spans: DataFrame, groups: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The bins that hold a wanted rank, with those ranks and the rows before each; a stored table."""
    position = F.transform(_listed(probs), lambda p: p * (F.col("_n") - 1))
    wanted = F.array_distinct(F.flatten(F.transform(position, lambda p: F.array(F.floor(p).cast("long"), F.ceil(p).cast("long")))))
    earlier = W.partitionBy(*groups, "_base").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    placed = spans.withColumn("_from", F.col("_base") + F.coalesce(F.sum("_in").over(earlier), F.lit(0)))
    mine = F.filter(wanted, lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_in")))
    return durable(placed.withColumn("_ranks", mine).filter(F.size("_ranks") > 0).select(
        *groups, "_n", F.col("_from").alias("_base"), "_in", "_lo", "_hi", "_ranks"))


def _binned(rows: DataFrame, groups: Sequence[str], share: Column) -> DataFrame:
    """Rows (groups, _n, _base, v) counted by bin, `share` being a value's place between 0 and 1."""
    place = F.coalesce(F.least(F.floor(share * BINS), F.lit(BINS - 1)), F.lit(0))
    return rows.groupBy(*groups, "_n", "_base", place.alias("_bin")).agg(
        F.count(F.lit(1)).alias("_in"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))


def ranked_values(df: DataFrame, extent: DataFrame, columns: Sequence[str], probs: Sequence[float],
                  by: Sequence[str] = (), small: int = SMALL_BIN) -> DataFrame:
    """As `exact_quantiles`, for a table whose `extents` are known."""
    groups = [*by, "column"]
    long = _long(df, columns, by)
    # Values up to their mean size lie in even bins; the tails get log bins.
    scale = F.when(F.col("size") > 0, F.col("size")).otherwise(F.lit(1.0))
    low, high = _scaled(F.col("lo"), scale), _scaled(F.col("hi"), scale)
    share = F.when(high > low, (_scaled(F.col("v"), scale) - low) / (high - low))
    rows = long.join(extent, groups).withColumns({"_n": F.col("n"), "_base": F.lit(0).cast("long")})
    settled = []
    while True:
        hits = _hits(_binned(rows, groups, share), groups, probs)
        settled.append(hits.filter("_lo = _hi").select(*groups, "_n", F.explode("_ranks").alias("_rank"), F.col("_lo").alias("v")))
        unsettled = hits.filter("_lo < _hi")
        largest = unsettled.agg(F.max("_in")).first()[0]
        if largest is None:
            break
        spans = unsettled.groupBy(*groups).agg(F.collect_list(F.struct("_n", "_base", "_lo", "_hi", "_ranks")).alias("_spans"))
        inside = F.filter("_spans", lambda s: (F.col("v") >= s["_lo"]) & (F.col("v") <= s["_hi"]))
        rows = long.join(spans, groups).select(*groups, "v", F.inline(inside))
        if largest <= small:
            settled.append(_counted(rows, groups))
            break
        share = (F.col("v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
    # At most two order statistics per wanted quantile reach a group.
    table = reduce(DataFrame.unionByName, settled).groupBy(*groups, "_n").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "v"))).alias("_at"))

    def value(p: Column) -> Column:
        below, above = F.col("_at")[F.floor(p).cast("long")], F.col("_at")[F.ceil(p).cast("long")]
        return below + (above - below) * (p - F.floor(p))

    values = F.transform(F.transform(_listed(probs), lambda p: p * (F.col("_n") - 1)), value)
    return table.select(*groups, values.alias("quantiles"))


def _counted(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The wanted order statistics of small bins, from their counted values."""
    before = W.partitionBy(*groups, "_base").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    counted = rows.groupBy(*groups, "_n", "_base", "_ranks", "v").agg(F.count(F.lit(1)).alias("_c")).withColumn(
        "_from", F.col("_base") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
    mine = F.filter("_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_c")))
    return counted.select(*groups, "_n", F.explode(mine).alias("_rank"), "v")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    small: int = SMALL_BIN) -> DataFrame:
    """One row per group and column that has values, with the array `quantiles`, in the order of
    `probs`. Nulls and NaN are skipped, and rows whose group is null."""
    return ranked_values(df, extents(df, columns, by), columns, probs, by, small)


def quantile_value(df: DataFrame, column: str, prob: float) -> float | None:
    """One quantile of one column as a number."""
    found = exact_quantiles(df, [column], [prob]).first()
    return found["quantiles"][0] if found else None


def quantile_bins(df: DataFrame, columns: dict[str, str], bins: int = 5) -> DataFrame:
    """Add the integer code of each column's quantile interval under the given name.

    Intervals are right-closed with the lowest edge included; equal edges collapse into one.
    """
    probs = [i / bins for i in range(bins + 1)]
    found = exact_quantiles(df, list(columns), probs).collect()  # one row per column
    edges = {r["column"]: sorted(set(r["quantiles"] or [])) for r in found}
    return df.select("*", *[
        interval_code(col(c), edges[c]).alias(out) if edges.get(c) else F.lit(None).cast("int").alias(out)
        for c, out in columns.items()
    ])


def quantile_sketches(df: DataFrame, column: str, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One KLL sketch of the column per group, of a size that does not grow with the rows: a table to
    store, to which later days add their own rows."""
    v = col(column).cast("double")
    return df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*[col(b) for b in by]).agg(
        F.kll_sketch_agg_double(v, k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str], probs: Sequence[float], k: int = SKETCH_K) -> DataFrame:
    """Stored sketches merged into coarser groups: n and the approximate quantiles, one row per group
    and probability."""
    merged = sketches.groupBy(*[col(b) for b in by]).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    asked = F.array(*[F.struct(
        F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs])
    return merged.select(*[col(b) for b in by], F.kll_sketch_get_n_double("sketch").alias("n"), F.inline(asked))
