"""Shards cut from a Hilbert-curve order of several metadata dimensions.

Each dimension is quantised to 2^bits levels by its own quantiles, texts by their whole values; the levels are coordinates of
a point, and rows are ordered by the place of their point on the Hilbert curve. Rows that are
close in all dimensions lie close in that order, so every shard covers narrow ranges of each
dimension and a reader prunes shards by their minima and maxima. Shards are runs of that order
whose row counts differ by at most one (the law `rows`).

A point that many rows share is no hot group: the order goes on by the key and the other
columns, rows are dealt by ranges of that whole order, and ranks come from positions inside a
range plus the number of rows in the ranges before.

Nulls of a dimension take level 0. Equal rows may swap places, which
changes nothing. An empty table gives no rows. Columns are carried through, and the names added
(`shard`, `slot`) replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veinwork.llm.common import numbered
from veinwork.session import durable

PLACE = "__curve"
SEQUENCE = "__sequence"


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates below 2^bits, one per row.

    The transform of Skilling (2004): undo the excess rotations, then Gray-code the transpose.
    """
    x = [points[:, i].astype(np.int64).copy() for i in range(points.shape[1])]
    n = len(x)
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i in range(n):
            high = (x[i] & step) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(high, x[i], x[i] ^ swap)
        step >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    step = 1 << (bits - 1)
    while step > 1:
        turn ^= np.where((x[n - 1] & step) != 0, step - 1, 0)
        step >>= 1
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for one in x:
            place = place << 1 | ((one ^ turn) >> bit & 1)
    return place


def _text_cuts(df: DataFrame, name: str, levels: int) -> list[str]:
    """The values of a text column at which the shares 1/levels, 2/levels, ... of its rows end.

    Values are counted first, so a common one is a single row; whole values are compared, in runs
    that a range partitioning cuts, and a run's place among all rows is the sum of those before it.
    """
    counted = df.groupBy(F.col(name).alias("value")).count().filter("value is not null")
    ranged = durable(counted.repartitionByRange(_tasks(df), "value").withColumn("run", F.spark_partition_id()))
    sums = sorted((r["run"], r["n"]) for r in ranged.groupBy("run").agg(F.sum("count").alias("n")).collect())
    before, total = [], 0
    for run, n in sums:
        before += [F.lit(run), F.lit(total)]
        total += n
    if not total:
        return []
    within = F.sum("count").over(Window.partitionBy("run").orderBy("value"))
    through = F.element_at(F.create_map(*before), F.col("run")) + within
    share = lambda rows: F.floor(rows * levels / F.lit(total))
    ends = ranged.select("value", "count", through.alias("through")).filter(share(F.col("through")) > share(F.col("through") - F.col("count")))
    return sorted((r["value"] for r in ends.select("value").collect()), key=str.encode)  # `levels` at most


def curve_order(df: DataFrame, dimensions: Sequence[str], bits: int = 5, place: str = PLACE) -> DataFrame:
    """The rows with `place`, their index on the curve of `dimensions`.

    Cut points (at most 2^bits for each dimension) are approximate quantiles of numbers, found in
    one pass with sketches of a fixed size, and quantiles of the whole values of texts.
    """
    levels = 1 << bits
    shares = [i / levels for i in range(1, levels)]
    texts = {d for d in dimensions if isinstance(df.schema[d].dataType, T.StringType)}
    measures = {d: F.col(d) if d in texts else F.coalesce(F.col(d).cast("double"), F.lit(float("-inf"))) for d in dimensions}
    numbers = [d for d in dimensions if d not in texts]
    found = df.agg(*[
        F.percentile_approx(measures[d], shares, 10_000).alias(f"q{i}") for i, d in enumerate(numbers)
    ]).first() if numbers else ()
    cuts = {d: sorted(set(found[i] or ())) for i, d in enumerate(numbers)} | {d: _text_cuts(df, d, levels) for d in texts}

    def level(d: str) -> Column:
        """A number above a cut is beyond it; a text that is a cut begins the level after it."""
        beyond = [measures[d] >= F.lit(e) if d in texts else measures[d] > F.lit(e) for e in cuts[d]]
        steps = [F.coalesce(b, F.lit(False)).cast("int") for b in beyond]
        return F.least(reduce(lambda a, b: a + b, steps, F.lit(0)), F.lit(levels - 1))

    @F.pandas_udf("long")
    def on_curve(*coordinates: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.column_stack(coordinates), bits))

    return df.withColumn(place, on_curve(*[level(d) for d in dimensions]))


def assign_shards(df: DataFrame, dimensions: Sequence[str], shards: int, order: Sequence[str],
                  bits: int = 5) -> DataFrame:
    """The rows with `shard` (int) and `slot` (long, gapless from 0 in each shard).

    `order` names the columns that break ties of the curve; rows equal in all of them are
    interchangeable. Carry narrow rows: what is dealt out is what `df` holds.
    """
    given = df.drop("shard", "slot")
    plain, at = numbered(given)
    order = [at[c] for c in order]
    placed = curve_order(plain, [at[d] for d in dimensions], bits)
    dealt = durable(
        placed.repartitionByRange(_tasks(df), PLACE, *order)
        .sortWithinPartitions(PLACE, *order)
        .withColumn(SEQUENCE, F.monotonically_increasing_id())
    )
    # monotonically_increasing_id holds the partition above bit 33 and the position below.
    part, position = F.shiftright(SEQUENCE, 33), F.col(SEQUENCE).bitwiseAND((1 << 33) - 1)
    counts = {r[0]: r[1] for r in dealt.groupBy(part.alias("p")).count().collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p] = total
        total += counts[p]
    if not total:
        return given.limit(0).withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    offsets = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    rank = F.element_at(offsets, part.cast("int")) + position
    base, extra = divmod(total, shards)
    edge = extra * (base + 1)  # the first `extra` shards hold one row more
    shard = F.when(rank < edge, F.floor(rank / (base + 1))).otherwise(
        extra + F.floor((rank - edge) / max(base, 1))
    )
    start = F.when(shard < extra, shard * (base + 1)).otherwise(edge + (shard - extra) * base)
    return dealt.withColumns({"shard": shard.cast("int"), "slot": (rank - start).cast("long")}).drop(PLACE, SEQUENCE).toDF(
        *given.columns, "shard", "slot")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, its rows in slot order, with statistics that readers prune by."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
