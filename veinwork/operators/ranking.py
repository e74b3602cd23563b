"""Exact ranks in hash order within strata, without sorting a whole stratum in one task.

The hash digest is uniform, so its leading hex digits cut each stratum, however large, into
even buckets. Bucket counts tell how many rows precede a bucket; only rows inside a bucket
are ever sorted together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veinwork.functions.hashing import DEFAULT_SEED, hash_key
from veinwork.operators.shape import col
from veinwork.session import durable

_BUCKET_ROWS = 100_000
_MAX_DIGITS = 8


def _digits(rows: int) -> int:
    """Hex digits of the bucket prefix, such that a bucket holds about _BUCKET_ROWS rows at most."""
    digits = 1
    while digits < _MAX_DIGITS and rows / 16**digits > _BUCKET_ROWS:
        digits += 1
    return digits


def _order(keys: Sequence[str]) -> Column:
    return F.struct(F.col("_hash"), *[col(k) for k in keys])


def _spans(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per (stratum, bucket), rows of the stratum in earlier buckets, rows of the stratum."""
    stratum = W.partitionBy(*[col(b) for b in by])
    earlier = stratum.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    return (
        hashed.groupBy(*[col(b) for b in by], "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(stratum))
    )


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality on all names, so that a null stratum is a stratum."""
    condition = F.lit(True)
    for n in names:
        condition = condition & left[f"`{n}`"].eqNullSafe(right[f"`{n}`"])
    return condition


def stratum_cuts(
    df: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    quotas: Callable[[Column], Sequence[Column]],
    rows: int,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Per stratum the last row, in hash order, within each cumulative quota.

    `quotas` maps the stratum size to rising ranks. The result has one row per stratum with
    `cut_0`, `cut_1`, ... as (hash, keys) structs, null where the quota is 0. It needs one
    counting pass and one pass that shuffles only the rows of the buckets a quota falls in.
    """
    hashed = df.withColumn("_hash", hash_key(keys, seed)).select(
        *[col(b) for b in by], F.substring("_hash", 1, _digits(rows)).alias("_bucket"), _order(keys).alias("_at")
    )
    ranks = [q.cast("long") for q in quotas(F.col("_total"))]
    hits = durable(
        _spans(hashed, by)
        .select(
            *[col(b) for b in by], "_bucket", "_n", "_before",
            F.posexplode(F.array(*ranks)).alias("_cut", "_rank"),
        )
        .filter("_rank > _before and _rank <= _before + _n")
        .select(*[col(b) for b in by], "_bucket", "_cut", (F.col("_rank") - F.col("_before")).alias("_place"))
    )
    inside = hashed.join(hits, _same(hashed, hits, [*by, "_bucket"])).select(
        *[hits[f"`{b}`"] for b in by], "_cut", "_place", "_at"
    )
    place = W.partitionBy(*[col(b) for b in by], "_cut").orderBy("_at")
    return (
        inside.withColumn("_row", F.row_number().over(place))
        .filter("_row = _place")
        .groupBy(*[col(b) for b in by])
        .agg(*[
            F.max(F.when(F.col("_cut") == i, F.col("_at"))).alias(f"cut_{i}")
            for i in range(len(ranks))
        ])
    )


def label_by_cuts(
    df: DataFrame,
    cuts: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    labels: Sequence[str],
    last: str,
    out: str,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Label each row by the first cut it does not exceed. Row-wise, no shuffle of the rows
    as long as the strata are few enough to broadcast."""
    cuts = durable(cuts)
    at = F.struct(hash_key(keys, seed).alias("_hash"), *[col(k) for k in keys])
    left = df.withColumn("_at", at)
    chain = F
    for i, label in enumerate(labels):
        chain = chain.when(F.col("_at") <= F.col(f"cut_{i}"), label)
    return left.join(cuts, _same(left, cuts, by), "left").select(
        *[left[f"`{c}`"] for c in df.columns], chain.otherwise(last).alias(out)
    )


def stratified_rank(
    df: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    rows: int,
    out: str = "rank",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """1-based rank of every row in its stratum by (hash, keys)."""
    hashed = df.withColumn("_hash", hash_key(keys, seed)).withColumn(
        "_bucket", F.substring("_hash", 1, _digits(rows))
    )
    # Stored: Spark knows that the counts are few, and does not shuffle the placed rows to join them.
    spans = durable(_spans(hashed, by).drop("_n", "_total"))
    # Single columns, of which the digest is sorted by its first bytes; a struct is compared field by field.
    inner = W.partitionBy(*[col(b) for b in by], "_bucket").orderBy("_hash", *[col(k) for k in keys])
    placed = hashed.withColumn("_row", F.row_number().over(inner))
    return placed.join(spans, _same(placed, spans, [*by, "_bucket"])).select(
        *[placed[f"`{c}`"] for c in df.columns], (F.col("_row") + F.col("_before")).alias(out)
    )
