"""Stratified samples, splits and folds. All exact in size and reproducible by seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.functions.hashing import DEFAULT_SEED
from veinwork.operators.ranking import label_by_cuts, stratified_rank, stratum_cuts
from veinwork.operators.shape import col, drop_null

SAMPLE_ROWS = 10_000


def stratified_sample(
    df: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    size: int = SAMPLE_ROWS,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """About `size` rows, each stratum giving its share rounded half to even.

    A row whose stratum is null belongs to no stratum and is left out, at any size. Where
    `size` is no less than the table, every row that has a stratum is in the sample.
    """
    rows = df.count()
    kept = drop_null(df, by)
    if rows == 0:
        return kept
    fraction = min(1.0, size / rows)
    cuts = stratum_cuts(kept, by, keys, lambda n: [F.rint(n * F.lit(fraction))], rows, seed)
    marked = label_by_cuts(kept, cuts, by, keys, ["in"], "out", "_part", seed)
    return marked.filter("_part = 'in'").drop("_part")


def bernoulli_sample(df: DataFrame, by: str, size: int = SAMPLE_ROWS, seed: int = DEFAULT_SEED) -> DataFrame:
    """The fast option: each row of a stratum is drawn on its own with the stratum's fraction, in one
    pass without a sort or shuffle. Sizes vary around their expectation. `by` has few values; each
    stratum of fewer rows than an even share of `size` is taken whole."""
    counts = {r[0]: r[1] for r in df.filter(col(by).isNotNull()).groupBy(col(by)).count().collect()}  # a row per stratum
    share = size / max(len(counts), 1)
    return df.sampleBy(col(by), {value: min(1.0, share / n) for value, n in counts.items()}, seed)


def with_stratum(
    df: DataFrame,
    preferred: Sequence[str],
    composite: Sequence[str],
    out: str = "stratum",
) -> DataFrame:
    """Add the stratum column: the first preferred column present, else the composite ones
    joined by `_`."""
    for name in preferred:
        if name in df.columns:
            return df.withColumn(out, col(name).cast("string"))
    return df.withColumn(out, F.concat_ws("_", *[col(c).cast("string") for c in composite]))


def train_test_split(
    df: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    test: float = 0.3,
    out: str = "split",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    cuts = stratum_cuts(df, by, keys, lambda n: [F.rint(n * F.lit(test))], df.count(), seed)
    return label_by_cuts(df, cuts, by, keys, ["test"], "train", out, seed)


def train_validation_test_split(
    df: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    test: float = 0.2,
    validation_of_rest: float = 0.25,
    out: str = "split",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The test share is cut first, then the validation share of what remains."""

    def quotas(n):
        first = F.rint(n * F.lit(test))
        return [first, first + F.rint((n - first) * F.lit(validation_of_rest))]

    cuts = stratum_cuts(df, by, keys, quotas, df.count(), seed)
    return label_by_cuts(df, cuts, by, keys, ["test", "validation"], "train", out, seed)


def stratified_folds(
    df: DataFrame,
    by: Sequence[str],
    keys: Sequence[str],
    folds: int = 5,
    out: str = "fold",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Deal the rows of each stratum to folds 0..folds-1 in turn."""
    ranked = stratified_rank(df, by, keys, df.count(), "_rank", seed)
    return ranked.withColumn(out, F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank")
