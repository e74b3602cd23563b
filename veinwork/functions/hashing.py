"""A pseudo-random order that depends on the row alone, not on partitions or engines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 2025
# A column that holds the digest of the keys in half the bytes, in place of the keys.
DIGEST = "_digest"


def hash_key(keys: Sequence[str], seed: int = DEFAULT_SEED) -> Column:
    """Hex digest of the key columns and the seed; sorting by it shuffles the rows fairly. Of the column
    DIGEST alone it is the digest that the column holds."""
    if list(keys) == [DIGEST]:
        return F.lower(F.hex(F.col(DIGEST)))
    return F.md5(F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in keys], F.lit(str(seed))))


def digest(keys: Sequence[str], seed: int = DEFAULT_SEED) -> Column:
    """The column DIGEST: rows that carry it are ranked, sampled and split as by `keys`, which they need not carry."""
    return F.unhex(hash_key(keys, seed)).alias(DIGEST)
