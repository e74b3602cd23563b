"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Rows that one Arrow batch may hold. A batch of very long texts stays small this way.
BATCH_ROWS = 512


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`df` with its columns named by their places, which no column of an operator is called, and
    the place of each name."""
    places = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*places.values()), places


def digest_order(column: str):
    """A fixed pseudo-random order of rows by a key."""
    return F.xxhash64(F.col(column).cast("string"))


def arrow_map(df: DataFrame, function: Callable[[dict], dict | None], schema: str,
              rows: int = BATCH_ROWS) -> DataFrame:
    """Apply `function` to the columns of small row blocks, as Arrow arrays by name.

    The function returns lists or arrays by name, or None for no rows. A block is a slice of at
    most `rows` rows, so that what a task holds does not depend on the session's Arrow batches.
    """
    fields = [(f.name, to_arrow_type(f.dataType)) for f in T.StructType.fromDDL(schema)]
    names = [name for name, _ in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                piece = batch.slice(start, rows)
                out = function(dict(zip(piece.schema.names, piece.columns, strict=True)))
                if out is not None:
                    yield pa.RecordBatch.from_arrays([_typed(out[n], kind) for n, kind in fields], names=names)

    return df.mapInArrow(run, schema)


def _typed(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def ddl(df: DataFrame) -> str:
    """The columns of `df` as a schema text for `arrow_map`."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    BOUND = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hash_words(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of `width` words; of the whole run where there are fewer."""
    width = min(width, len(words))
    if not width:
        return words[:0]
    count = len(words) - width + 1
    out = np.full(count, np.uint64(0x9E3779B97F4A7C15 + seed), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mixed(out * np.uint64(0x9FB21C651E98DF25) + words[k : k + count])
    return out
