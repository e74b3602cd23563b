"""Fill-in-middle transformation, cut at token boundaries found by rank.

A token is a run of white space and the run of other characters after it; white space at the end
of a text is a token of its own. The ends of a text's tokens form a set of offsets in code points,
kept the way roaring bitmaps keep integers: offsets that agree above their low 16 bits share a
container, which is a sorted array, a bitmap or a list of runs, whichever is smallest, and
cumulative cardinalities tell how many offsets come before each container. The offset after k
tokens is a selection by rank: a search in the cumulative cardinalities finds the container, and
a local selection finds the member.

Two numbers drawn from the id's digest choose after how many tokens the middle begins and ends,
a third whether the text is transformed, a fourth which of the two orders it takes. Drawing,
cutting, joining and restoring are DataFrame functions; Python finds the two offsets.

A null text counts as empty. Empty texts and texts that hold a mark stay as they are (form
`plain`), so the marks of an output are always its own and the text can be restored. A null id
draws from the seed alone. Repeated rows give repeated results, an empty table gives none. Columns
other than id and text are not read. A text is held whole in its task, so its length is bounded by
what a row may have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What precedes each part of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

LOW_BITS = 16
LOW = (1 << LOW_BITS) - 1


class ArrayContainer:
    """Members as a sorted array."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.values[rank])

    def members(self) -> np.ndarray:
        return self.values


class BitmapContainer:
    """Members as bits of words, with the number of bits set before each word."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(LOW + 1, dtype=bool)
        bits[values] = True
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, rank: int) -> int:
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        word = int(self.words[at])
        for _ in range(rank - int(self.before[at])):
            word &= word - 1  # drops the lowest bit
        return at * 64 + (word & -word).bit_length() - 1

    def members(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


class RunContainer:
    """Members as runs of consecutive values, with the number of members before each run."""

    def __init__(self, values: np.ndarray):
        first = np.flatnonzero(np.diff(values, prepend=-2) != 1)
        self.starts = values[first].astype(np.uint16)
        self.before = np.append(first, len(values))

    def select(self, rank: int) -> int:
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.starts[at]) + rank - int(self.before[at])

    def members(self) -> np.ndarray:
        length = np.diff(self.before)
        return np.repeat(self.starts.astype(np.int64) - self.before[:-1], length) + np.arange(self.before[-1])


def container(values: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of sorted values below 2^16: two bytes a value, four a run, or 8 KB of bits."""
    runs = 1 + int(np.count_nonzero(np.diff(values) != 1))
    sizes = [(2 * len(values), ArrayContainer), ((LOW + 1) // 8, BitmapContainer), (4 * runs, RunContainer)]
    return min(sizes, key=lambda s: s[0])[1](values)


class BoundarySet:
    """Ascending offsets in containers, with selection by rank."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> LOW_BITS
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.keys = high[first]
        self.containers = [container(part) for part in np.split(offsets & LOW, first[1:])] if len(offsets) else []
        self.before = np.append(first, len(offsets))

    def __len__(self) -> int:
        return int(self.before[-1])

    def __iter__(self) -> Iterator[int]:
        for key, held in zip(self.keys.tolist(), self.containers, strict=True):
            yield from ((key << LOW_BITS) + held.members().astype(np.int64)).tolist()

    def select(self, rank: int) -> int:
        """The offset that `rank` others precede."""
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        return (int(self.keys[at]) << LOW_BITS) + self.containers[at].select(rank - int(self.before[at]))

    def after(self, tokens: int) -> int:
        """The offset at which so many tokens end."""
        return self.select(tokens - 1) if tokens else 0


def boundaries(text: str) -> np.ndarray:
    """Where tokens end, in code points."""
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    white = (code == 0x20) | ((code >= 0x09) & (code <= 0x0D))
    ends = np.flatnonzero(~white & np.append(white[1:], True)) + 1
    return np.append(ends, len(code)) if len(code) and white[-1] else ends


def _cut(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Number of tokens, and the offsets at which prefix and middle end, for drawn numbers."""
    count, first, second = [], [], []
    for value, x, y in zip(text, one.to_pylist(), two.to_pylist(), strict=True):
        held = BoundarySet(boundaries(value.as_py()))
        n = len(held)
        low, high = sorted((x % (n + 1), y % (n + 1)))
        count.append(n)
        first.append(held.after(low))
        second.append(held.after(high))
    kinds = [pa.array(v, pa.int64()) for v in (count, first, second)]
    return pa.StructArray.from_arrays(kinds, names=["n", "first", "second"])


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50,
              spm_percent: int = 80) -> DataFrame:
    """Per row: the key, n (tokens), form, prefix_chars, middle_chars (null if plain) and output.

    `percent` of the texts are transformed, `spm_percent` of those have their suffix first.
    """
    cuts = F.arrow_udf(_cut, "n long, first long, second long")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumns({f"h{i}": h for i, h in enumerate(draws(F.col("key"), seed), 1)})
    rows = rows.withColumn("cut", cuts("text", "h1", "h2"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    first, second = F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    parts = rows.select(
        "key", "text", F.col("cut.n").alias("n"), form.alias("form"), first.alias("first"), (second - first).alias("inner"),
        F.substring("text", F.lit(1), first).alias("prefix"), F.substring("text", first + 1, second - first).alias("middle"),
        F.substring("text", second + 1, F.char_length("text")).alias("suffix"),
    )
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    shown = lambda column: F.when(F.col("form") != "plain", F.col(column).cast("long"))
    return parts.select(
        F.col("key").alias(key), "n", "form", shown("first").alias("prefix_chars"), shown("inner").alias("middle_chars"),
        F.when(F.col("form") == "spm", spm).when(F.col("form") == "psm", psm).otherwise(F.col("text")).alias("output"),
    )


def restored(output: str = "output", form: str = "form") -> Column:
    """The text of an output. No part holds a mark, so each mark is found where it was set."""

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(PREFIX) + 1), F.char_length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.char_length(one) + len(second) + 1, F.char_length(body))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substring(rest, F.char_length(two) + len(MIDDLE) + 1, F.char_length(rest))

    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    return F.when(F.col(form) == "spm", spm).when(F.col(form) == "psm", psm).otherwise(F.col(output))
