"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by a random rotation and stored once as a code: the signs of its
coordinates in packed bits, with a correction factor, the inner product of the turned vector with
its own code. As a query it is stored in bytes, rounded at random up or down so that the mean is
right. The inner product of a query with a code, divided by the code's factor, estimates the inner
product of the two vectors without bias; factor and rounding bound the error with any wanted
confidence. Pairs whose estimate lies below the threshold by more than that bound are done; the
others are recomputed exactly, in doubles.

Pairs are looked for in buckets of sign bits of further rotations: the number of tables is such
that two vectors just at the threshold meet with probability RECALL in at least one (closer ones
more often), and bits so that a bucket of unrelated vectors stays near BUCKET rows. A pair that
meets in several tables counts in the first. A bucket over BLOCK rows is cut into blocks, and
every pair of blocks is a group of its own, so a bucket of any size spreads over tasks and no
pair is left out. Only codes go to the buckets. Where a group leaves pairs open, the vectors of
those pairs, each once, go to the same group again. Tasks return a count and one link to a local
root per vector, not pairs.

Equal vectors are one class, compared once and counted as often as they occur. Vectors that are
null, empty or zero, or hold null or non-finite components, link with nothing, nor do vectors
of different lengths. A component's name is its smallest non-null key.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.llm.common import arrow_map
from veinwork.llm.components import components
from veinwork.session import discard, durable

THRESHOLD = 0.9
RECALL = 0.98
BUCKET = 64
BLOCK = 1024
# Standard deviations of the estimate's error that the bound allows.
CONFIDENCE = 4.0
# Bits of a word of a code, and the largest level of a query's coordinate.
WORD = 64
LEVELS = 255
# Pairs recomputed at once.
PAIRS = 65_536
CODE = ("bits", "factor", "low", "step", "levels")
GROUP = ("number", "bucket", "one", "two")


def rotation(size: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([2025, size, number]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def plan_tables(count: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a bucket key, number of tables) for so many vectors."""
    bits = max(4, math.ceil(math.log2(max(count, 2) / BUCKET)))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def bucket_keys(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A key per vector and table, from the signs of rotated coordinates."""
    size = units.shape[1]
    need = bits * tables
    signs = np.concatenate([units @ rotation(size, 1 + i).T > 0 for i in range(-(-need // size))], axis=1)[:, :need]
    return signs.reshape(len(units), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _turned(units: np.ndarray) -> np.ndarray:
    """The vectors under the rotation of the codes, with zeros added up to whole words of bits."""
    size = max(WORD, -(-units.shape[1] // WORD) * WORD)
    wide = np.zeros((len(units), size))
    wide[:, : units.shape[1]] = units
    return wide @ rotation(size, 0).T


def encode(units: np.ndarray) -> dict[str, np.ndarray]:
    """For each unit vector: bits and factor of its code; low, step and levels of it as a query."""
    turned = _turned(units)
    size = turned.shape[1]
    low, high = turned.min(axis=1), turned.max(axis=1)
    step = np.maximum((high - low) / LEVELS, 1e-12)
    drawn = np.random.default_rng(2025).random(turned.shape)
    levels = np.minimum((turned - low[:, None]) / step[:, None] + drawn, LEVELS).astype(np.uint8)
    return {"bits": np.packbits(turned > 0, axis=1), "factor": np.abs(turned).sum(axis=1) / math.sqrt(size),
            "low": low, "step": step, "levels": levels}


def compare_codes(queries: dict[str, np.ndarray], codes: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries with coded vectors, and the bound on each one's error."""
    signs = np.unpackbits(codes["bits"], axis=1).astype(np.float32) * 2 - 1
    size = signs.shape[1]
    values = queries["levels"].astype(np.float32) * queries["step"][:, None].astype(np.float32) + queries["low"][:, None].astype(np.float32)
    factor = codes["factor"].astype(np.float32)
    spread = np.sqrt(np.maximum(1 - factor**2, 0) / (size - 1))
    error = CONFIDENCE * (spread + queries["step"][:, None].astype(np.float32) / 2) / factor
    return (values @ signs.T) / (factor * np.float32(math.sqrt(size))), error


def estimates(units: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of `units` with `others` as their codes tell, and the bound on each one's error."""
    return compare_codes(encode(units), encode(others))


def _unit(vector: list | None) -> np.ndarray | None:
    if not vector or None in vector:
        return None
    values = np.array(vector, dtype=np.float64)
    if not np.isfinite(values).all() or not values.any():
        return None
    values = values / np.abs(values).max()  # so that the norm neither vanishes nor overflows
    return values / np.sqrt(values @ values)


def _rows(vectors: DataFrame) -> DataFrame:
    """Per row: key, class (null for a vector that links with nothing), unit (doubles as bytes); a stored table."""

    def block(columns: dict) -> dict:
        units = [_unit(v) for v in columns["vector"].to_pylist()]
        as_bytes = [None if u is None else (u + 0.0).tobytes() for u in units]
        return {"key": columns["key"], "unit": as_bytes,
                "class": [None if b is None else xxhash.xxh3_64_intdigest(b) - (1 << 63) for b in as_bytes]}

    return durable(arrow_map(vectors, block, "key long, unit binary, class long"))


def _coded(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Per class its code, its form as a query, its length, and the bucket key of each table; a stored table."""

    def block(columns: dict) -> dict:
        units = [np.frombuffer(b) for b in columns["unit"].to_pylist()]
        out: dict = {"class": columns["class"], **{n: [None] * len(units) for n in ("size", "keys", *CODE)}}
        for size in {len(u) for u in units}:
            at = [i for i, u in enumerate(units) if len(u) == size]
            some = np.stack([units[i] for i in at])
            code, keys = encode(some), bucket_keys(some, bits, tables).tolist()
            for k, i in enumerate(at):
                out["size"][i] = size
                out["keys"][i] = [key << 16 | size % (1 << 16) for key in keys[k]]
                for name in CODE:
                    value = code[name][k]
                    out[name][i] = value.tobytes() if name in ("bits", "levels") else float(value)
        return out

    return durable(arrow_map(
        classes.select("class", "unit"), block,
        "class long, size int, keys array<long>, bits binary, factor double, low double, step double, levels binary"))


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.uint8) for b in column.to_pylist()])


def _opener(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """Of a group of coded vectors the pairs that the codes leave open: for each vector its partners."""

    def compare(table: pa.Table) -> pa.Table:
        size = table["size"].to_numpy()
        table = table.filter(pa.array(size == size[0]))  # lengths that differ by 2^16 share a key
        name, block = table["class"].to_numpy(), table["block"].to_numpy()
        code = {n: _bytes(table[n]) if n in ("bits", "levels") else table[n].to_numpy() for n in CODE}
        earlier = np.array(table["earlier"].to_pylist(), dtype=np.int64).reshape(len(name), -1)
        first, second = table["one"][0].as_py(), table["two"][0].as_py()
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for cut in range(0, len(left), BLOCK):
            part = left[cut : cut + BLOCK]
            for other in range(0, len(right), BLOCK):
                that = right[other : other + BLOCK]
                estimate, error = compare_codes({n: v[part] for n, v in code.items()}, {n: v[that] for n, v in code.items()})
                i, j = np.nonzero(estimate >= np.float32(threshold) - error)
                i, j = part[i], that[j]
                fresh = i < j if first == second else np.ones(len(i), dtype=bool)
                i, j = i[fresh], j[fresh]
                fresh = ~(earlier[i] == earlier[j]).any(axis=1)
                found.append((i[fresh], j[fresh]))
        i, j = (np.concatenate([f[k] for f in found]) for k in (0, 1)) if found else (np.zeros(0, int),) * 2
        order = np.argsort(i, kind="stable")
        owners, counts = np.unique(i[order], return_counts=True)
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        same = {n: pa.array([table[n][0].as_py()] * len(owners), table[n].type) for n in GROUP} if len(name) else {}
        return pa.table({**same, "class": name[owners], "partners": pa.ListArray.from_arrays(ends, pa.array(name[j[order]], pa.int64()))})

    return compare


def _verifier(threshold: float) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """The open pairs of a group recomputed from the vectors: links and a root within the group."""

    def verify(_: tuple, pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        name = vectors["class"].to_numpy()
        order = np.argsort(name)
        units = np.stack([np.frombuffer(b) for b in vectors["unit"].to_pylist()])
        weight = vectors["weight"].to_numpy()
        at = lambda names: order[np.searchsorted(name, names, sorter=order)]
        partners = pairs["partners"].combine_chunks()
        i = np.repeat(at(pairs["class"].to_numpy()), partners.value_lengths().to_numpy())
        j = at(partners.flatten().to_numpy())
        good = np.zeros(len(i), dtype=bool)
        for cut in range(0, len(i), PAIRS):
            some = slice(cut, cut + PAIRS)
            good[some] = np.einsum("ij,ij->i", units[i[some]], units[j[some]]) >= threshold
        i, j = i[good], j[good]
        links = np.bincount(i, weight[j], len(name)) + np.bincount(j, weight[i], len(name))
        root = np.arange(len(name))
        while True:  # least index reachable inside the group
            before = root.copy()
            np.minimum.at(root, i, before[j])
            np.minimum.at(root, j, before[i])
            root = root[root]
            if (root == before).all():
                break
        some = links > 0
        return pa.table({"class": name[some], "links": links[some].astype(np.int64), "root": name[root[some]]})

    return verify


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Per row: the key, n_links, component_id and kept (whether the row names its component)."""
    rows = _rows(vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector")))
    classes = durable(
        rows.filter(F.col("class").isNotNull()).groupBy("class")
        .agg(F.min("key").alias("key"), F.count("*").alias("weight"), F.first("unit").alias("unit"))
    )
    bits, tables = plan_tables(classes.count(), threshold)
    coded = _coded(classes, bits, tables)
    bucketed = coded.select("class", F.posexplode("keys").alias("number", "bucket"))
    sizes = durable(bucketed.groupBy("number", "bucket").count().filter("count > 1"))
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    spread = bucketed.join(sizes, ["number", "bucket"]).select(
        "class", "number", "bucket", F.pmod(F.xxhash64("class"), blocks).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("partner"),
    )
    pairs = spread.select(
        "class", "number", "bucket", "block", F.least("block", "partner").alias("one"), F.greatest("block", "partner").alias("two")
    )
    # A vector's keys in the tables before this one tell which pairs have met already.
    met = pairs.join(coded, "class").withColumn("earlier", F.slice("keys", F.lit(1), F.col("number"))).drop("keys")
    left = durable(met.groupBy(*GROUP).applyInArrow(
        _opener(threshold), "number int, bucket long, one int, two int, class long, partners array<long>"))
    # Fresh aliases, as both sides come from one table.
    held = left.select(*[F.col(c).alias(c) for c in GROUP], F.explode(F.array_union(F.array("class"), "partners")).alias("class")).distinct()
    vectors = held.join(classes.select("class", "unit", "weight"), "class")
    found = durable(left.groupBy(*GROUP).cogroup(vectors.groupBy(*GROUP)).applyInArrow(
        _verifier(threshold), "class long, links long, root long"))
    discard(coded, sizes, left)
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    labels = components(found.filter("`class` != root").select(F.col("class").alias("a"), F.col("root").alias("b")))
    inside = classes.select("class", "key").join(labels.withColumnRenamed("node", "class"), "class")
    names = inside.groupBy("component").agg(F.min("key").alias("name"))
    named = classes.select("class", "weight", F.col("key").alias("first")).join(links, "class", "left").join(
        inside.select("class", "component").join(names, "component"), "class", "left"
    )
    out = rows.select("key", "class").join(named, "class", "left").select(
        F.col("key").alias(key),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("weight") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("name", "first", "key").alias("component_id"),
    )
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
