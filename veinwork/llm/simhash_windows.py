"""Benchmark decontamination by SimHash over item-sized windows.

An item is a sequence of words (A-Z lower-cased); its features are its five-word shingles with
the number of times they occur, and its fingerprint is the 64-bit SimHash of those weighted
shingles. Every window of a document that is as long as an item is fingerprinted the same way,
from running sums over the document's shingles. Fingerprints are cut into BLOCKS blocks; two of
them within RADIUS differ in at most RADIUS // BLOCKS bits of at least one block (of 19 differing
bits spread over four blocks, one block has at most four), so windows and items that are farther
apart in every block are ruled out. Those left within RADIUS are candidates, and the weighted
Jaccard similarity of the shingle counts decides exactly: at least `similarity`.

Windows that hold none of the items' shingles have similarity 0, so they are not fingerprinted; a
stretch is compared with the items whose shingles it holds, in windows of their sizes.

Items are the stated query set. Their shingles, counts and fingerprints are laid out as sorted
arrays of under a kilobyte an item, ITEMS_AT_ONCE of them at a time, and every executor gets them
once; larger sets go over the documents in several passes. Documents are not shuffled.

Null and empty texts match nothing, nor do items without words. An item or document of fewer
than five words has one shingle, all its words. Repeated documents and items are each reported.
Of several windows of a document that match one item, the most similar counts, the first among
equals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.llm.common import WordHashes, arrow_map, ddl, hash_words, mixed, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 4
WIDTH = 64 // BLOCKS
# Items whose arrays a task holds at once, and the characters in them (one longer item is a
# block of its own).
ITEMS_AT_ONCE = 100_000
CHARS_AT_ONCE = 32_000_000
# Windows fingerprinted together, pairs of windows and items compared together, and the gap at
# which sums start anew.
WINDOWS_AT_ONCE = 20_000
PAIRS_AT_ONCE = 1_000_000
GAP = 64


def words_of(text: str | None, known: WordHashes) -> np.ndarray:
    return hash_words((text or "").encode().lower().split(), known)


def bit_signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each shingle's hash."""
    bits = np.unpackbits(mixed(shingles).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(shingles: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash of the `count` shingles from each start (a shingle that repeats counts each time)."""
    low = int(starts[0])
    sums = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bit_signs(shingles[low : int(starts[-1]) + count]), axis=0, dtype=np.int32)])
    at = starts - low
    bits = (sums[at + count] - sums[at]) > 0
    return np.packbits(bits, axis=1).view(np.uint64).reshape(-1)


class ItemTables:
    """What one block of items needs, as flat arrays: shingles and whose they are, counts, fingerprints."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.names = [name for name, _ in items]
        self.words = np.array([len(w) for _, w in items])
        shingles = [shingle_hashes(w, SHINGLE) for _, w in items]
        self.count = np.array([len(s) for s in shingles])
        self.prints = np.array([fingerprints(s, np.array([0]), len(s))[0] for s in shingles], dtype=np.uint64)
        flat = np.concatenate(shingles)
        owner = np.repeat(np.arange(len(items), dtype=np.int32), self.count)
        # Each item's distinct shingles in order, with their counts: from ends[i] to ends[i + 1].
        order = np.lexsort((flat, owner))
        fresh = np.flatnonzero((np.diff(owner[order], prepend=-1) != 0) | (np.diff(flat[order], prepend=flat[order][:1] + np.uint64(1)) != 0))
        self.distinct, self.weight = flat[order][fresh], np.diff(np.append(fresh, len(flat))).astype(np.int32)
        self.ends = np.searchsorted(owner[order][fresh], np.arange(len(items) + 1))
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]

    def near(self, prints: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """(window, item) pairs within RADIUS among the items of `wanted` (a mask), as an array."""
        items = np.flatnonzero(wanted)
        found = []
        step = max(1, PAIRS_AT_ONCE // max(len(items), 1))
        for start in range(0, len(prints), step):
            apart = prints[start : start + step, None] ^ self.prints[items][None, :]
            blocks = [np.bitwise_count(apart >> np.uint64(WIDTH * b) & np.uint64((1 << WIDTH) - 1)) for b in range(BLOCKS)]
            window, item = np.nonzero(np.minimum.reduce(blocks) <= RADIUS // BLOCKS)
            good = np.bitwise_count(apart[window, item]) <= RADIUS
            found.append(np.stack([window[good] + start, items[item[good]]], axis=1))
        return np.concatenate(found) if found else np.zeros((0, 2), np.int64)

    def similarity(self, shingles: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a window's shingle counts with an item's."""
        mine, counts = np.unique(shingles, return_counts=True)
        theirs, weights = (x[self.ends[item] : self.ends[item + 1]] for x in (self.distinct, self.weight))
        at = np.searchsorted(theirs, mine)
        at[at == len(theirs)] = 0
        both = np.minimum(counts, weights[at])[theirs[at] == mine].sum()
        return float(both / (counts.sum() + weights.sum() - both))

    def matches(self, words: np.ndarray, similarity: float) -> Iterator[tuple[int, int, float]]:
        """(item number, first word of the best window, similarity) of one document."""
        best: dict[int, tuple[float, int]] = {}
        for width in range(1, min(SHINGLE, len(words)) + 1):
            self._scan(words, width, similarity, best)
        for item in sorted(best):
            value, start = best[item]
            yield item, start, value

    def _scan(self, words: np.ndarray, width: int, similarity: float, best: dict) -> None:
        """Windows whose shingles have `width` words: five, or all words of a shorter item."""
        suited = self.words >= SHINGLE if width == SHINGLE else self.words == width
        if not width or not suited.any():
            return
        shingles = shingle_hashes(words, width)
        at = np.searchsorted(self.flat, shingles)
        at[at == len(self.flat)] = 0
        hits = np.flatnonzero(self.flat[at] == shingles)
        if not len(hits):
            return
        first = np.searchsorted(self.flat, shingles[hits])
        last = np.searchsorted(self.flat, shingles[hits], side="right")
        touched = np.zeros(len(self.names), dtype=bool)
        for i, j in set(zip(first.tolist(), last.tolist(), strict=True)):
            touched[self.owner[i:j]] = True
        touched &= suited
        for count in np.unique(self.count[touched]).tolist():
            # A shorter document is one window; otherwise every window that covers a hit.
            size = min(count, len(shingles))
            wanted = touched & (self.count == count)
            begin = np.maximum(hits - size + 1, 0)
            end = np.minimum(hits, len(shingles) - size)
            mark = np.zeros(len(shingles) - size + 2, dtype=np.int32)
            np.add.at(mark, begin, 1)
            np.add.at(mark, end + 1, -1)
            starts = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
            for cut in range(0, len(starts), WINDOWS_AT_ONCE):
                for part in _runs(starts[cut : cut + WINDOWS_AT_ONCE]):
                    prints = fingerprints(shingles, part, size)
                    for window, item in self.near(prints, wanted).tolist():
                        start = int(part[window])
                        value = self.similarity(shingles[start : start + size], item)
                        if value >= similarity and (-value, start) < (-best.get(item, (0, 0))[0], best.get(item, (0, 0))[1]):
                            best[item] = (value, start)


def _runs(starts: np.ndarray) -> list[np.ndarray]:
    """Consecutive starts, so that sums run over the covered words only."""
    return np.split(starts, np.flatnonzero(np.diff(starts) > GAP) + 1)


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, in an order of their keys, fetched one block at a time."""
    block, size = [], 0
    rows = items.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    for row in rows.orderBy("k", "t").toLocalIterator():
        block.append((row["k"], row["t"]))
        size += len(row["t"])
        if len(block) >= ITEMS_AT_ONCE or size >= CHARS_AT_ONCE:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
               item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Rows (key, item_key, first_word, n_words, similarity) for every document and item that match."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    schema = f"__key {kind}, __item {item_kind}, first_word long, n_words long, similarity double"
    out = None
    for part in item_blocks(items, item_key, item_text):
        found = arrow_map(rows, _matcher(spark.sparkContext.broadcast(item_arrays(part)), similarity), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.withColumnsRenamed({"__key": key, "__item": item_key})


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
               item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents that match no item, with all their columns; rows are judged one by one."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = f"c{names.index(text)}"
    for part in item_blocks(items, item_key, item_text):
        plain = arrow_map(plain, _cleaner(docs.sparkSession.sparkContext.broadcast(item_arrays(part)), at, similarity), ddl(plain))
    return plain.toDF(*names)


def item_arrays(block: list[tuple[int, str]]) -> dict | None:
    """The fields of the tables of a block of items; tasks get them as they are."""
    known = WordHashes()
    items = [(name, words_of(text, known)) for name, text in block]
    items = [(name, words) for name, words in items if len(words)]
    return vars(ItemTables(items)) if items else None


def _tables(arrays: dict | None) -> ItemTables | None:
    if arrays is None:
        return None
    tables = ItemTables.__new__(ItemTables)
    vars(tables).update(arrays)
    return tables


def _cleaner(shared, at: str, similarity: float):
    known = WordHashes()

    def block(columns: dict) -> dict:
        tables = _tables(shared.value)
        clean = pa.array([
            tables is None or next(tables.matches(words_of(text, known), similarity), None) is None
            for text in columns[at].to_pylist()
        ], pa.bool_())
        return {name: column.filter(clean) for name, column in columns.items()}

    return block


def _matcher(shared, similarity: float):
    known = WordHashes()

    def block(columns: dict) -> dict | None:
        tables = _tables(shared.value)
        out = {"__key": [], "__item": [], "first_word": [], "n_words": [], "similarity": []}
        keys = columns["__key"].to_pylist()
        for key, text in zip(keys, columns["__text"].to_pylist(), strict=True):
            words = words_of(text, known)
            for item, start, value in tables.matches(words, similarity) if tables else ():
                out["__key"].append(key)
                out["__item"].append(tables.names[item])
                out["first_word"].append(start)
                out["n_words"].append(min(int(tables.words[item]), len(words)))
                out["similarity"].append(value)
        return out if out["__key"] else None

    return block
