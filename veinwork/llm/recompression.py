"""Removal of long passages that an earlier document holds, by recompression.

Words are symbols. A round of recompression first names maximal runs of equal symbols, then
names pairs of neighbours whose left symbol falls into one half of the alphabet and whose right
symbol into the other; names are hashes of what they stand for, so every task gives equal
substrings the same names, except near their ends, where a neighbour outside the substring may
have a say. For every symbol the words that decided it and its boundaries are known exactly. A window
of WINDOW words is anchored at one of the symbols of the highest round that the window alone
decides (in round 0 every word is one): the one whose name has the least hash, the first among
equals. So equal windows have the same anchor at the same place, and neighbouring windows
mostly share theirs.

Windows of a document that share an anchor, and whose distances to it fall into one stretch of
STRETCH words, are one row with two names: the narrow one (the anchor and the words around it
that every window at such a distance holds) and the wide one (all words that the row's windows
cover). Then

* rows whose wide name an earlier document holds are covered as a whole;
* rows that are first with their wide name, but not alone with their narrow one, have their
  windows compared one by one: these are the edges of passages and of edited copies;
* all others hold text of their own.

Only the rows of the second kind are looked into, only one for each wide name, so groups of
copies cost what one copy costs. Every step groups by a name with partial aggregation or joins
on it; nothing gathers the documents of a passage.

A window counts as covered when its words also start in a document with a smaller key, judged
on the input. Documents with null keys come after all others and never cover one another; nor
do documents with the same key. Null texts have no words. Texts of fewer than WINDOW words keep
all of them. Names have 128 bits in two independent halves.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.llm.common import WordHashes, arrow_map, hash_words, mixed
from veinwork.session import durable

WINDOW = 50
ROUNDS = 3
STRETCH = 16
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
OTHER_BASE = np.uint64(0xD1342543DE82EF95 | 1)
FAR = np.int64(1) << np.int64(40)


class Sums:
    """Hashes of any stretch of a word sequence, from running sums."""

    def __init__(self, words: np.ndarray, base: np.uint64):
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(words), base)]), dtype=np.uint64)
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            self.undo = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(words), inverse)]), dtype=np.uint64)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.power[:-1], dtype=np.uint64)])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.undo[start]


def _merge(names, starts, low, high, edge, joins, ends, combine):
    """Join each symbol i with i - 1 where `joins`; returns the symbols of the next step.

    low[i], high[i]: the words that decide the boundary before symbol i.
    """
    stop = np.append(starts[1:], ends)
    after_low, after_high = np.append(low[1:], -FAR), np.append(high[1:], FAR)
    symbol_low = np.minimum(np.minimum(low, after_low), starts)
    symbol_high = np.maximum(np.maximum(high, after_high), stop)
    before_low = np.concatenate([[-FAR], symbol_low[:-1]])
    before_high = np.concatenate([[FAR], symbol_high[:-1]])
    new_low = np.where(edge, -FAR, np.minimum(before_low, symbol_low))
    new_high = np.where(edge, FAR, np.maximum(before_high, symbol_high))
    keep = ~joins
    return combine(names, keep), starts[keep], new_low[keep], new_high[keep], edge[keep]


def rounds(words: np.ndarray, document_starts: np.ndarray, count: int = ROUNDS):
    """For rounds 0 to `count`: (name, low, high) of all symbols that words alone decide.

    low and high bound the words that decide the symbol; both ascend. Symbols at the edge of a
    document, or that more than a window decides, are left out.
    """
    size = len(words)
    names = mixed(words)
    starts = np.arange(size)
    edge = np.zeros(size, dtype=bool)
    edge[document_starts] = True
    low, high = starts.copy(), starts + 1
    out = [(names, low, high)]
    for number in range(count):
        equal = np.concatenate([[False], names[1:] == names[:-1]]) & ~edge
        names, starts, low, high, edge = _merge(names, starts, low, high, edge, equal, size, _run_names)
        right = (mixed(names ^ _SIDES[number % len(_SIDES)]) & np.uint64(1)).astype(bool)
        pair = np.concatenate([[False], ~right[:-1] & right[1:]]) & ~edge
        names, starts, low, high, edge = _merge(names, starts, low, high, edge, pair, size, _pair_names)
        stop = np.append(starts[1:], size)
        symbol_low = np.minimum(np.minimum(low, np.append(low[1:], -FAR)), starts)
        symbol_high = np.maximum(np.maximum(high, np.append(high[1:], FAR)), stop)
        sure = (symbol_low > -FAR) & (symbol_high < FAR) & (symbol_high - symbol_low <= WINDOW)
        out.append((names[sure], symbol_low[sure], symbol_high[sure]))
    return out


_SIDES = mixed(np.arange(1, 65, dtype=np.uint64))  # one partition of the alphabet for each round


def _run_names(names: np.ndarray, keep: np.ndarray) -> np.ndarray:
    begin = np.flatnonzero(keep)
    length = np.diff(np.append(begin, len(names)))
    with np.errstate(over="ignore"):
        named = mixed(names[begin] + length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return np.where(length > 1, named, names[begin])


def _pair_names(names: np.ndarray, keep: np.ndarray) -> np.ndarray:
    begin = np.flatnonzero(keep)
    length = np.diff(np.append(begin, len(names)))
    second = names[np.minimum(begin + 1, len(names) - 1)]
    with np.errstate(over="ignore"):
        named = mixed(mixed(names[begin] * np.uint64(3)) + second)
    return np.where(length > 1, named, names[begin])


def _first_least(keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the first least key in each range start..end - 1 (none empty), by doubling."""
    length = end - start
    power = np.frexp(length)[1] - 1
    table = [np.arange(len(keys))]
    for p in range(int(power.max())):
        half = 1 << p
        left, right = table[-1][:-half], table[-1][half:]
        table.append(np.where(keys[left] <= keys[right], left, right))
    out = np.empty(len(start), dtype=np.int64)
    for p, one in enumerate(table):
        at = np.flatnonzero(power == p)
        left, right = one[start[at]], one[end[at] - (1 << p)]
        out[at] = np.where(keys[left] <= keys[right], left, right)
    return out


def anchors(words: np.ndarray, document_starts: np.ndarray, window_starts: np.ndarray, count: int = ROUNDS):
    """Of each window: the round of its anchor, the words that decide it (low, high), and its name."""
    size = len(window_starts)
    level = np.full(size, -1)
    low, high, name = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.uint64)
    left = np.arange(size)
    for number, (names, lows, highs) in reversed(list(enumerate(rounds(words, document_starts, count)))):
        if not len(left) or not len(names):
            continue
        first = np.searchsorted(lows, window_starts[left])
        last = np.searchsorted(highs, window_starts[left] + WINDOW, side="right")
        some = last > first
        chosen = left[some]
        if len(chosen):
            which = _first_least(mixed(names ^ np.uint64(number + 1)), first[some], last[some])
            level[chosen], low[chosen], high[chosen], name[chosen] = number, lows[which], highs[which], names[which]
        left = left[~some]
    return level, low, high, name


# The key that stands for a null one: after all others.
LAST_KEY = (1 << 63) - 1


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(narrow, wide, key, text_id, at, count): runs of windows of a text that share an anchor."""
    known = WordHashes()

    def block(columns: dict) -> dict | None:
        texts = [hash_words((t or "").encode().split(), known) for t in columns["text"].to_pylist()]
        long_ = [i for i, w in enumerate(texts) if len(w) >= WINDOW]
        if not long_:
            return None
        lengths = np.array([len(texts[i]) for i in long_])
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        words = np.concatenate([texts[i] for i in long_])
        count = lengths - WINDOW + 1
        owner = np.repeat(np.arange(len(long_)), count)
        windows = begin[owner] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        level, low, high, name = anchors(words, begin, windows)
        stretch = (low - windows) // STRETCH
        new = np.ones(len(windows), dtype=bool)
        new[1:] = np.any([np.diff(x) != 0 for x in (owner, low, high, level, stretch)], axis=0)
        first = np.flatnonzero(new)
        run = np.diff(np.append(first, len(windows)))
        start = windows[first]
        level, low, high, name, stretch = (x[first] for x in (level, low, high, name, stretch))
        sums = Sums(mixed(words), BASE)
        near = low - stretch * STRETCH
        far = np.maximum(near - STRETCH + 1 + WINDOW, high)
        with np.errstate(over="ignore"):
            narrow = mixed(mixed(name + level.astype(np.uint64)) + sums.between(near, far) + stretch.astype(np.uint64))
            shape = mixed((low - start).astype(np.uint64) * np.uint64(1024) + run.astype(np.uint64))
            wide = mixed(sums.between(start, start + run + WINDOW - 1) + shape)
        row = np.array(long_)[owner[first]]
        return {"narrow": _signed(narrow), "wide": _signed(wide), "key": columns["key"].take(row),
                "text_id": columns["text_id"].take(row), "at": start - begin[owner[first]], "count": run}

    return arrow_map(docs, block, "narrow long, wide long, key long, text_id long, at int, count int", rows=256)


def _window_rows(docs: DataFrame) -> DataFrame:
    """(one, two, key, text_id, at): both halves of the name of each window of the runs in `runs`."""
    known = WordHashes()

    def block(columns: dict) -> dict:
        out: dict = {n: [] for n in ("one", "two", "row", "at")}
        for row, (text, runs) in enumerate(zip(columns["text"].to_pylist(), columns["runs"].to_pylist(), strict=True)):
            words = hash_words((text or "").encode().split(), known)
            at = np.unique(np.concatenate([np.arange(r["at"], r["at"] + r["count"]) for r in runs]))
            out["one"].append(_signed(mixed(Sums(mixed(words), BASE).between(at, at + WINDOW))))
            out["two"].append(_signed(mixed(Sums(words, OTHER_BASE).between(at, at + WINDOW))))
            out["row"].append(np.full(len(at), row))
            out["at"].append(at)
        one, two, row, at = (np.concatenate(out[n]) for n in ("one", "two", "row", "at"))
        return {"one": one, "two": two, "key": columns["key"].take(row), "text_id": columns["text_id"].take(row), "at": at}

    return arrow_map(docs, block, "one long, two long, key long, text_id long, at int", rows=256)


def covered_runs(docs: DataFrame) -> DataFrame:
    """(key, text_id, runs): per text with covered windows, where runs of them start and their counts.

    `docs` holds key (long, never null), text_id (tells texts of one key apart) and text.
    """
    rows = _anchor_rows(docs)
    # Stored, as are the owners below, so that the joins on a name read plain exchanges, whose
    # large partitions adaptive execution splits.
    names = durable(rows.groupBy("narrow").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), (F.min("wide") != F.max("wide")).alias("several")
    ).filter("first < last").drop("last"))
    shared = durable(rows.join(names, "narrow"))
    alike = shared.filter("not several and key > first").select("key", "text_id", "at", "count")
    several = shared.filter("several").drop("first", "several")
    owners = durable(several.groupBy("narrow", "wide").agg(F.min("key").alias("owner")))
    several = durable(several.join(owners, ["narrow", "wide"]).select(
        "key", "text_id", "at", "count", (F.col("key") > F.col("owner")).alias("covered")
    ))
    run = F.struct("at", "count")
    open_ = several.filter("not covered").groupBy("key", "text_id").agg(F.collect_list(run).alias("runs"))
    windows = durable(_window_rows(docs.join(open_, ["key", "text_id"]).select("key", "text_id", "text", "runs")))
    earlier = durable(
        windows.groupBy("one", "two").agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .filter("first < last").drop("last")
    )
    single = windows.join(earlier, ["one", "two"]).filter("key > first").select(
        "key", "text_id", "at", F.lit(1).alias("count")
    )
    whole = alike.unionByName(several.filter("covered").drop("covered")).unionByName(single)
    return whole.groupBy("key", "text_id").agg(F.collect_set(run).alias("runs"))


def _keep_mask(count: int, runs: list[dict] | None) -> np.ndarray:
    """Which of `count` words no covered window holds."""
    change = np.zeros(count + 1, dtype=np.int64)
    for r in runs or ():
        change[r["at"]] += 1
        change[r["at"] + r["count"] + WINDOW - 1] -= 1
    return np.cumsum(change[:count]) == 0


def _with_runs(docs: DataFrame, key: str, text: str, others: list[str]) -> DataFrame:
    known = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY)).alias("key"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_id"), F.col(text).alias("text"),
        *[F.col(n).alias(f"o{i}") for i, n in enumerate(others)],
    )
    runs = covered_runs(known.select("key", "text_id", "text"))
    return known.join(runs, ["key", "text_id"], "left")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns; the words of `text` that earlier documents cover are taken out.

    A text that loses words is written as its kept words joined by one space; others stay as
    they are.
    """
    names = docs.columns
    joined = _with_runs(docs, key, text, names)
    at = f"o{names.index(text)}"

    def block(columns: dict) -> dict:
        out = []
        for value, runs in zip(columns[at].to_pylist(), columns["runs"].to_pylist(), strict=True):
            if runs:
                words = (value or "").encode().split()
                value = b" ".join(np.array(words, dtype=object)[_keep_mask(len(words), runs)]).decode()
            out.append(value)
        return columns | {at: out}

    kinds = ", ".join(f"o{i} {docs.schema[n].dataType.simpleString()}" for i, n in enumerate(names))
    return arrow_map(joined.drop("key", "text_id", "text"), block, kinds).toDF(*names)


def repeat_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_words, n_removed, and kept_sha256, the digest of the kept words joined by one space."""
    joined = _with_runs(docs, key, text, [key])

    def block(columns: dict) -> dict:
        out: dict = {"o0": columns["o0"], "n_words": [], "n_removed": [], "kept_sha256": []}
        for value, runs in zip(columns["text"].to_pylist(), columns["runs"].to_pylist(), strict=True):
            words = (value or "").encode().split()
            keep = _keep_mask(len(words), runs)
            kept = words if keep.all() else np.array(words, dtype=object)[keep].tolist()
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return out

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(joined, block, f"o0 {kind}, n_words long, n_removed long, kept_sha256 string").withColumnRenamed("o0", key)
