"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The pieces that the split pattern finds in a block of texts are encoded together: every
distinct piece once. An inverted index maps the rank of each adjacent token pair to the
positions where that pair stands, over all pieces at once; the ranks present are replayed in
order, each over all its positions together, and a merge looks again only at the two pairs
that its neighbours now form. Chunks already encoded are remembered up to a bound, so that a
task pays for a frequent one once.

The whole corpus would be one block if its table of distinct pieces could be joined back to
every piece of every text; that join would move all pieces through a shuffle. A block per task
gives the same ids without moving any text.

Null and empty texts have no ids. Rows are independent: ties and repeated rows change nothing.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinwork.llm.common import arrow_map

# Chunks remembered by a task, pieces held at once of a text, the length from which a text is
# cut, and characters of texts whose new pieces are encoded together.
REMEMBERED = 400_000
AT_ONCE = 200_000
LONG_TEXT = 500_000
BLOCK_CHARS = 12_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Vocabulary:
    """Token bytes, and the rank of every pair of tokens that merges, as sorted arrays."""

    def __init__(self, ranks: dict[bytes, int], **built):
        self.ranks = ranks
        if built:
            self.__dict__.update(built)
            return
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        pairs.sort()
        self.codes = np.array([code for code, _ in pairs] or [-1], dtype=np.int64)
        self.merged = np.array([rank for _, rank in pairs] or [-1], dtype=np.int32)
        self.decimal = {rank: str(rank) for rank in ranks.values()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it does not merge or one side is no token."""
        code = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where((self.codes[at] == code) & (left >= 0) & (right >= 0), self.merged[at], np.int32(-1))


def replay(pieces: list[bytes], vocabulary: Vocabulary) -> list[str]:
    """Ids of each piece, joined by commas: all merges over all pieces, in rank order.

    `where` is the inverted index from a pair's rank to the positions where it was seen;
    `pair_at` tells which of them still hold. New pairs may rank below the current one (a
    token can be built in two ways), so the next rank comes from a heap.
    """
    joined = b"\0".join(pieces)
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    ends = np.cumsum(lengths + 1) - 1  # the place after each piece
    tokens = np.append(vocabulary.byte[np.frombuffer(joined, dtype=np.uint8)], np.int32(-1))
    tokens[ends] = -1
    size = len(tokens)
    following = np.arange(1, size + 1)
    preceding = np.arange(-1, size - 1)
    following[-1], preceding[0] = size - 1, size - 1  # the last place is never a token
    pair_at = np.append(vocabulary.pair_ranks(tokens[:-1], tokens[1:]), np.int32(-1))
    order = np.argsort(pair_at, kind="stable")
    order = order[np.searchsorted(pair_at[order], 0):]
    first = np.flatnonzero(np.diff(pair_at[order], prepend=-1))
    where = {int(pair_at[part[0]]): [part] for part in np.split(order, first[1:]) if len(part)}
    late: dict[int, list[int]] = {}
    waiting = list(where)
    heapify(waiting)
    while waiting:
        rank = heappop(waiting)
        at = np.concatenate([*where.pop(rank, ()), np.array(late.pop(rank, ()), dtype=np.int64)])
        at = at[pair_at[at] == rank]
        if not len(at):
            continue
        if len(at) > 1:
            at.sort()
            at = at[np.append(True, at[1:] != at[:-1])]
        taken = following[at]
        if len(at) > 1 and (taken[:-1] == at[1:]).any():  # overlapping: the left one goes first
            keep, free = [], -1
            for left, right in zip(at.tolist(), taken.tolist(), strict=True):
                if left != free:
                    keep.append(left)
                    free = right
            at = np.array(keep)
            taken = following[at]
        beyond = following[taken]
        tokens[at] = rank
        tokens[taken] = -2
        pair_at[taken] = -1
        following[at] = beyond
        preceding[beyond] = at
        before = preceding[at]
        touched = np.concatenate([before, at])
        ranks = vocabulary.pair_ranks(tokens[touched], tokens[following[touched]])
        pair_at[touched] = ranks
        new = ranks >= 0
        for one, position in zip(ranks[new].tolist(), touched[new].tolist(), strict=True):
            if one in late:
                late[one].append(position)
            else:
                late[one] = [position]
                heappush(waiting, one)
    kept = tokens >= 0
    ids = list(map(vocabulary.decimal.__getitem__, tokens[kept].tolist()))
    cuts = np.cumsum(kept)[ends].tolist()
    return [",".join(ids[i:j]) for i, j in zip([0, *cuts[:-1]], cuts, strict=True)]


class TextEncoder:
    """Ids of whole texts, block by block, as strings of decimal ids.

    Works on chunks, a space and what follows up to the next one, which are fewer than pieces.
    The pattern always starts a piece at a space unless that space stands inside a run of white
    space; a text with such a run is cut into pieces by the pattern as a whole.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.split = regex.compile(pattern)
        self.inside = regex.compile(r"\s (?:\s|\Z)")
        self.vocabulary = vocabulary
        self.known: dict[str, str] = {}
        self.decimal = {str(rank): token for token, rank in vocabulary.ranks.items()}

    def chunks(self, text: str) -> Iterator[list[str]]:
        if self.inside.search(text):
            found = (match.group() for match in self.split.finditer(text))
            while part := list(islice(found, AT_ONCE)):
                yield part
        elif text:
            start = 0
            while len(text) - start > LONG_TEXT:
                cut = text.find(" ", start + LONG_TEXT)
                if cut < 0:
                    break
                yield self.spaced(text[start:cut])
                start = cut
            yield self.spaced(text[start:])

    @staticmethod
    def spaced(text: str) -> list[str]:
        """Chunks; the first has a space only if the text begins with one."""
        first, *rest = text.replace(" ", "\0 ").split("\0") if "\0" not in text else _at_spaces(text)
        return [first, *rest] if first else rest

    def learn(self, texts: list[str]) -> None:
        """Encode the chunks of a block of texts that are not known yet."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh: set[str] = set()
        for text in texts:
            for part in self.chunks(text):
                fresh.update(part)
        fresh.difference_update(self.known)
        pieces: set[str] = set()
        mixed: dict[str, list[str]] = {}
        for chunk in fresh:
            if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
                pieces.add(chunk)  # letters only: one piece
            else:
                mixed[chunk] = parts = self.split.findall(chunk)
                pieces.update(parts)
        distinct = list(pieces)
        ids = replay([piece.encode() for piece in distinct], self.vocabulary) if distinct else []
        self.known.update(zip(distinct, ids, strict=True))
        known = self.known
        for chunk, parts in mixed.items():
            known[chunk] = ",".join([known[piece] for piece in parts])

    def encoded(self, texts: Iterable[str | None]) -> Iterator[tuple[int, str]]:
        """(row, ids of a part joined by commas), in order of rows and parts."""
        held: list[tuple[int, str]] = []
        size = 0
        for row, text in enumerate(texts):
            held.append((row, text or ""))
            size += len(text or "")
            if size >= BLOCK_CHARS:
                yield from self._block(held)
                held, size = [], 0
        yield from self._block(held)

    def _block(self, held: list[tuple[int, str]]) -> Iterator[tuple[int, str]]:
        self.learn([text for _, text in held])
        look = self.known.__getitem__
        for row, text in held:
            for part in self.chunks(text):
                yield row, ",".join(map(look, part))

    def decoded(self, ids: str) -> bytes:
        return b"".join(map(self.decimal.__getitem__, ids.split(","))) if ids else b""


def _at_spaces(text: str) -> list[str]:
    first, *rest = text.split(" ")
    return [first, *(" " + part for part in rest)]


def _with_encoder(spark: SparkSession, ranks: dict[bytes, int], pattern: str) -> Callable[[], TextEncoder]:
    """The vocabulary, whose size is that of its file, goes to each executor once."""
    shared = spark.sparkContext.broadcast(vars(Vocabulary(ranks)))
    held: list[TextEncoder] = []

    def encoder() -> TextEncoder:
        if not held:
            held.append(TextEncoder(Vocabulary(**shared.value), pattern))
        return held[0]

    return encoder


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_tokens and ids, an array of token ids (empty for null or empty text)."""
    encoder = _with_encoder(df.sparkSession, ranks, pattern)

    def block(columns: dict) -> dict:
        texts = columns["__text"].to_pylist()
        ids: list[list[int]] = [[] for _ in texts]
        for row, part in encoder().encoded(texts):
            ids[row].extend(map(int, part.split(",")))
        return {"__key": columns["__key"], "n_tokens": [len(x) for x in ids],
                "ids": ids}

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    return arrow_map(rows, block, f"__key {kind}, n_tokens long, ids array<int>").withColumnRenamed("__key", key)


def decode(df: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: the key and `decoded`, the bytes that its ids stand for (null ids: no bytes)."""
    shared = df.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    def block(columns: dict) -> dict:
        look = shared.value.__getitem__
        return {"__key": columns["__key"],
                "decoded": [b"".join(map(look, x or ())) for x in columns["__ids"].to_pylist()]}

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("__key"), F.col(ids).alias("__ids"))
    return arrow_map(rows, block, f"__key {kind}, decoded binary").withColumnRenamed("__key", key)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Per row: n_tokens, a digest of the ids and a digest of what those ids decode to.

    Encodes and decodes in one pass and hands on digests instead of ids. Digests are SHA-256 in
    lowercase hex: of the decimal ids joined by commas, and of the decoded bytes.
    """
    encoder = _with_encoder(df.sparkSession, ranks, pattern)

    def block(columns: dict) -> dict:
        texts = columns["__text"].to_pylist()
        count = [0] * len(texts)
        of_ids = [hashlib.sha256() for _ in texts]
        of_bytes = [hashlib.sha256() for _ in texts]
        for row, part in encoder().encoded(texts):
            of_ids[row].update(f",{part}".encode() if count[row] else part.encode())
            count[row] += part.count(",") + 1
            of_bytes[row].update(encoder().decoded(part))
        return {"__key": columns["__key"], "n_tokens": count,
                "ids_sha256": [h.hexdigest() for h in of_ids],
                "decoded_sha256": [h.hexdigest() for h in of_bytes]}

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    out = arrow_map(rows, block, f"__key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("__key", key)
