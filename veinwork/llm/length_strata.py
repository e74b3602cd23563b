"""Ranked lexical search over an index stratified by length.

Terms are runs of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased. With
N documents that have terms and L terms in them all, a document of n terms has the normaliser
m = 10 + 90 n N div L, and a query term of weight w = floor(1000 ln((2N + 2) / (2 df + 1))) that it
holds tf times adds w * (10^9 tf div (1000 tf + 8 m)) to its score.

Documents of equal m are a stratum. Within one, what a term adds depends on tf alone, so the
factor is computed once per stratum and tf, for postings that are ordered by term and tf. The
factor of the largest tf of each term bounds every score of the stratum:

1. the strata with the highest bounds of each query, until they hold SEED documents, are scored;
   the last of the wanted scores found there is the query's threshold;
2. of the others only strata whose bound reaches the threshold are visited.

`index` reads every text once and stores a bag of terms per document; `search` joins the bags with
the queries' terms, so that nothing but their postings is moved. Strata are cut into blocks of at
most BLOCK documents, which are spread by (m, block): documents of one length, however many, make
many tasks. A block meets the queries that visit it and hands back at most `limit` rows a query.
The tables that meet are stored, so Spark broadcasts one only where its size allows.

Equal scores go by ascending key, null keys last, then by an arbitrary but fixed order. Every row
of documents is ranked for itself and every row of queries has its own result, repeated rows too.
Null and empty texts and texts without terms have no score; they do not count for N and L, and
queries without known terms get no rows. Empty tables give empty results. Other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinwork.llm.common import arrow_map
from veinwork.session import durable

# Documents of a stratum that one task scores together.
BLOCK = 4096
# Documents in the strata that give a query its threshold.
SEED = 2000
# Postings that one step of a task gathers.
TOUCHED = 4_000_000

_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or "").encode().translate(_LETTERS).split()


def bags(rows: DataFrame) -> DataFrame:
    """`rows` (row, key, text) as (row, key, n, terms, tfs): distinct terms and how often each occurs."""

    def block(columns: dict) -> dict:
        sizes, words, counts, ends = [], [], [], [0]
        for text in columns["text"].to_pylist():
            found = Counter(terms(text))
            sizes.append(found.total())
            words.extend(found.keys())
            counts.extend(found.values())
            ends.append(len(words))
        ends = pa.array(ends, pa.int32())
        held = pa.array(words, pa.binary()).cast(pa.string())
        return {"row": columns["row"], "key": columns["key"], "n": sizes,
                "terms": pa.ListArray.from_arrays(ends, held),
                "tfs": pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32()))}

    return arrow_map(rows, block, "row long, key long, n long, terms array<string>, tfs array<int>")


@dataclass(frozen=True)
class Index:
    """Stored bags of terms, the number of documents that have terms, and of all their terms."""

    bags: DataFrame
    documents: int
    length: int

    def normaliser(self) -> Column:
        return F.expr(f"cast(10 + (90 * n * {self.documents}L) div {max(self.length, 1)}L as int)")


def _rows(table: DataFrame, key: str, text: str) -> DataFrame:
    return table.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"),
                        F.col(text).alias("text"))


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    stored = durable(bags(_rows(docs, key, text)).filter("n > 0"))
    total = stored.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    return Index(stored, total["documents"], total["length"])


def factor(tf: str) -> Column:
    """What one unit of weight adds for a term that occurs `tf` times, in the stratum `m`."""
    return F.expr(f"(1000000000L * {tf}) div (1000L * {tf} + 8L * m)")


def _score_block(limit: int):
    def run(group: tuple, postings: pa.Table, visits: pa.Table) -> pa.Table:
        out: dict = {"q": [], "key": [], "row": [], "score": [], "unnamed": []}
        if postings.num_rows and visits.num_rows:
            _fill(out, int(group[0].as_py()), postings, visits, limit)
        flat = {name: np.concatenate(v) if v else np.zeros(0, np.int64) for name, v in out.items()}
        unnamed = flat.pop("unnamed").astype(bool)
        return pa.table({name: pa.array(v, pa.int64(), mask=unnamed if name == "key" else None) for name, v in flat.items()})

    return run


def _fill(out: dict, m: int, postings: pa.Table, visits: pa.Table, limit: int) -> None:
    rows, doc = np.unique(postings["row"].to_numpy(), return_inverse=True)
    keys = np.zeros(len(rows), dtype=np.int64)
    unnamed = np.zeros(len(rows), dtype=bool)
    keys[doc] = postings["key"].fill_null(0).to_numpy()
    unnamed[doc] = pc.is_null(postings["key"]).to_numpy()
    tfs, tf = np.unique(postings["tf"].to_numpy().astype(np.int64), return_inverse=True)
    order = np.lexsort((tf, term := postings["term"].to_numpy()))
    doc, term = doc[order], term[order]
    added = ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m))[tf[order]]
    scores = np.empty(len(rows), dtype=np.int64)
    for q, wanted, weights in zip(visits["q"].to_pylist(), visits["terms"], visits["weights"], strict=True):
        wanted, weights = wanted.values.to_numpy(), weights.values.to_numpy()
        low, high = np.searchsorted(term, wanted), np.searchsorted(term, wanted, side="right")
        scores[:] = 0
        ends = np.cumsum(high - low)
        for first, last in _pieces(ends):
            length = (high - low)[first:last]
            at = np.arange(length.sum()) + np.repeat(low[first:last] - np.cumsum(length) + length, length)
            np.add.at(scores, doc[at], np.repeat(weights[first:last], length) * added[at])
        best = np.flatnonzero(scores)
        if len(best) > limit:
            least = np.partition(scores[best], -limit)[-limit]
            best = best[scores[best] >= least]
        best = best[np.lexsort((rows[best], keys[best], unnamed[best], -scores[best]))][:limit]
        for name, values in (("q", np.full(len(best), q)), ("key", keys[best]), ("row", rows[best]),
                             ("score", scores[best]), ("unnamed", unnamed[best])):
            out[name].append(values)


def _pieces(ends: np.ndarray):
    """Ranges of terms that touch at most about TOUCHED postings together."""
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + TOUCHED, side="right")))
        yield first, last
        first = last


def _scored(postings: DataFrame, sizes: DataFrame, queries: DataFrame, visits: DataFrame, limit: int) -> DataFrame:
    """(q, key, row, score): the best of each visited block; a stored table."""
    cut = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    asked = visits.join(sizes, "m").select("q", "m", cut).join(queries, "q").select("m", "block", "q", "terms", "weights")
    visited = durable(visits.select("m").distinct().join(sizes, "m").select("m", "blocks"))
    held = postings.join(visited, "m").select(
        "m", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("block"), "row", "key", "term", "tf")
    pairs = held.groupBy("m", "block").cogroup(asked.groupBy("m", "block"))
    return durable(pairs.applyInArrow(_score_block(limit), "q long, key long, row long, score long"))


def _best(scored: DataFrame, limit: int) -> DataFrame:
    """The first `limit` rows of each query and their rank."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("key").asc_nulls_last(), "row")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def search(found: Index, items: DataFrame, item_key: str = "item_id", item_text: str = "text", limit: int = 10,
           seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Per row of `items` its best documents: item_key, rank, key and score."""
    asked = durable(bags(_rows(items, item_key, item_text)).select(F.col("row").alias("q"), F.col("key").alias("item"), "terms"))
    wanted = asked.select("q", F.explode("terms").alias("word"))
    names = durable(wanted.select("word").distinct().select("word", F.monotonically_increasing_id().alias("term")))
    every = found.bags.select("row", "key", found.normaliser().alias("m"), F.expr("inline(arrays_zip(terms, tfs))"))
    postings = durable(every.withColumnRenamed("terms", "word").join(names, "word")
                       .select("m", "row", "key", "term", F.col("tfs").alias("tf")))
    weight = F.floor(1000 * F.log((2.0 * found.documents + 2) / (2.0 * F.col("df") + 1)))
    weights = postings.groupBy("term").agg(F.count("*").alias("df")).select("term", weight.alias("weight")).filter("weight > 0")
    known = durable(wanted.join(names, "word").join(weights, "term").select("q", "term", "weight"))
    queries = durable(known.groupBy("q").agg(F.collect_list(F.struct("term", "weight")).alias("t"))
                      .select("q", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")))

    # Bounds of the strata, and the visits that give thresholds.
    sizes = durable(found.bags.groupBy(found.normaliser().alias("m")).count()
                    .select("m", F.col("count").alias("docs"), F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    top = postings.groupBy("m", "term").agg(F.max("tf").alias("tf"))
    bounds = durable(top.join(known, "term").groupBy("q", "m").agg(F.sum(F.col("weight") * factor("tf")).alias("bound")))
    down = Window.partitionBy("q").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("docs").over(down), F.lit(0))
    ordered = durable(bounds.join(sizes.select("m", "docs"), "m").withColumn("passed", passed).select("q", "m", "bound", "passed"))
    first = _scored(postings, sizes, queries, ordered.filter(F.col("passed") < seed).select("q", "m"), limit)
    least = _best(first, limit).filter(F.col("rank") == limit).select("q", F.col("score").alias("least"))
    rest = ordered.filter(F.col("passed") >= seed).join(least, "q", "left").filter(
        F.col("bound") >= F.coalesce("least", F.lit(1))).select("q", "m")
    second = _scored(postings, sizes, queries, rest, limit)
    best = _best(first.unionByName(second), limit).join(asked.select("q", "item"), "q")
    return best.select(F.col("item").alias(item_key), F.col("rank").cast("int").alias("rank"), "key", "score")


def rank_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                   item_text: str = "text", limit: int = 10) -> DataFrame:
    """The best documents of each item: item_key, rank, key and score."""
    return search(index(docs, key, text), items, item_key, item_text, limit).withColumnRenamed("key", key)
