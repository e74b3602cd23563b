"""Fill-in-middle, exact duplicates and ranked search against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from veinwork.llm import exact_dedup, fill_in_middle, length_strata

DOCS = "doc_id long, text string"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ordered(values):
    return sorted(values, key=lambda r: tuple((v is not None, v) for v in r))


def rows(df, *names):
    return ordered(tuple(r) for r in (df.select(*names) if names else df).collect())


# 11, fill-in-middle


@pytest.mark.parametrize("kind,values", [
    ("ArrayContainer", range(0, 60000, 97)), ("BitmapContainer", range(0, 65536, 3)), ("RunContainer", [*range(5, 9000), *range(40000, 65536)]),
])
def test_containers_select_their_members(kind, values):
    values = np.array(values)
    held = fill_in_middle.container(values)
    assert type(held).__name__ == kind
    assert [held.select(i) for i in range(len(values))] == values.tolist() == held.members().tolist()


def test_boundary_set_selects_across_containers():
    rng = np.random.default_rng(5)
    parts = [rng.choice(65536, 300, replace=False), 65536 + rng.choice(65536, 9000, replace=False), 5 * 65536 + np.arange(20000)]
    offsets = np.sort(np.concatenate(parts))
    held = fill_in_middle.BoundarySet(offsets)
    assert [type(c).__name__ for c in held.containers] == ["ArrayContainer", "BitmapContainer", "RunContainer"]
    assert len(held) == len(offsets) and list(held) == offsets.tolist()
    assert [held.select(i) for i in range(len(offsets))] == offsets.tolist()
    assert held.after(0) == 0 and held.after(len(held)) == offsets[-1]
    assert len(fill_in_middle.BoundarySet(offsets[:0])) == 0


def fim(key, text, seed=42, percent=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    prefix, middle, suffix = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return key, len(tokens), "plain", None, None, text
    if h[3] % 100 < spm:
        return key, len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return key, len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = ["", None, " ", "x", " a\tb\n", "a <P> b", "<", "<P <S> x", "<M", "  two  words   wide　gap \U0001f600 end", "\x0b\x0c mixed\r\n",
       "w " * 70_000, "é" * 70_000 + " tail", "\x00 nul \x1f"]


@pytest.mark.parametrize("percent,spm", [(50, 80), (100, 50)])
def test_fill_in_middle_against_plain_version(spark, percent, spm):
    given = brute.documents(3, 120) + [(2000 + i, t) for i, t in enumerate(ODD * 4)]
    docs = spark.createDataFrame(given, DOCS).withColumns({"n": F.lit(1), "form": F.lit("x"), "output": F.lit("y")}).repartition(5)
    out = fill_in_middle.transform(docs, percent=percent, spm_percent=spm)
    want = ordered(fim(k, t, percent=percent, spm=spm) for k, t in given)
    assert rows(out) == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    assert rows(out.select("doc_id", fill_in_middle.restored())) == ordered((k, t or "") for k, t in given)


def test_fill_in_middle_without_rows(spark):
    assert fill_in_middle.transform(spark.createDataFrame([], DOCS)).count() == 0


# 12, exact duplicates


def copies(given):
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for key, text in given:
        groups[plain(text)].append((-len(text or ""), key is None, key or 0, key))
    out = []
    for key, text in given:
        group = groups[plain(text)]
        best = min(group)
        out.append((key, best[3], len(group), (-len(text or ""), key) == (best[0], best[3]), hashlib.sha256(plain(text).encode()).hexdigest()))
    return out


def spaced(given):
    rng = random.Random(1)
    more = [(3000 + i, rng.choice([" ", "\n", ""]).join((t or "").split(" "))) for i, (_, t) in enumerate(given)]
    return given + more + [(4000, " "), (4001, "\x1c"), (4002, "a b"), (4003, "ab"), (4002, "a b"), (None, "a b")]


@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda t: F.unhex(F.md5(F.substring(t, 1, 1)))])
def test_copies_against_plain_version(spark, digest):
    given = spaced(brute.documents(5, 90))
    docs = spark.createDataFrame(given, DOCS).repartition(6)
    out = exact_dedup.find_copies(docs, digest=digest)  # the second digest makes most groups collide
    assert rows(out) == ordered(copies(given))
    wide = docs.withColumns({"kept": F.lit(7), "hash": F.lit("h"), "own_sha": F.lit(1), "sha": F.lit(2), "chars": F.lit(3)})
    left = exact_dedup.drop_copies(wide, digest=digest)
    assert left.columns == wide.columns and left.filter("kept != 7 or chars != 3").count() == 0
    want = {(g[0], g[1]) for g, c in zip(given, copies(given)) if c[3]}
    found = rows(left, "doc_id", "text")
    assert len(found) == len(set(c[4] for c in copies(given))) and set(found) <= want


def test_copies_without_rows(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.find_copies(none).count() == exact_dedup.drop_copies(none).count() == 0


def test_copies_run_without_python(spark):
    out = exact_dedup.find_copies(spark.createDataFrame(brute.documents(), DOCS))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 13, ranked search


def ranked(docs, items, limit=10):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    bags = [(k, Counter(TERM.findall(lower(t)))) for k, t in docs]
    bags = [(k, b) for k, b in bags if b]
    count, length = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for at, (key, bag) in enumerate(bags):
            m = 10 + 90 * bag.total() * count // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in set(TERM.findall(lower(text))) if bag[t])
            if score:
                scored.append((-score, key is None, key or 0, at, key))
        out += [(item, i, s[4], -s[0]) for i, s in enumerate(sorted(scored)[:limit], 1)]
    return out


def searched(seed):
    given = brute.documents(seed, 150)
    rng = random.Random(seed)
    given += [(1000 + i, "Long " + " ".join(rng.choice(given)[1] or "" for _ in range(30))) for i in range(3)]
    given += [(2000, "ÉTÉ naïve 42x"), (2001, "?! -- \n"), (2000, "ÉTÉ once more")]
    items = [(i, " ".join(rng.sample((given[4 * i][1] or "x").split(), 3)) + " " + (given[3 * i][1] or "")[:80]) for i in range(14)]
    items += [(50, None), (51, ""), (52, "ÉTÉ 42X"), (53, "nowhere"), (54, "again"), (54, "again")]
    return given, items


@pytest.mark.parametrize("seed,first,block", [(3, 2000, 4096), (4, 5, 7), (8, 1, 40)])
def test_search_against_plain_version(spark, seed, first, block):
    given, items = searched(seed)
    docs = spark.createDataFrame(given, DOCS).repartition(4).withColumns({"m": F.lit(1), "row": F.lit(2), "terms": F.lit(3)})
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = length_strata.search(length_strata.index(docs), bench, seed=first, block=block)
    # Rows of one document id tie in an arbitrary order; their scores and ranks are fixed.
    assert rows(out, "item_id", "rank", "score") == ordered((i, r, s) for i, r, _, s in ranked(given, items))
    assert rows(out, "item_id", "key", "score") == ordered((i, k, s) for i, _, k, s in ranked(given, items))


def test_bounds_leave_strata_unvisited(spark, monkeypatch):
    given = [(i, "rare word " + "pad " * 3) for i in range(20)] + [(100 + i, "word " + "fill " * (50 + 9 * i)) for i in range(40)]
    seen = []
    scored = length_strata._scored
    monkeypatch.setattr(length_strata, "_scored", lambda p, s, q, visits, n: (seen.append(visits.count()), scored(p, s, q, visits, n))[1])
    docs, bench = spark.createDataFrame(given, DOCS), spark.createDataFrame([(1, "rare word")], "item_id long, text string")
    out = length_strata.search(length_strata.index(docs), bench, seed=10)
    assert [r["key"] for r in out.orderBy("rank").collect()] == list(range(10))
    assert seen == [1, 0]  # one of some forty strata


def test_search_without_rows(spark):
    none, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], DOCS)
    assert length_strata.rank_documents(none, bench).count() == 0
    assert length_strata.rank_documents(some, bench.limit(0)).count() == 0
    assert rows(length_strata.rank_documents(some, bench), "item_id", "rank", "doc_id") == [(1, 1, 1)]
