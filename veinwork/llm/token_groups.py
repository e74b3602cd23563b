"""N-gram Jaccard join with a token-group matrix.

A document is the set of its distinct word n-grams. Documents with equal sets are one class,
handled once. Similar classes are put into groups by min-hash keys. The matrix holds, for each
group, the union of its members' index tokens: the first tokens of each set in a global order
(rare ones first), so many that two sets of the wanted similarity must share `needed` of them.
The number of a query's tokens in a group's union bounds its overlap with every member:

1. groups whose unions share too few tokens are never compared;
2. members are compared with their group's head, and heads of qualifying groups with each other;
3. where that leaves open whether two groups connect, or a member is not linked to its head,
   the bound is taken for the single query, and only groups that it cannot rule out are opened:
   the query is compared with the head. Members and queries that are not linked to it are then
   compared with one member each that shares what many of them share and the head lacks, so
   that copies of another original come together in linear work;
4. at last with those members of other components that the head's intersections with both do not
   exclude; if the query is linked to the head, only with members that are not. How much two sets
   must share outside the head bounds how many of the rarest such tokens need be looked at.

Comparisons are exact: intersection and union of the whole sets. Pairs that are already in one
component are not compared, since they cannot change it; no link between different components
is lost. The order of tokens only decides how much work there is: the frequent ones come from
counts over a sample of documents, of which at most FREQUENT are sent to the tasks.

Words are runs of characters other than space and the five white-space controls, A-Z lower-
cased. A text with fewer words than an n-gram has one, all its words; null and empty texts have
none and link with nothing. Repeated documents belong to one class. Documents with null keys are
compared like others; a component's name is its smallest non-null key.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinwork.llm.common import WordHashes, arrow_map, hash_words, mixed, shingle_hashes
from veinwork.llm.components import components
from veinwork.session import discard, durable

# Sampling of documents for token counts (one in SAMPLE), and how many frequent tokens count.
SAMPLE = 20
FREQUENT = 200_000
FREQUENT_FROM = 3
# Group keys of a class, and min-hashes joined in each.
KEYS, JOINED = 4, 3
# One more index token, and one more needed match, for every so many tokens of a set.
SLACK = 50


def token_set(text: str | None, width: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text."""
    return np.unique(shingle_hashes(hash_words((text or "").encode().lower().split(), known), width))


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent hashes of a set."""
    with np.errstate(over="ignore"):
        one = mixed(mixed(tokens).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(tokens)))
        two = mixed(mixed(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64, keepdims=True))
    return int(one.view(np.int64)[0]), int(two.view(np.int64)[0])


def group_keys(tokens: np.ndarray) -> list[int]:
    """KEYS hashes, each of JOINED minima of the set under multiplicative hashing."""
    with np.errstate(over="ignore"):
        least = np.array([(tokens * factor).min() for factor in _FACTORS], dtype=np.uint64).reshape(KEYS, JOINED)
        key = np.arange(KEYS, dtype=np.uint64)
        for i in range(JOINED):
            key = mixed(key * np.uint64(31) + least[:, i])
    return key.view(np.int64).tolist()


_FACTORS = mixed(np.arange(1, KEYS * JOINED + 1, dtype=np.uint64)) | np.uint64(1)


def short(tokens: np.ndarray) -> np.ndarray:
    """32-bit tokens of the index; that two may fall together only raises a bound."""
    return (mixed(tokens) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def needed(size: int) -> int:
    """Index tokens that two sets must share, the smaller of which has `size` tokens."""
    return 1 + size // SLACK


def _bound(one: str, other: str) -> Column:
    """`needed` of the smaller of two sizes."""
    return 1 + F.floor(F.least(one, other) / SLACK)


def _sizes_fit(one: str, other: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough, the second being the larger."""
    return F.col(one) * percent <= F.col(other) * 100


def in_order(tokens: np.ndarray, frequent: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Tokens in the global order: rare ones by hash, then frequent ones, rarest first.

    `frequent` holds the frequent tokens in ascending order, `place` where each comes (from 1).
    """
    few = short(tokens)
    rank = np.zeros(len(few), dtype=np.int64)
    if len(frequent):
        at = np.searchsorted(frequent, few)
        at[at == len(frequent)] = 0
        rank = np.where(frequent[at] == few, place[at], 0)
    return tokens[np.lexsort((tokens, few, rank))]


def at_least(size: int, percent: int) -> int:
    """What a set of this size must share with any set that is similar enough."""
    return -(-percent * size // 100)


def index_tokens(tokens: np.ndarray, percent: int, frequent: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The first tokens of a set in the global order, in short."""
    size = len(tokens)
    count = min(size, size - at_least(size, percent) + needed(size))
    return np.unique(short(in_order(tokens, frequent, place)[:count]))


def telling(outside: np.ndarray, size: int, both: int, percent: int, frequent: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The tokens by which a set finds its partners in a group, of those that the head lacks.

    A partner shares at most `both` tokens that the head has too, so at least r of the others, and
    the first that they share is among the first len - r + 1 of either in the global order.
    """
    r = max(1, at_least(size, percent) - both)
    return in_order(outside, frequent, place)[: max(0, len(outside) - r + 1)]


def _enough(overlap: str, one: str, other: str, percent: int) -> Column:
    """Whether so large an intersection makes sets of these sizes similar enough."""
    return F.expr(overlap) * (100 + percent) >= (F.col(one) + F.col(other)) * percent


def _alike(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the rows (a, b, one, two: token sets as bytes) whose sets are similar enough."""

    def block(columns: dict) -> dict | None:
        good = []
        for i, (x, y) in enumerate(zip(columns["one"], columns["two"], strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                good.append(i)
        return {"a": columns["a"].take(good), "b": columns["b"].take(good)} if good else None

    return arrow_map(pairs.select("a", "b", "one", "two"), block, "a long, b long")


def _against_heads(pairs: DataFrame, sets: DataFrame, percent: int, shared) -> DataFrame:
    """For (class, g, head): n, both (size of the intersection with the head), linked, and the telling
    tokens that the head lacks; a stored table."""

    def block(columns: dict) -> dict:
        out: dict = {"class": columns["class"], "g": columns["g"], "n": [], "both": [], "linked": [], "outside": []}
        for x, y in zip(columns["one"], columns["two"], strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            outside = np.setdiff1d(x, y, assume_unique=True)
            both = len(x) - len(outside)
            out["n"].append(len(x))
            out["both"].append(both)
            out["linked"].append(100 * both >= percent * (len(y) + len(outside)))
            out["outside"].append(telling(outside, len(x), both, percent, *shared.value).view(np.int64))
        return out

    one = sets.withColumnRenamed("tokens", "one")
    two = sets.select(F.col("class").alias("head"), F.col("tokens").alias("two"))
    joined = pairs.join(one, "class").join(two, "head").select("class", "g", "one", "two")
    return durable(arrow_map(joined, block, "class long, g long, n long, both long, linked boolean, outside array<long>"))


def classes(docs: DataFrame, width: int, percent: int, shared) -> DataFrame:
    """Per row of `docs` (key, text): key, n, the class id (two longs), group keys and index tokens; a stored table."""
    known = WordHashes()

    def block(columns: dict) -> dict:
        sets = [token_set(t, width, known) for t in columns["text"].to_pylist()]
        ids = [identity(s) for s in sets]
        return {"key": columns["key"], "n": [len(s) for s in sets], "one": [i[0] for i in ids],
                "two": [i[1] for i in ids], "bands": [group_keys(s) if len(s) else [] for s in sets],
                "tokens": [index_tokens(s, percent, *shared.value) for s in sets]}

    return durable(arrow_map(docs, block, "key long, n long, one long, two long, bands array<long>, tokens array<int>"))


def _frequent(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, places): the most frequent index tokens of a sample, ascending, and their places, the rarest first."""
    known = WordHashes()

    def block(columns: dict) -> dict:
        return {"token": np.concatenate([short(token_set(t, width, known)) for t in columns["text"].to_pylist()])}

    counted = arrow_map(docs.filter(F.xxhash64("text") % SAMPLE == 0), block, "token int").groupBy("token").count()
    top = counted.filter(F.col("count") >= FREQUENT_FROM).orderBy(F.desc("count"), "token").limit(FREQUENT)
    tokens = np.array([r["token"] for r in top.collect()][::-1], dtype=np.int32)
    order = np.argsort(tokens)
    return tokens[order], order + 1


def link_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4,
                    percent: int = 85) -> DataFrame:
    """Per row: the key, n_shingles (size of its set) and component_id."""
    plain = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(plain, width))
    wide = classes(plain, width, percent, shared)
    firsts = durable(
        wide.filter("n > 0").groupBy("one", "two", "n")
        .agg(F.min("key").alias("key"), F.min("bands").alias("bands"), F.min("tokens").alias("tokens"))
        .withColumnRenamed("one", "class")
    )
    rows = durable(wide.select("key", "n", "one", "two"))
    discard(wide)
    edges = _class_edges(plain, firsts, width, percent, shared)
    found = components(edges).withColumnRenamed("node", "class")
    named = firsts.select("class", "two", "n", "key")
    inside = named.join(found, "class")
    least = inside.groupBy("component").agg(F.min("key").alias("name"))
    named = durable(named.join(inside.select("class", "component").join(least, "component"), "class", "left").select(
        F.col("class").alias("one"), "two", "n", F.coalesce("name", F.col("key")).alias("component_id")
    ))
    discard(edges, firsts)
    return rows.join(named, ["one", "two", "n"], "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id")
    )


def _class_edges(plain: DataFrame, firsts: DataFrame, width: int, percent: int, shared) -> DataFrame:
    """(a, b) between classes: enough links for their components; a stored table."""
    banded = firsts.select("class", F.posexplode("bands").alias("band", "value"))
    leaders = durable(banded.groupBy("band", "value").agg(F.min("class").alias("leader")))
    led = banded.join(leaders, ["band", "value"]).groupBy("class").agg(F.min("leader").alias("g"))
    members = durable(firsts.join(led, "class").select("class", "key", "n", "g"))
    flat = firsts.select("class", F.explode("tokens").alias("token"))
    # Stored, so that the join reads plain exchanges, whose large partitions are split.
    several = durable(
        flat.groupBy("token").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x < y").select("token")
    )
    matrix = durable(flat.join(several, "token").join(members.select("class", "n", "g"), "class"))
    discard(leaders, several)
    unions = durable(matrix.groupBy("g", "token").agg(F.count("*").alias("holders")))
    # The head is the member whose tokens most others hold: an original rather than a copy.
    held = matrix.join(unions, ["g", "token"]).groupBy("class").agg(F.sum("holders").alias("held"))
    scored = members.join(held, "class", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    groups = durable(scored.groupBy("g").agg(
        F.max_by("class", F.struct("held", "class")).alias("head"), F.count("*").alias("members"),
        F.min("n").alias("least"), F.max("n").alias("most"),
    ))
    tokens = unions.select("g", "token")
    overlap = tokens.join(tokens.withColumnRenamed("g", "h"), "token").filter("g < h").groupBy("g", "h").count()
    other = groups.toDF("h", "other_head", "other_members", "other_least", "other_most")
    sized = overlap.join(groups, "g").join(other, "h").filter(
        (F.col("count") >= _bound("least", "other_least")) & _sizes_fit("least", "other_most", percent)
        & _sizes_fit("other_least", "most", percent)
    )
    candidates = durable(sized.select("g", "h", F.col("head").alias("a"), F.col("other_head").alias("b")))
    involved = groups.filter("members > 1").select("g").union(candidates.select("g")).union(candidates.select("h")).distinct()
    sets = _sets(plain, members.join(involved, "g"), width)

    # Members against their own head, heads of candidate groups against each other.
    heads = groups.select("g", "head")
    inside = members.join(involved, "g").join(heads, "g").select("class", "g", "head")
    own = _against_heads(inside, sets, percent, shared)
    faced = _faced(candidates, sets, percent)
    to_head = lambda found: found.filter("linked").join(heads, "g").select(F.col("class").alias("a"), F.col("head").alias("b"))
    edges = durable(faced.filter("linked").select("a", "b").unionByName(to_head(own)))
    # Those not linked to their head, with one another: first each with one that leads many.
    loose_own = own.filter("not linked")
    now = _components_of(members, edges)
    led = durable(_leading(loose_own, own, now, percent))
    edges = _more(edges, found := _compared(led, sets, percent))
    discard(led, found, now)

    # Queries of the candidate groups that this leaves apart, as far as their own bound allows.
    now = _components_of(members, edges)
    placed = durable(own.select("class", "g", "n", (F.col("n") - F.col("both")).alias("out")).join(now, "class"))
    of_head = heads.join(now.select(F.col("class").alias("head"), F.col("component").alias("hc")), "head").select("g", "hc")
    state = durable(placed.join(of_head, "g").groupBy("g", "hc").agg(
        F.count("*").alias("size"), F.count_if(F.col("component") != F.col("hc")).alias("strays"), F.max("out").alias("reach")))
    both = faced.select("g", "h", "both").union(faced.select(F.col("h").alias("g"), F.col("g").alias("h"), "both"))
    facing = durable(both.join(state.drop("reach"), "g").join(state.toDF("h", "other_hc", "other_size", "other_strays", "reach"), "h"))
    asked = durable(_asked(placed, facing, percent))
    queries = matrix.select("class", "n", "token").join(asked, "class")
    qualified = durable(
        queries.join(tokens.withColumnRenamed("g", "h"), ["h", "token"]).groupBy("class", "n", "h").count()
        .join(groups.select(F.col("g").alias("h"), "head", "least"), "h")
        .filter(F.col("count") >= _bound("n", "least"))
        .select("class", F.col("h").alias("g"), "head")
    )
    discard(matrix, unions, candidates, faced, state, facing, asked, placed, now)
    cross = _against_heads(qualified, sets, percent, shared)
    edges = _more(edges, to_head(cross))
    loose_cross = cross.filter("not linked")
    later = _components_of(members, edges)
    led = durable(_leading(loose_cross, own, later, percent))
    edges = _more(edges, found := _compared(led, sets, percent))
    discard(led, found, later)

    # At last with all members that are still apart.
    later = _components_of(members, edges)
    # A query that is linked to the head can still lack the members that are not.
    crossed = cross.filter("linked")
    opened = _opened(loose_own.unionByName(loose_cross), own, later, percent)
    opened = durable(opened.union(_opened(crossed, loose_own, later, percent)).distinct())
    edges = _more(edges, found := _compared(opened, sets, percent))
    discard(opened, found, later, qualified, own, cross, sets, groups, members)
    return edges


def _faced(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (g, h, a, b) with `both`, the size of their heads' intersection, and linked; a stored table."""

    def block(columns: dict) -> dict:
        out: dict = {name: columns[name] for name in ("g", "h", "a", "b")} | {"both": [], "linked": []}
        for x, y in zip(columns["one"], columns["two"], strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out["both"].append(both)
            out["linked"].append(100 * both >= percent * (len(x) + len(y) - both))
        return out

    one = sets.select(F.col("class").alias("a"), F.col("tokens").alias("one"))
    two = sets.select(F.col("class").alias("b"), F.col("tokens").alias("two"))
    joined = candidates.join(one, "a").join(two, "b").select("g", "h", "a", "b", "one", "two")
    return durable(arrow_map(joined, block, "g long, h long, a long, b long, both long, linked boolean"))


def _asked(placed: DataFrame, facing: DataFrame, percent: int) -> DataFrame:
    """(class, h): which classes must be taken as queries of which groups.

    A class is a stray if it is not in the component of its group's head. Of two groups that face
    each other the classes of the smaller one are queries of the larger, unless all of that one is
    in their component. Where both heads are in one component and there are fewer strays than
    classes in the smaller group, the strays of both are queries instead: of a group whose head is in
    another component, and of two strays one where it is not.

    Of these, a class shares with a member of the other group at most what the heads share (`both`),
    what it has outside its own head (`out`), and what members there have outside theirs (`reach`).
    """
    enough = (F.col("both") + F.col("out") + F.col("reach")) * 100 >= F.col("n") * percent
    one_way = F.expr("hc <> other_hc or strays + other_strays > least(size, other_size)")
    smaller = F.expr("size < other_size or size = other_size and g < h")
    whole = placed.join(facing.filter(one_way & smaller), "g").filter(
        F.expr("component <> other_hc or other_strays > 0") & enough).select("class", "h")
    strays = placed.join(facing.filter(~one_way & (F.col("strays") > 0)), "g").filter(
        F.expr("component <> hc and (component <> other_hc or other_strays > 0 and g < h)") & enough).select("class", "h")
    return whole.union(strays)


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough; a stored table."""
    one = sets.select(F.col("class").alias("a"), F.col("tokens").alias("one"))
    two = sets.select(F.col("class").alias("b"), F.col("tokens").alias("two"))
    return durable(_alike(pairs.select("a", "b").join(one, "a").join(two, "b"), percent))


def _more(edges: DataFrame, found: DataFrame) -> DataFrame:
    both = durable(edges.unionByName(found.select("a", "b")))
    discard(edges)
    return both


def _components_of(members: DataFrame, edges: DataFrame) -> DataFrame:
    """(class, component) of all classes; a stored table."""
    parts = components(edges)
    found = durable(
        members.select("class").join(parts.withColumnRenamed("node", "class"), "class", "left")
        .select("class", F.coalesce("component", "class").alias("component"))
    )
    discard(parts)
    return found


def _leading(queries: DataFrame, members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """(a, b): each query with one member that shares its most widely held telling token, and with one
    of its own size, where they are not in one component yet. The member is that of least id, so all
    queries of a token meet the same one."""
    fits = _sizes_fit("n", "nb", percent) & _sizes_fit("nb", "n", percent)
    tokens = members.select(F.col("class").alias("b"), "g", F.col("n").alias("nb"), F.explode("outside").alias("token"))
    lists = durable(tokens.groupBy("g", "token").agg(F.min(F.struct("b", "nb")).alias("led"), F.count("*").alias("holders"))
                    .select("g", "token", "led.b", "led.nb", "holders"))
    by_token = queries.select("class", "g", "n", F.explode("outside").alias("token")).join(lists, ["g", "token"]).filter(
        (F.col("class") != F.col("b")) & fits).groupBy("class", "g").agg(F.max_by("b", F.struct("holders", "token")).alias("b"))
    sizes = durable(members.groupBy("g", "n").agg(F.min("class").alias("b")))
    by_size = queries.select("class", "g", "n").join(sizes, ["g", "n"]).filter("class != b")
    of = lambda name, at: parts.select(F.col("class").alias(name), F.col("component").alias(at))
    pairs = by_token.select("class", "b").union(by_size.select("class", "b")).withColumnRenamed("class", "a")
    apart = pairs.join(of("a", "ca"), "a").join(of("b", "cb"), "b").filter("ca != cb")
    return apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _opened(queries: DataFrame, members: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """(a, b): queries and members of a group, in different components, that its head does not rule out.

    What two sets share is at most the smaller of what each shares with the head, plus what they
    share outside it. So a pair qualifies by sizes alone, or shares a token that the head lacks; the
    first that they share in the global order leaves at most so many others as come after it.
    """
    query = queries.join(components, "class").select(
        F.col("class").alias("a"), "g", F.col("n").alias("na"), F.col("both").alias("ba"), F.col("component").alias("ca"), "outside")
    member = members.join(components, "class").select(
        F.col("class").alias("b"), "g", F.col("n").alias("nb"), F.col("both").alias("bb"), F.col("component").alias("cb"), "outside")
    # Sizes that a member may have, from 100 * both >= percent * union with no shared token outside.
    low, high = F.ceil(F.col("na") * percent / 100), F.floor(F.col("ba") * (100 + percent) / percent) - F.col("na")
    sized = query.filter(low <= high).select("a", "g", "na", "ba", "ca", F.explode(F.sequence(low, high)).alias("nb"))
    by_size = sized.join(member.drop("outside"), ["g", "nb"]).filter(
        (F.col("ca") != F.col("cb")) & _enough("least(ba, bb)", "na", "nb", percent)).select("a", "b")
    by_token = query.select("a", "na", "ba", "g", "ca", F.posexplode("outside").alias("pa", "token")).join(
        member.select("b", "nb", "bb", "g", "cb", F.posexplode("outside").alias("pb", "token")), ["g", "token"]
    ).filter(
        (F.col("ca") != F.col("cb")) & _sizes_fit("na", "nb", percent) & _sizes_fit("nb", "na", percent)
        & _enough("least(ba, bb) + least(na - ba - pa, nb - bb - pb)", "na", "nb", percent)
    ).select("a", "b")
    found = by_size.union(by_token)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _sets(plain: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(class, tokens) of the member classes, from the text of their first document; a stored table."""
    known = WordHashes()
    wanted = members.select("class", F.col("key").alias("first"))

    def block(columns: dict) -> dict:
        out: dict = {"class": [], "tokens": []}
        for name, text in zip(columns["class"].to_pylist(), columns["text"].to_pylist(), strict=True):
            tokens = token_set(text, width, known)
            if identity(tokens)[0] == name:  # another text of the same key is another class
                out["class"].append(name)
                out["tokens"].append(tokens.tobytes())
        return out

    found = plain.join(wanted, F.col("key").eqNullSafe(F.col("first"))).select("class", "text")
    return durable(arrow_map(found, block, "class long, tokens binary").dropDuplicates(["class"]))
