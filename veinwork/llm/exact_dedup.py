"""Exact duplicates by 128-bit content hashes, with bytes compared inside the groups.

Texts are equal when nothing but their white space (space and the five white-space controls)
differs. Rows are grouped by the MD5 of what is left. Of a group the row with the most code
points in its original text stays, then the one with the smallest id. Ids and hashes are all
that this moves.

Bytes are compared by a second grouping, on the hash and the text itself: it leaves one row for
each distinct text, of which each task sends one copy, so a text that a third of all rows share
costs no more than any other. A hash that is left with two texts is a collision; the rows of
those hashes alone are grouped once more, by hash and text.

All steps are DataFrame functions. Null texts count as empty, and empty texts are equal to each
other. A null id comes last among equals. Repeated rows of one id and text count as members of
their group and share its verdict; `drop_copies` leaves one of them. An empty table gives an
empty result. Columns other than id and text are not read by `find_copies`; `drop_copies` hands
them on whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinwork.session import durable

# Deleted before texts are compared.
WHITE = " \t\n\x0b\x0c\r"


def content_hash(text: Column) -> Column:
    """128 bits of a text's content."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def normal(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), WHITE, "")


def _chosen(rows: DataFrame, by: list[str]) -> DataFrame:
    """Size and staying row of each group with several rows; stored, so that a join can split a hot group."""
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("key").isNull().alias("unnamed"), "key"))
    found = rows.groupBy(*by).agg(F.count("*").alias("group_size"), best.alias("best"))
    return durable(found.filter("group_size > 1"))


def _judged(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    alone = F.col("group_size").isNull()
    best = (F.col("chars") == -F.col("best.less")) & F.col("key").eqNullSafe(F.col("best.key"))
    return rows.join(groups, by, "left").select(
        "key", "chars", "sha", F.when(alone, F.col("key")).otherwise(F.col("best.key")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"), (alone | best).alias("kept"),
    )


def _verdicts(docs: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Per row: key, chars, sha (of the normalised text), keep_id, group_size, kept."""
    seen = docs.select(F.col(key).alias("key"), F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("chars"),
                       normal(text).alias("normal"))
    hashed = seen.withColumn("hash", digest(F.col("normal")))
    rows = durable(hashed.select("key", "chars", "hash", F.unhex(F.sha2("normal", 256)).alias("sha")))
    texts = hashed.select("hash", "normal").distinct()
    collided = durable(texts.groupBy("hash").count().filter("count > 1").select("hash"))
    judged = _judged(rows, _chosen(rows, ["hash"]), ["hash"])
    if collided.isEmpty():
        return judged
    apart = durable(hashed.join(collided, "hash").withColumn("sha", F.unhex(F.sha2("normal", 256))))
    sound = rows.join(collided, "hash", "left_anti")
    both = ["hash", "normal"]
    return _judged(sound, _chosen(sound, ["hash"]), ["hash"]).unionByName(_judged(apart, _chosen(apart, both), both))


def find_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Per row: the key, keep_id (of the row that stays), group_size, kept, and text_sha256 of the normalised text."""
    return _verdicts(docs, key, text, digest).select(
        F.col("key").alias(key), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The rows that stay, with all their columns; of repeated rows one."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    k, t = (f"c{names.index(c)}" for c in (key, text))
    kept = _verdicts(plain, k, t, digest).filter("kept").select("key", "chars", "sha").distinct()
    marked = plain.withColumns({"own_chars": F.char_length(F.coalesce(t, F.lit(""))).cast("long"),
                                "own_sha": F.unhex(F.sha2(normal(t), 256))})
    same = (F.col(k).eqNullSafe(F.col("key")) & (F.col("own_chars") == F.col("chars")) & (F.col("own_sha") == F.col("sha")))
    once = marked.join(kept, same, "left_semi").dropDuplicates([k, "own_chars", "own_sha"])
    return once.drop("own_chars", "own_sha").toDF(*names)
