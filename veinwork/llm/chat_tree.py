r"""Chat formatting as prefix trees: shared initial turns are written once.

A turn is written as `<turn:ROLE>TEXT</turn>` and a line feed. Inside roles and texts the three
characters that control strings need are escaped (`\` as `\b`, `<` as `\l`, `>` as `\g`), so no
control string can stand in them and reading back is exact.

Conversations are sorted by the hashes of their successive prefixes, which lays all trees out
depth first. Every distinct prefix is a node of a tree; its last turn is written once, where the
first conversation below it stands. The output is one stream of pieces, a piece for each node:
its place in the stream, the position of its first code point in its conversation (positions
restart where branches part), the span under the loss mask, and the stream intervals of its
ancestors, which its tokens attend to besides earlier tokens of the piece. Ancestors that follow
each other in the stream are one interval: those that a conversation writes itself make one run,
so a piece has at most one interval more than the part of its path that others wrote has runs.
`leaves` give for each conversation the intervals that spell it.

No tree is held by one task: nodes are aggregated by prefix hash, the sorted order is dealt in
ranges whatever the trees, and places are running sums inside a range plus the totals of the
ranges before. A first turn that many conversations share is one node with many join partners,
a join that adaptive execution splits. One conversation is one row, the unit of the result.

Rows are ordered by turn (nulls first), then role and text. A null text or role counts as
empty. Rows with a null key make up one conversation. Repeated conversations add no piece. An
empty table gives no pieces and no leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinwork.session import durable

LEVEL = 16  # bytes of a prefix hash
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def _digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def _path(turns: Column) -> Column:
    """The hashes of all prefixes of a conversation, one after the other."""
    none = F.lit(b"")

    def follow(state: Column, turn: Column) -> Column:
        prefix = F.substring(
            _digest(F.concat(state["last"], _digest(turn["role"].cast("binary")), _digest(turn["text"].cast("binary")))),
            1, LEVEL,
        )
        return F.struct(prefix.alias("last"), F.concat(state["all"], prefix).alias("all"))

    return F.aggregate(turns, F.struct(none.alias("last"), none.alias("all")), follow, lambda state: state["all"])


def build(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pieces, leaves).

    pieces: start, end (in the stream), position, depth, loss_start, loss_end (null outside the
    loss role), ancestors (array of start, end, merged), piece. leaves: the key, intervals (array of
    start, end). Both are stored tables.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                   F.coalesce(text, F.lit("")).alias("text"))
    whole = conversations.groupBy(F.col(key).alias("__key")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = durable(
        whole.withColumn("path", _path(F.col("turns")))
        .repartitionByRange(tasks, "path", "__key").sortWithinPartitions("path", "__key")
        .withColumn("sequence", F.monotonically_increasing_id())
    )
    levels = ordered.select(
        "sequence", "path", F.posexplode("turns").alias("depth", "one")
    ).select(
        "sequence", "depth", F.substring("path", F.col("depth") * LEVEL + 1, F.lit(LEVEL)).alias("node"), "one"
    )
    head = F.concat(F.lit("<turn:"), escape(F.col("role")), F.lit(">"))
    body = escape(F.col("text"))
    nodes = (
        levels.groupBy("node").agg(
            F.min("sequence").alias("owner"), F.min("depth").alias("depth"), F.first("one").alias("one")
        )
        .select("node", "owner", "depth", "one.role", "one.text")
        .select("node", "owner", "depth", F.concat(head, body, F.lit("</turn>\n")).alias("piece"),
                F.when(F.col("role") == LOSS_ROLE, F.char_length(head)).alias("skip"), F.char_length(body).alias("body"))
    )
    placed = durable(_placed(durable(nodes)))
    spans = placed.select("node", "start", "end")
    leaves = durable(
        levels.select("sequence", "depth", "node").join(spans, "node").groupBy("sequence")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "start", "end"))).alias("found"))
        .select("sequence", F.transform("found", lambda x: F.struct(x["start"], x["end"])).alias("intervals"))
    )
    # What a conversation writes itself is one run of the stream, from `first` on; `base` spells the rest.
    written = placed.groupBy("owner").agg(F.min("depth").alias("own"), F.min("start").alias("first"))
    bases = written.join(leaves.withColumnRenamed("sequence", "owner"), "owner").select(
        "owner", "own", "first", _merged(F.slice("intervals", F.lit(1), F.col("own"))).alias("base"))
    base, last = F.col("base"), F.element_at("base", -1)
    run = F.struct(F.col("first").alias("start"), F.col("start").alias("end"))
    grown = F.struct(last["start"].alias("start"), F.col("start").alias("end"))
    joined = F.when((F.size(base) > 0) & (last["end"] == F.col("first")), F.concat(F.slice(base, F.lit(1), F.size(base) - 1), F.array(grown)))
    pieces = placed.join(durable(bases), "owner").select(
        "start", "end",
        (F.aggregate(base, F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"]) + F.col("start") - F.col("first")).alias("position"),
        "depth",
        (F.col("start") + F.col("skip")).alias("loss_start"),
        (F.col("start") + F.col("skip") + F.col("body")).alias("loss_end"),
        F.when(F.col("depth") == F.col("own"), base).otherwise(F.coalesce(joined, F.concat(base, F.array(run)))).alias("ancestors"), "piece",
    )
    keyed = ordered.select("sequence", F.col("__key").alias(key)).join(leaves, "sequence").select(key, "intervals")
    return durable(pieces), keyed


def _merged(intervals: Column) -> Column:
    """Intervals in order, those that touch made one."""
    count = F.size(intervals)
    begins = F.filter(intervals, lambda x, i: (i == 0) | (x["start"] != F.get(intervals, i - 1)["end"]))
    ends = F.filter(intervals, lambda x, i: (i == count - 1) | (x["end"] != F.get(intervals, i + 1)["start"]))
    return F.zip_with(begins, ends, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))


def _placed(nodes: DataFrame) -> DataFrame:
    """Nodes with start and end: running lengths in depth-first order."""
    part = F.shiftright("owner", 33)
    sized = nodes.withColumns({"part": part, "length": F.char_length("piece").cast("long")})
    totals = {r["part"]: r["n"] for r in sized.groupBy("part").agg(F.sum("length").alias("n")).collect()}
    before, total = [F.lit(-1), F.lit(0).cast("long")], 0  # one entry for each range of the sort
    for p in sorted(totals):
        before += [F.lit(p), F.lit(total).cast("long")]
        total += totals[p]
    inside = F.sum("length").over(Window.partitionBy("part").orderBy("owner", "depth"))
    end = F.element_at(F.create_map(*before), F.col("part").cast("int")) + inside
    return sized.withColumn("end", end).withColumn("start", F.col("end") - F.col("length")).drop("part", "length")


def read_back(pieces: DataFrame, leaves: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per conversation: its turns (array of role, text, loss) and formatted_chars, read from the stream.

    `loss` is the unescaped text under the loss mask, null for a turn outside it.
    """
    wanted = leaves.select(key, F.posexplode("intervals").alias("at", "span")).select(key, "at", "span.start")
    found = pieces.select("start", "piece", (F.col("loss_start") - F.col("start")).alias("skip"),
                          (F.col("loss_end") - F.col("loss_start")).alias("size"))
    form = r"(?s)^<turn:([^<>]*)>([^<>]*)</turn>\n$"
    turn = F.struct(
        "at",
        unescape(F.regexp_extract("piece", form, 1)).alias("role"),
        unescape(F.regexp_extract("piece", form, 2)).alias("text"),
        F.when(F.col("skip").isNotNull(), unescape(F.substring("piece", F.col("skip") + 1, F.col("size")))).alias("loss"),
        F.char_length("piece").alias("chars"),
    )
    rows = wanted.join(found, "start").select(key, turn.alias("turn"))
    return rows.groupBy(key).agg(F.sort_array(F.collect_list("turn")).alias("turns")).withColumn(
        "formatted_chars", F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["chars"])
    )
