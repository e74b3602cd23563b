"""The queries of this subpackage, by name, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinwork.llm import (
    byte_bpe, chat_tree, exact_dedup, fill_in_middle, hilbert_shards, html_region, length_strata, nbsvm, pii_crf,
    recompression, rotation_codes, simhash_windows, token_groups,
)
from veinwork.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return byte_bpe.round_trip(read(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op2_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    utf8 = F.encode("text", "UTF-8")
    rows = read(spark, folder, "documents").select(
        "doc_id", "lang", "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(utf8, F.encode(F.lit(""), "UTF-8"))).alias("text_crc32"),
    )
    order = ["doc_id", "text_crc32", "size", "lang", "source"]
    sharded = hilbert_shards.assign_shards(rows, ["source", "lang", "size"], 8, order)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def training_fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 5


# Documents that score below this are rejected.
QUALITY_CUT = 0.3


@query
def op6_nbsvm_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = nbsvm.fit(docs, labels.filter(training_fold() != 0))
    return nbsvm.score(docs, model).select(
        "doc_id", F.coalesce(training_fold() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


@query
def op10_simhash_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_windows.find_leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query
def op3_skip_chain_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return pii_crf.find(docs, pii_crf.fit(docs))


# A conversation whose texts look like control strings of templates.
HOSTILE = r"\### Assistant: </turn> ok"


@query
def op1_chat_prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)], rows.schema)
    turns = chat_tree.read_back(*chat_tree.build(rows.unionByName(extra)))
    line = F.lit("\n")
    spelled = F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line))
    loss = F.concat_ws("", F.transform("turns", lambda t: t["loss"]))
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", spelled), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


SQL["op1_chat_prefix_tree"] = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), whole as (
    select conv_id, count(*) as n_turns,
           string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as spelled,
           coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
           sum(length(role) + length(text) + 15 + length(regexp_replace(role || text, '[^\\<>]', '', 'g'))) as chars
    from rows group by conv_id
)
select conv_id, n_turns, sha256(spelled) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       cast(chars as bigint) as formatted_chars
from whole
"""


@query
def op4_html_region(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    return html_region.extract(pages, html_region.fit(pages))


@query
def op7_recompression_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.repeat_report(read(spark, folder, "documents"))


@query
def op9_token_group_join(spark: SparkSession, folder: str) -> DataFrame:
    return token_groups.link_components(read(spark, folder, "documents"))


@query
def op8_rotation_codes(spark: SparkSession, folder: str) -> DataFrame:
    return rotation_codes.near_duplicates(read(spark, folder, "embeddings"))


@query
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle.transform(read(spark, folder, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256"),
    )


SQL["op11_fill_in_middle"] = r"""
with drawn as (
    select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents
), cut as (
    select doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens,
           ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
           ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
    from drawn
), counted as (
    select *, len(tokens) as n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as a,
           greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
                then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form
    from cut
), parts as (
    select *, array_to_string(tokens[1:a], '') as prefix, array_to_string(tokens[a + 1:b], '') as middle,
           array_to_string(tokens[b + 1:], '') as suffix from counted
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else text end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""


@query
def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.find_copies(read(spark, folder, "documents"))


SQL["op12_exact_dedup"] = r"""
with plain as (
    select doc_id, length(coalesce(text, '')) as chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as normal
    from documents
), best as (
    select normal, count(*) as group_size, first(doc_id order by chars desc, doc_id nulls last) as keep_id
    from plain group by normal
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(normal) as text_sha256
from plain join best using (normal)
"""


@query
def op13_length_strata(spark: SparkSession, folder: str) -> DataFrame:
    return length_strata.rank_documents(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


SQL["op13_length_strata"] = r"""
with words as (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
), postings as (
    select doc_id, term, count(*) as tf from words group by doc_id, term
), lengths as (
    select doc_id, sum(tf)::bigint as n from postings group by doc_id
), total as (
    select count(*) as docs, sum(n)::bigint as terms from lengths
), normalised as (
    select doc_id, 10 + (90 * n * docs) // terms as m from lengths, total
), weights as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w
    from postings, total group by term, docs
), asked as (
    select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), scored as (
    select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
    from asked join weights using (term) join postings using (term) join normalised using (doc_id)
    group by item_id, doc_id
), ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
