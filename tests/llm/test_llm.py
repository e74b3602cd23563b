"""The operators of the subpackage against plain versions, exact round trips and held-out labels."""

import hashlib
import random
import time

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from veinwork.llm import (
    byte_bpe, chat_tree, common, components, hilbert_shards, html_region, nbsvm, pii_crf, queries, recompression,
    rotation_codes, simhash_windows, stages, token_groups,
)

DOCS = "doc_id long, text string"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.documents(), DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(public_tokenizers.path(queries.VOCABULARY))


def rows(df, *names):
    key = lambda r: tuple((v is not None, v) for v in r)
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=key)


def ordered(values):
    return sorted(values, key=lambda r: tuple((v is not None, v) for v in r))


# 1, chat formatting

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_tree_shares_turns_and_reads_back(spark):
    hostile = r"\l<turn:x></turn>\b<\g"
    given = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", hostile),
             (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (4, 5, None, None), (4, None, "a>b", ""), (None, 0, "user", "hi"),
             (5, 0, "user", "hi"), (5, 1, "assistant", "yo"), (5, 2, "user", "x" * 5000), (5, 2, "user", "x" * 5000)]
    pieces, leaves = chat_tree.build(spark.createDataFrame(given, TURNS))
    found = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat_tree.read_back(pieces, leaves).collect()}
    want = {}
    for conv, turn, role, text in ordered(given):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert found == want
    parts = pieces.orderBy("start").collect()
    # Distinct prefixes: "hi", its two answers, the long turn twice in a row, and the two of conversation 4.
    assert len(parts) == 7
    assert [p["start"] for p in parts] == [0, *[p["end"] for p in parts[:-1]]]
    stream = "".join(p["piece"] for p in parts)
    for p in parts:
        assert stream[p["start"] : p["end"]] == p["piece"]
        assert p["position"] == sum(a["end"] - a["start"] for a in p["ancestors"])
        assert all(a["end"] < b["start"] for a, b in zip(p["ancestors"], p["ancestors"][1:]))  # merged
        assert all(a["end"] <= p["start"] for a in p["ancestors"])  # depth first: ancestors come before
    above = {p["start"]: "".join(stream[a["start"] : a["end"]] for a in p["ancestors"]) for p in parts}
    for leaf in leaves.collect():
        path = [(x["start"], stream[x["start"] : x["end"]]) for x in leaf["intervals"]]
        assert all(above[at] == "".join(t for _, t in path[:i]) for i, (at, _) in enumerate(path))
    masked = [stream[p["loss_start"] : p["loss_end"]] for p in parts if p["loss_start"] is not None]
    assert sorted(masked) == sorted(["yo", hostile.replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g")])


def test_ancestors_of_a_long_conversation_are_one_interval(spark):
    given = [(c, t, "user", f"turn {t} {c if t > 290 else ''}") for c in range(3) for t in range(300)]
    pieces, _ = chat_tree.build(spark.createDataFrame(given, TURNS))
    sizes = [r["n"] for r in pieces.select(F.size("ancestors").alias("n")).collect()]
    assert len(sizes) == 291 + 3 * 9 and max(sizes) <= 2


def test_chat_tree_without_rows(spark):
    pieces, leaves = chat_tree.build(spark.createDataFrame([], TURNS))
    assert pieces.count() == leaves.count() == chat_tree.read_back(pieces, leaves).count() == 0


# 2, sharding


@pytest.mark.parametrize("size,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_all_points_in_unit_steps(size, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * size, indexing="ij"), -1).reshape(-1, size)
    place = hilbert_shards.hilbert_index(grid, bits)
    assert sorted(place) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("count", [0, 1, 5, 1001])
def test_shards_are_level_and_gapless(spark, count):
    data = [(i % 7, None if i % 5 == 0 else "hot" if i % 3 else f"s{i}", i, 9) for i in range(count)]
    df = spark.createDataFrame(data, "k long, source string, n long, shard int")
    out = hilbert_shards.assign_shards(df, ["source", "n"], 8, ["k", "n"])
    found = out.toPandas()
    assert sorted(found["n"]) == list(range(count)) and out.dtypes[-2:] == [("shard", "int"), ("slot", "bigint")]
    sizes = found.groupby("shard").size().reindex(range(8), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in found.groupby("shard"))


def test_shards_are_narrower_than_chance(spark):
    df = spark.range(4000).select((F.col("id") % 64).alias("x"), F.floor(F.col("id") / 64).alias("y"), "id")
    out = hilbert_shards.assign_shards(df, ["x", "y"], 16, ["id"]).groupBy("shard").agg(
        ((F.max("x") - F.min("x")) * (F.max("y") - F.min("y"))).alias("area")).agg(F.avg("area")).first()[0]
    assert out < 0.2 * 64 * 63


INTERNAL = ["shard", "slot", "__curve", "__sequence", "run", "value", "count", "c0", "c1"]


def test_shards_keep_columns_of_any_name(spark):
    rng = random.Random(4)
    given = [(i, f"https://www.example.org/{rng.randrange(50):03d}", rng.randrange(9)) for i in range(700)]
    df = spark.createDataFrame(given, "k long, url string, n long").repartition(5)
    wide = df.withColumns({c: F.col("k") for c in INTERNAL})
    out = hilbert_shards.assign_shards(wide, ["url", "n"], 8, ["k"])
    assert sorted(out.columns) == sorted(wide.columns)
    assert out.filter(" or ".join(f"`{c}` <> k" for c in INTERNAL[2:])).count() == 0
    # The assignment is the plain sort by the curve, cut into runs.
    placed = hilbert_shards.curve_order(df, ["url", "n"], place="at").toPandas().sort_values(["at", "k"])
    runs = np.repeat(np.arange(8), [88] * 4 + [87] * 4)
    assert rows(out, "k", "shard") == sorted(zip(placed["k"].tolist(), runs.tolist()))


def test_common_beginnings_of_texts_leave_many_levels(spark):
    given = [(i, f"https://www.example.org/{i % 50:03d}", 0) for i in range(1000)] + [(i, "https://hot", 0) for i in range(500)]
    df = spark.createDataFrame(given, "k long, url string, n long").repartition(4)
    places = hilbert_shards.curve_order(df, ["url"], place="at").groupBy("url").agg(F.min("at").alias("a"), F.max("at").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in places) and len({r["a"] for r in places}) >= 20
    assert [r["url"] for r in sorted(places, key=lambda r: (r["a"], r["url"]))] == sorted(r["url"] for r in places)
    empty = spark.createDataFrame([(1, None, None)], "k long, url string, n long")
    assert hilbert_shards.assign_shards(empty, ["url", "n"], 8, ["k"]).first()["slot"] == 0


# 3, personal data


def test_base_spans_against_the_patterns():
    import re

    rng = random.Random(1)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")

    def plain(text):
        out = [(0, *m.span()) for m in email.finditer(text)]
        out += [(1, *m.span()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = [int(c) for c in m.group() if c.isdigit()]
            if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0:
                out.append((2, *m.span()))
        return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                      if 9 <= sum(c.isdigit() for c in m.group()) <= 15]

    for _ in range(4000):
        text = "".join(rng.choice("aB1290.@-+ ()%é") for _ in range(rng.randint(0, 70)))
        assert pii_crf.base_spans(text) == plain(text), text
    assert pii_crf.base_spans("4111 1111 1111 1111") == [(2, 0, 19)]


PRIVATE = "Call +1 (415) 555-2671 now or 415-555-2671. Mail bob.smith9@x.org, I am bob.smith9. Order 1234567."


def test_similar_mentions_take_the_label_of_the_entity(spark):
    known = [(i, f"Call +1 (415) 555-26{i:02d} or mail ann.{i}x@y.org at 10.0.0.{i}, {i} times ann.{i}x@y.org") for i in range(40)]
    df = spark.createDataFrame([*known, (98, PRIVATE), (99, "Order 1234567 of 7654321 in 2020"), (100, None), (101, "")], DOCS)
    field = pii_crf.fit(df)
    found = {r["doc_id"]: r for r in pii_crf.find(df, field).collect()}
    texts = [PRIVATE[int(s.split(":")[1]) : int(s.split(":")[2])] for s in found[98]["spans"].split(",")]
    assert texts == ["bob.smith9@x.org", "bob.smith9", "+1 (415) 555-2671", "415-555-2671"]
    assert found[98]["n_email"] == found[98]["n_phone"] == 1 and found[98]["n_ip"] == found[98]["n_card"] == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert all(found[i]["spans"] == "" and found[i]["base_sha256"] == empty for i in (99, 100, 101))
    masked = {r["doc_id"]: r["text"] for r in pii_crf.mask(df.withColumn("c0", F.lit(1)), field).collect()}
    assert masked[98] == "Call [PHONE] now or [PHONE]. Mail [EMAIL], I am [EMAIL]. Order 1234567."
    assert masked[99] == "Order 1234567 of 7654321 in 2020" and masked[100] is None and masked[101] == ""


@pytest.mark.parametrize("times", [1, 2, 3, 5, 8, 20, 200])
@pytest.mark.parametrize("other", ["14155550100", "415-555-0100", "1 415.555.0100"])
def test_repeats_do_not_unmask_a_number(times, other):
    field = pii_crf.Field.fitted({("shape", s, pii_crf.NONE): 10**6 for s in range(80)})  # shapes that are never personal data
    text = "Call +1 415 555 0100 now." + f" Ref {other} again," * times + " order 7654321 of 1234567."
    base = pii_crf.base_spans(text)
    added = field.added(pii_crf.mentions(text, base))
    assert [text[a:b] for _, a, b in added] == [other] * times
    assert other not in pii_crf.masked(text, base + added)


def test_long_digit_groups_are_whole_mentions():
    text = "No 1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6-7-8-9-0 end"
    assert [(m.start, m.end) for m in pii_crf.mentions(text, [])] == [(3, len(text) - 4)]


def _exact_marginals(field, found, links):
    exact = np.zeros((len(found), 5))
    for state in np.ndindex(*[5] * len(found)):
        if all(m.label in (pii_crf.NONE, x) for m, x in zip(found, state)):
            score = sum(field.shape[m.shape, x] for m, x in zip(found, state) if m.label == pii_crf.NONE)
            score += sum(field.chain[state[i], state[i + 1]] for i in range(len(found) - 1))
            score += sum(field.skip[state[i], state[j]] for i, j in links)
            for i, x in enumerate(state):
                exact[i, x] += np.exp(score)
    return exact / exact.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("keys,worst,mean", [(2, 0.15, 0.01), (99, 1e-5, 1e-5)])
def test_loopy_marginals_are_near_the_exact_ones(keys, worst, mean):
    """Exact where edges make no loop; elsewhere off by at most 0.15 and 0.01 in the mean."""
    rng, off = np.random.default_rng(3), []
    for _ in range(40):
        shape = np.maximum(-1.5 * np.abs(rng.normal(size=(pii_crf.SHAPES, 5))), -pii_crf.SHAPE_MOST)
        field = pii_crf.Field(shape, np.clip(rng.normal(size=(5, 5)) / 2, -1, 1), np.eye(5) * pii_crf.SKIP_PRIOR[0])
        found = [pii_crf.Mention(i, i + 1, int(rng.choice([3, 4, 4])), int(rng.integers(80)), (f"d{rng.integers(keys) if keys < 9 else i}",)) for i in range(5)]
        links = pii_crf.skip_edges(found)
        belief, settled = field.marginals(found, links)
        assert settled
        off.append(np.abs(belief - _exact_marginals(field, found, links)).max())
    assert max(off) <= worst and np.mean(off) <= mean


def test_masked_base_mentions_are_recovered(spark):
    """Every second repeat of a base mention is taken as unknown; the field gives its kind back."""
    rng = random.Random(5)
    given = []
    for i in range(150):
        phone, card = f"+1 415 555 {rng.randrange(10**4):04d}", "4111 1111 1111 1111"
        given.append((i, f"Call {phone} or {phone}. Pay {card}, {card}. Order {rng.randrange(10**6, 10**7)} here."))
    field = pii_crf.fit(spark.createDataFrame(given, DOCS))
    hidden = right = 0
    for _, text in given:
        found = pii_crf.mentions(text, pii_crf.base_spans(text))
        seen: set = set()
        for m in found:
            if m.label != pii_crf.NONE and m.keys[0] in seen:
                hidden += 1
                m.label, truth = pii_crf.NONE, m.label
                right += (truth, m.start, m.end) in field.added(found)
                m.label = truth
            seen.add(m.keys[0])
    assert hidden >= 300 and right >= 0.95 * hidden


def test_personal_data_without_rows(none):
    assert pii_crf.find(none, pii_crf.fit(none)).count() == 0


# 4, html


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) "</p>"</script></head><body><nav><a href="/x">Home page</a>
</nav><div class="side-ad">Buy now cheap things today</div><article><h1>A &amp; B</h1><p>One <b>bold</b>
 word&nbsp;here.<br>Next</p><aside>Note of the editor</aside><p>Two &lt;tags&gt; &#233; and more words in it</p>
<div id="comments"><p>I disagree with all of this, says a reader</p></div></article><footer>Copyright words</footer></body></html>"""


def test_main_text(spark):
    given = [(1, "u", PAGE), (2, "v", None), (3, "w", ""), (4, "x", "<nav>only a menu</nav>"), (5, "y", "plain & simple <b"),
             (6, "z", PAGE[: PAGE.index("Two") + 9])]
    df = spark.createDataFrame(given, "page_id long, url string, html string")
    out = {r["page_id"]: r for r in html_region.extract(df, html_region.fit(df)).collect()}
    assert out[1]["text"] == "A & B\nOne bold word here. Next\nTwo <tags> é and more words in it"
    assert [out[i]["text"] for i in (2, 3, 4)] == ["", "", ""] and out[5]["text"] == "plain & simple"
    assert out[6]["text"] == "A & B\nOne bold word here. Next\nTwo <t"
    assert all(r["n_chars"] == len(r["text"]) for r in out.values())
    assert html_region.extract(df.limit(0), html_region.fit(df.limit(0))).count() == 0


@pytest.mark.parametrize("inner", [
    '<p class="ad">Buy this', '<ul><li>Keep one<li class="comment">I disagree<li>Keep two</ul>', '<p>Keep <span class="share">Share this</span> three',
    '<p class="cookie-notice">We use cookies</p>', '<table><tr><td>Keep<td>cells<tr class="promo"><td>Now<td>cheaper</table>',
    "<div hidden>Unseen</div>", '<div style="display: none">Unseen</div>', '<section class="advertorial"><p>Paid</p></section>',
    '<div class="cta">Act now</div>', '<div class="poll">Vote here</div>', '<div class="author-bio">Ann writes</div>',
    '<p class="tags">one, two</p>', '<div class="pagination">Page 2 of 3</div>', '<p aria-hidden="true">Unseen</p>',
])
def test_marks_of_every_element_inside_an_article(inner):
    words = "Some words of the article that go on for a while and then on and on again."
    page = f"<main><h1>Title</h1><p>{words}{inner}<p>{words}</main>"
    weights = html_region.weights_from(html_region.Page(PAGE).counts())
    gone = ("Buy", "disagree", "Share", "cookies", "Now", "Unseen", "Paid", "Act", "Vote", "Ann", "one, two", "Page 2")
    text = html_region.Page(page).main_text(weights)
    assert text.count(words) == 2 and not any(g in text for g in gone)
    kept = [k for k in ("Keep one", "Keep two", "three", "cells") if k in inner]
    assert all(k in text for k in kept)


def test_unmatched_end_tags_take_linear_time():
    def seconds(n):
        page = "<article><p>word " + "<div>" * n + "</ul>" * n + "<i>" * n + "</b>" * n + "text"
        start = time.process_time()
        html_region.Page(page)
        return time.process_time() - start

    seconds(1000)
    assert seconds(32_000) < 16 * max(seconds(4_000), 0.01)


def test_very_long_page():
    page = "<article>" + "<p>one two</p>" * 60_000 + "</article>"
    assert html_region.Page(page).main_text(html_region.weights_from({})) == "\n".join(["one two"] * 60_000)


@pytest.mark.parametrize("opening,closing", [
    ('<div class="has-sidebar">', "</div>"), ('<div class="layout-with-nav">', "</div>"),
    ('<section class="social-policy">', "</section>"), ("<form id=f>", "</form>"), ('<div class="has-comments"><form>', "</form></div>"),
])
def test_wrappers_of_the_content_are_kept(opening, closing):
    want = "A & B\nOne bold word here. Next\nTwo <tags> é and more words in it"
    weights = html_region.weights_from(html_region.Page(PAGE).counts())
    body = lambda page: page.replace("<nav>", opening + "<nav>", 1).replace("</footer>", "</footer>" + closing)
    inner = lambda page: page.replace("<article>", "<article>" + opening).replace("</article>", closing + "</article>")
    for page in (body(PAGE), inner(PAGE).replace('<div id="comments"', '<p></p><div id="comments"'), body(inner(PAGE))):
        assert html_region.Page(page).main_text(weights) == want
        assert html_region.Page(page).counts()["word", True] == html_region.Page(PAGE).counts()["word", True]
    plain = PAGE.replace("article>", "div>")
    assert html_region.Page(body(plain)).main_text(weights) == html_region.Page(plain).main_text(weights) != ""


def test_blocks_of_a_page_builder_are_kept_and_comments_are_not():
    weights = html_region.weights_from(html_region.Page(PAGE).counts())
    blocks = "".join(f'<div class="elementor-widget"><p>Part {i} of the text in a block</p></div>' for i in range(5))
    talk = "<div id='comments'>" + "<article class='comment'><p>I think that all of this is wrong</p></article>" * 9 + "</div>"
    share = "<div class='share'><p>Share this with friends</p></div>"
    page = f"<main><div class='elementor-widget-wrap'>{blocks}</div>{share}{talk}</main>"
    want = "\n".join(f"Part {i} of the text in a block" for i in range(5))
    assert html_region.Page(page).main_text(weights) == want
    related = "<div class='related'><article><p>Another story</p></article></div>"
    page = f"<div class='has-nav'><article>{blocks}</article>{related}</div>"
    assert html_region.Page(page).main_text(weights) == want


def test_best_run_is_the_maximum():
    page = html_region.Page(PAGE)
    weights = html_region.weights_from(page.counts())
    value = [
        weights.get(f, weights["other"]) if t is None else 0 if o.out else weights[f] * len(t.split())
        for f, t, o in zip(page.features, page.texts, page.owners)
    ]
    start, end = page.region(weights)
    best = max(sum(value[i:j]) for i in range(len(value)) for j in range(i, len(value) + 1))
    assert np.isclose(sum(value[start:end]), best)


def test_page_without_article_gives_whole_blocks_of_the_run():
    links = "<ul>" + "<li><a href=/x>Go there</a></li>" * 12 + "</ul>"
    text = "<p>The first of two long <b>paragraphs</b> has these words in it</p><p>and the second one has as many more of them</p>"
    weights = html_region.weights_from({})
    for page in (f"<body>{links}{text}{links}</body>", f"<body><div>{links}{text}{links}<p>Imprint</p></div></body>"):
        assert html_region.Page(page).main_text(weights) == (
            "The first of two long paragraphs has these words in it\nand the second one has as many more of them")


# 5, byte-level BPE


def test_ids_are_those_of_the_library(spark, ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["".join(rng.choice("aabcñé   \n\t\0\r1.,!'s<|>日本🙂the　") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["aaaaaaaaaaaaaaaaaaaaaaaa", "the " * 3000, " " * 700 + "x", "    z", "<|endoftext|>"]
    texts += [t for _, t in brute.documents() if t]
    encoder = byte_bpe.TextEncoder(byte_bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    for text in texts:
        ids = ",".join(part for _, part in encoder.encoded([text]))
        assert [int(i) for i in ids.split(",") if i] == library.encode_ordinary(text), text
        assert encoder.decoded(ids) == text.encode()
    df = spark.createDataFrame([*enumerate(texts), (-1, None), (-2, "")], DOCS)
    encoded = byte_bpe.encode(df, ranks, public_tokenizers.PATTERN)
    back = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(encoded, ranks).collect()}
    assert back == {**{i: t.encode() for i, t in enumerate(texts)}, -1: b"", -2: b""}
    digests = {r["doc_id"]: r for r in byte_bpe.round_trip(df, ranks, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text)
        assert digests[i]["n_tokens"] == len(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_long_texts_are_cut_without_a_trace(ranks, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 20)
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 3)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.TextEncoder(byte_bpe.Vocabulary(ranks), public_tokenizers.PATTERN)
    for text in ("a few words that go on, and on; " * 5, "tabs\t \tand  spaces   here \n " * 5, "x" * 90):
        ids = ",".join(part for _, part in encoder.encoded([text]))
        assert list(map(int, ids.split(","))) == library.encode_ordinary(text)


# 6, quality


def test_quality_on_held_out_rows(spark):
    from pyspark.sql import SparkSession  # noqa: F401

    folder = "/root/testdata/sf0.01"
    out = queries.QUERIES["op6_nbsvm_quality"](spark, folder)
    assert out.count() == 1000 and out.filter("score < 0 or score > 1 or (score >= 0.3) != (predicted = 1)").count() == 0
    labelled = out.join(common.read(spark, folder, "labels"), "doc_id").filter("held_out").toPandas()
    good, bad = labelled[labelled.quality == 1].score, labelled[labelled.quality == 0].score
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert (good >= 0.3).mean() > 0.97


def test_quality_of_odd_tables(spark, docs, none):
    labels = "doc_id long, quality int"
    for given, score in (([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, None), (2, 7)], 0.5)):
        model = nbsvm.fit(docs, spark.createDataFrame(given, labels))
        found = nbsvm.score(docs, model).toPandas()["score"]
        assert len(found) == docs.count() and np.allclose(found, score, atol=1e-5)
    model = nbsvm.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(50)] + [(3, 0)], labels))
    assert nbsvm.score(none, model).count() == 0
    named = nbsvm.score(docs.withColumn("score", F.lit(9)), model, keep=("score",))
    assert named.columns == ["doc_id", "score"]  # the new one takes its place
    assert named.filter("score between 0 and 1").count() == docs.count()


def test_quality_fit_collects_a_bounded_number_of_rows(spark, monkeypatch):
    given = [(1, f"copy {i % 7}") for i in range(300)] + [(i, f"text {i}") for i in range(2, 30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, quality int")
    df = spark.createDataFrame(given, DOCS).repartition(5)
    collected, seen, plain, train = [], [], type(df).toPandas, nbsvm.train
    monkeypatch.setattr(type(df), "toPandas", lambda self: collected.append(plain(self)) or collected[-1])
    monkeypatch.setattr(nbsvm, "train", lambda rows, labels: seen.append((rows, labels)) or train(rows, labels))
    nbsvm.fit(df, labels, rows=50)
    assert [len(c) for c in collected] == [50]
    # Key 1 sorts first as text, and its rows by their features.
    known, flags = common.WordHashes(), np.zeros(nbsvm.BUCKETS, dtype=bool)
    want = sorted(nbsvm.features(t, known, flags).tobytes() for k, t in given if k == 1)[:50]
    assert [r.tobytes() for r in seen[0][0]] == want and set(seen[0][1].tolist()) == {1}


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    found = [np.sort(rng.choice(200, 20, replace=False)).astype(np.int32) for _ in range(120)]
    labels = np.array([int(5 in set(x) or 9 in set(x) or rng.random() < 0.2) for x in found])
    ratio = np.zeros(nbsvm.BUCKETS)
    ratio[:200] = rng.normal(size=200)
    weight, bias = nbsvm.descend(found, labels, ratio)
    again, other = nbsvm.descend(found, labels, ratio)
    assert np.array_equal(weight, again) and bias == other
    # Against the dual problem solved by projected gradients on the whole matrix.
    x = np.zeros((120, 201))
    for i, at in enumerate(found):
        x[i, at] = ratio[at] / np.sqrt(np.square(ratio[at]).sum())
    x[:, 200] = 1
    sign = np.where(labels == 1, 1.0, -1.0)
    cost = nbsvm.COST * 0.5 / np.where(labels == 1, (labels == 1).mean(), (labels == 0).mean())
    gram = (x * sign[:, None]) @ (x * sign[:, None]).T
    alpha, step = np.zeros(120), 1 / np.linalg.eigvalsh(gram).max()
    for _ in range(20_000):
        alpha = np.clip(alpha - step * (gram @ alpha - 1), 0, cost)
    primal = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - sign * (x @ w))).sum()
    own = np.append(weight[:200] / ratio[:200], bias)
    best = primal(x.T @ (alpha * sign))
    assert np.isclose(primal(own), best, rtol=1e-3)


# 7, repeated passages


@pytest.mark.parametrize("seed", [7, 8])
def test_repeats_against_brute_force(spark, seed):
    given = brute.documents(seed)
    out = recompression.repeat_report(spark.createDataFrame(given, DOCS).repartition(7))
    assert rows(out) == ordered(brute.repeats(given))


def test_runs_and_periods_are_covered(spark):
    given = [(1, "a " * 80), (2, "x " + "a " * 55 + "y"), (3, "p q " * 40), (4, "q " + "p q " * 30), (5, "p q r " * 60), (6, "r p q " * 17)]
    out = recompression.repeat_report(spark.createDataFrame(given, DOCS))
    assert rows(out) == ordered(brute.repeats(given))


def test_removal_keeps_other_columns(spark, docs, none):
    wide = docs.withColumns({"key": F.lit("k"), "runs": F.lit(1)})
    out = recompression.remove_repeats(wide)
    assert out.columns == wide.columns and out.count() == wide.count()
    kept = {r["doc_id"]: hashlib.sha256(" ".join((r["text"] or "").split(" ")).encode()).hexdigest()
            for r in out.filter("doc_id between 10 and 20").collect()}
    want = {k: h for k, _, n, h in brute.repeats(brute.documents()) if k is not None and 10 <= k <= 20 and n}
    assert all(kept[k] == h for k, h in want.items())
    assert recompression.repeat_report(none).count() == 0


# 8, vectors


def _vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 16))
    out = []
    for i in range(300):
        out.append((i, (base[i % 12] + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.6])).tolist()))
    out += [(300, out[0][1]), (301, out[0][1]), (0, out[5][1]), (302, None), (303, []), (304, [0.0] * 16),
            (305, [float("nan")] + [1.0] * 15), (306, [None] + [1.0] * 15), (307, [1.0, 2.0]), (308, [2.0, 4.0]),
            (309, [x * 1e-30 for x in out[7][1]]), (None, out[9][1])]
    return out


@pytest.mark.parametrize("block", [1024, 5])
def test_links_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(rotation_codes, "BLOCK", block)
    given = _vectors()
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    out = rotation_codes.near_duplicates(df)
    assert out.count() == len(given)
    units = [rotation_codes._unit(v) for _, v in given]
    good = lambda i, j: units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9
    want = [sum(good(i, j) for j in range(len(given)) if j != i) for i in range(len(given))]
    found = rows(out, "vec_id", "n_links")
    assert sum(n for _, n in found) >= 0.9 * sum(want)
    assert all(a[1] <= b[1] for a, b in zip(found, ordered(list(zip([k for k, _ in given], want)))))
    names = dict(zip(range(len(given)), brute.components([k for k, _ in given], good)))
    got = rows(out, "vec_id", "component_id")
    assert got == ordered([(k, names[i]) for i, (k, _) in enumerate(given)])
    assert out.filter(~F.col("vec_id").eqNullSafe(F.col("component_id")) & F.col("kept")).count() == 0
    assert rotation_codes.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.normal(size=x.shape) * 0.05
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    value, error = rotation_codes.estimates(x, y)
    miss = value - x @ y.T
    assert abs(miss.mean()) < 0.01 and (np.abs(miss) <= error).mean() > 0.999


# 9, similarity join


@pytest.mark.parametrize("seed,percent", [(7, 85), (11, 70)])
def test_components_against_brute_force(spark, seed, percent):
    given = brute.documents(seed, 90)
    sets = [brute.shingles(t, 4) for _, t in given]
    linked = lambda i, j: bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    names = brute.components([k for k, _ in given], linked)
    df = spark.createDataFrame(given, DOCS).repartition(6)
    out = token_groups.link_components(df, percent=percent)
    assert rows(out) == ordered([(k, len(s), n) for (k, _), s, n in zip(given, sets, names)])


def _with_groups(monkeypatch, given, group_of):
    """Put each text into the group that `group_of` names, in place of its min-hash keys."""
    identity = token_groups.identity
    group = {identity(token_groups.token_set(t, 4, common.WordHashes()))[0]: g for (_, t), g in zip(given, group_of)}
    monkeypatch.setattr(token_groups, "group_keys", lambda tokens: [group[identity(tokens)[0]]])


def _span(first, last):
    return " ".join(f"v0x{i}" for i in range(first, last))


def test_crossed_chain_between_two_groups(spark, monkeypatch):
    # A chain 1-2-3-4; 1 and 4 are the heads of their groups, as each has copies with two edits there.
    given = [(1, _span(-8, 200)), (2, _span(12, 212)), (3, _span(24, 224)), (4, _span(36, 244))]
    edited = lambda n, k: " ".join(f"edit{k}n{n}" if i in (60 + 30 * k, 75 + 30 * k) else w for i, w in enumerate(given[n - 1][1].split()))
    given += [(10 * k + n, edited(n, k)) for n in (1, 4) for k in (1, 2, 3)]
    sets = [brute.shingles(t, 4) for _, t in given]
    linked = lambda i, j: 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    assert [(i + 1, j + 1) for i in range(4) for j in range(i) if linked(i, j)] == [(2, 1), (3, 2), (4, 3)]
    assert not any(linked(i, j) for i in range(4, 10) for j in (1, 2))
    _with_groups(monkeypatch, given, [0, 1, 0, 1, 0, 0, 0, 1, 1, 1])
    out = token_groups.link_components(spark.createDataFrame(given, DOCS))
    assert rows(out, "doc_id", "component_id") == [(k, 1) for k in sorted(k for k, _ in given)]


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_edits_in_any_groups(spark, monkeypatch, seed):
    rng = random.Random(seed)
    given = []
    for chain in range(25):
        at = 1000 * chain
        for _ in range(rng.randint(2, 7)):
            given.append((len(given), _span(at - rng.randint(0, 8), at + 200 + rng.randint(0, 8))))
            at += rng.randint(6, 18)
    sets = [brute.shingles(t, 4) for _, t in given]
    linked = lambda i, j: 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    names = brute.components([k for k, _ in given], linked)
    _with_groups(monkeypatch, given, [rng.randrange(12) for _ in given])
    out = token_groups.link_components(spark.createDataFrame(given, DOCS).repartition(4))
    assert rows(out, "doc_id", "component_id") == [(k, n) for (k, _), n in zip(given, names)]


@pytest.mark.parametrize("copies", [12, 40])
def test_copies_of_another_original_meet_in_linear_work(spark, monkeypatch, copies):
    # A group whose head is one original; the near copies of another share what the head lacks.
    rng = random.Random(copies)
    start = _span(0, 120)
    head = [(i, start + " " + _span(1000, 1200)) for i in range(1)]
    given = head + [(1 + i, start + " " + _span(1000, 1190 + i)) for i in range(6)]
    for i in range(copies):
        words = (start + " " + _span(2000, 2200)).split()
        for at in rng.sample(range(125, 310), 2):
            words[at] = f"edit{i}x{at}"
        given.append((100 + i, " ".join(words)))
    sets = [brute.shingles(t, 4) for _, t in given]
    linked = lambda i, j: 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    names = brute.components([k for k, _ in given], linked)
    assert len(set(names)) >= 2
    _with_groups(monkeypatch, given, [0] * len(given))
    opened = []
    compared = token_groups._compared
    monkeypatch.setattr(token_groups, "_compared", lambda pairs, *rest: (opened.append(pairs.count()), compared(pairs, *rest))[1])
    out = token_groups.link_components(spark.createDataFrame(given, DOCS).repartition(4))
    assert rows(out, "doc_id", "component_id") == [(k, n) for (k, _), n in zip(given, names)]
    assert max(opened[1:]) <= 3 * len(given)


def test_join_without_rows(none):
    assert token_groups.link_components(none).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_connected_components(spark, shape):
    rng = random.Random(3)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 60)] + [(70, 71), (71, 71)],
             "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]}[shape]
    nodes = sorted({n for e in edges for n in e})
    want = brute.components(nodes, lambda i, j: (nodes[i], nodes[j]) in edges or (nodes[j], nodes[i]) in edges)
    out = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert rows(out, "node", "component") == sorted(zip(nodes, want))


# 10, decontamination


def test_leaks_against_brute_force(spark, docs, none):
    given = brute.documents()
    items = [(i, " ".join((given[3 * i + 3][1] or "").split()[5 : 5 + 9 + i])) for i in range(15)]
    items += [(50, "One"), (51, None), (52, ""), (53, "again again again"), (54, items[2][1].upper() + " tail"), (2, items[2][1])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    out = simhash_windows.find_leaks(docs, bench)
    found = {(r["doc_id"], r["item_id"], round(r["similarity"], 6)) for r in out.collect()}
    want = brute.leaks(given, items)
    assert found <= want and len(found) >= 0.98 * len(want) > 20
    clean = simhash_windows.drop_leaks(docs.withColumn("c0", F.lit(2)), bench)
    texts = {t for d, t in given if d in {x[0] for x in found}}
    assert {r["text"] for r in clean.collect()} == {t for _, t in given} - texts
    assert simhash_windows.find_leaks(none, bench).count() == simhash_windows.find_leaks(docs, bench.limit(0)).count() == 0


def test_every_fingerprint_within_the_radius_is_found():
    rng = np.random.default_rng(1)
    known = common.WordHashes()
    tables = simhash_windows.ItemTables([(i, simhash_windows.words_of(" ".join(map(str, rng.integers(0, 99, 20))), known)) for i in range(30)])
    for item in range(30):
        for bits in (0, 5, simhash_windows.RADIUS):
            flip = sum(1 << int(b) for b in rng.choice(64, bits, replace=False))
            near = tables.near(np.array([int(tables.prints[item]) ^ flip], dtype=np.uint64), np.ones(30, dtype=bool))
            assert item in near[:, 1]


# the pipeline


def test_pipeline_stages_against_plain_versions(spark):
    docs = common.read(spark, FOLDER, "documents")
    names = docs.columns
    kept = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "tokens"]
    good = kept["quality"](spark, docs, FOLDER).cache()
    assert good.columns == names and 0 < good.count() < docs.count()
    one = kept["near_duplicates"](spark, good, FOLDER).cache()
    given = [(r["doc_id"], r["text"]) for r in good.collect()]
    sets = [brute.shingles(t, 5) for _, t in given]
    linked = lambda i, j: bool(sets[i]) and bool(sets[j]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    assert {r["doc_id"] for r in one.collect()} == set(brute.components([k for k, _ in given], linked))
    clean = kept["decontamination"](spark, one, FOLDER).cache()
    items = [(r["item_id"], r["text"]) for r in common.read(spark, FOLDER, "benchmark").collect()]
    left = [(r["doc_id"], r["text"]) for r in one.collect()]
    leaked = {d for d, _, _ in brute.leaks([x for x in left if len(x[1]) < 4000], items)}
    assert not leaked & {r["doc_id"] for r in clean.collect()}
    masked = kept["personal_data"](spark, clean, FOLDER).cache()
    assert masked.columns == names and masked.count() == clean.count()
    for r in masked.collect():
        assert not pii_crf.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    ids = kept["tokens"](spark, masked, FOLDER)
    ranks = byte_bpe.load_ranks(public_tokenizers.path(queries.VOCABULARY))
    back = {r["doc_id"]: bytes(r["decoded"]).decode() for r in byte_bpe.decode(ids, ranks).collect()}
    assert back == {r["doc_id"]: r["text"] for r in masked.collect()}


def test_near_duplicates_stage_takes_five_words_and_four_fifths(spark):
    given = []
    for i in range(4):
        words = [f"w{i}x{j}" for j in range(100)]
        given.append((4 * i, " ".join(words)))
        given.append((4 * i + 1, " ".join([*words, *[f"new{i}x{j}" for j in range(18 + 2 * i)]])))
        given.append((4 * i + 2, " ".join(words[: 84 - 3 * i])))
        given.append((4 * i + 3, " ".join("edit" if j in (30 + i, 60 + i) else w for j, w in enumerate(words))))
    sets = [brute.shingles(t, 5) for _, t in given]
    share = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    pairs = [share(4 * i, 4 * i + k) for i in range(4) for k in (1, 2, 3)]
    assert sum(0.8 <= s < 0.85 for s in pairs) >= 8 and min(pairs) < 0.8
    names = brute.components([k for k, _ in given], lambda i, j: share(i, j) >= 0.8)
    df = spark.createDataFrame(given, DOCS)
    assert [k for k, _ in rows(stages.near_duplicates(spark, df, FOLDER), "doc_id", "text")] == sorted(set(names))


CLASHING = ["score", "kept_id", "key", "c0", "c1", "component_id", "n_shingles", "__key", "__text", "__score", "n_tokens2", "spans", "class"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_carry_columns_of_any_name(spark, name):
    docs = common.read(spark, FOLDER, "documents").filter("doc_id < 60")
    wide = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING})
    stage = dict(corpus_pipeline.STAGES)[name]
    plain, out = stage(spark, docs, FOLDER), stage(spark, wide, FOLDER)
    assert rows(out, "doc_id") == rows(plain, "doc_id")
    if name != "tokens":
        assert out.columns == wide.columns
        assert out.filter(" or ".join(f"`{c}` <> concat('{c}', doc_id)" for c in CLASHING)).count() == 0


def test_pipeline_keeps_odd_texts(spark, ranks):
    odd = spark.createDataFrame(
        [(1, None, "en", None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "x " * 60000, None, "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:]:
        odd = stage(spark, odd, FOLDER)
        assert odd.count() == 3, name
    assert stages.QUALITY_CUT == 0.3 and corpus_pipeline.ORACLE_SQL is None
