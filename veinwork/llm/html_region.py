"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Words score positive and tags negative; the weights are
log odds of standing in an article rather than outside it, counted over all pages that mark
their article (`article` or `main` elements), which label themselves. One linear scan finds the
contiguous run with the largest sum. The outermost article that holds the run, or else the run
extended to whole blocks, is the content region; elements in it that are no part of an article
(menus, adverts, forms, notices, reader comments and the like, by tag, role or class) are left
out. So is what is hidden, and every kind of element is judged, down to a line of a list or a span
of text.

A role or class, or being a form, leaves out no wrapper of the content: no element that holds
`main`, most words of the page's articles, or most words of what it stands in (its article, or
else the page). Where such elements of one mark hold most of those words together, as the blocks
of some page builders do, the mark says nothing there. Readers' comments may outweigh an article,
so for their marks `most` is nine tenths.

Inside a block, character references are decoded and white space becomes one space; blocks are
joined in page order by one line feed. Nothing is capped: the whole page is scanned.

Null and empty pages, and pages without words outside such elements, give an empty text. Of
equal sums the first run counts. Cut-off tags and comments run to the end of the page. Without
any labelled page the weights are those of their bounds. Rows are independent.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.llm.common import arrow_map

# Fixed lists: HTML element names by what they mean here.
ARTICLES = frozenset("article main".split())
RAW = frozenset("script style noscript template textarea iframe svg title".split())
LEFT_OUT = frozenset(
    "script style noscript template textarea iframe svg title head nav footer aside button select dialog menu".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
# Elements that build the page: only their own end tags, or those of elements around them, close them.
NESTING = frozenset(
    "html head body article main section div nav aside header footer form ul ol dl table figure dialog menu button select "
    "blockquote fieldset details".split()
)
# Elements without content, and those whose start ends an open one of the same list or table.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"),
        "tbody": ("td", "th", "tr"), "option": ("option",)}
INLINE_LINK = "a"
# Words in class, id or role that mark what is no part of an article.
MARKS = frozenset(
    "ad ads advert advertorial adverts advertisement advertising banner bio breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies cta discussion disqus footer gdpr menu modal nav navbar navigation newsletter notice "
    "notices notification pager pagination paywall poll popup promo promoted recommended related replies responses share sharing "
    "sidebar signup skip social sponsor sponsored subscribe tags toolbar widget".split()
)
# Marks of what readers write; and the share of words, in tenths, above which an element is a wrapper.
READERS = frozenset("comment comments discussion disqus replies responses".split())
WRAPPER_TENTHS, READERS_TENTHS = 5, 9

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|</?[A-Za-z!?][^>]*+(?:>|\Z)"
    r"|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
HIDDEN = re.compile(
    r"(?:^|\s)(?:hidden(?=[\s=/]|\Z)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"']?[^\"']*(?:display\s*:\s*none|visibility\s*:\s*hidden))", re.I)
PART = re.compile(r"[a-z]+")
WHOLE = frozenset("html body article main".split())  # never left out by an attribute
LEAST_WORD, LEAST_TAG = 0.25, 0.5  # bounds that keep words positive and tags negative
MOST = 12.0


class Element:
    __slots__ = ("name", "parent", "out", "marks", "article", "first", "last", "frame", "open")

    def __init__(self, name: str, parent: Element | None, attributes: str, first: int):
        self.name, self.parent, self.first, self.last = name, parent, first, -1
        inside = bool(parent and parent.article)
        self.out = bool(parent and parent.out) or name in LEFT_OUT or name == "header" and not inside
        if name not in WHOLE and attributes and not self.out and HIDDEN.search(attributes):
            self.out = True
        self.marks = _marks(name, attributes)
        # The outermost article or main element that this one is in, or is.
        self.article = parent.article if inside else self if name in ARTICLES else None
        # The nearest element that builds the page, and how many of its open elements have each name.
        nests = parent is None or name in NESTING
        self.frame = self if nests else parent.frame
        self.open = Counter() if nests else None
        if not nests:
            self.frame.open[name] += 1


def _marks(name: str, attributes: str) -> set[str]:
    """What marks an element as no part of an article: words of class, id and role, or being a form."""
    found = {"form"} if name == "form" else set()
    if name not in WHOLE and "=" in attributes:
        for m in ATTRIBUTE.finditer(attributes):
            found |= MARKS.intersection(PART.findall(m.group(1).lower()))
    return found


def _most(words: int, of: int, mark: str) -> bool:
    return 10 * words > (READERS_TENTHS if mark in READERS else WRAPPER_TENTHS) * of


class Page:
    """The words and tags of a page: parallel lists of feature, text (words only) and element."""

    def __init__(self, html: str):
        self.features: list[str] = []
        self.texts: list[str | None] = []
        self.owners: list[Element] = []
        self.breaks: list[bool] = []
        here = root = Element("", None, "", 0)
        self.elements = [root]
        nested: Counter = Counter()  # open elements that build the page, by name
        link, at = False, 0
        while True:
            m = TOKEN.match(html, at)
            if m is None:
                break
            at = m.end()
            name = m.group(2)
            if name is None:
                part = m.group()
                if part[0] == "<" and len(part) > 1:
                    continue  # a comment, a declaration or a broken tag
                self._add("link word" if link else "word", unescape(part), here, False)
                continue
            name, closing = name.lower(), bool(m.group(1))
            if name in RAW and not closing:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
                self._add(name, None, here, name in BLOCKS)
                continue
            if name == INLINE_LINK:
                link = not closing
            if not closing and name not in VOID:
                for ended in ("p",) if name in BLOCKS else ():
                    here = self._ended(here, ended)
                for ended in ENDS.get(name, ()):
                    here = self._ended(here, ended)
                here = Element(name, here, m.group(3), len(self.features))
                self.elements.append(here)
                nested[name] += name in NESTING
            self._add(("/" if closing else "") + name, None, here, name in BLOCKS)
            if closing and name in NESTING and nested[name]:
                while True:
                    here.last, gone, here = len(self.features), here.name, here.parent
                    nested[gone] -= gone in NESTING
                    if gone == name:
                        break
            elif closing and name not in NESTING:
                here = self._ended(here, name)
        for one in self.elements:
            if one.last < 0:
                one.last = len(self.features)
        # What readers write goes first, so that it weighs nothing when the other marks are judged.
        for readers in (True, False):
            if any((mark in READERS) == readers for one in self.elements for mark in one.marks):
                self._judge(readers)

    def _ended(self, here: Element, name: str) -> Element:
        """Close the innermost open element of this name in the frame, if there is one, and all in it."""
        frame = here.frame
        if not frame.open[name]:
            return here
        while True:
            here.last, gone, here = len(self.features), here.name, here.parent
            frame.open[gone] -= 1
            if gone == name:
                return here

    def _judge(self, readers: bool) -> None:
        """Leave out the elements whose marks, of READERS or the others, hold, and all that is in them."""
        total = [0]  # words before each place that are not left out so far
        inside = [0]  # of those, words in articles
        mains = [0]
        for feature, text, owner in zip(self.features, self.texts, self.owners, strict=True):
            n = 0 if text is None or owner.out else len(text.split())
            total.append(total[-1] + n)
            inside.append(inside[-1] + (n if owner.article else 0))
            mains.append(mains[-1] + (feature == "main"))
        words = lambda e, of=total: of[e.last] - of[e.first]
        root = self.elements[0]
        holding: dict[Element, set[str]] = {}
        above: dict[Element, frozenset[str]] = {root: frozenset()}  # marks of an element and of those around it
        together: Counter = Counter()
        for e in self.elements[1:]:
            around = above[e.parent] if e.parent.article is e.article else frozenset()
            if not e.marks:
                above[e] = around
                continue
            base, held = e.article or root, set()
            for mark in (m for m in e.marks if (m in READERS) == readers):
                wraps = not e.article and (words(e, mains) > 0 or _most(words(e, inside), inside[-1], mark))
                if not wraps and not _most(words(e), words(base), mark):
                    held.add(mark)
            for mark in held - around:
                together[base, mark] += words(e)
            holding[e], above[e] = held, around | held
        for e in self.elements[1:]:
            base = e.article or root
            e.out = e.out or e.parent.out or any(not _most(together[base, m], words(base), m) for m in holding.get(e, ()))

    def _add(self, feature: str, text: str | None, owner: Element, breaks: bool) -> None:
        self.features.append(feature)
        self.texts.append(text)
        self.owners.append(owner)
        self.breaks.append(breaks)

    def labelled(self) -> bool:
        return any(e.name in ARTICLES for e in self.elements)

    def counts(self) -> Counter:
        """(feature, inside) to the number of words or tags."""
        out: Counter = Counter()
        for feature, text, owner in zip(self.features, self.texts, self.owners, strict=True):
            n = 1 if text is None else len(text.split())
            out[feature if feature in KNOWN else "other", owner.article is not None and not owner.out] += n
        return out

    def region(self, weights: dict[str, float]) -> tuple[int, int] | None:
        """The run of words and tags with the largest sum, as first and last + 1."""
        best, best_run, total, start = 0.0, None, 0.0, 0
        other = weights.get("other", -LEAST_TAG)
        for i, (feature, text, owner) in enumerate(zip(self.features, self.texts, self.owners, strict=True)):
            if text is None:
                total += weights.get(feature, other)
            elif not owner.out:  # words of left-out elements cannot carry a region
                total += weights[feature] * len(text.split())
            if total <= 0:
                total, start = 0.0, i + 1
            elif total > best:
                best, best_run = total, (start, i + 1)
        return best_run

    def main_text(self, weights: dict[str, float]) -> str:
        run = self.region(weights)
        if run is None:
            return ""
        words = [i for i in range(*run) if self.texts[i] is not None and not self.owners[i].out]
        holder = self.owners[words[0]]
        while holder.parent is not None and not (holder.first <= words[0] and words[-1] < holder.last):
            holder = holder.parent
        # Up to the article that the region is part of, so that short blocks at its edges stay.
        while holder is not None and holder.name not in ARTICLES:
            holder = holder.parent
        first, last = (holder.first, holder.last) if holder else run
        while not holder and first > 0 and not self.breaks[first - 1]:
            first -= 1
        while not holder and last < len(self.breaks) and not self.breaks[last]:
            last += 1
        blocks, line = [], []
        for i in range(first, last):
            if self.breaks[i]:
                blocks.append("".join(line))
                line = []
            elif self.texts[i] is None:
                if self.features[i] in ("br", "/br", "img", "wbr") and not self.owners[i].out:
                    line.append(" ")
            elif not self.owners[i].out:
                line.append(self.texts[i])
        blocks.append("".join(line))
        return "\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


KNOWN = frozenset(
    {"word", "link word"} | {slash + name for name in (BLOCKS | NESTING | LEFT_OUT | RAW | frozenset(
        "a b i em strong span u s small sub sup code img br font label input q cite time mark".split()
    )) for slash in ("", "/")}
)


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of standing in an article, bounded so that words stay positive and tags negative."""
    total = {side: sum(n for (f, s), n in counts.items() if s == side and "word" in f) + 1 for side in (True, False)}
    out = {}
    for feature in sorted(KNOWN | {"other"}):
        inside, outside = counts.get((feature, True), 0) + 1, counts.get((feature, False), 0) + 1
        odds = log(inside / total[True]) - log(outside / total[False])
        if feature in ("word", "link word"):
            out[feature] = min(max(odds, LEAST_WORD), MOST)
        else:
            out[feature] = max(min(odds, -LEAST_TAG), -MOST)
    return out


def fit(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Weights counted over all labelled pages; features are a fixed, small set."""

    def block(columns: dict) -> dict:
        counts: Counter = Counter()
        for value in columns["html"].to_pylist():
            page = Page(value or "")
            if page.labelled():
                counts.update(page.counts())
        rows = list(counts)
        return {"feature": [r[0] for r in rows], "inside": [r[1] for r in rows], "n": [counts[r] for r in rows]}

    counted = arrow_map(pages.select(F.col(html).alias("html")), block, "feature string, inside boolean, n long")
    rows = counted.groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect()
    return weights_from({(r["feature"], r["inside"]): r["n"] for r in rows})


def extract(pages: DataFrame, weights: dict[str, float], html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Per page: the columns of `keep`, text, and n_chars (its code points)."""
    kept = [f"k{i}" for i in range(len(keep))]

    def block(columns: dict) -> dict:
        texts = [Page(value or "").main_text(weights) for value in columns["html"].to_pylist()]
        return {**{k: columns[k] for k in kept}, "text": texts, "n_chars": [len(t) for t in texts]}

    kinds = [f"{k} {pages.schema[name].dataType.simpleString()}" for k, name in zip(kept, keep, strict=True)]
    rows = pages.select(*[F.col(name).alias(k) for k, name in zip(kept, keep, strict=True)], F.col(html).alias("html"))
    out = arrow_map(rows, block, ", ".join([*kinds, "text string, n_chars long"]))
    return out.toDF(*keep, "text", "n_chars")
