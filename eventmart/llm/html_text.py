"""Operator 2: main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. A word's score is the sum of log odds of where
it stands (in the page's main element or not, in what kind of boilerplate, in a link, in
what kind of block), a tag's score is that of its name and never above ``TAG_MOST``, so that
words speak for content and tags against it. The odds come from labelled pages. One
scan finds the contiguous run with the largest sum. It is widened to whole blocks, and what
is embedded in it but isn't the article (adverts, forms, comments ...) is cut out.

A word in a class or id, or a form, can also be a wrapper's around the article ("layout has-sidebar").
Such an element says nothing of what is below it if it holds most of the page's words or a main
element, unless the page has a main element elsewhere; its words are then judged like any others.
Within a main element a word that an article's own parts may have as well ("discussion", "tabs") decides
nothing: such a part is cut only if the weights, summed over its words, speak against it.
What is cut from within a main element costs the run nothing, so that a long menu doesn't split an article.

Reading is linear in the page: each element carries what its ancestors add up to, and an
unfinished tag ends where the next begins.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import slices
from eventmart.llm.labelled_pages import PAGES

#: What stands in a tag: values in quotes may hold anything, else it ends at the next angle bracket.
INSIDE = r"""(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^<>])*+"""
TOKEN = re.compile(
    rf"""(?is)<!--(?P<comment>.*?)(?:-->|\Z)|<(?P<raw>script|style|noscript|template|iframe|textarea|title)\b{INSIDE}>.*?(?:</(?P=raw)\s*>|\Z)"""
    rf"""|<(?P<close>/?)(?P<tag>[a-z][^\s/<>]*)(?P<attrs>{INSIDE})(?:>|(?=<))|<[!?][^>]*+(?:>|\Z)"""
)
ATTRIBUTE = re.compile(r"""(?is)\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
REGION = {"[": True, "]": False}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul head".split())
#: A block of these ends an open one that it can't stand in.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}

# What an element is, by its tag, its role, or a word in its class or id.
BY_TAG = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "form": "form", "button": "form", "fieldset": "form", "select": "form", "dialog": "notice", "head": "markup", "svg": "markup", "math": "markup", "canvas": "markup", "object": "markup", "audio": "markup", "video": "markup"}
BY_ROLE = {"navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer", "complementary": "sidebar", "search": "form", "form": "form", "dialog": "notice", "alert": "notice", "alertdialog": "notice"}
BY_WORD = {
    word: kind
    for kind, names in {
        "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip toolbar tabs",
        "header": "masthead topbar header",
        "footer": "footer copyright imprint legal colophon bottom",
        "sidebar": "sidebar widget widgets related recommended recommendations teaser teasers trending popular rail",
        "advert": "ad ads advert adverts advertisement advertisements adsense sponsor sponsored sponsors promo promotion promotions banner banners",
        "notice": "cookie cookies consent gdpr notice notices notification notifications popup modal overlay alert paywall",
        "form": "newsletter subscribe subscription signup login search searchbox form",
        "comments": "comment comments reply replies disqus discussion respond reviews",
        "share": "share sharing social",
    }.items()
    for word in names.split()
}
#: Words that parts of an article have in their classes too.
WEAK = frozenset("tabs toc skip legal bottom rail discussion reviews".split())
MAIN_WORDS = frozenset("article post entry content story main".split())

TAG_MOST = -0.1
#: A word in what is cut out anyway costs no more than this.
CUT_COST = -0.2
CLIP = 4.0


def _kind(tag: str, attrs: str, in_main: bool) -> tuple[str, bool, bool]:
    """Kind of boilerplate that an element opens, if any, whether only weak words of its class say so, and whether it is a main element."""
    names, role = set(), ""
    for name, value in ATTRIBUTE.findall(attrs) if attrs else ():
        value = value.strip("\"'")
        if name.lower() == "role":
            role = value.lower().strip()
        else:
            names.update(w.lower() for w in NAME_PART.findall(value))
    kind = BY_TAG.get(tag, "") or BY_ROLE.get(role, "")
    found = [w for w in names if w in BY_WORD]
    weak = False
    if not kind and found and tag not in ("body", "html", "article", "main"):
        kind = min(BY_WORD[w] for w in found)
        weak = all(w in WEAK for w in found)
        if kind == "header" and names & MAIN_WORDS:
            kind = ""
    if tag == "article" and any(BY_WORD[w] == "comments" for w in found):
        kind = "comments"
    if kind == "header" and in_main:
        # an article's own header holds its title
        kind = ""
    return kind, weak and bool(kind), not kind and (tag in ("article", "main") or role in ("main", "article") or tag in ("div", "section", "td") and bool(names & MAIN_WORDS))


def _role(attrs: str) -> str:
    return next((v.strip("\"'").lower().strip() for n, v in ATTRIBUTE.findall(attrs or "") if n.lower() == "role"), "")


def _role_kind(attrs: str) -> str:
    return BY_ROLE.get(_role(attrs), "")


def _is_main(tag: str, attrs: str) -> bool:
    """Whether an element says by itself that it is the main one, not by a word of its class."""
    return tag in ("article", "main") or _role(attrs) in ("main", "article")


class Open(NamedTuple):
    """An open element, with what it and its ancestors add up to."""

    tag: str
    kind: str
    main: bool
    links: int
    #: The innermost block.
    holder: str
    #: Place of the element if its kind is a guess, the words and main elements read before it.
    guess: int | None
    words: int
    mains: int


TOP = Open("", "", False, 0, "", None, 0, 0)


class Page:
    """The tokens of a page: runs of words and tags, with what they stand in.

    ``words`` has (block, text, features, kind, n) of each run, at its place among ``tokens``:
    (index of the run or None, tag). ``free`` tells which tokens are cut from within a main element.
    ``labels`` tells for labelled pages which are in the region. ``judge`` is the score of a word
    by its features; without it all weak words of a class are believed.
    """

    def __init__(self, source: str, judge: Callable[[Iterable[str]], float] | None = None):
        self._read(source, frozenset())
        total = sum(r[4] for r in self.runs if r[3] != "markup")
        if not self.has_main:
            plain = {i for i, n in self.held.items() if 2 * n > total or i in self.around}
        else:
            plain = {i for i, (begin, end) in self.weak.items() if judge and self._sum(judge, begin, end) > 0}
        if plain:
            self._read(source, plain)

    def _sum(self, judge: Callable[[Iterable[str]], float], begin: int, end: int) -> float:
        """What the weights say of runs as a part of the main element, whatever their kind is."""
        return sum(r[4] * judge([f for f in self.features(r) if not f.startswith("kind ")]) for r in self.runs[begin:end] if r[4])

    def _read(self, source: str, plain: set[int] | frozenset[int]) -> None:
        """Read the page; the elements at the places of ``plain`` have no kind. ``held`` has the words below each
        element whose kind is a guess, ``around`` those with a main element below, ``weak`` the runs of the outermost
        ones in a main element of which only weak words say what they are."""
        self.held: dict[int, int] = {}
        self.around: set[int] = set()
        self.weak: dict[int, tuple[int, int]] = {}
        self.runs: list[tuple[int, str, tuple, str, int]] = []
        self.tokens: list[tuple[int | None, str]] = []
        self.free: list[bool] = []
        self.labels: list[bool] = []
        self.has_main = False
        self.read = self.mains = 0
        stack: list[Open] = []
        names: Counter = Counter()
        begun: dict[int, int] = {}
        block, at, inside = 0, 0, False

        def close() -> None:
            top = stack.pop()
            names[top.tag] -= 1
            if top.guess is not None:
                self.held[top.guess] = self.read - top.words
                if self.mains > top.mains:
                    self.around.add(top.guess)
                if top.guess in begun:
                    self.weak[top.guess] = begun[top.guess], len(self.runs)

        for m in TOKEN.finditer(source):
            if m.start() > at:
                self._text(source[at : m.start()], block, stack[-1] if stack else TOP, inside)
            at = m.end()
            tag = (m["tag"] or "").lower()
            if m["comment"] is not None:
                inside = REGION.get(m["comment"], inside)
                continue
            if not tag:
                continue
            top = stack[-1] if stack else TOP
            if tag in BLOCKS:
                block += 1
            if tag == "br":
                self._text(" ", block, top, inside)
            self.tokens.append((None, tag))
            self.free.append(top.main and top.kind != "")
            self.labels.append(inside)
            if m["close"]:
                if names[tag]:
                    while stack[-1].tag != tag:
                        close()
                    close()
                continue
            if tag in BLOCKS:
                over = ENDS.get(tag, {"p"})
                while stack and (stack[-1].tag in over or (stack[-1].tag not in BLOCKS and any(s.tag in over for s in stack[-3:]))):
                    close()
            if tag in VOID:
                continue
            top = stack[-1] if stack else TOP
            kind, weak, main = _kind(tag, m["attrs"], top.main)
            guess = bool(kind) and (tag == "form" or tag not in BY_TAG and not _role_kind(m["attrs"]))
            if m.start() in plain:
                kind, guess = "", False
            self.mains += main and _is_main(tag, m["attrs"])
            self.has_main |= main and not top.kind
            if guess and weak and top.main and not top.kind:
                begun[m.start()] = len(self.runs)
            holder = tag if tag in BLOCKS else top.holder
            stack.append(Open(tag, top.kind or kind, top.main or main, top.links + (tag == "a"), holder, m.start() if guess else None, self.read, self.mains))
            names[tag] += 1
            self.free[-1] = stack[-1].main and stack[-1].kind != ""
        if at < len(source):
            self._text(source[at:], block, stack[-1] if stack else TOP, inside)
        while stack:
            close()

    def _text(self, raw: str, block: int, top: Open, inside: bool) -> None:
        text = html.unescape(raw)
        n = len(text.split())
        if n:
            self.tokens.append((len(self.runs), ""))
            self.free.append(top.main and top.kind != "")
            self.labels.append(inside)
        self.read += n
        self.runs.append((block, text, (top.main, top.links > 0, top.holder), top.kind, n))

    def features(self, run: tuple) -> list[str]:
        main, link, holder = run[2]
        return [f"main {main if self.has_main else 'none'}", f"kind {run[3]}", f"link {link}", f"block {holder}"]


@lru_cache(1)
def weights() -> dict[str, float]:
    """Log odds of features of words, and of tags, from the labelled pages, with a half added to each count."""
    counts = {True: Counter(), False: Counter()}
    totals = {True: Counter(), False: Counter()}
    for source in PAGES:
        page = Page(source)
        for (i, tag), inside in zip(page.tokens, page.labels, strict=True):
            run = page.runs[i] if i is not None else None
            for f in page.features(run) if run else [f"tag {tag}"]:
                n = run[4] if run else 1
                counts[inside][f] += n
                totals[inside][f.split(" ")[0]] += n
    odds = {}
    for f in counts[True] | counts[False]:
        group = f.split(" ")[0]
        share = [(counts[x][f] + 0.5) / (totals[x][group] + 1) for x in (True, False)]
        odds[f] = math.log(share[0] / share[1])
    return odds


def _odds(features: Iterable[str]) -> float:
    odds = weights()
    return max(-CLIP, min(CLIP, sum(odds.get(f, 0.0) for f in features)))


def _scores(page: Page) -> Iterator[float]:
    odds = weights()
    known: dict[tuple, float] = {}
    for (i, tag), free in zip(page.tokens, page.free, strict=True):
        if free:
            yield 0.0
            continue
        if i is None:
            yield max(-CLIP, min(TAG_MOST, odds.get(f"tag {tag}", TAG_MOST)))
            continue
        run = page.runs[i]
        key = (run[2], run[3])
        if key not in known:
            word = _odds(page.features(run))
            known[key] = max(CUT_COST, min(word, 0.0)) if run[3] else word
        yield run[4] * known[key]


def best_run(scores: list[float]) -> tuple[int, int, float]:
    """(begin, end, sum) of the contiguous run with the largest sum, the first and shortest of equals; none if no sum is positive."""
    best, since, total = (0, 0, 0.0), 0, 0.0
    for i, s in enumerate(scores):
        if total <= 0:
            since, total = i, 0.0
        total += s
        if total > best[2]:
            best = (since, i + 1, total)
    return best


def main_text(source: str | None) -> str:
    """The article of a page: blocks in page order, parted by an empty line.

    Character references are decoded, white space in a block becomes one space, and
    blocks are trimmed. Empty if no run of words speaks for content, as for null, an empty
page and one of tags only; a page without tags is one block. Whole pages are read, however long, in linear time.
    """
    page = Page(source or "", _odds)
    begin, end, _ = best_run(list(_scores(page)))
    blocks = {page.runs[i][0] for i, _ in page.tokens[begin:end] if i is not None}
    texts: dict[int, list[str]] = {}
    for block, text, _, kind, _ in page.runs:
        if block in blocks and not kind:
            texts.setdefault(block, []).append(text)
    found = (" ".join("".join(parts).split()) for parts in texts.values())
    return "\n\n".join(t for t in found if t)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html; others are ignored).

    A null page has no text; repeated rows and ids are rows of their own; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(t) for t in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
