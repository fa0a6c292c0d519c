"""Main text of web pages by maximum-scoring subsequence.

A page is cut into tags and runs of text. Words score by the log-odds, over the elements and class
names around them, of main against other text; tags score negative. One linear scan (best sum of
consecutive scores) finds the content region. All of it is returned; at its ends it is widened to whole
blocks and to the outermost ``article`` or ``main`` element around them, with those nested in it. The weights come from labelled pages: a page with exactly one ``article`` (else one ``main``)
element labels its own words, those inside it as main text. Elements made for menus, forms and the like
score slightly negative wherever they stand, and are left out of the region.

A class or id that names a menu, notice, advert or the like is a prior against its elements, judged for
each page: they are left out unless their text, at the odds of such a name, outscores what the page has
outside of them; one that is not named so outright and holds an ``article`` or ``main`` with most words of the page
always stays. A wrapper of the page (``has-sidebar``) is opened so, and then the elements within it
are judged in the same way; elements of the same names are opened together.

A null, empty or text-free page has an empty text. Unclosed elements end with their parent, an unclosed
tag or comment takes the rest of the page. Blocks are joined by one newline, white space within a block
(of any kind) becomes one space, character references are decoded, nothing else is cut.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by role.
RAW = frozenset("script style noscript template iframe textarea svg math object title noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header"
    " hgroup hr main menu nav ol p pre section table ul li dd dt".split()
) | HEADINGS
NAMES_OF_LEFT_OUT = frozenset("head nav footer aside form menu button select dialog option datalist input".split())
NAMES_LEFT_OUT = re.compile(
    r"(?:^|[-_])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|breadcrumbs?|sidebar"
    r"|side|footer|masthead|topbar|toolbar|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe"
    r"|signup|login|comments?|disqus|respond|replies|share|sharing|social|related|recommended|pagination|pager|widget"
    r"|skip|copyright|legal)(?:$|[-_])",
    re.I,
)
ROLES_LEFT_OUT = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

SLOTS = 4096
LEFT_OUT_TAG = SLOTS  # in place of the slot of a tag within an element that is left out
UNSEEN_TAG = 0.5
LEFT_OUT = 0.05  # against a word or tag in an element that is left out, in the region or not
LIMIT = 3.0  # of one name's weight
NAMED, NAMED_SO = 0.1, 0.05  # odds that an element is main text if a part of its name, or all of it, tells otherwise
WORD_BASE = 0.5

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s>"']++))?""", re.I)


@dataclass
class Element:
    name: str
    slots: tuple[int, ...]
    left_out: bool
    main: bool
    names: tuple[str, ...] = ()  # classes and ids that speak against it
    so: bool = False  # one of them is nothing but such a name
    node: int = 0  # its number among the elements of the page
    fresh: tuple[int, ...] = ()  # its slots that no element around it has


@dataclass
class Run:
    """Text between two tags, and the elements around it."""

    text: str
    words: int
    node: int  # the innermost element around it, 0 for the page
    left_out: bool
    main: int  # number of the article or main element around it, 0 if none
    outer: int  # the outermost of those around it
    block: int


@dataclass
class Named:
    """An element with names that speak against it."""

    parent: int  # number of the one around it, 0 if none
    names: tuple[str, ...]
    odds: float


@dataclass
class Page:
    items: list = field(default_factory=list)  # Run, or the slot of a tag
    mains: dict[int, str] = field(default_factory=dict)
    within: list[int] = field(default_factory=list)  # number of the innermost named element around each item
    named: list[Named] = field(default_factory=lambda: [Named(-1, (), 1.0)])  # 0 is the page
    mains_within: dict[int, int] = field(default_factory=dict)
    # of each element, outer ones first: the one around it, its slots, and those that no element around it has
    nodes: list[tuple[int, tuple[int, ...], tuple[int, ...]]] = field(default_factory=lambda: [(-1, (), ())])


def slot(name: str) -> int:
    return xxhash.xxh32_intdigest(name) % SLOTS


def element(name: str, attributes: str, inside_main: bool) -> Element:
    names, against, left_out = [f"<{name}"], [], name in NAMES_OF_LEFT_OUT or (name == "header" and not inside_main)
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                names += [f".{x.lower()}" for x in value.split()]
                if name not in ("html", "body"):
                    against += [x.lower() for x in value.split() if NAMES_LEFT_OUT.search(x)]
            elif key == "role":
                left_out |= value.lower() in ROLES_LEFT_OUT
            elif key == "hidden":
                left_out = True
            elif key == "aria-hidden":
                left_out |= value.lower() == "true"
    so = name not in ("article", "main") and any(NAMES_LEFT_OUT.fullmatch(x) for x in against)
    return Element(name, tuple(slot(x) for x in names), left_out, name in ("article", "main"), tuple(sorted(against)), so)


def parse(source: str) -> Page:
    page = Page()
    stack: list[Element] = []
    open_names: Counter = Counter()
    out = block = mains = 0
    held: set[int] = set()  # slots of the open elements
    around: list[int] = []  # numbers of the article and main elements around
    inside = [0]  # numbers of the named elements around
    at, end = 0, len(source)
    lower = None

    def pop_to(depth: int) -> None:
        nonlocal out
        while len(stack) > depth:
            gone = stack.pop()
            open_names[gone.name] -= 1
            held.difference_update(gone.fresh)
            out -= gone.left_out
            if gone.main:
                around.pop()
            if gone.names:
                inside.pop()

    while at < end:
        less = source.find("<", at)
        if less < 0:
            less = end
        if less > at:
            text = html.unescape(source[at:less])
            node = stack[-1].node if stack else 0
            page.items.append(Run(text, len(text.split()), node, out > 0, around[-1] if around else 0, around[0] if around else 0, block))
            page.within.append(inside[-1])
        if less == end:
            break
        if source.startswith("<!--", less):
            close = source.find("-->", less + 4)
            at = end if close < 0 else close + 3
            continue
        closing = source.startswith("</", less)
        name = _NAME.match(source, less + 1 + closing)
        if not name:
            if source[less + 1 : less + 2] in ("!", "?", "/"):
                close = source.find(">", less)
                at = end if close < 0 else close + 1
            else:  # a less-than sign in the text
                page.items.append(Run("<", 0, 0, out > 0, around[-1] if around else 0, around[0] if around else 0, block))
                page.within.append(inside[-1])
                at = less + 1
            continue
        rest = _REST.match(source, name.end())
        close = rest.end() if rest else source.find(">", name.end()) + 1
        if not close:
            break
        tag, attributes = name.group().lower(), source[name.end() : close - 1]
        at = close
        if tag not in INLINE and tag not in RAW:
            block += 1
        opened = len(page.items)
        page.items.append(LEFT_OUT_TAG if out else slot(f"<{tag}"))
        page.within.append(inside[-1])
        if closing:
            if open_names[tag] > 0:
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == tag)
                pop_to(depth)
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                lower = source.lower() if lower is None else lower
                close = lower.find(f"</{tag}", at) if len(lower) == end else source.find(f"</{tag}", at)
                at = end if close < 0 else close
            continue
        if tag in VOID:
            continue
        for ended, closes in (("p", tag in ENDS_PARAGRAPH), ("li", tag == "li" and not open_names["ul"] + open_names["ol"] > open_names["li"])):
            if closes and open_names[ended] > 0:
                pop_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == ended))
        if attributes.endswith("/") and tag in INLINE:
            continue
        new = element(tag, attributes, bool(around))
        if new.names:
            page.named.append(Named(inside[-1], new.names, NAMED_SO if new.so else NAMED))
            inside.append(len(page.named) - 1)
            page.within[opened] = inside[-1]
        if new.main:
            mains += 1
            around.append(mains)
            page.mains[mains] = tag
            page.mains_within[mains] = inside[-1]
        new.node, new.fresh = len(page.nodes), tuple(set(new.slots) - held)
        held.update(new.fresh)
        page.nodes.append((stack[-1].node if stack else 0, new.slots, new.fresh))
        stack.append(new)
        open_names[tag] += 1
        out += new.left_out
        if new.left_out:
            page.items[opened] = LEFT_OUT_TAG
    return page


def labelled_main(page: Page) -> int:
    """The element whose words are the main text, 0 if the page does not tell."""
    for kind in ("article", "main"):
        own = [n for n, name in page.mains.items() if name == kind]
        if own:
            return own[0] if len(own) == 1 else 0
    return 0


def counts(page: Page, found: np.ndarray) -> None:
    """Add the page's words (rows 0, 1) and tags (rows 2, 3), outside and inside its main text.

    What lies in elements that are left out anyway tells nothing about the names within them. Named
    elements are left out here if they do not hold the main text.
    """
    main = labelled_main(page)
    if not main:
        return
    known, at = {0}, page.mains_within[main]
    while at:
        known.add(at)
        at = page.named[at].parent
    inside = 0
    words = [[0] * len(page.nodes) for _ in range(2)]  # in each element
    for item, within in zip(page.items, page.within, strict=True):
        if within not in known:
            continue
        if isinstance(item, Run):
            if item.left_out:
                continue
            inside = int(item.main == main)
            words[inside][item.node] += item.words
            found[inside, SLOTS] += item.words
        elif item != LEFT_OUT_TAG:
            found[2 + inside, item] += 1
    for inside in (0, 1):
        own = words[inside]
        for node in range(len(page.nodes) - 1, 0, -1):  # inner elements first: their words are in the outer ones too
            if own[node]:
                parent, _, fresh = page.nodes[node]
                own[parent] += own[node]
                for s in fresh:
                    found[inside, s] += own[node]


@dataclass
class Weights:
    word: np.ndarray
    tag: np.ndarray

    @classmethod
    def of(cls, found: np.ndarray) -> Weights:
        outside, inside = found[0, :SLOTS] + 1, found[1, :SLOTS] + 1
        odds = np.log(inside / (found[1, SLOTS] + SLOTS)) - np.log(outside / (found[0, SLOTS] + SLOTS))
        seen = found[0, :SLOTS] + found[1, :SLOTS] > 0
        word = np.clip(np.where(seen, odds, 0), -LIMIT, LIMIT)
        # tags per word outside against inside; always against the region
        out_rate = (found[2, :SLOTS] + 0.5) / (found[0, SLOTS] + SLOTS)
        in_rate = (found[3, :SLOTS] + 0.5) / (found[1, SLOTS] + SLOTS)
        known = found[2, :SLOTS] + found[3, :SLOTS] > 0
        tag = -np.where(known, np.clip(np.log(out_rate / in_rate), 0.1, LIMIT), UNSEEN_TAG)
        tag = np.append(tag, -LEFT_OUT)  # LEFT_OUT_TAG
        return cls(word, tag)

    def odds(self, page: Page) -> list[float]:
        """Of each element the sum over its slots and those of the elements around it."""
        out = [0.0]
        for parent, slots, _ in page.nodes[1:]:
            out.append(out[parent] + sum(self.word[s] for s in slots))
        return out

    def score(self, item, odds: list[float]) -> float:
        """Of a tag, or of a run of text given the odds of the page's elements."""
        if not isinstance(item, Run):
            return float(self.tag[item])
        if item.left_out:
            return -LEFT_OUT * item.words
        return item.words * min(max(WORD_BASE + odds[item.node], -LIMIT), LIMIT)


def opened(page: Page, weights: Weights) -> set[int]:
    """The named elements that are not left out, and 0 for the page itself."""
    found = {0}
    n = len(page.named)
    if n == 1:
        return found
    odds = weights.odds(page)
    own, total = [0.0] * n, [0.0] * n  # the best region of what lies in an element and in no named one within
    for item, g in zip(page.items, page.within, strict=True):
        total[g] = max(total[g], 0.0) + weights.score(item, odds)
        own[g] = max(own[g], total[g])
    whole = own.copy()
    children: dict[int, list[int]] = {}
    for g in range(n - 1, 0, -1):  # outer elements have smaller numbers
        whole[page.named[g].parent] += whole[g]
        children.setdefault(page.named[g].parent, []).append(g)
    # those around an article with most of the words, unless one is named by nothing but what is left out
    for g in around_longest(page):
        found.add(g)
        own[0] += own[g]
        children.setdefault(0, []).extend(c for c in children.get(g, ()) if c not in found)
    children = {p: [c for c in cs if c not in found] for p, cs in children.items()}
    here, text = [0], own[0]
    while True:
        alike: dict[tuple, list[int]] = {}
        for g in (c for p in here for c in children.get(p, ())):
            alike.setdefault((page.named[g].names, page.named[g].odds), []).append(g)
        score, here = max(((odds * sum(whole[g] for g in gs), gs) for (_, odds), gs in alike.items()), default=(0.0, []))
        if score <= text:
            return found
        found.update(here)
        text += sum(own[g] for g in here)


def around_longest(page: Page) -> list[int]:
    """The named elements around an article or main that holds most of the page's words."""
    words: Counter = Counter()
    for item in page.items:
        if isinstance(item, Run) and not item.left_out:
            words[item.outer] += item.words
    longest = max(words, key=words.__getitem__, default=0)
    if not longest or 2 * words[longest] <= sum(words.values()):
        return []
    chain, g = [], page.mains_within[longest]
    while g:
        if page.named[g].odds < NAMED:
            return []
        chain.append(g)
        g = page.named[g].parent
    return chain[::-1]


def settle(page: Page, weights: Weights) -> None:
    """Leave out what lies in named elements that are not opened."""
    found = opened(page, weights)
    if len(found) == len(page.named):
        return
    for i, g in enumerate(page.within):
        if g not in found:
            if isinstance(page.items[i], Run):
                page.items[i].left_out = True
            else:
                page.items[i] = LEFT_OUT_TAG


def region(page: Page, weights: Weights) -> tuple[int, int]:
    """The items of the best contiguous region, by one scan."""
    best, best_span, total, start = 0.0, (0, 0), 0.0, 0
    odds = weights.odds(page)
    for i, item in enumerate(page.items):
        if total <= 0:
            total, start = 0.0, i
        total += weights.score(item, odds)
        if total > best:
            best, best_span = total, (start, i + 1)
    return best_span


def extract(source: str | None, weights: Weights) -> str:
    if not source:
        return ""
    page = parse(source)
    settle(page, weights)
    start, end = region(page, weights)
    runs = [r for r in page.items[start:end] if isinstance(r, Run) and not r.left_out and r.words]
    if not runs:
        return ""
    outer = {r.outer for r in runs} - {0}
    blocks = {runs[0].block, runs[-1].block}
    chosen = [
        r
        for i, r in enumerate(page.items)
        if isinstance(r, Run) and not r.left_out and (start <= i < end or r.outer in outer or r.block in blocks)
    ]
    texts: dict[int, list[str]] = {}
    for r in chosen:
        texts.setdefault(r.block, []).append(r.text)
    lines = (" ".join("".join(parts).split()) for parts in texts.values())
    return "\n".join(line for line in lines if line)


def fit(pages: DataFrame, source: str = "html") -> Weights:
    """Weights from all pages that label themselves; the counts have a fixed size."""

    def run(batches: Iterator):
        import pyarrow as pa

        found = np.zeros((4, SLOTS + 1), dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts(parse(text), found)
        kind, at = np.nonzero(found)
        yield pa.RecordBatch.from_pydict({"kind": kind.astype(np.int32), "at": at.astype(np.int32), "n": found[kind, at]})

    rows = pages.select(source).mapInArrow(run, "kind int, at int, n bigint")
    total = np.zeros((4, SLOTS + 1))
    for r in rows.groupBy("kind", "at").agg(F.sum("n").alias("n")).collect():
        total[r.kind, r.at] = r.n
    return Weights.of(total)


def main_text(pages: DataFrame, weights: Weights, source: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the column ``into``."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([extract(t, weights) for t in texts], dtype=object)

    return pages.withColumn(into, run(F.col(source)))
