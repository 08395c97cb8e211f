"""Main text of web pages by tag-path ratios.

Every block of text has a path of tags from the root, with their classes. Per path, characters and
punctuation marks are counted and divided by the number of its blocks. Both ratios are smoothed along the
page, so that a short line amid long ones gains and a lone one doesn't, fused into one score per path, and
compared with the page's best. Paths through navigation, forms, notices and the like, or made of links,
score nothing, in an article as elsewhere. The nodes of the paths that pass are the content nodes.

Headings, short lines and lists between them score less but belong to the text, so the elements that hold content
nodes are taken as a whole, without what scores nothing: a node's parent, an article or main element around it, and
any other element around it that has more content than that and little else. An article element is a hint, not
a condition: the same page with plain elements in its place has the same text. Class words that are often used in
articles too, such as `legal`, weigh on a path's score there and don't settle it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from duelframe.llm.common import texts_of

#: Share of the best path's score that a path needs.
SHARE = 0.2
#: Share of characters in links from which a path counts as made of links.
LINKS = 0.5
#: Weights of a block and its neighbours in the smoothing.
KERNEL = np.array([0.06, 0.24, 0.4, 0.24, 0.06])

#: Fixed values of HTML: elements without end tag, without text of the page, and within a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math textarea title head audio video canvas".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that a new one of the same group ends: p by any block, the others by one of their group.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
CONTAINERS = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select"}
#: Elements, roles and words of classes and ids that hold no main text.
OUTSIDE = set("nav header footer aside form button select menu dialog fieldset address".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
WORDS = set(
    "nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar header footer sidebar aside widget widgets ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
    "signin login share sharing social related recommended recommendations comment comments commentlist discussion reply replies respond disqus pagination pager "
    "toolbar search skip alert paywall disclaimer copyright legal form tags".split()
)
#: Those of them that may also name a part of an article, and what a path through one counts there.
DOUBTFUL = set("legal discussion notice notices alert form tags copyright disclaimer header footer search promotion banner overlay".split())
DOUBT = 0.3
#: Words that name whoever wrote a text.
AUTHORS = set("author authors byline bio".split())
#: What an element must have, next to the content nodes in it, to be taken: more content than the one inside, and so much of its text.
MORE, MOSTLY = 1.1, 0.6
ROOTS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = ".,;:!?…。，！？、"


@dataclass(eq=False)
class Element:
    tag: str
    path: str
    parent: Element | None = None
    #: Text in it is none of the page's, or may be none.
    outside: bool = False
    doubtful: bool = False
    root: bool = False  # an article or main element
    within: bool = False  # it or one around it is
    heading_only: bool = False


@dataclass
class Block:
    place: Element
    outside: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""

    @property
    def path(self) -> str:
        return self.place.path


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)} if source and not source.isspace() else {}


def _named(attributes: dict[str, str]) -> list[str]:
    """Words of class and id; those that follow no, has or with tell of the page, not of the element."""
    found = []
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for name in value.split():
            words = [w.lower() for w in _WORD.findall(name)]
            found += [w for i, w in enumerate(words) if i == 0 or words[i - 1] not in ("no", "has", "with")]
    return found


def _enter(parent: Element, tag: str, source: str) -> Element:
    attributes = _attributes(source)
    words = _named(attributes)
    made = Element(tag, f"{parent.path}/{tag}" + "".join(f".{w}" for w in words), parent, parent.outside, parent.doubtful, False, parent.within, parent.heading_only)
    named = WORDS.intersection(words)
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "")
    if tag in ROOTS or attributes.get("role") in ("main", "article"):
        made.root = made.within = not named
        made.outside |= bool(named)
    elif tag == "header" and made.within:
        made.heading_only = True  # an article's own header holds its headline
    elif tag in OUTSIDE or attributes.get("role") in ROLES or hidden:
        made.outside = True
    elif tag not in ("html", "body") and tag not in HEADINGS and (named or AUTHORS.intersection(words)):
        if made.within and named <= DOUBTFUL and not AUTHORS.intersection(words):
            made.doubtful = True
        else:
            made.outside = True
    return made


def blocks(page: str) -> list[Block]:
    """The page's blocks of text in order, white space put right, empty ones left out."""
    stack = [Element("", "")]
    done: list[Block] = []
    now: Block | None = None
    links = 0

    def add(raw: str) -> None:
        nonlocal now
        if not raw:
            return
        if now is None:
            top = next(e for e in reversed(stack) if e.tag not in INLINE)
            outside = stack[-1].outside or (top.heading_only and top.tag not in HEADINGS)
            now = Block(top, outside)
        text = html.unescape(raw) if "&" in raw else raw
        now.parts.append(text)
        now.linked += len(text) if links else 0

    def close() -> None:
        nonlocal now
        if now is not None:
            now.text = " ".join("".join(now.parts).split())
            if now.text:
                done.append(now)
            now = None

    def pop(to: int) -> None:
        nonlocal links
        links -= sum(e.tag == "a" for e in stack[to:])
        del stack[to:]

    at = 0
    while match := _MARK.search(page, at):
        add(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        ending, source = bool(match[1] or match[4]), match[3] or match[6] or ""
        if tag in RAW and not ending:
            if source.endswith("/") and tag not in ("script", "style", "textarea", "title"):
                continue
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            if end is None and tag == "head":
                continue
            at = end.end() if end else len(page)
            continue
        if tag not in INLINE:
            close()
        if ending:
            place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if place and not (tag in INLINE and any(e.tag not in INLINE for e in stack[place:])):
                pop(place)
            continue
        if tag in VOID or tag in RAW:
            continue
        if tag not in INLINE:
            for i in range(len(stack) - 1, 0, -1):  # what the new block ends
                if stack[i].tag == "p" or tag in ENDED_BY.get(stack[i].tag, ()):
                    pop(i)
                    break
                if stack[i].tag not in INLINE and (stack[i].tag in CONTAINERS or tag not in ENDED_BY):
                    break
        if not source.endswith("/") or tag not in INLINE:
            stack.append(_enter(stack[-1], tag, source))
            links += tag == "a"
    add(page[at:])
    close()
    return done


def path_scores(found: list[Block]) -> dict[str, float]:
    """Score of each path: characters and punctuation per block, smoothed along the page and fused."""
    counts: dict[str, list[float]] = {}
    for b in found:
        c = counts.setdefault(b.path, [0, 0, 0, 0])
        for i, x in enumerate((1, len(b.text), sum(map(b.text.count, _PUNCTUATION)), b.linked)):
            c[i] += x
    barred = {b.path for b in found if b.outside} | {p for p, c in counts.items() if c[3] > LINKS * c[1]}
    weight = {b.path: 0.0 if b.path in barred else DOUBT if b.place.doubtful else 1.0 for b in found}
    at = [b.path for b in found]
    ratio = lambda i: np.array([0.0 if p in barred else counts[p][i] / counts[p][0] for p in at])
    smooth = lambda x: np.convolve(np.pad(x, 2, mode="edge"), KERNEL, mode="valid")
    fused = np.sqrt(smooth(ratio(1)) * (1 + smooth(ratio(2)))) if at else np.zeros(0)
    sums: dict[str, float] = {}
    for p, s in zip(at, fused, strict=True):
        sums[p] = sums.get(p, 0.0) + s
    return {p: weight[p] * sums[p] / counts[p][0] for p in counts}


def _around(place: Element) -> Iterator[Element]:
    """The elements around one, from its parent out, without the page's own."""
    at = place.parent
    while at is not None and at.tag not in ("", "html", "body"):
        yield at
        at = at.parent


def _held(nodes: list[Block], others: list[Block]) -> set[Element]:
    """The elements that are taken as a whole: `nodes` are the content nodes, `others` what else might be text."""
    content: dict[Element, int] = {}
    every: dict[Element, int] = {}
    for group, sums in ((nodes, (content, every)), (others, (every,))):
        for b in group:
            for e in (b.place, *_around(b.place)):
                for s in sums:
                    s[e] = s.get(e, 0) + len(b.text)
    held, seen = set(), set()
    for place in {b.place: None for b in nodes}:
        around = list(_around(place))
        if not around or around[0] in seen:
            continue
        seen.add(around[0])
        now = around[0]
        for e in around[1:]:
            in_article = now.root or any(x.root for x in around[: around.index(now)])
            if (e.root and not in_article) or (content[e] >= MORE * content[now] and content[e] >= MOSTLY * every[e]):
                now = e
        held.add(now)
    return held


def main_text(page: str) -> tuple[str, int, int]:
    """The page's main text, its number of blocks, and that of all blocks."""
    found = blocks(page)
    scores = path_scores(found)
    top = max(scores.values(), default=0.0)
    if not top:
        return "", 0, len(found)
    passes = [scores[b.path] >= SHARE * top for b in found]
    others = [b for b, p in zip(found, passes, strict=True) if not p and scores[b.path] and not b.place.doubtful]
    held = _held([b for b, p in zip(found, passes, strict=True) if p], others)
    fill = {id(b) for b in others if held.intersection(_around(b.place)) or b.place in held}
    kept = [b for b, p in zip(found, passes, strict=True) if p or id(b) in fill]
    return "\n".join(b.text for b in kept), len(kept), len(found)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_blocks (kept) and n_all for each row of `pages`.

    Null and empty pages have an empty text, as have pages whose blocks are all boilerplate. A page without
    markup is one block. Pages cut off within a tag, a reference or a comment give the text up to there.
    Repeated rows are treated one by one; other columns are not read.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [main_text(x) for x in texts_of(frame["html"])]
            yield pd.DataFrame({"page_id": frame["page_id"].to_numpy(), "url": frame["url"].to_numpy(), "text": [r[0] for r in rows], "n_blocks": [r[1] for r in rows], "n_all": [r[2] for r in rows]})

    return pages.select("page_id", "url", "html").mapInPandas(run, f"page_id {kind}, url string, text string, n_blocks long, n_all long")
