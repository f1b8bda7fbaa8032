"""Main text of web pages: two-pass rules over blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rules of the first pass: characters of a short and of a long block, share of stop words, share of link text.
SHORT, LONG, STOP_LOW, STOP_HIGH, LINKS = 70, 200, 0.12, 0.25, 0.5
# A page with a smaller share of stop words in all its text is in another language: there length and links decide.
# Articles stand for the page if they hold this share of its good text.
FOREIGN, MOST = 0.08, 0.5

# Elements that end a block, that are never main text, that hold text of their own kind, and
# words in class, id or role that mark furniture, readers' comments, or a page's frame.
BLOCKS = frozenset("address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 "
                   "h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead "
                   "title tr ul".split())
FURNITURE = frozenset("aside audio button canvas datalist dialog fieldset footer form head iframe label legend map menu nav noscript object option "
                      "select svg template title video".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HINTS = re.compile(
    "ads?|advert(?:s|isement|isements|ising|orial)?|ad(?:box|slot|unit|banner)|alert|banner|breadcrumbs?|complementary|consent|contentinfo|cookies?|disclaimer|"
    "footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|paywall|popup|promo|promotion|related|rss|search|share|"
    "sharing|sidebar|sidenav|signup|skip|social|sponsor|sponsored|subscribe|subscription|toolbar|widgets?")
COMMENTS = re.compile("comments?|comment(?:list|form|section|area|thread)|disqus|reply|replies|respond")
# Words that say that an element is built around furniture and is none itself.
LAYOUT = frozenset("with has no without page layout container wrapper wrap body site".split())
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be by for from he i in is it not of on or that the this to was with you "
    "auf aus das dem den der des die ein eine einer es für ich im ist mit nicht sich sie und von zu "
    "au avec ce dans des du elle en est et il la le les par pas pour que qui sur un une "
    "al como con de del el ella las lo los más no para por se su y".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
MAIN = re.compile(r"""\b(?:role\s*=\s*["']?main\b|itemprop\s*=\s*["']?articleBody\b)""", re.I)
PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """Text between two block elements. scope: the article it stands in, 0 for none; furniture: 0 no, 1 by a hint, 2 for certain."""

    scope: int
    furniture: int
    heading: bool
    text: str
    link: int
    good: bool | None = None  # None: not decided yet
    near: bool = False  # nearly good


@dataclass
class Place:
    """Open elements that matter: (name, furniture, scope, link). furniture: 0 no, 1 by a hint, 2 for certain."""

    stack: list[tuple[str, int, int, bool]] = field(default_factory=list)

    def top(self) -> tuple[str, int, int, bool]:
        return self.stack[-1] if self.stack else ("", 0, 0, False)


def hinted(attributes: str) -> int:
    """What class, id or role say of an element: 0 nothing, 1 furniture, 2 readers' comments."""
    level = 0
    for found in HINT.findall(attributes) if attributes else ():
        for name in "".join(found).lower().split():
            words = [w for w in PARTS.split(name) if w]
            if any(COMMENTS.fullmatch(w) for w in words):
                return 2
            if not LAYOUT.intersection(words) and any(HINTS.fullmatch(w) for w in words):
                level = 1
    return level


def blocks(page: str) -> list[Block]:
    """The page's blocks in order. Unclosed and stray tags, comments and quotes do no harm; time is linear."""
    found: list[Block] = []
    parts: list[tuple[str, bool]] = []
    place, heading, articles, at, tag = Place(), False, 0, 0, TAG

    def end() -> None:
        nonlocal heading
        if parts:
            text = SPACE.sub(" ", "".join(p for p, _ in parts)).strip()
            if text:
                _, furniture, scope, _ = place.top()
                link = sum(len(p) for p, linked in parts if linked)
                found.append(Block(scope, furniture, heading, text, link))
            parts.clear()
        heading = False

    def say(text: str) -> None:
        if text:
            parts.append((html.unescape(text), place.top()[3]))

    while True:
        mark = page.find("<", at)
        if mark < 0:
            say(page[at:])
            break
        if page.startswith("<!--", mark):
            say(page[at:mark])
            close = page.find("-->", mark + 4)
            at = len(page) if close < 0 else close + 3
            continue
        if page[mark + 1:mark + 2] in ("!", "?"):
            say(page[at:mark])
            close = page.find(">", mark)
            at = len(page) if close < 0 else close + 1
            continue
        if page[mark + 1:mark + 2].isalpha() or page[mark + 1:mark + 2] == "/":
            m = tag.match(page, mark)
            if m is None and tag is TAG and page.find(">", mark) >= 0 and LOOSE.match(page, mark):
                tag = LOOSE  # a quote that never ends: from here on quotes mean nothing
                m = tag.match(page, mark)
        else:
            m = None
        if m is None:
            if page.find(">", mark) < 0:  # no tag can follow
                say(page[at:])
                break
            say(page[at:mark + 1])
            at = mark + 1
            continue
        say(page[at:mark])
        at = m.end()
        close, name, attributes = m[1], m[2].lower(), m[3]
        if name == "br":
            parts.append((" ", False))
            continue
        if close:
            if name in BLOCKS:
                end()
            for k in range(len(place.stack) - 1, -1, -1):
                if place.stack[k][0] == name:
                    del place.stack[k:]
                    break
            continue
        if name in RAW:
            over = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = over.end() if over else len(page)
            continue
        if name in BLOCKS:
            end()
            heading = name in HEADINGS
        if name in VOID or attributes.endswith("/"):
            continue
        _, furniture, scope, link = place.top()
        if name in ("article", "main") or MAIN.search(attributes):
            articles += 1
            scope = articles
            furniture = furniture if furniture == 2 else 0  # an article in a frame that only names furniture
        if name in FURNITURE or name == "header" and not scope:
            furniture = 2
        elif name not in ("html", "body", "main"):
            level = hinted(attributes)
            furniture = max(furniture, level if level == 2 or not scope or "header" not in attributes else 0)
        if name in BLOCKS and name != "p" and name not in HEADINGS or name in FURNITURE or name == "a" or furniture != place.top()[1]:
            # A paragraph is not kept open: it ends where the next block begins, closed or not.
            place.stack.append((name, furniture, scope, link or name == "a"))
    end()
    return found


def stops_of(text: str, stop_words: frozenset[str]) -> tuple[int, int]:
    """Stop words and words."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in stop_words for w in words), len(words)


def decide(found: list[Block], stop_words: frozenset[str] = STOP_WORDS) -> None:
    """First pass: blocks that their own figures decide. A hint that an element is furniture does not decide over a
    long block of prose in an article."""
    open_ = [b for b in found if b.furniture < 2 and b.link <= LINKS * len(b.text) and len(b.text) >= SHORT]
    counts = [stops_of(b.text, stop_words) for b in open_]
    foreign = sum(s for s, _ in counts) < FOREIGN * sum(n for _, n in counts)
    share = {id(b): s / n for b, (s, n) in zip(open_, counts)}
    for b in found:
        if b.furniture == 1 and b.scope and len(b.text) >= LONG and (foreign or share.get(id(b), 0) >= STOP_HIGH) and id(b) in share:
            b.furniture = 0
        if b.furniture or b.link > LINKS * len(b.text):
            b.good = False
        elif len(b.text) >= SHORT:
            if len(b.text) >= LONG and (foreign or share[id(b)] >= STOP_HIGH):
                b.good = True
            elif foreign or share[id(b)] >= STOP_LOW:
                b.near = True
            elif not b.scope:
                b.good = False


def inherit(found: list[Block]) -> None:
    """Second pass: an undecided block takes the label of the nearest decided one. Within an article only
    that article's own blocks count, and one in which nothing is decided is kept. Elsewhere the page's ends
    count as furniture; of two equally near a heading, or a block that is nearly good, takes the good one."""
    own = [b.good for b in found]
    # One sweep each way keeps the nearest decided block, by scope.
    sides: list[list[tuple[int, bool] | None]] = []
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        last: dict[int, tuple[int, bool]] = {}
        edge = -1 if not sides else len(found)
        side: list[tuple[int, bool] | None] = [None] * len(found)
        for i in order:
            b = found[i]
            if b.scope:
                side[i] = (abs(last[b.scope][0] - i), last[b.scope][1]) if b.scope in last else None
            else:
                at, good = last.get(0, (edge, False))
                side[i] = (abs(at - i), good)
            if own[i] is not None:
                last[0] = (i, own[i])
                if b.scope and not b.furniture:
                    last[b.scope] = (i, own[i])
        sides.append(side)
    for i, b in enumerate(found):
        if b.good is None:
            near = [s for s in (sides[0][i], sides[1][i]) if s]
            if not near:
                b.good = True
            elif len({good for _, good in near}) == 1:
                b.good = near[0][1]
            elif near[0][0] == near[1][0]:
                b.good = bool(b.scope or b.heading or b.near)
            else:
                b.good = min(near)[1]


def main_text(page: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    """The good blocks, two line ends between them. Where articles hold most of the good text, what stands outside of
    all of them is furniture; without any good block, nearly good ones outside of furniture are taken."""
    found = blocks(page or "")
    decide(found, stop_words)
    inherit(found)
    good = [b for b in found if b.good]
    if sum(len(b.text) for b in good if b.scope) > MOST * sum(len(b.text) for b in good):
        good = [b for b in good if b.scope]
    return "\n\n".join(b.text for b in good or [b for b in found if b.near])


def extracted(html_text: str | Column, stop_words: frozenset[str] = STOP_WORDS) -> Column:
    @F.arrow_udf("string")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([main_text(v.as_py(), stop_words) for v in column], pa.string())
    return run(html_text)


def extract(pages: DataFrame, page: str = "page_id", url: str = "url", html_text: str = "html") -> DataFrame:
    """page, url, text and n_chars of every row: the whole main text, empty if there is none. A null page is
    empty; other columns are not touched, and rows that repeat are read each for itself."""
    return (pages.select(F.col(page).alias("page"), F.col(url).alias("url"), extracted(F.col(html_text).cast("string")).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
