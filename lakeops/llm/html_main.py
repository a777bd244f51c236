"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass classifies each block by
itself: by its place (navigation, footers, forms, adverts and the like, known by tag, role,
class or id, are never text), by link density, length and the density of stop words. Short
or undecided blocks are left open. The second pass gives an open block the label of its
nearest decided neighbours: if both sides agree, theirs; if not, that of the nearer one, and
the good one at equal distance. Only blocks of the same region (an article, or the page
around it) are neighbours; an article without any decided block is text.

Defined cases: a null or empty page has an empty text; tags that are never closed or close
nothing are tolerated, and an open element ends with its parent; a page that breaks off
inside a tag or script loses that tag or script; character references are decoded once;
repeated rows are answered each; an empty table gives an empty result; other columns are
left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.words import hidden, text_of

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not text, whatever it looks like.
RAW = ("script", "style", "textarea", "title", "noframes", "iframe", "xmp")
BOILER_TAGS = set("nav footer aside form menu button select option template noscript svg object dialog head fieldset label canvas audio video".split())
BLOCK_TAGS = BOILER_TAGS | set(
    "html body address article blockquote center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hr li"
    " main ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
REGIONS = {"article", "main"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "toolbar"}
BOILER_NAMES = set(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion promoted teaser nav navbar navigation"
    " menu topmenu submenu breadcrumb breadcrumbs pagination pager toc sidebar sidebars side aside widget widgets rail header masthead topbar"
    " footer foot bottom copyright legal imprint comment comments commentlist respond disqus reply replies discussion cookie cookies"
    " consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login register"
    " share sharing social follow related recommended recommendations more popular trending tags hidden search skip".split()
)
#: Classes that name the article itself win over a hint beside them.
TEXT_NAMES = set("article content post entry story main body text prose".split())
#: Frequent function words of the languages at hand.
STOP_WORDS = set(
    "the of and to in a is was for on that with by from at an it as be are this or not have has he she they we you his her"
    " der die das und in den von zu mit ist des für auf dem ein eine nicht auch als sich es an werden aus er hat dass sie nach im"
    " le la les de des et en un une du que est pour dans par sur au qui pas plus avec ce se il elle sont aux ne son sa"
    " el los las que y del por con una para su al lo como más se es no o sus fue ha".split()
)
LONG, MEDIUM = 200, 70
STOP_HIGH, STOP_LOW = 0.3, 0.15
MAX_LINKS, ALL_LINKS = 0.33, 0.95
#: Least share of stop words in the running text of a page whose language they are of.
KNOWN_LANGUAGE = 0.25

_NAME_END, _QUOTE_OR_END = re.compile(r"[\s/>]"), re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW_END = {t: re.compile(rf"</{t}\b", re.I) for t in RAW}
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    region: int = 0
    in_article: bool = False
    boiler: bool = False
    heading: bool = False
    text: str = ""
    label: str = ""


class Tags:
    """Finds where tags end, in time that grows with the page, also where tags never end.

    A tag that is not closed is text; a scan from it runs to where it fails. Every scan that
    comes to a quote or bracket from which one has failed fails at once.
    """

    def __init__(self, page: str):
        self.page, self.failed = page, set()
        self.known = {}  # pattern: the stretch without a match that was looked through last, and its end

    def next(self, pattern: re.Pattern, at: int, hop: bool) -> int:
        low, high = self.known.get((pattern, hop), (1, 0))
        if not low <= at <= high:
            m = pattern.search(self.page, at)
            low, high = at, m.start() if m else len(self.page)
            self.known[pattern, hop] = low, high
        return high

    def end(self, at: int) -> int:
        """Place of the > that closes a tag whose attributes start at ``at``, or -1; quoted ones do not."""
        passed, hop = [], False
        while True:
            at = self.next(_QUOTE_OR_END, at, hop)
            if at < len(self.page) and self.page[at] == ">":
                return at
            passed.append(at)
            close = -1 if at == len(self.page) or at in self.failed else self.page.find(self.page[at], at + 1)
            if close < 0:
                self.failed.update(passed)
                return -1
            at, hop = close + 1, True

    def tag(self, at: int) -> tuple[bool, str, str, int] | None:
        """closing, name, attributes and the end of the tag that starts at ``at``, if one does."""
        name = at + 1 + self.page.startswith("/", at + 1)
        first = self.page[name : name + 1]
        if not (first.isascii() and first.isalpha()):
            return None
        until = self.next(_NAME_END, name, False)
        end = self.end(until)
        return None if end < 0 else (name > at + 1, self.page[name:until].lower(), self.page[until:end], end + 1)


class Stack:
    """The open elements, and where the last one of each tag is."""

    def __init__(self, root: Element):
        self.elements, self.places, self.blocks, self.forced = [root], {}, [], 0

    @property
    def top(self) -> Element:
        return self.elements[-1]

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.elements))
        if e.tag == "p" or e.tag in BLOCK_TAGS:
            self.blocks.append(len(self.elements))
        self.forced += e.boiler and e.tag in FORCING
        self.elements.append(e)

    def pop_from(self, depth: int) -> None:
        while len(self.elements) > depth:
            e = self.elements.pop()
            self.places[e.tag].pop()
            if self.blocks and self.blocks[-1] == len(self.elements):
                self.blocks.pop()
            self.forced -= e.boiler and e.tag in FORCING

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag, 0 for none."""
        own = self.places.get(tag)
        return own[-1] if own else 0


#: What never holds an article, even if one starts inside.
FORCING = ("nav", "footer", "aside", "form", "template", "dialog")


@dataclass
class Element:
    tag: str
    boiler: bool
    region: int
    in_article: bool
    link: bool


def _hinted(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether a tag opens something that is never main text."""
    if tag in BOILER_TAGS:
        return True
    if tag == "header" and not in_article:
        return True
    if not attributes.strip():
        return False
    got = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in got or got.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", got.get("style", ""), re.I):
        return True
    if tag in ("html", "body", "main"):
        return False
    if got.get("role", "").lower() in BOILER_ROLES:
        return True
    said = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", f"{got.get('class', '')} {got.get('id', '')}").lower()
    names = set(re.split(r"[^a-z0-9]+", said))
    hints = names & BOILER_NAMES
    return bool(hints) and not (names & TEXT_NAMES and not hints & {"comment", "comments", "ad", "ads", "sidebar", "nav", "footer", "menu"})


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, with what pass one needs to know of them."""
    stack, tags = Stack(Element("", False, 0, False, False)), Tags(page)
    out: list[Block] = []
    now = Block()
    regions = 0

    def end_block() -> None:
        nonlocal now
        if now.parts:
            now.text = _SPACE.sub(" ", "".join(now.parts)).strip()
            if now.text:
                out.append(now)
        top = stack.top
        now = Block(region=top.region, in_article=top.in_article, boiler=top.boiler, heading=top.tag in ("h1", "h2", "h3"))

    def say(raw: str) -> None:
        if raw:
            text = unescape(raw)
            now.parts.append(text)
            if stack.top.link:
                now.linked += len(text.strip())

    said = at = 0  # up to where text was taken, up to where the page was read
    while True:
        at = page.find("<", at)
        if at < 0:
            say(page[said:])
            break
        found = None
        if page.startswith(("<!", "<?"), at):
            cdata = page.startswith("<![CDATA[", at)
            close = "-->" if page.startswith("<!--", at) else "]]>" if cdata else ">"
            skip = 4 if close == "-->" else 9 if cdata else 2
            until = page.find(close, at + skip)
            say(page[said:at])
            if cdata:
                say(page[at + skip : until if until >= 0 else len(page)])
            said = at = until + len(close) if until >= 0 else len(page)
            continue
        found = tags.tag(at)
        if found is None:
            if (page.startswith("/", at + 1) or page[at + 1 : at + 2].isalpha()) and page.find("<", at + 1) < 0:
                say(page[said:at])  # the page breaks off inside a tag
                break
            at += 1
            continue
        say(page[said:at])
        closing, tag, attributes, at = found
        said = at
        if closing:
            if depth := stack.last(tag):
                stack.pop_from(depth)
            if tag in BLOCK_TAGS:
                end_block()
            continue
        if tag == "br":
            now.parts.append(" ")
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            until = page.find(">", end.end()) if end else -1
            said = at = until + 1 if until >= 0 else len(page)
            continue
        if tag in VOID:
            if tag in BLOCK_TAGS:
                end_block()
            continue
        # what the start of a block ends by itself
        if tag in ("p", "li", "td", "th", "tr", "dd", "dt", "option") or tag in BLOCK_TAGS:
            if stack.top.tag == "p" or (tag == stack.top.tag and tag in ("li", "td", "th", "tr", "dd", "dt", "option")):
                stack.pop_from(len(stack.elements) - 1)
            elif tag == "p" and stack.blocks:  # inline elements left open inside a paragraph end with it
                depth = stack.blocks[-1]
                if stack.elements[depth].tag == "p":
                    stack.pop_from(depth)
        top = stack.top
        hint = _hinted(tag, attributes, top.in_article)
        region, in_article, boiler = top.region, top.in_article, top.boiler or hint
        if tag in REGIONS and not hint:
            if not top.in_article:
                # an article starts afresh, also inside something left open before it
                boiler = stack.forced > 0
            regions += not top.in_article
            region, in_article = (region if top.in_article else regions), True
        if not attributes.rstrip().endswith("/") or tag in BLOCK_TAGS:
            stack.push(Element(tag, boiler, region, in_article, top.link or tag == "a"))
        if tag in BLOCK_TAGS:
            end_block()
    end_block()
    return out


def _length(text: str) -> int:
    """Letters, those of scripts that write a word or syllable with one sign twice."""
    return len(text) + (0 if text.isascii() else sum(c >= "\u2e80" for c in text))


def _stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)


def speaks_known_language(blocks: list[Block]) -> bool:
    """Whether the stop words can judge a page: enough of its running text is made of them."""
    running = " ".join(b.text for b in blocks if not b.boiler and len(b.text) >= MEDIUM and b.linked <= MAX_LINKS * len(b.text))
    return not running or _stop_share(running) >= KNOWN_LANGUAGE


def first_pass(b: Block, known: bool = True) -> str:
    """good, bad or open. ``known``: whether the stop words are of the page's language.

    Where they are not, length and links decide alone. Inside an article a block with many
    links is open, unless it is nothing but links.
    """
    if b.boiler:
        return "bad"
    length = _length(b.text)
    links = b.linked / len(b.text)
    if links > MAX_LINKS and not (b.heading and b.in_article):
        return "open" if b.in_article and links < ALL_LINKS else "bad"
    if "©" in b.text[:3] and length < LONG and not b.in_article:
        return "bad"
    if length < MEDIUM:
        return "open"
    if not known:
        return "good" if length >= LONG else "open"
    stops = _stop_share(b.text)
    if stops >= STOP_HIGH or (stops >= STOP_LOW and length >= LONG):
        return "good"
    if stops >= STOP_LOW or b.in_article:
        return "open"
    return "bad" if length >= LONG else "open"


def second_pass(blocks: list[Block]) -> None:
    """Label what the first pass left open from the nearest decided neighbours of its region."""
    regions: dict[int, list[Block]] = {}
    for b in blocks:
        # what is never text does not speak for the text around it
        if not b.boiler:
            regions.setdefault(b.region, []).append(b)
    for number, own in regions.items():
        default = "good" if number else "bad"
        decided = [b.label for b in own]
        before: list[tuple[int, str]] = []
        last = (-1, "")
        for i, label in enumerate(decided):
            before.append(last)
            if label != "open":
                last = (i, label)
        after, last = [], (len(own), "")
        for i in range(len(own) - 1, -1, -1):
            after.append(last)
            if decided[i] != "open":
                last = (i, decided[i])
        after.reverse()
        for i, b in enumerate(own):
            if b.label != "open":
                continue
            (p, left), (q, right) = before[i], after[i]
            if not left or not right or left == right:
                b.label = left or right or default
            elif i - p != q - i:
                b.label = left if i - p < q - i else right
            else:
                b.label = "good"


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    known = speaks_known_language(blocks)
    for b in blocks:
        b.label = first_pass(b, known)
    second_pass(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """row (the page's own columns without its html), text, n_chars (code points)."""
    rest = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c != html])
    own = hidden(rest) if rest.columns else F.struct(F.lit(0).alias("_")).alias("row")
    rows = pages.select(own, text_of(f"`{html}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["row", "text", "n_chars"],
                )

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string, n_chars bigint")
