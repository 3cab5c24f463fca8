"""Main text of web pages by tag-path ratios.

A page's text nodes are put together to blocks; each block has its path of tags from the root. Length and punctuation of
the text outside links are aggregated per path: what stands often and short on a path, or is all links (menus, lists of
teasers), gets low ratios, what stands in sentences high ones. The ratios of the blocks, in page order, are smoothed and fused
(length times punctuation); a path is content if the mean of its blocks reaches a share of the page's mean. The
paths choose the blocks: all of a content path that hang from the content's container, which is the article element around them or,
without one, the smallest that holds nearly all of their text. Of other blocks in the container stay those that belong to the
text by their place: headings that what follows is kept of, items of lists and tables within or right after content, lines between
paragraphs of the same parent; none that is mostly links.

An element takes no part, its ratio being nothing, by its tag (nav, footer, ...), role, or names, as far as it doesn't hold the article.
A name counts as a whole (``sidebar``, ``post-comments``, ``cookie-box``), not as the state of something else
(``has-sidebar``, ``comments-open``) or a part of another noun (``share-price``).

Tokens, elements and sums over elements take time and memory in proportion to the page, however deep or broken its markup.
Each page is worked off in one task as a row, whatever its site; nothing is shuffled.

Inputs without a result of their own: an empty table gives no rows; null or empty html has an empty text; unclosed and
stray tags, unknown declarations, unclosed comments and quotes are read as browsers do; repeated rows get a row each;
other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.llm import words

# Elements of HTML by what they do to text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head script style noscript template svg math iframe object canvas audio video map datalist title textarea".split())
RAW = set("script style textarea title iframe xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
CELLS = {"td", "th"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ITEMS = set("li dd dt tr td th pre blockquote figcaption caption".split())
CONTAINERS = set("article main section div body td center blockquote".split())
#: Start tags that end an open element of the same list.
ENDS = {
    **{t: {"p"} for t in BLOCK - {"body", "html"}},
    "li": {"p", "li"},
    "dt": {"p", "dt", "dd"},
    "dd": {"p", "dt", "dd"},
    "tr": {"p", "tr", "td", "th"},
    "td": {"p", "td", "th"},
    "th": {"p", "td", "th"},
    "option": {"option"},
}
#: No implied end reaches beyond these.
SCOPES = set("article aside body div footer form header html main nav ol section table ul td th dl blockquote".split())

# What rules an element out as boilerplate.
BOILERPLATE_TAGS = set("nav footer aside form menu button select textarea dialog".split())
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form toolbar".split())
BOILERPLATE_NAMES = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright discussion disqus footer gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion related replies reply respond "
    "search share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription toolbar widget widgets".split()
)
COMMENT_NAMES = set("comment comments commentlist discussion disqus replies reply respond".split())
#: Words that make a name of the list no other noun, and words that make it the state of something else.
TAILS = set(
    "area bar block body bottom box buttons column container content form group holder inner item items label left link links list "
    "main outer panel posts right row section slot text thread top unit wrap wrapper zone".split()
)
STATES_BEFORE = set("has no not with without is hide hides show shows".split())
STATES_BEHIND = set("open closed on off enabled disabled visible hidden active inactive allowed".split())
PUNCTUATION = set(".,;:!?…。，、；：！？।؟،¿¡")

#: Production parameters: smoothing weights, share of the mean, share of the content in the container, share of link text.
KERNEL = (0.25, 0.5, 0.25)
LEAST_SHARE = 0.5
HELD_SHARE = 0.9
LINKED_SHARE = 0.5

_COMMENT_END = re.compile(r"--!?>|\Z")
_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?>\s++|/|=|[^\s/>=]++(?:\s*+=\s*+(?>\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+))?+)*+)(?:>|\Z)"
)
_ATTRIBUTE = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+(?>\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?+")
_NAME_WORDS = re.compile(r"[a-z]+")
_WANTED = {"class", "id", "role"}


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("start", tag, attributes) and ("end", tag, "") in page order, read as browsers do."""
    at, n, since = 0, len(html), 0
    while at < n:
        at = html.find("<", at)
        if at < 0:
            break
        then = html[at + 1 : at + 2]
        if then == "!" or then == "?" or (then == "/" and not html[at + 2 : at + 3].isalpha()):
            if since < at:
                yield "text", html[since:at], ""
            if html.startswith("<!--", at):
                # an abrupt end needs no second pair of dashes
                abrupt = next((len(x) for x in ("<!-->", "<!--->") if html.startswith(x, at)), 0)
                at = at + abrupt if abrupt else _COMMENT_END.search(html, at + 4).end()
            else:
                end = html.find(">", at)
                at = n if end < 0 else end + 1
            since = at
            continue
        found = _TAG.match(html, at)
        if not found:
            at += 1
            continue
        if since < at:
            yield "text", html[since:at], ""
        tag = found[2].lower()
        at = since = found.end()
        yield ("end" if found[1] else "start"), tag, found[3]
        if not found[1] and tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.IGNORECASE).search(html, at)
            at = since = close.start() if close else n
    if since < n:
        yield "text", html[since:], ""


def _named(token: str) -> str | None:
    """The word of the list that a class or id is named by."""
    parts = _NAME_WORDS.findall(token.lower())
    if not parts or parts[0] in STATES_BEFORE or parts[-1] in STATES_BEHIND:
        return None
    if parts[-1] in BOILERPLATE_NAMES:
        return parts[-1]
    if parts[0] in BOILERPLATE_NAMES and all(p in TAILS for p in parts[1:]):
        return parts[0]
    return None


@dataclass(slots=True)
class Element:
    """An open or closed element. ``path`` numbers its path of tags, ``block`` is the element its text belongs to."""

    number: int
    tag: str
    up: Element | None
    path: int
    depth: int
    unseen: bool
    link: bool
    by_tag: bool
    role: bool
    name: str | None
    block: Element | None = None
    out: bool = False
    opened: dict[str, int] | None = None  # of a scope: its open elements by tag


@dataclass(slots=True)
class Block:
    at: Element
    text: list[str] = field(default_factory=list)
    linked: int = 0


class Page:
    """Elements and text blocks of a page."""

    def __init__(self, html: str) -> None:
        self.paths: dict[tuple[int, str], int] = {}
        self.at = Element(0, "", None, 0, 0, False, False, False, False, None, opened={})
        self.at.block = self.at
        self.elements = [self.at]
        self.scope = [self.at]  # open elements that no implied end reaches beyond
        self.open: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.fresh = True
        for kind, what, rest in tokens(html):
            if kind == "text":
                self._add(what if self.at.unseen else entities.unescape(what))
            elif kind == "start":
                self._start(what, rest)
            else:
                self._end(what)

    def _start(self, tag: str, rest: str) -> None:
        ends = ENDS.get(tag)
        while ends and any(self.scope[-1].opened.get(t) for t in ends):
            self._close(lambda e, ends=ends: e.tag in ends)
        if tag in CELLS and ends and self.at.tag in ends:  # a cell is a scope of its own
            self._pop()
        if tag == "tr" and self.at.tag in CELLS:
            self._pop()
            self._start(tag, rest)
            return
        if tag in BLOCK:
            self.fresh = True
        if tag in VOID:
            if tag == "br":
                self._add(" ")
            return
        up = self.at
        given = {}
        if rest and not up.unseen:
            for name, *values in _ATTRIBUTE.findall(rest):
                if (name := name.lower()) in _WANTED:
                    given.setdefault(name, entities.unescape("".join(values)))
        names = [found for key in ("class", "id") for token in given.get(key, "").split() if (found := _named(token))]
        path = self.paths.setdefault((up.path, tag), len(self.paths) + 1)
        new = Element(
            len(self.elements),
            tag,
            up,
            path,
            up.depth + 1,
            up.unseen or tag in UNSEEN,
            up.link or tag == "a",
            tag in BOILERPLATE_TAGS or tag == "header",
            given.get("role", "").strip().lower() in BOILERPLATE_ROLES,
            next(iter(names), None) if tag not in ("html", "body", "main") else None,
        )
        own = tag in BLOCK or new.by_tag or new.role or new.name is not None
        new.block = new if own else up.block
        self.elements.append(new)
        self.at = new
        if tag in SCOPES:
            new.opened = {}
            self.scope.append(new)
        else:
            self.scope[-1].opened[tag] = self.scope[-1].opened.get(tag, 0) + 1
        self.open[tag] = self.open.get(tag, 0) + 1

    def _pop(self) -> None:
        gone = self.at
        self.open[gone.tag] -= 1
        if gone.opened is not None:
            self.scope.pop()
        else:
            self.scope[-1].opened[gone.tag] -= 1
        self.at = gone.up

    def _close(self, which) -> None:
        """Pop up to the innermost element that it is said of."""
        while not which(self.at):
            self._pop()
        self._pop()

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self.fresh = True
        known = self.open.get(tag) if tag in SCOPES else self.scope[-1].opened.get(tag)
        if known:  # else a stray end tag
            self._close(lambda e: e.tag == tag)

    def _add(self, data: str) -> None:
        at = self.at
        if at.unseen:
            return
        if self.fresh or not self.blocks or self.blocks[-1].at is not at.block:
            if data.isspace():
                if not self.fresh and self.blocks:
                    self.blocks[-1].text.append(data)
                return
            # text of an inline element goes on with its block, also behind an inline boilerplate element
            self.blocks.append(Block(at.block))
            self.fresh = False
        self.blocks[-1].text.append(data)
        if at.link:
            self.blocks[-1].linked += len(data.strip())

    def sums(self, own: np.ndarray) -> np.ndarray:
        """``own`` of each element and of all below it."""
        total = own.astype(float)
        for e in reversed(self.elements):
            if e.up is not None:
                total[e.up.number] += total[e.number]
        return total


def rule_out(page: Page, size: np.ndarray, at: list[Element]) -> None:
    """Mark the elements that take no part: boilerplate by tag, role or name that doesn't hold the article, and all below them."""
    n = len(page.elements)
    article = page.sums(np.array([e.tag in ("article", "main") and e.name is None for e in page.elements]))
    own = np.zeros(n)
    np.add.at(own, [e.number for e in at], size)
    text = page.sums(own)
    most = text >= 0.5 * max(1.0, text[0])
    for e in page.elements:
        if e.up is None:
            continue
        holds = bool(article[e.number]) and e.tag not in ("article", "main")
        wraps = e.tag in ("form", "header") and most[e.number]
        named = e.name is not None and not holds and (e.name in COMMENT_NAMES or not most[e.number])
        own_out = ((e.by_tag or e.role) and not holds and not wraps) or named
        e.out = e.up.out or own_out
        # headings in the header of an article belong to it
        if e.tag in HEADINGS and e.up.out and not named and _in_article_header(e):
            e.out = False


def _in_article_header(heading: Element) -> bool:
    """Whether only a header, and groups in it, stand between a heading and its article; these are few levels."""
    element, header = heading.up, False
    for _ in range(4):
        if element is None or element.tag not in ("header", "hgroup", "div", "article") or element.name not in (None, "header"):
            return False
        if element.tag == "article":
            return header and not element.out
        header |= element.tag == "header"
        element = element.up
    return False


def page_blocks(html: str) -> tuple[Page, list[tuple[Element, str]], np.ndarray]:
    """The page, (element, text) of its blocks in page order, white space collapsed, and how much of each text is in links."""
    page = Page(html)
    found = [(b.at, " ".join("".join(b.text).split()), b.linked) for b in page.blocks]
    found = [f for f in found if f[1]]
    linked = np.array([min(k, len(text)) for _, text, k in found], dtype=float)
    blocks = [(at, text) for at, text, _ in found]
    rule_out(page, np.array([len(text) for _, text in blocks]) - linked, [at for at, _ in blocks])
    return page, blocks, linked


def block_ratios(blocks: list[tuple[Element, str]], linked: np.ndarray) -> np.ndarray:
    """The fused, smoothed ratio of each block: of its path's text and punctuation per block on that path."""
    paths: dict[int, list[float]] = {}
    for (at, text), k in zip(blocks, linked, strict=True):
        if not at.out:
            total = paths.setdefault(at.path, [0.0, 0.0, 0.0])
            total[0] += len(text) - k
            total[1] += sum(c in PUNCTUATION for c in text)
            total[2] += 1
    means = [[0.0, 0.0] if at.out else [x / paths[at.path][2] for x in paths[at.path][:2]] for at, _ in blocks]
    kernel, reach = np.array(KERNEL), len(KERNEL) // 2
    smooth = [np.convolve(np.pad(np.array(x), reach, mode="edge"), kernel, mode="valid") for x in zip(*means)]
    return smooth[0] * (1.0 + smooth[1])


def content_paths(blocks: list[tuple[Element, str]], ratios: np.ndarray) -> set[int]:
    """The paths whose blocks' mean ratio reaches a share of the mean of all blocks that take part."""
    by_path: dict[int, list[float]] = {}
    for (at, _), ratio in zip(blocks, ratios, strict=True):
        if not at.out:
            by_path.setdefault(at.path, []).append(ratio)
    every = [r for found in by_path.values() for r in found]
    least = LEAST_SHARE * sum(every) / len(every) if every else 0.0
    return {path for path, found in by_path.items() if sum(found) > 0 and sum(found) / len(found) >= least}


def content_container(page: Page, blocks: list[tuple[Element, str]], content: np.ndarray, size: np.ndarray) -> Element | None:
    """The article around the content or, without one, the smallest container of nearly all of it, and headings beside it."""
    if not content.any():
        return None
    own = np.zeros(len(page.elements))
    np.add.at(own, [blocks[i][0].number for i in np.flatnonzero(content)], size[content])
    held = page.sums(own)
    enough = [e for e in page.elements if held[e.number] >= HELD_SHARE * held[0] and (e.tag in CONTAINERS or e.up is None)]
    best = max(enough, key=lambda e: e.depth)
    for tag in ("article", "main"):
        element = best
        while element is not None:
            if element.tag == tag and not element.out:
                return element
            element = element.up
    # wider as long as only headings come with it
    other = np.zeros(len(page.elements))
    np.add.at(other, [at.number for (at, _), c in zip(blocks, content, strict=True) if not at.out and not c and at.tag not in HEADINGS], 1)
    others = page.sums(other)
    while best.up is not None and best.up.tag not in ("html", "") and others[best.up.number] == others[best.number]:
        best = best.up
    return best


def main_blocks(html: str | None) -> list[str]:
    """The article's blocks in page order."""
    if not html:
        return []
    page, blocks, linked = page_blocks(html)
    if not blocks:
        return []
    chosen = content_paths(blocks, block_ratios(blocks, linked))
    size = np.array([len(text) for _, text in blocks], dtype=float)
    links = linked > LINKED_SHARE * size
    content = np.array([not at.out and at.path in chosen for at, _ in blocks]) & ~links
    container = content_container(page, blocks, content, size)
    if container is None:
        return []
    below = np.zeros(len(page.elements), bool)
    for e in page.elements:
        below[e.number] = e is container or (e.up is not None and below[e.up.number])
    within = np.array([below[at.number] and not at.out for at, _ in blocks])
    kept = _with_neighbours([at for at, _ in blocks], content & within, within & ~links)
    return [text for (_, text), keep in zip(blocks, kept, strict=True) if keep]


def _with_neighbours(at: list[Element], content: np.ndarray, able: np.ndarray) -> np.ndarray:
    """``content`` and the blocks among ``able`` ones that belong to it by their place."""
    kept = content.copy()
    places = np.flatnonzero(content)
    if not len(places):
        return kept
    first, last = places[0], places[-1]
    parents = {at[i].up.number for i in places if at[i].up is not None}
    before = False  # whether the block before is kept
    for i, element in enumerate(at):
        if able[i] and not kept[i] and element.tag not in HEADINGS:
            if element.tag in ITEMS:
                kept[i] = first < i < last or before
            elif element.up is not None:
                kept[i] = first < i < last and element.up.number in parents
        before = bool(kept[i]) or (before and element.tag in HEADINGS)
    following = False  # whether the next block that is no heading is kept
    for i in range(len(at) - 1, -1, -1):
        if at[i].tag not in HEADINGS:
            following = bool(kept[i]) if able[i] or kept[i] else following
        elif able[i] and not kept[i]:
            kept[i] = following
        elif kept[i] and not following and i > last:
            kept[i] = False
    return kept


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = ["\n\n".join(main_blocks(html.as_py())) for html in batch.column("html")]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (blocks joined by an empty line), n_chars (code points)."""
    pages = pages.select("page_id", "url", "html")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    return pages.transform(words.map_texts, _text_rows, schema).withColumn("n_chars", F.char_length("text").cast("long"))
