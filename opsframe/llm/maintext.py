"""The main text of web pages by tag-path ratios.

A page is read into blocks: the text between two block-level tags, with its path
of block-level tags (and their first class) from the root. What stands in
elements that never hold an article (menus, forms, scripts ...), by tag or role, is
left out beforehand, and so is what class or id name as no part of one, unless
the element turns out to hold the page's article or most of its text. Over the rest, each path's text length and
punctuation are summed and divided by its number of blocks, less what is linked.
Both ratios are fused, smoothed over the blocks in page order, and paths that
reach the threshold are content. The article is the innermost element that holds
nearly all of them, with the headings and short paragraphs that it has besides.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of the mean fused ratio (weighted by length) that a content path reaches.
THRESHOLD = 0.3
# Weights of a block and of its neighbours in the smoothed ratio.
KERNEL = (0.15, 0.7, 0.15)
# Share of the content that the article's element holds.
HELD = 0.8
LINKED = 0.5

# Element names of HTML by what they mean here.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style noscript template textarea title iframe xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME_LEVEL = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}
NEVER = frozenset(
    "head nav header footer aside form button select label fieldset legend dialog menu svg object "
    "canvas audio video map applet".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar tablist".split()
)
NAMES = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer sidebar "
    "aside rail cookie cookies consent gdpr privacy banner notice notices notification alert ad ads "
    "adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion comment "
    "comments commentlist replies reply respond disqus discussion share sharing social related "
    "recommended recommendations subscribe subscription newsletter signup login search popup modal "
    "overlay widget widgets pagination pager toolbar copyright skip".split()
)
STARTS = ("comment", "advert", "cookie", "sidebar", "breadcrumb", "sponsor", "navbar")
#: In the names of elements that hold an article, only these count.
IN_ARTICLE = ("comment", "advert", "sponsor", "promo", "related", "repl")
MODIFIERS = frozenset("has no not with without is".split())
#: Of paragraphs in an article, only names that begin so count.
IN_PARAGRAPH = ("comment", "advert", "sponsor", "promo", "repl", "cookie", "newsletter", "subscri", "copyright")
#: Elements named so are not kept for the share of text that they hold: replies can be longer than the article.
REPLIES = ("comment", "repl", "respond", "disqus", "discussion")
# Shares of the page's unlinked text: an article in a named element that clears it, the text that
# clears one where no other article is, and what has to be left for the names to count at all.
CLEARED = 0.3
MOSTLY = 0.5
SMALL = 0.1
HOLDERS = frozenset("html body main article section div td center details".split())
ROOTS = frozenset(["", "html", "body"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)",
    re.DOTALL,
)
#: What ends a tag, or opens a quoted value in it.
TAG_STOP = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？¿¡]")


def _attributes(raw: str) -> dict[str, str]:
    if "=" not in raw and "hidden" not in raw:
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}


def _hidden(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is not shown or, by its role, no part of an article."""
    if not attributes or tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    return attributes.get("role", "").lower() in ROLES


def _named(tag: str, attributes: dict[str, str], in_article: bool) -> str | None:
    """The word of its class or id by which an element is no part of an article."""
    if not attributes or tag in ("html", "body"):
        return None
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or words[0] in MODIFIERS:
            continue
        for k, w in enumerate(words):
            if k and words[k - 1] in MODIFIERS:
                continue
            if tag in ("main", "article"):
                named = w.startswith(IN_ARTICLE)
            elif tag == "p" and in_article:
                named = w.startswith(IN_PARAGRAPH) or w in ("ad", "ads")
            else:
                named = w in NAMES or w.startswith(STARTS)
            if named:
                return w
    return None


class Page:
    """Blocks of one page in order, and the paths they stand on.

    ``strict`` leaves out by attributes and forms too; without it only elements
    that hold no running text are left out.
    """

    def __init__(self, source: str, strict: bool = True) -> None:
        self.strict = strict
        # Path number -> (parent's number, tag); number 0 is the root.
        self.paths: list[tuple[int, str]] = [(-1, "")]
        self.numbers: dict[tuple[int, str], int] = {}
        self.instances: Counter[int] = Counter()
        self.parts = 0
        self.blocks: list[tuple[int, str, int]] = []
        # Blocks with the named elements and the articles they are in, before these are judged.
        self.found: list[tuple[int, str, int, tuple[int, ...], tuple[int, ...]]] = []
        self.names: list[str] = []
        self.articles: list[tuple[tuple[int, ...], bool]] = []
        self.open: list[tuple[str, int, bool, bool, tuple[int, ...], tuple[int, ...]]] = []
        self.counts: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.linked = 0
        self._read(source)
        self._judge()

    def _judge(self) -> None:
        """Drop the blocks of named elements, but for those that hold the article."""
        if not self.names:
            self.blocks = [x[:3] for x in self.found]
            return
        sizes = [len(text) - min(linked, len(text)) for _, text, linked, _, _ in self.found]

        def held(blocks: list[int], at: int) -> Counter[int]:
            """Unlinked text of those blocks in each named element (3) or article (4)."""
            out: Counter[int] = Counter()
            for k in blocks:
                out.update(dict.fromkeys(self.found[k][at], sizes[k]))
            return out

        def articles_in(k: int) -> list[int]:
            return [a for a, (named, own) in enumerate(self.articles) if k in named and not own]

        every = list(range(len(self.found)))
        whole = held(every, 4)
        replies = {
            k for k, word in enumerate(self.names)
            if word.startswith(REPLIES) and not any(whole[a] >= MOSTLY * sum(sizes) for a in articles_in(k))
        }
        own = [k for k in every if replies.isdisjoint(self.found[k][3])]
        total, inside, article = sum(sizes[k] for k in own), held(own, 3), held(own, 4)
        free = any(article[a] for a, (named, _) in enumerate(self.articles) if not named)

        def cleared(k: int) -> bool:
            if k in replies:
                return False
            if any(article[a] >= max(CLEARED * total, 1) for a in articles_in(k)):
                return True
            if self.names[k].startswith(REPLIES):
                return True  # it holds the page's article
            return not free and inside[k] >= max(MOSTLY * total, 1)

        out = {k for k in range(len(self.names)) if not cleared(k)}
        left = sum(sizes[k] for k in own if out.isdisjoint(self.found[k][3]))
        if left < SMALL * total and not free:
            out &= replies
        self.blocks = [x[:3] for x in self.found if out.isdisjoint(x[3])]

    def _tag_end(self, source: str, at: int) -> int:
        """Where the tag ends whose name ends at ``at``; -1 if nowhere.

        Quoted values may have any length. If a quote is never closed, or no tag
        end follows the values, the next ``>`` ends the tag.
        """
        if at > self.last[">"]:
            return -1
        seen = []
        stop = TAG_STOP.search(source, at)
        while stop is not None and stop[1]:
            # No quote is passed twice in vain, so broken pages are read in linear time.
            if stop.start() in self.in_vain or stop.end() > self.last[stop[1]]:
                stop = None
                break
            seen.append(stop.start())
            stop = TAG_STOP.search(source, source.index(stop[1], stop.end()) + 1)
        if stop is not None:
            return stop.end()
        self.in_vain.update(seen)
        return source.index(">", at) + 1

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        self.last = {c: source.rfind(c) for c in "\"'>"}
        self.in_vain: set[int] = set()
        while at < n:
            token = TOKEN.search(source, at)
            if token is None:
                self._text(source[at:])
                break
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            if token[2] is None:
                if token[0].startswith("<![CDATA["):
                    self._text(token[0][9:].removesuffix("]]>"))
                continue
            end = self._tag_end(source, at)
            if end < 0:
                self._text(token[0])
                continue
            raw, at = source[at:end], end
            tag = token[2].lower()
            if token[1]:
                self._end(tag)
            elif tag in RAW:
                close = re.compile(f"</{re.escape(tag)}[^>]*>", re.IGNORECASE).search(source, at)
                at = close.end() if close else n
            else:
                self._start(tag, raw)
        self._block()

    def _top(self) -> tuple[str, int, bool, bool, tuple[int, ...], tuple[int, ...]]:
        return self.open[-1] if self.open else ("", 0, False, False, (), ())

    def _text(self, raw: str) -> None:
        _, _, out, linked, _, _ = self._top()
        if not out:
            text = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(text)
            if linked:
                self.linked += len(text.strip())

    def _block(self) -> None:
        """Ends the block that the pieces so far make up."""
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                top = self._top()
                self.found.append((top[1], text, self.linked, top[4], top[5]))
            self.pieces = []
        self.linked = 0

    def _pop(self, depth: int) -> None:
        if any(tag not in INLINE for tag, *_ in self.open[depth:]):
            self._block()
        for tag, *_ in self.open[depth:]:
            self.counts[tag] -= 1
        del self.open[depth:]

    def _end(self, tag: str) -> None:
        if not self.counts[tag]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self._pop(depth)
                return
            if tag in INLINE and self.open[depth][0] not in INLINE:
                return

    def _implied(self, tags: str, barriers: tuple[str, ...]) -> None:
        closing = tags.split()
        if not any(self.counts[t] for t in closing):
            return
        found = None
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] in barriers:
                break
            if self.open[depth][0] in closing:
                found = depth
        if found is not None:
            self._pop(found)

    def _start(self, tag: str, raw: str) -> None:
        if tag in VOID:
            if tag in ("br", "hr"):
                self._text(" ") if tag == "br" else self._block()
            return
        if tag in CLOSES_P:
            self._implied("p", ("td", "th", "button", "object", "article", "section", "div", "li"))
        if tag in SAME_LEVEL:
            self._implied(*SAME_LEVEL[tag])
        attributes = _attributes(raw)
        above, path, out, linked, named, articles = self._top()
        if tag in INLINE:
            out = out or self.strict and (_hidden(tag, attributes) or _named(tag, attributes, False) is not None)
            if not raw.endswith("/>"):
                self._push(tag, path, out, linked or tag == "a", named, articles)
            return
        self._block()
        first = attributes.get("class", "").split()[:1] or attributes.get("id", "").split()[:1]
        if not first and tag in HOLDERS and self.paths[path][1] in ROOTS:
            # Nameless parts of the page's layout are told apart by their place.
            self.parts += 1
            first = [str(self.parts)]
        key = (path, ".".join([tag, *first]))
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.paths)
            self.paths.append((path, tag))
        self.instances[number] += 1
        if tag in HEADINGS and above == "header" and (self.counts["article"] or self.counts["main"]):
            out = self._above_header()  # the article's own title
        elif tag in NEVER and (self.strict or tag not in ("form", "label", "fieldset")):
            out = True
        elif self.strict and not out:
            out = _hidden(tag, attributes)
            word = None if out else _named(tag, attributes, bool(articles))
            if word is not None:
                named = (*named, len(self.names))
                self.names.append(word)
            if tag in ("article", "main"):
                articles = (*articles, len(self.articles))
                self.articles.append((named, word is not None))
        if not raw.endswith("/>") or tag in ("div", "p"):
            self._push(tag, number, out, linked, named, articles)

    def _above_header(self) -> bool:
        return self.open[-2][2] if len(self.open) > 1 else False

    def _push(
        self, tag: str, path: int, out: bool, linked: bool, named: tuple[int, ...], articles: tuple[int, ...]
    ) -> None:
        self.open.append((tag, path, out, linked, named, articles))
        self.counts[tag] += 1


def _fused(page: Page) -> dict[int, float]:
    """Each path's text per block times punctuation per block, less the linked share; smoothed."""
    n, chars, stops, links = Counter(), Counter(), Counter(), Counter()
    for path, text, linked in page.blocks:
        n[path] += 1
        chars[path] += len(text)
        stops[path] += len(PUNCTUATION.findall(text))
        links[path] += min(linked, len(text))
    plain = {
        path: (chars[path] - links[path]) / n[path] * (1 + stops[path] / n[path])
        * (1 - links[path] / chars[path])
        for path in n
    }
    along = [plain[path] for path, _, _ in page.blocks]
    sums: Counter[int] = Counter()
    for i, (path, _, _) in enumerate(page.blocks):
        before = along[i - 1] if i else along[i]
        after = along[i + 1] if i + 1 < len(along) else along[i]
        sums[path] += KERNEL[0] * before + KERNEL[1] * along[i] + KERNEL[2] * after
    return {path: sums[path] / n[path] for path in n}


def _article(page: Page, content: set[int]) -> int:
    """The innermost single element that holds nearly all of the content's text.

    Nothing inside an article or main element is left behind, and from other
    elements only layout: no content, heading or unlinked paragraph. Only an
    article or main element itself is entered whatever is beside it.
    """
    weight: Counter[int] = Counter()
    for path, text, _ in page.blocks:
        if path in content:
            weight[path] += len(text)
    total = sum(weight.values())
    held: Counter[int] = Counter()
    # A path's number is larger than its parent's, so this hands weights upwards.
    for path in range(len(page.paths) - 1, 0, -1):
        held[path] += weight[path]
        held[page.paths[path][0]] += held[path]
    # Blocks that must not be left behind, on each path and below it.
    kept: Counter[int] = Counter()
    for path, text, linked in page.blocks:
        tag = page.paths[path][1]
        kept[path] += path in content or tag in HEADINGS or tag == "p" and linked <= LINKED * len(text)
    for path in range(len(page.paths) - 1, 0, -1):
        kept[page.paths[path][0]] += kept[path]
    best = 0
    for path in range(1, len(page.paths)):
        if page.paths[best][1] in ("article", "main"):
            break
        parent, tag = page.paths[path]
        if parent == best or _inside(page, path, best):
            whole = kept[path] == kept[best] or tag in ("article", "main")
            enough = held[path] >= HELD * total and whole
            if enough and tag in HOLDERS and page.instances[path] == 1:
                best = path
    return best


def _inside(page: Page, path: int, holder: int) -> bool:
    while path > holder:
        path = page.paths[path][0]
    return path == holder


def _belonging(page: Page, content: set[int], holder: int) -> list[bool]:
    """Per path whether its blocks are of the article: inside the holder and, if that is the
    whole page, not in a part of the layout that has no content."""
    filled = [path in content for path in range(len(page.paths))]
    for path in range(len(page.paths) - 1, 0, -1):
        if filled[path]:
            filled[page.paths[path][0]] = True
    belongs = [path == holder for path in range(len(page.paths))]
    for path in range(holder + 1, len(page.paths)):
        parent, tag = page.paths[path]
        belongs[path] = belongs[parent] and not (
            tag in HOLDERS and not filled[path] and page.paths[parent][1] in ROOTS
        )
    return belongs


def main_text(source: str | None) -> str:
    """The article of one page; empty if it has none."""
    if not source:
        return ""
    page = Page(source)
    if not page.blocks:
        page = Page(source, strict=False)
        if not page.blocks:
            return ""
    ratios = _fused(page)
    chars = sum(len(text) for _, text, _ in page.blocks)
    mean = sum(ratios[path] * len(text) for path, text, _ in page.blocks) / chars
    content = {path for path, ratio in ratios.items() if ratio >= THRESHOLD * mean}
    holder = _article(page, content)
    belongs = _belonging(page, content, holder)
    return " ".join(
        text
        for path, text, linked in page.blocks
        if belongs[path] and (path in content or linked <= LINKED * len(text))
    )


def extracted(page_html: Column) -> Column:
    """Main text of a column of whole pages; null and empty pages give an empty text."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(x.as_py()) for x in batch], pa.string())

    return of(page_html)


def with_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text and ``n_chars``, its code points.

    Rows stay as they are, repeated or not; columns of these names that were
    there are replaced. Text without any tag is the article itself.
    """
    return pages.withColumn(text_col, extracted(F.col(html_col))).withColumn(
        "n_chars", F.length(text_col).cast("long")
    )
