"""Main text of web pages by the distribution of text over line blocks.

Markup is read once into lines: one line for each run of text between block-level tags,
with its plain length, the part of it inside links and the elements around it. Lines of
scripts, styles, forms, menus, headers, footers, sidebars, and of elements whose class, id
or role names an advert, notice, comment section or the like, weigh nothing. Over windows
of ``WINDOW`` lines the remaining lengths are summed; the text surges where a window first
reaches the threshold (a share of the best window, ``ENOUGH`` characters at most) and dives
where it falls below. The run with most text is the article's core. Its ends then move outward
to the innermost element that holds the core and says it is the article. Without one, all runs
in the innermost element around the core join it (where that is the whole page, those of lines
directly in it), noise between them left out, and so do adjoining paragraphs and headings, so
that short ones at its ends are kept. Paragraphs inside that are mostly links stay.

Defined cases: null html is empty and gives empty text and 0; a page without text likewise;
unclosed or stray tags, comments and declarations are passed over, and a tag with an open quote
ends where the quote is closed later, else at its first bracket; character references are
decoded after markup is gone; equal rows give equal results; an empty table gives no rows;
other columns are ignored. Every page is handled on its own, whole, with no shuffle.
"""

from __future__ import annotations

import html as references
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from cinderspark.llm import shared

WINDOW = 3
#: A window counts as text if it holds this share of the fullest window.
SHARE = 0.15
#: Or, on pages with long paragraphs, this many characters.
ENOUGH = 150
#: A line that is mostly links is a menu.
LINK_SHARE = 0.6

# Elements by their role in HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q",
    "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
NOISE = {"nav", "header", "footer", "aside", "form", "button", "select", "option", "svg", "canvas", "object", "dialog", "menu", "fieldset", "label", "head", "input"} | RAW
CONTAINERS = {"article", "main"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "figcaption", "dd", "dt"}
ENDS_PARAGRAPH = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
NOISE_NAMES = re.compile(
    r"(?:^|(?<!has)(?<!with)(?<!without)(?<!no)[\s_-])(?:ad\d*|ads(?:bygoogle|ense)?|adverts?|advertisements?|advertising|ad(?:box|slot|unit|space)|\w*banner|sponsor(?:ed|s)?|promo(?:tion)?s?|"
    r"cookies?(?:bar|notice|banner|law)?|consent|gdpr|notices?|notifications?|alerts?|popup|modal|overlay|paywall|subscribe|subscription|newsletter|signup|login|"
    r"comments?|commentlist|replies|reply|respond|responses|discussion|disqus|\w*nav|navbar|navigation|\w*menus?|breadcrumbs?|\w*sidebars?|side|rail|widgets?|toc|\w*footer|\w*header|masthead|topbar|"
    r"share|sharing|social|related|recommended|recommendations|more-stories|trending|popular|pagination|pager|tags|toolbar|skip|legal|copyright|disclaimer|search|outbrain|taboola)(?=$|[\s_-])"
)
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|article-?body|post|post-?body|post-?content|entry|entry-?content|content|main|main-?content|story|story-?body|body-?text|page-?content)(?=$|[\s_-])")

_OPEN = re.compile(r"<(?=[!?]|/?[a-zA-Z])")
_PASSED = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[|<[!?][^>]*>", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
#: A tag whose quotes do not close ends at the first bracket.
_BROKEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
#: Open quotes are searched for their ends over so many characters for each one of the page.
PATIENCE = 4
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|itemprop|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPACE = re.compile(r"\s+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}


def _markup(page: str):
    """Tags, and None for comments and declarations, as (start, end, tag); in time linear in the page.

    A tag with an open quote costs a look at the rest of the page, so only some of these are given it.
    """
    at, left, last = 0, PATIENCE * len(page), page.rfind(">")
    while (bracket := _OPEN.search(page, at)) is not None:
        at = bracket.start()
        follows = page[at + 1]
        if follows in "!?":
            found = _PASSED.match(page, at) if at < last or page.startswith(("<!--", "<![CDATA["), at) else None
        elif at >= last:
            return
        else:
            found = _TAG.match(page, at) if left > 0 else None
            if found is None:
                left -= len(page) - at
                found = _BROKEN_TAG.match(page, at)
        if found is None:
            at += 1
            continue
        at = found.end()
        jump = yield found.start(), at, found if follows not in "!?" else None
        if jump is not None:
            at = jump
            yield


class _Element:
    __slots__ = ("name", "noise", "content", "parent", "first", "last", "link")

    def __init__(self, name, parent, noise, content, line):
        self.name, self.parent, self.noise, self.content = name, parent, noise, content
        self.first, self.last = line, None
        self.link = name == "a" or bool(parent and parent.link)


def _judge(name: str, attributes: str, by_name: bool) -> tuple[bool, bool]:
    """(is noise, says it is the content); class, id and role count only ``by_name``."""
    if name in NOISE:
        return True, False
    noise, content = False, name in CONTAINERS
    if by_name and attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                noise = noise or bool(NOISE_NAMES.search(value))
                content = content or bool(CONTENT_NAMES.search(value))
            elif key == "role":
                noise, content = noise or value in NOISE_ROLES, content or value in ("main", "article")
            elif key == "itemprop":
                content = content or value == "articlebody"
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                noise = True
    # The page's and the article's own frames are never noise by a name alone, but for readers' comments.
    if name in ("html", "body") or name in CONTAINERS and "comment" not in attributes.lower():
        noise = False
    return noise, content and not noise


def lines(page: str, by_name: bool = True) -> list:
    """Each line is [text, weight, noise, element]; elements know their range of lines."""
    found: list = []
    root = _Element("", None, False, False, 0)
    top = root
    depth: dict[str, int] = {}
    buffer: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            # The decoded text is white-spaced once; a line of nothing is no line.
            text = _SPACE.sub(" ", references.unescape("".join(buffer))).strip()
            if text:
                menu = linked >= LINK_SHARE * len(text)
                found.append([text, 0 if top.noise or menu else len(text), top.noise, top])
            buffer.clear()
        linked = 0

    def text(part: str) -> None:
        nonlocal linked
        if part:
            buffer.append(part)
            if top.link:
                linked += len(part.strip())

    def close(element: _Element) -> None:
        nonlocal top
        while top is not element:
            top.last, depth[top.name] = len(found), depth[top.name] - 1
            top = top.parent
        top.last, depth[top.name] = len(found), depth[top.name] - 1
        top = top.parent

    at, marks = 0, _markup(page)
    for start, end, tag in marks:
        text(page[at:start])
        at = end
        if tag is None:
            continue
        name = tag[2].lower()
        if name not in INLINE:
            flush()
        if tag[1]:
            if depth.get(name):
                element = top
                while element.name != name and (name not in INLINE or element.name in INLINE):
                    element = element.parent
                # A stray end tag of an inline element does not close the blocks inside it.
                if element.name == name:
                    close(element)
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at, page.rfind(">") + 1)
            at = end.end() if end else len(page)
            marks.send(at)
            continue
        if name in ENDS_PARAGRAPH:
            # An open paragraph, with the inline elements in it, ends here.
            element = top
            while element.name in INLINE:
                element = element.parent
            if element.name == "p":
                close(element)
        elif name in ("li", "option", "dd", "dt", "tr", "td", "th") and top.name == name:
            close(top)
        if name in VOID or tag[3].endswith("/") and name not in ("p", "div", "article", "main", "section"):
            continue
        noise, content = _judge(name, tag[3], by_name)
        top = _Element(name, top, top.noise or noise, content and not top.noise, len(found))
        depth[name] = depth.get(name, 0) + 1
    text(page[at:])
    flush()
    while top.parent is not None:
        top.last, top = len(found), top.parent
    root.last = len(found)
    return found


def runs(weights: list[int]) -> list[tuple[int, int]]:
    """The runs of lines between a surge and the dive after it."""
    if not any(weights):
        return []
    n = len(weights)
    sums = [sum(weights[i : i + WINDOW]) for i in range(n)]
    least = max(1, min(ENOUGH, SHARE * max(sums)))
    found, start = [], None
    for i in range(n + 1):
        if i < n and sums[i] >= least:
            start = i if start is None else start
        elif start is not None:
            # The last windows reach beyond their first line.
            stop = min(n, i + WINDOW - 1)
            while weights[start] == 0:
                start += 1
            while weights[stop - 1] == 0:
                stop -= 1
            found.append((start, stop))
            start = None
    return found


def core(weights: list[int]) -> tuple[int, int] | None:
    """The run that holds most text, the first of equal ones."""
    return max(runs(weights), key=lambda run: sum(weights[run[0] : run[1]]), default=None)


def _block(element: _Element) -> str:
    while element.name in INLINE:
        element = element.parent
    return element.name


def _holder(element: _Element) -> _Element:
    """The element around the paragraph that a line is in."""
    while element.parent is not None and (element.name in INLINE or element.name in PROSE):
        element = element.parent
    return element


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = lines(page)
    run = core([line[1] for line in found])
    if run is None:
        # A frame around everything may have a name that sounds like a menu's or a sidebar's.
        found = lines(page, by_name=False)
        run = core([line[1] for line in found])
    if run is None:
        return ""
    start, stop = run
    # Outward: to the element that calls itself the content and holds the heaviest line.
    heaviest = max(range(start, stop), key=lambda i: (found[i][1], -i))
    holder, element = None, found[heaviest][3]
    while element.parent is not None:
        if element.content and (holder is None or element.name in CONTAINERS and holder.name not in CONTAINERS):
            holder = element
        element = element.parent
    if holder is not None:
        return " ".join(line[0] for line in found[holder.first : holder.last] if not line[2])
    # Else all runs in the element around the core, noise passed over, and the paragraphs and headings next to them.
    element = found[heaviest][3]
    while element.parent is not None and not (element.first <= start and element.last >= stop and element.name not in INLINE and element.name != "p"):
        element = element.parent
    whole = element.name in ("", "html", "body")
    inside = [i for i in range(element.first, element.last) if not found[i][2] and (not whole or start <= i < stop or _holder(found[i][3]) is element)]
    for first, last in runs([found[i][1] for i in inside]):
        start, stop = min(start, inside[first]), max(stop, inside[last - 1] + 1)
    plain = lambda i: found[i][1] and _block(found[i][3]) in PROSE
    # Where the core is paragraphs for the most part, lines of another kind at its ends are not of it.
    if 2 * sum(found[i][1] for i in range(start, stop) if plain(i)) >= sum(found[i][1] for i in range(start, stop)):
        while not plain(start):
            start += 1
        while not plain(stop - 1):
            stop -= 1
    before = [i for i in reversed(range(element.first, start)) if whole or not found[i][2]]
    after = [i for i in range(stop, element.last) if whole or not found[i][2]]
    for i in itertools.takewhile(plain, before):
        start = i
    for i in itertools.takewhile(plain, after):
        stop = i + 1
    return " ".join(line[0] for line in found[start:stop] if line[1] or not line[2] and _block(line[3]) in PROSE)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", pages["html"].cast("string")).mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(shared.read(spark, sf_dir, "pages"))
