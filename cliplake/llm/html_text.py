"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element. A line weighs as much as its
text outside links, or nothing if most of it is in links. Lines of menus, headers,
footers, sidebars, notices, adverts, forms and comments, told by elements, roles
and class names, weigh nothing; lines of an article that the page names weigh
BOOST times as much. Weights are summed over windows of WINDOW lines, and one
threshold is taken from the sums of the page. A stretch of the page from where the
sums rise from nothing to where they dive to nothing is text if they surge over
the threshold in between. Its lines are kept, but for those of the parts above and,
outside a named article, for runs of lines of links; inside one, links between two
of its lines stay.

Scale: one pass over the pages, no shuffle, a page at a time, in time linear in
its length: the tokenizer never goes back, and open elements are counted, so that
none is searched for that isn't open.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: A sum of this many characters is a surge on any page.
SURGE = 86
#: Weight of a line in a named article.
BOOST = 4
#: A line must have this share of its text outside links to weigh.
PLAIN_SHARE = 0.5
#: So many lines of links in a row are a list of links.
LINK_RUN = 2

_OPEN = re.compile(r"</?([a-zA-Z][a-zA-Z0-9-]*+)")
_REST = re.compile(r"(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>")
#: Elements whose content is not marked-up text; they end at their end tag.
_RAW = frozenset("script style noscript template svg textarea select iframe title".split())
_RAW_END = {n: re.compile(rf"</{n}\b[^>]*>?", re.IGNORECASE) for n in sorted(_RAW)}
_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never the article's.
_OUT = frozenset("nav header footer aside form menu dialog button head label".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Names of such parts, alone or as the last word of a name.
_PARTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar cookies consent gdpr notice popup modal newsletter subscribe signup login comments disqus replies respond pagination pager toolbar adbox adslot adunit adsbygoogle leaderboard topnav mainnav subnav commentlist cookiebar cookiebanner cookienotice sharebar sharebuttons relatedposts".split())
#: Names that say so when they stand alone, or first before words that only hold things.
_FIRST = _PARTS | frozenset("cookie comment reply share sharing social related recommended recommendations search header aside widget topbar".split())
_HOLDERS = frozenset("area bar block body bottom box button buttons card cards container content form group icons inner item items left links list main message module outer overlay panel posts right row section slot stories text top unit wrap wrapper header".split())
#: Names that say so outside a named article only.
_LOOSE = frozenset("header side aside related recommended share sharing social search alert legal copyright top widget".split())
#: Words in front of a part that say whether a layout has it.
_LAYOUT = frozenset("with without has no not is".split())
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$|/)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Elements that an open p ends at, and those that end others of their kind.
_ENDS_P = _BLOCKS - {"body", "html", "head", "caption", "option", "tbody", "td", "tfoot", "th", "thead", "tr"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _named(name: str, article: bool) -> bool:
    """Whether a class or id names a part that is not the article. Of a name of several words the last one says what it is, or the first before words that only hold things."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words:
        return False
    if len(words) == 1:
        return words[0] in _PARTS or words[0] in ("comment", "reply", "cookie") or (not article and words[0] in _LOOSE)
    if words[0] in _LAYOUT:
        return False
    if words[-1] in _PARTS or words == ["site", "header"]:
        return True
    return words[0] in _FIRST and all(w in _HOLDERS or w in _PARTS for w in words[1:]) and not (article and words[0] in _LOOSE and words[-1] == "content")


def _out_of_place(name: str, attrs: str, article: bool) -> bool:
    if name in ("body", "html", "main", "article"):
        return False
    if name in _OUT and not (name == "header" and article):  # an article's own heading
        return True
    if not attrs:
        return False
    if _HIDDEN.search(attrs):
        return True
    for kind, a, b, c in _ATTRIBUTE.findall(attrs):
        value = a or b or c
        if kind.lower() == "role":
            if value.strip().lower() in _ROLES:
                return True
        elif any(_named(x, article) for x in value.split()):
            return True
    return False


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(text, "", ""), ("", name, attributes) of start tags and ("", "/name", "") of end tags, in order.

    An end of a tag inside quotes is not one, unless quotes are never closed;
    from there on a tag ends at the next >."""
    at, n, quotes = 0, len(html), True
    while at < n:
        start = html.find("<", at)
        if start < 0:
            break
        if html.startswith("<!--", start):
            end = html.find("-->", start + 2)
            yield html[at:start], "", ""
            at = n if end < 0 else end + 3
            continue
        mark = html[start + 1 : start + 2]
        m = _OPEN.match(html, start)
        if not m and mark not in ("!", "?", "/"):
            yield html[at : start + 1], "", ""
            at = start + 1
            continue
        if start > at:
            yield html[at:start], "", ""
        if m and quotes and (rest := _REST.match(html, m.end())):
            end = rest.end()
        else:
            end = html.find(">", m.end() if m else start) + 1
            if m and end:
                quotes = False
        if not end:  # no tag ends any more
            at = n if m else start
            if not m:
                yield html[start:], "", ""
                at = n
            break
        at = end
        if not m:
            continue
        name = m.group(1).lower()
        if html[start + 1] == "/":
            yield "", "/" + name, ""
            continue
        attrs = html[m.end() : end - 1]
        yield "", name, attrs
        if name in _RAW and not attrs.endswith("/"):
            close = _RAW_END[name].search(html, end)
            at = close.end() if close else n
    if at < n:
        yield html[at:], "", ""


class _Block:
    """An open block element and the inline elements open in it."""

    __slots__ = ("name", "out", "article", "inner", "names")

    def __init__(self, name: str, out: bool, article: bool):
        self.name, self.out, self.article = name, out, article
        self.inner: list[tuple[str, bool]] = []
        self.names: Counter = Counter()


def lines(html: str) -> list[tuple[str, int, bool, int]]:
    """(text, characters outside links, out of place, number of the outermost named article it is in, 0 if none) of each block in page order."""
    found: list[tuple[str, int, bool, int]] = []
    blocks = [_Block("", False, False)]
    open_blocks: Counter = Counter()
    text: list[str] = []
    link: list[str] = []
    out = articles = links = number = 0

    def flush() -> None:
        if text:
            raw = _SPACE.sub(" ", unescape("".join(text))).strip()
            if raw:
                linked = len(_SPACE.sub(" ", unescape("".join(link))).strip())
                found.append((raw, max(0, len(raw) - linked), out > 0, number if articles > 0 else 0))
            text.clear()
            link.clear()

    def close_inner(block: _Block) -> str:
        nonlocal out, links
        name, bad = block.inner.pop()
        block.names[name] -= 1
        out -= bad
        links -= name == "a"
        return name

    def close_block() -> str:
        nonlocal out, articles
        block = blocks.pop()
        blocks.append(block)
        while block.inner:
            close_inner(block)
        blocks.pop()
        open_blocks[block.name] -= 1
        out -= block.out
        articles -= block.article
        return block.name

    for part, name, attrs in tokens(html):
        if not name:
            text.append(part)
            if links:
                link.append(part)
        elif name == "br":
            text.append(" ")
        elif name[0] == "/":
            name = name[1:]
            if name in _BLOCKS:
                flush()
                if open_blocks[name] > 0:
                    while close_block() != name:
                        pass
            elif blocks[-1].names[name] > 0:
                while close_inner(blocks[-1]) != name:
                    pass
        elif name in _BLOCKS:
            flush()
            if name in _VOID:
                continue
            top = blocks[-1].name
            if top in _SIBLINGS.get(name, ()) or (top == "p" and name in _ENDS_P):
                close_block()
            block = _Block(name, _out_of_place(name, attrs, articles > 0), name in ("article", "main"))
            blocks.append(block)
            open_blocks[name] += 1
            out += block.out
            number += block.article and not articles
            articles += block.article
        elif name not in _VOID and name not in _RAW and not attrs.endswith("/"):
            bad = _out_of_place(name, attrs, articles > 0)
            blocks[-1].inner.append((name, bad))
            blocks[-1].names[name] += 1
            out += bad
            links += name == "a"
    flush()
    return found


def weights(found: list[tuple[str, int, bool, int]]) -> list[int]:
    weight = [0 if bad or plain < PLAIN_SHARE * len(text) else plain * (BOOST if art else 1) for text, plain, bad, art in found]
    # lines of links between two lines of one named article are part of it
    last: dict[int, int] = {art: k for k, (_, _, _, art) in enumerate(found) if art and weight[k]}
    begun: set[int] = set()
    for k, (_, _, bad, art) in enumerate(found):
        if weight[k]:
            begun.add(art)
        elif art and not bad and art in begun and k < last[art]:
            weight[k] = 1
    return weight


def stretches(weight: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """First line and end of each stretch of text: where the window sums are above nothing and surge over the page's threshold."""
    upto = [0]
    for w in weight:
        upto.append(upto[-1] + w)
    n = len(weight)
    sums = [upto[min(n, i + window)] - upto[i] for i in range(n)]
    threshold = min(surge, max(sums, default=0) / 4)
    out, start = [], 0
    while start < n:
        end, top = start, 0
        while end < n and sums[end]:
            top = max(top, sums[end])
            end += 1
        if top > threshold:
            out.append((start, end))
        start = end + 1
    return out


def extract(html: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text, blocks joined by line breaks; empty if there is none."""
    # what interrupts a named article doesn't part its lines
    found = [x for x in lines(html or "") if not (x[2] and x[3])]
    weight = weights(found)
    kept: list[str] = []
    for start, end in stretches(weight, window, surge):
        run: list[str] = []
        began = False
        for k in range(start, end):
            text, _, bad, _ = found[k]
            if weight[k]:
                if began and len(run) < LINK_RUN:
                    kept += run
                run, began = [], True
                kept.append(text)
            elif not bad:
                run.append(text)
    return "\n".join(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points): a row per row of pages.

    Null html counts as empty and gives an empty text; null urls and ids stay;
    repeated rows are alike; other columns are not read. Pages of any length are
    read whole, in time linear in it; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [extract(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
