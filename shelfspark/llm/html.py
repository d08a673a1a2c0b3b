"""Main text of web pages by the distribution of text over blocks of lines.

Markup is stripped so that each block of a page is a line, and each border of a
container a line without text. A line weighs the characters that are neither in
links nor in a menu, header, footer, sidebar, notice, advert, form or comment.
Sums over sliding windows of lines surge where the main text begins and dive
to nothing where it ends; the text between is kept. An article or main element
draws those points itself: lines outside it weigh nothing, and any text inside
is a surge.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import segment

#: Lines in a window; a window surges at so many characters, or at a share of the page's largest where that is less.
WINDOW, SURGE, SHARE = 3, 80, 0.25
#: Stretches with less than this share of the largest one's weight are left out where no element marks the article.
LEAST = 0.2

_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
#: Their content is no text of the page.
_RAW = frozenset("script style noscript template title textarea svg iframe object canvas select button math".split())
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LINE = frozenset("address blockquote caption dd dt figcaption figure h1 h2 h3 h4 h5 h6 hr legend li option p pre summary td th tr label".split())
_CONTAINER = frozenset("article aside body center details dialog dir div dl fieldset footer form head header html main menu nav ol section table tbody tfoot thead ul".split())
_CHROME_TAGS = frozenset("nav header footer aside form dialog menu head".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login sidebar aside menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer bottombar comment comments commentlist "
    "respond reply replies disqus social share sharing related recommended recommendations widget toolbar pagination pager".split()
)
#: Of these, what an element that is itself an article can be.
_ASIDE_ARTICLES = frozenset("ad ads advert advertisement sponsored promo comment comments reply related recommended widget".split())
#: Names that say what is around or in an element, not what it is.
_STATES = frozenset("with without has no is".split())
_MAIN = frozenset(("article", "main"))
_NONE = 1 << 60


class _Line:
    __slots__ = ("chrome", "inside", "own", "text")

    def __init__(self, text: str, own: int, inside: bool):
        self.text, self.own, self.inside, self.chrome = text, own, inside, False  # own: characters that are no space and in no link


def _is_chrome(tag: str, attributes: str) -> bool:
    if tag in _CHROME_TAGS:
        return True
    if tag in ("body", "html", "main"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            if value.strip().lower() in _CHROME_ROLES:
                return True
        for words in ([w.lower() for w in _WORD.findall(name)] for name in value.split() if m[1].lower() != "role"):
            if words and words[0] not in _STATES and (_ASIDE_ARTICLES if tag == "article" else _CHROME_WORDS).intersection(words):
                return True
    return False


def lines_of(page: str) -> list[_Line]:
    """The page's blocks in order, with an empty line at each border of a container. One walk, whatever the nesting.

    An element that holds an article is no chrome, whatever its class, if no article of the page is in fewer such
    elements than those that it holds, and what is outside of it has not more text than the article.
    """
    lines: list[_Line] = []
    open_: list[tuple[str, int, bool, list[int]]] = []  # tag, first line, chrome, in how many of these the least enclosed article inside is
    names: Counter[str] = Counter()
    spans: dict[str, list[tuple[int, int]]] = {"chrome": [], "own header": []}
    doubtful: list[tuple[int, int, int]] = []
    pieces: list[str] = []
    linked = links = mains = chromes = 0
    least = _NONE
    tag = _TAG

    def end_line() -> None:
        nonlocal linked
        if text := " ".join("".join(pieces).split()):
            lines.append(_Line(text, max(0, len(text) - text.count(" ") - linked), mains > 0))
        pieces.clear()
        linked = 0

    def border() -> None:
        end_line()
        lines.append(_Line("", 0, mains > 0))

    def close(n: int) -> None:
        """All open elements from the ``n``th on."""
        nonlocal mains, chromes
        border()
        while len(open_) > n:
            name, first, chrome, holds = open_.pop()
            names[name] -= 1
            chromes -= chrome
            mains -= name in _MAIN and not chrome
            if chrome and holds[0] < _NONE:
                doubtful.append((first, len(lines), holds[0]))
            elif chrome:
                spans["own header" if name == "header" and mains else "chrome"].append((first, len(lines)))

    heads: set[int] = set()  # lines that are headings: those of an article's own header stay
    heading = 0
    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            start = n
        if start > at:
            text = unescape(page[at:start])
            pieces.append(text)
            if links:
                linked += len("".join(text.split()))
        if start == n:
            break
        at = start
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        after = page[at + 1 : at + 2]
        if after in ("!", "?") and after:
            end = page.find(">", at)
            at = n if end < 0 else end + 1
            continue
        m = tag.match(page, at)
        if m is None and tag is _TAG and after and (after.isalpha() or after == "/"):
            tag = _PLAIN  # quotes that never close: from here on a tag ends at the next bracket
            m = tag.match(page, at)
        if m is None:
            if after and after.isascii() and (after.isalpha() or after == "/"):
                end = page.find(">", at)
                at = n if end < 0 else end + 1  # no tag, as in "</ p>", or one that the page's end cuts off
            else:
                pieces.append("<")
                at += 1
            continue
        at = m.end()
        name, closing = m[2].lower(), bool(m[1])
        if name in _RAW:
            if not closing and not m[3].endswith("/"):
                end = _RAW_END[name].search(page, at)
                at = n if end is None else end.end()
            continue
        if name == "br":
            pieces.append(" ")
        elif name == "a":
            links = 0 if closing else 1
        elif name in _LINE:
            before = len(lines)
            end_line()
            if heading and len(lines) > before:
                heads.add(len(lines) - 1)
            heading = int(name[0] == "h" and name != "hr" and not closing)
        elif name in _CONTAINER:
            links = heading = 0
            if closing:
                close(next(k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name)) if names[name] else border()
                continue
            if name == "body" and names["head"]:
                close(next(k for k, x in enumerate(open_) if x[0] == "head"))
            border()
            chrome = _is_chrome(name, m[3])
            if name in _MAIN and not chrome:
                mains += 1
                least = min(least, chromes)
                for x in reversed(open_):
                    if x[3][0] <= chromes:
                        break
                    x[3][0] = chromes
            chromes += chrome
            names[name] += 1
            open_.append((name, len(lines), chrome, [_NONE]))
    border()
    close(0)
    _mark(lines, spans["chrome"] + [(a, b) for a, b, depth in doubtful if depth > least], frozenset())
    _mark(lines, spans["own header"], heads)
    around = [(a, b) for a, b, depth in doubtful if depth == least]
    if around:
        depth = _depths(len(lines), around)
        outside = sum(x.own for x, d in zip(lines, depth, strict=True) if not d and not x.chrome)
        if outside > sum(len(x.text) for x, d in zip(lines, depth, strict=True) if d and x.inside and not x.chrome):
            _mark(lines, around, frozenset())
    return lines


def _depths(n: int, spans: list[tuple[int, int]]) -> list[int]:
    """In how many of the spans each line is."""
    change = [0] * (n + 1)
    for a, b in spans:
        change[a] += 1
        change[b] -= 1
    return list(accumulate(change[:n]))


def _mark(lines: list[_Line], spans: list[tuple[int, int]], but: set[int] | frozenset[int]) -> None:
    for i, (x, depth) in enumerate(zip(lines, _depths(len(lines), spans), strict=True)):
        x.chrome |= depth > 0 and i not in but


def stretches(weights: list[int], surge: float) -> list[tuple[int, int]]:
    """``[surge, dive)`` over lines: from where the sum of a window comes to ``surge`` to where it is nothing."""
    n = len(weights)
    sums = [0] * (n + 1)
    now = 0
    for i in range(n - 1, -1, -1):
        now += weights[i] - (weights[i + WINDOW] if i + WINDOW < n else 0)
        sums[i] = now
    out, begin, i = [], None, 0
    while i <= n:
        if begin is None and i < n and sums[i] >= surge:
            begin = i
            while begin > 0 and sums[begin - 1] and weights[begin - 1]:  # text that leads up to the surge
                begin -= 1
        elif begin is not None and sums[i] == 0:
            out.append((begin, i))
            begin = None
        i += 1
    return out


def main_text(page: str | None) -> str:
    """The article's blocks joined by line feeds; empty if there is none. Null is empty."""
    if not page:
        return ""
    lines = [x for x in lines_of(page) if not x.chrome]
    marked = any(x.inside and x.text for x in lines)
    if marked:
        weights = [len(x.text) if x.inside else 0 for x in lines]
        kept = stretches(weights, 1)
    else:
        weights = [x.own for x in lines]
        most = max((sum(weights[i : i + WINDOW]) for i in range(len(weights))), default=0)
        kept = stretches(weights, max(1, min(SURGE, SHARE * most)))
        size = {s: sum(weights[s[0] : s[1]]) for s in kept}
        kept = [s for s in kept if size[s] >= LEAST * max(size.values())]
    return "\n".join(x.text for a, b in kept for x in lines[a:b] if x.text and (x.inside or not marked))


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, pages in segment.chunks(batch.column(2).to_pylist()):
            texts = [main_text(p) for p in pages]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(pages)), batch.column(1).slice(at, len(pages)), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=_SCHEMA)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: one row a page, read whole.

    Character references are decoded, white space in a block is one space, blocks are joined by a line feed; a null or
    empty page, and one without main text, has an empty text. Tags that never close, wrong nesting, comments and quotes
    left open end with the page. Repeated rows, equal and null ids have a row each. An empty table gives an empty
    result; other columns are not read. No shuffle.
    """
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
