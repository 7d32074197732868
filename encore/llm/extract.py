"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element, in page order. Containers that aren't text of
the page (menus, forms, scripts, adverts, comments) leave a gap of empty lines; lines that are
mostly links count as empty too. Over the lines, text lengths are summed in sliding windows. A
surge is where the sum rises to the threshold, a dive where a whole window is empty; the lines
between are kept. A page's mark of its article is evidence, not another way: lines outside count
as empty, so the first surge and the last dive lie within it, and inside any text is a surge.

Defined cases. A null, empty or text-free page has an empty text. A page none of whose windows
reaches the threshold is judged against its own largest sum, so short articles are kept. Unclosed
markup ends with what it stands in, or where HTML lets its end tag be left out, at the latest with
the page. Repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import map_batches, query, table

WINDOW = 3
THRESHOLD = 86
LINK_SHARE = 0.6

_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>"
    r"|</?[a-zA-Z][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|hidden|style|itemprop)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
#: Elements whose content is raw and never text of the page.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed"}
_RAW_END = {t: re.compile(rf"</{t}\s*[^>]*>|\Z", re.I) for t in _RAW}
#: Elements that hold no main text.
_ASIDE = {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu",
    "svg", "canvas", "object", "audio", "video", "map", "fieldset", "datalist", "label", "input",
}
_EMPTY = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "img", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr", "ruby", "rb", "rt", "rp",
}
#: Elements whose class or role may say what they hold, and those of them whose id doesn't: ids of
#: headings, paragraphs, items and cells are link targets made of words of the text.
_CONTAINERS = {
    "div", "header", "ul", "ol", "dl", "table", "details", "figure", "center", "section", "li", "dt",
    "dd", "thead", "tbody", "tfoot", "tr", "td", "th",
}
_ANCHORS = {"li", "dt", "dd", "thead", "tbody", "tfoot", "tr", "td", "th"}
#: Start tags that end an element without its end tag, if not in a list or table of its own.
_BLOCKS = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre",
    "section", "table", "ul",
}
_ROWS = {"tr", "tbody", "tfoot"}
_ENDED_BY = {
    "p": _BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": _ROWS,
    "td": {"td", "th"} | _ROWS, "th": {"td", "th"} | _ROWS,
}
_NESTS = ("ul", "ol", "menu", "dl", "table")
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|adsense|banner|sponsor(?:ed)?|promo(?:tion)?|menu|nav"
    r"|navbar|navigation|sidebar|side-?bar|footer|header|masthead|breadcrumbs?|cookies?|notices?"
    r"|consent|gdpr|popup|modal|overlay|newsletter|subscribe|subscription|share|sharing|social"
    r"|comments?|comment-?list|respond|disqus|related|recommended|widget|toolbar|login|signin|search"
    r"|pagination|pager|copyright|legal|disclaimer|alert|contentinfo|complementary|dialog)(?=$|[\s_-])",
    re.I,
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _skipped(name: str, attributes: str, in_article: bool) -> bool:
    if name in _ASIDE or name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "article", "main", "h1"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if name in _CONTAINERS and key in ("class", "id", "role") and (key != "id" or name not in _ANCHORS):
            # A section's id is made of its heading, unless it is no more than such a word.
            if (_HINT.fullmatch if name == "section" and key == "id" else _HINT.search)(value):
                return True
        if key == "hidden" or key == "style" and _HIDDEN.search(value):
            return True
    return False


class _Lines:
    """Lines of a page: (text, characters in links, inside the article, gap before)."""

    def __init__(self) -> None:
        self.out: list[tuple[str, int, bool]] = []
        self.parts: list[str] = []
        self.linked = 0

    def end(self, inside: bool) -> None:
        if self.parts:
            text = _SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            if text:
                self.out.append((text, self.linked, inside))
            self.parts, self.linked = [], 0

    def gap(self) -> None:
        self.out += [("", 0, False)] * WINDOW


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """The blocks outside skipped containers, in page order, with gaps of empty lines for those."""
    lines = _Lines()
    at, size = 0, len(page)
    article = links = 0
    skip, depth = "", 0
    around: list[str] = []  # open blocks, with their numbers by name; within: those in a skipped one
    opened, within = Counter(), Counter()
    while at < size:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else size]
        if text and not skip:
            lines.parts.append(text)
            if links:
                lines.linked += len(text.strip())
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closing, alone = bool(m[1]), bool(m[4]) or name in _EMPTY
        if name in _RAW and not closing:
            end = _RAW_END[name].search(page, at)
            at = end.end()
            continue
        if skip:
            nested = any(within[n] for n in _NESTS)
            if not closing and name in _ENDED_BY.get(skip, ()) and not nested:
                skip = ""  # its end tag was left out
            elif name == skip and skip in _ENDED_BY:
                if not nested:
                    skip = ""
                    continue
            elif name == skip and not alone:
                depth += -1 if closing else 1
                if depth == 0:
                    skip = ""
                    continue
            elif name in ("article", "main", "body") and not closing and not article:
                skip = ""  # it was never closed
            elif closing and not within[name] and opened[name]:
                skip = ""  # what it stands in ends
            elif not alone and name not in _INLINE:
                within[name] = max(0, within[name] + (-1 if closing else 1))
            if skip:
                continue
        if not closing and not alone and _skipped(name, m[3], article > 0):
            lines.end(article > 0)
            lines.gap()
            skip, depth = name, 1
            within.clear()
            continue
        if not alone and name not in _INLINE:
            if not closing:
                around.append(name)
                opened[name] += 1
            elif opened[name]:
                last = ""
                while last != name:
                    last = around.pop()
                    opened[last] -= 1
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name == "br":
            lines.parts.append(" ")
        elif name not in _INLINE:
            links = 0
            lines.end(article > 0)
            if name in ("article", "main"):
                article = max(0, article + (-1 if closing else 1))
    if not skip:
        lines.end(article > 0)
    return lines.out


def keep_lines(sizes: list[int], window: int = WINDOW, threshold: int = THRESHOLD) -> list[bool]:
    """Which lines lie between a surge and the dive after it."""
    n = len(sizes)
    sums = [sum(sizes[i : i + window]) for i in range(n)]
    least = min(threshold, max(sums, default=0))
    kept, on = [False] * n, False
    for i in range(n):
        if not on and sizes[i] and sums[i] >= least > 0:
            on = True
        if on and not sums[i]:
            on = False
        kept[i] = on
    # What leads up to a surge without an empty line between belongs to it.
    for i in range(n - 2, -1, -1):
        if kept[i + 1] and sizes[i]:
            kept[i] = True
    return kept


def main_text(page: str | None) -> str:
    """The page's main text: its kept blocks joined by one space."""
    lines = lines_of(page or "")
    inside = any(t and a for t, _, a in lines)
    sizes = [
        0 if not t or inside and not a or not inside and k > LINK_SHARE * len(t) else len(t)
        for t, k, a in lines
    ]
    kept = keep_lines(sizes, threshold=1 if inside else THRESHOLD)
    return " ".join(t for (t, _, _), size, ok in zip(lines, sizes, kept) if ok and size)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, url, text and its length of every row."""

    def run(batch):
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts,
                "n_chars": [len(t) for t in texts]}

    picked = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return map_batches(picked, run, "page_id bigint, url string, text string, n_chars bigint")


@query("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extract(table(spark, sf, "pages"))
