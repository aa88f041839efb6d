"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines: one line a block of the page, with character
references decoded and white space as one space. A line weighs its characters;
it weighs nothing where it is structure and not article: scripts, styles,
menus, page headers and footers, sidebars, forms, adverts, notices and reader
comments, by element or by a whole token of its class or id, and, if the page has
an article or main element that is not itself such structure and holds text, all
that is outside of it. Classes of html, body, main and article are not looked
at (an article that is a comment or a reply is structure). The block value of line
i is the sum of the weights of lines i .. i + WINDOW - 1. Text dives where a
whole block weighs nothing; between two dives it is kept, if some block there
surges to at least ``SURGE`` characters. Lines that are mostly link text weigh
nothing, but for headings of an article. What is out inside of an article is no
line of it, so an advert does not cut its text. If no block of the page
surges, all weighing lines are kept; if blocks surge, but none of the article,
the article says nothing about the page. A lone link line of an article, between
two lines of it that are text, is a paragraph and weighs. Outside of an article a
hyphenated class counts by its last part (main-nav, not no-sidebar).

Defined cases: null or empty html gives the empty text; a page that breaks off
inside a tag ends before that tag; from a tag on whose quotes do not end before the page does,
tags end at the next >; unclosed elements end with the page or with an element around them. The
time grows with the page's length, open quotes and unclosed elements included."""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import words

WINDOW = 3
SURGE = 40
LINKS = 0.6

#: Names of elements and the words of classes and ids.
RAW = {"script", "style", "textarea", "xmp", "noembed", "noframes", "iframe", "title", "template"}
OUT = {"head", "nav", "header", "footer", "aside", "form", "noscript", "svg", "math", "select", "button", "menu", "dialog",
       "object", "audio", "video", "canvas", "map", "fieldset", "datalist"}
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "img"}
CLASSES = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
           "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "sidebar", "aside", "widget", "related",
           "footer", "masthead", "topbar", "toolbar", "cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "overlay",
           "newsletter", "subscribe", "login", "signup", "share", "sharing", "social", "comment", "comments", "reply", "replies",
           "disqus", "discussion", "copyright", "legal"}
HEADER = {"header", "head"}
UNTESTED = {"html", "body", "main", "article"}
READERS = {"comment", "reply"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

#: First parts of a class such as no-sidebar that say what a page has, not what an element is.
STATES = {"no", "not", "has", "have", "with", "without", "is", "show", "hide", "enable", "disable"}
#: Names that are text in an article, and page furniture elsewhere.
SECTIONS = {"discussion", "legal"}

_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_TAG = re.compile(r"""<!--.*?(?:-->|$)|<([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|</([a-zA-Z][^\s>]*)[^>]*>|<[!?/][^>]*>""", re.S)
_PLAIN = re.compile(r"<([a-zA-Z][^\s/>]*)([^>]*)()>", re.S)      # where quotes do not end before the page does
_RAW_END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
_BROKEN = re.compile(r"<[a-zA-Z/!][^>]*$")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)


def _is_out(name: str, attributes: str, inside_article: bool) -> bool:
    if name in OUT and not (name == "header" and inside_article):
        return True
    if not attributes:
        return False
    if name == "html" or name == "body":
        return False
    for m in _NAMED.finditer(attributes):
        found = set((m.group(1) or m.group(2) or m.group(3) or "").lower().split())
        if name in UNTESTED:
            if name == "article" and found & READERS:
                return True
        elif inside_article:
            if found & CLASSES - SECTIONS:
                return True
        elif found & (CLASSES | HEADER) or any(_names_structure(x) for x in found):
            return True
    return bool(_HIDDEN.search(attributes))


def _names_structure(token: str) -> bool:
    """Whether a hyphenated class ends in a name of structure: main-nav, cookie_banner, but not no-sidebar."""
    parts = re.split("[-_]+", token)
    return len(parts) > 1 and parts[-1] in CLASSES and parts[0] not in STATES


def lines(page: str) -> tuple[list[tuple[str, bool, bool, int]], bool]:
    """(text, out, in an article, link characters) of each block, and whether
    the page has an article element that is not out."""
    found, parts = [], []
    stack: list[tuple[str, bool]] = []          # open elements: name, leaves the article
    out, article, link, linked, heading, has_article = 0, 0, 0, 0, 0, False
    count: dict[str, int] = {}                  # open elements by name
    at, quotes = 0, True

    def end_line():
        nonlocal parts, linked
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            if text:
                found.append((text, out > 0, article > 0, linked))
            parts = []
        linked = 0

    def close(index):
        nonlocal out, article, link, heading
        for name, is_out in stack[index:]:
            count[name] -= 1
            out -= is_out
            article -= name in ARTICLE
            link -= name == "a"
            heading -= name in HEADINGS
        del stack[index:]

    def text(piece):
        nonlocal linked
        if piece:
            parts.append(piece)
            if link and not (heading and article):
                linked += len(piece)

    while True:
        start = _OPEN.search(page, at)
        if start is None:
            text(page[at:])
            break
        m = _TAG.match(page, start.start()) if quotes else None
        if m is None:
            m = _PLAIN.match(page, start.start()) or _TAG.match(page, start.start())
            if m is not None and m.group(1):
                quotes = False      # a quote stays open to the end of the page: from here on, > ends a tag
        if m is None:
            text(_BROKEN.sub("", page[at:]))
            break
        text(page[at:m.start()])
        at = m.end()
        if m.group(1):
            name, attributes = m.group(1).lower(), m.group(2)
            if name in RAW:
                end = _RAW_END[name].search(page, at)
                at = page.find(">", end.end()) + 1 or len(page) if end else len(page)
                continue
            if name in INLINE:
                is_out = _is_out(name, attributes, article > 0) if attributes else False
                if (is_out or name == "a") and name not in VOID and not attributes.rstrip().endswith("/"):
                    if is_out:
                        end_line()
                    stack.append((name, is_out))
                    count[name] = count.get(name, 0) + 1
                    out += is_out
                    link += name == "a"
                continue
            end_line()
            if name in VOID or attributes.rstrip().endswith("/"):
                continue
            if count.get(name) and name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                # these end an open one of their kind that no other block is around
                for index in range(len(stack) - 1, -1, -1):
                    if stack[index][0] == name:
                        close(index)
                        break
                    if stack[index][0] not in ("a", "span") and stack[index][0] not in INLINE:
                        break
            is_out = _is_out(name, attributes, article > 0)
            stack.append((name, is_out))
            count[name] = count.get(name, 0) + 1
            out += is_out
            heading += name in HEADINGS
            if name in ARTICLE:
                article += 1
                has_article = has_article or out == 0
        elif m.group(3):
            name = m.group(3).lower()
            if name not in INLINE:
                end_line()
            for index in range(len(stack) - 1, -1, -1) if count.get(name) else ():
                if stack[index][0] == name:
                    if name in INLINE and stack[index][1]:
                        end_line()
                    close(index)
                    break
                if name in INLINE and stack[index][0] not in INLINE:
                    break
    end_line()
    return found, has_article


def _block_sums(weight: list[int], window: int) -> list[int]:
    sums, total = [], 0
    for i in range(len(weight) - 1, -1, -1):
        total += weight[i] - (weight[i + window] if i + window < len(weight) else 0)
        sums.append(total)
    sums.reverse()
    return sums


def linked_line(line: tuple[str, bool, bool, int]) -> bool:
    """Whether a line is mostly link text."""
    return line[3] > LINKS * len(line[0])


def kept(found: list[tuple[str, bool, bool, int]], has_article: bool, window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The weighing lines between dives that have a surge between them."""
    texts = [t for t, _, _, _ in found]
    link = [linked_line(x) for x in found]
    here = [i for i, (_, out, _, _) in enumerate(found) if not out]
    for before, i, after in zip([None, *here], here, [*here[1:], None]):
        # between two lines of an article that are text, a lone link is one of its paragraphs
        if link[i] and found[i][2] and all(j is not None and found[j][2] and not linked_line(found[j]) for j in (before, after)):
            link[i] = False
    weight = [0 if out or link[i] else len(t) for i, (t, out, _, _) in enumerate(found)]
    sums = _block_sums(weight, window)
    if has_article:
        own = [i for i, (_, out, inside, _) in enumerate(found) if not (out and inside)]
        inner = [weight[i] if found[i][2] else 0 for i in own]
        inner_sums = _block_sums(inner, window)
        if any(inner) and (max(inner_sums) >= surge or max(sums) < surge):
            texts, weight, sums = [texts[i] for i in own], inner, inner_sums
    if max(sums, default=0) < surge:
        return [t for t, w in zip(texts, weight) if w]      # a page too short to surge
    out, start, surges = [], 0, False
    for i, value in enumerate([*sums, 0]):
        if value:
            surges = surges or value >= surge
        else:
            if surges:
                out += [t for t, w in zip(texts[start:i], weight[start:i]) if w]
            start, surges = i, False
    return out


def main_text(page: str | None) -> str:
    return " ".join(kept(*lines(page))) if page else ""


def _extracted(batches):
    for batch in batches:
        texts = [main_text(x) for x in batch.column("__html").to_pylist()]
        out = batch.drop_columns(["__html"])
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(texts, pa.string())], [*out.schema.names, "__main"])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with a column ``__main``, the main text of each row."""
    words.small_batches(pages.sparkSession)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields] + ["__main string"])
    return pages.withColumn("__html", F.col(html_col)).mapInArrow(_extracted, schema)
