"""Main text of HTML pages by scoring the element tree.

Each page is parsed on its own inside Arrow tasks (no shuffle): paragraphs pass points for their
length and commas to their ancestors, halved with each level; a container's points are discounted by
the share of its text that stands in links. The best container is kept (its article or main element,
if it is in one) with those siblings that score or read like it. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, hidden parts and reader comments are left out; a form or an
element with a class or id of such a part stays if it is a wrapper of the page: it holds most of the
paragraphs, and a main or h1 element or (three or more of them) all there are. A head ends at its end
tag, or at text or an element that can't stand in it.

Defined cases: null or empty html gives empty text; unclosed or crossed tags, cut pages and pages of
any length are parsed as far as they go; a page without any paragraph keeps its headings and other
blocks outside the parts named above; every row gives one row; extra columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import table

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|"
    r"<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?i)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe object svg math canvas audio video select textarea button "
                    "title head datalist map".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
RAW = frozenset("script style textarea title iframe noscript".split())
BOILERPLATE = frozenset("nav header footer aside form dialog menu fieldset".split())
BLOCKS = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
                   "caption blockquote pre figure figcaption address hgroup details summary hr center search".split()) | BOILERPLATE
#: An opening tag closes an open one of these, if no element of the second kind stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "a": ({"a"}, BLOCKS - {"p"})}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
# Words in class or id that name parts outside the article.
OUTSIDE = frozenset("ad ads adv advert banner comment comments reply replies respond disqus cookie cookies consent gdpr notice notices alert "
                    "newsletter subscribe subscription signup login share sharing social related recommended sidebar aside "
                    "widget menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead toolbar topbar popup "
                    "modal overlay sponsor sponsored promo promotion skip".split())
OUTSIDE_STEMS = ("advert", "comment", "sponsor", "cookie", "newsletter", "breadcrumb", "sidebar", "disqus", "recommend")
INSIDE = frozenset("with has no without".split())
#: Of those, words that an article may be about.
AMBIGUOUS = frozenset("share sharing menu login signup subscription promotion alert social".split())
#: With one of these, "header" is that of the article.
OF_ARTICLE = frozenset("post article entry story page content title headline chapter section".split())
#: Characters of a paragraph that tells a part to read from one to click.
PARAGRAPH = 80


class _Node:
    __slots__ = ("tag", "parent", "kids", "out", "doubt", "points", "chars", "linked", "heads")

    def __init__(self, tag, parent, out, doubt=0):
        self.tag, self.parent, self.out, self.doubt = tag, parent, out, doubt
        self.kids, self.points, self.chars, self.linked, self.heads = [], 0.0, 0, 0, 0


def _outside(tag: str, attrs: str, in_article: bool) -> tuple[bool, int]:
    """(outside the article, 2: outside unless the element turns out to be a wrapper of the page, 1: or
    to hold a paragraph of its own)."""
    if tag in BOILERPLATE and tag != "form" and not (tag == "header" and in_article):
        return True, 0
    doubt = 2 if tag == "form" else 0
    if not attrs or tag in ("html", "body", "article", "main"):
        return False, doubt
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, 0
        if name == "style" and re.search(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, 0
        if name == "role" and value.lower() in ROLES:
            return True, 0
        if name in ("class", "id"):
            for each in value.split():
                words = {w.lower() for w in _PART.findall(each)}
                if words & INSIDE:
                    continue
                if words & OUTSIDE - AMBIGUOUS or any(w.startswith(OUTSIDE_STEMS) for w in words):
                    doubt = 2
                elif "header" in words and not in_article and not words & OF_ARTICLE:
                    doubt = 2
                elif words & AMBIGUOUS:
                    doubt = max(doubt, 1 if in_article else 2)
    return False, doubt


def _parse(html: str) -> tuple[_Node, list]:
    """The tree, and its blocks of text in page order as (node, text, characters in links)."""
    root = _Node("root", None, False)
    blocks, text, linked = [], [], 0
    open_, at, links, articles = [root], 0, 0, 0
    n = len(html)

    def flush():
        nonlocal linked
        if text:
            t = " ".join(unescape("".join(text)).split())
            if t and not open_[-1].out:
                blocks.append((open_[-1], t, min(linked, len(t))))
            text.clear()
            linked = 0

    def close(i):
        nonlocal links, articles
        for x in open_[i:]:
            links -= x.tag == "a"
            articles -= x.tag in ("article", "main")
        del open_[i:]

    def find(tags, stops):
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in tags:
                return i
            if open_[i].tag in stops:
                return 0
        return 0

    while at < n:
        m = _MARKUP.search(html, at)
        if m is None or m.start() > at:
            piece = html[at:m.start() if m else n]
            if open_[-1].tag == "head" and piece.strip():
                close(len(open_) - 1)
            if not open_[-1].out:
                text.append(piece)
                linked += len(piece) if links else 0
        if m is None:
            break
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag, ending = tag.lower(), m["end"] or m["end2"]
        if tag in RAW and not ending:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = stop.end() if stop else n
            continue
        if tag == "br" or tag == "hr" and not ending:
            text.append(" ")
        if tag in BLOCKS:
            flush()
        if tag in VOID:
            continue
        if ending:
            i = find({tag}, () if tag in BLOCKS else BLOCKS)
            if i:
                if any(x.tag in BLOCKS for x in open_[i:]):
                    flush()
                close(i)
            continue
        if tag in BLOCKS:
            i = find({"p"}, BLOCKS - {"p"})
            if i:
                close(i)
        if tag in CLOSES:
            i = find(*CLOSES[tag])
            if i:
                if any(x.tag in BLOCKS for x in open_[i:]):
                    flush()
                close(i)
        if open_[-1].tag == "head" and tag not in IN_HEAD:
            close(len(open_) - 1)
        up = open_[-1]
        attrs = m["attrs"] or m["attrs2"] or ""
        if attrs.endswith("/") and tag not in BLOCKS:
            continue
        out, doubt = _outside(tag, attrs, articles > 0)
        node = _Node(tag, up, up.out or tag in SKIPPED or out, doubt)
        up.kids.append(node)
        open_.append(node)
        links += tag == "a"
        articles += tag in ("article", "main")
    flush()
    return root, blocks


def _ancestors(node):
    while node is not None:
        yield node
        node = node.parent


def _sure(blocks) -> list:
    """The blocks without those in doubtful elements that are no wrappers of the page."""
    if not any(x.doubt for b in blocks for x in _ancestors(b[0])):
        return blocks
    held, total, chains = {}, [0, 0], []
    for node, text, linked in blocks:
        chars = len(text) if node.tag not in HEADINGS and len(text) >= 25 and linked < 0.5 * len(text) else 0
        above = list(_ancestors(node))
        chains.append([x for x in above if x.doubt])
        total = [total[0] + chars, total[1] + (chars > 0)]
        marked = False
        for x in above:
            marked = marked or x.tag in ("main", "h1")
            if x.doubt:
                h = held.setdefault(id(x), [0, 0, False, False])
                h[0], h[1], h[2] = h[0] + chars, h[1] + (chars > 0), h[2] or marked
                h[3] = h[3] or x.doubt == 1 and chars >= PARAGRAPH
    wrapper = {k for k, (chars, n, marked, read) in held.items()
               if read or 2 * chars > total[0] and (marked or chars == total[0] and n >= 3)}
    return [b for b, chain in zip(blocks, chains) if all(id(x) in wrapper for x in chain)]


def _score(blocks) -> _Node | None:
    """Pass points up the tree; the container of most points after the discount for links."""
    seen = {}
    for node, text, linked in blocks:
        for x in _ancestors(node):
            x.chars += len(text)
            x.linked += linked
            x.heads += len(text) if node.tag in ("h1", "h2") else 0
        if node.tag in HEADINGS or len(text) < 25:
            continue
        points = (1 + text.count(",") + min(3.0, len(text) / 100)) * (1 - linked / len(text))
        holder = next(x for x in _ancestors(node) if x.tag in BLOCKS or x.tag == "root")
        first = holder if holder.tag not in ("p", "pre", "td", "blockquote", "li", "dd") else holder.parent
        for level, x in enumerate(_ancestors(first or holder)):
            x.points += points / 2 ** level
            seen[id(x)] = x
    best = max(seen.values(), key=lambda x: x.points * (1 - x.linked / max(1, x.chars)), default=None)
    if best is None:
        return None
    return next((x for x in _ancestors(best) if x.tag in ("article", "main")), best)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root, blocks = _parse(html)
    blocks = _sure(blocks)
    best = _score(blocks)
    if best is None:
        best = next((x for b in blocks for x in _ancestors(b[0]) if x.tag in ("article", "main")), root)
    kept = {id(best)}
    worth = best.points * (1 - best.linked / max(1, best.chars))
    whole = best.tag in ("article", "main")
    before = True
    for x in best.parent.kids if best.parent and best.tag not in ("article", "main", "body") else ():
        share = x.linked / max(1, x.chars)
        before = before and x is not best
        if before and 2 * x.heads >= x.chars > 0 and share < 0.5:  # the head of the container
            kept.add(id(x))
        if x.points * (1 - share) >= max(2.0, 0.2 * worth) or x.tag == "p" and share < 0.25 and x.chars >= 80 or x.tag in HEADINGS and share < 0.5:
            kept.add(id(x))
    out = []
    for node, text, _ in blocks:
        inside = False
        for x in _ancestors(node):
            if id(x) in kept:
                inside = True
                break
            # a list or box of links in a container that nothing marks as the article
            if not whole and x.tag in ("ul", "ol", "dl", "table", "div", "section") and x.linked > 0.8 * x.chars:
                break
        if inside:
            out.append(text)
    return "\n".join(out)


def _extract(batches):
    for b in batches:
        text = [main_text(h) for h in b.column("html").to_pylist()]
        rest = [c for c, name in zip(b.columns, b.schema.names) if name != "html"]
        names = [name for name in b.schema.names if name != "html"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                                         [*names, "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    p = pages.select("page_id", "url", "html")
    kinds = dict(p.dtypes)
    return p.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op10_html_text(spark, sf_dir):
    """One row per page: page_id, url, text, n_chars."""
    return extract(table(spark, sf_dir, "pages"))
