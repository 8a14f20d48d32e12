"""Main text of web pages by gradient-boosted trees over DOM nodes.

A tolerant reader builds the tree of block elements: broken and unclosed markup is repaired by the
usual rules (a new block ends a paragraph, a list item ends the one before, an end tag closes what
is open inside). Every node gets features of its subtree (text, words, links, density), its
attribute tokens and tag and those of its ancestors, its depth and its siblings. Boosted trees,
trained on a small labelled table of pages that is made from templates here, give each node the
log-odds of being part of the article. Decoding is hierarchical: bottom-up, a node is worth its
own log-odds plus what its kept children are worth, and it is kept only when that is positive and
its parent is kept, so no kept node has a dropped ancestor.

Scripts, styles, comments and markup never give text. Character references are decoded, white
space within a block becomes one space, blocks are joined by a line end in page order.

Defined results: NULL or empty html, and pages of boilerplate only, give an empty text of 0
characters. Cut-off pages give what was read. Repeated pages give equal texts.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
from pyspark.sql import DataFrame

from hardwood.llm.boosting import BoostedTrees
from hardwood.llm.common import map_rows

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|<[a-zA-Z/!?][^>]*+\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_ATTRIBUTE_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"\shidden(?:\s|=|/|\Z)|display\s*:\s*none", re.I)

#: Elements whose content is no text.
RAW = frozenset("script style noscript textarea iframe title xmp noembed noframes".split())
#: Elements that flow within a line: they make no node of their own.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr input button picture source link meta base col hr "
    # Media, drawings and formulas, with what they hold: their text flows on, whether they are closed or not.
    "object audio video canvas track param svg g defs symbol use text tspan textpath desc metadata switch path rect circle "
    "ellipse line polyline polygon image marker pattern mask clippath filter lineargradient radialgradient stop animate "
    "animatetransform animatemotion set math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom "
    "menclose mspace msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd semantics "
    "annotation annotation-xml maction".split()
)
#: What a choice may hold: any other block ends an unclosed one.
_CHOICE = frozenset("select optgroup option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_ITEM = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
              "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
              "tbody": ("tbody thead tr td th", "table"), "thead": ("tbody thead tr td th", "table")}
_ENDS_ITEM = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _ENDS_ITEM.items()}

#: Groups of attribute tokens and tags: what they speak of.
TOKEN_GROUPS = (
    "article articlebody content post entry story main body text prose",
    "nav navigation navbar menu breadcrumb breadcrumbs toc pagination pager tabs",
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner adsense dfp",
    "comment comments reply replies discussion disqus respond commentlist",
    "cookie cookies consent notice notices alert gdpr popup modal overlay warning toast message",
    "sidebar aside widget widgets related recommended recommendations complementary trending popular rail",
    "share sharing social follow likes bookmark",
    "footer copyright legal colophon contentinfo bottom",
    "header masthead logo branding topbar",
    "form search login signin signup subscribe newsletter register contact",
)
_GROUP = {word: i for i, words in enumerate(TOKEN_GROUPS) for word in words.split()}
_TAG_GROUP = {"article": 0, "main": 0, "nav": 1, "menu": 1, "aside": 5, "footer": 7, "header": 8, "form": 9, "fieldset": 9, "select": 9, "dialog": 4,
              "template": len(TOKEN_GROUPS)}  # not shown, as what is hidden
TAGS = ("p", "div", "section", "h", "li", "ul", "table", "td", "blockquote", "pre", "body", "html", "figure")
_TAG_NUMBER = {t: i + 1 for i, t in enumerate(TAGS)} | {f"h{i}": 4 for i in range(1, 7)} | {"ol": 6, "tr": 7, "th": 8}


class Page:
    """Block nodes in page order, and the runs of text between their borders."""

    __slots__ = ("parent", "depth", "tag", "own", "above", "chars", "words", "linked", "stops", "runs", "marked")

    def __init__(self, html: str | None):
        self.parent, self.depth, self.tag, self.own, self.above = [-1], [0], [0], [0], [0]
        self.chars, self.words, self.linked, self.stops, self.marked = [0], [0], [0], [0], [None]
        self.runs: list[tuple[int, str]] = []
        if html:
            self._read(html)

    def _read(self, html: str) -> None:
        stack, names, held, link, at = [0], ["#"], [], False, 0
        linked_here = 0

        def flush() -> None:
            nonlocal linked_here
            if held:
                text = " ".join(_html.unescape("".join(held)).split())
                held.clear()
                if text:
                    node = stack[-1]
                    self.runs.append((node, text))
                    self.chars[node] += len(text)
                    self.words[node] += text.count(" ") + 1
                    self.stops[node] += text.count(".") + text.count(",")
                    self.linked[node] += min(linked_here, len(text))
            linked_here = 0

        while match := _MARKUP.search(html, at):
            if match.start() > at:
                piece = html[at : match.start()]
                held.append(piece)
                if link:
                    linked_here += len(piece.strip())
            at = match.end()
            name = match[2] or match[5]
            if name is None:
                continue
            name, closing = name.lower(), match[1] or match[4]
            if name in INLINE:
                if name == "a":
                    link = not closing
                elif name in ("br", "hr", "text", "mtd"):
                    held.append(" ")
                continue
            attributes = match[3] or match[6] or ""
            if name in RAW:
                if not closing and not attributes.endswith("/"):
                    end = re.compile(f"</{name}", re.I).search(html, at)
                    at = end.start() if end else len(html)
                continue
            flush()
            link = False
            if closing:
                if name in names:
                    while names[-1] != name:
                        names.pop(), stack.pop()
                    names.pop(), stack.pop()
                continue
            if name in VOID:
                continue
            if name not in _CHOICE:
                while names[-1] in _CHOICE:
                    names.pop(), stack.pop()
                if names[-1] == "p":
                    names.pop(), stack.pop()
            if name in _ENDS_ITEM:
                ended, scope = _ENDS_ITEM[name]
                for i in range(len(names) - 1, 0, -1):
                    if names[i] in scope:
                        break
                    if names[i] in ended:
                        del names[i:], stack[i:]
            self._open(name, attributes, stack[-1])
            stack.append(len(self.parent) - 1)
            names.append(name)
        held.append(html[at:])
        flush()

    def _open(self, name: str, attributes: str, parent: int) -> None:
        own = 1 << _TAG_GROUP[name] if name in _TAG_GROUP else 0
        if attributes:
            for value in _ATTRIBUTE.findall(attributes):
                for word in _ATTRIBUTE_WORD.findall(value.lower()):
                    if word in _GROUP:
                        own |= 1 << _GROUP[word]
            if _HIDDEN.search(attributes):
                own |= 1 << len(TOKEN_GROUPS)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tag.append(_TAG_NUMBER.get(name, 0))
        self.own.append(own)
        self.above.append(self.above[parent] | self.own[parent])
        self.marked.append(attributes[-1] if attributes[-12:-1] == " data-keep=" else None)
        for values in (self.chars, self.words, self.linked, self.stops):
            values.append(0)


def _features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the nodes of all pages, each node's parent, and where each page starts."""
    counts = np.array([len(p.parent) for p in pages])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    gather = lambda name: np.array([v for p in pages for v in getattr(p, name)], float)
    parent = gather("parent").astype(np.int64) + np.repeat(starts, counts)
    roots = starts
    parent[roots] = roots
    n = len(parent)
    depth, chars, words, linked, stops = map(gather, ("depth", "chars", "words", "linked", "stops"))
    own, above, tag = (gather(x).astype(np.int64) for x in ("own", "above", "tag"))
    sub = np.stack([chars, words, linked, stops, np.ones(n)])
    order = np.argsort(-depth, kind="stable")
    levels = np.flatnonzero(np.diff(depth[order])) + 1
    for rows in np.split(order, levels):
        rows = rows[parent[rows] != rows]
        for measure in sub:
            np.add.at(measure, parent[rows], measure[rows])
    child = parent != np.arange(n)
    children = np.bincount(parent[child], minlength=n)
    # Place among the siblings, in page order.
    by_parent = np.argsort(np.where(child, parent, -1), kind="stable")
    ordered = np.where(child, parent, -1)[by_parent]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    place = np.empty(n)
    place[by_parent] = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    before = np.zeros(n)
    before[by_parent[1:]] = np.where(new[1:], 0, sub[0][by_parent[:-1]])
    page = np.repeat(roots, counts)
    whole = np.maximum(sub[0][page], 1)
    siblings = np.maximum(children[parent], 1)
    columns = [
        np.log1p(chars), np.log1p(sub[0]), np.log1p(sub[1]), sub[2] / np.maximum(sub[0], 1),
        sub[3] / np.maximum(sub[1], 1), sub[0] / sub[4], sub[0] / whole, depth, np.minimum(children, 20),
        place / siblings, np.minimum(siblings, 20), np.log1p(sub[0][parent] / siblings), np.log1p(before),
        sub[2][parent] / np.maximum(sub[0][parent], 1), tag,
    ]
    columns += [(own >> i) & 1 for i in range(len(TOKEN_GROUPS) + 1)]
    columns += [(above >> i) & 1 for i in range(len(TOKEN_GROUPS) + 1)]
    columns += [(tag == i).astype(float) for i in (1, 4, 5, 6)]
    return np.stack(columns, axis=1).astype(float), parent, starts


# ---- the labelled table

_SYLLABLES = "ar be con der el fin gra hi in jo ka lum mer no ort pre qui ra sto tion und ver wel zu".split()


def labelled_pages(count: int = 800, seed: int = 23) -> list[str]:
    """Small training table: pages whose blocks say by data-keep whether they are article text."""
    rng = np.random.default_rng(seed)
    pick = lambda items: items[int(rng.integers(len(items)))]
    word = lambda: "".join(pick(_SYLLABLES) for _ in range(rng.integers(1, 4)))

    def text(low: int, high: int) -> str:
        size = int(rng.integers(low, high))
        return " ".join(word() + (pick([",", ".", ".", ""]) if rng.random() < 0.2 else "") for _ in range(size)) + pick([".", "", "."])

    def marked(tag: str, attributes: str, inner: str, keep: int) -> str:
        return f"<{tag} {attributes} data-keep={keep}>{inner}</{tag}>"

    links = lambda n: "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(n))

    def junk(kind: str) -> str:
        some = {
            "nav": [("nav", ""), ("div", 'class="menu"'), ("ul", 'id="navbar"'), ("div", 'class="breadcrumb"')],
            "ad": [("div", 'class="ad"'), ("div", 'class="advert box"'), ("section", 'id="sponsored"'), ("aside", 'class="promo"')],
            "comments": [("section", 'id="comments"'), ("div", 'class="comment-list"'), ("ol", 'class="commentlist"')],
            "notice": [("div", 'class="cookie-notice"'), ("div", 'id="consent"'), ("div", 'role="alert"'), ("p", 'class="notice"')],
            "side": [("aside", ""), ("div", 'class="sidebar"'), ("div", 'class="widget related"')],
            "share": [("div", 'class="share"'), ("div", 'class="sharing"'), ("ul", 'class="social-links"')],
            "footer": [("footer", ""), ("div", 'class="footer"'), ("div", 'id="copyright"')],
            "header": [("header", ""), ("div", 'id="masthead"'), ("div", 'class="header"')],
            "form": [("form", ""), ("div", 'class="newsletter"'), ("form", 'class="search"')],
        }[kind]
        tag, attributes = pick(some)
        if kind in ("nav", "share"):
            inner = links(rng.integers(1, 9)) if tag == "ul" or rng.random() < (0.7 if kind == "nav" else 0.3) else text(1, 12)
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind in ("comments", "side"):
            inner = "".join(f"<p>{text(3, 50)}</p>" for _ in range(rng.integers(1, 5)))
        elif kind == "form":
            inner = f"<p>{text(2, 10)}</p><input><button>{word()}</button>"
        else:
            inner = pick(["{}", "<p>{}</p>", "<div>{}</div>"]).format(("&copy; " if kind == "footer" else "") + text(2, 40))
        return marked(tag, attributes, inner, 0)

    def article() -> str:
        body = [f"<h1>{text(2, 10)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.integers(1, 12)):
            kind = rng.random()
            if kind < 0.58:
                body.append(f"<p>{text(1, 90)}</p>")
            elif kind < 0.65:
                body.append(f"<h2>{text(1, 7)}</h2>")
            elif kind < 0.78:
                kind, most = pick(["ul", "ol"]), pick([2, 6, 25])
                body.append(f"<{kind}>" + "".join(f"<li>{text(1, most)}</li>" for _ in range(rng.integers(1, 7))) + f"</{kind}>")
            elif kind < 0.82:
                body.append(f"<blockquote><p>{text(5, 40)}</p></blockquote>")
            elif kind < 0.85:
                body.append(f"<p>{text(5, 30)} <a href=x>{text(1, 5)}</a> {text(3, 20)}</p>")
            else:
                body.append(junk(pick(["ad", "share", "side", "notice", "form", "nav"])))
        if rng.random() < 0.3:
            body.append(junk(pick(["comments", "share", "footer"])))
        tag, attributes = pick(
            [("article", ""), ("article", 'class="post"'), ("article", ""), ("main", ""), ("main", 'id="content"'), ("div", 'class="entry-content"'),
             ("div", 'id="article-text"'), ("div", 'class="story"'), ("section", 'itemprop="articleBody"'), ("div", ""), ("div", 'class="wrap"')]
        )
        whole = marked(tag, attributes, "".join(body), 1)
        return whole if rng.random() < 0.7 else f'<div class="{pick(["page", "container", "layout"])}">{whole}</div>'

    pages = []
    for _ in range(count):
        top = [junk(k) for k in ("header", "nav", "notice", "ad", "form") if rng.random() < 0.5]
        low = [junk(k) for k in ("side", "comments", "ad", "share", "form", "footer") if rng.random() < 0.45]
        pages.append(f"<html><head><title>{text(1, 8)}</title></head><body>{''.join(top)}{article()}{''.join(low)}</body></html>")
    return pages


def _gold(page: Page) -> np.ndarray:
    """1 where a node is, or holds, article text."""
    inside = []
    for node, parent in enumerate(page.parent):
        mark = page.marked[node]
        inside.append(int(mark) if mark is not None else (inside[parent] if node else 0))
    gold = np.array(inside, float)
    for node in range(len(gold) - 1, 0, -1):
        if gold[node]:
            gold[page.parent[node]] = 1
    return gold


def train(rows: list[str] | None = None) -> BoostedTrees:
    pages = [Page(html) for html in (labelled_pages() if rows is None else rows)]
    return BoostedTrees().fit(_features(pages)[0], np.concatenate([_gold(p) for p in pages]))


def decoded(margin: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Which nodes are kept: no kept node has a dropped ancestor. A root is its own parent."""
    worth, up = margin.tolist(), parent.tolist()
    for node in range(len(worth) - 1, -1, -1):
        if up[node] != node and worth[node] > 0:
            worth[up[node]] += worth[node]
    keep = [False] * len(worth)
    for node, (value, above) in enumerate(zip(worth, up, strict=True)):
        keep[node] = above == node or (keep[above] and value > 0)
    return np.array(keep)


def main_texts(htmls: list[str | None], model: BoostedTrees) -> list[str]:
    pages = [Page(html) for html in htmls]
    features, parent, starts = _features(pages)
    margin = model.margin(features)
    keep = decoded(margin, parent)
    # Text that stands in no element but the root is judged by the root's own log-odds.
    keep[starts] = margin[starts] > 0
    return [
        "\n".join(text for node, text in page.runs if keep[start + node])
        for page, start in zip(pages, starts, strict=True)
    ]


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Append text and n_chars (code points) to every page."""
    shared, at = pages.sparkSession.sparkContext.broadcast(train()), pages.columns.index(html)

    def make():
        model = shared.value

        def compute(part):
            texts = main_texts(part.column(at).to_pylist(), model)
            return texts, [len(t) for t in texts]

        return compute

    return map_rows(pages, make, "text string, n_chars long", keep=[c for c in pages.columns if c != html])
