"""Main text of web pages by minimum-cut labelling.

A page is read once into text blocks: the runs of text between block-level tags, each
with the path of its enclosing elements.  Consecutive blocks under the same path form
one node.  A linear classifier over tag names, class and id words, link share and length
gives each node a cost for being content and a cost for being boilerplate: its
capacities from the source and to the sink.  Smoothness edges join nodes that follow
each other and nodes that share an enclosing element, stronger the deeper that element
is.  The maximum flow's minimum cut parts content from boilerplate.

Names speak against an element (a class such as "sidebar"), but not against one that holds
the page's prose.  Attributes are read one after the other as a browser does, so a name in
another attribute's value says nothing.

Scripts, styles, controls, comments of the markup and other parts without prose never
become blocks.  Those without an end tag end where an element around them does or the
next flow element begins; a script or style goes on to the end of the page, as in a
browser.  A form goes through the cut at a cost, unless it holds the page's prose.  Character references are decoded, white space inside a block becomes
one space, and content blocks are joined by one space in page order.

Defined cases: null or empty html, and html without content blocks, give an empty text;
unclosed and stray tags are tolerated; text outside any element is a block of its own;
repeated rows are extracted each; other columns are ignored; an empty table gives no
rows.  Pages are read whole; a page of n nodes has at most 3 n edges.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Their whole content is left out.
SKIPPED = frozenset("script style noscript template iframe object embed svg math canvas audio video title "
                    "select option datalist button textarea input".split())
#: Their content is not markup.
_RAW = frozenset("script style textarea title iframe".split())
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.IGNORECASE | re.ASCII) for t in _RAW}
#: Fragments of their own: end tags inside them close nothing around them.
_OPAQUE = frozenset("noscript template svg math".split())
#: A start tag ends one that is still open.
_SINGLE = frozenset("button select option".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s "
                    "samp small span strike strong sub sup time tt u var wbr".split())
_CLOSES_P = frozenset("p div section article aside header footer nav main ul ol dl table h1 h2 h3 h4 h5 h6 pre "
                      "blockquote form figure hr address details fieldset menu".split())
#: Where an element that is left out has no end tag, it ends here at the latest.
_FLOW = _CLOSES_P | frozenset("body li dt dd tr td th".split())
_SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                 "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
          "td": {"table", "tr"}, "th": {"table", "tr"}, "p": {"article", "section", "div", "main", "body", "td", "li",
                                                              "aside", "header", "footer", "nav", "blockquote"}}
_TAG_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_COMMENT_END = re.compile(r"--!?>")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE_NAME = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE_VALUE = re.compile(r"[^\s>]*")
_NAME_WORD = re.compile(r"[a-z]+")

# Weights of the classifier: the cost difference (positive: boilerplate) each sign adds.
TAG_COST = {"nav": 8.0, "footer": 8.0, "aside": 8.0, "header": 5.0, "menu": 6.0, "dialog": 6.0, "address": 1.0,
            "article": -6.0, "main": -4.0, "p": -0.5, "blockquote": -0.5, "pre": -0.5, "h1": -0.5, "li": 0.3}
BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promotion promoted banner banners nav "
    "navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs sidebar sidebars side rail widget widgets "
    "footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe subscription signup login signin register share sharing social related "
    "recommended recommendations comment comments commentlist disqus respond reply replies reactions pagination pager tags taglist "
    "copyright legal disclaimer skip search form teaser teasers outbrain taboola trending popular".split())
GOOD_NAMES = frozenset("article content main body post entry story text prose page".split())
NAME_BAD, NAME_GOOD = 7.0, -2.0
ROLE_COST = {"navigation": 8.0, "banner": 6.0, "contentinfo": 8.0, "complementary": 8.0, "search": 8.0, "form": 8.0,
             "dialog": 8.0, "alert": 6.0, "main": -4.0, "article": -4.0}
HIDDEN = 12.0
FORM_COST = 8.0       # of a form, unless it holds at least FORM_SHARE of the page's prose, with an article,
FORM_SHARE = 0.5      # a main element or a block of LONG characters in it
NAME_SHARE = 0.5      # names do not speak against an article or main element with this share of the prose,
WRAP_SHARE = 0.9      # nor against another element with this one, around an article or main element
LINK_COST = 4.0       # times the share of the text that is link text
SHORT_COST = 1.5      # times the shortfall of a node below SHORT characters
SHORT = 80
MIDDLE_GAIN = -0.8    # from SHORT characters on
LONG_GAIN = -1.5      # from LONG characters on
LONG = 240
BIAS = 0.2
NEXT_EDGE = 0.4       # smoothness of nodes that follow each other
SHARED_EDGE = 0.5     # and, times the share of the path they have in common, of nodes in one element


def _attribute_cost(tag: str, attributes: dict[str, str]) -> tuple[float, float]:
    """(cost, cost without what its names say against it) of an element."""
    cost = TAG_COST.get(tag, 0.0)
    if tag in ("html", "body") or not attributes:
        return cost, cost
    hidden = bad = good = 0.0
    for name, value in attributes.items():
        value = value.lower() if name == "role" else value
        if name in ("class", "id", "aria-label"):
            found = set(_NAME_WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))
            if found & GOOD_NAMES and name == "class" and found & BAD_NAMES:
                continue  # a layout wrapper such as "content has-sidebar"
            if found & BAD_NAMES:
                bad = NAME_BAD
            elif found & GOOD_NAMES:
                good = NAME_GOOD
        elif name == "role":
            cost += ROLE_COST.get(value.strip(), 0.0)
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            hidden = HIDDEN
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            hidden = HIDDEN
    plain = max(cost, 0.0) + hidden if hidden else cost + good
    return (max(cost, 0.0) + max(bad, hidden) if bad else plain), plain


class Block:
    """Text under a path of open elements: (serial number, cost) of each."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path, text, linked):
        self.path, self.text, self.linked = path, text, linked


class Tag:
    """The attributes of a start tag, by lower-case name, and whether it closes itself."""

    __slots__ = ("attributes", "closed")

    def __init__(self, attributes=None, closed=False):
        self.attributes, self.closed = attributes or {}, closed


_NO_TAG = Tag()


class Reader:
    """Finds tags and comments.  Places from which no tag end can be reached are remembered,
    so a page full of signs that open nothing is still read in linear time."""

    def __init__(self, html: str):
        self.html, self.n = html, len(html)
        self.last = {c: html.rfind(c) for c in "\"'>"}
        self.dead: set[int] = set()

    def tag(self, at: int) -> tuple[int, Tag] | None:
        """(end, attributes) of a tag whose name ends at ``at``; None where no sign ends it."""
        html, attributes, seen = self.html, {}, []
        while True:
            gap = _GAP.match(html, at)
            slash = gap.end() > at and html[gap.end() - 1] == "/"
            at = gap.end()
            if at >= self.n or at > self.last[">"] or at in self.dead:
                self.dead.update(seen)
                return None
            if html[at] == ">":
                return at + 1, Tag(attributes, slash)
            seen.append(at)
            name = _ATTRIBUTE_NAME.match(html, at)
            at, value = name.end(), ""
            if equals := _EQUALS.match(html, at):
                at = equals.end()
                quote = html[at:at + 1]
                if quote and quote in "\"'" and at < self.last[quote]:
                    end = html.index(quote, at + 1)
                    value, at = html[at + 1:end], end + 1
                else:
                    bare = _BARE_VALUE.match(html, at)
                    value, at = bare.group(), bare.end()
            attributes.setdefault(name.group().lower(), unescape(value) if "&" in value else value)

    def skip(self, at: int) -> int | None:
        """The end of a comment or declaration that begins at ``at``; None where none does."""
        html = self.html
        if html.startswith("<!--", at):
            for short in (">", "->"):
                if html.startswith(short, at + 4):
                    return at + 4 + len(short)
            end = _COMMENT_END.search(html, at + 4)
            return end.end() if end else self.n
        if html.startswith(("<!", "<?"), at):
            end = html.find(">", at)
            return end + 1 if end >= 0 else self.n
        return None


def _tokens(html: str) -> list[tuple[int, int, str | None, bool, Tag]]:
    """(start, stop, tag, closing, attributes) in page order; the tag is "<" for a bare
    sign and None for comments.  A raw element is one token up to the end of its end tag;
    without one, scripts and styles go to the end of the page, others to the next sign."""
    out, at, n = [], 0, len(html)
    reader, endless = Reader(html), set()
    while (start := html.find("<", at)) >= 0:
        end = reader.skip(start)
        if end is not None:
            out.append((start, end, None, False, _NO_TAG))
            at = end
            continue
        closing = html.startswith("/", start + 1)
        name = _TAG_NAME.match(html, start + 1 + closing)
        found = reader.tag(name.end()) if name else None
        if not found:
            out.append((start, start + 1, "<", False, _NO_TAG))
            at = start + 1
            continue
        tag, (at, raw) = name.group().lower(), found
        if tag in _RAW and not closing and not raw.closed:
            end = None if tag in endless else _RAW_END[tag].search(html, at)
            if end:
                gt = html.find(">", end.end())
                at = n if gt < 0 else gt + 1
            else:
                endless.add(tag)
                sign = -1 if tag in ("script", "style") else html.find("<", at)
                at = n if sign < 0 else sign
        out.append((start, at, tag, closing, raw))
    return out


def _ends(tokens) -> dict[int, tuple[int, bool]]:
    """Start token of each element that is left out, and of each form -> (the token it
    ends at, whether that is its own end tag)."""
    ends: dict[int, tuple[int, bool]] = {}
    opened: dict[str, list[int]] = {}
    if not any(t[2] in SKIPPED or t[2] == "form" for t in tokens):
        return ends
    for k, (_, _, tag, closing, raw) in enumerate(tokens):
        if tag in _OPAQUE:
            if not closing and not raw.closed:
                opened.setdefault(tag, []).append(k)
            elif closing and opened.get(tag):
                ends[opened[tag].pop()] = k, True
    stack: list[tuple[str, int]] = []
    depth: dict[str, int] = {}
    flow, loose = [], []

    def pop(k, own=False):
        tag, i = stack.pop()
        depth[tag] -= 1
        if tag in SKIPPED or tag == "form":
            ends[i] = k, own
            if not own:
                loose.append(i)

    k = 0
    while k < len(tokens):
        _, _, tag, closing, raw = tokens[k]
        if k in ends:
            k = ends[k][0] + 1
            continue
        if tag is None or tag == "<" or tag in _VOID or tag in _INLINE or tag in _RAW:
            pass
        elif closing:
            if depth.get(tag):
                while stack[-1][0] != tag:
                    pop(k)
                pop(k, True)
        else:
            if tag in _FLOW:
                flow.append(k)
            if tag in _CLOSES_P and stack and stack[-1][0] == "p":
                pop(k)
            if tag in _SINGLE and depth.get(tag):
                while stack[-1][0] != tag:
                    pop(k)
                pop(k)
            if not (raw.closed and tag not in ("p", "div")) and not (tag == "form" and depth.get(tag)):
                stack.append((tag, k))
                depth[tag] = depth.get(tag, 0) + 1
        k += 1
    while stack:
        pop(len(tokens))
    for i in loose:
        at = bisect_right(flow, i)
        if at < len(flow) and tokens[i][2] != "form":
            ends[i] = min(ends[i][0], flow[at]), False
    return ends


def _reprice(blocks: list[Block], forms: dict[int, bool], named: dict[int, tuple[str, float]], main: dict[int, bool]) -> None:
    """Give the forms (serial number -> holds an article or main element) their cost, and take
    from elements that hold the page's prose what their names say against them.  ``named``:
    serial number -> (tag, cost without the names); ``main``: whether an article or main element
    stands in it whose own names are good."""
    prose = dict.fromkeys((*forms, *named), 0)
    large = dict(forms)
    total = 0
    for b in blocks:
        if len(b.text) < SHORT or b.linked >= 0.5 or any(c > 2 and s not in named for s, c in b.path):
            continue
        if any(s in named and named[s][1] > 2 for s, _ in b.path):
            continue
        total += len(b.text)
        for serial, _ in b.path:
            if serial in prose:
                prose[serial] += len(b.text)
                if serial in large:
                    large[serial] |= len(b.text) >= LONG
    dear = {f for f in forms if not (large[f] and prose[f] and prose[f] >= FORM_SHARE * total)}
    freed = {s: cost for s, (tag, cost) in named.items()
             if prose[s] and (prose[s] >= NAME_SHARE * total if tag in ("article", "main")
                              else main[s] and prose[s] >= WRAP_SHARE * total)}
    new: dict[tuple, tuple] = {}
    for b in blocks:
        if b.path not in new:
            new[b.path] = tuple((s, max(c, 0.0) + FORM_COST if s in dear else freed.get(s, c)) for s, c in b.path)
        b.path = new[b.path]


def read_blocks(html: str) -> list[Block]:
    blocks: list[Block] = []
    stack: list[tuple[str, int, float]] = []  # tag, serial, cost; inline elements are not on it
    path: tuple = ()
    parts: list[str] = []
    forms: dict[int, bool] = {}
    named: dict[int, tuple[str, float]] = {}
    main: dict[int, bool] = {}
    linked = links = 0
    serial = at = k = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                blocks.append(Block(path, text, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def close_to(i):
        nonlocal path
        flush()
        del stack[i:]
        path = tuple((s, c) for _, s, c in stack)

    tokens = _tokens(html)
    ends = _ends(tokens)
    while at < len(html):
        start, stop, tag, closing, raw = tokens[k] if k < len(tokens) else (len(html), len(html), None, False, "")
        if start > at:
            piece = html[at:start]
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        at, here, k = stop, k, k + 1
        if tag == "<":  # a bare less-than sign is text
            parts.append("<")
            continue
        if tag is None:
            continue
        if tag == "br" or tag == "wbr":
            parts.append(" " if tag == "br" else "")
            continue
        if tag in SKIPPED and tag not in _VOID:
            if closing or raw.closed:
                continue
            if tag not in ("button", "input", "svg"):
                flush()
            if tag not in _RAW:
                k, own = ends[here]
                if own:
                    at, k = tokens[k][1], k + 1
                else:
                    at = tokens[k][0] if k < len(tokens) else len(html)
            continue
        if tag == "head":  # what is not left out there belongs to the body
            flush()
            continue
        if tag == "form" and not closing and not ends.get(here, (0, False))[1]:
            flush()  # without an end tag, or inside another one
            continue
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
                if not closing:
                    links = 1
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close_to(i)
                    break
            else:
                flush()
            links = 0 if tag not in ("p", "li", "div") else links
            continue
        flush()
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close_to(i)
                    break
                if stack[i][0] in _SCOPE["p"]:
                    break
        if tag in _SELF_CLOSING:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _SELF_CLOSING[tag]:
                    close_to(i)
                    break
                if stack[i][0] in _SCOPE[tag]:
                    break
        if raw.closed and tag not in ("p", "div"):
            continue
        serial += 1
        cost, plain = _attribute_cost(tag, raw.attributes)
        stack.append((tag, serial, cost))
        path += ((serial, cost),)
        if cost > plain:
            named[serial], main[serial] = (tag, plain), False
        elif named and tag in ("article", "main"):
            main.update((s, True) for _, s, _ in stack if s in main)
        if tag == "form":
            forms[serial] = False
        elif forms and tag in ("article", "main"):
            forms.update((s, True) for t, s, _ in stack if t == "form")
    flush()
    if forms or named:
        _reprice(blocks, forms, named, main)
    return blocks


# --- maximum flow -----------------------------------------------------------------------


class FlowNet:
    """Maximum flow by blocking flows over level graphs."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, forth: float, back: float = 0.0) -> None:
        self.out[a].append(len(self.to))
        self.to.append(b)
        self.room.append(forth)
        self.out[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def run(self, source: int, sink: int) -> list[bool]:
        """Push the maximum flow; whether each node is on the source's side."""
        while True:
            level = self.levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            nxt = [0] * len(self.out)
            path: list[int] = []
            at = source
            while True:
                if at == sink:
                    amount = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= amount
                        self.room[e ^ 1] += amount
                    first = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    at = self.to[path[first] ^ 1]
                    del path[first:]
                    continue
                edges = self.out[at]
                while nxt[at] < len(edges):
                    e = edges[nxt[at]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[at] + 1:
                        break
                    nxt[at] += 1
                else:
                    if at == source:
                        break
                    level[at] = -1
                    at = self.to[path.pop() ^ 1]
                    continue
                path.append(e)
                at = self.to[e]


def _cost(path, chars: int, linked: float) -> float:
    """Positive where boilerplate is the likelier label."""
    worst = best = 0.0
    for _, c in path:
        worst = max(worst, c)
        best = min(best, c)
    cost = BIAS + (worst or best) + LINK_COST * linked
    if chars < SHORT:
        cost += SHORT_COST * (1 - chars / SHORT)
    else:
        cost += LONG_GAIN if chars >= LONG else MIDDLE_GAIN
    return cost


def graph(blocks: list[Block]) -> tuple[list[list[int]], list[float], list[tuple[int, int, float]]]:
    """(blocks of each node, cost of its being content, smoothness edges)."""
    # Blocks that differ in the innermost element only belong together where that
    # element itself gives no sign.
    nodes: list[list[int]] = []
    keys: list[tuple] = []
    for i, b in enumerate(blocks):
        key = b.path[:-1] if b.path and abs(b.path[-1][1]) <= 1.0 else b.path
        if keys and keys[-1] == key:
            nodes[-1].append(i)
        else:
            keys.append(key)
            nodes.append([i])
    costs, edges = [], []
    last_in: dict[int, int] = {}
    for k, members in enumerate(nodes):
        chars = sum(len(blocks[i].text) for i in members)
        linked = sum(blocks[i].linked * len(blocks[i].text) for i in members) / chars
        costs.append(_cost(blocks[members[0]].path if len(members) == 1 else keys[k], chars, linked))
        if k:
            edges.append((k - 1, k, NEXT_EDGE))
        # the last node that stands right in the deepest element around this one
        for depth in range(len(keys[k]), 0, -1):
            other = last_in.get(keys[k][depth - 1][0])
            if other is not None:
                edges.append((other, k, SHARED_EDGE * depth / len(keys[k])))
                break
        if keys[k]:
            last_in[keys[k][-1][0]] = k
    return nodes, costs, edges


def label(blocks: list[Block]) -> list[bool]:
    """Whether each block is content."""
    nodes, costs, edges = graph(blocks)
    n = len(nodes)
    net = FlowNet(n + 2)
    source, sink = n, n + 1
    for k, cost in enumerate(costs):
        if cost > 0:
            net.edge(k, sink, cost)
        else:
            net.edge(source, k, -cost)
    for a, b, w in edges:
        net.edge(a, b, w, w)
    side = net.run(source, sink)
    out = [False] * len(blocks)
    for k, members in enumerate(nodes):
        for i in members:
            out[i] = side[k]
    return out


def extract(html: str | None) -> str:
    blocks = read_blocks(html or "")
    if not blocks:
        return ""
    return " ".join(b.text for b, keep in zip(blocks, label(blocks), strict=True) if keep)


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """One row per page: id, url, text."""
    def run(batches):
        for b in batches:
            text = [extract(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], ["id", "url", "text"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return (pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("h"))
            .mapInArrow(run, f"id {id_type}, url string, text string"))
