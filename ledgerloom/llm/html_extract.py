"""Main-text extraction with a tree-structured graphical model.

A page's block elements form a tree. Every element is content or not; an
element's own look (tag, words of class, id and role, share of link text,
length) gives its unary potential, and every parent-child edge couples the two
labels, by kind of child. Sum-product messages from the leaves to the root and
back give each element's exact marginal, and the text of elements more likely
content than not is the extract. The weights are trained by gradient on
labelled pages: what the model expects of each feature, by the same messages,
against what the labels say.

The labelled pages are given as HTML whose elements carry ``data-y`` ("1"
content, "0" not; children inherit it). ``LABELLED`` holds a small set; a
caller can pass its own. Training needs only that bounded set, so it runs on
the driver; pages are extracted in parallel, each by itself.

Defined results: null and empty html give an empty text; broken markup is read
as browsers do where that is simple (open paragraphs and items close, a head
ends where its end tag is missing, unknown end tags are skipped, quotes count
only after an equals sign, an unfinished tag ends the page's text), in time
linear in the page however deep its elements lie; a button, select, object or the like without an end
tag holds only what stands before the first block in it; repeated rows are
extracted alike; empty tables give empty results.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Element names by their role in HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
NEVER = RAW | frozenset("head svg math canvas object select option button audio video map datalist".split())
#: What a start tag closes if it is open, and where the search for it ends.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
          "option": ({"option"}, {"select"}), "button": ({"button"}, {"table", "td", "th", "caption", "object"}),
          **dict.fromkeys(("select", "input", "textarea"), ({"select"}, {"table", "td", "th", "caption", "object"}))}
#: Start tags that a head can hold; all others, and text, end it.
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript noframes template html head".split())
#: Hidden elements that hold only what stands before their first block if they have no end tag.
LOOSE = NEVER - RAW - {"head"}
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 header hr main menu nav ol p pre section table ul".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
                   r"(?P<attrs>(?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*?)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"""(?<![\w-])(class|id|role|data-y|hidden|aria-label|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

#: Words of class, id and role that the model looks for, each with the stems that mean it.
HINTS = {
    "ad": r"\bads?\b|advert|sponsor|promo|banner|doubleclick|outbrain|taboola", "nav": r"\bnav|menu|breadcrumb|pagination|pager|\btabs?\b|skip",
    "foot": r"foot|copyright|legal|colophon", "head": r"head(?!line)|masthead|topbar|logo|brand", "side": r"side|\baside|widget|rail|complementary",
    "comment": r"comment|discuss|disqus|repl(?:y|ies)|respond|feedback|review", "notice": r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|dialog|toast|privacy|warning",
    "share": r"share|social|follow|subscribe|newsletter|signup|related|recommend|popular|trending|more-|tags?\b|byline|author|meta",
    "form": r"form|login|search|register", "main": r"article|content|main|body|post|entry|story|text|prose",
}
_HINT = {k: re.compile(v, re.I) for k, v in HINTS.items()}
TAGS = {t: i for i, t in enumerate(
    "html body article main section div p h1 h2 h3 h4 ul ol li nav header footer aside form table tr td blockquote pre figure figcaption dl dd".split())}
#: What short texts say of the element they stand in.
TEXT_HINTS = {
    "legal": r"all rights reserved|\u00a9|\bcopyright\b|\bimprint\b|terms of (?:use|service)|privacy policy",
    "notice": r"\bcookies?\b|\bjavascript\b|your browser",
    "share": r"^\W*(?:share|follow us|subscribe|sign up|newsletter|related|read more|more from|you may also|recommended|popular|trending|advert|sponsored)\b",
}
_TEXT_HINT = [re.compile(v, re.I) for v in TEXT_HINTS.values()]
#: Titles of sections of reader comments.
COMMENT_TITLE = re.compile(r"^\W*(?:\d+\W*)?(?:(?:reader|user|your|leave a|post a|add a|join the)\s+)?(?:comments?|discussion|conversation|repl(?:y|ies)|responses?)\W*(?:\d+\W*)?$", re.I)
#: Texts with more code points are no hint.
SHORT_TEXT = 160
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend summary".split())
PARAGRAPHS = frozenset("p h1 h2 h3 blockquote pre".split())
N_UNARY = len(TAGS) + 1 + len(HINTS) + 8 + 4 + 2 + len(TEXT_HINTS) + 1
#: Kinds of child for the edge potentials.
EDGE_KINDS = {**dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt".split(), 0), **dict.fromkeys("li tr td th".split(), 1),
              **dict.fromkeys("nav header footer aside form".split(), 2), **dict.fromkeys("ul ol dl table".split(), 3)}
OTHER_KIND = 4
N_EDGE = 5


class Node:
    __slots__ = ("tag", "parent", "children", "hints", "label", "chars", "links", "runs", "never", "own", "loose")

    def __init__(self, tag: str, parent: int, attrs: str, label: int | None, never: bool):
        self.tag, self.parent, self.children, self.label, self.never = tag, parent, [], label, never
        self.chars = self.links = 0
        self.runs: list[int] = []
        self.hints = ()
        self.own = tag in NEVER  # hidden by itself
        self.loose = False
        if attrs:
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}
            if found:
                words = " ".join(v for k, v in found.items() if k in ("class", "id", "role", "aria-label", "itemprop"))
                self.hints = tuple(i for i, p in enumerate(_HINT.values()) if p.search(words)) if words else ()
                if found.get("data-y") in ("0", "1"):
                    self.label = int(found["data-y"])
                if "hidden" in found:
                    self.own = True
        self.never = never or self.own


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements in page order (parents before children), and blocks of text as (element, text)."""
    nodes = [Node("html", -1, "", None, False)]
    stack = [0]  # open block elements
    places: dict[str, list[int]] = {"html": [0]}  # where in the stack each tag is open, so that no search walks the stack
    endless: set[str] = set()  # tags whose content is text that have no end tag any more
    inline_links = 0
    blocks: list[tuple[int, list[str]]] = []
    fresh = True  # the next text begins a block

    def close(place: int) -> None:
        for i in reversed(stack[place:]):
            places[nodes[i].tag].pop()
        del stack[place:]

    def innermost(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def text(raw: str, decode: bool = True) -> None:
        nonlocal fresh
        piece = _html.unescape(raw) if decode and "&" in raw else raw
        if decode and nodes[stack[-1]].tag == "head" and piece.strip(" \t\n\f\r"):
            close(len(stack) - 1)
            fresh = True
        if fresh:
            if not piece.strip():
                return
            blocks.append((stack[-1], []))
            fresh = False
        blocks[-1][1].append(piece)
        n = len(piece.strip())
        nodes[stack[-1]].chars += n
        if inline_links:
            nodes[stack[-1]].links += n

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end() if m.end() > at else at + 1
        if m["data"] is not None:
            text(m["data"], decode=False)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if nodes[stack[-1]].tag == "head" and (tag in ("body", "html", "br") if m["end"] else tag not in IN_HEAD):
            close(len(stack) - 1)
            inline_links, fresh = 0, True
        if m["end"]:
            if tag in INLINE:
                inline_links -= tag == "a" and inline_links > 0
                if tag == "br":
                    text(" ")
                continue
            place = innermost((tag,))
            if place:
                nodes[stack[place]].loose = False
                close(place)
                inline_links, fresh = 0, True
            continue
        if tag in INLINE:
            if tag == "a":
                inline_links = 1
            elif tag in ("br", "img") and not fresh:
                blocks[-1][1].append(" ")
            continue
        if tag in CLOSES:
            closed, bound = CLOSES[tag]
            place = innermost(closed)
            if place and place >= innermost(bound):
                nodes[stack[place]].loose = False
                close(place)
                inline_links, fresh = 0, True
        if tag in RAW:  # its content is text up to the end tag, none of it shown
            end = None if tag in endless else re.compile(rf"</{re.escape(tag)}(?![\w-])[^>]*>", re.I).search(page, at)
            if tag in ("noscript", "template") and end is None:
                endless.add(tag)
                continue
            at = end.end() if end else size
            continue
        if tag in ENDS_P and nodes[stack[-1]].tag == "p":
            close(len(stack) - 1)
        inline_links, fresh = 0, True
        if tag == "html" and m["attrs"]:
            nodes[0].label = Node("html", -1, m["attrs"], nodes[0].label, False).label
        if tag == "html" or tag == "head" and (len(nodes) > 1 or blocks):
            continue
        parent = nodes[stack[-1]]
        node = Node(tag, stack[-1], m["attrs"] or "", parent.label, parent.never)
        parent.children.append(len(nodes))
        nodes.append(node)
        if tag not in VOID and not (m["attrs"] or "").rstrip().endswith("/") or tag in ("div", "p") and tag not in VOID:
            places.setdefault(tag, []).append(len(stack))
            stack.append(len(nodes) - 1)
            node.loose = tag in LOOSE
    if any(n.loose for n in nodes):
        for n in nodes:
            n.children = []
        for i, n in enumerate(nodes[1:], 1):  # parents come first
            if nodes[n.parent].loose:
                n.parent = nodes[n.parent].parent
            n.never = nodes[n.parent].never or n.own
            nodes[n.parent].children.append(i)
    out = []
    for owner, pieces in blocks:
        joined = " ".join("".join(pieces).split())
        if joined:
            out.append((owner, joined))
    return nodes, out


def features(nodes: list[Node], blocks: list[tuple[int, str]]) -> list[tuple[int, ...]]:
    """Active unary features of each element; all are 0 or 1."""
    chars, links = [n.chars for n in nodes], [n.links for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        links[p] += links[i]
    shown = sum(n.chars for n in nodes if not n.never)
    base, first = len(TAGS) + 1, len(TAGS) + 1 + len(HINTS)
    said: list[set[int]] = [set() for _ in nodes]
    for owner, words in blocks:
        if len(words) > SHORT_TEXT:
            continue
        said[owner].update(first + 14 + i for i, p in enumerate(_TEXT_HINT) if p.search(words))
        above = nodes[owner].parent
        if above >= 0 and nodes[owner].tag in HEADINGS and nodes[above].children[0] == owner and COMMENT_TITLE.search(words):
            said[above].add(first + 14 + len(_TEXT_HINT))
    told = [False] * len(nodes)  # holds paragraphs of its own
    for n in nodes[1:]:
        if n.tag in PARAGRAPHS and n.chars:
            told[n.parent] = True
    out = []
    for n, c, k, words, paragraphs in zip(nodes, chars, links, said, told):
        found = [TAGS.get(n.tag, len(TAGS)), first + 7]
        found += [base + h for h in n.hints]
        share = k / c if c else 0.0
        found.append(first + (0 if share < 0.2 else 1 if share < 0.6 else 2))
        found.append(first + (3 if c < 25 else 4 if c < 120 else 5))
        if not n.chars:
            found.append(first + 6)
        part = c / shown if shown and not n.never else 0.0
        found.append(first + 8 + (0 if part < 0.1 else 1 if part < 0.5 else 2 if part < 0.9 else 3))
        found.append(first + 12 + paragraphs)
        found += words
        out.append(tuple(found))
    return out


def marginals(nodes: list[Node], scores: Sequence[float], edges: Sequence[Sequence[float]], pairs: bool = False):
    """P(content) of each element by sum-product, leaves to root and back; with ``pairs`` also of each edge's four label pairs.

    ``scores`` are log odds of content alone; ``edges`` are log potentials of
    (parent, child) labels 00, 01, 10, 11 for each element's edge to its parent.
    """
    n = len(nodes)
    up1 = [1.0] * n  # product of the children's messages and the own potential, as shares
    up0 = [1.0] * n
    for i in range(n):
        s = scores[i]
        up1[i] = 1 / (1 + math.exp(-s)) if s > -500 else 0.0
        up0[i] = 1 - up1[i] if up1[i] < 1 else math.exp(-min(s, 500))
    own = [(1.0, 1.0)] * n  # what each element sends to its parent
    pot = [tuple(map(math.exp, e)) for e in edges]
    for i in range(n - 1, 0, -1):
        e = pot[i]
        m0, m1 = e[0] * up0[i] + e[1] * up1[i], e[2] * up0[i] + e[3] * up1[i]
        total = m0 + m1
        own[i] = (m0 / total, m1 / total)
        p = nodes[i].parent
        a, b = up0[p] * own[i][0], up1[p] * own[i][1]
        up0[p], up1[p] = a / (a + b), b / (a + b)
    full, joint = [0.0] * n, [None] * n
    down = [(1.0, 1.0)] * n
    for i in range(n):
        a, b = up0[i] * down[i][0], up1[i] * down[i][1]
        full[i] = b / (a + b)
        a, b = a / (a + b), b / (a + b)
        for c in nodes[i].children:  # without what the child itself said
            r0, r1 = a / max(own[c][0], 1e-300), b / max(own[c][1], 1e-300)
            e = pot[c]
            d0, d1 = r0 * e[0] + r1 * e[2], r0 * e[1] + r1 * e[3]
            down[c] = (d0 / (d0 + d1), d1 / (d0 + d1))
            if pairs:
                q = (r0 * e[0] * up0[c], r0 * e[1] * up1[c], r1 * e[2] * up0[c], r1 * e[3] * up1[c])
                joint[c] = tuple(x / sum(q) for x in q)
    return (full, joint) if pairs else full


class Model:
    def __init__(self, unary: np.ndarray, edge: np.ndarray):
        self.unary, self.edge = unary.tolist(), [tuple(x) for x in edge.tolist()]

    def extract(self, page: str | None) -> str:
        """The page's main text."""
        if not page:
            return ""
        nodes, blocks = parse(page)
        shown = [(o, t) for o, t in blocks if not nodes[o].never]
        if not shown:
            return ""
        w = self.unary
        scores = [-30.0 if n.never else sum(w[f] for f in fs) for n, fs in zip(nodes, features(nodes, blocks))]
        share = marginals(nodes, scores, [self.edge[EDGE_KINDS.get(n.tag, OTHER_KIND)] for n in nodes])
        return "\n\n".join(t for o, t in shown if share[o] >= 0.5)


def train(labelled: Sequence[str], steps: int = 500, rate: float = 0.5, decay: float = 0.001) -> Model:
    """Gradient ascent on the likelihood of the labelled pages' labels."""
    data = []
    for page in labelled:
        nodes, blocks = parse(page)
        for n in nodes:
            n.label = 0 if n.label is None else n.label
        data.append((nodes, features(nodes, blocks), [EDGE_KINDS.get(n.tag, OTHER_KIND) for n in nodes]))
    unary, edge = np.zeros(N_UNARY), np.zeros((N_EDGE, 4))
    for _ in range(steps):
        du, de = -decay * unary * len(data), -decay * edge * len(data)
        for nodes, feats, kinds in data:
            share, joint = marginals(nodes, [float(sum(unary[f] for f in fs)) for fs in feats], [edge[k] for k in kinds], True)
            for i, n in enumerate(nodes):
                for f in feats[i]:
                    du[f] += n.label - share[i]
                if i:
                    de[kinds[i]] -= joint[i]
                    de[kinds[i], 2 * nodes[n.parent].label + n.label] += 1
        unary += rate * du / len(data)
        edge += rate * de / len(data)
    return Model(unary, edge)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              labelled: Sequence[str] | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    model = train(LABELLED if labelled is None else labelled)  # a bounded set of pages
    shared = pages.sparkSession.sparkContext.broadcast(model)  # some hundred weights
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = shared.value.extract
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return slim.mapInArrow(run, f"page_id {slim.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint")


_LONG = "The river had risen for three days, and by Sunday the lower fields, the path and half of the orchard lay under water. "
_MID = "Nobody in the village could remember such a spring. "

_LINKS = "".join(f"<li><a href=/{w}>{w}</a></li>" for w in ("Home", "News", "Sport", "Weather", "Letters", "Archive", "About", "Contact"))

#: Labelled pages: common layouts, each with its content marked.
LABELLED = (
    f"""<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/s>Sport</a></li></ul></nav>
<div class="ad">Buy new boots now, half price.</div><article data-y=1><h1>High water</h1><p>{_LONG * 3}</p><p>{_MID}</p><p>Short.</p></article>
<footer>&copy; example.com All rights reserved by the publisher of this page.</footer></body></html>""",
    f"""<html><body><header><div class="logo"><a href=/>Site</a></div><nav class="menu"><a href=/a>One</a> <a href=/b>Two</a></nav></header>
<main data-y=1><h1>A title</h1><p>{_LONG}</p><h2>Part two</h2><p>{_LONG * 2}</p><ul><li>first thing we saw there</li><li>second thing</li></ul><p>{_MID}</p></main>
<aside class="sidebar"><h3>Popular</h3><ul><li><a href=/x>Ten ways to cook rice</a></li></ul><p>{_MID}</p></aside><footer><p>{_MID}</p></footer></body></html>""",
    f"""<html><body><div class="cookie-banner"><p>We use cookies to make this site better for you. {_MID}</p><button>OK</button></div>
<div id="header"><h1><a href=/>The paper</a></h1></div><div id="content" data-y=1><h1>Water everywhere</h1><p>{_LONG * 2}</p><p>{_LONG}</p>
<blockquote><p>{_MID}</p></blockquote><p>{_MID}</p></div><div class="comments"><h3>Comments</h3><div class="comment"><p>{_LONG}</p></div>
<div class="comment"><p>I agree with all of this.</p></div></div><div id="footer">Contact and imprint</div></body></html>""",
    f"""<html><body><article data-y=1><header><h1>What happened</h1></header><p>{_LONG}</p><div class="advertisement" data-y=0><p>{_MID}</p></div>
<p>{_LONG * 2}</p><aside data-y=0><p>Read more about floods {_MID}</p></aside><table><tr><td>Monday</td><td>3 m</td></tr><tr><td>Tuesday</td><td>4 m</td></tr></table>
<p>{_MID}</p><section class="comments" data-y=0><h2>Reader comments</h2><p>{_LONG}</p><p>{_MID}</p></section></article>
<form action=/subscribe><p>Enter your address to get our letter.</p><input name=q></form></body></html>""",
    f"""<html><body><div class="topbar"><ul class="nav"><li><a href=/1>A</a></li><li><a href=/2>B</a></li></ul></div><div class="wrapper"><div class="sidebar">
<div class="widget"><h4>Archive</h4><ul><li><a href=/3>May</a></li><li><a href=/4>June</a></li></ul><p>{_LONG}</p></div></div><div class="post" data-y=1>
<h2>A post</h2><div class="entry"><p>{_LONG}</p><p>{_MID}</p><pre>x = 1</pre><ol><li>{_MID}</li><li>Then came rain.</li></ol></div>
<div class="share" data-y=0><a href=/t>Share this</a></div></div><div class="related"><h3>Related</h3><p><a href=/5>Another story of the river</a></p></div>
<div id="comments"><ol class="comment-list"><li><p>{_LONG}</p></li><li><p>{_MID}</p></li></ol></div></div></body></html>""",
    f"""<html><body><div role="alert" class="notice"><p>{_MID} Scheduled maintenance tonight.</p></div><main data-y=1><article><h1>On maps</h1><p>{_MID}</p><figure>
<img src=m.png><figcaption>A map of the valley.</figcaption></figure><p>{_LONG * 4}</p><h3>Notes</h3><dl><dt>Weir</dt><dd>{_MID}</dd></dl></article></main>
<section class="promo"><h2>Offers</h2><p>{_LONG}</p></section><footer class="site-footer"><div><p>{_LONG}</p></div><ul><li><a href=/c>Contact</a></li></ul></footer></body></html>""",
    f"""<html><body><nav class="breadcrumb"><a href=/>Home</a> &gt; <a href=/w>World</a></nav><header><p>{_MID}</p></header><section data-y=1><h1>Long read</h1><p>{_LONG}</p>
<p>{_LONG}</p><p>Ends.</p></section><form class="login"><p>{_MID}</p><label>Name</label><input></form><div class="popup"><p>{_LONG}</p></div></body></html>""",
    f"""<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article data-y=1><h1>Short news</h1><p>Rain.</p></article><footer>&copy; example.net</footer></body></html>""",
    f"""<html><body><div class="page"><div class="ad">{_LONG}</div><aside>{_LONG}</aside><article data-y=1><h1>{_MID}</h1><div><p>{_LONG}</p><div>{_MID}</div></div></article>
<div class="ad-slot"><p>{_LONG}</p></div><footer>{_LONG}<p>{_MID}</p></footer></div></body></html>""",
    f"""<html><body><div data-y=1><h1>Plain page</h1><p>{_LONG}</p><p>{_MID}</p></div></body></html>""",
    "<html><body data-y=1><p>Rain.</p></body></html>",
    f"""<html><body data-y=1><h1>No layout at all</h1><p>{_LONG * 2}</p><p>{_MID}</p></body></html>""",
    # long menus
    f"""<html><body><nav><ul>{_LINKS}</ul></nav><article data-y=1><h1>Rain</h1><p>{_LONG}</p><p>{_MID}</p></article><footer>{_MID}</footer></body></html>""",
    f"""<html><body><nav><ul>{_LINKS}</ul></nav><div class="ad">{_MID}</div><article data-y=1><p>{_MID}</p></article></body></html>""",
    f"""<html><body><header><ul>{_LINKS}</ul></header><main data-y=1><h1>Rain</h1><p>{_LONG * 2}</p></main><footer><ul>{_LINKS}</ul></footer></body></html>""",
    f"""<html><body><div><ul>{_LINKS}</ul></div><div data-y=1><h1>Rain</h1><p>{_LONG * 2}</p><p>{_MID}</p></div><aside><ul>{_LINKS}</ul></aside></body></html>""",
    f"""<html><body><nav><ul>{_LINKS}</ul></nav></body></html>""",
    # elements within elements
    f"""<html><body><div><div data-y=1><p>{_LONG}</p><p>{_MID}</p><div><p>{_LONG}</p></div></div></div></body></html>""",
    f"""<html><body><div><div><a href=/>Home</a></div><div><div data-y=1><div><h1>Rain</h1><p>{_LONG * 2}</p></div><div><p>{_MID}</p><div><p>{_LONG}</p></div></div></div></div></div></body></html>""",
    # no elements, or hardly any
    "<html data-y=1><a href=/r>Rain</a> again.", f"<html><body data-y=1><div>{_LONG}</div><div>{_MID}</div><div>{_LONG * 2}</div><div>Ends.</div></body>",
    "<html data-y=1>Rain again.", f"<html data-y=1>{_MID}", f"<html data-y=1>{_LONG * 3}", "<html data-y=1><p>Rain.</p>", f"<html data-y=1><p>{_MID}</p><p>Rain.</p>",
    f"<html data-y=1><h1>Rain</h1><p>{_LONG}</p><p>{_MID}</p>", f"<html><div data-y=1>{_LONG}</div>", "<html><body data-y=1>Rain.</body>",
    # names that say nothing, short articles
    f"""<html><body><div class="kopfzeile">Das Blatt</div><div class="leiste"><a href=/>Start</a> <a href=/b>Wetter</a></div><article data-y=1><p>{_MID}</p></article></body></html>""",
    f"""<html><body><div class="x1"><a href=/>Una</a></div><div class="x2">Dos</div><article data-y=1><p>Rain.</p></article><div class="x3">Tres</div></body></html>""",
    f"""<html><body><div class="barre"><a href=/>Accueil</a></div><div class="boite" data-y=1><h1>La crue</h1><p>{_LONG}</p><p>{_MID}</p></div><div class="bas">\u00a9 Le Journal. All rights reserved.</div></body></html>""",
    f"""<html><body><table><tr><td><a href=/>Home</a><br><a href=/n>News</a></td><td data-y=1><h2>High water</h2><p>{_LONG * 2}</p><p>{_MID}</p></td></tr></table><div>All rights reserved.</div></body></html>""",
    # lists of links that belong to the article
    f"""<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav><article data-y=1><h1>Sources</h1><p>{_MID}</p><ul><li><a href=/1>The first gauge book</a></li>
<li><a href=/2>The second gauge book</a></li><li><a href=/3>Letters</a></li></ul><p>{_LONG}</p></article><footer><ul><li><a href=/c>Contact</a></li></ul></footer></body></html>""",
    f"""<html><body><header><a href=/>Site</a></header><main data-y=1><h1>Reading list</h1><ul><li><a href=/1>High water in May</a></li><li><a href=/2>A map of weirs</a></li></ul><p>{_MID}</p></main>
<aside><ul><li><a href=/x>Ten ways to cook rice</a></li></ul></aside></body></html>""",
    # comments and small print without marks
    f"""<html><body><main data-y=1><h1>High water</h1><p>{_LONG * 2}</p><p>{_MID}</p><section data-y=0><h2>Comments</h2><div><p>{_LONG}</p></div><div><p>{_MID}</p></div></section></main>
<div>\u00a9 The paper. All rights reserved.</div></body></html>""",
    f"""<html><body><article data-y=1><h1>Weirs</h1><p>{_LONG}</p><section><h2>How they work</h2><p>{_MID}</p><p>{_LONG}</p></section><div data-y=0><h3>3 replies</h3><ul><li><p>{_MID}</p></li><li>{_LONG}</li></ul></div>
<div data-y=0>Copyright The paper</div></article></body></html>""",
    f"""<html><body><main data-y=1><h1>High water</h1><p>{_LONG * 3}</p><section><h2>At night</h2><p>{_MID}</p><p>Rain.</p></section><section data-y=0><h2>Comments</h2><p>{_LONG}</p><p>So true.</p><p>{_MID}</p></section></main></body></html>""",
    f"""<html><body><article data-y=1><p>{_LONG}</p><p>{_MID}</p><div data-y=0><h2>Discussion</h2><p>I agree.</p><p>{_LONG * 2}</p></div></article></body></html>""",
    f"""<html><body><main data-y=1><h1>Weirs</h1><p>{_MID}</p><section data-y=0><h3>Responses (2)</h3><p>Nice.</p><p>{_MID}</p></section></main></body></html>""",
    f"""<html><body><div data-y=1><h1>Weirs</h1><p>{_LONG * 2}</p><div data-y=0><h4>Leave a reply</h4><p>{_MID}</p></div></div><div><p>This site uses cookies. Read our privacy policy.</p></div></body></html>""",
)
