"""Main text of web pages by a tree-structured graphical model over the DOM.

Each element is a node that is content or not.  A node has a potential from what can be seen of it (tag,
class and id words, link density, length, punctuation, forms), and each parent-child pair a potential from
both labels and the child's kind of tag.  Sum-product messages go up the tree and down again and give
every node's marginal; the blocks whose nodes are content by their marginals are the text.

The tables have no labelled pages, so both kinds of potentials are trained on seeded, generated pages
that are part of this module: articles among menus, headers, footers, sidebars, notices, adverts, forms
and comments, in several layouts and with the usual faults (unclosed tags, no closing body).  The node
potentials are a logistic model's log odds less those of the labels' share (a likelihood ratio); the
pair potentials are smoothed transition frequencies.

Defined results: null and empty html give the empty text; pages without markup give their text as one
block; broken markup is repaired as it is read and never fails; repeated rows are extracted one by one;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import arrow_batches

PAGES = 1500  # generated training pages

TAG = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z))""", re.S)
ATTR = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no text of the page.  Those of ``TO_END`` run to the page's end if no end tag follows,
#: those of ``LOOSE`` end at the first block or list of options; of others without an end tag only the tag is skipped.
RAW = frozenset("script style textarea title template svg iframe select option".split())
TO_END, LOOSE = frozenset("script style textarea title".split()), frozenset("svg select option".split())
#: Elements that start a block of their own; others run on in the block around them.
BLOCK = frozenset(
    "html body div p article section main header footer nav aside ul ol li dl dt dd h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption form fieldset details summary address hgroup search dialog menu center".split()
)
LOOSE_END = {t: re.compile(rf"</{t}\s*>|</?(?:{'|'.join(sorted(BLOCK - {'hr'} | ({'select', 'datalist', 'optgroup', 'option'} if t == 'option' else {'select', 'datalist'} if t == 'select' else set())))})(?=[\s/>])", re.I) for t in LOOSE}
CLOSES_P = BLOCK - {"html", "body"}
#: An opening tag ends open elements of these kinds, up to the boundary given.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

KINDS = {
    "title": {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}, "text": {"p", "blockquote", "pre", "figcaption"}, "list": {"ul", "ol", "li", "dl", "dt", "dd", "menu"},
    "main": {"article", "main"}, "nav": {"nav"}, "edge": {"header", "footer"}, "aside": {"aside", "dialog", "search"}, "form": {"form", "fieldset", "button", "label", "input"},
    "table": {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, "root": {"html", "body"},
}
KIND_OF = {t: k for k, ts in KINDS.items() for t in ts}
KIND_NAMES = (*KINDS, "other")
CUES = {
    "nav": "nav navbar menu menus breadcrumb breadcrumbs pagination pager toc links tabs toolbar skip".split(),
    "edge": "header head masthead banner footer foot bottom copyright colophon legal topbar site".split(),
    "aside": "sidebar side aside related recommend recommended recommendations widget rail popular trending tags tag share sharing social follow more also".split(),
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion promoted banner-ad adsense".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup paywall disclaimer message toast warning login".split(),
    "comment": "comment comments reply replies respond discussion disqus reaction reactions reader".split(),
    "content": "content article post entry story body text main prose".split(),
    "meta": "meta byline author date time timestamp info".split(),
}
CUE_OF = {w: c for c, ws in CUES.items() for w in ws}
CUE_NAMES = tuple(CUES)
WORDS = re.compile(r"[a-z]+")
FEATURES = [*(f"kind {k}" for k in KIND_NAMES), *(f"cue {c}" for c in CUE_NAMES), "hidden", "length", "links", "stops", "depth", "inside form", "short", "has p", "after main"]


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    cues: frozenset[str]
    hidden: bool
    depth: int
    own: int = 0  # characters of text directly in this node's block
    total: int = 0
    linked: int = 0
    stops: int = 0
    paragraphs: int = 0


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in document order (parents first) and blocks of text (node, raw text) in page order."""
    nodes = [Node("#", -1, frozenset(), False, 0)]
    stack = [0]
    blocks: list[tuple[int, list[str]]] = []
    links, at, n = 0, 0, len(html)
    current = -1  # node of the open block, -1 if the next text starts one

    def add(text: str) -> None:
        nonlocal current
        if not text or (current < 0 and text.isspace()):
            return
        home = stack[-1]
        if current != home:
            blocks.append((home, []))
            current = home
        blocks[-1][1].append(text)
        if links:
            size = len(text.strip())
            nodes[home].linked += size

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        if lt > at:
            add(html[at:lt])
        m = TAG.match(html, lt)
        if not m:
            add("<")
            at = lt + 1
            continue
        at = m.end()
        close, tag, attrs = m.group(1), m.group(2), m.group(3)
        if tag is None:
            close, tag, attrs = m.group(4), m.group(5), m.group(6)
            if tag is None:
                continue  # comment or declaration
        tag = tag.lower()
        if close:
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCK:
                for k in range(len(stack) - 1, 0, -1):
                    if nodes[stack[k]].tag == tag:
                        del stack[k:]
                        links = 0
                        break
                current = -1
            continue
        if tag in RAW and not attrs.rstrip().endswith("/"):
            if tag in LOOSE:
                end = LOOSE_END[tag].search(html, at)
                at = n if not end else end.end() if end.group().endswith(">") else end.start()
                continue
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else n if tag in TO_END else at
            continue
        if tag == "br" or tag == "hr":
            if current >= 0:
                blocks[-1][1].append(" ")
            if tag == "hr":
                current = -1
            continue
        if tag == "a":
            links += 1
            continue
        if tag == "head":
            end = re.compile(r"</head\s*>|<body\b", re.I).search(html, at)
            if end:
                at = end.end() if end.group()[1] == "/" else end.start()
            continue
        if tag in VOID or tag not in BLOCK:
            continue
        if tag in CLOSES_P and nodes[stack[-1]].tag == "p":
            stack.pop()
        if tag in ENDS:
            over, stop = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                t = nodes[stack[k]].tag
                if t in stop:
                    break
                if t in over:
                    del stack[k:]
                    break
        cues, hidden = frozenset(), False
        if attrs and not attrs.isspace():
            words: list[str] = []
            for a in ATTR.finditer(attrs):
                name, value = a.group(1).lower(), (a.group(2) or a.group(3) or a.group(4) or "").lower()
                if name in ("class", "id", "role"):
                    words += WORDS.findall(value)
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                    hidden = True
            cues = frozenset(CUE_OF[w] for w in words if w in CUE_OF)
        nodes.append(Node(tag, stack[-1], cues, hidden, len(stack)))
        stack.append(len(nodes) - 1)
        current = -1
    out = []
    for home, parts in blocks:
        text = " ".join(html_lib.unescape("".join(parts)).split())
        if text:
            out.append((home, text))
            node = nodes[home]
            node.own += len(text)
            node.stops += sum(map(text.count, ".!?,;。，"))
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        node.total += node.own
        if node.tag == "p":
            node.paragraphs += 1
        if node.parent >= 0:
            up = nodes[node.parent]
            up.total += node.total
            up.linked += node.linked
            up.stops += node.stops
            up.paragraphs += node.paragraphs
    return nodes, out


def features(nodes: list[Node]) -> np.ndarray:
    x = np.zeros((len(nodes), len(FEATURES)))
    base = len(KIND_NAMES) + len(CUE_NAMES)
    after, form = False, [False] * len(nodes)
    for i, node in enumerate(nodes):
        row = x[i]
        kind = KIND_OF.get(node.tag, "other")
        row[KIND_NAMES.index(kind)] = 1
        for c in node.cues:
            row[len(KIND_NAMES) + CUE_NAMES.index(c)] = 1
        form[i] = node.parent >= 0 and form[node.parent] or kind == "form"
        row[base:] = (
            node.hidden, min(math.log1p(node.total), 8) / 8, min(1.0, node.linked / node.total) if node.total else 0.0, min(10 * node.stops / node.total, 1.0) if node.total else 0.0,
            min(node.depth, 12) / 12, form[i], node.total < 40, min(node.paragraphs, 8) / 8, after,
        )
        after = after or kind == "main" and node.total > 0
    return x


def kinds_of(nodes: list[Node]) -> list[int]:
    return [KIND_NAMES.index(KIND_OF.get(n.tag, "other")) for n in nodes]


@dataclass
class Potentials:
    weight: np.ndarray
    bias: float
    pair: list  # [kind of child][parent label][child label], log
    root: tuple[float, float]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Sum-product over the tree: messages from the leaves up, then from the root down."""
        n = len(nodes)
        unary = (features(nodes) @ self.weight + self.bias).tolist()  # log ratio content : not
        kinds = kinds_of(nodes)
        # belief[i]: log (own potential and messages from children) for both labels
        b0, b1 = [0.0] * n, unary[:]
        m0, m1 = [0.0] * n, [0.0] * n
        b0[0] += self.root[0]
        b1[0] += self.root[1]
        for i in range(n - 1, 0, -1):
            (p00, p01), (p10, p11) = self.pair[kinds[i]]
            m0[i], m1[i] = _add(p00 + b0[i], p01 + b1[i]), _add(p10 + b0[i], p11 + b1[i])
            up = nodes[i].parent
            b0[up] += m0[i]
            b1[up] += m1[i]
        for i in range(1, n):
            (p00, p01), (p10, p11) = self.pair[kinds[i]]
            up = nodes[i].parent
            # the parent's belief without this child's own message
            q0, q1 = b0[up] - m0[i], b1[up] - m1[i]
            b0[i] += _add(p00 + q0, p10 + q1)
            b1[i] += _add(p01 + q0, p11 + q1)
        return [1 / (1 + math.exp(max(-700.0, min(700.0, x - y)))) for x, y in zip(b0, b1)]


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if a - b < 40 else a


def labelled_page(seed: int) -> tuple[str, list[str]]:
    """A generated page and the texts of its content blocks."""
    r = random.Random(seed)
    syllables = "an en ti ra mo le tion ou er est ka lin do ver ça ß ü".split()

    def word() -> str:
        return "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))

    plain, again = r.random() < 0.12, r.random() < 0.12  # pages without punctuation, pages of few words

    def text(lo: int, hi: int, stop: bool = True) -> str:
        stop = stop and not plain
        if again:
            w = word()
            return " ".join([w] * r.randint(lo, 4 * hi))
        w = [word() + ("," if stop and r.random() < 0.08 else "." if stop and r.random() < 0.1 else "") for _ in range(r.randint(lo, hi))]
        s = " ".join(w)
        return s[:1].upper() + s[1:] + ("." if stop else "")

    def cls(*names: str) -> str:
        return f' {r.choice(["class", "class", "id"])}="{r.choice(names)}"' if r.random() < 0.8 else ""

    gold: list[str] = []

    def keep(tag: str, s: str, close: bool = True) -> str:
        gold.append(s)
        inner = s
        if r.random() < 0.15 and " " in s:
            a, _, b = s.partition(" ")
            inner = f"<b>{a}</b> {b}" if r.random() < 0.6 else f'<a href="/x">{a}</a> {b}'
        return f"<{tag}>{inner}" + (f"</{tag}>" if close else "")

    def links(tag: str, n: int) -> str:
        own = "".join(f'<li><a href="/{word()}">{text(1, 3, False)}</a></li>' for _ in range(n))
        return f"<ul>{own}</ul>" if r.random() < 0.7 else "".join(f'<a href="/{word()}">{text(1, 3, False)}</a> ' for _ in range(n))

    def nav() -> str:
        t = r.choice(["nav", "nav", "div", "ul"])
        return f"<{t}{cls('menu', 'navbar', 'nav main-nav', 'breadcrumbs') if t != 'nav' else ''}>{links(t, r.randint(2, 9))}</{t}>"

    def header() -> str:
        t = r.choice(["header", "div"])
        return f"<{t} class=\"{r.choice(['site-header', 'masthead', 'topbar', 'header'])}\">{r.choice(['<h1>%s</h1>', '<p>%s</p>', '<a href=\"/\">%s</a>', '%s']) % text(1, 8, False)}{nav() if r.random() < 0.4 else ''}</{t}>"

    def footer() -> str:
        t = r.choice(["footer", "footer", "div"])
        return f"<{t}{cls('footer', 'site-footer', 'bottom') if t == 'footer' else ' class=\"footer\"'}>{r.choice(['&copy; %s', '<p>%s</p>', '%s &middot; <a href=\"/p\">privacy</a>']) % text(2, 22)}{links('div', 3) if r.random() < 0.3 else ''}</{t}>"

    def aside() -> str:
        t = r.choice(["aside", "aside", "div", "section"])
        c = "" if t == "aside" and r.random() < 0.6 else f' class="{r.choice(["sidebar", "related", "widget", "share social", "recommended", "tags"])}"'
        body = r.choice([lambda: f"<h3>{text(1, 4, False)}</h3>" + links("div", r.randint(2, 6)), lambda: f"<p>{text(5, 40)}</p>", lambda: text(4, 30)])()
        return f"<{t}{c}>{body}</{t}>"

    def advert() -> str:
        t = r.choice(["div", "div", "section", "aside", "p"])
        return f'<!-- ad --><{t} class="{r.choice(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot"])}">{r.choice(["%s", "<a href=/buy>%s</a>", "<span>%s</span>"]) % text(3, 40)}</{t}>'

    def notice() -> str:
        return f'<div class="{r.choice(["cookie-notice", "consent", "newsletter", "popup modal", "alert notice", "paywall", "gdpr"])}"{r.choice(["", " role=\"dialog\"", " hidden"])}>{r.choice(["%s", "<p>%s</p>", "<p>%s</p><button>OK</button>"]) % text(4, 35)}</div>'

    def form() -> str:
        return f"<form action=\"/s\"{cls('search', 'login', 'subscribe')}><label>{text(1, 4, False)}</label><input name=q>{r.choice(['', '<p>%s</p>' % text(4, 20)])}<button>{text(1, 2, False)}</button></form>"

    def comments() -> str:
        t = r.choice(["section", "div", "ol", "div"])
        c = r.choice(["div", "li", "article"])
        one = [f"<{c} class=\"comment\"><p>{text(4, 60)}</p></{c}>" if r.random() < 0.5 else f"<p>{text(4, 60)}</p>" for _ in range(r.randint(1, 6))]
        return f'<{t} {r.choice(["class", "id"])}="{r.choice(["comments", "replies", "comment-list", "discussion", "reader-comments"])}">{"<h2>%s</h2>" % text(1, 3, False) if r.random() < 0.6 else ""}{"".join(one)}</{t}>'

    junk = [nav, header, footer, aside, advert, notice, form, comments]
    style = r.random()
    shell = r.choice([("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' class="content"'), ("div", ' id="article-body"'), ("section", ' class="entry-content"'), ("div", ' class="post-text"')])
    out = []
    title = text(3, 12, r.random() < 0.5)
    if r.random() < 0.93:
        gold.append(title)
        out.append(f"<h1>{title}</h1>")
    for k in range(r.randint(1, 9)):
        u = r.random()
        if u < 0.62:
            out.append(keep("p", text(3, 90), r.random() < 0.85))
        elif u < 0.68:
            s, x = text(3, 60), text(1, 40)
            gold.extend([s, x])
            out.append(f"<p><b>{s}<br><p>{x}</p>")
        elif u < 0.74:
            out.append(keep("h2", text(1, 7, False)))
        elif u < 0.79:
            out.append("<ul>" + "".join(keep("li", text(2, 18, False), r.random() < 0.8) for _ in range(r.randint(2, 5))) + "</ul>")
        elif u < 0.83:
            out.append(keep("blockquote", text(5, 40)))
        elif u < 0.86:
            out.append("<table>" + "".join("<tr>" + "".join(keep("td", text(1, 4, False)) for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
        elif u < 0.89:
            out.append("<figure><img src=x>" + keep("figcaption", text(2, 14)) + "</figure>")
        elif u < 0.91:
            out.append(keep("pre", text(3, 30)))
        else:
            out.append(r.choice([advert, aside, notice, form])())
    article = f"<{shell[0]}{shell[1]}>{''.join(out)}</{shell[0]}>"
    if r.random() < 0.15:
        article = f"<div{cls('wrapper', 'container', 'page')}>{article}</div>"
    before = [f() for f in r.sample(junk[:7], r.randint(0, 4))]
    after = [f() for f in r.sample(junk, r.randint(0, 5))]
    close = "</body></html>" if r.random() < 0.85 else ""
    head = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
    return (head if style < 0.95 else "") + "".join(before) + article + "".join(after) + close, gold


def _labels(nodes: list[Node], blocks: list[tuple[int, str]], gold: list[str]) -> list[int]:
    """1 for nodes of content blocks and for ancestors whose text is mostly content."""
    wanted = {" ".join(html_lib.unescape(g).split()) for g in gold}
    good = [0] * len(nodes)
    for home, text in blocks:
        good[home] += len(text) if text in wanted else 0
    for i in range(len(nodes) - 1, 0, -1):
        good[nodes[i].parent] += good[i]
    return [int(n.total > 0 and 2 * g > n.total) for n, g in zip(nodes, good)]


@cache
def potentials(pages: int = PAGES, seed: int = 100_000) -> Potentials:
    """Trained potentials; the same on every call and machine."""
    xs, ys = [], []
    pair = np.ones((len(KIND_NAMES), 2, 2))
    root = np.ones(2)
    for k in range(pages):
        page, gold = labelled_page(seed + k)
        nodes, blocks = parse(page)
        y = _labels(nodes, blocks, gold)
        xs.append(features(nodes))
        ys += y
        root[y[0]] += 1
        for i, kind in list(enumerate(kinds_of(nodes)))[1:]:
            pair[kind, y[nodes[i].parent], y[i]] += 1
    x, y = np.concatenate(xs), np.asarray(ys, float)
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, reg = np.zeros(x1.shape[1]), np.full(x1.shape[1], 3.0)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        g, h = x1.T @ (p - y) + reg * w, (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(reg)
        w -= np.linalg.solve(h, g)
    prior = math.log(y.mean() / (1 - y.mean()))
    logs = np.log(pair / pair.sum(2, keepdims=True))
    return Potentials(w[:-1], float(w[-1]) - prior, logs.tolist(), tuple(np.log(root / root.sum()).tolist()))


def extract(html: str | None, model: Potentials) -> str:
    if not html:
        return ""
    nodes, blocks = parse(html)
    if not blocks:
        return ""
    if len(nodes) == 1:
        return "\n".join(t for _, t in blocks)
    p = model.marginals(nodes)
    return "\n".join(t for home, t in blocks if p[home] > 0.5)


def main_text(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    slim = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    model = potentials()
    schema = T.StructType([slim.schema["page_id"], slim.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h, model) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return arrow_batches(slim).mapInArrow(run, schema)
