"""Main text of web pages: gradient-boosted trees over the nodes of the document tree.

Every block element is a node with features of its subtree (text, link and tag density, sentence
marks, length of blocks), of its tag, class, id and role, of its depth and place among siblings, and of its
ancestors. Boosted trees give the probability that a node holds main text. A node may only be kept if
all its ancestors are, and a dropped one drops its subtree: of all such choices the likeliest is
found from the leaves to the root. The text of the kept nodes follows page order.

There are no labelled pages, so the trees learn from pages with known answers, built from the texts
of at most about ``sample_pages`` pages of the table: the text blocks of a page in one of many article
layouts among menus, headers, notices, adverts, sidebars, forms, comments and footers made of the words of
that page. The page itself is added where it marks its article by an ``article`` or ``main`` element.

Script, style, head, template and form controls never give text; comments of the markup neither.
Character references are decoded, white space becomes one space, blocks are joined by one space.
A null or empty page has an empty text. Unclosed and wrongly nested elements are closed as a browser would.
Repeated rows get equal texts. In an empty table nothing is learnt. Other columns pass through.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from recspark.session import freeze

SAMPLE_PAGES = 400
VARIANTS = 6
TREES, DEPTH = 20, 5

#: Element names by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style head title template noscript iframe object svg canvas audio video select textarea button datalist".split())
BLOCK = frozenset(
    "html body article section main nav header footer aside div p ul ol li dl dt dd h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th "
    "blockquote pre figure figcaption form fieldset details summary address hgroup center dialog menu search".split()
)
ENDS_P = BLOCK - {"html", "body"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An end tag inside one of these never closes what stands outside.
SCOPE = frozenset("article section main nav header footer aside div td th li blockquote figure form table body".split())
#: Words in class, id and role that name main text, and that name the rest.
MAIN_WORDS = frozenset("article content main post entry story text body prose page hentry".split())
OTHER_WORDS = frozenset(
    "nav navigation navbar menu breadcrumb breadcrumbs sidebar aside widget footer foot header masthead banner comment comments reply "
    "respond discussion cookie consent notice alert gdpr ad ads advert advertisement sponsor sponsored promo promoted share social related "
    "recommended newsletter subscribe signup login search popup modal overlay copyright legal disclaimer tags pagination toolbar hidden "
    "complementary contentinfo dialog form rail teaser bar top topbar skip".split()
)
_TAGS = ("p", "h", "list", "div", "article", "nav", "header", "footer", "aside", "form", "table")
_TAG_OF = {t: i for i, t in enumerate(_TAGS)} | {h: 1 for h in HEADINGS} | {t: 2 for t in ("ul", "ol", "li", "dl", "dt", "dd", "menu")}
_TAG_OF |= {"section": 3, "main": 4, "td": 10, "tr": 10, "th": 10, "tbody": 10, "blockquote": 0, "pre": 0}
N_FEATURES = 16 + len(_TAGS) + 1


class Node:
    __slots__ = ("tag", "words", "hidden", "label", "parent", "nodes", "parts", "depth", "order", "chars", "linked", "marks", "blocks", "tags", "main")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        named = f"{attrs.get('class') or ''} {attrs.get('id') or ''} {attrs.get('role') or ''}"
        self.tag, self.parent = tag, parent
        self.words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()) if named.strip() else []
        self.hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "")
        self.label = attrs.get("data-known") == "main"
        self.nodes: list[Node] = []
        self.parts: list = []  # texts, spaces and child nodes in order
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.linked = self.marks = self.blocks = self.tags = 0
        self.main = False


class _Tree(HTMLParser):
    """Block elements as nodes; what is inline only adds its text, links count apart."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {}, None)
        self.open: list[tuple[str, Node]] = [("html", self.root)]
        self.silent = 0
        self.links = 0

    @property
    def node(self) -> Node:
        return self.open[-1][1]

    def _close(self, at: int) -> None:
        for tag, _ in self.open[at:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.open[at:]

    def _find(self, tags, limit) -> int:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in tags:
                return i
            if self.open[i][0] in limit:
                return 0
        return 0

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if not self.silent:
                self.node.parts.append(" " if tag in ("br", "hr") else "")
                self.node.tags += 1
            return
        if tag in ("html",):
            return
        if tag == "body" and (at := self._find(("head",), ())):
            self._close(at)
        if tag in ENDS_P and (at := self._find(("p",), SCOPE)):
            self._close(at)
        for group, limit in ((("li",), ("ul", "ol", "menu")), (("dt", "dd"), ("dl",)), (("td", "th"), ("tr", "table")), (("tr",), ("table",)), (("option",), ("select",))):
            if tag in group and (at := self._find(group, limit)):
                self._close(at)
        node = self.node
        if tag in BLOCK and not self.silent:
            node = Node(tag, dict(attrs), self.node)
            self.node.nodes.append(node)
            self.node.parts.append(node)
        elif not self.silent:
            node.tags += 1
        self.open.append((tag, node))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID or tag in ("html", "body"):
            return
        limit = () if tag in SCOPE or tag in SILENT else SCOPE
        if at := self._find((tag,), limit):
            self._close(at)

    def handle_data(self, data):
        if self.silent or not data:
            return
        node = self.node
        node.parts.append(data)
        n = len(data) - data.count(" ") if not data.isspace() else 0
        node.chars += n
        node.linked += n if self.links else 0
        if n:
            node.marks += data.count(",") + data.count(".")
            node.blocks += 1


def parse(page: str) -> list[Node]:
    """Nodes in page order, the root first, with sums over their subtrees."""
    tree = _Tree()
    tree.feed(page)
    tree.close()
    out: list[Node] = []
    stack = [tree.root]
    while stack:
        node = stack.pop()
        node.order = len(out)
        out.append(node)
        stack.extend(reversed(node.nodes))
    for node in reversed(out):
        node.main = node.main or node.label
        if node.parent:
            for name in ("chars", "linked", "marks", "blocks"):
                setattr(node.parent, name, getattr(node.parent, name) + getattr(node, name))
            node.parent.tags += node.tags + 1
            node.parent.main = node.parent.main or node.main
    return out


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    out = np.zeros((len(nodes), N_FEATURES))
    total = max(1, nodes[0].chars)
    before = 0
    up = np.zeros((len(nodes), 2))
    seen: dict[int, int] = {}
    for i, n in enumerate(nodes):
        p = n.parent
        good = sum(w in MAIN_WORDS for w in n.words) + (n.tag in ("article", "main"))
        bad = sum(w in OTHER_WORDS for w in n.words) + (n.tag in ("nav", "footer", "aside", "form"))
        at = seen.get(id(p), 0)
        seen[id(p)] = at + 1
        siblings = len(p.nodes) if p else 1
        if p:
            up[i] = up[p.order] + (0, 0)
        chars = n.chars
        out[i, :16] = (
            np.log1p(chars),
            chars / total,
            n.linked / max(1, chars),
            n.tags / (chars + 10),
            n.marks / max(1, chars),
            chars / max(1, n.blocks),
            n.depth,
            at / siblings,
            np.log1p(siblings),
            chars / max(1, p.chars if p else chars),
            before / total,
            good,
            bad,
            up[i, 0],
            up[i, 1],
            n.hidden,
        )
        out[i, 16 + _TAG_OF.get(n.tag, len(_TAGS))] = 1
        up[i] += (good > 0, (bad > 0) | n.hidden)
        before += chars - sum(c.chars for c in n.nodes)
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Kept nodes of the likeliest choice in which a kept node's ancestors are kept."""
    keep = -np.logaddexp(0, -odds)  # log probability of main text
    drop = -np.logaddexp(0, odds)
    keep[0] = 0.0
    for n in reversed(nodes[1:]):
        i, p = n.order, n.parent.order
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = np.zeros(len(nodes), bool)
    kept[0] = True
    for n in nodes[1:]:
        kept[n.order] = kept[n.parent.order] and keep[n.order] > drop[n.order]
    return kept


def text_of(nodes: list[Node], kept: np.ndarray) -> str:
    """Text of the kept nodes in page order; the edges of a node are white space."""
    out: list[str] = []
    stack: list = [nodes[0]]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif kept[part.order]:
            stack.append(" ")
            stack.extend(reversed(part.parts))
            stack.append(" ")
    return " ".join("".join(out).split())


_WORD_LISTS = (["article"], ["main"], ["div", "content"], ["div", "post"], ["div", "entry-content"], ["section", "story"], ["div", "article-body"], ["div", ""], ["td", ""], ["section", ""])


def build_page(blocks: list[str], seed: int) -> str:
    """A page with known main text, from the text blocks of another: its words also fill everything else."""
    rng = random.Random(seed)
    words = " ".join(blocks).split() or ["text"]

    def some(low: int, high: int) -> str:
        at = rng.randrange(len(words))
        n = rng.randint(low, high)
        return escape(" ".join((words + words)[at : at + n]))

    def links(tag: str, attrs: str = "") -> str:
        items = "".join(f'<li><a href="/{i}">{some(1, 3)}</a></li>' for i in range(rng.randint(3, 9)))
        return f"<{tag}{attrs}><ul>{items}</ul></{tag}>"

    def bare_links(tag: str, attrs: str = "") -> str:
        gap = rng.choice([" ", " | ", "<br>"])
        return f"<{tag}{attrs}>{gap.join(f'<a href="/{i}">{some(1, 3)}</a>' for i in range(rng.randint(2, 7)))}</{tag}>"

    def named(choices: str) -> str:
        return f' {rng.choice(["class", "id"])}="{rng.choice(choices.split())}"'

    def paragraphs(low: int, high: int) -> str:
        return "".join(f"<p>{some(4, 60)}</p>" for _ in range(rng.randint(low, high)))

    def comments() -> str:
        one = lambda: f'<div{named("comment reply comment-body")}><p><b>{some(1, 2)}</b></p><p>{some(5, 50)}</p></div>'
        tag = rng.choice(["section", "div"])
        return f'<{tag}{named("comments comment-list discussion responses-comments")}><h3>{some(1, 3)}</h3>{"".join(one() for _ in range(rng.randint(1, 5)))}</{tag}>'

    def form() -> str:
        return f'<form{named("search newsletter signup login")}><label>{some(1, 5)}</label><input name="q"><p>{some(3, 12)}</p></form>'

    before = [
        lambda: links("nav"),
        lambda: links("div", named("menu navbar nav breadcrumb")),
        lambda: links("ul", named("menu navigation breadcrumbs")),
        lambda: bare_links("div", named("top-bar navbar menu links")),
        lambda: bare_links("div"),
        lambda: bare_links("nav"),
        lambda: f"<header><p>{some(2, 8)}</p>{links('nav')}</header>",
        lambda: f'<div{named("header masthead banner site-header")}>{some(2, 9)}</div>',
        lambda: f'<div{named("cookie-notice consent notice alert cookie-banner")}><p>{some(6, 30)}</p></div>',
        lambda: f'<div{named("ad ads advert sponsored promo")}>{some(4, 30)}</div>',
        form,
    ]
    after = [
        comments,
        comments,
        lambda: f"<aside>{paragraphs(1, 3)}</aside>",
        lambda: f"<aside{named('sidebar related widget')}><h4>{some(1, 3)}</h4>{links('div')}</aside>",
        lambda: f'<div{named("sidebar rail widget related")}><h4>{some(1, 3)}</h4>{paragraphs(1, 3)}</div>',
        lambda: f'<div{named("share social newsletter subscribe")}><p>{some(3, 20)}</p></div>',
        lambda: f'<div{named("ad advert sponsor promo")}><p>{some(4, 40)}</p></div>',
        form,
        lambda: f'<footer><p>{some(3, 20)}</p>{links("div")}</footer>',
        lambda: f"<footer>{some(3, 30)}</footer>",
        lambda: f'<div{named("footer copyright legal site-footer")}>{some(3, 20)}</div>',
        lambda: f"<div hidden><p>{some(3, 30)}</p></div>",
    ]
    inside = [
        lambda: f'<div{named("ad advert promo sponsored")}>{some(3, 30)}</div>',
        lambda: f'<aside><p>{some(3, 25)}</p></aside>',
        lambda: f'<div{named("share social related")}>{links("div")}</div>',
    ]
    main = []
    for i, block in enumerate(blocks):
        tag = "h1" if i == 0 else rng.choice(["h2", "li"]) if len(block) < 60 and rng.random() < 0.2 else rng.choices(["p", "blockquote", "div"], [12, 1, 1])[0]
        shown = escape(block) if rng.random() < 0.9 else f'<a href="#">{escape(block[:20])}</a>{escape(block[20:])}'
        made = f'<{tag} data-known="main">{shown}</{tag}>'
        main.append(f"<ul>{made}</ul>" if tag == "li" else made)
        if rng.random() < 0.08:
            main.append(rng.choice(inside)())
    tag, *name = rng.choice(_WORD_LISTS)
    attrs = f' {rng.choice(["class", "id"])}="{name[0]}"' if name and name[0] else ""
    body = f"<{tag}{attrs}>{''.join(main)}</{tag}>"
    if tag == "td":
        body = f"<table><tr>{bare_links('td') if rng.random() < 0.5 else ''}{body}<td{named('sidebar menu widget')}>{paragraphs(1, 2)}</td></tr></table>"
    elif rng.random() < 0.3:
        body = f'<div class="{rng.choice(["page", "wrap", "container", "layout"])}">{body}{rng.choice(after)()}</div>'
    bare = rng.random() < 0.1
    parts = [f() for f in rng.sample(before, 0 if bare else rng.randint(1, 4))] + [body]
    parts += [f() for f in rng.sample(after, 0 if bare else rng.randint(1, 5))]
    return f"<html><head><title>{some(2, 8)}</title></head><body>{''.join(parts)}</body></html>"


def _own_blocks(nodes: list[Node]) -> list[str]:
    """Texts of the nodes without child nodes and with few links."""
    alone = [n for n in nodes if not n.nodes and n.chars and n.linked * 2 < n.chars]
    texts = (" ".join("".join(p for p in n.parts if isinstance(p, str)).split()) for n in alone)
    return [t for t in texts if t]


def examples_of(page: str, seed: int, variants: int) -> Iterator[list[Node]]:
    nodes = parse(page)
    marked = [n for n in nodes if n.tag in ("article", "main")]
    if marked:
        for n in marked:
            stack = [n]
            while stack:
                m = stack.pop()
                m.main = True
                stack.extend(c for c in m.nodes if c.tag not in ("nav", "aside", "footer", "form"))
        for n in reversed(nodes):
            if n.main and n.parent:
                n.parent.main = True
        yield nodes
    blocks = _own_blocks(marked[0:1] and [n for n in nodes if n.main] or nodes)
    if blocks:
        rng = random.Random(seed)
        for v in range(variants):
            # articles of every length, down to one block of a few words
            some = blocks if v == 0 else blocks[: rng.choice([1, 2, 4, 12])]
            if v % 2:
                some = [" ".join(b.split()[: rng.choice([3, 6, 12, 1000])]) for b in some]
            yield parse(build_page(some, seed * 31 + v))


def _examples(variants: int):
    """Arrow map over (draw, html): features and label of the nodes of training pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for draw, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for nodes in examples_of(page or "", draw, variants):
                    rows = features(nodes)[1:]
                    if len(rows):
                        label = pa.array([int(n.main) for n in nodes[1:]], pa.int32())
                        values = pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), N_FEATURES).cast(pa.list_(pa.float64()))
                        yield pa.RecordBatch.from_arrays([label, values], names=["label", "values"])

    return run


def trees_of(description: str) -> list[list[tuple]]:
    """Nodes (feature, threshold, left, right, value) of the trees in a model's description; leaves have feature -1."""
    trees: list[list[tuple]] = []
    weights: list[float] = []
    path: list[tuple[int, int]] = []  # (depth, node)
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        word = line.strip()
        if m := re.match(r"Tree \d+ \(weight ([-\d.eE]+)\)", word):
            trees.append([])
            weights.append(float(m[1]))
            path = []
        elif trees and (m := re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", word)):
            at = len(trees[-1])
            trees[-1].append([int(m[1]), float(m[2]), -1, -1, 0.0])
            _attach(trees[-1], path, at)
            path.append((depth, at))
        elif trees and word.startswith("Else"):
            while path[-1][0] > depth:
                path.pop()
        elif trees and (m := re.match(r"Predict: ([-\d.eE]+)", word)):
            at = len(trees[-1])
            trees[-1].append([-1, 0.0, at, at, weights[-1] * float(m[1])])
            _attach(trees[-1], path, at)
    return trees


def _attach(tree: list, path: list, at: int) -> None:
    while path and tree[path[-1][1]][3] >= 0:
        path.pop()
    if path:
        parent = tree[path[-1][1]]
        parent[2 if parent[2] < 0 else 3] = at


def margins(trees: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Log-odds of main text: twice the boosted sum."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for tree in trees:
        at = np.zeros(len(rows), np.int64)
        for _ in range(DEPTH):
            feature = tree[at, 0].astype(np.int64)
            left = rows[every, np.maximum(feature, 0)] <= tree[at, 1]
            at = np.where(left, tree[at, 2], tree[at, 3]).astype(np.int64)
        total += tree[at, 4]
    return 2 * total


def train(pages: DataFrame, html: str = "html", sample_pages: int = SAMPLE_PAGES, variants: int = VARIANTS) -> list[np.ndarray]:
    """Boosted trees fitted on nodes of about ``sample_pages`` pages at most; empty if nothing can be learnt."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    n = pages.count()
    parts = 1 << 30
    drawn = pages.select(F.pmod(F.xxhash64(html), F.lit(parts)).alias("draw"), F.col(html).alias("html")).filter("html != ''")
    drawn = drawn if n <= sample_pages else drawn.filter(F.col("draw") < int(parts * sample_pages / n))
    nodes = freeze(drawn.mapInArrow(_examples(variants), "label int, values array<double>").coalesce(8), "nodes")
    if nodes.agg(F.countDistinct("label")).first()[0] < 2:
        return []
    rows = nodes.select(F.col("label").cast("double").alias("label"), array_to_vector("values").alias("features"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=32).fit(rows)
    return [np.array(t, dtype=np.float64) for t in trees_of(model.toDebugString)]


def extractor(spark, trees: list[np.ndarray]):
    """Column function from a page to its main text."""
    sent = spark.sparkContext.broadcast(trees)

    def extract(column: pa.Array) -> pa.Array:
        out: list[str] = []
        for low in range(0, len(column), 64):
            parsed = [parse(page or "") for page in column.slice(low, 64).to_pylist()]
            odds = margins(sent.value, np.concatenate([features(nodes) for nodes in parsed]))
            at = 0
            for nodes in parsed:
                out.append(text_of(nodes, decode(nodes, odds[at : at + len(nodes)])))
                at += len(nodes)
        return pa.array(out, pa.string())

    return F.arrow_udf(extract, ST.StringType())
