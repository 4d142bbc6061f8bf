"""Main text of HTML pages by a tree-structured graphical model.

Every block element has a hidden label: most of its text is content, or not. Potentials of elements come from
their tag, names, lengths and links, potentials of edges from the labels of parent and child. Sum-product messages up
and down the tree give each element's marginal, and text whose element is content more likely than not is kept.

The potentials are trained on labelled pages: a few written for the purpose (PAGES, ``data-content`` marks content) and a
bounded sample of the table's own pages whose <article> or <main> labels them.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tunequorum.llm.dom import Node, parse

#: Training takes at most so many pages of the table, of at most so many characters each.
SAMPLE_PAGES = 400
SAMPLE_CHARS = 100_000
#: What a written page counts for, and what all sampled pages together count for.
WRITTEN_WEIGHT = 20
SAMPLE_WEIGHT = 20

#: Words in class, id, role or label attributes that hint at the one or the other.
AWAY = frozenset(
    "ad ads advert adverts advertisement adverting advertising banner sponsor sponsored sponsors promo promotion promotions nav navbar navigation navlinks menu "
    "menubar submenu breadcrumb breadcrumbs header masthead topbar toolbar footer foot bottom contentinfo sidebar aside complementary widget "
    "widgets rail cookie cookies consent gdpr notice notices alert alerts popup modal dialog overlay newsletter subscribe subscription signup login "
    "register form search searchbox comment comments commentlist disqus reply replies respond discussion responses reviews share sharing social follow related recommended recommendations "
    "recommend popular trending more tags tagcloud pagination pager copyright legal disclaimer hidden skip toc outbrain taboola survey poll paywall".split()
)
TOWARDS = frozenset("article articlebody content post entry main story body text prose hentry blogpost page single".split())
TAGS = frozenset("article main section div p h ul ol li nav aside header footer form table tr blockquote pre figure figcaption body html address details dialog menu search dl dt dd fieldset legend".split())
AWAY_TAGS = frozenset("nav aside form footer".split())
PAGES = [
    """<html><body><header class="site-header"><div class="logo">Daily Paper</div><nav class="menu"><ul><li><a href="/">Home</a></li>
    <li><a href="/n">News</a></li></ul></nav></header><div class="cookie-notice" role="dialog"><p>We use cookies to improve this site. Please accept them
    to go on.</p></div><main><article><header data-content><h1 data-content>A long walk</h1></header><p data-content>They went out before dawn and walked along
    the river until the fog had lifted from the fields and the town lay behind.</p><p data-content>Nobody spoke.</p><ul data-content><li data-content>Bread</li><li data-content>Water and a map
    of the hills</li></ul><blockquote data-content><p data-content>It was further than we had thought.</p></blockquote><div class="ad"><p>Buy two
    pairs of boots and get the third for half of the price.</p></div></article></main><aside class="sidebar"><h3>Popular</h3><ul><li><a href="/1">Ten hills to climb before the year is out</a></li></ul></aside>
    <section id="comments" class="comments"><h3>Comments</h3><div class="comment"><p>I liked this very much and have walked there myself, many years ago, with my brother.</p></div></section>
    <form class="newsletter"><p>Sign up and get our letter every week.</p></form><footer><p>Copyright by the Daily Paper. All rights reserved.</p></footer></body></html>""",
    """<html><body><div id="top"><div class="navbar"><a href="/">Start</a> <a href="/b">Blog</a></div></div><div id="wrapper"><div class="post-content">
    <h1 data-content>How to bake</h1><p data-content>Mix flour and water, and let the dough rest for a night in a cold place before you shape it.</p><div data-content>Heat the oven as far as it goes.</div>
    <table data-content><tr data-content><td>Flour</td><td>500 g</td></tr></table><pre data-content>mix; rest; bake</pre></div><div class="related"><h4>More like this</h4><p><a href="/c">Cakes without sugar and how they are made at home</a></p></div>
    <div class="comment-list"><div class="comment-body"><p>Mine did not rise at all. What could have gone wrong? I did all as it says above.</p></div></div>
    <div class="share"><a href="#">Share</a></div></div><div class="footer"><div>About us, terms and privacy. We answer letters within two days.</div></div></body></html>""",
    """<html><body><nav><ul><li><a href="/x">Index</a></li></ul></nav><div class="alert">This site will be down for work on Sunday night.</div><div class="content"><h2 data-content>Notes</h2>
    <p data-content>The second part of the report deals with the harbour, which was rebuilt twice in ten years.</p><p data-content>See <a href="/m">the map</a> for the old line of the wall and its towers.</p><aside><p>Advertisement: hotels by the sea for less money.</p></aside>
    <section data-content><h3 data-content>Sources</h3><p data-content>Letters of the council.</p></section></div><form><label>Name</label><p>Leave a reply with your name and address.</p></form><footer><address>Harbour Road 1</address></footer></body></html>""",
]


def features(node: Node) -> list[str]:
    tag = "h" if node.tag[0] == "h" and node.tag[1:].isdigit() else node.tag
    share = node.link_chars / max(1, node.text_chars)
    context = " of links" if share > 0.5 else " in article" if node.inner and tag in ("header", "footer") else ""
    found = [f"tag:{tag if tag in TAGS else 'other'}{context}"]
    found += ["away"] * any(w in AWAY for w in node.hints) + ["towards"] * any(w in TOWARDS for w in node.hints)
    if node.own_chars:
        found.append(f"own:{sum(node.own_chars >= limit for limit in (20, 80))}")
        found.append("sentence" if node.last_char in ".!?…" else "no sentence")
    found.append(f"links:{sum(share > limit for limit in (0, 0.2, 0.5))}")
    return found


def labels_of(nodes: list[Node], inside: list[bool]) -> list[bool]:
    """Whether most of an element's text lies in elements of its own or below that are ``inside`` the content."""
    good = [n.own_chars * i for n, i in zip(nodes, inside)]
    for k in range(len(nodes) - 1, 0, -1):
        good[nodes[k].parent] += good[k]
    return [2 * g > n.text_chars for g, n in zip(good, nodes)]


def marked(nodes: list[Node]) -> list[bool]:
    return labels_of(nodes, [n.marked for n in nodes])


def weakly_labelled(nodes: list[Node]) -> list[bool] | None:
    """Labels from the only <article>, else the only <main>; None where there is no such element. Inside it,
    elements that are away from the content by tag or name are not content, nor is what they hold."""
    for tag in ("article", "main"):
        roots = [k for k, n in enumerate(nodes) if n.tag == tag]
        if len(roots) == 1:
            inside = [False] * len(nodes)
            for k, n in enumerate(nodes):
                away = n.tag in AWAY_TAGS or any(w in AWAY for w in n.hints)
                inside[k] = k == roots[0] or (n.parent >= 0 and inside[n.parent] and not away)
            return labels_of(nodes, inside)
    return None


def edge_kinds(nodes: list[Node]) -> list[int]:
    """1 for elements below something that is away from the content by tag or name, else 0."""
    kinds = [0] * len(nodes)
    for k, node in enumerate(nodes[1:], 1):
        above = nodes[node.parent]
        page_header = above.tag == "header" and not above.inner
        kinds[k] = int(kinds[node.parent] or page_header or above.tag in AWAY_TAGS or any(w in AWAY for w in above.hints))
    return kinds


class TreeModel:
    """Log-odds of features, and log-potentials of (parent, child) labels for each kind of edge; trained by counting,
    with one added to each."""

    def __init__(self):
        self.seen = [Counter(), Counter()]
        self.total = [0.0, 0.0]
        self.edges = [[[1.0, 1.0], [1.0, 1.0]] for _ in range(2)]

    def learn(self, nodes: list[Node], labels: list[bool], weight: float = 1.0) -> None:
        for node, label, kind in zip(nodes, labels, edge_kinds(nodes)):
            if not node.text_chars:
                continue
            self.total[label] += weight
            for f in features(node):
                self.seen[label][f] += weight
            if node.parent >= 0:
                self.edges[kind][labels[node.parent]][label] += weight

    def finish(self) -> TreeModel:
        names = set(self.seen[0]) | set(self.seen[1])
        self.odds = {f: math.log((self.seen[1][f] + 1) / (self.total[1] + 2)) - math.log((self.seen[0][f] + 1) / (self.total[0] + 2)) for f in names}
        self.pair = [[[math.log(x / sum(row)) for x in row] for row in table] for table in self.edges]
        return self

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content of each element: messages from the leaves to the root, then back."""
        n, tables = len(nodes), [self.pair[kind] for kind in edge_kinds(nodes)]
        own = [(0.0, sum(self.odds.get(f, 0.0) for f in features(node))) for node in nodes]
        up = [list(o) for o in own]  # log-potential of an element together with all below it
        sent: list[tuple[float, float]] = [(0.0, 0.0)] * n
        for k in range(n - 1, 0, -1):
            (a, b), pair = up[k], tables[k]
            sent[k] = (_log_add(pair[0][0] + a, pair[0][1] + b), _log_add(pair[1][0] + a, pair[1][1] + b))
            parent = up[nodes[k].parent]
            parent[0] += sent[k][0]
            parent[1] += sent[k][1]
        down = [(0.0, 0.0)] * n  # what the rest of the tree says of an element
        result = [0.0] * n
        for k in range(n):
            if k:
                p, pair = nodes[k].parent, tables[k]
                rest = (down[p][0] + up[p][0] - sent[k][0], down[p][1] + up[p][1] - sent[k][1])
                low = min(rest)
                rest = (rest[0] - low, rest[1] - low)
                down[k] = (_log_add(rest[0] + pair[0][0], rest[1] + pair[1][0]), _log_add(rest[0] + pair[0][1], rest[1] + pair[1][1]))
            odds = down[k][1] + up[k][1] - down[k][0] - up[k][0]
            result[k] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
        return result


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def train(sample: list[str]) -> TreeModel:
    model = TreeModel()
    for page in PAGES:
        nodes, _ = parse(page)
        model.learn(nodes, marked(nodes), WRITTEN_WEIGHT)
    parsed = [nodes for nodes, _ in map(parse, sample)]
    labelled = [(nodes, labels) for nodes in parsed if (labels := weakly_labelled(nodes)) is not None]
    for nodes, labels in labelled:
        model.learn(nodes, labels, SAMPLE_WEIGHT / len(labelled))
    return model.finish()


def main_text(html: str | None, model: TreeModel) -> str:
    """Blocks of content, white space made single, in page order, joined by a line feed."""
    nodes, blocks = parse(html)
    content = model.marginals(nodes)
    return "\n".join(text for k, text in blocks if content[k] > 0.5)


def training_sample(pages: DataFrame, html_col: str = "html") -> list[str]:
    """At most SAMPLE_PAGES different pages of at most SAMPLE_CHARS characters: those with the least hashes.

    Hashes alone are sorted; only the chosen pages are then fetched, one for each hash.
    """
    short = pages.where(F.length(html_col) <= SAMPLE_CHARS).select(F.xxhash64(html_col).alias("hash"), F.col(html_col).alias("html"))
    last = short.select("hash").distinct().orderBy("hash").limit(SAMPLE_PAGES).agg(F.max("hash")).first()[0]
    if last is None:
        return []
    chosen = short.where(F.col("hash") <= last).groupBy("hash").agg(F.min("html").alias("html"))
    return [r.html for r in chosen.orderBy("hash").collect()]


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: TreeModel | None = None
) -> DataFrame:
    """(id_col, url_col, text, n_chars): one row for each row of ``pages``; null or empty pages have an empty text.

    The model is trained on a sample of ``pages`` unless given. Repeated rows and ids each get their row; an empty table
    gives none; other columns are not read. A page of any length is parsed in one pass.
    """
    model = train(training_sample(pages, html_col)) if model is None else model

    @F.arrow_udf("string")
    def text(html: pa.Array) -> pa.Array:
        return pa.array([main_text(h.as_py(), model) for h in html], pa.string())

    return pages.select(F.col(id_col), F.col(url_col), text(F.col(html_col)).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
