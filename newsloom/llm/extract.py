"""Main text of web pages by minimum cuts.

A page is read into blocks: runs of text between block-level tags, in page
order, each with its containers. A classifier gives every block a cost for being
content and one for being boilerplate: the log odds of a linear discriminant
over the block's own text, learned from blocks in containers that say what they
are, plus fixed evidence from those containers. The costs are the capacities to
the two terminals of a flow network, and edges between neighbours in the page
and in the DOM make it dear to separate them. The minimum cut is the labelling.

Blocks whose costs outweigh all their edges are settled first, which is exact;
the flow only runs over what is left, usually nothing.

Defined cases: a null or empty page has an empty text; unclosed and stray tags
are repaired as browsers do roughly (a block tag ends a paragraph); an unclosed
comment or script runs to the end of the page; a closed svg, button or select is
left out, and of one that closes itself or is never closed only the tag; formulas
are text, their annotations are not; object holds markup; references without a semicolon
are decoded where HTML allows it; equal rows are extracted alike; an empty
table gives no rows; further columns stay as they are, but for ``text`` and
``n_chars``, which are replaced.
"""

import html as entities
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the HTML standard, and words in class, id and role
# attributes that commonly mark a container.
RAW = "script style noscript template textarea title iframe annotation annotation-xml".split()
LABELS = "svg button select".split()  # dropped where they are closed, no text of the article
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var img wbr svg button select "
    "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt "
    "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
CONTENT_TAGS = frozenset(["article", "main"])
BOILERPLATE_TAGS = frozenset("nav footer aside form header menu dialog fieldset canvas".split())
CONTENT_WORDS = frozenset("article articlebody content entry main post story".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer footer form header legal menu modal nav navbar navigation newsletter notice pager pagination popup "
    "promo related replies reply search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)

PAGE_TAGS = frozenset(["html", "body"])  # their names speak of the page, not of its text
# containers of other texts than the page's own, which a nested article does not outweigh
OTHER_TAGS = frozenset("nav footer aside menu dialog".split())
COMMENT_WORDS = frozenset("comment comments replies reply".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement footer nav navbar navigation promo related sidebar sponsor sponsored".split()
)

# evidence of the containers
IN_CONTENT, IN_BOILERPLATE, IN_OTHER, IN_COMMENTS, HIDDEN = 4.0, -9.0, -10.0, -12.0, -20.0
TEXT_LIMIT = 2.0  # the text alone says no more than this, either way
NEXT_TO, SAME_PARENT = 0.5, 0.5  # smoothness of neighbours in the page and in the DOM
SCALE = 1000  # capacities are whole numbers

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<label>" + "|".join(LABELS) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<!/)>"
    r"(?:[^<]|<(?!/?(?P=label)[\s/>]))*+</(?P=label)\s*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
NAMES = re.compile(r"[a-z0-9]+")
# what a name says of something else: no-sidebar, page-with-comments
MODIFIER = re.compile(r"(?<![a-z0-9])(?:has|no|not|with|without|hide)[-_]\S*")


def _evidence(tag, attrs, inherited, on_page=False):
    """What a container adds to what its own containers say. ``on_page`` is set
    if nothing but the page itself holds it: a form there may be all of the page."""
    if tag in PAGE_TAGS:
        return inherited
    found = {}
    if attrs and "=" in attrs or "hidden" in attrs:
        found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attrs)}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return HIDDEN
    said = " ".join(found.get(k, "") for k in ("class", "id", "role", "itemprop"))
    names = set(NAMES.findall(MODIFIER.sub("", said)))
    if tag == "form" and on_page:
        tag, names = "", names - {"form"}
    if names & COMMENT_WORDS:
        return min(inherited, IN_COMMENTS)
    if tag in OTHER_TAGS or names & OTHER_WORDS:
        return min(inherited, IN_OTHER)
    if tag in BOILERPLATE_TAGS and not (tag == "header" and inherited > 0) or names & BOILERPLATE_WORDS:
        return min(inherited, IN_BOILERPLATE)
    outweighed = {"main": IN_OTHER, "article": IN_BOILERPLATE}.get(tag, 0)
    if (tag in CONTENT_TAGS or names & CONTENT_WORDS) and outweighed <= inherited <= 0:
        return IN_CONTENT
    return inherited


class Block:
    """A run of text: its evidence, parent and the characters inside links."""

    __slots__ = ("text", "evidence", "parent", "linked", "kind")

    def __init__(self, text, evidence, parent, linked, kind):
        self.text, self.evidence, self.parent, self.linked, self.kind = text, evidence, parent, linked, kind


def blocks(page: str):
    """The blocks of a page, in page order."""
    out, pieces = [], []
    stack = [("", 0.0, 0, False)]  # tag, evidence, number of the block-level element, inside a link
    number, linked = 0, 0

    def flush():
        nonlocal linked
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            tag = next((t for t, *_ in reversed(stack) if t not in INLINE), "")
            holder = next((k for t, _, k, _ in reversed(stack) if t not in INLINE and t != "p"), 0)
            out.append(Block(text, min(stack[-1][1], IN_CONTENT), holder, linked, tag))
        pieces.clear()
        linked = 0

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text = page[at:m.start()]
            pieces.append(text)
            if stack[-1][3]:
                linked += len(text.strip())
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        if m["end"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), None)
            if depth is not None:
                del stack[depth:]
        elif tag not in VOID and not m["attrs"].endswith("/"):
            if tag not in INLINE:
                # a block ends an open paragraph, and an item the item before it
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p" or stack[i][0] == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                        del stack[i:]
                        break
                    if stack[i][0] not in INLINE:
                        break
                number += 1
            top = stack[-1]
            stack.append((tag, _evidence(tag, m["attrs"], top[1], top[0] == "" or top[0] in PAGE_TAGS), number if tag not in INLINE else top[2],
                          top[3] or tag == "a"))
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return out


N_FEATURES = 5


def features(block: Block):
    """Transformed statistics of a block's own text."""
    n = len(block.text)
    words = block.text.count(" ") + 1
    stops = sum(map(block.text.count, ".,;:!?"))
    return [
        float(np.log1p(words)), float(np.log((stops + 0.5) / (words + 0.5))), block.linked / n if n else 0.0,
        float(np.log(n / words)), float(block.kind in ("li", "td", "th", "dt", "dd", "option")),
    ]


def _block_moments(texts):
    """Sums over blocks with outspoken containers: (content or not, moments)."""
    total = np.zeros((2, 1 + N_FEATURES + N_FEATURES ** 2))
    for page in texts:
        for block in blocks(page.as_py() or ""):
            if block.evidence != 0 and block.evidence != HIDDEN:
                x = np.array(features(block))
                total[int(block.evidence > 0)] += np.concatenate([[1.0], x, np.outer(x, x).ravel()])
    return total


def learn(pages: DataFrame, html="html"):
    """Weights and constant of the discriminant, from all pages; zeros where one
    kind of block does not occur. Only sums come to the driver."""

    def run(batches):
        total = sum((_block_moments(batch.column(0)) for batch in batches), np.zeros((2, 1 + N_FEATURES + N_FEATURES ** 2)))
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["i", "x"])

    rows = pages.select(F.col(html)).mapInArrow(run, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x"))
    flat = np.zeros(2 * (1 + N_FEATURES + N_FEATURES ** 2))
    for row in rows.collect():
        flat[row["i"]] = row["x"]
    return discriminant(flat.reshape(2, -1))


def discriminant(moments):
    n = moments[:, 0]
    if min(n) < 1:
        return np.zeros(N_FEATURES), 0.0
    means = moments[:, 1:1 + N_FEATURES] / n[:, None]
    squares = moments[:, 1 + N_FEATURES:].reshape(2, N_FEATURES, N_FEATURES)
    within = sum(squares[k] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)) / n.sum()
    weights = np.linalg.solve(within + 0.01 * np.eye(N_FEATURES), means[1] - means[0])
    return weights, float(-weights @ (means[0] + means[1]) / 2)


def _edges(page_blocks):
    """(i, j, weight): neighbours in the page, dearer to part in one container."""
    last = {}
    for i, block in enumerate(page_blocks):
        before = last.get(block.parent)
        if before is not None and before != i - 1:
            yield before, i, SAME_PARENT
        if i:
            yield i - 1, i, NEXT_TO + (SAME_PARENT if before == i - 1 else 0.0)
        last[block.parent] = i


def minimum_cut(costs, edges):
    """True for each node on the content side. ``costs`` are log odds for content;
    of several minimum cuts, the one with the fewest content blocks."""
    n = len(costs)
    cost = [round(c * SCALE) for c in costs]
    near = [{} for _ in range(n)]
    for i, j, weight in edges:
        w = round(weight * SCALE)
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    label = [None] * n
    ready = deque(range(n))
    while ready:  # a settled block turns its edges into costs of its neighbours
        i = ready.popleft()
        if label[i] is not None:
            continue
        bound = sum(near[i].values())
        if cost[i] > bound or cost[i] <= -bound:
            label[i] = cost[i] > bound
            for j, w in near[i].items():
                cost[j] += w if label[i] else -w
                del near[j][i]
                ready.append(j)
            near[i] = {}
    open_nodes = [i for i in range(n) if label[i] is None]
    if open_nodes:
        side = _flow(open_nodes, cost, near)
        for i in open_nodes:
            label[i] = i in side
    return label


def _flow(nodes, cost, near):
    """The nodes that stay reachable from the content terminal after a maximum
    flow, found by shortest augmenting paths in layers."""
    source, sink = -1, -2
    rest = {i: dict(near[i]) for i in nodes}
    rest[source], rest[sink] = {}, {}
    for i in nodes:
        if cost[i] > 0:
            rest[source][i] = cost[i]
            rest[i][source] = 0
        elif cost[i] < 0:
            rest[i][sink] = -cost[i]
            rest[sink][i] = 0
    while True:
        layer, queue = {source: 0}, deque([source])
        while queue:
            i = queue.popleft()
            for j, room in rest[i].items():
                if room and j not in layer:
                    layer[j] = layer[i] + 1
                    queue.append(j)
        if sink not in layer:
            return layer.keys() - {source}
        ways = {i: iter(list(rest[i])) for i in layer}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                steps = list(zip(path, path[1:]))
                amount = min(rest[a][b] for a, b in steps)
                for a, b in steps:
                    rest[a][b] -= amount
                    rest[b][a] = rest[b].get(a, 0) + amount
                cut = next(k for k, (a, b) in enumerate(steps) if not rest[a][b])
                del path[cut + 1:]
                continue
            j = next((j for j in ways[i] if rest[i][j] and layer.get(j) == layer[i] + 1), None)
            if j is None:
                path.pop()
            else:
                path.append(j)


def main_text(page: str, weights, constant) -> str:
    found = blocks(page)
    if not found:
        return ""
    x = np.array([features(b) for b in found])
    own = np.clip(x @ weights + constant, -TEXT_LIMIT, TEXT_LIMIT)
    costs = own + np.array([b.evidence for b in found])
    kept = minimum_cut(costs.tolist(), _edges(found))
    return "\n".join(b.text for b, content in zip(found, kept) if content)


def extracted(html: Column, model) -> Column:
    weights, constant = model

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "", weights, constant) for p in pages], pa.string())

    return run(html)


def extract(pages: DataFrame, html="html") -> DataFrame:
    """``pages`` without the markup, with ``text`` and its length ``n_chars``."""
    model = learn(pages, html)
    others = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "text", "n_chars")]
    out = pages.select(*others, extracted(F.col(html), model).alias("text"))
    return out.select("*", F.length("text").cast("bigint").alias("n_chars"))


def query(spark, sf_dir) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
