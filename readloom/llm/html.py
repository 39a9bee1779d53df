"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a variable, content or not. Its potential comes from what can be seen of it (name, hints in
class, id and role, length, share of linked text, punctuation); parent and child are tied by another potential.
The page itself counts as content. Messages pass from the leaves up and from the root down (sum-product), which gives every block's marginal.
Blocks of text whose element is more likely content than not make up the text, in page order.

Potentials are counts from labelled pages: layouts labelled by hand below, and a bounded sample of the corpus whose
elements name their own role (article, nav, footer ...). Each page is handled alone, so nothing but counts shuffles.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import exp, log

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import text_of

SAMPLE = 1000   # pages of the corpus a model is trained on at most
SMOOTH = 0.5
HAND_WEIGHT = 200  # how often a page labelled by hand counts, so that rare elements are not drowned

# Fixed values of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template svg math iframe object canvas select datalist textarea title head audio video "
                 "button".split())  # never text of a page
_VERBATIM = frozenset("script style iframe noscript textarea title".split())  # no markup inside
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark meter nobr output "
                    "progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                      "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SELF = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
         "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
         "option": ("option", ("select",))}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</\s*([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_HINTED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)

# Words in class, id and role that sites use by convention for what is not, or is, the article.
_AGAINST = frozenset("ad ads advert advertisement adsense banner promo promotion promoted sponsor sponsored nav navbar navigation menu "
                     "breadcrumb breadcrumbs sidebar side rail aside widget footer foot header masthead topbar toolbar comment comments "
                     "disqus reply replies respond discussion reader related recommended recommendation share sharing social follow subscribe "
                     "subscription newsletter signup login form search cookie cookies consent gdpr notice notices alert popup modal "
                     "overlay copyright legal disclaimer pagination pager tags complementary contentinfo".split())
_FOR = frozenset("article content main story post entry body text prose blog news".split())


class Node:
    __slots__ = ("name", "hint", "parent", "children", "texts", "size", "linked", "stops", "label", "given")

    def __init__(self, name: str, hint: str, parent):
        self.name, self.hint, self.parent = name, hint, parent
        self.children: list[Node] = []
        self.texts: list[tuple[int, list[str]]] = []  # blocks of own text with their place on the page
        self.size = self.linked = self.stops = 0
        self.label = self.given = None


def _hint(attributes: str) -> str:
    if "=" not in attributes:
        return ""
    words = {w for value in _HINTED.findall(attributes) for w in re.findall("[a-z]+", value.lower())}
    return "against" if words & _AGAINST else "for" if words & _FOR else "other" if words else ""


def parse(page: str) -> list[Node]:
    """Block elements of a page, parents first. End tags that are missing are implied as browsers do."""
    root = Node("body", "", None)
    nodes, stack, inline = [root], [root], []  # inline: open links
    links, blocks, open_block = 0, 0, None
    at, skip = 0, None
    find, size = _TOKEN.search, len(page)

    def text(raw: str) -> None:
        nonlocal blocks, open_block
        if not raw or (open_block is None and raw.isspace()):
            return
        node = stack[-1]
        value = unescape(raw) if "&" in raw else raw
        if open_block is None:
            open_block = []
            node.texts.append((blocks, open_block))
            blocks += 1
        open_block.append(value)
        n = len(value)
        node.size += n
        if links:
            node.linked += n
        node.stops += value.count(".") + value.count(",")

    while at < size:
        found = find(page, at)
        if found is None:
            text(page[at:])
            break
        if found.start() > at:
            text(page[at:found.start()])
        at = found.end()
        closing, opening = found.group(1), found.group(2)
        if opening:
            name = opening.lower()
            if name in _RAW:
                end = None
                if not found.group(3).rstrip().endswith("/"):
                    end = _end_of(name, page, at)
                at = end if end is not None else at
                continue
            if name in _INLINE:
                links += name == "a"
                if name == "br":
                    text(" ") if open_block is not None else None
                continue
            if name in _VOID:
                open_block = None
                continue
            open_block = None
            links = 0
            if name in ("html", "body"):
                continue
            if name in _CLOSES_P:
                _close(stack, ("p",), ("td", "th", "li", "div", "article", "section", "main", "table", "blockquote", "aside"))
            elif name in _SELF:
                names, stops = _SELF[name]
                _close(stack, names.split(), stops)
            node = Node(name, _hint(found.group(3)), stack[-1])
            stack[-1].children.append(node)
            stack.append(node)
            nodes.append(node)
        elif closing:
            name = closing.lower()
            if name in _INLINE:
                links -= name == "a" and links > 0
            elif name not in ("html", "body"):
                open_block = None
                links = 0
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == name:
                        del stack[k:]
                        break
    return nodes


def _end_of(name: str, page: str, at: int) -> int:
    """Behind the end tag of an element whose content is left out; nested elements of that name are counted."""
    pattern = _END.get(name)
    if pattern is None:
        pattern = _END[name] = re.compile(rf"<(/?){name}(?=[\s/>])[^>]*(?:>|\Z)" if name not in _VERBATIM
                                          else rf"<(/){name}(?=[\s/>])[^>]*(?:>|\Z)", re.I)
    depth = 1
    for found in pattern.finditer(page, at):
        depth += -1 if found.group(1) else 1
        if not depth:
            return found.end()
    return len(page) if name in _VERBATIM else at


_END: dict[str, re.Pattern] = {}


def _close(stack: list[Node], names, stops) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in stops:
            return


_BIG = re.compile(r"h[1-6]")


def features(node: Node) -> tuple[str, ...]:
    size = node.size
    kind = "h" if _BIG.fullmatch(node.name) else node.name
    if not size:
        return f"name {kind}", f"hint {node.hint}", "empty"
    length = min(8, size.bit_length() // 2)
    return (f"name {kind}", f"hint {node.hint}", f"length {length}", f"links {round(4 * node.linked / size)}",
            f"stops {min(3, node.stops)}")


class Model:
    """Log odds of what is seen on an element, and the chance that a child is content given its parent is or not."""

    def __init__(self, counts: dict[str, tuple[float, float]]):
        total = [sum(counts[k][i] for k in counts if k.startswith("name ")) + SMOOTH for i in (0, 1)]
        self.odds = {k: log((c[1] + SMOOTH) / total[1] / ((c[0] + SMOOTH) / total[0]))
                     for k, c in counts.items() if not k.startswith("edge ")}
        under = [counts.get(f"edge {i}", (0.0, 0.0)) for i in (0, 1)]
        self.edge = [(c[1] + SMOOTH) / (c[0] + c[1] + 2 * SMOOTH) for c in under]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Chance of being content per element, by messages up and down the tree."""
        q0, q1 = self.edge
        place = {id(node): k for k, node in enumerate(nodes)}
        odds = self.odds
        parents = [place[id(node.parent)] if node.parent is not None else -1 for node in nodes]
        own = [sum([odds.get(f, 0.0) for f in features(node)]) for node in nodes]
        own[0] = 1e9  # the page as a whole holds the article
        up = [0.0] * len(nodes)  # log ratio of the message to the parent
        belief = own[:]
        for k in range(len(nodes) - 1, 0, -1):  # children come after their parents
            r = exp(max(-40.0, min(40.0, belief[k])))
            up[k] = log((q1 * r + 1 - q1) / (q0 * r + 1 - q0))
            belief[parents[k]] += up[k]
        for k in range(1, len(nodes)):
            rest = belief[parents[k]] - up[k]
            r = exp(max(-40.0, min(40.0, rest)))
            belief[k] += log((q1 * r + q0) / ((1 - q1) * r + 1 - q0))
        return [1 / (1 + exp(-max(-40.0, min(40.0, b)))) for b in belief]


def extract(page: str, model: Model) -> str:
    """Blocks of the elements that are content, white space made one blank, parted by an empty line."""
    nodes = parse(page)
    chances = model.marginals(nodes)
    blocks = [(place, parts) for node, p in zip(nodes, chances) if p > 0.5 for place, parts in node.texts]
    blocks.sort(key=lambda x: x[0])
    lines = (" ".join("".join(parts).split()) for _, parts in blocks)
    return "\n\n".join(x for x in lines if x)


# Names that tell an element's role in corpus pages, for the sampled part of the training.
_ROLE = {"article": 1, "main": 1, "nav": 0, "footer": 0, "aside": 0, "form": 0, "header": 0, "menu": 0, "dialog": 0}


def _labels(nodes: list[Node], by_hand: bool) -> None:
    """Labels of elements from their role or hint, handed down; elements without one stay out, unless they hold content.

    A hint for content is trusted in the layouts only.
    """
    for node in nodes:
        over = node.parent.label if node.parent is not None else None
        own = 0 if node.hint == "against" else _ROLE.get(node.name, 1 if by_hand and node.hint == "for" else over)
        node.label = 0 if over == 0 else own
    for node in reversed(nodes):
        if node.label is None and any(c.label == 1 for c in node.children):
            node.label = 1


def count_page(page: str, weight: float = 1.0, by_hand: bool = False) -> Counter:
    """Counts of (feature, label) and of labels of children given their parents' from a page that labels itself."""
    nodes, out = parse(page), Counter()
    _labels(nodes, by_hand)
    for node in nodes:
        if node.label is None:
            continue
        for f in features(node):
            out[f, node.label] += weight
        if node.parent is not None and node.parent.label is not None:
            out[f"edge {node.parent.label}", node.label] += weight
    return out


_PROSE = "The council met on Monday to discuss the bridge, which has been closed since March. Work may start in spring."
_LAYOUTS = """
<header class=masthead><div>Daily Paper</div><ul><li><a>Home</a><li><a>News</a></ul></header><div class=post><h1>Bridge</h1>{P}{Q}
<ul><li>One point made, in short.</li><li>Another point.</li></ul>{P}</div><div class=sidebar><h3>Related</h3><p><a>More</a></p></div>
<div id=comments><h2>Comments</h2><div><p>Nice text, I agree with all of it.</p></div></div><footer><p>Copyright</p></footer>
===
<div class=cookie-notice><p>We use cookies. By going on you agree, as the law asks.</p></div><div id=content><article><header><h1>T</h1>
</header>{P}{P}<aside><p>Read also: <a>that</a></p></aside>{Q}<blockquote><p>I said so.</p></blockquote><table><tr><td>1</td><td>two</td></tr>
</table><div class=share><a>Share</a></div><section class=comments><div class=comment><p>First!</p></div></section></article></div>
===
<table class=layout><tr><td class=menu><a>a</a> <a>b</a></td><td class=main><h2>Head</h2>{P}{P}{P}</td></tr></table><form><p>Search the
site</p><div>Your name</div></form><div class=ad><p>Buy now, only today.</p></div>
===
<nav><ul><li><a>x</a></li><li><a>y</a></li></ul></nav><main><h1>H</h1><div class=text>{P}<div>{P}</div><section><h2>I</h2>{P}{Q}</section><pre>code</pre><ol><li>Do this
first, then wait.</li></ol><dl><dt>Term</dt><dd>What it means.</dd></dl><figure><figcaption>A bridge.</figcaption></figure></div></main>
<aside><h4>Latest</h4><ul><li><a>n</a></li></ul></aside><div class=newsletter><form><p>Sign up.</p></form></div><footer><div>c</div></footer>
===
<div class=banner>Sale</div><section class=story><h1>S</h1>{P}{P}<p>Short.</p><h2>Part</h2>{Q}</section><div class=footer><ul><li><a>Terms
</a></li></ul></div>
===
<body><dialog><p>We value your privacy, so please choose.</p></dialog><header><p>All the news, every day.</p></header><div class=wrap><section class=text><div>
{P}</div>{P}<section>{Q}</section></section></div><form><p>Subscribe to our letter, it is free.</p><fieldset><legend>You</legend><p>Name.</p></fieldset></form><aside><p>He writes
about bridges, and about roads.</p><p>More of his work, and that of others.</p></aside><footer><p>All rights reserved, 2020.</p></footer>
"""


def labelled_layouts() -> list[str]:
    """Pages labelled by hand: the roles and hints of their elements say what is content."""
    filled = _LAYOUTS.replace("{P}", f"<p>{_PROSE}</p><p>{_PROSE * 3}</p>").replace("{Q}", "<p>Yes.</p><p>So they say, it seems.</p>")
    return filled.split("===")


def train(pages: DataFrame, bound: int = SAMPLE, html_col: str = "html") -> Model:
    """A model from the layouts and ``bound`` different corpus pages at most, those with the lowest hashes of their text."""
    rows = pages.select(F.col(html_col).alias("html")).filter("html is not null")
    rows = rows.withColumn("place", F.xxhash64(F.lit(3), "html"))
    # Copies have one place, so each counts once; pages apart that share a place are told by the smaller one.
    lowest = [r.place for r in rows.select("place").distinct().orderBy("place").limit(bound).collect()]
    sample = (rows.filter(F.col("place") <= F.lit(max(lowest, default=0)).cast("long"))
              .groupBy("place").agg(F.min("html").alias("html")).select("html"))

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total.update(count_page(page.as_py()))
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame([(f, label, float(n)) for (f, label), n in total.items()], columns=["feature", "label", "n"]),
            schema=pa.schema([("feature", pa.string()), ("label", pa.int64()), ("n", pa.float64())]))

    n = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0.0)).alias(f"n{label}")
    counts = sample.mapInArrow(run, "feature string, label long, n double").groupBy("feature").agg(n(0), n(1))
    total: Counter = Counter()
    for layout in labelled_layouts():
        total.update(count_page(layout, HAND_WEIGHT, by_hand=True))
    for r in counts.collect():  # names of elements and small classes, of ``bound`` pages
        total[r.feature, 0] += r.n0
        total[r.feature, 1] += r.n1
    return Model({f: (total[f, 0], total[f, 1]) for f in {k[0] for k in total}})


def main_text(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars per row.

    A null or empty page, and one without content, has an empty text. Broken markup is read as far as it goes. Null and
    repeated ids and urls pass through; other columns are not read; no rows give no rows.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [extract(page.as_py(), sent.value) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())],
                                             ["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return rows.mapInArrow(run, f"{kinds}, text string").withColumn("n_chars", F.length("text").cast("long"))
