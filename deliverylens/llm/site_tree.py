"""Main text of web pages by a site style tree.

Pages of one host are merged into one tree. A node is the way from the root to
an element, each step its tag with its class and id; at it stand the styles
(sequences of child elements) and the texts that pages have there. What the
pages of a host have alike at a node is template, what differs is content: a
text that k of the node's m pages share has importance 1 - log k / log m, the
styles of a node have the entropy of their distribution to the base m, and a
node has the mean of its texts' importance, joined with that of its styles. A
branch is noise if all nodes in it are, so each node is judged by what stands
directly at it: the texts of nodes of low importance are removed, and single
texts that nearly all pages of their node share (`LEAF`), inside ``article``
and ``main`` as outside.

Tags and names are a prior of a branch's importance. ``article`` and ``main`` add
`MAIN`; a class or id that merely holds a word such as "share" or "related" takes
`HINT` away; text outside of an article stays unless the tree removes it. Only
elements that a tag, role or whole name calls a menu, form, advert and so on
(``aside``, "cookie-box") do not take part, which serves hosts with few pages,
where there is nothing to compare, and also that is no verdict: where all
articles, or what a main name says is one, lie in such elements, those that hold one
count as any other, and so does, on a page without one, one of no kind of
`NEVER_MOST` that holds more than half of the page's text, and such a ``form`` anyway. Inline elements so called,
scripts, styles, hidden elements and form controls have no text.

Copies of an article, also near copies, are not template: of the pages of a
host that have the same sampled block, one counts. A page samples its blocks by
a hash weighted with their lengths, so pages that share most of their text
mostly sample the same block, and pages that share a template seldom do.

The trees of all hosts are built by grouping on (host, node, text), so a host
with a third of all pages is spread like any other.

Defined cases: null and empty html give an empty text; a null or malformed url
has the host ''; a host with fewer than `LEAST_PAGES` counted pages at a node
keeps that node; a page that is all template has an empty text; unclosed and cut-off markup is closed where it ends; repeated rows
come out each; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_tasks, written

LEAST_PAGES = 8
THRESHOLD = 0.35
STYLE_WEIGHT = 0.25
#: Added to the importance of nodes in ``article`` and ``main``.
MAIN = 0.25
#: Taken from the importance of nodes below a name that holds a word of noise among others.
HINT = 0.25
#: A single text of less importance is template: more than m ** 0.9 of m pages have it.
LEAF = 0.1
#: So many marked (host, node or text) go to every task; more meet their pages in a join.
BROADCAST_PATHS = 200_000

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p
    pre section summary table tbody td tfoot th thead title tr ul""".split())
CLOSES_P = BLOCK - {"html", "body", "title", "caption", "legend", "option", "optgroup", "td", "th", "tr", "tbody",
                    "thead", "tfoot"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
         "th": {"tr", "table"}, "option": {"select"}, "body": {"html"}}
NEVER_TEXT = frozenset("""head title script style noscript template button select textarea input label iframe object
    embed canvas svg math audio video map datalist""".split())
NOISE_TAGS = frozenset("aside dialog footer form menu nav".split())
NOISE_ROLES = frozenset("""navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar
    toolbar tablist status note""".split())
NOISE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor
    sponsored cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup
    login comment comments disqus respond reply replies share sharing social related recommended recommendations
    breadcrumb breadcrumbs pagination pager toolbar widget widgets footer copyright""".split())
LAYOUT_NAMES = frozenset("nav navbar navigation menu menus sidebar sidebars header masthead topbar".split())
MAIN_NAMES = frozenset("article content main post entry story body text".split())
#: Words that say nothing of what a part holds, so "ad-box" is an advert and "related-work" only a hint.
PLAIN_NAMES = frozenset("""area articles bar block bottom box btn button buttons col column container count desktop float form
    group header icon icons inner item items left link links list mobile module outer page panel posts primary right
    row secondary section site slot space stories text title top unit widget wrap wrapper""".split()) | MAIN_NAMES
#: Most of a page's text does not excuse these: a page may have little else than its menu or its readers' comments.
NEVER_MOST = (NOISE_TAGS - {"form"}) | LAYOUT_NAMES | frozenset(
    "comment comments disqus respond reply replies cookie cookies consent gdpr footer".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr""".split())

_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"\s+")
_CUT_TAG = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")  # a tag that the end of the page cuts off


def _hash(*parts: str) -> int:
    """Signed 64-bit name of a sequence of texts."""
    h = xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


class _Node:
    __slots__ = ("tag", "path", "dead", "zone", "weight", "main", "block", "last", "children")

    def __init__(self, tag: str, path: int, dead: bool, zone: int, weight: float, main: bool, block: _Node | None):
        self.tag, self.path, self.dead, self.zone, self.weight, self.main = tag, path, dead, zone, weight, main
        self.block = block or self  # the nearest that is not inline
        self.last: str | None = None
        self.children = xxhash.xxh64()  # of the child steps so far


class _Zone:
    """An element that its tag, role or name calls noise, until the page's end tells what it holds."""
    __slots__ = ("up", "form", "may_hold_most", "holds", "chars", "noise")

    def __init__(self, up: int, form: bool, may_hold_most: bool):
        self.up, self.form, self.may_hold_most = up, form, may_hold_most
        self.holds, self.chars, self.noise = False, 0, True


class PageTree(HTMLParser):
    """Text blocks and element styles of one page, in time linear in its length however deep it is.

    ``blocks``: (text, path of its element, prior weight of its importance);
    ``styles``: (path, children) of the elements that may hold main text.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.zones: list[_Zone] = []
        self.found: list[tuple[str, int, float, int]] = []
        self.looks: list[tuple[int, int, int]] = []
        self.main_outside, self.chars = False, 0
        self.stack = [_Node("", 0, False, -1, 0.0, False, None)]
        self.open: dict[str, list[int]] = {}  # places of the open elements in the stack, by tag
        self.text: list[str] = []
        self.feed(_CUT_TAG.sub("", html))
        self.close()
        while len(self.stack) > 1:
            self._pop()
        self._flush()
        self._judge()
        self.blocks = [(t, p, w) for t, p, w, z in self.found if z < 0 or not self.zones[z].noise]
        self.styles = [(p, s) for p, s, z in self.looks if z < 0 or not self.zones[z].noise]

    def _judge(self) -> None:
        """Zones that are no noise: see the module's text. A zone stands after the one around it."""
        for z in reversed(self.zones):
            if z.up >= 0:
                self.zones[z.up].holds |= z.holds
                self.zones[z.up].chars += z.chars
        held = any(z.holds for z in self.zones)
        for z in self.zones:
            most = (z.form or z.may_hold_most and not held and not self.main_outside) and 2 * z.chars > self.chars
            z.noise = not (most or z.holds and not self.main_outside) or (z.up >= 0 and self.zones[z.up].noise)

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        self.text.clear()
        node = self.stack[-1].block
        if not text or node.dead:
            return
        self.found.append((text, node.path, node.weight, node.zone))
        self.chars += len(text)
        if node.zone < 0:
            self.main_outside |= node.main
        else:
            self.zones[node.zone].chars += len(text)
            self.zones[node.zone].holds |= node.main

    def _pop(self) -> None:
        node = self.stack[-1]
        if node.tag in BLOCK:
            self._flush()
        self.stack.pop()
        self.open[node.tag].pop()
        if node.tag not in INLINE and not node.dead and node.last is not None:
            h = node.children.intdigest()
            self.looks.append((node.path, h - (1 << 64) if h >> 63 else h, node.zone))

    def _nearest(self, tags: set[str]) -> int:
        return max((places[-1] for t in tags if (places := self.open.get(t))), default=0)

    def _close(self, tags: set[str], scope: set[str]) -> None:
        """Close the nearest open element of ``tags`` unless one of ``scope`` stands before it."""
        i = self._nearest(tags)
        if i and i >= self._nearest(scope):
            while len(self.stack) > i:
                self._pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, {"table", "td", "th", "button", "object"})
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], SCOPE[tag])
        if tag in BLOCK:
            self._flush()
        if tag in ("br", "wbr"):
            self.text.append(" " if tag == "br" else "")
        if tag in VOID:
            return
        up = self.stack[-1]
        given = {k: (v or "") for k, v in attrs}
        names = f"{given.get('class', '')} {given.get('id', '')}".strip()
        called, hint, main = self._prior(tag, names, given, up)
        dead = (up.dead or tag in NEVER_TEXT or "hidden" in given or given.get("aria-hidden") == "true"
                or (called is not None and tag not in BLOCK))
        zone, weight = up.zone, up.weight
        if called is not None and not dead:
            self.zones.append(_Zone(zone, called == {"form"}, not called & NEVER_MOST))
            zone = len(self.zones) - 1
        if (tag in ("article", "main") or given.get("role") == "main") and weight <= 0:
            weight += MAIN
        if hint and weight >= 0:
            weight -= HINT
        if tag in INLINE:
            node = _Node(tag, up.path, dead, zone, weight, up.main, up.block)
        else:
            step = f"{tag} {names}"
            if up.last != step:  # a run of like children is one
                up.last = step
                up.children.update(step.encode("utf-8", "surrogatepass") + b"\0")
            # What is called noise inside an article is no article that could excuse itself.
            node = _Node(tag, _hash(str(up.path), step), dead, zone, weight, called is None and (up.main or main), None)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)

    @staticmethod
    def _prior(tag: str, names: str, given: dict, up: _Node) -> tuple[frozenset | set | None, bool, bool]:
        """Tag, role or words that call an element noise or null; a word of noise among others; a main part."""
        tokens = [{w.lower() for w in _NAME.findall(t)} for t in names.split()]
        main = tag in ("article", "main") or given.get("role") == "main"
        named = any(t and t <= MAIN_NAMES for t in tokens)
        if tag in ("html", "body", "main") or given.get("role") == "main":
            return None, False, main
        if tag in NOISE_TAGS or (tag == "header" and not up.main):
            return {tag}, False, False
        if given.get("role", "").lower() in NOISE_ROLES:
            return {"nav"} if given["role"].lower() != "form" else {"form"}, False, False
        noise = NOISE_NAMES if up.main else NOISE_NAMES | LAYOUT_NAMES
        words = set().union(*(t & noise for t in tokens if not {w for w in t if not w.isdigit()} - noise - PLAIN_NAMES))
        if words and not named and not (tag == "article" and not words & {"comment", "comments"}):
            return words, False, False
        return None, not named and any(t & noise for t in tokens), main or named

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag in BLOCK and not self.open.get(tag):
            self._flush()
            return
        self._close({tag}, {"table", "td"} if tag in INLINE else set())

    def handle_data(self, data: str) -> None:
        if not self.stack[-1].dead:
            self.text.append(data)


def page(html: str | None) -> tuple[list, list]:
    """Blocks and styles of a page."""
    if not html:
        return [], []
    tree = PageTree(html)
    return tree.blocks, tree.styles


def sampled(blocks: list[tuple]) -> int | None:
    """Name of one of the blocks: each is it with a chance of its share of the page's text, and pages agree on it."""
    if not blocks:
        return None
    names = [_hash(b[0]) for b in blocks]
    return min(zip(names, blocks), key=lambda x: (-math.log(((x[0] & (1 << 53) - 1) + 1) / (1 << 53) + 1e-17)
                                                  / len(x[1][0]), x[0]))[0]


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


_BLOCK = T.StructType([T.StructField("text", T.StringType()), T.StructField("path", T.LongType()),
                       T.StructField("weight", T.DoubleType()), T.StructField("name", T.LongType())])
_STYLE = T.StructType([T.StructField("path", T.LongType()), T.StructField("style", T.LongType())])


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, a name of the html, its sampled block, blocks and styles of every row."""
    arrow_tasks(pages.sparkSession)
    block = pa.struct([("text", pa.string()), ("path", pa.int64()), ("weight", pa.float64()), ("name", pa.int64())])
    style = pa.struct([("path", pa.int64()), ("style", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, names, samples, blocks, styles = [], [], [], [], []
            for url, html in zip(b["url"].to_pylist(), b["html"].to_pylist()):
                found, looks = page(html)
                hosts.append(host(url))
                names.append(_hash(html or ""))
                samples.append(sampled(found))
                blocks.append([{"text": t, "path": p, "weight": w, "name": _hash(t)} for t, p, w in found])
                styles.append([{"path": p, "style": s} for p, s in set(looks)])
            yield pa.RecordBatch.from_arrays(
                [b["page_id"], b["url"], pa.array(hosts, pa.string()), pa.array(names, pa.int64()),
                 pa.array(samples, pa.int64()), pa.array(blocks, pa.list_(block)), pa.array(styles, pa.list_(style))],
                ["page_id", "url", "host", "name", "sample", "blocks", "styles"])

    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("host", T.StringType()), T.StructField("name", T.LongType()),
                           T.StructField("sample", T.LongType()), T.StructField("blocks", T.ArrayType(_BLOCK)), T.StructField("styles", T.ArrayType(_STYLE))])
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, schema)


def _counted(pages: DataFrame) -> DataFrame:
    """host, page, blocks (path, weight, name) and styles of the pages that count: one of those with one sampled block."""
    # Only names are shuffled, never texts.
    slim = F.transform("blocks", lambda b: F.struct(b["path"].alias("path"), b["weight"].alias("weight"),
                                                    b["name"].alias("name")))
    first = (pages.where(F.col("sample").isNotNull()).groupBy("host", "sample").agg(F.min("name").alias("name"))
             .select("host", "name"))
    return (pages.select("host", "name", slim.alias("blocks"), "styles").join(first, ["host", "name"], "left_semi")
            .dropDuplicates(["host", "name"]).withColumnRenamed("name", "page"))


def importance(once: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Over `_counted` pages: (host, path, weight, importance, pages) of the nodes, (host, path, text, importance, pages) of the texts."""
    texts = once.select("host", "page", F.explode("blocks").alias("b")).select(
        "host", "page", F.col("b.path").alias("path"), F.col("b.weight").alias("weight"), F.col("b.name").alias("text"))
    # k: pages that have this text at this node; the same text twice on a page counts twice in the mean, once in k.
    shared = (texts.groupBy("host", "path", "text", "page").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"))
              .groupBy("host", "path", "text")
              .agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.max("weight").alias("weight")))
    node_pages = (once.select("host", F.explode(F.array_distinct("blocks.path")).alias("path"))
                  .groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages")))
    content = (shared.groupBy("host", "path")
               .agg(F.sum(F.col("n") * F.log("k")).alias("alike"), F.sum("n").alias("n"), F.max("weight").alias("weight"))
               .join(node_pages, ["host", "path"])
               .select("host", "path", "weight", "pages",
                       F.when(F.col("pages") > 1, 1 - F.col("alike") / (F.log("pages") * F.col("n")))
                       .otherwise(F.lit(1.0)).alias("content")))
    styles = (once.select("host", F.explode("styles").alias("s"))
              .groupBy("host", F.col("s.path").alias("path"), F.col("s.style").alias("style"))
              .agg(F.count(F.lit(1)).alias("n")).groupBy("host", "path")
              .agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
              .select("host", "path", F.when(F.col("m") > 1, 1 - F.col("nlogn") / (F.col("m") * F.log("m")))
                      .otherwise(F.lit(1.0)).alias("style")))
    weight = F.when(F.col("style").isNull(), F.lit(0.0)).otherwise(F.lit(STYLE_WEIGHT))
    score = weight * F.coalesce("style", F.lit(0.0)) + (1 - weight) * F.col("content")
    nodes = content.join(styles, ["host", "path"], "left").select("host", "path", "weight", "pages",
                                                                  score.alias("importance"))
    leaves = (shared.join(node_pages, ["host", "path"])
              .select("host", "path", "text", "pages",
                      F.when(F.col("pages") > 1, 1 - F.log("k") / F.log("pages")).otherwise(F.lit(1.0)).alias("importance")))
    return nodes, leaves


def _kept(blocks: list[dict], low: frozenset | set) -> list[dict]:
    """Blocks whose node and text are not in ``low``, a set of (path, null) and (path, text)."""
    return [b for b in blocks if (b["path"], None) not in low and (b["path"], b["name"]) not in low]


def extract(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES,
            broadcast_paths: int = BROADCAST_PATHS) -> DataFrame:
    """page_id, url, text, n_chars of every row of (page_id, url, html).

    The nodes and texts to remove go to every task if they are no more than
    ``broadcast_paths``; else pages and their nodes meet in a join.
    """
    table = written(parsed(pages).withColumn("uid", F.monotonically_increasing_id()), "page_trees")
    nodes, leaves = importance(written(_counted(table), "counted_pages"))
    weighed = F.col("importance") + F.col("weight")
    low = written(nodes.where((weighed < threshold) & (F.col("pages") >= least_pages))
                  .select("host", "path", F.lit(None).cast("long").alias("text"))
                  .unionByName(leaves.where((F.col("importance") < LEAF) & (F.col("pages") >= least_pages))
                               .select("host", "path", "text")), "low_nodes")
    by_host: dict[str, set[tuple]] | None = None
    rows = table.select("page_id", "url", "host", "blocks")
    if low.count() <= broadcast_paths:
        by_host = {}
        for r in low.collect():
            by_host.setdefault(r.host, set()).add((r.path, r.text))
        rows = rows.withColumn("low", F.lit(None).cast("array<struct<path:bigint,text:bigint>>"))
    else:
        # A node's row meets its blocks by a null text, a single text's row by its name.
        own = F.array_distinct(F.flatten(F.transform("blocks", lambda b: F.array(
            F.struct(b["path"].alias("path"), F.lit(None).cast("long").alias("text")),
            F.struct(b["path"].alias("path"), b["name"].alias("text"))))))
        asked = table.select("uid", "host", F.explode(own).alias("o")).select("uid", "host", "o.path", "o.text").alias("a")
        found = low.alias("l")
        gone = (asked.join(found, (F.col("a.host") == F.col("l.host")) & (F.col("a.path") == F.col("l.path"))
                           & F.col("a.text").eqNullSafe(F.col("l.text")))
                .groupBy("a.uid").agg(F.collect_list(F.struct(F.col("a.path").alias("path"),
                                                              F.col("a.text").alias("text"))).alias("low")))
        rows = table.join(gone, "uid", "left").select("page_id", "url", "host", "blocks", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for name, blocks, own in zip(b["host"].to_pylist(), b["blocks"].to_pylist(), b["low"].to_pylist()):
                lost = ({(x["path"], x["text"]) for x in own or ()} if by_host is None
                        else by_host.get(name, frozenset()))
                texts.append("\n".join(x["text"] for x in _kept(blocks, lost)))
            yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
