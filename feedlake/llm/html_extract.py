"""Operator 9, HTML extraction with a site style tree.

The DOMs of a host's pages are merged into one tree of element nodes: a node is
the path of tags and classes from the root. For every node the pages' ways of
presenting it (the row of its children's tags and classes) and its contents
(hashes of its own text) are counted over the host's distinct pages. A node's
importance is, with m pages,

* of presentation: the entropy to base m of the ways it is presented;
* of content: 1 less the mean, over its distinct contents, of the entropy to
  base m of the pages that hold the content (log_m k for k pages);
* together: ``CONTENT_WEIGHT`` of content and the rest of presentation.

Navigation, adverts or notices that a site repeats have little importance, and
branches below ``threshold`` are cut from each of the host's pages. Few pages
are weak evidence: a node's lack of importance counts less by a part of 1/m.
Pages that share their longest block of text are one page, so near copies of
an article are no evidence against it, and the node with most of a host's text
is never cut. Elements that HTML itself or a common name marks as page furniture
have no importance from the start.

The main text is that of the article (``article`` or ``main`` elements) if the
page has one, else of the body. An article that is only a teaser beside far more
running text is not the page's. A page that is nothing but a form is not empty. Counting shuffles hashes only; pages stay where
they are read and are parsed twice.

Defined cases: null or empty html gives an empty text; broken markup is read
leniently and never fails; a null url is a host of its own; repeated rows are
rows of their own and count as one page; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import arrow_schema, materialise

THRESHOLD = 0.3
CONTENT_WEIGHT = 0.9
TEASER_PART, TEASER_CHARS = 3, 250  # text outside links, around an article so many times shorter, and at least so long
PATH_DEPTH = 400  # elements below it share the path of the one above them, so that paths stay short
BROADCAST_BRANCHES = 100_000  # branches to cut, all hosts, that are broadcast

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template iframe svg title textarea select object audio video canvas".split())
#: Of these, HTML closes none by a slash in the start tag, and an open one ends with the page.
UNPARSED = frozenset("script style title textarea".split())
FURNITURE = frozenset("nav footer aside form button dialog menu head script style noscript template iframe svg "
                      "title textarea select object audio video canvas".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices newsletter subscribe subscription share sharing social related recommended sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus replies respond popup modal "
    "overlay paywall login signup pagination pager toolbar widget widgets skip".split())
#: Second parts of names of furniture, as in ``share-buttons``.
FURNITURE_PARTS = frozenset("area bar block box button buttons container form icon icons inner item items link links list "
                            "outer panel section top bottom left right unit wrap wrapper".split())
#: First parts of names of furniture, as in ``site-footer``; a header only with those that name the site.
FURNITURE_FIRST = frozenset("site main page post global top bottom left right primary secondary blog article entry "
                            "user reader".split())
SITE_HEADERS = frozenset(("site-header", "global-header", "top-header"))
#: Names that are single words of an article's own ids and classes too: inside it the style tree decides.
DOUBTFUL_NAMES = frozenset("consent overlay respond share sharing skip social subscription".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
MAIN = frozenset(("article", "main"))
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split())
#: A start tag ends these open elements, up to the named limits.
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
        "tr": ("tr", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
        "option": ("option", ("select",))}
ENDS = {k: (frozenset(v.split()), frozenset(limit)) for k, (v, limit) in ENDS.items()}
NOT_IN_P = BLOCK - {"br", "option", "optgroup", "body", "html", "head", "title", "caption", "tr", "td", "th", "tbody",
                    "thead", "tfoot", "legend"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    # A quote without its partner: the tag ends where it seems to.
    r"|<([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
#: A whole attribute, so that values are never searched for names.
_ATTRIBUTE = re.compile(r"""([^\s/>="']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_NAME = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


class Node:
    __slots__ = ("children", "main", "mute", "parent", "path", "tag", "text")

    def __init__(self, tag: str, name: str, parent: Node | None, mute: bool, depth: int = 0):
        self.tag, self.parent = tag, parent
        self.path = name if parent is None else parent.path if depth > PATH_DEPTH else f"{parent.path}/{name}"
        self.mute = mute or (parent is not None and parent.mute)
        self.main = tag in MAIN or (parent is not None and parent.main)
        self.children: list[str] = []
        self.text: list[str] = []


def _furniture(key: str, value: str, tag: str, in_main: bool) -> bool:
    """Whether a whole class or id names page furniture. Ids of headings and sections are
    slugs of their titles; headings in an article belong to it."""
    if tag in HEADINGS and (in_main or key == "id"):
        return False
    if tag == "section" and key == "id" and in_main:
        return value in ("comments", "comment-list")
    for token in value.split():
        parts = _NAME.findall(token)
        if len(parts) > 1 and parts[0] in FURNITURE_FIRST and (parts[1] in FURNITURE_NAMES or token in SITE_HEADERS):
            parts = parts[1:] if token not in SITE_HEADERS else ["banner"]
        if parts and parts[0] in FURNITURE_NAMES and all(x in FURNITURE_NAMES or x in FURNITURE_PARTS for x in parts):
            if not (in_main and len(parts) == 1 and parts[0] in DOUBTFUL_NAMES):
                return True
    return False


def _named(tag: str, attributes: str, in_main: bool) -> tuple[str, bool]:
    """The node's name in the style tree (tag and classes), and whether it is page furniture."""
    mute = tag in FURNITURE or (tag == "header" and not in_main)
    name = tag
    if attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                if tag not in MAIN and tag not in ("body", "html"):
                    mute = mute or _furniture(key, value, tag, in_main)
                elif tag == "article" and any(x.startswith(("comment-", "comments-")) or x in ("comment", "comments")
                                              for x in value.split()):
                    mute = True
                if key == "class":
                    name += "." + " ".join(_NAME.findall(value))
            elif key == "role":
                mute = mute or value in FURNITURE_ROLES
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                mute = True
            elif key == "style" and "display:none" in value.replace(" ", ""):
                mute = True
    return name, mute


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """All nodes, and the runs of text in page order with their node; None: a block begins or ends."""
    root = Node("", "", None, False)
    nodes, runs, stack, at = [root], [], [root], 0
    places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag

    def innermost(tags: frozenset) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def pop_to(names: frozenset, limits: frozenset) -> None:
        k = innermost(names)
        if k and k >= innermost(limits):
            for node in stack[k:]:
                places[node.tag].pop()
            del stack[k:]

    def add(upto: int) -> None:
        if at < upto:
            text = page[at:upto]
            runs.append((stack[-1], entities.unescape(text) if "&" in text else text))

    p, none = frozenset(("p",)), frozenset()
    p_limits = frozenset(("td", "th", "caption", "button", "object"))
    while (m := _TOKEN.search(page, at)) is not None:
        add(m.start())
        at = m.end()
        end, tag, attributes = m.group(1), m.group(2) or m.group(4), m.group(3) or m.group(5) or ""
        if end is not None:
            end = end.lower()
            if end in BLOCK:
                runs.append((stack[-1], None))
            pop_to(frozenset((end,)), none)
        elif tag is not None:
            tag = tag.lower()
            if tag in BLOCK:
                runs.append((stack[-1], None))
                if tag in NOT_IN_P:
                    pop_to(p, p_limits)
                if tag in ENDS:
                    pop_to(*ENDS[tag])
            if tag in VOID:
                continue
            name, mute = _named(tag, attributes, stack[-1].main)
            stack[-1].children.append(name)
            if tag in RAW and (tag in UNPARSED or not attributes.rstrip().endswith("/")):
                close = _RAW_END[tag].search(page, at)
                # Only these swallow the rest of the page; others that are never closed hold nothing.
                at = close.end() if close else len(page) if tag in UNPARSED else at
                continue
            node = Node(tag, name, stack[-1], mute, len(stack))
            nodes.append(node)
            if tag not in RAW:
                places.setdefault(tag, []).append(len(stack))
                stack.append(node)
    add(len(page))
    return nodes, runs


def main_text(page: str, cut: frozenset = frozenset()) -> str:
    """Text of the page's article; ``cut``: paths of branches to leave out."""
    nodes, runs = parse(page)
    text = _text(nodes, runs, cut, frozenset())
    if not text and any(n.tag == "form" for n in nodes):
        text = _text(nodes, runs, cut, frozenset(("form",)))  # the page's whole body is in a form
    return text


def _text(nodes: list[Node], runs: list[tuple[Node, str | None]], cut: frozenset, spoken: frozenset) -> str:
    """The main text; elements of the tags ``spoken`` are no furniture by their tag."""
    dropped: set[int] = set()
    linked: set[int] = set()
    for node in nodes:  # parents come first
        own = node.mute and not (node.tag in spoken or spoken and node.parent is not None and node.parent.mute
                                 and id(node.parent) not in dropped and node.tag not in FURNITURE)
        if own or node.path in cut or id(node.parent) in dropped:
            dropped.add(id(node))
        if node.tag == "a" or id(node.parent) in linked:
            linked.add(id(node))
    inside = around = 0
    for node, text in runs:
        if text is not None and id(node) not in dropped:
            n = len(" ".join(text.split()))
            inside += n * node.main
            around += n * (not node.main and id(node) not in linked)
    has_main = any(n.main and id(n) not in dropped for n in nodes)
    has_main = has_main and not (around >= TEASER_CHARS and around > TEASER_PART * inside)

    blocks, block = [], []
    for node, text in runs:
        if text is None:
            blocks.append("".join(block))
            block = []
        elif not (has_main and not node.main) and id(node) not in dropped:
            block.append(text)
    blocks.append("".join(block))
    return " ".join(x for b in blocks if (x := " ".join(b.split())))


def path_hash(path: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(path) - (1 << 63)


_FEATURES = "host string, page long, path string, kind int, value long, size long"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's ways of presentation (kind 0) and contents (kind 1) by node, each once."""
    schema = arrow_schema(_FEATURES)
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part = batch.slice(low, 500)
            rows = []
            for host, text in zip(part.column("host").to_pylist(), part.column("html"), strict=True):
                nodes, runs = parse(text.as_py() or "")
                longest = max((" ".join(run.split()) for node, run in runs if run is not None and not node.mute),
                              key=lambda x: (len(x), x), default="")
                page = path_hash(longest)
                seen: dict[tuple[str, int, int], int] = {}
                for node, run in runs:
                    if run is None or node.mute or run.isspace():
                        continue
                    key = (node.path, 1, path_hash(" ".join(run.split())))
                    seen[key] = seen.get(key, 0) + len(run)
                texted = {path for path, _, _ in seen}
                shown: dict[str, list[str]] = {}
                for node in nodes:
                    if node.path in texted and not node.mute:
                        shown.setdefault(node.path, []).append(",".join(node.children))
                for path, ways in shown.items():
                    seen[(path, 0, path_hash("|".join(ways)))] = 0
                rows += [(host, page, *key, size) for key, size in seen.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def host_of(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def style_tree(pages: DataFrame) -> DataFrame:
    """``host, path, pages, importance, size`` of every node that holds text. ``pages``: ``url, html``."""
    features = pages.select(host_of().alias("host"), "html").mapInArrow(_features, _FEATURES).distinct()
    counted = features.groupBy("host", "path", "kind", "value").agg(
        F.count(F.lit(1)).alias("k"), F.sum("size").alias("size"))
    first = F.col("kind") == 0
    # Near copies are one page that may present a node in several ways.
    sums = counted.groupBy("host", "path").agg(
        F.sum(F.when(first, F.col("k"))).alias("pages"),
        # Entropy from sums: -sum k/m ln(k/m) = ln m - sum(k ln k) / m.
        F.sum(F.when(first, F.col("k") * F.log(F.col("k")))).alias("k_ln_k"),
        F.avg(F.when(~first, F.log(F.col("k")))).alias("ln_k"),
        F.sum("size").alias("size"))
    log_m = F.log(F.col("pages"))
    presentation = (log_m - F.col("k_ln_k") / F.col("pages")) / log_m
    content = 1 - F.col("ln_k") / log_m
    combined = CONTENT_WEIGHT * content + (1 - CONTENT_WEIGHT) * presentation
    importance = F.when(F.col("pages") > 1, 1 - (1 - combined) * (1 - 1 / F.col("pages")))
    return sums.select("host", "path", "pages", "size", F.coalesce(importance, F.lit(1.0)).alias("importance"))


def unimportant_branches(pages: DataFrame, threshold: float) -> DataFrame:
    """``host, paths``: the branches to cut."""
    tree = style_tree(pages)
    # The node that holds most of a host's text stays.
    return (tree.groupBy("host")
                .agg(F.max_by("path", F.struct("size", "path")).alias("largest"),
                     F.collect_set(F.when(F.col("importance") < threshold, F.col("path"))).alias("paths"))
                .select("host", F.array_remove("paths", F.col("largest")).alias("paths"))
                .where(F.size("paths") > 0))


_TEXT = "page_id long, url string, text string, n_chars long"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_TEXT)
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part = batch.slice(low, 500)
            out = [main_text(h.as_py() or "", frozenset(p.as_py() or ()))
                   for h, p in zip(part.column("html"), part.column("paths"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(out, pa.string()),
                 pa.array(np.fromiter(map(len, out), np.int64, len(out)))], schema=schema)


def extract_text(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id``, ``url``, ``html``)."""
    cut = materialise(unimportant_branches(pages, threshold), "style-cuts")
    if (cut.agg(F.sum(F.size("paths"))).first()[0] or 0) <= BROADCAST_BRANCHES:
        cut = F.broadcast(cut)
    return (pages.select("page_id", "url", "html", host_of().alias("host")).join(cut, "host", "left")
                 .select("page_id", "url", "html", "paths").mapInArrow(_extract, _TEXT))
