"""Main text of web pages by consensus paths: pages of a host vote on the container that holds their article."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.llm.store import materialise

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++)))?""")
_TOLD_BY = frozenset("class id role style hidden aria-hidden".split())
_LETTERS = re.compile("[a-z]+")
_DIGITS = re.compile("[0-9]+")
_RAW = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in ("script", "style", "textarea", "title", "xmp", "iframe", "noscript", "noembed", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that stand beside the article, wherever they are.
BESIDE = frozenset("nav footer aside script style noscript iframe svg math button select label legend template dialog menu head textarea object canvas audio video".split())
#: Such that may also stand around the whole page, as servers write them: told like those with a sign.
DOUBTFUL = frozenset({"form"})
#: Words in a class, id or role that tell the same.
SIGNS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices newsletter subscribe subscription sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond popup modal overlay widget widgets toolbar pagination pager login signup search skip alert masthead topbar hidden complementary contentinfo".split()
)
CONTAINERS = frozenset("html body div section article main td table tbody tr center ul ol dl blockquote details figure".split())
#: Containers that may stand around a whole article; others are parts of one.
AROUND = CONTAINERS - frozenset("ul ol dl blockquote details figure".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag of the first closes an open one of the second.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NO_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: The share of a container's text that one inside it must have for the search to go on there.
SHARE = 0.8


#: An element that signs tell from the article is kept if it has more than MOST of the page's text, unless an `article`
#: or `main` outside has ENOUGH.
MOST, ENOUGH = 0.5, 0.2
#: How often a page is read again to look inside a kept one.
ROUNDS = 8
#: Elements nested deeper are taken as parts of the last one above, or left out with their text if they stand beside.
MOST_DEPTH = 512


class Node:
    """An element.  Its path is told by a hash of the generalised tags and classes from the root, and shown by the last
    two, so that it stays short however deep and wordy a page is.  beside: its text is left out; doubt: the innermost
    element that is left out by a sign alone, over: the next around that, held: the text in it, without links."""

    __slots__ = ("beside", "doubt", "held", "key", "name", "over", "parent", "path", "weight")

    def __init__(self, name: str, key: str, parent: Node | None, beside: bool):
        self.name, self.parent, self.beside, self.weight, self.key = name, parent, beside, 0, key[:80]
        self.doubt, self.over, self.held = None, None, 0
        mark = hashlib.blake2b(f"{parent.path if parent else ''}>{key}".encode(), digest_size=8).hexdigest()
        self.path = f"{parent.key if parent else ''}>{self.key}#{mark}"


def _attributes(text: str) -> tuple[str, list[str], bool]:
    """The generalised class key, words of class, id and role, and whether the element is hidden."""
    classes, words, hidden = [], [], False
    for m in _ATTRIBUTE.finditer(text):
        if (name := m[1].lower()) not in _TOLD_BY:
            continue
        value = html.unescape(m[2] or m[3] or m[4] or "").lower()
        if name == "class":
            classes = sorted({_DIGITS.sub("#", c) for c in value.split()})[:3]
        if name in ("class", "id", "role"):
            words += _LETTERS.findall(value)
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        else:
            hidden |= value != "false"
    return "".join(f".{c}" for c in classes), words, hidden


def parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The root, and the blocks of text outside of elements that stand beside the article, each with its element.

    White space in a block is one space; character references are decoded; a `br` is white space.  A sign alone
    doesn't put an element aside that holds most of the text, nor all text of a page.
    """
    kept: set[int] = set()
    for k in range(ROUNDS + 1):
        root, blocks, doubted, articles = _parse(page, kept)
        held = {at: node.held for at, node in doubted.items() if node.held > 0}
        total = root.weight + sum(n for at, n in held.items() if doubted[at].over is None)
        new = {at for at, n in held.items() if n > MOST * total}
        if sum(a.weight for a in articles) >= ENOUGH * total:
            new = set()
        elif k < ROUNDS:
            new = {at for at in new if doubted[at].over is None}
        if not new and not blocks:
            new = set(held)
        if not new:
            break
        kept |= new
    else:
        root, blocks, _, _ = _parse(page, kept)
    return root, blocks


def _parse(page: str, kept: set[int]) -> tuple[Node, list[tuple[Node, str]], dict[int, Node], list[Node]]:
    """The root and blocks, the elements that are left out by signs (of those not in kept; by the order of their tags),
    and the outermost `article` and `main` elements of what is left."""
    doubted: dict[int, Node] = {}
    articles: list[Node] = []
    tags = 0
    #: Open elements below MOST_DEPTH, and how many of them are left out.
    deep: list[tuple[str, bool]] = []
    muted = 0
    root = Node("", "", None, False)
    stack = [root]
    blocks: list[tuple[Node, str]] = []
    pieces: list[str] = []
    linked = links = 0
    owner = root
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append((owner, text))
                weight = max(0, len(text) - 2 * linked)
                node: Node | None = owner
                while node is not None:
                    node.weight += weight
                    node = node.parent
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal owner, linked
        top = stack[-1]
        if muted:
            return
        if top.beside or not raw:
            doubt = top.doubt
            if doubt is not None and (n := len(raw.strip())):
                while doubt is not None:
                    doubt.held += -n if links else n
                    doubt = doubt.over
            return
        if not pieces:
            if raw.isspace():
                return
            k = len(stack) - 1
            while k and stack[k].name in INLINE:
                k -= 1
            owner = stack[k]
        text = html.unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if links:
            linked += len(text)

    def close(k: int) -> None:
        nonlocal links
        for node in stack[k:]:
            if node.name == "a":
                links -= 1
            if node.name not in INLINE:
                flush()
        del stack[k:]

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        m = _TOKEN.match(page, lt)
        if not m:
            add("<")
            at = lt + 1
            continue
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if (m["end"] or m["end2"]) and deep:
            k = next((k for k in range(len(deep) - 1, -1, -1) if deep[k][0] == name), None)
            if name not in INLINE:
                flush()
            if k is not None:
                muted -= sum(x for _, x in deep[k:])
                del deep[k:]
                continue
            if not any(x.name == name for x in stack):
                continue
            deep.clear()
            muted = 0
        if m["end"] or m["end2"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    close(k)
                    break
                if name in INLINE and stack[k].name in CONTAINERS:
                    break
            continue
        attributes = m["attributes"] or m["attributes2"] or ""
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                add(" ")
            continue
        if name in _RAW:
            end = _RAW[name].search(page, at)
            at = end.start() if end else n
            if not end:
                break
            gt = page.find(">", at)
            at = gt + 1 if gt >= 0 else n
            continue
        if len(stack) >= MOST_DEPTH:
            if name not in INLINE:
                flush()
            words, hidden = _attributes(attributes)[1:] if attributes else ([], False)
            deep.append((name, hidden or name in BESIDE or not SIGNS.isdisjoint(words)))
            muted += deep[-1][1]
            continue
        if name in _NO_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    close(k)
                    break
                if stack[k].name in CONTAINERS and stack[k].name not in ("ul", "ol", "dl"):
                    break
        if name in _CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in _CLOSES[name]:
                    close(k)
                    if name != "tr":
                        break
                elif stack[k].name in ("ul", "ol", "dl", "table", "div", "article", "body", "select"):
                    break
        if name not in INLINE:
            flush()
        top = stack[-1]
        key, hidden, sign = name, False, False
        if attributes:
            more, words, hidden = _attributes(attributes)
            key += more
            if name in ("html", "body", "main"):
                hidden = False
            else:
                sign = not SIGNS.isdisjoint(words)
        aside, within = top.beside and top.doubt is None or hidden or name in BESIDE, True
        if not aside and name in ("header", "article", "main"):
            within = any(x.name in ("article", "main") for x in stack)
            aside = name == "header" and not within
        sign |= name in DOUBTFUL
        tags += 1
        node = Node(name, key, top, aside or top.beside)
        if not aside:
            node.doubt = top.doubt
            if sign and tags not in kept:
                node.beside, node.doubt, node.over = True, node, top.doubt
                doubted[tags] = node
            elif not node.beside and not within:
                articles.append(node)
        stack.append(node)
        links += name == "a"
    for _ in range(len(stack)):
        close(max(0, len(stack) - 1))
    flush()
    return root, blocks, doubted, articles


def _has_heading(node: Node, children: dict[int, dict[int, Node]]) -> bool:
    """Whether it is, or holds, a heading with text that is not all links."""
    todo = [node]
    while todo:
        node = todo.pop()
        if node.weight:
            if node.name in HEADINGS:
                return True
            todo += children.get(id(node), {}).values()
    return False


def best_container(root: Node, blocks: list[tuple[Node, str]]) -> str:
    """The path of the deepest container that has most of the page's text; empty if there is none.

    The search ends at an `article` or `main`, and goes on inside a container only if what it leaves outside is
    boilerplate: links, or containers of another tag or class without a heading.
    """
    children: dict[int, dict[int, Node]] = {}
    for owner, _ in blocks:
        node = owner
        while node.parent is not None:
            children.setdefault(id(node.parent), {})[id(node)] = node
            node = node.parent
    here = root
    while here.weight and here.name not in ("article", "main"):
        all_ = list(children.get(id(here), {}).values())
        inner = [c for c in all_ if c.name in AROUND and c.weight >= SHARE * here.weight]
        if not inner:
            break
        best = max(inner, key=lambda c: c.weight)
        outside = [c for c in all_ if c is not best and c.weight]
        # Weight that is in no child is text of its own.
        if here.weight > sum(c.weight for c in all_) or any(c.name not in AROUND or c.key == best.key or _has_heading(c, children) for c in outside):
            break
        here = best
    return here.path


def inside(owner: Node, path: str) -> bool:
    node: Node | None = owner
    while node is not None:
        if node.path == path:
            return True
        node = node.parent
    return False


def main_text(page: str, path: str | None) -> str:
    """The blocks in containers of the path, or else of the page's own best container, joined by two line feeds."""
    root, blocks = parse(page)
    if not blocks:
        return ""
    kept = [t for o, t in blocks if path and inside(o, path)]
    if not kept:
        own = best_container(root, blocks)
        kept = [t for o, t in blocks if inside(o, own)]
    return "\n\n".join(kept)


def host_of(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, weights = [], []
        for page in batch.column(1):
            root, blocks = parse(page.as_py() or "")
            paths.append(best_container(root, blocks) if blocks else None)
            weights.append(root.weight)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string()), pa.array(weights, pa.int64())], ["host", "path", "weight"])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py() or "", path.as_py()) for page, path in zip(batch.column(0), batch.column(1), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*batch.schema.names[2:], "text", "n_chars"])


#: Hosts whose paths are sent to all executors, and characters of these; with more, pages are joined with them by host.
MOST_SENT, MOST_SENT_CHARS = 50_000, 16 << 20


def host_paths(pages: DataFrame) -> DataFrame:
    """The winning container path of each host (columns host, html): most votes, then most text, then the name."""
    votes = pages.select("host", "html").mapInArrow(_votes, "host string, path string, weight long").where("path is not null")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("weight").alias("weight"))
    return counted.groupBy("host").agg(F.max_by("path", F.struct("votes", "weight", "path")).alias("path"), F.max("votes").alias("votes"), F.sum("votes").alias("pages"))


def extract(frame: DataFrame, page: str = "html", url: str = "url", key: str = "page_id", least_share: float = 0.5) -> DataFrame:
    """The main text of every page: key, url, text, n_chars.

    A host's winning path is used if `least_share` of its pages with text voted for it, on pages that have it; all
    others use their own best container.  Null and empty pages have an empty text; a page whose url is null or
    without a host belongs to the host ""; repeated rows and equal keys stay rows of their own; other columns are not
    read.  An empty table gives an empty result.
    """
    kinds = dict(frame.dtypes)
    named = frame.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), host_of(F.col(f"`{url}`").cast("string")).alias("host"), F.col(f"`{page}`").cast("string").alias("html"))
    winners = materialise(host_paths(named).where(f"votes >= {least_share} * pages").select("host", "path"), "paths")
    count, chars = winners.agg(F.count("*"), F.sum(F.length("host") + F.length("path"))).first()
    small = count <= MOST_SENT and (chars or 0) <= MOST_SENT_CHARS
    joined = named.join(F.broadcast(winners) if small else winners, "host", "left")
    schema = f"key {kinds[key]}, url string, text string, n_chars long"
    return joined.select("html", "path", "key", "url").mapInArrow(_extracted, schema).select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
