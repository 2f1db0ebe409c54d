"""Main text of HTML pages with a site style tree.

The pages of a host are merged into one tree of style nodes (path of tags and classes). Importance has two sources. Content: a block of text is the less
important the more pages of the host show the same text at the same node, 1 - ln(pages with it) / ln(pages with the node + PSEUDO_PAGES).
Presentation: a node is the less important the more its sequences of child tags are alike (their entropy). A branch has the composite importance of both,
(1 - CONTENT_SHARE) * presentation + CONTENT_SHARE * mean of its children by length of text. From the root down, each branch with less than
MIN_IMPORTANCE times the importance of the page's median text (the block in which half of its text is reached, from the least important on) is removed.
So a page that reads like others in most of its text, a near copy and not a template around a text of its own, keeps it.

Markup is a prior. Branches that say what they are (menus, headers, footers, sidebars, notices, adverts, forms, reader comments) carry a factor that no importance can make
up for (an advert's text differs on every page), and so does what lies beside an explicit article; these are left out while parsing.

The tree of a host is a set of aggregated tables, (host, node, text or child tags) -> count, so a host with a third of all pages is combined map-side and never
gathered. Pages are parsed twice: for the tree's hashes, and for the text; texts are neither stored nor exchanged unless the table of pages that lose something is large.

Defined results: null or empty html, or a page without main text, gives an empty text; broken markup is read as far as it goes (an unclosed tag at the end is
dropped, an unpaired quote is part of its tag); scripts, styles, templates, frames and form controls hold no text; pages of a host that read alike count once in its
tree; pages without a host lose nothing by importance; pages and blocks of any length are read whole; equal pages get equal results; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import materialise, ship
from tramline.llm.url_filter import parts_of

MIN_IMPORTANCE = 0.3
CONTENT_SHARE = 0.9
#: Pages without a text that are assumed besides those seen, so that two like pages prove little and a hundred prove much.
PSEUDO_PAGES = 4

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|iframe|textarea|select)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<[!?/][^>]*>"
    r"|<[a-zA-Z/!?][^>]*\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORD = re.compile(r"[a-z0-9]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mrow msub msup mtext object q ruby rp rt s samp small span strike strong sub sup time tt u var wbr".split())
NOISE_TAGS = frozenset("head nav footer aside form button menu dialog fieldset".split())
#: A class or id is noise if it is made of these words, or of these and the neutral ones.
NOISE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner nav navbar navigation menu menubar
    breadcrumb breadcrumbs sidebar aside rail footer header masthead topbar cookie cookies consent gdpr notice notices alert warning popup modal overlay
    newsletter subscribe subscription signup login form search searchbox share sharing social related recommended recommendations comments comment
    commentlist disqus replies reply respond widget toolbar pagination pager skip hidden copyright disclaimer""".split()
)
NEUTRAL_WORDS = frozenset(
    """site page top bottom left right main side bar box list lists item items section sections wrap wrapper container content block blocks area slot unit inner outer
    global primary secondary user users reader readers area panel group links link posts post articles stories buttons button bar row col x l r m s xs sm md lg xl wide fixed sticky mobile desktop""".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: A start tag of the first kind ends an open element of the second.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",)}
WALLS = frozenset("ul ol dl table article section div main body html aside nav header footer form blockquote".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

NOISE, PLAIN, MAIN = 0, 1, 2


class Open:
    """An element on the stack; ``at`` is its number among the page's elements that aren't inline."""

    __slots__ = ("at", "key", "kids", "main", "noise", "tag")

    def __init__(self, tag: str, key: int, noise: bool, main: bool, at: int) -> None:
        self.tag, self.key, self.noise, self.main, self.at, self.kids = tag, key, noise, main, at, []


def names_noise(name: str) -> bool:
    words = WORD.findall(name)
    return not NOISE_WORDS.isdisjoint(words) and all(w in NOISE_WORDS or w in NEUTRAL_WORDS or w.isdigit() for w in words)


def looks_like_noise(tag: str, given: dict[str, str], in_main: bool) -> bool:
    if tag in NOISE_TAGS or tag == "header" and not in_main:
        return True
    if not given:
        return False
    if given.get("role", "").strip() in NOISE_ROLES or "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", ""):
        return True
    if tag in ("html", "body", "main"):
        return False
    names = f"{given.get('class', '')} {given.get('id', '')}"
    return "comment" in names if tag == "article" else any(map(names_noise, names.split()))


class Page:
    """The candidate blocks of a page, (element, node, text) in page order, and its elements, (node, parent, hash of child tags)."""

    def __init__(self, page: str | None) -> None:
        self.elements: list[list[int]] = []
        found: list[tuple[int, int, int, str]] = []
        root = Open("", 0, False, False, 0)
        self.elements.append([0, -1, 0])
        stack = [root]
        held: list[str] = []

        def flush() -> None:
            if held:
                text = " ".join(entities.unescape("".join(held)).split())
                held.clear()
                if text:
                    top = next(x for x in reversed(stack) if x.tag not in INLINE)
                    found.append((NOISE if top.noise else MAIN if top.main else PLAIN, top.at, top.key, text))

        def close(n: int) -> None:
            while len(stack) > n:
                x = stack.pop()
                if x.kids and x.tag not in INLINE:
                    self.elements[x.at][2] = zlib.crc32(" ".join(x.kids).encode("utf-8", "replace"))

        page, at = page or "", 0
        for m in TOKEN.finditer(page):
            if m.start() > at:
                held.append(page[at : m.start()])
            at = m.end()
            tag = m[3]
            if not tag:
                continue
            tag = tag.lower()
            if m[2]:
                if tag in VOID:
                    held.append(" ")
                    continue
                n = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
                if tag not in INLINE:
                    flush()
                if n:
                    close(n)
                continue
            if tag in INLINE:
                if tag == "br":
                    held.append(" ")
            else:
                flush()
            if tag in ENDS_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag in WALLS:
                        break
            for ended in CLOSES.get(tag, ()):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == ended:
                        close(i)
                        break
                    if stack[i].tag in WALLS:
                        break
            top = stack[-1]
            given = {k.lower(): (a or b or c).lower() for k, a, b, c in ATTRIBUTE.findall(m[4])} if "=" in m[4] else {}
            if " hidden" in f" {m[4].lower()}".replace("aria-hidden", ""):
                given.setdefault("hidden", "")
            if tag not in INLINE:
                top.kids.append(tag)
            if tag in VOID:
                continue
            key = zlib.crc32(f"{top.key}/{tag}.{given.get('class', '')}".encode("utf-8", "replace"))
            inside = top.at
            if tag not in INLINE:
                inside = len(self.elements)
                self.elements.append([key, top.at, 0])
            stack.append(Open(tag, key, top.noise or looks_like_noise(tag, given, top.main), top.main or tag in ("article", "main") or given.get("role") == "main", inside))
        if at < len(page):
            held.append(page[at:])
        flush()
        close(1)
        best = max((b[0] for b in found), default=NOISE)
        self.n_marked = sum(b[0] != best or not best for b in found)  # blocks that markup rules out
        self.blocks = [b[1:] for b in found if b[0] == best and best]

    def skeleton(self) -> tuple[list[list[int]], list[list[int]]]:
        """The elements above candidate blocks, (node, parent, child tags), and the blocks, (element, node, hash of text, length)."""
        needed = set()
        for at, _, _ in self.blocks:
            while at >= 0 and at not in needed:
                needed.add(at)
                at = self.elements[at][1]
        number = {at: i for i, at in enumerate(sorted(needed))}  # parents come first
        elements = [[self.elements[at][0], number.get(self.elements[at][1], -1), self.elements[at][2]] for at in sorted(needed)]
        return elements, [[number[at], key, zlib.crc32(text.encode("utf-8", "replace")), len(text)] for at, key, text in self.blocks]


ELEMENT = pa.list_(pa.struct([("k", pa.int64()), ("parent", pa.int32()), ("shown", pa.int64())]))
BLOCK = pa.list_(pa.struct([("element", pa.int32()), ("k", pa.int64()), ("h", pa.int64()), ("size", pa.int32())]))
STRUCTURE = "host string, page long, reads long, elements array<struct<k:long,parent:int,shown:long>>, blocks array<struct<element:int,k:long,h:long,size:int>>"
AT_ONCE = 256


def _structures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            pages = [Page(x) for x in part.column(2).to_pylist()]
            reads = [int.from_bytes(hashlib.blake2b("\n".join(b[2] for b in p.blocks).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) for p in pages]
            skeletons = [p.skeleton() for p in pages]
            elements = pa.array([[dict(zip(("k", "parent", "shown"), e, strict=True)) for e in s[0]] for s in skeletons], ELEMENT)
            blocks = pa.array([[dict(zip(("element", "k", "h", "size"), b, strict=True)) for b in s[1]] for s in skeletons], BLOCK)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(reads, pa.int64()), elements, blocks], names=["host", "page", "reads", "elements", "blocks"])


def content_importance(pages: DataFrame) -> DataFrame:
    """(host, k, h, importance) of the texts that more than one page of a host shows at a node."""
    own = pages.select("host", F.explode(F.array_distinct(F.transform("blocks", lambda b: F.struct(b["k"].alias("k"), b["h"].alias("h"))))).alias("b"))
    shown = own.groupBy("host", F.col("b.k").alias("k"), F.col("b.h").alias("h")).agg(F.count("*").alias("n")).filter("n > 1")
    nodes = pages.select("host", F.explode(F.array_distinct(F.transform("blocks", lambda b: b["k"]))).alias("k")).groupBy("host", "k").agg(F.count("*").alias("m"))
    return shown.join(nodes, ["host", "k"]).select("host", "k", "h", (1 - F.log("n") / F.log(F.col("m") + PSEUDO_PAGES)).alias("importance"))


def presentation_importance(pages: DataFrame) -> DataFrame:
    """(host, k, importance): entropy of a node's sequences of child tags, 1 where each differs and 0 where all are alike."""
    own = pages.select("host", F.explode("elements").alias("e"))
    counts = own.groupBy("host", F.col("e.k").alias("k"), F.col("e.shown").alias("shown")).agg(F.count("*").cast("double").alias("n"))
    parts = counts.groupBy("host", "k").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
    entropy = F.when(F.col("m") > 1, 1 - F.col("s") / F.col("m") / F.log("m")).otherwise(1.0)
    return parts.select("host", "k", ((F.col("m") * entropy + PSEUDO_PAGES) / (F.col("m") + PSEUDO_PAGES)).alias("importance"))


def removed_blocks(elements: list[dict], blocks: list[dict], content: dict[int, float], presentation: dict[int, float], least: float) -> list[int]:
    """Numbers of the blocks in branches below ``least`` times the importance of the page's median text. Blocks and elements without a figure have importance 1."""
    weight, mass = [0.0] * len(elements), [0.0] * len(elements)
    own = [content.get(i, 1.0) for i in range(len(blocks))]
    for b, x in zip(blocks, own, strict=True):
        weight[b["element"]] += b["size"]
        mass[b["element"]] += b["size"] * x
    value = [1.0] * len(elements)
    for i in range(len(elements) - 1, -1, -1):
        value[i] = (1 - CONTENT_SHARE) * presentation.get(i, 1.0) + CONTENT_SHARE * mass[i] / max(1.0, weight[i])
        if i:
            weight[elements[i]["parent"]] += weight[i]
            mass[elements[i]["parent"]] += weight[i] * value[i]
    bound, seen = 0.0, 0
    for x, b in sorted(zip(own, (b["size"] for b in blocks), strict=True)):
        seen += b
        if 2 * seen >= weight[0]:
            bound = least * x
            break
    gone = [False] * len(elements)
    for i in range(1, len(elements)):
        gone[i] = gone[elements[i]["parent"]] or value[i] < bound
    return [i for i, (b, x) in enumerate(zip(blocks, own, strict=True)) if gone[b["element"]] or x < bound]


def _judged(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            figures = lambda found: {x["at"]: x["importance"] for x in found or []}
            gone = [removed_blocks(r["elements"], r["blocks"], figures(r["content"]), figures(r["presentation"]), least) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))], names=["host", "reads", "removed"])

    return run


def removals(structures: DataFrame, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """(host, page, removed array<int>) of the pages that lose blocks to the style tree of their host."""
    known = structures.filter("host <> '' and size(blocks) > 0")
    pages = materialise(known.groupBy("host", "reads").agg(F.first(F.struct("elements", "blocks")).alias("s")).select("host", "reads", "s.elements", "s.blocks"))
    texts = materialise(content_importance(pages))
    blocks = pages.select("host", "reads", F.posexplode("blocks").alias("at", "b")).select("host", "reads", "at", "b.k", "b.h")
    figure = F.collect_list(F.struct("at", "importance"))
    # a branch below the bound holds a block below the bound over its content's share
    content = blocks.join(texts, ["host", "k", "h"]).groupBy("host", "reads").agg(figure.alias("content"), F.min("importance").alias("least")).filter(F.col("least") < min_importance / CONTENT_SHARE).drop("least")
    touched = materialise(pages.join(content, ["host", "reads"]))
    elements = touched.select("host", "reads", F.posexplode("elements").alias("at", "e")).select("host", "reads", "at", "e.k")
    presentation = elements.join(presentation_importance(pages), ["host", "k"]).groupBy("host", "reads").agg(figure.alias("presentation"))
    judged = touched.join(presentation, ["host", "reads"], "left").mapInArrow(_judged(min_importance), "host string, reads long, removed array<int>").filter("size(removed) > 0")
    return structures.select("host", "page", "reads").distinct().join(judged, ["host", "reads"]).select("host", "page", "removed")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(at, AT_ONCE)
            pages = [Page(x) for x in part.column(2).to_pylist()]
            gone = [frozenset(x or ()) for x in part.column(3).to_pylist()]
            texts = ["\n".join(b[2] for i, b in enumerate(p.blocks) if i not in g) for p, g in zip(pages, gone, strict=True)]
            counts = [pa.array(x, pa.int64()) for x in ([len(t) for t in texts], [len(g) for g in gone], [p.n_marked for p in pages])]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string()), *counts], names=["page_id", "url", "text", "n_chars", "n_removed", "n_marked"])


def extract(pages: DataFrame, min_importance: float = MIN_IMPORTANCE, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars, n_removed, n_marked): one row per page. n_removed: blocks in branches of low importance; n_marked: blocks that markup rules out."""
    ship(pages.sparkSession)
    host, key = parts_of(F.col(url))[0].alias("host"), F.xxhash64(F.col(html)).alias("page")
    structures = materialise(pages.select(host, key, F.col(html).alias("html")).mapInArrow(_structures, STRUCTURE))
    # written first, so that Spark knows its size: a small table is broadcast and no page is exchanged
    gone = materialise(removals(structures, min_importance)).select(F.col("host").alias("g_host"), F.col("page").alias("g_page"), "removed")
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), host, key, F.col(html).alias("html"))
    own = own.join(gone, (F.col("host") == F.col("g_host")) & (F.col("page") == F.col("g_page")), "left")
    return own.select("page_id", "url", "html", "removed").mapInArrow(_texts, "page_id long, url string, text string, n_chars long, n_removed long, n_marked long")
