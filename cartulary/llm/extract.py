"""Main text of web pages by host suffix arrays and markup.

A page is read into blocks in page order, each with what its markup says: main content
(article, main), beside it (menus, footers, forms, adverts, reader comments and so on), or nothing.
Blocks outside main content form regions, one for each list, division or section. The token
streams of a host's regions are concatenated and their suffixes sorted (to `SPAN` tokens: deeper order
doesn't change which tokens lie in a repeat of `SPAN` or more). Neighbours with a common prefix that come
from distinct pages are repeats; a region shorter than `SPAN` is compared whole. A block with half its
tokens in repeats is boilerplate. Of what is left, blocks that markup puts beside the main content go too,
and unique runs stay. Prose outside any main content (`PROSE` tokens or more, few of them links) may be an article with
copies, so it only counts as boilerplate where a tenth of the host's pages, three at least, repeat it.

Copies of a page are one page here: pages are told apart by host and all visible text. Equal regions are
combined before they are shuffled with texts. A host of more than `BLOCK` tokens is dealt by region to several
arrays; what repeats only between arrays is found by joining their prefixes, so a host with a third of
all pages gives the same result and no task holds more than a block and one region. Hosts, regions and
pages are matched by joins; nothing is broadcast by request or collected.

Null html is empty, and so is the text of a page without any. A null url, or one without `://`, has no host:
such pages are judged by markup alone. Equal rows get equal results. Columns of the pages other than html are
kept; those named like a result are replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartulary.llm.common import add_columns
from cartulary.llm.urls import host_of
from cartulary.sources.storage import drop_path, stage

SPAN = 8
BLOCK = 1 << 20
PROSE = 25
RESULTS = "text string, n_repeated int, n_marked int"

#: Fixed values of HTML: elements by how they hold text.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby s samp small span strike strong sub sup time tt u var".split())
BREAKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody tfoot thead tr ul".split()
)
REGIONS = frozenset("article aside body center details dialog dir div dl fieldset footer form header main menu nav ol search section table ul".split())
#: An element that opens closes an open one of its group, up to the nearest of the scope.
CLOSES = {
    **dict.fromkeys(("li",), (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir")))),
    **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), frozenset(("dl",)))),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("table", "tr")))),
    **dict.fromkeys(("tr",), (frozenset(("tr",)), frozenset(("table",)))),
    **dict.fromkeys(("option", "optgroup"), (frozenset(("option",)), frozenset(("select",)))),
}
#: Elements, roles and words of class or id that stand beside the main text.
BESIDE = frozenset("nav footer aside menu noscript template svg object video audio canvas select button datalist dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer masthead cookie cookies consent gdpr notice notices newsletter subscribe signup login popup modal overlay share sharing social related "
    "recommended recommendations comment comments disqus respond widget widgets toolbar pagination pager".split()
)
ARTICLE_HINTS = frozenset("comment comments ad advert promo sponsored related teaser".split())

TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
WORDS = re.compile("[a-z]+")
CAMEL = re.compile("(?<=[a-z])(?=[A-Z])")

NEUTRAL, MAIN, BEYOND, AROUND = range(4)


class Block(NamedTuple):
    region: int
    state: int
    linked: int
    text: str


def _hinted(name: str, rest: str) -> bool | None:
    """Whether attributes put the element beside the main text; None for main content itself."""
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), unescape(value.strip("\"'")).strip()
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "role":
            if value.lower() == "main":
                return None
            if value.lower() in ROLES:
                return True
        elif key == "itemprop" and value.lower() == "articlebody":
            return None
        elif key in ("class", "id"):
            if name == "article":
                if not ARTICLE_HINTS.isdisjoint(value.lower().split()):
                    return True
            elif not HINTS.isdisjoint(WORDS.findall(CAMEL.sub(" ", value).lower())):
                return True
    return False


def state_of(name: str, rest: str, around: int) -> int:
    """State of an element inside an element of state `around`. AROUND is beside, unless main content opens in it."""
    if around == BEYOND or name in BESIDE:
        return BEYOND
    hint = _hinted(name, rest) if rest and name not in ("html", "body", "main") else False
    if hint:
        return BEYOND
    if hint is None or name in ("article", "main"):
        return MAIN
    if name == "form":
        return BEYOND if around == MAIN else AROUND
    if name == "header" and around != MAIN:
        return AROUND
    return around


class Reader:
    """Reads one page; open elements are kept with their states."""

    def __init__(self):
        self.open: list[tuple[str, int]] = []
        self.count: dict[str, int] = {}
        self.region = 0
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0

    @property
    def state(self) -> int:
        return self.open[-1][1] if self.open else NEUTRAL

    def add(self, text: str) -> None:
        text = unescape(text) if "&" in text else text
        self.parts.append(text)
        if self.count.get("a"):
            self.linked += len(text.split())

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(self.region, self.state, self.linked, text))
            self.parts, self.linked = [], 0

    def push(self, name: str, state: int) -> None:
        if state != self.state:
            self.end_block()
            self.region += 1
        self.open.append((name, state))
        self.count[name] = self.count.get(name, 0) + 1

    def pop(self) -> str:
        name, state = self.open[-1]
        if state != (self.open[-2][1] if len(self.open) > 1 else NEUTRAL):
            self.end_block()
            self.region += 1
        self.open.pop()
        self.count[name] -= 1
        return name

    def pop_to(self, names: frozenset, scope: frozenset) -> None:
        """Close the nearest open element of `names`, if none of `scope` is nearer."""
        if not any(self.count.get(n) for n in names):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in names:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i][0] in scope:
                return

    def starts(self, name: str, rest: str) -> None:
        if name in BREAKS:
            self.end_block()
            if self.count.get("p"):
                while self.pop() != "p":
                    pass
        if name in CLOSES:
            self.pop_to(*CLOSES[name])
        if name in REGIONS:
            self.region += 1
        if name in ("br", "td", "th"):
            self.parts.append(" ")
        if name not in VOID:
            self.push(name, state_of(name, rest, self.state))

    def ends(self, name: str) -> None:
        if name in BREAKS:
            self.end_block()
        if name in REGIONS:
            self.region += 1
        if not self.count.get(name):
            return
        if name in INLINE:
            self.pop_to(frozenset((name,)), BREAKS)
        else:
            while self.pop() != name:
                pass


def blocks_of(html: str | None) -> list[Block]:
    """Blocks of visible text in page order. Elements that are cut off end with the page."""
    html, reader, at = html or "", Reader(), 0
    while tag := TAG.search(html, at):
        if tag.start() > at:
            reader.add(html[at : tag.start()])
        at = tag.end()
        if not tag[2]:
            continue
        name = tag[2].lower()
        if tag[1]:
            reader.ends(name)
        elif name in RAW:
            closing = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(html, at)
            at = closing.end() if closing else len(html)
        else:
            reader.starts(name, tag[3])
    reader.add(html[at:])
    reader.end_block()
    return reader.blocks


def digest(*parts: str) -> bytes:
    return blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=16).digest()


def regions_of(blocks: list[Block]) -> dict[int, str]:
    """Texts of the regions outside main content, a block a line."""
    found: dict[int, list[str]] = {}
    for b in blocks:
        if b.state != MAIN:
            found.setdefault(b.region, []).append(b.text)
    return {r: "\n".join(texts) for r, texts in found.items()}


def page_digest(host: str, blocks: list[Block]) -> bytes:
    return digest(host, *[f"{b.region}:{b.state}:{b.text}" for b in blocks])


# -- suffix arrays --------------------------------------------------------------------------


def suffix_classes(streams: list[list[str]], span: int) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """The suffix array of streams laid end to end, sorted to `span` tokens.

    Returns the sorted suffixes (places in the whole), where each run of equal prefixes begins in that order, all
    tokens, and the stream of each place. Suffixes with fewer than `span` tokens of their stream left are left out.
    """
    number: dict[str, int] = {}
    sizes = np.array([len(s) for s in streams])
    ids = np.array([number.setdefault(t, len(number)) for s in streams for t in s], np.int64)
    stream = np.repeat(np.arange(len(streams)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(ids))
    rank, depth = ids, 1
    while depth < span:
        step = min(depth, span - depth)
        further = np.concatenate([rank[step:], np.zeros(step, np.int64)])[: len(rank)]
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + further, return_inverse=True)[1].astype(np.int64)
        depth += step
    places = np.flatnonzero(left >= span)
    order = places[np.argsort(rank[places], kind="stable")]
    begins = np.flatnonzero(np.diff(rank[order], prepend=-1))
    return order, begins, [t for s in streams for t in s], stream


CLASSES = "host string, prefix binary, first binary, last binary, n long, pages long, regions array<binary>, starts array<int>"


def repeated_prefixes(span: int, table: pa.Table) -> pa.Table:
    """Of one host's block: prefixes of `span` tokens with the pages and places they stand in; all of them where the host has more blocks."""
    host, pages, parts = (table.column(c)[0].as_py() for c in ("host", "pages", "parts"))
    regions, firsts, lasts, counts = (table.column(c).to_pylist() for c in ("region", "first", "last", "n"))
    streams = [t.split() for t in table.column("text").to_pylist()]
    out: list[tuple] = []
    for r, tokens in enumerate(streams):
        if len(tokens) < span and firsts[r] != lasts[r]:
            out.append((host, digest(host, *tokens), firsts[r], lasts[r], counts[r], pages, [regions[r]], [0]))
    order, begins, tokens, stream = suffix_classes(streams, span)
    offsets = np.cumsum([0] + [len(s) for s in streams])
    for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(order)]):
        own = order[begin:end]
        inside = stream[own].tolist()
        different = set(inside)
        first, last = min(firsts[r] for r in different), max(lasts[r] for r in different)
        if first == last and parts == 1:
            continue
        prefix = digest(host, *tokens[own[0] : own[0] + span])
        out.append((host, prefix, first, last, sum(counts[r] for r in different), pages, [regions[r] for r in inside], (own - offsets[inside]).tolist()))
    schema = pa.schema([("host", pa.string()), *[(c, pa.binary()) for c in ("prefix", "first", "last")], ("n", pa.int64()), ("pages", pa.int64()), ("regions", pa.list_(pa.binary())), ("starts", pa.list_(pa.int32()))])
    columns = list(zip(*out)) if out else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def region_rows(pages: DataFrame) -> DataFrame:
    """(host, page, region, text, tokens) of each page's regions, and one row without region for the page itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                blocks = blocks_of(html)
                page = page_digest(host, blocks)
                rows.append((host, page, None, None, 0))
                rows += [(host, page, digest(text), text, len(text.split())) for text in set(regions_of(blocks).values())]
            types = (pa.string(), pa.binary(), pa.binary(), pa.string(), pa.int64())
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "page", "region", "text", "tokens"])

    return pages.select("host", "html").where("host <> ''").mapInArrow(run, "host string, page binary, region binary, text string, tokens long")


def repeats(rows: DataFrame, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """(host, region, starts, common): where repeats begin in a region, and which of them a tenth of the host's pages hold."""
    own = rows.groupBy("host", "region").agg(
        F.first("text").alias("text"), F.max("tokens").alias("tokens"), F.min("page").alias("first"), F.max("page").alias("last"), F.count_distinct("page").alias("n")
    )
    regions, at = stage(own, "regions")
    sizes = regions.groupBy("host").agg(F.sum("tokens").alias("total"), F.max(F.when(F.col("region").isNull(), F.col("n"))).alias("pages"))
    hosts = sizes.select("host", "pages", F.greatest(F.lit(1), F.ceil(F.col("total") / block)).alias("parts"))
    dealt = regions.where("region is not null").join(hosts, "host").withColumn("part", F.pmod(F.xxhash64("region"), F.col("parts")))
    classes, at_classes = stage(dealt.groupBy("host", "part").applyInArrow(lambda t: repeated_prefixes(span, t), CLASSES), "prefixes")
    merged = classes.groupBy("host", "prefix").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.max("pages").alias("pages"))
    held = merged.where("first <> last").select("host", "prefix", ((F.col("n") >= 3) & (10 * F.col("n") >= F.col("pages"))).alias("common"))
    places = classes.select("host", "prefix", F.arrays_zip("regions", "starts").alias("places")).join(held, ["host", "prefix"])
    single = places.select("host", "common", F.explode("places").alias("p")).select("host", F.col("p.regions").alias("region"), F.struct(F.col("p.starts").alias("at"), "common").alias("s"))
    found = single.groupBy("host", "region").agg(F.collect_set("s").alias("s"))
    result, _ = stage(found.select("host", "region", F.col("s.at").alias("starts"), F.col("s.common").alias("common")), "repeats")
    for path in (at, at_classes):
        drop_path(rows.sparkSession, path)
    return result


# -- pages ----------------------------------------------------------------------------------


def decide(blocks: list[Block], found: dict[bytes, tuple[list[int], list[bool]]], span: int) -> tuple[str, int, int]:
    """Main text, blocks removed as repeated, and blocks removed by markup alone."""
    covered: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for region, text in regions_of(blocks).items():
        if places := found.get(digest(text)):
            n = len(text.split())
            both = []
            for starts in (np.array(places[0]), np.array(places[0])[np.array(places[1], bool)]):
                edges = np.zeros(n + 1, np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, np.minimum(starts + span, n), -1)
                both.append(np.cumsum(edges[:-1]) > 0)
            covered[region] = tuple(both)
    kept, repeated, marked, region, at = [], 0, 0, None, 0
    for b in blocks:
        n = len(b.text.split())
        at = at if b.region == region else 0
        region = b.region
        here = slice(at, at + n)
        at += n
        if b.state == MAIN:
            kept.append(b.text)
            continue
        if region in covered:
            prose = n >= PROSE and 3 * b.linked < n
            if 2 * covered[region][prose][here].sum() >= n:
                repeated += 1
                continue
        if b.state == NEUTRAL:
            kept.append(b.text)
        else:
            marked += 1
    return "\n".join(kept), repeated, marked


BLOCKS = "page binary, blocks array<struct<region:int,state:int,linked:int,text:string>>"


def _blocks_column(batch: pa.RecordBatch) -> list:
    pages, blocks = [], []
    for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
        own = blocks_of(html)
        pages.append(page_digest(host, own) if host else None)
        blocks.append([b._asdict() for b in own])
    kind = pa.list_(pa.struct([("region", pa.int32()), ("state", pa.int32()), ("linked", pa.int32()), ("text", pa.string())]))
    return [pa.array(pages, pa.binary()), pa.array(blocks, kind)]


def main_text(pages: DataFrame, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """`pages` (url, html) without html, with text and how many blocks repeats (n_repeated) and markup alone (n_marked) removed."""
    others = [c for c in pages.columns if c != "html"]
    read = pages.select(F.struct(*[pages[c] for c in others]).alias("whole"), host_of(pages["url"]).alias("host"), pages["html"].alias("html"))
    rows, at = stage(region_rows(read), "page-regions")
    regions = rows.where("region is not null").select("host", "page", "region").distinct().join(repeats(rows, span, block), ["host", "region"])
    found = regions.groupBy("page").agg(F.collect_list(F.struct("region", "starts", "common")).alias("found"))
    texts = add_columns(read, _blocks_column, BLOCKS).drop("html", "host").join(found, "page", "left").drop("page")

    def run(batch: pa.RecordBatch) -> list:
        out = []
        for blocks, found in zip(batch.column("blocks").to_pylist(), batch.column("found").to_pylist()):
            places = {f["region"]: (f["starts"], f["common"]) for f in found or ()}
            out.append(decide([Block(**b) for b in blocks], places, span))
        return [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, (pa.string(), pa.int32(), pa.int32()))]

    results = StructType.fromDDL(RESULTS).fieldNames()
    judged = add_columns(texts, run, RESULTS)
    return judged.select(*[F.col("whole")[c].alias(c) for c in others if c not in results], *results)
