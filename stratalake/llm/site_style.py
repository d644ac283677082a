"""HTML extraction by a site style tree.

The DOMs of a host's pages are merged: elements with the same path of tags, classes and ids are one
node of the host's style tree. A node's presentation importance is the entropy of the child
sequences that its pages show there; its content importance falls with the entropy with which the
same texts are spread over the pages. Both are mixed into one importance per node; branches of
low importance are the same on all pages and are removed from each page. If a page marks its
article or main part, only that is looked at.

Elements whose tag or role says that they are no article text (menus, headers, footers, asides, forms)
have no importance, unless all article and main parts of the page lie in them or a form holds most of
the page's text. Words in a class or id (menus, sidebars, notices, adverts, comments) only lower a
node's importance, by the share of such words in its name; the style tree decides. Where the tree has
seen the node on one page only, such an element goes, unless it holds most of the page's text or its
name also says article and it holds the headline. An element around an article or main part is never
noise by its name.

Importance is weighted by confidence: ``caution`` imaginary pages of full importance stand beside a
node's own pages, so few pages must agree more than many to make a branch low. Inside an article or
main part it is at least ``CAUTION``: a sentence that two articles share is no evidence. Pages of a
host whose main parts (the whole page, if it marks none) agree but for white space count as one page
together, whatever stands around them: versions or copies say nothing about boilerplate. If
low branches hold most of a main part's text, its pages are near copies of one another, and it is kept
whole; a page that marks a main part never falls back to what lies around it.

A header inside a main part that holds a headline belongs to it. As in browsers, elements nested deeper
than ``DEEPEST`` levels are read as children of that level.

Statistics are summed inside tasks first and then by (host, node, feature), so a hot host is spread
over all of its features. The judged branches of all hosts are broadcast if there are at most
``BROADCAST_NODES`` of them (8 bytes each); beyond that, pages are joined with those of their host. The
copied main parts are broadcast up to the same number (16 bytes each) and joined beyond.

Defined cases: a NULL or empty html gives an empty text; a NULL url is a host of its own. Unclosed and
stray tags are read as browsers do in the main. Repeated rows are pages like any others. An empty
table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator, Set
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import settings
from stratalake.session import staged

#: Imaginary pages of full importance. At 1 a node needs five pages to be low, at ``EAGER`` two.
CAUTION, EAGER = 1.0, 0.4
LOW = 0.2
#: How much of its importance a node loses if its name has noise words alone.
NAME_WEIGHT = 0.8
_GAMMA = 0.9
BROADCAST_NODES = 1_000_000
#: Levels of nesting that browsers keep.
DEEPEST = 512
_TASK_FEATURES = 200_000
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

# Names of the HTML standard, and words that sites use in classes and ids.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe svg canvas object math".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
NOISE_TAGS = set("head nav header footer aside form menu dialog button select option input".split()) | RAW
NOISE_ROLES = set(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
    "toolbar".split()
)
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promos "
    "promotion nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar "
    "sidebars aside widget widgets notice notices cookie cookies consent gdpr banner alert popup modal "
    "overlay newsletter subscribe subscription signup login search form comment comments commentlist "
    "disqus respond reply replies share sharing social related recommended pagination pager toolbar "
    "skip".split()
)
#: Elements that a start tag of the key closes, if one of them is open inside the nearest scope.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead"},
}
SCOPE = set("ul ol dl table article section div main aside nav header footer form td th body".split())
MAIN_TAGS = {"article", "main"}
REPLY_WORDS = {"comment", "reply", "replies"}
ARTICLE_WORDS = set("article entry post story content main body hentry".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
HEADLINES = set("h1 h2 h3 h4 h5 h6".split())


@dataclass(slots=True)
class Suspect:
    """An element that may be noise: by its tag or role, else by the words of its name."""

    tag: str
    node: int
    by_tag: bool
    article_name: bool
    in_main: bool
    outer: Suspect | None  # the next one around it
    mains: int = 0  # article and main parts inside
    headline: bool = False  # an h1 inside
    heading: bool = False  # any heading inside
    chars: int = 0
    gone: bool = False  # noise by tag, or inside such
    named: bool = False  # noise by its name unless the tree keeps it


@dataclass(slots=True)
class Element:
    """An element, linked to the one around it: a page needs as much as it has elements, however
    deeply they are nested."""

    tag: str
    node: int
    main: bool  # it is a main part or lies in one
    judged: bool  # blocks, and inline elements with a suspect name, are nodes of the tree
    above: Element | None
    depth: int
    suspect: Suspect | None  # the innermost suspect that it is or lies in
    children: list[str] = field(default_factory=list)


@dataclass(slots=True)
class Block:
    """Text without a block boundary or the border of a suspect, and the element it lies in."""

    text: str
    element: Element
    run: int  # blocks of a run have no block boundary between them
    space: tuple[bool, bool]  # white space before and after the text

    def nodes(self) -> set[int]:
        """The judged nodes that it lies in."""
        found, at = set(), self.element
        while at is not None:
            if at.judged:
                found.add(at.node)
            at = at.above
        return found


@dataclass(slots=True)
class Page:
    """Text blocks outside noise by tag, in order, (element, child sequence) of the elements outside
    it, and the share of noise words of nodes that are suspects by name."""

    blocks: list[Block]
    looks: list[tuple[Element, str]]
    shares: dict[int, float]


@dataclass
class Style:
    """What an element's tag and attributes say."""

    node: int
    by_tag: bool
    share: float  # of noise words in its class and id
    article_name: bool
    main: bool


_KNOWN: dict[tuple[int, str, str], Style] = {}


def _node(parent: int, tag: str, attributes: str) -> Style:
    key = (parent, tag, attributes if len(attributes) < 200 else "")
    if key in _KNOWN and len(attributes) < 200:
        return _KNOWN[key]
    named = {"class": "", "id": "", "role": ""}
    for name, *values in _ATTRIBUTE.findall(attributes):
        named[name.lower()] = next((v for v in values if v), "")
    words = {w.lower() for w in _PARTS.findall(f"{named['class']} {named['id']}")}
    main = tag in MAIN_TAGS or named["role"].lower() == "main"
    share = len(words & NOISE_WORDS) / len(words) if words and tag not in ("html", "body", "main") else 0.0
    look = _DIGITS.sub("#", f"{parent}|{tag}|{named['class']}|{named['id']}")
    value = Style(
        xxhash.xxh3_64_intdigest(look) >> 1,
        tag in NOISE_TAGS or named["role"].lower() in NOISE_ROLES,
        0.0 if main and (share < 0.5 or share == 0.5 and words.isdisjoint(REPLY_WORDS)) else share,
        not words.isdisjoint(ARTICLE_WORDS),
        main,
    )
    if len(_KNOWN) >= 50_000:
        _KNOWN.clear()
    _KNOWN[key] = value
    return value


def parse(page: str) -> Page:
    blocks: list[Block] = []
    looks: list[tuple[Element, str]] = []
    suspects: list[Suspect] = []
    shares: dict[int, float] = {}
    mains = 0
    run = 0
    stack: list[Element] = [Element("", 0, False, False, None, 0, None)]
    pieces: list[str] = []

    def text(piece: str) -> None:
        if piece:
            pieces.append(piece)

    def flush(boundary: bool = True) -> None:
        nonlocal run
        if pieces:
            raw = entities.unescape("".join(pieces))
            words = raw.split()
            pieces.clear()
            if words:
                at, joined = stack[-1], " ".join(words)
                space = (raw[0].isspace(), raw[-1].isspace())
                blocks.append(Block(joined, at, run, space))
                if at.suspect:
                    at.suspect.chars += len(joined)
            elif blocks and blocks[-1].run == run:
                blocks[-1].space = (blocks[-1].space[0], True)
        run += boundary

    def close(count: int) -> None:
        """Close the innermost ``count`` elements."""
        for _ in range(count):
            if stack[-1].tag not in BLOCK and stack[-1].suspect is not stack[-2].suspect:
                flush(boundary=False)
            gone = stack.pop()
            if gone.judged:
                looks.append((gone, ",".join(gone.children)))
            gone.children.clear()

    def close_open(tags: set[str], scope: set[str]) -> None:
        for depth in range(1, len(stack)):
            tag = stack[-depth].tag
            if tag in tags:
                flush()
                close(depth)
                return
            if tag in scope:
                return

    at, end = 0, len(page)
    while at < end:
        found = _TAG.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in BLOCK:
                close_open({tag}, set())
                flush()
            else:
                close_open_inline(stack, tag, close)
            continue
        attributes = found[3]
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCK:
            flush()
            close_open({"p"}, {"button", "table", "td", "th"})
            if tag in CLOSED_BY:
                close_open(CLOSED_BY[tag], SCOPE - {tag} if tag in ("td", "th") else SCOPE)
        if len(stack) > DEEPEST:
            flush(boundary=False)
            close(1)
        parent = stack[-1]
        style = _node(parent.node, tag, attributes)
        if not parent.children or parent.children[-1] != tag:
            parent.children.append(tag)
        if tag in VOID or attributes.endswith("/") and tag in RAW:
            continue
        if tag in RAW:
            over = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = over.end() if over else end
            continue
        suspect = parent.suspect
        if style.main and style.share == 0:
            mains += 1
            if suspect:
                suspect.mains += 1
        elif tag in HEADLINES and suspect:
            suspect.heading = True
            suspect.headline |= tag == "h1"
        if style.by_tag or style.share:
            if tag not in BLOCK:
                flush(boundary=False)
            suspect = Suspect(tag, style.node, style.by_tag, style.article_name, parent.main, suspect)
            suspects.append(suspect)
            if style.share and not style.by_tag:
                shares[style.node] = style.share
        judged = tag in BLOCK or style.share > 0 and not style.by_tag
        stack.append(
            Element(tag, style.node, parent.main or style.main, judged, parent, len(stack), suspect)
        )
    flush()
    close(len(stack) - 1)
    _judge_suspects(suspects, blocks, mains)
    return Page(
        [b for b in blocks if not (b.element.suspect and b.element.suspect.gone)],
        [(e, look) for e, look in looks if not (e.suspect and e.suspect.gone)],
        shares,
    )


def _judge_suspects(suspects: list[Suspect], blocks: list[Block], mains: int) -> None:
    """Which suspects are noise. An element comes after those around it."""
    for found in reversed(suspects):
        if found.outer:
            found.outer.mains += found.mains
            found.outer.headline |= found.headline
            found.outer.heading |= found.heading
            found.outer.chars += found.chars
    most = sum(len(b.text) for b in blocks) / 2
    for found in suspects:
        if found.by_tag:
            around = found.mains == mains > 0 or found.tag == "form" and found.chars > most
            own_header = found.tag == "header" and found.in_main and found.heading
            found.gone = not (around or own_header)
        else:
            # A headline in an element whose name also says article is left to the tree.
            left = found.article_name and found.headline
            found.named = not (found.mains or found.chars > most or left)
        found.gone = found.gone or bool(found.outer and found.outer.gone)


def close_open_inline(stack: list[Element], tag: str, close) -> None:
    """An inline end tag closes its element unless a block began inside it."""
    for depth in range(1, len(stack)):
        if stack[-depth].tag == tag:
            close(depth)
            return
        if stack[-depth].tag in BLOCK:
            return


def _low(element: Element, low: Set[int], known: dict[int, bool]) -> bool:
    """Whether an element lies in a low branch."""
    chain, at = [], element
    while at is not None and id(at) not in known:
        chain.append(at)
        at = at.above
    found = known[id(at)] if at is not None else False
    for one in reversed(chain):
        found = found or one.judged and one.node in low
        known[id(one)] = found
    return found


def _unwanted(suspect: Suspect | None, kept: Set[int]) -> bool:
    """Whether a suspect or one around it is noise by its name."""
    while suspect is not None:
        if suspect.named and suspect.node not in kept:
            return True
        suspect = suspect.outer
    return False


def main_blocks(page: Page, low: Set[int] = frozenset(), kept: Set[int] = frozenset()) -> list[Block]:
    """Blocks of the main part; of the whole page if it marks none."""
    wanted: dict[int, bool] = {}
    blocks = []
    for block in page.blocks:
        key = id(block.element.suspect)
        if key not in wanted:
            wanted[key] = not _unwanted(block.element.suspect, kept)
        if wanted[key]:
            blocks.append(block)
    main = [b for b in blocks if b.element.main]
    known: dict[int, bool] = {}
    stay = [b for b in main or blocks if not _low(b.element, low, known)]
    if main and 2 * sum(len(b.text) for b in stay) < sum(len(b.text) for b in main):
        return main  # near copies of one article
    return stay


def _joined(blocks: list[Block]) -> str:
    """Texts of blocks, one line per run."""
    parts: list[str] = []
    before = None
    for block in blocks:
        if before is not None:
            same = before.run == block.run
            parts.append(("" if not (before.space[1] or block.space[0]) else " ") if same else "\n")
        parts.append(block.text)
        before = block
    return "".join(parts)


def extract(page: str | None, low: Set[int], kept: Set[int] = frozenset()) -> str:
    """The page's text without the branches in ``low``; ``kept`` are nodes that their name makes
    suspect and the tree keeps."""
    blocks = main_blocks(parse(page), low, kept) if page else []
    return _joined(blocks)


def host_of(url: Column) -> Column:
    """Host of a URL, lower-cased; empty without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


#: Kinds of features of a node: that a page has it (1: inside a main part), a child sequence, a text,
#: the share of noise words in its name in thousandths.
_PAGE, _LOOK, _CONTENT, _NAME = 0, 1, 2, 3


def _page_features(page: Page) -> Iterator[tuple[int, int, int, int]]:
    """(node, kind, feature, times) of a page."""
    counts: dict[tuple[int, int, int], int] = {}
    for element, look in page.looks:
        node = element.node
        counts[node, _PAGE, int(element.main)] = 1
        if node in page.shares:
            counts[node, _NAME, round(1000 * page.shares[node])] = 1
        key = (node, _LOOK, _hash(look))
        counts[key] = counts.get(key, 0) + 1
    for block in page.blocks:
        feature = _hash(block.text)
        for node in block.nodes():
            key = (node, _CONTENT, feature)
            counts[key] = counts.get(key, 0) + 1
    for (node, kind, feature), times in counts.items():
        yield node, kind, feature, times


def main_digest(host: str, page: Page) -> int:
    """Digest of a page's host and the text of its main part, white space aside."""
    text = "".join(b.text for b in main_blocks(page))
    return _hash(f"{host}\n{text.replace(' ', '')}")


def _narrow(pages: DataFrame) -> DataFrame:
    return pages.select(host_of(pages["url"]).alias("host"), pages["html"].cast("string").alias("html"))


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True)
        digests = [main_digest(host, parse(page or "")) for host, page in rows]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(digests, pa.int64())], ["host", "html", "digest"]
        )


def copied_pages(pages: DataFrame) -> DataFrame:
    """Rows (digest, copies) of the main parts that several pages of a host have."""
    digests = _narrow(pages).mapInArrow(_with_digest, "host string, html string, digest bigint")
    return digests.groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def _weights(copies: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    found = copies.toArrow()
    digests = found["digest"].to_numpy()
    order = np.argsort(digests)
    return digests[order], 1 / found["copies"].to_numpy()[order]


def style_tree(
    pages: DataFrame, copies: DataFrame | None = None, broadcast_nodes: int = BROADCAST_NODES
) -> DataFrame:
    """Rows (host, node, pages, presentation, content, importance, noise_words, main) of all hosts'
    style trees; noise_words is the share in the name of a node that its name makes suspect. Pages
    whose main part is in ``copies`` share the weight of one page."""
    narrow = _narrow(pages).withColumn("weight", F.lit(None).cast("double"))
    held = None
    if copies is not None and copies.count() <= broadcast_nodes:
        held = pages.sparkSession.sparkContext.broadcast(_weights(copies))
    elif copies is not None:
        keyed = _narrow(pages).mapInArrow(_with_digest, "host string, html string, digest bigint")
        weight = 1 / F.coalesce("copies", F.lit(1))
        narrow = keyed.join(copies, "digest", "left").select("host", "html", weight.alias("weight"))
    names = ["host", "node", "kind", "feature", "pages", "times", "spread"]
    schema = (
        "host string, node bigint, kind int, feature bigint, pages double, times double, "
        "spread double"
    )
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]

    def weight_of(host: str, page: Page) -> float:
        if held is None or not len(held.value[0]):
            return 1.0
        digests, weights = held.value
        digest = main_digest(host, page)
        at = min(int(np.searchsorted(digests, digest)), len(digests) - 1)
        return float(weights[at]) if digests[at] == digest else 1.0

    def batch_of(sums: dict) -> pa.RecordBatch:
        rows = [(*key, *value) for key, value in sums.items()]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for batch in batches:
            for host, html, weight in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page = parse(html or "")
                weight = weight_of(host, page) if weight is None else weight
                for node, kind, feature, times in _page_features(page):
                    at = sums.setdefault((host, node, kind, feature), [0.0, 0.0, 0.0])
                    at[0] += weight
                    at[1] += weight * times
                    at[2] += weight * times * math.log(times)
            if len(sums) > _TASK_FEATURES:
                yield batch_of(sums)
                sums = {}
        yield batch_of(sums)

    counted = (
        narrow.mapInArrow(features, schema)
        .groupBy("host", "node", "kind", "feature")
        .agg(*[F.round(F.sum(c), 9).alias(c) for c in ("pages", "times", "spread")])
    )
    # Entropy of a feature over pages: log(times) - sum(c log c) / times.
    look, content = F.col("kind") == _LOOK, F.col("kind") == _CONTENT
    entropy = F.log("times") - F.col("spread") / F.col("times")
    by_node = counted.groupBy("host", "node").agg(
        F.sum(F.when(F.col("kind") == _PAGE, F.col("pages"))).alias("pages"),
        F.sum(F.when(look, F.col("times"))).alias("looked"),
        F.sum(F.when(look, F.col("times") * F.log("times"))).alias("looks"),
        F.count(F.when(look, 1)).alias("kinds"),
        F.avg(F.when(content, entropy)).alias("entropy"),
        F.max(F.when(F.col("kind") == _NAME, F.col("feature") / 1000)).alias("noise_words"),
        F.max(F.when(F.col("kind") == _PAGE, F.col("feature"))).alias("main"),
    )
    several = F.col("pages") > 1
    shown = (F.log("looked") - F.col("looks") / F.col("looked")) / F.log("pages")
    presentation = F.when(several, F.least(F.lit(1.0), shown)).otherwise(1.0)
    spread = F.coalesce("entropy", F.lit(0.0)) / F.log("pages")
    content = F.when(several, 1 - F.least(F.lit(1.0), spread)).otherwise(1.0)
    share = F.pow(F.lit(_GAMMA), F.greatest("kinds", F.lit(1)))
    return by_node.select(
        "host",
        "node",
        "pages",
        presentation.alias("presentation"),
        content.alias("content"),
        ((1 - share) * presentation + share * content).alias("importance"),
        "noise_words",
        (F.col("main") == 1).alias("main"),
    )


def low_branches(tree: DataFrame, caution: float = CAUTION) -> DataFrame:
    """Rows (host, node, low) of the branches to remove, and of those suspect by name to keep."""
    pages = F.col("pages")
    imaginary = F.when(F.col("main"), max(caution, CAUTION)).otherwise(caution)
    importance = (pages * F.col("importance") + imaginary) / (pages + imaginary)
    low = (pages > 1) & (importance < LOW)
    named = (1 - NAME_WEIGHT * F.col("noise_words")) * importance >= LOW
    keep = ~low & (pages > 1) & F.coalesce(named, F.lit(False))
    return tree.where(low | keep).select("host", "node", low.alias("low"))


def _keys(host: str, nodes: np.ndarray) -> np.ndarray:
    """One number per node of a host."""
    return nodes ^ np.int64(_hash(f"host {host}"))


class _Branches:
    """Judged branches of all hosts: sorted numbers, 8 bytes each."""

    def __init__(self, low: DataFrame):
        found = low.toArrow()
        hosts = found["host"].combine_chunks().dictionary_encode()
        salts = np.array([_hash(f"host {h}") for h in hosts.dictionary.to_pylist()], np.int64)
        keys = found["node"].to_numpy() ^ salts[hosts.indices.to_numpy()] if len(found) else np.zeros(0, np.int64)
        is_low = found["low"].to_numpy().astype(bool)
        self.low, self.kept = np.sort(keys[is_low]), np.sort(keys[~is_low])

    @staticmethod
    def _of(held: np.ndarray, keys: np.ndarray, nodes: np.ndarray) -> set[int]:
        if not len(held) or not len(keys):
            return set()
        at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
        return set(nodes[held[at] == keys].tolist())

    def of(self, host: str, page: Page) -> tuple[set[int], set[int]]:
        """The low and the kept ones among a page's nodes."""
        own = {e.node for e, _ in page.looks}
        nodes = np.fromiter(own, np.int64, len(own))
        keys = _keys(host, nodes)
        return self._of(self.low, keys, nodes), self._of(self.kept, keys, nodes)


def main_text(
    pages: DataFrame,
    keys: tuple[str, ...] = ("page_id", "url"),
    broadcast_nodes: int = BROADCAST_NODES,
    caution: float = CAUTION,
) -> DataFrame:
    """Rows (*keys, text) of all rows of ``pages`` (url, html and the keys)."""
    spark = pages.sparkSession
    with settings(spark, _BATCHES):
        copies = staged(copied_pages(pages), "copied-pages")
        low = staged(low_branches(style_tree(pages, copies, broadcast_nodes), caution), "low-branches")
    narrow = pages.select(
        *keys, host_of(pages["url"]).alias("__host"), pages["html"].cast("string").alias("__html")
    )
    if low.count() <= broadcast_nodes:
        held = spark.sparkContext.broadcast(_Branches(low))
    else:
        held = None
        of_host = low.groupBy(F.col("host").alias("__host")).agg(
            F.collect_set(F.when(F.col("low"), F.col("node"))).alias("__low"),
            F.collect_set(F.when(~F.col("low"), F.col("node"))).alias("__kept"),
        )
        narrow = narrow.join(of_host, "__host", "left").select(
            *keys, "__host", "__html", "__low", "__kept"
        )
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if not f.name.startswith("__")
    ) + ", text string"
    n = len(keys)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for i, (host, html) in enumerate(zip(batch[n].to_pylist(), batch[n + 1].to_pylist(), strict=True)):
                page = parse(html or "")
                if held is None:
                    low, kept = (set(batch[n + k][i].as_py() or ()) for k in (2, 3))
                else:
                    low, kept = held.value.of(host, page)
                done.append(_joined(main_blocks(page, low, kept)))
            yield pa.RecordBatch.from_arrays(
                [batch[i] for i in range(n)] + [pa.array(done, pa.string())],
                [*batch.schema.names[:n], "text"],
            )

    return narrow.mapInArrow(extracted, schema)
