"""Main text of web pages by a style tree of each host.

The pages of a host are merged. A node of the tree is a place: a path of block elements with their class names. There each
page has a presentation, the sequence of child tags (a run of equal ones counts as one), and a content, the text that
stands there and is no link. The entropy H of either over the host's pages gives its importance 1 - exp(-H), 0 if all
pages are alike and 1 - 1/n for n equally frequent ones; it does not depend on how many pages a host has. A node is low
if both importances are below LOW. On a page, a branch is cut if its node and all nodes below it there are low.

What a branch that stays holds is judged by itself: a block of the same text on the same path on k of m pages has the
importance 1 - (k - 1) / m. One page that has nothing in common with the others is added to every host and node, so a host
of few pages is cut less readily than a large one (a block on all pages goes from 5 pages on, a branch from 11), and a
single page not at all. Nothing is cut inside an <article> or <main>. Pages of equal blocks and nodes count once, whatever
else their html holds. What an element is called counts too: menus, adverts, forms and the like have no importance
whatever they hold.

What stays: noise of an unknown name whose text differs from page to page, unless it is made of links.

Nodes are counted by groupBy with map-side sums, so a host with a third of all pages is some counts per task. Only what is
low is kept for a host: it is on most of its pages, so it is little, and pages meet it by a join on the host that Spark
may split where a host is large.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.scratch import save

LOW = 0.25
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>", re.S)
CLASSES = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

#: Elements by what they do in HTML, and names that sites give to what is not the article.
RAW = set("script style textarea title noscript template xmp iframe noembed noframes".split())
NOISE = set("nav footer aside form button select option dialog menu svg canvas object audio video head datalist fieldset".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
NAMED_NOISE = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice alert comment comments disqus replies share "
    "sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget toolbar "
    "pagination pager copyright search skip complementary contentinfo masthead".split()
)
OTHERS = set("with without no not has have is show hide".split())  # a name of these tells of another element


def _noise_tag(tag: str, inside_article: bool) -> bool:
    return tag in NOISE or (tag == "header" and not inside_article)


def _noise_name(tag: str, attributes: str) -> bool:
    """Whether a whole class, id or role, or the last part of one, names noise: 'page-footer', but not 'with-sidebar'."""
    if tag in ("html", "body", "article", "main") or "=" not in attributes:
        return False
    for name in " ".join("".join(m) for m in NAMES.findall(attributes)).lower().split():
        parts = [x for x in re.split(r"[^a-z0-9]+", name) if x]
        if parts and parts[-1] in NAMED_NOISE and not OTHERS & set(parts[:-1]):
            return True
    return False


@dataclass
class Place:
    """A node of a page's tree: where it hangs, the child tags of its elements, its texts, and whether it is low there."""

    name: str
    parent: int
    style: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    low: bool = False


def _place_name(tag: str, attributes: str) -> str:
    """The tag with its class names, without numbers, which tell elements apart and not kinds of them."""
    names = " ".join("".join(m) for m in CLASSES.findall(attributes)) if "=" in attributes else ""
    return ".".join([tag, *sorted({re.sub(r"\d+", "", name) for name in names.lower().split()})])


def blocks(page: str) -> list[tuple[str, str, bool]]:
    """(path of elements, text, inside an article) of the page's blocks, in order, without those that are noise by name.

    If no article has text outside elements of noisy names, such an element is none if it holds an article or most of the text.
    """
    return [block[:3] for block in parsed(page)[0]]


def parsed(page: str) -> tuple[list[tuple[str, str, bool, int]], list[Place]]:
    """The blocks with the places they stand at, and all places outside articles; 0 is the root."""
    found_blocks: list[tuple[str, list[tuple[str, tuple[int, ...], bool]], bool, int]] = []
    # Open elements, whether they are noise, noisy names around them, and their places.
    stack: list[tuple[str, bool, tuple[int, ...], int]] = []
    places = [Place("", -1)]
    known: dict[tuple[int, str], int] = {}
    links = 0
    parts: list[tuple[str, tuple[int, ...], bool]] = []
    chars: list[int] = []  # for each element of a noisy name
    holds: set[int] = set()  # those that hold an article
    article = total = 0
    plain = False

    def close_block() -> None:
        if parts:
            found_blocks.append(("/".join(tag for tag, *_ in stack if tag in BLOCK), parts.copy(), article > 0, stack[-1][3] if stack else 0))
            parts.clear()

    def pop(to: int) -> None:
        nonlocal article, links
        while len(stack) > to:
            tag, noise, *_ = stack[-1]
            if tag in BLOCK:
                close_block()
            stack.pop()
            links -= tag == "a"
            article -= tag in ("article", "main") and not noise

    at = 0
    while True:
        found = TAG.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text and not (stack and stack[-1][1]):
            named = stack[-1][2] if stack else ()
            parts.append((text, named, links > 0))
            size = len(text.strip())
            total += size
            for i in named:
                chars[i] += size
            plain |= bool(size and article and not named)
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag, closes = found[2].lower(), bool(found[1])
        if closes:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if place >= 0:
                pop(place)
            elif tag in BLOCK:
                close_block()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br" or tag == "hr":
            parts.append((" ", (), links > 0)) if tag == "br" else close_block()
        if tag in VOID or found[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in BLOCK:
            while stack and (stack[-1][0] == "p" or stack[-1][0] not in BLOCK and any(t == "p" for t, *_ in stack)):
                pop(len(stack) - 1)
            if tag in SELF_CLOSING and stack and stack[-1][0] in SELF_CLOSING[tag]:
                pop(len(stack) - 1)
            close_block()
        noise = bool(stack and stack[-1][1]) or _noise_tag(tag, article > 0)
        named = stack[-1][2] if stack else ()
        if not noise and tag in ("article", "main"):
            holds.update(named)
        if not noise and _noise_name(tag, found[3]):
            named = (*named, len(chars))
            chars.append(0)
        at_place = stack[-1][3] if stack else 0
        if not noise and not article:
            if places[at_place].style[-1:] != [tag]:
                places[at_place].style.append(tag)
            if tag in BLOCK:
                name = _place_name(tag, found[3])
                inner = known.setdefault((at_place, name), len(places))
                if inner == len(places):
                    places.append(Place(name, at_place))
                at_place = inner
                places[at_place].style.append("|")  # one more element of this place
        stack.append((tag, noise, named, at_place))
        links += tag == "a"
        article += tag in ("article", "main") and not noise
    pop(0)
    close_block()
    noisy = {i for i, n in enumerate(chars) if plain or not (i in holds or 2 * n > total)}
    out: list[tuple[str, str, bool, int]] = []
    for path, held, inside, place in found_blocks:
        held = [(t, linked) for t, named, linked in held if noisy.isdisjoint(named)]
        text = " ".join(entities.unescape("".join(t for t, _ in held)).split())
        if text:
            out.append((path, text, inside, place))
            if not inside and not all(linked or not t.strip() for t, linked in held):
                places[place].texts.append(text)
    if any(inside for _, _, inside, _ in out):
        out = [block for block in out if block[2]]
    return out, places


def _node(path: str, content: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{content}") - 2**63


def _style(place: Place) -> str:
    """The child tags of the place's elements; runs of equal elements count as one, as runs of equal tags do."""
    elements = [" ".join(tags.split()) for tags in " ".join(place.style).split("|")]
    return "|".join(tags for tags, _ in groupby(elements))


def _hashed_places(places: list[Place]) -> list[int]:
    """A hash of the whole path of each place; a place comes after the one it hangs at."""
    out: list[int] = []
    for place in places:
        out.append(_node(f"place {out[place.parent] if place.parent >= 0 else ''}", place.name))
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page a digest of its blocks and nodes, its blocks outside articles, and (node, presentation, content) of its nodes."""
    for batch in batches:
        copies, nodes, styled = [], [], []
        for page in batch.column("html"):
            own, places = parsed(page.as_py() or "")
            found = [
                {"node": at, "style": _node("style", _style(place)), "content": _node("content", "\n".join(place.texts))}
                for at, place in zip(_hashed_places(places), places)
            ]
            lines = [f"{path}\n{text}" for path, text, *_ in own] + [str(tuple(x.values())) for x in found]
            copies.append(xxhash.xxh3_128_digest("\n".join(lines)))
            nodes.append(list({_node(path, text) for path, text, inside, _ in own if not inside}))
            styled.append(found)
        kind = pa.list_(pa.struct([("node", pa.int64()), ("style", pa.int64()), ("content", pa.int64())]))
        columns = [batch.column("host"), pa.array(copies, pa.binary()), pa.array(nodes, pa.list_(pa.int64())), pa.array(styled, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["host", "copy", "nodes", "styled"])


def main_text(page: str, noise: set[int]) -> str:
    """The page's text without the blocks and the branches that are low on its host."""
    own, places = parsed(page)
    hashes = _hashed_places(places)
    for place, at in zip(places, hashes):
        place.low = at in noise
    for place in reversed(places):  # a place comes after the one it hangs at
        if place.parent >= 0 and not place.low:
            places[place.parent].low = False
    return " ".join(text for path, text, inside, at in own if inside or not (places[at].low or _node(path, text) in noise))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("html"), batch.column("noise"))
        texts = [main_text(page.as_py() or "", set(noise.as_py() or ())) for page, noise in pairs]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def low_nodes(once: DataFrame, low: float = LOW) -> DataFrame:
    """(host, node) of the nodes whose presentations and contents vary little, from rows (host, styled)."""
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(f"at.{n}").alias("value")) for n in ("style", "content")]))
    seen = once.select("host", F.explode("styled").alias("at")).select("host", "at.node", kinds.alias("seen"))
    counts = seen.groupBy("host", "node", "seen").agg(F.count("*").alias("n"))
    pages = F.sum("n") + 1  # with one of its own kind, which adds log 1 = 0 to the sum
    entropy = F.log(pages) - F.sum(F.col("n") * F.log("n")) / pages
    both = counts.groupBy("host", "node", "seen.kind").agg((1 - F.exp(-entropy)).alias("importance"))
    return both.groupBy("host", "node").agg(F.max("importance").alias("importance")).where(F.col("importance") < low).drop("importance")


def extract(pages: DataFrame, low: float = LOW) -> DataFrame:
    """(page_id, url, text, n_chars) per page. Null or empty html: empty text. A url without host is a host of its own.

    Pages of equal blocks and nodes count once in the tree, so copies of a page do not make its article look like a template.
    Repeated rows and null ids come out as often as they went in; a share of exactly 1 - `low` stays; very long pages are
    read whole; other columns are not looked at, whatever their names; no rows give no rows.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "://([^/?#]*)", 1))
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    kind = "host string, copy binary, nodes array<bigint>, styled array<struct<node:bigint,style:bigint,content:bigint>>"
    counted = source.select("host", "html").mapInArrow(_counted, kind)
    once = save(counted.groupBy("host", "copy").agg(F.any_value("nodes").alias("nodes"), F.any_value("styled").alias("styled")))
    nodes = once.select("host", F.explode("nodes").alias("node"))
    nodes = nodes.groupBy("host", "node").agg(F.count("*").alias("k")).where(F.col("k") > 1)
    sizes = once.groupBy("host").agg(F.count("*").alias("m"))
    importance = 1 - (F.col("k") - 1) / F.col("m")
    shared = nodes.join(sizes, "host").where(importance < low).select("host", "node")
    noise = shared.unionByName(low_nodes(once, low)).groupBy("host").agg(F.collect_set("node").alias("noise"))
    joined = source.join(save(noise), "host", "left").select("page_id", "url", "html", "noise")
    return joined.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
