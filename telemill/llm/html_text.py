"""Main text of web pages by consensus of a host's pages.

Every page's containers are scored by the text they hold; the best one is widened to the article or
main element around it, or to an outer container that adds text of its own kind. The generalised path of
that (tag and classes of each ancestor, digits generalised) is the page's vote. Spark counts votes per host, and
paths with a tenth of their host's votes win. Pages are then read again: a page's text is what lies in
its elements at the winning path with most votes that it has, or in its own best container if it has
none.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import in_bytes, stored
from telemill.llm.url_filter import host_of

#: Winning paths up to which they are broadcast (under 10 MB); beyond, pages are joined by host.
BROADCAST_HOSTS = 100_000

# Names of elements and words of classes, ids and roles.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math nobr q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "nav aside header footer form script style noscript template head title button select "
    "textarea iframe object svg canvas audio video menu dialog datalist".split()
)
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement advertisements adverts adsense banner breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies disqus footer form header masthead menu "
    "nav navbar navigation newsletter notice notices popup promo related replies share sharing "
    "sidebar sidebars social sponsor sponsored subscribe toolbar widget widgets".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert menu".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article body center div main section table tbody td tr".split())
#: A start tag ends an open element of these, unless one of the others is between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}

#: The begin of a tag, a comment or another markup declaration. Possessive, so that no try is repeated.
OPENING = re.compile(r"<(?:(?P<end>/?)(?P<name>[a-z][^\s/>]*+)|(?P<other>!--|[!?/]))", re.I)
#: What is between a tag's name and its end: quoted values may hold `>`.
WITHIN = re.compile(r"""(?:[^>="']++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+""")
RAW_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in ("script", "style")}
#: Read one after the other, so that nothing within a value is taken for an attribute.
ATTRIBUTE = re.compile(r"""([^\s"'/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
READ = frozenset(["class", "id", "role"])
#: Words of a class, also of one like siteFooter.
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Classes that tell what lies within or is missing, such as has-sidebar.
NO_PART = re.compile(r"([Hh]as|[Nn]o|[Ww]ith|[Ww]ithout)([-_]|(?=[A-Z]))")


@dataclass(eq=False)
class Container:
    """An element that may hold the text, in the container around it, and what its kind is worth."""

    path: int
    kind: str
    outer: Container | None
    #: It is an article or a main element, or in one; and the former.
    marked: bool
    in_article: bool


@dataclass
class Element:
    name: str
    path: int
    dropped: bool
    #: The nearest container, itself included.
    holder: Container | None
    #: The part named by a dropped word that it is in, if any.
    part: int | None


@dataclass
class Block:
    """A run of text between block elements, and the container around it."""

    text: str
    linked: int
    holder: Container | None = None
    part: int | None = None

    @property
    def worth(self) -> int:
        return max(0, len(self.text) - 2 * self.linked)


@dataclass
class Part:
    """An element with a dropped word in a class or id, or a header in a main element, and what lies in
    it."""

    outer: int | None
    is_header: bool = False
    heading: bool = False
    main: bool = False
    article: bool = False
    unlinked: int = 0


def _kept(blocks: list[Block], parts: list[Part], marked: bool) -> list[Block]:
    """The blocks that lie in no part to be dropped; all, if that leaves none.

    A part with a main element stays, and one with three quarters of the page's unlinked text, or with
    an article and half of that, unless an article or main element is outside of all parts (`marked`).
    A header in a main element stays if it has a heading.
    """
    total = 0
    for block in blocks:
        unlinked = max(0, len(block.text) - block.linked)
        total += unlinked
        if block.part is not None:
            parts[block.part].unlinked += unlinked
    # Outer parts come before inner ones.
    for part in reversed(parts):
        if part.outer is not None:
            outer = parts[part.outer]
            outer.main |= part.main
            outer.article |= part.article
            outer.unlinked += part.unlinked
    dropped: list[bool] = []
    for part in parts:
        most = 4 * part.unlinked >= 3 * total or (part.article and 2 * part.unlinked >= total)
        stays = part.heading if part.is_header else part.main or (most and not marked)
        dropped.append(not stays or (part.outer is not None and dropped[part.outer]))
    kept = [block for block in blocks if block.part is None or not dropped[block.part]]
    return kept or blocks


def _tokens(page: str) -> Iterator[tuple[str, str, bool, str]]:
    """The text before each tag, and the tag: its lower-case name, whether it ends an element, and what
    is between name and end. The text at the end comes with an empty name. Scripts, styles, comments
    and declarations are left out.

    Each part of the page is read a bounded number of times: an end that is missing is missed once.
    """
    at = begin = 0
    last = page.rfind(">")
    quotes_hold = True
    while (opening := OPENING.search(page, begin)) is not None and opening.start() < last:
        begin = opening.end()
        if opening["other"] == "!--":
            end = page.find("-->", begin)
            yield page[at : opening.start()], "", False, ""
            at = begin = len(page) if end < 0 else end + 3
            continue
        end = -1
        if quotes_hold and opening["name"]:
            end = WITHIN.match(page, begin).end()
            if end == len(page):
                # All further ends lie within quotes that go wrong somewhere.
                quotes_hold, end = False, -1
        if end < 0:
            end = page.find(">", begin)
        name = (opening["name"] or "").lower()
        raw = RAW_END.get(name) if not opening["end"] else None
        if raw is None:
            yield page[at : opening.start()], name, bool(opening["end"]), page[begin:end]
            at = begin = end + 1
        else:
            yield page[at : opening.start()], "", False, ""
            closing = raw.search(page, end + 1)
            at = begin = len(page) if closing is None else closing.end()
    # Without any tag end behind it, an opening is text.
    yield page[at:], "", False, ""


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, without those inside dropped elements."""
    blocks: list[Block] = []
    parts: list[Part] = []
    marked = False
    stack: list[Element] = []
    opened: Counter[str] = Counter()
    texts: list[str] = []
    linked = 0
    #: How deep the open link is, if any: it ends with its element at the latest.
    link: int | None = None

    def close_block() -> None:
        nonlocal linked
        if texts:
            text = " ".join("".join(texts).split())
            texts.clear()
            if text:
                inner = stack[-1] if stack else None
                blocks.append(
                    Block(text, linked, inner and inner.holder, inner.part if inner else None)
                )
            linked = 0

    def drop_to(depth: int) -> None:
        nonlocal link
        for element in stack[depth:]:
            opened[element.name] -= 1
        del stack[depth:]
        if link is not None and depth < link:
            link = None

    for data, name, ends, more in _tokens(page):
        if data and not (stack and stack[-1].dropped):
            data = html.unescape(data)
            texts.append(data)
            if link is not None:
                linked += len(data.strip())
        if not name:
            continue
        if name in INLINE:
            if name == "a":
                link = None if ends else len(stack)
            continue
        if name == "br" or name == "wbr" or name == "img":
            if name != "wbr":
                texts.append(" ")
            continue
        close_block()
        if name in VOID:
            continue
        if ends:
            if opened[name] > 0:
                depth = len(stack) - 1
                while stack[depth].name != name:
                    depth -= 1
                drop_to(depth)
            continue
        implied = _implied(stack, opened, name)
        if implied is not None:
            drop_to(implied)
        element = _element(name, more, stack[-1] if stack else None, parts)
        stack.append(element)
        opened[name] += 1
        if element.part is not None and name in HEADINGS:
            parts[element.part].heading = True
        if name in ("article", "main") and not element.dropped:
            if element.part is None:
                marked = True
            elif name == "main":
                parts[element.part].main = True
            else:
                parts[element.part].article = True
    close_block()
    return _kept(blocks, parts, marked) if parts else blocks


def _implied(stack: list[Element], opened: Counter[str], name: str) -> int | None:
    """From which depth on a start tag of this name ends elements: an open paragraph, an item before
    an item; none if it ends nothing."""
    ended, limits = CLOSES.get(name, (frozenset(), frozenset()))
    last = len(stack) - (bool(stack) and stack[-1].name == "p")
    if any(opened[item] > 0 for item in ended):
        for depth in range(last - 1, -1, -1):
            if stack[depth].name in limits:
                break
            if stack[depth].name in ended:
                return depth
    return last if last < len(stack) else None


def _element(name: str, more: str, parent: Element | None, parts: list[Part]) -> Element:
    classes, words, role = "", set(), ""
    if "=" in more:
        for key, value in ATTRIBUTE.findall(more):
            key = key.lower()
            if key not in READ:
                continue
            value = value.strip("\"'")
            if key == "role":
                role = value.lower()
                continue
            for token in value.split():
                if not NO_PART.match(token):
                    words.update(word.lower() for word in WORD.findall(token))
            if key == "class":
                classes = ".".join(sorted(set(re.sub(r"\d+", "0", value.lower()).split())))
    outer = parent.holder if parent else None
    # The header of an article has its title and lead, and so may that of a main element.
    of_text = outer is not None and outer.marked
    in_article = outer is not None and outer.in_article
    dropped = (
        (name in DROPPED and not (name == "header" and of_text))
        or role in DROPPED_ROLES
        or (parent is not None and parent.dropped)
    )
    part = parent.part if parent else None
    named = words & (DROPPED_WORDS - {"header"} if of_text else DROPPED_WORDS)
    # A class word drops a part of the page, not the page itself.
    is_header = name == "header" and of_text and not in_article
    if not dropped and (is_header or (named and name not in ("html", "body", "article", "main"))):
        parts.append(Part(part, is_header and not named))
        part = len(parts) - 1
    path = xxhash.xxh64_intdigest(f"{parent.path if parent else ''}/{name}.{classes}") >> 1
    if name in CONTAINERS:
        kind = name if name in ("article", "body", "main") else ""
        outer = Container(
            path, kind, outer, of_text or kind in ("article", "main"), in_article or kind == "article"
        )
    return Element(name, path, dropped, outer, part)


def _containers(blocks: list[Block]) -> list[Container]:
    """All containers with text in them, outer ones before inner ones."""
    found: dict[Container, None] = {}
    for block in blocks:
        chain, container = [], block.holder
        while container is not None and container not in found:
            chain.append(container)
            container = container.outer
        found.update(dict.fromkeys(reversed(chain)))
    return list(found)


def best_path(blocks: list[Block]) -> int | None:
    """The path of the container with the highest score, widened. A block gives its length, less that of
    its links twice, to the container around it, and half as much to each further one outwards."""
    containers = _containers(blocks)
    own = dict.fromkeys(containers, 0.0)
    for block in blocks:
        if block.holder is not None:
            own[block.holder] += block.worth
    scores: dict[int, float] = {}
    for container in reversed(containers):
        scores[container.path] = scores.get(container.path, 0.0) + own[container]
        if container.outer is not None:
            own[container.outer] += own[container] / 2
    best = max(scores, key=lambda path: (scores[path], path), default=None)
    return None if best is None else _widened(blocks, containers, best)


def _widened(blocks: list[Block], containers: list[Container], best: int) -> int:
    """The outermost container around the best that belongs to its text.

    That is the outermost article around it, or else the main element. A container further out takes
    its place if, of text that is mostly no links, it adds a tenth or more, or has some beside the inner
    container that lies in no other (the body not). Beyond an article or main element only the text of
    others of these adds.
    """
    holder: Container | None = next(c for c in containers if c.path == best)
    chain, kinds = [], []
    while holder is not None:
        chain.append(holder.path)
        kinds.append(holder.kind)
        holder = holder.outer
    level = {path: i for i, path in enumerate(chain)}
    # The innermost of these around each container.
    around: dict[Container | None, int | None] = {None: None}
    for container in containers:
        around[container] = level.get(container.path, around[container.outer])
    #: What each level adds to the ones within: all text, links, worth, and worth in no other container.
    length, linked, worth, direct = ([0] * len(chain) for _ in range(4))
    marked = [0] * len(chain)
    for block in blocks:
        i = around[block.holder]
        if i is not None:
            length[i] += len(block.text)
            linked[i] += block.linked
            worth[i] += block.worth
            if block.holder.path == chain[i]:
                direct[i] += block.worth
            if block.holder.marked:
                marked[i] += block.worth

    at = 0
    for kind in ("main", "article"):
        at = max((i for i, k in enumerate(kinds) if k == kind), default=at)
    inside = "article" in kinds or "main" in kinds
    held = sum(worth[: at + 1])
    # Sums since the level that was last taken.
    added = more_worth = more_linked = more_length = 0
    for i in range(at + 1, len(chain)):
        added += (marked if inside else worth)[i]
        more_worth, more_linked, more_length = (
            more_worth + worth[i], more_linked + linked[i], more_length + length[i]
        )
        unlinked = 2 * more_linked <= more_length
        beside = kinds[i] != "body" and (direct[i] if not inside or kinds[i] == "main" else 0) > 0
        if unlinked and (beside or (added > 0 and 10 * added >= held)):
            at, held = i, held + more_worth
            added = more_worth = more_linked = more_length = 0
    return chain[at]


def text_at(blocks: list[Block], paths: list[int]) -> str:
    """The text at the first of `paths` that the page has, else in its best container, else all."""
    containers = _containers(blocks)
    there = {container.path for container in containers}
    path = next((path for path in paths if path in there), None)
    if path is None:
        path = best_path(blocks)
    if path is not None:
        # The outermost element at the path around each container. A page may have several: lists of
        # teasers in plain divs beside a story in one, of which those that are mostly links go.
        root: dict[Container | None, Container | None] = {None: None}
        for container in containers:
            own = container if container.path == path else None
            root[container] = root[container.outer] or own
        links: Counter[Container] = Counter()
        for block in blocks:
            links[root[block.holder]] += 2 * block.linked - len(block.text)
        links.pop(None, None)
        some = any(n <= 0 for n in links.values())
        kept = {own for own, n in links.items() if n <= 0 or not some}
        blocks = [block for block in blocks if root[block.holder] in kept]
    return "\n".join(block.text for block in blocks)


def votes_of(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """host and path of the best container of each page that has a host and text."""
    rows = pages.select(
        host_of(F.coalesce(F.col(url_column), F.lit(""))).alias("host"),
        F.col(html_column).alias("html"),
    ).filter("host <> '' AND html IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_bytes(batch, "html"):
                paths = [best_path(blocks_of(page)) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("host"), pa.array(paths, pa.int64())], ["host", "path"]
                )

    return rows.mapInArrow(run, "host string, path bigint").filter("path IS NOT NULL")


def winning_paths(votes: DataFrame) -> DataFrame:
    """host and paths: those with a tenth of the host's votes, at most ten, most votes first, and of
    paths with equal votes the one with the smaller number."""
    counted = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    totals = votes.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    return (
        counted.join(totals, "host")
        .filter(10 * F.col("n") >= F.col("total"))
        .groupBy("host")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))).alias("won"))
        .select("host", F.col("won.path").alias("paths"))
    )


def main_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """One row per row of `pages`: id, url and text (blocks in page order, one to a line).

    A null or empty html has an empty text. A page without a host has no consensus and its own best
    container counts. Repeated rows vote and return each, an empty table gives none. Other columns are
    not read.
    """
    winners = stored(winning_paths(stored(votes_of(pages, url_column, html_column), "votes")), "won")
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)
    url = F.coalesce(F.col(url_column), F.lit(""))
    rows = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).alias("html"),
        host_of(url).alias("host"),
    ).join(winners, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_bytes(batch, "html"):
                found = zip(part.column("html").to_pylist(), part.column("paths").to_pylist())
                texts = [text_at(blocks_of(page), paths or []) for page, paths in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(texts, pa.string())],
                    ["id", "url", "text"],
                )

    id_type = pages.schema[id_column].dataType.simpleString()
    read = rows.select("id", "url", "html", "paths")
    return read.mapInArrow(run, f"id {id_type}, url string, text string").withColumnsRenamed(
        {"id": id_column, "url": url_column}
    )
