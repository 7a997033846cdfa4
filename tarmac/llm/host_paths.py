"""Main text of web pages by container paths that the pages of a host agree on.

Each page is cut into blocks, each under the path of its containers with tags
and generalised classes.  A page votes for the container that holds most text
and least chrome; votes are counted per host in Spark, and every page is
extracted again by the paths its host has elected.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import lookup_join, staged

# Element and class names of HTML.
RAW = frozenset("script style noscript template title textarea iframe xmp noembed noframes".split())
CHROME = frozenset(
    "head nav footer aside form button select option svg canvas object dialog menu fieldset datalist audio video map".split()
)
CONTAINERS = frozenset(
    "html body div article main section header footer nav aside form table tbody thead tfoot tr td th ul ol dl "
    "figure blockquote details center fieldset dialog menu head button select svg canvas object audio video map".split()
)
BREAKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr br address summary figcaption caption option legend".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice popup modal overlay newsletter subscribe subscription social share sharing nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar footer comment comments commentlist disqus replies respond related recommended "
    "recommendations widget widgets login signup search toolbar pagination pager paywall".split()
)
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog menu menubar alert".split())
MAIN_TAGS = frozenset({"article", "main"})
#: Containers that no class or id makes chrome, and words behind which a class only tells what a page has or lacks.
WHOLE_TAGS = frozenset({"html", "body", "main", "article"})
MODIFIERS = frozenset("no not has have with without".split())
#: Words that say where or in what shape a part stands: with them alone beside it, a name is still that of chrome.
SHAPE_WORDS = frozenset(
    "box block area section wrapper wrap container list item items bar panel inner outer content link links button buttons "
    "icon icons top bottom left right main header post posts page site col row group body title text unit slot module "
    "articles stories news more count form thread a the and".split()
)
HEADLINE_WORDS = frozenset("title headline heading".split())
#: What a headline may be one of.
HEADED_WORDS = frozenset("post article entry main content story news box wrapper text block".split())
# End of fixed values.

_SKIP = re.compile(r"[\s/]*")
_NAME = re.compile(r"=?[^\s=>/]*")
_EQUALS = re.compile(r"\s*=\s*")
_VALUE = re.compile(r"[^\s>]*")
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Tags:
    """Reads a page once, left to right, ending tags, comments and quotes as browsers do."""

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()  # what has been looked for and does not come any more

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def attributes(self, at: int) -> tuple[dict[str, str], int, bool] | None:
        """Attributes from ``at`` on, where the tag ends, and whether a slash ends it; None at the end of the page.

        A quote counts only where a value begins; one that is never closed is a letter like any other.
        """
        page, named = self.page, {}
        while True:
            skipped = _SKIP.match(page, at)
            at = skipped.end()
            if at >= len(page):
                return None
            if page[at] == ">":
                return named, at + 1, skipped.group().endswith("/")
            name = _NAME.match(page, at)
            at = name.end()
            if equals := _EQUALS.match(page, at):
                at = equals.end()
                quote = page[at : at + 1]
                close = self.find(quote, at + 1) if quote in ("'", '"') else -1
                if close >= 0:
                    value, at = page[at + 1 : close], close + 1
                else:
                    value = _VALUE.match(page, at).group()
                    at += len(value)
            else:
                value = ""
            named.setdefault(name.group().lower(), value)

    def __iter__(self) -> Iterator[tuple[str, str, dict[str, str], bool]]:
        """``("text", …)``, ``("raw", …)`` for character data, ``("open", tag, attributes, closed)`` and ``("close", tag)``."""
        page, at, begun = self.page, 0, 0  # text runs from ``begun``
        while (at := self.find("<", at)) >= 0:
            kind = page[at + 1 : at + 2]
            name = _TAG_NAME.match(page, at + 1 + (kind == "/")) if self.find(">", at) >= 0 else None
            if kind in ("!", "?"):
                if begun < at:
                    yield "text", page[begun:at], {}, False
                if page.startswith("<!--", at):
                    stop, size = self.find("-->", at + 2), 3
                elif page.startswith("<![CDATA[", at):
                    stop, size = self.find("]]>", at), 3
                    yield "raw", page[at + 9 : stop if stop >= 0 else len(page)], {}, False
                else:
                    stop, size = self.find(">", at), 1
                at = begun = stop + size if stop >= 0 else len(page)
                continue
            if name is None:
                at += 1  # a sign like any other
                continue
            if begun < at:
                yield "text", page[begun:at], {}, False
            found = self.attributes(name.end())
            tag = name.group().lower()
            at = begun = found[1] if found else len(page)
            if found and kind == "/":
                yield "close", tag, {}, False
            elif found:
                yield "open", tag, found[0], found[2]
                if tag in RAW and not found[2]:
                    closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                    stop = self.find(">", closing.end()) if closing else -1
                    at = begun = stop + 1 if stop >= 0 else len(page)
        if begun < len(page):
            yield "text", page[begun:], {}, False


def name_words(named: dict[str, str]) -> list[set[str]]:
    """The words of every class and id, up to one that only tells what a page has or lacks."""
    found = []
    for name in f"{named.get('class', '')} {named.get('id', '')}".split():
        words: set[str] = set()
        for word in re.split(r"[^a-z]+", _CAMEL.sub(" ", name).lower()):
            if word in MODIFIERS:
                break
            words.add(word)
        found.append({word for word in words if len(word) > 1})
    return found


@dataclass
class Block:
    node: int  # of the page's containers
    text: str
    chrome: bool
    linked: int
    named: int = 0  # innermost container around it that is chrome by class, id or as a form; 0 is none
    headline: int = 0  # 2 in a first-rank heading, 1 in a container named so


@dataclass
class Cutter:
    """Cuts one page into blocks of text below a tree of containers.

    Equal steps below one container are one node, whose path is that of its
    parent and its own step.  Node 0 is the page.
    """

    blocks: list[Block] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [-1])
    steps: list[str] = field(default_factory=lambda: [""])
    in_main: list[bool] = field(default_factory=lambda: [False])
    nodes: dict[tuple[int, str], int] = field(default_factory=dict)
    #: tag, node, chrome, inside a main element, innermost named container, inside a headline
    stack: list[tuple[str, int, bool, bool, int, bool]] = field(default_factory=lambda: [("", 0, False, False, 0, False)])
    open_tags: Counter = field(default_factory=Counter)
    around: list[int] = field(default_factory=lambda: [0])  # the named container around each named one
    parts: list[str] = field(default_factory=list)
    links: int = 0
    linked: int = 0
    first_rank: bool = False

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split()) if self.parts else ""
        if text:
            _, node, chrome, _, named, headline = self.stack[-1]
            rank = 2 if self.first_rank else 1 if headline else 0
            self.blocks.append(Block(node, text, chrome, min(self.linked, len(text)), named, rank))
        self.parts, self.linked = [], 0

    def words(self, text: str) -> None:
        self.parts.append(text)
        if self.links:
            self.linked += len(text)

    def open(self, tag: str, named: dict[str, str]) -> None:
        self.flush()
        self.first_rank = False
        _, above, chrome, main, inside, headline = self.stack[-1]
        names = name_words(named)
        words = set().union(*names)
        role = named.get("role", "").lower()
        if tag not in WHOLE_TAGS and role != "main":
            # inside an article a name has to be of chrome as a whole: a notice of award is a topic there
            by_name = any(
                not CHROME_WORDS.isdisjoint(each) and (not main or each <= CHROME_WORDS | SHAPE_WORDS) for each in names
            )
            if tag == "form" or by_name or (not main and "header" in words):
                self.around.append(inside)
                inside = len(self.around) - 1
        hidden = "hidden" in named or named.get("aria-hidden", "").lower() == "true"
        chrome = (
            chrome
            or (tag in CHROME and tag != "form")
            or role in CHROME_ROLES
            or (not main and tag == "header")
            or hidden
            or re.search(r"display\s*:\s*none", named.get("style", ""), re.I) is not None
        )
        classes = re.sub(r"[^a-z-]+", "", named.get("class", "").lower().split(" ")[0])
        step = f"{tag}.{classes}" if classes else tag
        node = self.nodes.setdefault((above, step), len(self.steps))
        main = main or tag in MAIN_TAGS or role == "main"
        if node == len(self.steps):
            self.parents.append(above)
            self.steps.append(step)
            self.in_main.append(self.in_main[above] or tag in MAIN_TAGS)
        headline = headline or any(not HEADLINE_WORDS.isdisjoint(each) and each <= HEADLINE_WORDS | HEADED_WORDS for each in names)
        self.stack.append((tag, node, chrome, main, inside, headline))
        self.open_tags[tag] += 1

    def close(self, tag: str) -> None:
        if self.open_tags[tag]:
            self.flush()
            self.first_rank = False
            while True:
                closed = self.stack.pop()[0]
                self.open_tags[closed] -= 1
                if closed == tag:
                    return

    def cut(self, page: str) -> list[Block]:
        for kind, value, named, closed in Tags(page):
            if kind == "text":
                self.words(value)
            elif kind == "raw":
                self.words(html.escape(value))
            elif value in RAW:
                continue
            elif value in CONTAINERS:
                if kind == "close":
                    self.close(value)
                elif not (value in VOID or closed and value == "svg"):
                    self.open(value, named)
            elif value in BREAKS:
                self.flush()
                if value == "h1":
                    self.first_rank = kind == "open"
            elif value == "a":
                self.links = max(0, self.links - 1) if kind == "close" else 1
        self.flush()
        self.settle()
        return self.blocks

    def settle(self) -> None:
        """Make chrome what stands in containers named so, but for those the page is wrapped in.

        A wrapper holds more than half of the page's text and leaves less than a
        tenth as much clean text outside; the outer containers are asked first.
        Such containers lie one in the other, so each is asked once.
        """
        if len(self.around) == 1:
            return
        held = [0] * len(self.around)
        clean = 0  # text outside all named containers that is no chrome
        for block in self.blocks:
            held[block.named] += len(block.text)
            if not block.named and not block.chrome:
                clean += len(block.text)
        for name in range(len(held) - 1, 0, -1):
            if self.around[name]:
                held[self.around[name]] += held[name]
        total = sum(len(block.text) for block in self.blocks)
        direct = [0] * len(self.around)  # clean text of each, outside the named ones within
        for block in self.blocks:
            if block.named and not block.chrome:
                direct[block.named] += len(block.text)
        settled = [True] + [False] * (len(self.around) - 1)  # whether text right inside is clean by name
        for name in range(1, len(held)):
            # only a chain of wrappers from the outside in can hold over half each
            if settled[self.around[name]] and 2 * held[name] > total and 10 * clean < held[name]:
                settled[name] = True
                clean += direct[name]
        for block in self.blocks:
            block.chrome = block.chrome or not settled[block.named]

    def path(self, node: int) -> str:
        steps = []
        while node > 0:
            steps.append(self.steps[node])
            node = self.parents[node]
        return "".join(f"{step}/" for step in reversed(steps))

    def vote(self) -> str | None:
        """The container path with most text and least chrome or links in it; of equals the deepest, then the last by name.

        An article or main element counts a quarter more.
        """
        clean, junk, depth = [0] * len(self.steps), [0] * len(self.steps), [0] * len(self.steps)
        for block in self.blocks:
            size = len(block.text)
            spoiled = size if block.chrome else block.linked
            clean[block.node] += size - spoiled
            junk[block.node] += spoiled
        for node in range(1, len(self.steps)):
            depth[node] = depth[self.parents[node]] + 1
        for node in range(len(self.steps) - 1, 0, -1):  # children come after their parents
            clean[self.parents[node]] += clean[node]
            junk[self.parents[node]] += junk[node]
        values = [
            ((1.25 if self.in_main[node] else 1.0) * clean[node] - 0.5 * junk[node], depth[node])
            for node in range(len(self.steps))
        ]
        best = max((value for node, value in enumerate(values) if node and clean[node] > 0), default=None)
        if best is None:
            return None
        return max(self.path(node) for node, value in enumerate(values) if node and clean[node] > 0 and value == best)


_PAGE = pa.struct(
    [
        ("parents", pa.list_(pa.int32())),
        ("steps", pa.list_(pa.string())),
        ("nodes", pa.list_(pa.int32())),
        ("texts", pa.list_(pa.string())),
        ("headlines", pa.list_(pa.int32())),
    ]
)
_PAGE_TYPE = "struct<parents: array<int>, steps: array<string>, nodes: array<int>, texts: array<string>, headlines: array<int>>"


def _cut_page(page: str | None) -> tuple[dict, str | None]:
    """The containers of a page and its blocks without chrome, and the path it votes for."""
    cutter = Cutter()
    clean = [block for block in cutter.cut(page or "") if not block.chrome]
    return {
        "parents": cutter.parents,
        "steps": cutter.steps,
        "nodes": [block.node for block in clean],
        "texts": [block.text for block in clean],
        "headlines": [block.headline for block in clean],
    }, cutter.vote()


def text_under(page: dict, paths: list[str]) -> str:
    """The blocks under the first of ``paths`` that has any, or all blocks, with the headline before them.

    A page whose text has no first-rank heading of its own may have its headline
    in a container of its own before it: of the blocks before the text the last
    in a first-rank heading, else the last in a container named as a headline.
    """
    nodes = {(parent, step): node for node, (parent, step) in enumerate(zip(page["parents"], page["steps"])) if node}
    for path in paths:
        at = 0
        for step in path.split("/")[:-1]:
            at = nodes.get((at, step), -1)
            if at < 0:
                break
        if at < 0:
            continue
        under = [False] * len(page["steps"])
        under[at] = True
        for node in range(1, len(under)):
            under[node] = under[node] or under[page["parents"][node]]
        chosen = [k for k, node in enumerate(page["nodes"]) if under[node]]
        if chosen:
            if not any(page["headlines"][k] for k in chosen):
                before = [k for k in range(chosen[0]) if page["headlines"][k]]
                chosen = [*sorted(before, key=lambda k: (page["headlines"][k], k))[-1:], *chosen]
            return " ".join(page["texts"][k] for k in chosen)
    return " ".join(page["texts"])


def cut_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``host``, the ``page`` as containers and clean blocks, and the path it votes for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [_cut_page(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        part.column("host"),
                        pa.array([page for page, _ in found], _PAGE),
                        pa.array([vote for _, vote in found], pa.string()),
                    ],
                    names=["page_id", "url", "host", "page", "vote"],
                )

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html").mapInArrow(
        cut, f"page_id long, url string, host string, page {_PAGE_TYPE}, vote string"
    )


def elected(cut: DataFrame, least_share: float = 0.1) -> DataFrame:
    """``host`` and its ``paths`` with at least ``least_share`` of the votes, most votes first.

    The share bounds the list, whatever the number of pages.  Counts are added
    up before the shuffle, so a host with a third of all pages is one row per task.
    """
    counted = cut.where(F.col("vote").isNotNull()).groupBy("host", "vote").agg(F.count("*").alias("n"))
    total = counted.groupBy("host").agg(F.sum("n").alias("total"))
    enough = counted.join(total, "host").where(F.col("n") >= least_share * F.col("total"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "vote")))
    return enough.groupBy("host").agg(ranked["vote"].alias("paths"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    The text is that of the first path its host has elected under which the
    page has text, else of the path the page itself votes for, else of all
    blocks outside menus, headers, footers, adverts and the like; with the
    headline, where it stands before that path.  A page is read once from left
    to right, and its containers are a tree, so time and memory grow with its
    length whatever it holds.  Pages of no
    known host vote together.  Null or empty html, or none but chrome, gives an
    empty text.  Repeated rows are returned each.
    """
    cut = staged(cut_pages(pages), "blocks")
    joined = lookup_join(cut, staged(elected(cut), "elected"), "host")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = zip(batch.column("page"), batch.column("paths").to_pylist(), batch.column("vote").to_pylist())
            texts = [text_under(page.as_py(), [*(paths or ()), *([vote] if vote else ())]) for page, paths, vote in asked]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    text = joined.select("page_id", "url", "page", "paths", "vote").mapInArrow(choose, "page_id long, url string, text string")
    return text.withColumn("n_chars", F.length("text").cast("long"))
