"""HTML extraction by consensus host paths.

Pages of one host share their layout. Each page's containers (article, main, section, div, td)
are scored by the text that stands in them, less links and boilerplate, and vote with
their path: tags with their first class, numbers generalised, from the body down. The votes are
added up per host in Spark, and each page is read again with its host's winning paths; a page
in which no winning path gives text is read by its own best container.

Texts are cut at block tags; inside a block white space becomes one blank, blocks are joined by
line feeds. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out wherever they stand.

Votes: one row per page and container, added up with map-side combine, so a host with a third
of all pages is no hot task. Winners (`TOP_PATHS` rows a host) are broadcast once their count
proves small; beyond that they are shuffled with the pages, split where a host is skewed.

Defined results: a null or empty page, or one with nothing but boilerplate, gives an empty
text; a null url, or one without a host, belongs to the host ''; broken markup is read as far
as it goes (a page may end anywhere); repeated rows get a row each; an empty table gives an
empty table; other columns are not read.
"""

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from levyscan.llm.common import only, slices, stage

TOP_PATHS = 3
#: Deeper steps than this no longer add to a container's score.
MOST_DEPTH = 20
BROADCAST_HOSTS = 200_000

# Tags by what they mean for the text.
SKIPPED = frozenset("script style noscript template head nav header footer aside form button select option textarea iframe svg canvas object embed map menu dialog video audio math".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div td body".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new block ends these where they are still open.
IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Names of classes and ids that mark boilerplate, and those that go with them in compounds
#: such as site-header or ad-slot; any other part (ad-hoc-report, share-price) makes it a name
#: of its own, on which the votes decide.
BOILERPLATE = frozenset(
    """nav navbar navigation menu header masthead footer sidebar aside widget widgets notice cookie cookies consent gdpr banner ad ads adv advert adverts advertisement advertising adsbygoogle
    promo promos promotion sponsor sponsored sponsors form login signup comment comments commentlist replies disqus respond discussion share sharing social related recommended subscribe newsletter
    breadcrumb breadcrumbs pagination pager popup modal toolbar copyright skiplink""".split()
)
COMPANIONS = frozenset(
    """site page main global top bottom left right upper lower primary secondary mobile desktop sticky fixed bar side box wrapper wrap container holder inner outer area section block list item items
    group row col column panel slot unit links link buttons button icons icon text content message overlay toggle thread post posts article articles entry blog reader readers user users search skip
    google media email policy law eu the this js widget""".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())

#: A quote opens a value only behind an equals sign.
_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)(?:>|\Z)""", re.S)
#: What ends an element whose content is no markup, whatever stands in it.
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in RAW}
#: One attribute, name and value, so that a value is never searched for names.
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")


@dataclass(slots=True)
class _Node:
    """An open or closed element; `path` is a number of its page's `Paths`."""

    tag: str
    path: int
    skipped: bool
    link: bool
    first: int = 0  # its blocks: from this number
    stop: int = 0  # to before this one


class Paths:
    """The paths of a page's elements as a tree: each has a parent, a last step and a depth,
    so that deep pages need no long texts."""

    def __init__(self) -> None:
        self.number: dict[tuple[int, str], int] = {}
        self.parent, self.step, self.depth = [-1], [""], [-1]

    def under(self, parent: int, step: str) -> int:
        found = self.number.setdefault((parent, step), len(self.parent))
        if found == len(self.parent):
            self.parent.append(parent)
            self.step.append(step)
            self.depth.append(self.depth[parent] + 1)
        return found

    def name(self, path: int) -> str:
        steps = []
        while path:
            steps.append(self.step[path])
            path = self.parent[path]
        return "/".join(reversed(steps))

    def find(self, name: str) -> int | None:
        path: int | None = 0
        for step in name.split("/"):
            path = self.number.get((path, step))
            if path is None:
                return None
        return path


class Page:
    """What was read of a page: its blocks, its containers, and sums over the blocks."""

    def __init__(self, blocks: list[str], links: list[int], nodes: list[_Node], paths: Paths):
        self.blocks, self.nodes, self.paths = blocks, nodes, paths
        self.chars = [0, *accumulate(map(len, blocks))]
        self.links = [0, *accumulate(links)]
        self.marks = [0, *accumulate(b.count(".") + b.count(",") for b in blocks)]

    def score(self, node: _Node) -> float:
        """Text in sentences counts, text in links counts against; deep containers that hold
        all of it win over wide ones."""
        chars, links, marks = (s[node.stop] - s[node.first] for s in (self.chars, self.links, self.marks))
        if not chars:
            return 0.0
        likely = {"article": 1.5, "main": 1.3, "body": 0.6}.get(node.tag, 1.0)
        return likely * (chars - 2.0 * links + 10.0 * marks) * (1.0 + 0.01 * min(self.paths.depth[node.path], MOST_DEPTH))


def _marks_boilerplate(name: str) -> bool:
    parts = [p.lower() for p in _PARTS.split(name) if p]
    return any(p in BOILERPLATE for p in parts) and all(p in BOILERPLATE or p in COMPANIONS or p.isdigit() for p in parts)


def _boilerplate(tag: str, attributes: dict[str, str]) -> bool:
    if tag in SKIPPED or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if attributes.get("role", "").lower() in ROLES:
        return True
    if tag in ("body", "html", "article", "main"):
        return False
    return any(_marks_boilerplate(name) for a in ("class", "id") for name in attributes.get(a, "").split())


def _attributes(source: str) -> dict[str, str]:
    """Names in lower case with their values; of repeated names the first counts."""
    found: dict[str, str] = {}
    for a in _ATTRIBUTE.finditer(source):
        found.setdefault(a[1].lower(), html.unescape(a[2] or a[3] or a[4] or ""))
    return found


def _step(tag: str, attributes: dict[str, str]) -> str:
    names = sorted(_DIGITS.sub("0", c.lower()) for c in attributes.get("class", "").split())
    return (f"{tag}.{names[0]}" if names else tag).replace("/", "|")


def read(page: str) -> Page:
    """One pass, in time and memory that grow with the page, however deep it nests."""
    blocks: list[str] = []
    block_links: list[int] = []
    nodes: list[_Node] = []
    paths = Paths()
    stack: list[_Node] = [_Node("", 0, False, False)]
    open_at: dict[str, list[int]] = {}  # where in the stack elements of a tag are open
    part: list[str] = []
    links = 0

    def close_block() -> None:
        nonlocal links
        text = " ".join("".join(part).split())
        part.clear()
        if text:
            blocks.append(text)
            block_links.append(links)
        links = 0

    def pop() -> None:
        node = stack.pop()
        open_at[node.tag].pop()
        node.stop = len(blocks)

    def say(text: str) -> None:
        nonlocal links
        if text and not stack[-1].skipped:
            text = html.unescape(text)
            part.append(text)
            if stack[-1].link:
                links += len(text)

    at = 0
    while m := _MARKUP.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_at.get(tag):
                place = open_at[tag][-1]
                if any(stack[i].tag in BLOCKS or stack[i].tag in SKIPPED for i in range(place, len(stack))):
                    close_block()
                while len(stack) > place:
                    pop()
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in EMPTY:
            if tag == "hr":
                close_block()
            continue
        if tag in BLOCKS or tag in SKIPPED:
            close_block()
        if stack[-1].tag in IMPLIED.get(tag, ()):
            pop()
        attributes = _attributes(m[3] or "")
        above = stack[-1]
        path = paths.under(0 if tag == "body" else above.path, _step(tag, attributes))
        node = _Node(tag, path, above.skipped or _boilerplate(tag, attributes), above.link or tag == "a", len(blocks))
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(node)
        if tag in CONTAINERS and not node.skipped:
            nodes.append(node)
        if tag in RAW:
            close = _CLOSE[tag].search(page, at)
            at = close.start() if close else len(page)
    say(page[at:])
    close_block()
    while len(stack) > 1:
        pop()
    return Page(blocks, block_links, nodes, paths)


def container_votes(page: str) -> list[tuple[str, float]]:
    """(path, share) of a page's best containers, the best with 1."""
    found = read(page)
    best: dict[int, float] = {}
    for node in found.nodes:
        s = found.score(node)
        if s > 0:
            best[node.path] = best.get(node.path, 0.0) + s
    # Of paths with equal scores, the first on the page.
    top = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:TOP_PATHS]
    return [(found.paths.name(path), s / top[0][1]) for path, s in top]


def extract(page: str | None, paths: list[str]) -> str:
    """The text of the containers of the first path that gives text, else of the page's own
    best container."""
    if not page:
        return ""
    found = read(page)
    for name in paths:
        path = found.paths.find(name)
        chosen, stop = [], 0
        for n in found.nodes if path is not None else ():
            if n.path == path:  # in page order; one of them may hold the next one
                chosen += found.blocks[max(n.first, stop) : n.stop]
                stop = max(stop, n.stop)
        if chosen:
            return "\n".join(chosen)
    best = max(found.nodes, key=found.score, default=None)
    if best is not None and found.score(best) > 0:
        return "\n".join(found.blocks[best.first : best.stop])
    return "\n".join(found.blocks) if not found.nodes else ""


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): each host's paths by falling votes."""

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            hosts, paths, shares = [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for path, share in container_votes(page or ""):
                    hosts.append(host)
                    paths.append(path)
                    shares.append(int(1000 * share))
            yield pa.record_batch({"host": pa.array(hosts, pa.string()), "path": pa.array(paths, pa.string()), "votes": pa.array(shares, pa.int64())})

    votes = pages.select("host", "html").mapInArrow(voted, "host string, path string, votes long")
    sums = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    place = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    top = sums.withColumn("place", place).filter(F.col("place") <= TOP_PATHS)
    ordered = F.array_sort(F.collect_list(F.struct("place", "path")))
    return top.groupBy("host").agg(F.transform(ordered, lambda p: p["path"]).alias("paths"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars for every row of `pages`."""
    pages = only(pages, page_id=id_col, url=url_col, html=html_col).withColumn("host", host_of(F.col("url")))
    winners = stage(winning_paths(pages), "host-paths")
    side = F.broadcast(winners) if winners.count() <= BROADCAST_HOSTS else winners
    kind = dict(pages.dtypes)["page_id"]

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = [extract(page, paths or []) for page, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.record_batch(
                {"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
            )

    joined = pages.join(side, "host", "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(extracted, f"page_id {kind}, url string, text string, n_chars long")
