"""Main text of web pages by consensus of the pages of a host.

Every page's containers are scored by the text they hold outside links and boilerplate. Containers are named by generalised
paths (tags and classes from the root, digits replaced), and each page votes for the paths of its best containers. The votes
are summed per host in Spark, and the pages are extracted again by the winning paths of their host: the first winner that holds
at least half of what the page's own best container holds gives the text. A page without such a winner is extracted by its own best container.

Elements that never hold the article (menus, forms, scripts) are left out at once. Class names and ids only raise a suspicion, which is dropped for
``article`` and ``main``, for names that speak of a layout (``with-sidebar``, ``comments-open``), and where next to nothing of the page would be left
without the suspect. A list of links is a menu unless it stands among paragraphs.

NULL or empty html gives the empty text. Pages without a host (NULL or odd urls) vote together under the empty host. Ids may
be NULL or repeated; every row gets one output row; an empty table gives an empty result. Further columns have no influence. Markup
may be broken: unclosed elements end with their parents, an unfinished tag at the end of a page is no text.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import batches_of, broadcast_within, staged
from tideline.llm.registry import llm_query, table

# A path wins in a host if it has at least this part of the host's votes (so there are 20 winners at most).
LEAST_SHARE = 0.05
BROADCAST_BYTES = 16_000_000
VOTES = 1000

# Kinds of elements, and words in class names and ids that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr "
                   "img label output ruby rt rp".split())
SKIPPED = frozenset("aside audio button canvas dialog embed fieldset footer form frameset head iframe input map menu nav noscript object option "
                    "select svg template textarea title video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = frozenset("p li dt dd blockquote pre figcaption caption th td tr tbody thead tfoot address summary".split()) | HEADINGS
CLOSED_BY = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")),
             "tr": frozenset(("td", "th", "tr", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p"))}
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial banner banners promo promos promotion promoted sponsor sponsored sponsors sidebar "
    "sidebars widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar footer foot comment comments commentlist reply replies "
    "disqus respond related recommended recommendations share sharing social newsletter subscribe subscription signup cookie cookies consent gdpr notice notices "
    "notification notifications popup modal overlay login search searchbox pagination pager copyright legal skip toolbar".split())
# Words that turn a class name into a statement about the layout.
LAYOUT = frozenset("with without no not non has have is open opened closed off on enabled disabled".split())
HEADER = frozenset("header heading-bar siteheader".split())
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
ARTICLE_WORDS = frozenset("article content post entry story body text main".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(script|style)\b(?:.*?</\1\s*>|.*)|<[!?][^>]*>|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|</?[A-Za-z!?][^>]*$", re.S | re.I)
# One attribute after the other, so that nothing within a value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
# A suspect stays if less than this part of the page's unlinked text would be left without it.
LEAST_LEFT = 0.1
# A list of links among at least so many unlinked characters beside it is part of the text.
AMONG = 200
# A host's winning path gives a page's text if it holds at least this part of what the page's own best container holds.
LEAST_OF_BEST = 0.5
_TRUSTED = frozenset(("html", "body", "article", "main"))
_WORDS = re.compile(r"[a-z0-9]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class Container:
    path: str
    parent: int
    tag: str
    skipped: bool
    header: bool  # in a header of the article: only headings count
    good: bool
    suspect: bool = False  # its names say that it is not the article
    score: float = 0.0


@dataclass
class Block:
    container: int
    heading: bool
    group: int  # the list a list item belongs to, -1 elsewhere
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def parse(page: str) -> tuple[list[Container], list[Block]]:
    """Containers and text blocks of a page, in page order, without those in skipped elements."""
    containers = [Container("", -1, "", False, False, False)]
    blocks: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, -1)]  # tag, container, list
    links = 0
    current: Block | None = None
    at = 0

    def text(data: str) -> None:
        nonlocal current
        tag, place, group = stack[-1]
        c = containers[place]
        if c.skipped:
            return
        if current is None:
            if not data.strip():
                return
            current = Block(place, any(x[0] in HEADINGS for x in stack[-6:]), group)
            blocks.append(current)
        current.parts.append(data)
        if links:
            current.linked += len(data.strip())

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        closing = (m[2] or m[5]) == "/"
        if name == "br" or name == "hr":
            if current is not None:
                current.parts.append(" ")
            if name == "hr":
                current = None
            continue
        if name in VOID:
            continue
        if name not in INLINE:
            current = None
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    links = max(0, links - sum(1 for x in stack[i:] if x[0] == "a"))
                    del stack[i:]
                    break
            continue
        if name in CLOSED_BY:
            # An open paragraph or item ends here, unless a container lies between.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in CLOSED_BY[name]:
                    links = max(0, links - sum(1 for x in stack[i:] if x[0] == "a"))
                    del stack[i:]
                    if name not in ("tr",):
                        break
                elif stack[i][0] not in INLINE and stack[i][0] not in LEAVES:
                    break
        if name == "a":
            links += 1
        _, parent, group = stack[-1]
        above = containers[parent]
        attributes = m[4] if m[3] else m[7]
        if name in INLINE and not above.skipped and not (attributes and ("class" in attributes or "hidden" in attributes or "style" in attributes)):
            stack.append((name, parent, group))
            continue
        found = {}
        for k, v in _ATTRIBUTE.findall(attributes) if attributes else ():
            found.setdefault(k.lower(), v.strip("\"'"))
        words = set(_WORDS.findall((found.get("class", "") + " " + found.get("id", "")).lower())) if found else set()
        skipped = above.skipped or name in SKIPPED or (name not in ("html", "body") and (
            found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
            or "display:none" in found.get("style", "").replace(" ", "").lower()))
        suspect = not skipped and name not in _TRUSTED and any(not_article(n) for n in (found.get("class", "") + " " + found.get("id", "")).lower().split())
        header = above.header
        if not skipped and (name == "header" or words & HEADER):
            inside = any(x[0] == "article" for x in stack)
            skipped, header = not inside, inside
        if name in INLINE and not skipped and not suspect or name in LEAVES and not skipped and not words:
            stack.append((name, parent, group))
            continue
        label = name + "".join("." + _DIGITS.sub("#", w) for w in sorted(found.get("class", "").lower().split()))
        containers.append(Container(f"{above.path}>{label}", parent, name, skipped, header, bool(words & ARTICLE_WORDS) or name in ("article", "main"), suspect))
        place = len(containers) - 1
        stack.append((name, place, place if name in ("ul", "ol", "dl") else group))
    if at < len(page):
        text(page[at:])

    for b in blocks:
        b.text = " ".join(entities.unescape("".join(b.parts)).split())
    blocks = without_suspects(containers, [b for b in blocks if b.text])
    # A list whose items are links and nothing else is a menu, unless it stands among paragraphs.
    items: dict[int, list[bool]] = {}
    beside: Counter[int] = Counter()
    for b in blocks:
        if b.group >= 0:
            items.setdefault(b.group, []).append(b.linked >= 0.8 * len("".join(b.parts).strip()))
        else:
            beside[b.container] += unlinked(b)
    menus = {g for g, all_links in items.items() if len(all_links) >= 3 and all(all_links) and beside[containers[g].parent] < AMONG}
    return containers, [b for b in blocks if b.group not in menus and (b.heading or not containers[b.container].header)]


def unlinked(block: Block) -> float:
    return max(0.0, len(block.text) - 2.0 * block.linked)


def not_article(name: str) -> bool:
    """Whether a class name or id says that its element is not the article."""
    words = set(_WORDS.findall(name))
    return bool(words & NOT_ARTICLE) and not (words & LAYOUT)


def without_suspects(containers: list[Container], blocks: list[Block]) -> list[Block]:
    """The blocks outside suspect containers; while next to nothing is left, the outermost suspect with the most text is trusted."""
    if not any(c.suspect for c in containers):
        return blocks
    total = sum(map(unlinked, blocks))
    while True:
        outermost = [0] * len(containers)  # the outermost suspect around each container, 0 for none
        for i, c in enumerate(containers[1:], 1):
            outermost[i] = outermost[c.parent] or (i if c.suspect else 0)
        held: Counter[int] = Counter()
        for b in blocks:
            held[outermost[b.container]] += unlinked(b)
        suspects = [(-n, i) for i, n in held.items() if i and n > 0]
        if held[0] >= LEAST_LEFT * total or not suspects:
            return [b for b in blocks if not outermost[b.container]]
        containers[min(suspects)[1]].suspect = False


def best_paths(containers: list[Container], blocks: list[Block], most: int = 3) -> list[tuple[str, float]]:
    """The generalised paths of the best containers, with their scores.

    A block counts by its characters outside links: in full for its container, by half for each one further up. A container
    inside an article element stands for the whole article.
    """
    for b in blocks:
        worth = unlinked(b)
        place, share = b.container, 1.0
        while place > 0:
            containers[place].score += worth * share
            place, share = containers[place].parent, share / 2
    scored: Counter[str] = Counter()
    for c in containers[1:]:
        if c.skipped or c.score <= 0:
            continue
        score = c.score * (1.25 if c.good else 1.0)
        up = c
        while up.parent >= 0:
            if up.tag == "article":
                c = up
            up = containers[up.parent]
        scored[c.path] = max(scored[c.path], score)
    return sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:most]


def extract(page: str | None, winners: list[str] | None) -> str:
    """The blocks below the first of ``winners`` that holds enough of the page, else below its own best container, joined by line ends."""
    if not page:
        return ""
    containers, blocks = parse(page)
    best = best_paths(containers, blocks, 1)
    if not best:
        return "\n".join(b.text for b in blocks)
    held: Counter[str] = Counter()  # unlinked characters below each path
    above: dict[str, list[str]] = {}
    for b in blocks:
        path = containers[b.container].path
        if path not in above:
            above[path] = [path[:i] for i in range(1, len(path)) if path[i] == ">"] + [path]
        for p in above[path]:
            held[p] += unlinked(b)
    path = next((w for w in winners or () if held[w] > 0 and held[w] >= LEAST_OF_BEST * held[best[0][0]]), best[0][0])
    inside = [False] * len(containers)
    for i, c in enumerate(containers[1:], 1):
        inside[i] = c.path == path or inside[c.parent]
    return "\n".join(b.text for b in blocks if inside[b.container])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(_of, _paths): the winning paths of each host, most votes first. Stored."""
    source = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.int64())])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes: Counter[tuple[str, str]] = Counter()
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                best = best_paths(*parse(page)) if page else []
                total = sum(score for _, score in best)
                for path, score in best:
                    votes[host, path] += round(VOTES * score / total)
            yield pa.RecordBatch.from_arrays([
                pa.array([h for h, _ in votes], type=pa.string()), pa.array([p for _, p in votes], type=pa.string()),
                pa.array(list(votes.values()), type=pa.int64())], schema=schema)

    with batches_of(pages.sparkSession, 200):
        summed = staged(source.mapInArrow(vote, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes")), "votes")
    totals = summed.groupBy(F.col("host").alias("_of")).agg(F.sum("votes").alias("_all"))
    won = summed.join(totals, F.col("host") == F.col("_of")).where(F.col("votes") >= F.col("_all") * LEAST_SHARE)
    ranked = won.groupBy("_of").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), F.col("path").alias("p")))).alias("_won"))
    return staged(ranked.select("_of", F.col("_won.p").alias("_paths")), "host-paths")


def main_text(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), out: str = "text") -> DataFrame:
    """``keep`` and the main text of every page."""
    winners = broadcast_within(host_paths(pages, url, html), BROADCAST_BYTES)
    source = pages.select(*keep, F.col(html).alias("_html"), host_of(F.col(url)).alias("_host")).join(winners, F.col("_host") == F.col("_of"), "left")
    source = source.select(*keep, "_html", "_paths")
    schema = source.drop("_html", "_paths").withColumn(out, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p, w) for p, w in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(texts, type=pa.string())], names=[*keep, out])

    with batches_of(pages.sparkSession, 200):
        return staged(source.mapInArrow(run, schema), "main-texts")


@llm_query("op4_consensus_html")
def op4_consensus_html(spark, sf_dir):
    texts = main_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
