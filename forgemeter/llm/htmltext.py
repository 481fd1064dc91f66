"""Main text of web pages by the container paths that a host's pages agree on.

Each page is cut into blocks of text, each with the path of containers around it: tag names with
their classes, numbers generalised (``div.post-0``). Containers are weighed by all running text
below them, less links; a page votes for its article or main element or else for the lowest container
that holds nearly all of it. Spark adds the votes up by host, and the paths that win a good share of
a host's pages are its templates. Every page is then read again and the text of its host's winning
path returned; a page without any of them falls back on its own best.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.llm import tables

SHARE = 0.2
# The share of a page's running text that its article's container holds at least.
NEARLY = 0.97
BROADCAST_HOSTS = 50_000
SALTS = 32

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(
    "html body main article section div td th table center blockquote details".split()
)
BLOCKS = CONTAINERS | frozenset(
    "address caption dd dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup li "
    "ol p pre summary tbody tfoot thead tr ul nav footer aside form title head menu".split()
)
DROPPED = frozenset(
    "head title nav footer aside form noscript template iframe button select option datalist "
    "dialog object svg canvas audio video map menu".split()
)
CLOSED_BY = {
    "p": BLOCKS - {"html", "body"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
# Words of class names and ids that mark what is not the article.
COMMENTS = frozenset("comment comments commentlist respond reply replies discussion disqus".split())
BOILERPLATE = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo "
    "promotion cookie cookies consent gdpr notice notices alert alerts newsletter subscribe signup "
    "sidebar side aside menu menus nav navbar navigation breadcrumb breadcrumbs footer share sharing "
    "social related "
    "recommended widget widgets popup modal overlay login search pagination pager toolbar "
    "copyright disclaimer skip hidden".split()
)
# Words that may stand beside those in a name (``sidebar-left``); with any other, as in
# ``has-sidebar`` or ``related-work``, the name says something else.
BESIDE = frozenset(
    "site page global primary secondary left right top bottom upper lower header bar box block area "
    "container wrapper wrap inner outer section region zone slot unit panel list item items link links "
    "button buttons icon icons form field posts articles stories trail thread reader readers user users "
    "visitor customer".split()
)
KNOWN_COMMENTS = frozenset(
    "post-comments entry-comments article-comments user-reviews reader-reviews customer-reviews".split()
)
KNOWN = KNOWN_COMMENTS | frozenset("post-share entry-share".split())
# A named element with this share of a page's running text stays, unless it is named as comments. So
# does a form, or an unclosed menu, if that text is also of a length that no login or search form has.
MOST = 0.8
LONG = 200
RESCUED = frozenset(["form", "nav", "menu"])
# What cannot stand in an open element of these, and so ends it.
ENDED_BY = {
    "nav": frozenset(["main", "article"]),
    "menu": frozenset(["main", "article"]),
    "select": BLOCKS | {"button", "a", "img"},
    "option": BLOCKS | {"option", "button", "a", "img"},
    "optgroup": BLOCKS | {"optgroup", "button", "a", "img"},
}
ROLES = frozenset("navigation banner contentinfo complementary search alert form dialog menu".split())

RAW = frozenset("script style textarea xmp noembed noframes".split())
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*([\"'])")
_ATTRIBUTE = re.compile(
    r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I
)
_PARTS = re.compile(r"[-_:\s]+|(?<=[a-z])(?=[A-Z])")
_NUMBER = re.compile(r"\d+")
_COUNT = re.compile(r"\d+(?:x\d+)?")
_SPACE = re.compile(r"\s+")


def _attributes(raw: str) -> dict[str, str]:
    if not raw or "=" not in raw and "hidden" not in raw.lower():
        return {}
    return {a.lower(): html.unescape(b or c or d) for a, b, c, d in _ATTRIBUTE.findall(raw)}


_Piece = tuple[str, bool, str]


def pieces(page: str) -> Iterator[tuple[str, _Piece | None]]:
    """A page as (text, tag after it): the tag's name, whether it closes, its attributes; comments and
    elements of raw text are left out.

    The scan only goes forward. A tag ends at the first ``>`` outside quotes; where a quote is never closed,
    tags up to there end at their first ``>``, and a tag without one is text."""
    at, unquoted = 0, 0
    last = page.rfind(">")
    last_quote = {q: page.rfind(q) for q in "\"'"}
    start = page.find("<")
    while start >= 0:
        text = page[at:start]
        if page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            yield text, None
            at = len(page) if stop < 0 else stop + 3
        elif start > last:
            break
        elif found := _NAME.match(page, start + 1):
            stop = -1
            here = found.end()
            while start >= unquoted:
                mark = _STOP.search(page, here)
                if mark is None or not mark[1]:
                    stop = mark.start() if mark else -1
                    break
                here = mark.end()
                if here > last_quote[mark[1]]:
                    unquoted = here
                    break
                here = page.index(mark[1], here) + 1
            if stop < 0:
                unquoted = max(unquoted, here)
                stop = page.find(">", start)
            name = found[2].lower()
            at = stop + 1
            if name in RAW and not found[1]:
                end = re.compile(rf"</{name}", re.I).search(page, at)
                close = page.find(">", end.end()) if end else -1
                at = len(page) if close < 0 else close + 1
                yield text, None
            else:
                yield text, (name, bool(found[1]), page[found.end() : stop])
        elif page[start + 1 : start + 2] in ("!", "?", "/"):
            yield text, None
            at = page.find(">", start) + 1
        else:
            # A sign that begins nothing is text, up to the next one.
            yield page[at : start + 1], None
            at = start + 1
        start = page.find("<", at)
    yield page[at:], None


def _is_dropped(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if _SPACE.sub("", attributes.get("style", "").lower()).startswith("display:none"):
        return True
    return attributes.get("role", "").lower() in ROLES


def _names_boilerplate(name: str, in_article: bool) -> bool:
    parts = [p.lower() for p in _PARTS.split(name) if p]
    marks = BOILERPLATE if in_article else BOILERPLATE | {"header"}
    if "-".join(parts) in KNOWN:
        return True
    return not marks.isdisjoint(parts) and all(
        p in marks or p in BESIDE or _COUNT.fullmatch(p) for p in parts
    )


def _names(attributes: dict[str, str]) -> list[str]:
    return f"{attributes.get('class', '')} {attributes.get('id', '')}".split()


def _is_named_boilerplate(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a whole class name or id says so, not any part of one."""
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    return any(_names_boilerplate(name, in_article) for name in _names(attributes))


def _is_comments(attributes: dict[str, str], in_article: bool) -> bool:
    for name in _names(attributes):
        parts = [p.lower() for p in _PARTS.split(name) if p]
        marked = "-".join(parts) in KNOWN_COMMENTS or not COMMENTS.isdisjoint(parts)
        if marked and _names_boilerplate(name, in_article):
            return True
    return False


def _segment(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted(set(attributes.get("class", "").lower().split()))
    return _NUMBER.sub("0", ".".join([tag, *classes]))


_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = frozenset(
    "p h1 h2 h3 h4 h5 h6 pre blockquote article main section div li dd td body".split()
)


class Block:
    """A run of text: its container's path, its innermost block tag, its link share, and the
    innermost element around it that is marked as no part of the article."""

    __slots__ = ("path", "text", "linked", "tag", "mark")

    def __init__(self, path: int, text: str, linked: int, tag: str, mark: int):
        self.path, self.text, self.linked, self.tag, self.mark = path, text, linked, tag, mark

    @property
    def worth(self) -> float:
        """Its running text: less links, half of it where the tag seldom holds any."""
        running = max(0, len(self.text) - 2 * self.linked)
        return running if self.tag in _PROSE else running / 2


class Tree:
    """A page's container paths as numbers, each after the one around it, and its blocks."""

    def __init__(self) -> None:
        self.around = [-1]
        self.segment = [""]
        self.below: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []

    def child(self, path: int, segment: str) -> int:
        number = self.below.get((path, segment))
        if number is None:
            number = self.below[path, segment] = len(self.around)
            self.around.append(path)
            self.segment.append(segment)
        return number

    def names(self, path: int) -> tuple[str, ...]:
        out = []
        while path > 0:
            out.append(self.segment[path])
            path = self.around[path]
        return tuple(reversed(out))

    def find(self, names: tuple[str, ...]) -> int | None:
        path: int | None = 0
        for segment in names:
            path = self.below.get((path, segment))
            if path is None:
                return None
        return path

    def inside(self, path: int) -> list[bool]:
        """For every path whether it is this one or lies in it."""
        out = [False] * len(self.around)
        for number, around in enumerate(self.around):
            out[number] = number == path or (around >= 0 and out[around])
        return out


class _Marks:
    """The elements of a page that are marked as no part of the article, each after the one around it."""

    def __init__(self) -> None:
        self.around = [-1]
        self.rescue = [0.0]  # running text needed, beside its share, to stay
        self.closed = [True]

    def add(self, around: int, rescue: float) -> int:
        self.around.append(around)
        self.rescue.append(rescue)
        self.closed.append(False)
        return len(self.around) - 1

    def kept(self, found: list[Block]) -> list[Block]:
        """The blocks outside marked elements, but for those that hold most running text."""
        if len(self.around) == 1:
            return found
        held = [0.0] * len(self.around)
        for block in found:
            held[block.mark] += block.worth
        for number in range(len(held) - 1, 0, -1):
            held[self.around[number]] += held[number]
        stays = [True] * len(held)
        for number in range(1, len(held)):
            worth = held[number]
            enough = worth > 0 and worth >= max(MOST * held[0], self.rescue[number])
            stays[number] = stays[self.around[number]] and enough
        return [b for b in found if stays[b.mark]]


NEVER = float("inf")


class _Open:
    """An open element: what its text belongs to."""

    __slots__ = ("tag", "path", "dropped", "mark", "block", "article", "own")

    def __init__(self, tag: str, path: int, dropped: bool, mark: int, block: str, article: bool, own: int):
        self.tag, self.path, self.dropped, self.mark = tag, path, dropped, mark
        self.block, self.article, self.own = block, article, own


def blocks(page: str | None) -> Tree:
    """The text blocks outside boilerplate, in page order; white space is one space, references
    are decoded. Unclosed elements end with the page. Time is linear in the page, however deep it nests."""
    tree, marks = Tree(), _Marks()
    out = tree.blocks
    stack = [_Open("", 0, False, 0, "", False, 0)]
    opened: dict[str, int] = defaultdict(int)
    pending: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pending:
            text = " ".join(html.unescape("".join(pending)).split())
            if text:
                top = stack[-1]
                out.append(Block(top.path, text, linked, top.block, top.mark))
            pending.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].dropped:
            pending.append(text)
            if opened["a"]:
                linked += len(text)

    def pop(closing: bool = False) -> None:
        top = stack[-1]
        if top.tag in BLOCKS or top.dropped or top.own:
            flush()
        if top.own and not closing and top.tag in ("nav", "menu"):
            marks.rescue[top.own] = LONG
        stack.pop()
        opened[top.tag] -= 1

    def end(tag: str) -> None:
        while stack[-1].tag != tag:
            pop()
        pop(closing=True)

    for text, piece in pieces(page or ""):
        add(text)
        if piece is None:
            continue
        tag, closes, raw = piece
        if closes:
            if opened[tag] > 0:
                end(tag)
            elif tag in BLOCKS:
                flush()
            continue
        if tag == "br" or tag == "hr":
            add(" ")
            continue
        if tag in VOID:
            continue
        for open_tag, ends in ENDED_BY.items():
            if opened[open_tag] > 0 and tag in ends:
                while opened[open_tag] > 0:
                    pop()
        if tag in BLOCKS:
            flush()
            while tag in CLOSED_BY.get(stack[-1].block, ()):
                end(stack[-1].block)
        top = stack[-1]
        path, dropped, mark, article, own = top.path, top.dropped, top.mark, top.article, 0
        if not dropped:
            attributes = _attributes(raw)
            if _is_dropped(tag, attributes, article):
                flush()
                rescued = tag in RESCUED or attributes.get("role", "").lower() == "form"
                dropped = not rescued
                if rescued:
                    # A menu may stay only if it turns out to be unclosed.
                    mark = own = marks.add(mark, LONG if tag not in ("nav", "menu") else NEVER)
            elif _is_named_boilerplate(tag, attributes, article):
                flush()
                mark = own = marks.add(mark, NEVER if _is_comments(attributes, article) else 0)
            if not dropped and tag in CONTAINERS:
                path = tree.child(path, _segment(tag, attributes))
        if not raw.endswith("/") or tag not in ("path", "use", "circle", "rect"):
            block = tag if tag in BLOCKS else top.block
            stack.append(
                _Open(tag, path, dropped, mark, block, article or tag in ("article", "main"), own)
            )
            opened[tag] += 1
    while len(stack) > 1:
        pop()
    flush()
    tree.blocks = marks.kept(out)
    return tree


def best_path(tree: Tree) -> int | None:
    """The container of the page's article: an article or main element with half of the running
    text, the outermost of those with most; else the lowest container that holds nearly all of it
    and every heading; the whole page where no text is running text."""
    if not tree.blocks:
        return None
    size = len(tree.around)
    held, headings, depth = [0.0] * size, [0] * size, [0] * size
    there = [False] * size
    for block in tree.blocks:
        worth = block.worth
        held[block.path] += worth
        there[block.path] = True
        headings[block.path] += block.tag in _HEADINGS and worth > 0
    for path in range(size - 1, 0, -1):
        around = tree.around[path]
        held[around] += held[path]
        headings[around] += headings[path]
        there[around] = there[around] or there[path]
    for path in range(1, size):
        depth[path] = depth[tree.around[path]] + 1
    if not held[0]:
        return 0
    marked = [
        p for p in range(1, size)
        if there[p] and tree.segment[p].partition(".")[0] in ("article", "main")
    ]
    first = min(marked, key=lambda p: (-held[p], depth[p], tree.segment[p]), default=None)
    if first is not None and 2 * held[first] >= held[0]:
        return first
    # Halves add up exactly, so a path with all running text is not lost to rounding.
    enough = NEARLY * held[0]
    whole = [p for p in range(size) if held[p] >= enough and headings[p] == headings[0]]
    return max(whole, key=lambda p: depth[p])


def text_of(tree: Tree, winners: list[tuple[str, ...]]) -> str:
    """The text under the first winning path that the page has, else under its own best.

    The page's own best is taken before a winner inside it, for what this page has beside the
    winner is of the article too; but the body only where the host's pages agree on it."""
    own = best_path(tree)
    if own is None:
        return ""
    found = [path for names in winners if (path := tree.find(names)) is not None]
    in_own = tree.inside(own)
    first = own in found or not _is_page(tree.names(own))
    for path in [*found, own]:
        inside = in_own if in_own[path] and first else tree.inside(path)
        got = [b.text for b in tree.blocks if inside[b.path]]
        if got:
            return " ".join(got)
    return ""


def _is_page(path: tuple[str, ...]) -> bool:
    return all(segment.partition(".")[0] in ("html", "body") for segment in path)


def host_of(url: Column) -> Column:
    """The lower-cased host of a URL, without port and user; empty where there is none."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(raw)


def vote(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """Winning paths by host: those with ``share`` of its votes, so at most 1 / share of them, most
    votes first, ties by path. A host whose pages agree on nothing has no row; a page without a
    container of its own does not vote."""

    def ballots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            named = []
            for page in batch["html"]:
                tree = blocks(page)
                best = best_path(tree)
                named.append("/".join(tree.names(best)) if best else None)
            yield pd.DataFrame({"host": batch["host"], "path": named})

    cast = pages.select(host_of(F.col("url")).alias("host"), "html")
    votes = (
        cast.mapInPandas(ballots, "host string, path string")
        .filter(F.col("path").isNotNull())
        .groupBy("host", "path")
        .agg(F.count("*").alias("votes"))
    )
    votes = tables.stage(votes, "html-votes")
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path")))
    return (
        votes.join(totals, "host")
        .filter(F.col("votes") >= share * F.col("total"))
        .groupBy("host")
        .agg(F.transform(ranked, lambda x: x["path"]).alias("winners"))
    )


def extract(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """page_id, url, host, text of every page. A null or empty html gives an empty text, a null url
    the host ``''``; repeated rows are each extracted, other columns are ignored."""
    wanted = pages.select("page_id", "url", F.col("html").cast("string"))
    winners = tables.stage(vote(wanted, share), "html-winners")
    hosted = wanted.withColumn("host", host_of(F.col("url")))
    if winners.count() <= BROADCAST_HOSTS:
        joined = hosted.join(F.broadcast(winners), "host", "left")
    else:
        # A host may hold a third of the pages: its winners are repeated under so many salts.
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        salted = winners.withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        )
        joined = hosted.withColumn("salt", salt).join(salted, ["host", "salt"], "left")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                text_of(
                    blocks(page),
                    [] if paths is None else [tuple(p.split("/")) if p else () for p in paths],
                )
                for page, paths in zip(batch["html"], batch["winners"], strict=True)
            ]
            yield pd.DataFrame(
                {"page_id": batch["page_id"], "url": batch["url"], "host": batch["host"], "text": texts}
            ).astype({"page_id": "Int64"})

    return joined.select(F.col("page_id").cast("long"), "url", "host", "html", "winners").mapInPandas(
        read, "page_id long, url string, host string, text string"
    )


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(tables.read_table(spark, folder, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


QUERIES = {"op7_html_text": op7_html_text}
ORACLES: dict[str, str] = {}
