"""Main text of web pages by the consensus of their host.

1. Every page is read into blocks (paragraphs, headings, cells) and containers, which hold
   ranges of blocks. Blocks under labelled furniture (menus, adverts, forms, comments, ...) never count.
   The page names its best container by a generalised path: tags, ids and classes, digits
   replaced by ``#``, so ``div.post-17`` and ``div.post-18`` are one path.
2. Spark counts the names per host. A path with an eighth of a host's pages wins, so a host
   has at most eight winners, which is one for each kind of page that matters.
3. Every page is read again with the winners of its host: the most frequent one found on the
   page tells which containers are the article; a page without any keeps its own best.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.text import slices
from lodestar.llm.urls import host_of
from lodestar.session import cut

#: A path wins with one in so many of its host's pages; hosts with one in so many of all pages are joined without a shuffle.
SHARE, HEAVY = 8, 1000

#: Elements nested deeper than this are read as siblings, as browsers do.
DEEPEST = 512

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup and no text of the page.
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split())
CONTAINER = set("body main article section div td blockquote center".split())
LISTS = set("ul ol menu dl dir table".split())
#: Elements that end an open one of the second list, looked for up to the nearest of the third.
IMPLIED = {"li": ("li", "ul ol menu dir"), "dd": ("dd dt", "dl"), "dt": ("dd dt", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"),
           "th": ("td th", "tr table"), "option": ("option", "select"), "tbody": ("tbody thead tfoot", "table"),
           "tfoot": ("tbody thead tfoot", "table"), "thead": ("tbody thead tfoot", "table")}
IMPLIED = {k: (set(a.split()), set(b.split())) for k, (a, b) in IMPLIED.items()}
P_ENDS = BLOCK - set("body caption dd dt head html legend li option tbody td tfoot th thead tr".split())
P_KEEPS = set("td th caption button object table".split())
TABLE = set("table caption tbody td tfoot th thead tr".split())

#: Furniture by tag, by role and by words of class and id.
FURNITURE_TAGS = set("nav footer aside form search button select dialog template svg object canvas video audio menu header".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog form menu menubar toolbar".split())
COMMENT_WORDS = set("comment comments commentlist disqus respond reply replies discussion".split())
FURNITURE_WORDS = COMMENT_WORDS | set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adunit sponsor sponsors sponsored promo promos promotion "
    "banner banners menu menus nav navbar navigation topnav subnav sitenav breadcrumb breadcrumbs sidebar sidebars aside footer header masthead "
    "cookie cookies consent gdpr notice notices popup popups modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations toolbar pager pagination widget widgets copyright".split())
#: A class that starts or goes on with one of these speaks of another element.
ELSEWHERE = set("has no not with without".split())
MARKED_WORDS = set("article post entry content story main".split())

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))?+)?+")
_COMMENT_END = re.compile(r"--!?>")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


def _tokens(markup: str) -> Iterator[tuple[str, str, str]]:
    """Texts, start and end tags in order: ("", text, ""), ("+", tag, attributes), ("-", tag, "")."""
    at, n = 0, len(markup)
    while at < n:
        tag = markup.find("<", at)
        if tag < 0:
            tag = n
        if tag > at:
            yield "", markup[at:tag], ""
        if tag == n:
            return
        found = _TAG.match(markup, tag)
        if found:
            name = found[2].lower()
            yield "-" if found[1] else "+", name, found[3]
            at = found.end()
            if not found[1] and name in RAW:
                end = _RAW_END[name].search(markup, at)
                at = end.start() if end else n
        elif markup.startswith("<!--", tag):
            if markup.startswith((">", "->"), tag + 4):
                at = markup.index(">", tag) + 1
            else:
                end = _COMMENT_END.search(markup, tag + 4)
                at = end.end() if end else n
        elif markup[tag + 1 : tag + 2] in ("!", "?", "/"):
            end = markup.find(">", tag)
            at = end + 1 if end >= 0 else n
        elif markup[tag + 1 : tag + 2].isalpha() and markup[tag + 1].isascii():
            return  # a tag that never ends
        else:
            yield "", "<", ""
            at = tag + 1


class Page:
    """Blocks and containers of one page, in page order."""

    def __init__(self, markup: str) -> None:
        self.text: list[str] = []
        self.linked: list[int] = []  # characters of each block inside links
        self.links: list[int] = []
        self.heading: list[int] = []  # 1 to 6, or 0
        self.marked: list[bool] = []  # inside an article or the like
        self.paths: dict[tuple[int, str], int] = {(-1, "html"): 0}
        self.boxes: list[list] = [[0, 0, 0, 0]]  # first block, end, path, strength of its own mark
        self._furniture: list[list] = []  # first block, end, why it may wrap the article, keeps headings
        self._lists: list[list] = []  # first block, end
        self._read(markup)
        self.boxes[0][1] = len(self.text)
        self._weigh()

    def _read(self, markup: str) -> None:
        stack: list[tuple[str, list[list], int, bool, int]] = []  # tag, what ends with it, path, marked, mutes
        open_, skipped = Counter(), Counter()
        pieces: list[str] = []
        linked = links = muted = 0

        def flush() -> None:
            nonlocal linked, links
            text = " ".join("".join(pieces).split()) if pieces else ""
            if text:
                self.text.append(text)
                self.linked.append(min(linked, len(text)))
                self.links.append(links)
                self.heading.append(next((i for i in range(1, 7) if open_[f"h{i}"]), 0))
                self.marked.append(bool(stack) and stack[-1][3])
            pieces.clear()
            linked = links = 0

        def pop(index: int = -1) -> None:
            nonlocal muted
            tag, spans, _, _, mutes = stack.pop(index)
            open_[tag] -= 1
            muted -= mutes
            for span in spans:
                span[1] = len(self.text)

        def end_nearest(tags: set[str], barrier: set[str]) -> None:
            """End the nearest open element of ``tags`` and all inside it, unless a barrier stands before it."""
            if any(open_[t] for t in tags):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in tags:
                        flush()
                        while len(stack) > i:
                            pop()
                        return
                    if stack[i][0] in barrier:
                        return

        def end_inline(tag: str) -> None:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    return pop(i)
                if stack[i][0] in BLOCK:
                    return None

        for kind, tag, attributes in _tokens(markup):
            if not kind:
                if not muted:
                    text = html.unescape(tag) if "&" in tag else tag
                    pieces.append(text)
                    if open_["a"]:
                        linked += len(text.strip())
            elif tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    pieces.append(" ")
            elif kind == "-":
                if tag in BLOCK:
                    flush()
                if tag in ("body", "html"):
                    continue
                if skipped[tag]:
                    skipped[tag] -= 1
                elif open_[tag] and tag in BLOCK:
                    end_nearest({tag}, set() if tag in TABLE else TABLE)
                elif open_[tag]:
                    end_inline(tag)
            else:
                if tag in P_ENDS and open_["p"]:
                    end_nearest({"p"}, P_KEEPS)
                if tag in IMPLIED:
                    end_nearest(*IMPLIED[tag])
                if tag in BLOCK:
                    flush()
                if tag in ("html", "head") or (tag == "body" and open_["body"]):
                    continue
                if tag == "a":
                    links += 1
                    if open_["a"]:
                        end_inline("a")
                if len(stack) >= DEEPEST:
                    skipped[tag] += 1
                    continue
                _, _, path, marked, _ = stack[-1] if stack else ("", [], 0, False, 0)
                label, furniture, wraps, own = _look(tag, attributes)
                spans, here = [], len(self.text)
                if furniture and tag in BLOCK:
                    spans.append([here, here, wraps, furniture == "header" and marked])
                    self._furniture.append(spans[-1])
                if tag in CONTAINER:
                    path = self.paths.setdefault((path, label), len(self.paths))
                    own = 0 if furniture else own
                    spans.append([here, here, path, own])
                    self.boxes.append(spans[-1])
                    marked = marked or own > 0
                if tag in LISTS and not marked:
                    spans.append([here, here])
                    self._lists.append(spans[-1])
                mutes = int(bool(furniture) and tag not in BLOCK)
                muted += mutes
                open_[tag] += 1
                stack.append((tag, spans, path, marked, mutes))
        flush()
        while stack:
            pop()

    def _weigh(self) -> None:
        size = [len(t) for t in self.text]
        n = len(size)
        prose = [0, *accumulate(s - k if s - k >= 20 else 0 for s, k in zip(size, self.linked))]
        inner = [0, *accumulate(h == 1 for h in self.heading)]
        articles = [b[0] for b in self.boxes if b[3] > 1]
        junk, but_headings = [0] * (n + 1), [0] * (n + 1)
        for lo, hi, wraps, keeps in self._furniture:
            # A label on something that holds the title and nearly all prose is about the layout, not about furniture;
            # a form around a title is there for the page's buttons.
            held = inner[hi] > inner[lo] or bisect_left(articles, lo) < bisect_left(articles, hi)
            if held and (wraps == "form" or (wraps and prose[hi] - prose[lo] >= 0.8 * prose[n] > 0)):
                continue
            mark = but_headings if keeps else junk
            mark[lo] += 1
            mark[hi] -= 1
        count, linked, total = ([0, *accumulate(x)] for x in (self.links, self.linked, size))
        for lo, hi in self._lists:
            if count[hi] - count[lo] >= 3 and linked[hi] - linked[lo] >= 0.8 * (total[hi] - total[lo]):
                junk[lo] += 1
                junk[hi] -= 1
        junk, but_headings = list(accumulate(junk)), list(accumulate(but_headings))
        self.junk = [
            junk[i] > 0 or (but_headings[i] > 0 and not self.heading[i])
            or (not self.marked[i] and self.links[i] >= 3 and self.linked[i] >= 0.6 * size[i])
            for i in range(n)
        ]
        self._sum = [0, *accumulate(0 if j else s - 2 * k for j, s, k in zip(self.junk, size, self.linked))]

    def _worth(self, box: list) -> float:
        return self._sum[box[1]] - self._sum[box[0]]

    def best(self) -> list:
        """The page's own choice: of the containers with nearly all of its prose an article, else the least with the title."""
        score = [self._worth(b) * (1.5 if b[3] else 1) for b in self.boxes]
        top = max(score)
        title = next((i for i, h in enumerate(self.heading) if h == 1 and not self.junk[i]), None)

        def order(b: list) -> tuple:
            article = b[3] == 3
            return article, title is None or b[0] <= title < b[1], b[3] > 0, b[1] - b[0] if article else b[0] - b[1]

        return max((b for b, s in zip(self.boxes, score) if s >= 0.9 * top), key=order) if top > 0 else self.boxes[0]

    def path_of(self, box: list) -> str:
        above = {number: (parent, label) for (parent, label), number in self.paths.items()}
        labels, at = [], box[2]
        while at >= 0:
            at, label = above[at]
            labels.append(label)
        return " ".join(reversed(labels))

    def at(self, path: str) -> list[list]:
        """Containers at a path that hold prose; of unmarked ones those that hold a tenth of the largest one's."""
        number = -1
        for label in path.split(" "):
            number = self.paths.get((number, label))
            if number is None:
                return []
        found = [b for b in self.boxes if b[2] == number and self._worth(b) > 0]
        most = max(map(self._worth, found), default=0)
        return [b for b in found if b[3] or self._worth(b) >= 0.1 * most]

    def text_of(self, boxes: list[list]) -> str:
        return "\n".join(self.text[i] for lo, hi, *_ in boxes for i in range(lo, hi) if not self.junk[i])


def _look(tag: str, attributes: str) -> tuple[str, str, str, int]:
    """Generalised label of an element, the furniture it is, what may make it a wrapper of the article instead, its own mark."""
    values = {}
    if attributes:
        for name, *value in _ATTRIBUTE.findall(attributes):
            values.setdefault(name.lower(), "".join(value))
    own = {"article": 3, "main": 2}.get(tag, 0)
    furniture, wraps = (tag, "form" * (tag == "form")) if tag in FURNITURE_TAGS else ("", "")
    label = tag
    if values:
        name, role = values.get("id", ""), values.get("role", "").lower()
        classes = [*values.get("class", "").split(), *name.split()]
        label += "".join(sorted({f".{c}" for c in values.get("class", "").split()}))
        label = re.sub(r"[0-9]+", "#", label + (f"#{'_'.join(name.split())}" if name else ""))
        words = [w for w in ([t.lower() for t in _WORDS.findall(c)] for c in classes) if not ELSEWHERE & set(w)]
        words = {w for group in words for w in group}
        if not own and (role in ("main", "article") or "articlebody" in values.get("itemprop", "").lower()):
            own = 2
        elif not own and MARKED_WORDS & words:
            own = 1
        if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(values.get("style", "")):
            furniture, wraps = "hidden", ""
        elif role in FURNITURE_ROLES:
            furniture = furniture or role
        elif tag not in ("body", "main") and not furniture and FURNITURE_WORDS & words:
            furniture = "header" if FURNITURE_WORDS & words == {"header"} else "class"
            wraps = "" if COMMENT_WORDS & words else "class"
    return label, furniture, wraps, own


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        paths = []
        for markup in batch.column("html").to_pylist():
            page = Page(markup)
            paths.append(page.path_of(page.best()) if page.text else None)
        yield pa.RecordBatch.from_pydict({"host": batch.column("host"), "path": pa.array(paths, pa.string())})


def winning_paths(pages: DataFrame) -> DataFrame:
    """``host``, ``pages`` (that voted) and ``paths`` (at most eight, the most frequent first) of every host.

    Each page casts one vote; pages without a host or without text cast none. Votes are counted by
    host and path on the map side first, so a host with a third of all pages is a few rows per task.
    """
    texts = pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")).filter("host <> ''")
    votes = texts.mapInArrow(_vote, "host string, path string").filter("path is not null")
    counts = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("host").agg(F.sum("n").alias("pages"))
    won = counts.join(totals, "host").filter(F.col("n") * SHARE >= F.col("pages"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    return won.groupBy("host").agg(F.first("pages").alias("pages"), ranked["path"].alias("paths"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts, paths = [], []
        for markup, winners in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist()):
            page = Page(markup)
            path, boxes = next(((p, b) for p in winners or [] if (b := page.at(p))), (None, None))
            texts.append(page.text_of(boxes or [page.best()]))
            paths.append(path)
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array(map(len, texts), pa.int64()), "host_path": pa.array(paths, pa.string())})


def extract(pages: DataFrame) -> DataFrame:
    """Per page ``page_id``, ``url``, ``text``, ``n_chars`` (code points) and ``host_path``, the winner it was read by.

    ``text`` is the article: its blocks in page order, one per line, without menus, headers, footers, sidebars,
    notices, adverts, forms, comments and hidden parts; character references are decoded, white space in a block is one
    space. It is empty where nothing is left. A null html is empty; a page without a host, or without any
    winning path of its host, is read by its own best container (``host_path`` is null). Repeated rows are read each, null ids
    kept, other columns ignored; an empty table gives an empty table.

    Hosts with a thousandth of all pages, of which there are at most a thousand, are joined by
    broadcast, so their pages do not move; the pages of smaller hosts are shuffled once.
    """
    winners = cut(winning_paths(pages))
    total = winners.agg(F.sum("pages")).first()[0] or 0
    heavy = winners.filter(F.col("pages") * HEAVY >= total).select("host", "paths")
    light = winners.filter(F.col("pages") * HEAVY < total).select("host", "paths")
    read = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    hostless = read.filter("host = ''").withColumn("paths", F.lit(None).cast("array<string>"))
    hosted = read.filter("host <> ''")
    near = hosted.join(F.broadcast(heavy), "host")
    far = hosted.join(F.broadcast(heavy), "host", "left_anti").join(light, "host", "left")
    columns = ["page_id", "url", "html", "paths"]
    both = near.select(*columns).unionByName(far.select(*columns)).unionByName(hostless.select(*columns))
    types = dict(pages.select("page_id", "url").dtypes)
    return both.mapInArrow(_extract, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long, host_path string")
