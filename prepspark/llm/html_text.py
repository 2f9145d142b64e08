"""Main text of web pages by consensus paths of their hosts.

1. Each page's containers are scored: characters of the text blocks in them, less those in
   links, half of it passed to the container around.  The best one, widened to the article or
   main element it stands in, gives a generalised path: tags and classes from the root,
   digits replaced by N.
2. Pages vote for their path; the votes of a host are added up in Spark, and the path with
   most votes wins (ties: the smaller path).
3. Every page is extracted again, below the host's path; a page without that path uses its
   own best one.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out by tag, role and class words, wherever they stand.  A class or id is
evidence only: all its words must say so (``share-buttons``, not ``share-price``), the element must hold less than
half of the page's text outside links, and ids of headings and ids of sections made from their titles
say nothing.  A title and lead paragraphs before the container belong to it.  White space in a
block becomes one space and blocks are joined by a line feed; nothing else is dropped.
Broken pages are read as browsers do: an open paragraph ends where the next block starts,
stray end tags are ignored, an unfinished tag at the end is dropped.

Votes are summed in each task before they are shuffled.  The winners are a table of one row
per host; pages are shuffled only if it is above the session's broadcast threshold, and then
a large host can be split by the engine.

Results for odd input: a null or empty html gives an empty text; a null url belongs to the
host ""; null or repeated ids are passed on row by row; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, settle, slices, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption caption legend summary address th td hr".split())
HOLDER = frozenset(
    "html body article main section div blockquote ul ol dl table thead tbody tfoot tr center figure details "
    "fieldset form header footer nav aside menu dialog hgroup head".split()
)
BLOCK = LEAF | HOLDER
DROPPED_TAGS = frozenset("head nav footer aside form menu dialog button select option svg object audio video canvas datalist".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Words of a class or id that mark something beside the article.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer footnav gdpr login masthead menu menus modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination paywall popup promo promotion recommended related reply replies respond "
    "search share sharing sidebar sidenav signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets "
    "discussion discussions header".split()
)
#: Words that say nothing on their own: a name marks its element if all its words are of these or of the above.
PLAIN_WORDS = frozenset(
    "area aside bar block body bottom box button buttons card cell col column container content cta footer form group holder icon icons "
    "inline inner item items left link links list main module outer page panel place post posts primary reader readers right row secondary "
    "section site slot space strip text thread title top unit user users wrap wrapper zone".split()
)
#: Start tags that end an open element of the named kinds.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tr", "td", "th", "tbody", "thead"), "thead": ("tr", "td", "th"), "tfoot": ("tr", "td", "th", "tbody"), "option": ("option",),
}
#: Elements beyond which a start tag closes nothing.
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_MARK = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


def _tag_end(html: str, at: int) -> int:
    """Offset of the '>' that ends the tag; quoted values may hold one.  -1: unfinished."""
    while True:
        m = _MARK.search(html, at)
        if m is None:
            return -1
        if m.group() == ">":
            return m.start()
        close = html.find(m.group(), m.end()) if html[max(0, m.start() - 16) : m.start()].rstrip().endswith("=") else -1
        at = close + 1 if close >= 0 else m.end()


#: Share of a container's own text that the containers beside it hold at least where their parent is taken.
BESIDE = 0.1
#: The same for the body, which holds what no word or tag marks as well.
BESIDE_IN_BODY = 0.5
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TITLE = re.compile(r"\s*<h[1-6]\b[^>]*>(.*?)</h[1-6]", re.I | re.S)
_TAG = re.compile(r"<[^>]*>")


def _slug(text: str) -> str:
    return "-".join(re.findall(r"\w+", _TAG.sub("", text).lower()))


def _marks(tag: str, named: str, ident: str, html: str, at: int) -> set[str]:
    """Words of class and id that say what the element itself is; ``at``: where its content starts.

    A name counts as a whole: ``share-buttons`` says what the element is, ``share-price`` does not.
    """
    if tag == "section" and "-" in ident and (title := _TITLE.match(html, at)) and _slug(title.group(1)) == _slug(ident):
        ident = ""  # made from the title
    words: set[str] = set()
    for name in [*named.split(), *([] if tag in HEADINGS else ident.split())]:
        parts = [w.lower() for w in _WORD.findall(name)]
        if parts and all(w in DROPPED_WORDS or w in PLAIN_WORDS for w in parts):
            words.update(parts)
    return words


class Page:
    """Blocks (node, text, characters in links) of a page; a node is a generalised path.

    One reading keeps the blocks of marked elements with their innermost mark; which marks count is decided after it.
    """

    def __init__(self, html: str):
        self.parent, self.label = [0], [""]
        self.child: dict[tuple[int, str], int] = {}
        self.found: list[tuple[int, str, int, int, bool, bool]] = []  # node, line, links, mark, in article, heads the page
        self.outer: list[int] = []  # mark around each mark
        self._read(html)
        spared = self._spared()
        kept = [x for x in self.found if x[3] < 0 or x[3] in spared]
        self.blocks: list[tuple[int, str, int]] = [x[:3] for x in kept]
        self.heads = [x[5] for x in kept]

    def _spared(self) -> set[int]:
        """Marks that do not count: outermost first, those that hold half of the page's text, unless an article stands elsewhere."""
        weight, below, direct = [0] * len(self.outer), defaultdict(list), defaultdict(list)
        articles, total = False, 0
        for _, line, links, mark, inside, _ in self.found:
            total += len(line) - links
            direct[mark].append(inside)
            articles = articles or mark < 0 and inside
            if mark >= 0:
                weight[mark] += len(line) - links
        for mark in range(len(self.outer) - 1, -1, -1):  # inner marks have larger numbers
            below[self.outer[mark]].append(mark)
            if self.outer[mark] >= 0:
                weight[self.outer[mark]] += weight[mark]
        spared: set[int] = set()
        open_ = [(-weight[m], m) for m in below[-1]]
        heapq.heapify(open_)
        while open_ and not articles and 0 < total <= -2 * open_[0][0]:
            mark = heapq.heappop(open_)[1]
            spared.add(mark)
            articles = any(direct[mark])
            for inner in below[mark]:
                heapq.heappush(open_, (-weight[inner], inner))
        return spared

    def node(self, parent: int, label: str) -> int:
        key = (parent, label)
        if key not in self.child:
            self.child[key] = len(self.parent)
            self.parent.append(parent)
            self.label.append(label)
        return self.child[key]

    def path(self, node: int) -> str:
        labels = []
        while node:
            labels.append(self.label[node])
            node = self.parent[node]
        return ">".join(reversed(labels))

    def find(self, path: str) -> int:
        """Node of a path, or -1."""
        node = 0
        for label in path.split(">") if path else ():
            node = self.child.get((node, label), -1)
            if node < 0:
                return -1
        return node

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, bool, int, bool]] = [("", 0, False, -1, False)]  # tag, node, dropped, mark, in article
        text: list[str] = []
        links = depth = at = 0
        def flush():
            nonlocal links
            if text:
                line = " ".join(unescape("".join(text)).split())
                if line:
                    heads = any(x[0] == "h1" for x in stack[-3:]) or stack[-1][0] == "p" and not links
                    self.found.append((stack[-1][1], line, min(links, len(line)), stack[-1][3], stack[-1][4], heads))
                text.clear()
            links = 0

        def pop(index: int):
            nonlocal depth
            if any(s[0] in BLOCK for s in stack[index:]):
                flush()
            depth -= sum(s[0] == "a" for s in stack[index:])
            del stack[index:]

        while at < len(html):
            start = html.find("<", at)
            piece = html[at : start if start >= 0 else len(html)]
            if piece and not stack[-1][2]:
                text.append(piece)
                links += len(piece) if depth else 0
            if start < 0:
                break
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                at = end + 3 if end >= 0 else len(html)
                continue
            if html[start + 1 : start + 2] in ("!", "?"):
                end = html.find(">", start)
                at = end + 1 if end >= 0 else len(html)
                continue
            m = _NAME.match(html, start + 1)
            if m is None:  # a lone "<" is text
                if not stack[-1][2]:
                    text.append("<")
                at = start + 1
                continue
            end = _tag_end(html, m.end())
            if end < 0:
                break
            at = end + 1
            tag = m.group().lower()
            if tag[0] == "/":
                tag = tag[1:]
                index = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                if index:
                    pop(index)
                elif tag in BLOCK:
                    flush()
                continue
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
                end = html.find(">", close.end()) if close else -1
                at = end + 1 if end >= 0 else len(html)
                continue
            if tag in VOID:
                if tag in ("br", "hr") and not stack[-1][2]:
                    text.append(" ")
                continue
            if tag in BLOCK:
                flush()
                index = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in HOLDER or stack[i][0] in ("p", "td", "th", "li")), 0)
                if index and stack[index][0] == "p":
                    pop(index)
            if tag in CLOSES:
                limit = SCOPE.get(tag, ("table",))
                low = None
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in limit:
                        break
                    if stack[i][0] in CLOSES[tag]:
                        low = i
                if low:
                    pop(low)
            _, node, dropped, mark, inside = stack[-1]
            attributes = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(html, m.end(), end)} if end > m.end() else {}
            named = attributes.get("class", "")
            if not dropped:
                words = _marks(tag, named, attributes.get("id", ""), html, at)
                style = attributes.get("style", "").replace(" ", "").lower()
                dropped = (
                    tag in DROPPED_TAGS
                    or tag == "header" and not inside
                    or tag == "article" and bool(words & {"comment", "comments", "reply", "ad", "advert", "sponsored", "related"})
                    or attributes.get("role", "").lower() in DROPPED_ROLES
                    or "hidden" in attributes
                    or attributes.get("aria-hidden", "").lower() == "true"
                    or "display:none" in style
                )
                if inside:
                    words = words - {"header"}
                by_words = tag not in ("html", "body", "article", "main") and bool(words & DROPPED_WORDS)
                if by_words and not dropped and tag in BLOCK:
                    self.outer.append(mark)
                    mark = len(self.outer) - 1
                dropped = dropped or by_words and tag not in BLOCK
                if dropped and tag not in BLOCK:
                    text.append(" ")
            if tag in HOLDER:
                classes = sorted(set(_DIGITS.sub("N", named).replace(">", "_").split()))
                node = self.node(node, ".".join([tag, *classes]))
            depth += tag == "a"
            stack.append((tag, node, dropped, mark, inside or tag in ("article", "main")))
        flush()

    def best(self) -> int:
        """Node of the container that scores most, widened to its article; -1 without text."""
        score: dict[int, float] = defaultdict(float)
        for node, line, links in self.blocks:
            worth = len(line) - links
            score[node] += worth
            score[self.parent[node]] += worth / 2
        if not score:
            return -1
        node = max(score, key=lambda n: (score[n], -n))
        direct = {n for n, _, _ in self.blocks}
        outer, up = -1, node
        while up:
            if self.label[up].split(".")[0] in ("article", "main") and (outer < 0 or self.label[up].startswith("article")):
                outer = up
            up = self.parent[up]
        if outer >= 0:
            return outer
        while self.parent[node] in direct and self.label[self.parent[node]].split(".")[0] not in ("", "html", "body"):
            node = self.parent[node]
        # sibling containers with text of their own belong to the article
        worth: dict[int, int] = defaultdict(int)
        for n, line, links in self.blocks:
            while n:
                worth[n] += len(line) - links
                n = self.parent[n]
        up = self.parent[node]
        while self.label[up].split(".")[0] not in ("", "html"):
            beside = BESIDE_IN_BODY if self.label[up].split(".")[0] == "body" else BESIDE
            if worth[up] >= (1 + beside) * worth[node]:
                node = up
            up = self.parent[up]
        return node

    def text(self, top: int) -> str:
        below = {top: True, 0: top == 0}

        def under(node: int) -> bool:
            way = []
            while node not in below:
                way.append(node)
                node = self.parent[node]
            for n in way:
                below[n] = below[node]
            return below[node]

        above, up = set(), top
        while up:
            up = self.parent[up]
            above.add(up)
        first = next((i for i, b in enumerate(self.blocks) if under(b[0])), 0)
        # title and lead paragraphs that stand before the container, in none of their own
        lead = (i < first and head and b[0] in above for i, (b, head) in enumerate(zip(self.blocks, self.heads)))
        return "\n".join(b[1] for b, before in zip(self.blocks, lead) if before or under(b[0]))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)
    return F.lower(host)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, votes, pages): each host's winning path."""
    source = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))

    def run(batches):
        for batch in batches:
            votes: dict[tuple[str, str], int] = defaultdict(int)
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = Page(html.as_py() or "")
                if (node := page.best()) >= 0:
                    votes[host, page.path(node)] += 1
            rows = list(votes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([votes[r] for r in rows], pa.int64())],
                ["host", "path", "votes"],
            )

    counted = source.mapInArrow(run, "host string, path string, votes bigint").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = counted.groupBy("host").agg(
        F.min(F.struct((-F.col("votes")).alias("v"), F.col("path").alias("path"))).alias("best"), F.sum("votes").alias("pages")
    )
    return best.select("host", F.col("best.path").alias("path"), (-F.col("best.v")).alias("votes"), "pages")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, ``text``, ``n_chars`` (code points), ``path`` used, per row."""
    winners = settle(host_paths(pages, url_col, html_col).select("host", "path"), "html-paths")
    source = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"),
        host_of(F.col(url_col)).alias("host"),
    ).join(winners, "host", "left").select("id", "url", "html", "path")

    def run(batches):
        for batch in slices(batches):
            texts, used = [], []
            for html, path in zip(batch.column(2), batch.column(3).to_pylist()):
                page = Page(html.as_py() or "")
                node = page.find(path) if path is not None else -1
                text = page.text(node) if node >= 0 else ""
                if not text and (node := page.best()) >= 0:
                    text = page.text(node)
                texts.append(text)
                used.append(page.path(node) if node >= 0 else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(used, pa.string())],
                ["id", "url", "text", "n_chars", "path"],
            )

    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(run, f"id {kind}, url string, text string, n_chars bigint, path string")
    return found.withColumnsRenamed({"id": id_col, "url": url_col})


@query("op9_html_text")
def op9_html_text(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "path")
