"""Main-text extraction by consensus paths of each host.

Every page is parsed into containers and text blocks. Walking down from the body,
the innermost container that still holds all of the page's running text (or the
article around it) is the page's vote: its generalised path of tags and classes
(digits become "#"). Only a block of a single character that isn't a heading, such
as a mark that closes a box, doesn't hold the walk up, and neither do list items of
links outside <article> and <main>, which menus are made of; below the container
that is chosen they are text like any other. Votes are counted per host
in Spark; paths with a tenth of a host's votes or more are its winning paths, most
votes first, but one with more than a tenth comes before all paths inside it. The
second pass takes the text below the first winning path that a page has, or below
the page's own container if it has none; a path that holds next to nothing of a page
beside another with many votes is passed over, as on a host of two templates.

Both passes leave out what isn't the article: scripts, styles, forms, navigation,
page headers, footers, sidebars, and elements whose class, id or role names a menu,
notice, advert, comment section or the like and no content beside it. A <header> in
<article>, <main> or <section> is text.

Defined cases: null or empty html gives an empty text; a page without a container
uses its whole body; a page of nothing but link items has no vote; ties of votes go to
the smaller path; null or odd urls share the host ""; repeated rows vote each and give equal rows; an empty table gives no
rows; input columns named like a result column are replaced; a page of any length or
depth of nesting is parsed whole, at a cost in proportion to its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm.common import column, cut, map_text, unused

#: Percent of a host's votes that a winning path has at least, so a host has ten at most.
WINNING_PERCENT = 10
#: Percent of a wide path's text that a path with more votes holds at least.
SMALL = 20
#: Winning paths that are broadcast at most; beyond it pages meet them in a join.
BROADCAST_PATHS = 50_000

TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*+>?|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)*+)(?:>|\Z))""",
    re.S,
)
ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""")
WORDS = re.compile(r"[a-z]+")

# Kinds of elements and the words that name page furniture.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp"}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "center"}
BLOCKS = CONTAINERS | {
    "html", "head", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tr", "th",
    "blockquote", "pre", "figure", "figcaption", "form", "fieldset", "nav", "header", "footer", "aside", "address", "details", "summary", "hr", "dialog", "menu",
}
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "svg", "object", "dialog", "menu", "header", "canvas", "audio", "video", "label", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FURNITURE = {
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "sidebar", "disqus", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
    "newsletter", "popup", "modal", "footer", "masthead", "pagination", "pager", "toolbar", "signup", "consent",
}
#: These name furniture too, but an article's own parts as well ("related-work", "share-price"): they count only in classes without a word of content.
DOUBTFUL = {
    "promo", "banner", "comment", "comments", "reply", "replies", "cookie", "cookies", "notice", "notices", "menu", "share", "sharing", "social", "related",
    "subscribe", "header", "widget", "skip", "login", "search",
}
#: Words that tell where or how a thing stands, not what it says.
STANDING = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "col", "column", "container", "content", "count", "footer", "form",
    "group", "header", "heading", "icon", "icons", "id", "inner", "item", "items", "js", "left", "link", "links", "list", "main", "media", "outer", "page", "panel", "policy", "post", "posts",
    "primary", "right", "row", "secondary", "section", "site", "slot", "thread", "title", "to", "top", "tree", "unit", "user", "wrap", "wrapper",
}
#: Classes with these starts tell how a page is laid out, not what the element is.
LAYOUT = ("has-", "no-", "with-", "without-")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "form"}
#: Starting one of these ends an open element of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Page:
    """Containers in page order, each with its parent and its step of a generalised path, and blocks as (container, text).

    A path is spelt out only where it is asked for; the digest of a container's path is
    made from its parent's, so pages of any depth cost their length.
    """

    def __init__(self, html: str):
        self.parents = [-1]
        self.steps = [""]
        self.digests = [xxhash.xxh64_intdigest(b"")]
        self.in_article = [False]
        self.in_main = [False]
        self.blocks: list[tuple[int, str]] = []
        self.marks: set[int] = set()  # blocks of a single character
        self.links: set[int] = set()  # items that are links, as a menu has them
        self._parse(html)

    @property
    def paths(self) -> list[str]:
        return [self.path(c) for c in range(len(self.parents))]

    def path(self, at: int) -> str:
        steps = []
        while at > 0:
            steps.append(self.steps[at])
            at = self.parents[at]
        return "".join(reversed(steps))

    def _parse(self, html: str) -> None:
        stack: list[tuple[str, int]] = []  # open elements and the container that each is, or -1
        open_now: Counter[str] = Counter()  # open elements by name
        inside = [0]  # containers
        digests = [xxhash.xxh64()]  # of their paths
        drop_at = -1  # depth of the stack at which the dropped element stands
        parts: list[str] = []
        link = linked = 0
        at, end = 0, len(html)

        def flush() -> None:
            nonlocal parts, linked
            if parts:
                text = " ".join(unescape("".join(parts)).split())
                item = bool(stack) and stack[-1][0] in ("li", "dd", "dt")
                if text:
                    if item and linked >= 0.8 * len(text) and not (self.in_article[inside[-1]] or self.in_main[inside[-1]]):
                        self.links.add(len(self.blocks))
                    elif len(text) == 1 and not (stack and stack[-1][0] in HEADINGS):
                        self.marks.add(len(self.blocks))
                    self.blocks.append((inside[-1], text))
                parts = []
            linked = 0

        def close(depth: int) -> None:
            nonlocal drop_at
            while len(stack) > depth:
                name, container = stack.pop()
                open_now[name] -= 1
                if container >= 0:
                    inside.pop()
                    digests.pop()
            if drop_at >= len(stack):
                drop_at = -1

        while at < end:
            tag = TAG.search(html, at)
            upto = tag.start() if tag else end
            if upto > at and drop_at < 0:
                parts.append(html[at:upto])
                if link:
                    linked += upto - at
            if not tag:
                break
            at = tag.end()
            name = tag["name"]
            if name is None:
                continue
            name = name.lower()
            if tag["end"]:
                if name == "a":
                    link = max(0, link - 1)
                    continue
                open_at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1) if open_now[name] else -1
                if open_at >= 0:
                    if name in BLOCKS:
                        flush()
                    close(open_at)
                elif name in BLOCKS:
                    flush()
                continue
            if name in RAW:
                shut = re.compile(rf"</{name}[^>]*>?", re.I).search(html, at)
                at = shut.end() if shut else end
                continue
            if name == "br":
                parts.append(" ")
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                continue
            if name == "a":
                link += 1
                continue
            if name in BLOCKS:
                flush()
                link = 0
                if name in ("article", "main", "body") and drop_at >= 0:
                    close(drop_at)  # these can't stand inside furniture: its end tag is missing
                top = len(stack) - 1
                if top >= 0 and stack[top][0] == "p":
                    close(top)
                elif name in CLOSES and top >= 0 and stack[top][0] in CLOSES[name]:
                    close(top)
            if tag["attrs"].endswith("/") and name not in BLOCKS:
                continue
            attrs = {k.lower(): a or b or c or "" for k, a, b, c in ATTR.findall(tag["attrs"])} if "=" in tag["attrs"] else {}
            if drop_at < 0 and self._furniture(name, attrs, bool(open_now["article"] or open_now["main"] or open_now["section"])):
                flush()
                drop_at = len(stack)
                stack.append((name, -1))
                open_now[name] += 1
            elif name in CONTAINERS and drop_at < 0:
                kinds = ".".join(sorted({re.sub(r"\d+", "#", x) for x in attrs.get("class", "").lower().split()}))
                self.parents.append(inside[-1])
                self.steps.append(f"/{name}.{kinds}")
                digests.append(digests[-1].copy())
                digests[-1].update(self.steps[-1].encode("utf-8", "replace"))
                self.digests.append(digests[-1].intdigest())
                self.in_article.append(name == "article" or self.in_article[inside[-1]])
                self.in_main.append(name == "main" or self.in_main[inside[-1]])
                inside.append(len(self.parents) - 1)
                stack.append((name, inside[-1]))
                open_now[name] += 1
            elif name in BLOCKS or drop_at >= 0:
                stack.append((name, -1))
                open_now[name] += 1
        flush()

    @staticmethod
    def _furniture(name: str, attrs: dict[str, str], within: bool) -> bool:
        """within: the element stands in an article, main or section."""
        if name == "header" and within:
            return False  # it holds a title
        if name in DROPPED:
            return True
        if not attrs or name in HEADINGS or name in ("html", "body", "main"):
            return False
        classes = [c for c in attrs.get("class", "").lower().split() if not c.startswith(LAYOUT)]
        named = [set(WORDS.findall(x)) for x in (*classes, attrs.get("id", "").lower())]
        if name == "article":
            return any(x & {"comment", "comments", "reply"} for x in named)
        hidden = attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")
        return hidden or attrs.get("role", "").lower() in ROLES or any(x & FURNITURE or (x & DOUBTFUL and x <= DOUBTFUL | STANDING) for x in named)

    def best(self) -> int:
        """The container that the page votes for."""
        direct, total = [0] * len(self.parents), [0] * len(self.parents)
        for i, (c, text) in enumerate(self.blocks):
            if i not in self.links:
                direct[c] += len(text)
                total[c] += 0 if i in self.marks else len(text)
        below: list[list[int]] = [[] for _ in direct]
        for c in range(len(direct) - 1, 0, -1):
            total[self.parents[c]] += total[c]
            below[self.parents[c]].append(c)
        at = 0
        while below[at] and not direct[at]:
            most = max(below[at], key=lambda c: (total[c], -c))
            if total[most] < total[at] or total[most] == 0:
                break
            at = most
            if self.in_article[at] and not any(self.steps[c].startswith("/article.") for c in below[at]):
                break
        return at

    def text(self, wanted: set[int]) -> str:
        """Blocks below any of the containers."""
        inside = [False] * len(self.parents)
        for c in range(len(self.parents)):
            inside[c] = c in wanted or (c > 0 and inside[self.parents[c]])
        return "\n".join(t for c, t in self.blocks if inside[c])

    def extract(self, winning: list[tuple[str, bool]]) -> str:
        """The text below the first of the winning paths (path, wide) that the page has.

        One that holds less than SMALL percent of what a wide path behind it holds is
        passed over: the page is of that path's template.
        """
        at: dict[int, set[int]] = {}
        if winning:
            for c, d in enumerate(self.digests):
                at.setdefault(d, set()).add(c)
        found = [(text, wide) for path, wide in winning if (wanted := at.get(xxhash.xxh64_intdigest(path.encode("utf-8", "replace")))) and (text := self.text(wanted))]
        for i, (text, _) in enumerate(found):
            if not any(wide and 100 * len(text) < SMALL * len(more) for more, wide in found[i + 1 :]):
                return text
        return self.text({self.best()})


def host(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


OUT = [column("text", T.StringType()), column("n_chars", T.LongType())]


def winning_paths(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """(host, paths): each host's winning paths (path, wide), most votes first; wide ones have more than WINNING_PERCENT."""

    def vote(texts: list[bytes | None]) -> dict[str, list]:
        votes = []
        for data in texts:
            page = Page((data or b"").decode("utf-8"))
            votes.append(page.path(page.best()) if len(page.blocks) > len(page.links) else None)
        return {"path": votes}

    votes = map_text(pages.select(host(url).alias("host"), F.col(html).alias("html")), vote, [column("path", T.StringType())], "html", ["host"])
    counted = votes.filter("path is not null").groupBy("host", "path").agg(F.count("*").alias("n"))
    share = counted.withColumn("all", F.sum("n").over(Window.partitionBy("host"))).filter(f"100 * n >= {WINNING_PERCENT} * all")
    listed = share.groupBy("host").agg(F.collect_list(F.struct("n", "all", "path")).alias("w"))
    # A path ranks by the most votes of those it comes before, and is smaller than the paths inside it.
    covers = f"o.path = r.path or (100 * r.n > {WINNING_PERCENT} * r.all and startswith(o.path, concat(r.path, '/')))"
    ranked = F.expr(f"sort_array(transform(w, r -> struct(-array_max(transform(filter(w, o -> {covers}), o -> o.n)) as n, r.path as path, 100 * r.n > {WINNING_PERCENT} * r.all as wide)))")
    return listed.select("host", F.transform(ranked, lambda r: F.struct(r["path"].alias("path"), r["wide"].alias("wide"))).alias("paths"))


def extract(pages: DataFrame, html: str = "html", url: str = "url", broadcast_paths: int = BROADCAST_PATHS) -> DataFrame:
    """pages with text and n_chars."""
    winners = cut(winning_paths(pages, html, url))
    own, paths = unused(pages, "host"), unused(pages, "paths")
    hosts = winners.limit(broadcast_paths // 10 + 1).count()
    if hosts > broadcast_paths // 10:
        found = pages.withColumn(own, host(url)).join(winners.select(F.col("host").alias(own), F.col("paths").alias(paths)), own, "left")
        return _extract(found, html, paths).drop(own, paths)
    known = {r["host"]: [(p["path"], p["wide"]) for p in r["paths"]] for r in winners.collect()}
    shared = pages.sparkSession.sparkContext.broadcast(known)
    return _extract(pages.withColumn(own, host(url)), html, own, shared).drop(own)


def _extract(pages: DataFrame, html: str, key: str, shared=None) -> DataFrame:
    """key: a column of winning paths, or of hosts for which shared has them."""
    kept = [c for c in pages.columns if c.lower() not in {f.name for f in OUT}]
    schema = T.StructType([pages.schema[c] for c in kept] + OUT)
    columns = kept if html in kept else [*kept, html]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(columns.index(key)).to_pylist()
            texts = []
            for k, data in zip(keys, batch.column(columns.index(html)).to_pylist()):
                winning = [(w["path"], w["wide"]) for w in k or ()] if shared is None else shared.value.get(k, [])
                texts.append(Page(data).extract(winning) if data else "")
            cols = [batch.column(columns.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return pages.select(*[f"`{c}`" for c in columns]).mapInArrow(run, schema)
