"""Main text of web pages by consensus host paths.

Each page is parsed to containers and text blocks. Menus, adverts, forms and the like are
set aside by their tags and roles, and by class names that say nothing else (`ad-box`, `sidebar`).
A name with other words in it (`header-text`, `form-of-government`) only counts against a container
that lacks prose of its own. The page's best container is found by descending from the body as
long as what a step leaves behind is next to nothing beside the rest; that container's path of tags and
classes, with numbers generalised, is the page's vote, and containers with text beside it are
voted down. Spark counts the votes by host, and each page is extracted again from the containers on
the best-voted path of its host that holds nearly all of the page's own choice but for what the host
votes down; a page without any keeps its own choice, so a host may have several templates.

Edge cases: null and empty html give an empty text; a null url or one without host votes
in a group of its own. Unclosed tags, comments and scripts end where browsers end them or
at the end of the page. Repeated rows are extracted one by one, whatever their length; an
empty table gives an empty table; input columns other than id, url and html aren't read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haatlake.llm.common import stage, text_blocks
from haatlake.sources.staging import bounded

# Kinds of elements of HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "th", "tr", "table", "tbody", "thead", "tfoot", "center",
              "header", "footer", "nav", "aside", "form", "ul", "ol", "dl", "figure", "fieldset", "details", "dialog", "menu",
              "blockquote", "head", "template", "svg", "select", "button", "object", "audio", "video", "canvas", "math", "map"}
BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "hr", "br", "address", "figcaption", "summary",
          "caption", "legend", "option", "optgroup", "hgroup"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
DROPPED = {"head", "nav", "footer", "aside", "form", "template", "svg", "select", "button", "dialog", "menu", "object", "audio",
           "video", "canvas", "map", "header"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}
# Words of class names and ids that mark what isn't the article.
REMARKS = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "reply", "discussion", "responses"}
ASIDE = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "sponsors", "promo",
         "promoted", "promotion", "related", "recommended", "recommendations", "teaser", "teasers", "outbrain", "taboola"} | REMARKS
OUTSIDE = ASIDE | {"nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar",
                   "sidebar", "sidebars", "widget", "widgets", "rail", "footer", "foot", "header", "masthead", "topbar", "copyright", "cookie",
                   "cookies", "consent", "gdpr", "notice", "notices", "notification", "banner", "alert", "popup", "modal", "overlay",
                   "paywall", "newsletter", "subscribe", "subscription", "signup", "login", "search", "form", "share", "sharing",
                   "social", "skip", "hidden", "legal", "disclaimer"}
# Words that may stand beside one of these in a name without changing what it says.
PLAIN = {"top", "bottom", "left", "right", "upper", "lower", "inner", "outer", "main", "site", "page", "global", "local", "primary", "secondary", "mobile", "desktop",
         "box", "block", "bar", "panel", "module", "unit", "slot", "area", "zone", "section", "container", "wrapper", "wrap", "holder", "list", "item", "items", "links",
         "link", "row", "col", "column", "inline", "sticky", "fixed", "small", "large", "big", "first", "last", "new", "view", "region", "group", "js", "is", "the", "my"}
# Words before one of these that say it is elsewhere: with-sidebar, has-comments.
ABOUT = {"with", "has", "no", "without", "is", "not", "below", "before", "after"}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<!--|<[!?/][^>]*>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
NUMBER = re.compile(r"\d+")
COMMENT_END = re.compile(r"--!?>")
# A child with this share of the text is descended into, or one beside which no block has so many characters of prose.
MOST, REMARK = 0.9, 40
# A voted path must hold this share of what the page's own choice holds.
LEAST = 0.8
# Outside an article, a container with a doubtful name must hold this share of the page's prose.
SHARE = 0.25
# Paths of a host that pages may follow: all with more than one vote in a hundred.
PATHS = 99


class Page:
    """Containers (parent, path, tag, dropped) and blocks (container, heading level, text, characters in links)."""

    def __init__(self, source: str):
        self.parent, self.path, self.tag, self.dropped, self.doubtful = [-1], [""], ["#"], [False], [False]
        self.blocks: list[tuple[int, str, str, int]] = []
        self._parse(source)
        self._settle()

    def _parse(self, source: str) -> None:
        here, block, link, in_link = 0, "", 0, 0
        text: list[str] = []
        at = 0

        def flush() -> None:
            nonlocal link, text
            if text:
                words = " ".join(html.unescape("".join(text)).split())
                if words:
                    self.blocks.append((here, block, words, min(link, len(words))))
            text, link = [], 0

        def said(piece: str) -> None:
            nonlocal link
            if piece:
                text.append(piece)
                if in_link:
                    link += len(piece)

        while m := TAG.search(source, at):
            said(source[at : m.start()])
            at = m.end()
            if m[0] == "<!--":
                end = COMMENT_END.search(source, at)
                at = end.end() if end else len(source)
                continue
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing, attributes = m[1] or m[4], m[3] if m[2] else m[6]
            if name in RAW and not closing:
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
                at = (source.find(">", end.start()) + 1 or len(source)) if end else len(source)
            elif name in CONTAINERS:
                flush()
                block = ""
                if not closing:
                    here = self._open(here, name, attributes) if not attributes.endswith("/") or name not in ("svg", "math") else here
                else:
                    k = here
                    while k > 0 and self.tag[k] != name:
                        k = self.parent[k]
                    here = self.parent[k] if k > 0 else here
            elif name in BLOCKS:
                flush()
                block = "" if closing or name in VOID else name
            elif name == "a":
                in_link = 0 if closing else 1
        said(source[at:])
        flush()

    def _open(self, here: int, name: str, attributes: str) -> int:
        if name in ("html", "body") and name in self.tag:
            return here
        if name == "body":  # ends an open head
            while self.tag[here] == "head":
                here = self.parent[here]
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        classes = found.get("class", "").split()
        step = name + "".join(f".{c}" for c in sorted({NUMBER.sub("N", c) for c in classes}))
        self.parent.append(here)
        self.tag.append(name)
        self.path.append(f"{self.path[here]}/{step}")
        said = self._boilerplate(name, classes + [found.get("id", "")], found)
        self.dropped.append(said == "dropped")
        self.doubtful.append(said == "doubtful")
        return len(self.tag) - 1

    @staticmethod
    def _boilerplate(name: str, names: list[str], found: dict[str, str]) -> str | None:
        """Whether tag, role and names say that a container isn't part of the article: dropped, or doubtful."""
        if name in ("html", "body", "main"):
            return None
        if name in DROPPED or found.get("role", "").lower() in ROLES or found.get("aria-hidden") == "true" or "hidden" in found:
            return "dropped"
        marks, said = ASIDE if name == "article" else OUTSIDE, None
        for words in ([w.lower() for w in WORD.findall(n)] for n in names):
            if any(w in marks and not (k and words[k - 1] in ABOUT) for k, w in enumerate(words)):
                if all(w in marks or w in PLAIN or w.isdigit() for w in words):
                    return "dropped"
                said = "doubtful"
        return said

    def _settle(self) -> None:
        """What holds an article or main isn't dropped for its class; what lies in something dropped is."""
        self._weigh_doubtful()
        self.inside = [False] * len(self.tag)
        holds = [False] * len(self.tag)
        for k in range(len(self.tag) - 1, 0, -1):
            if holds[k] or self.tag[k] in ("article", "main") and not self.dropped[k]:
                holds[self.parent[k]] = True
        for k in range(1, len(self.tag)):
            up = self.parent[k]
            self.inside[k] = self.inside[up] or self.tag[k] in ("article", "main")
            own = self.dropped[k] and not (holds[k] and self.tag[k] in ("div", "section", "form", "header", "table", "td"))
            self.dropped[k] = own or self.dropped[up]
        self.title = set()  # headings in an article's own header
        for i, (k, block, _, _) in enumerate(self.blocks):
            if block in HEADINGS and self.dropped[k] and self.tag[k] == "header" and self.inside[k] and not self.dropped[self.parent[k]]:
                self.title.add(i)

    def _weigh_doubtful(self) -> None:
        """A container with a doubtful name goes if links are half of its text, or if it lies outside an article and has little of the page's prose."""
        if not any(self.doubtful):
            return
        prose, links = [0] * len(self.tag), [0] * len(self.tag)
        for k, _, words, link in self.blocks:
            while k >= 0:
                prose[k] += len(words) - link
                links[k] += link
                k = self.parent[k]
        for k in range(1, len(self.tag)):
            if self.doubtful[k]:
                up = k
                while up > 0 and self.tag[up] not in ("article", "main"):
                    up = self.parent[up]
                self.dropped[k] = links[k] >= prose[k] or up <= 0 and prose[k] < SHARE * prose[0]

    def kept(self) -> list[tuple[int, str, str, int]]:
        return [b for i, b in enumerate(self.blocks) if not self.dropped[b[0]] or i in self.title]

    def best(self) -> int:
        """The container to vote for."""
        n = len(self.tag)
        weight, heading, only = [0.0] * n, [0] * n, self.kept()
        for k, block, words, link in only:
            worth = max(0, len(words) - 2 * link)
            while k >= 0:
                weight[k] += worth
                heading[k] += block == "h1"
                k = self.parent[k]
        children: dict[int, list[int]] = {}
        for k in range(1, n):
            children.setdefault(self.parent[k], []).append(k)
        here = 0
        while self.tag[here] != "article":
            inner = max((k for k in children.get(here, ()) if not self.dropped[k] and self.tag[k] not in ("ul", "ol", "dl", "blockquote", "figure", "table", "tr", "tbody")), key=lambda k: (weight[k], -k), default=None)
            if inner is None or not weight[inner] or heading[here] > heading[inner] and self.tag[here] not in ("#", "html", "body"):
                break
            if weight[inner] < MOST * weight[here] and self._leaves_prose(only, here, inner):
                break
            here = inner
        return here

    def _leaves_prose(self, only: list[tuple[int, str, str, int]], here: int, inner: int) -> bool:
        """Whether a block below here, but not below inner, is more than a remark."""
        for k, _, words, link in only:
            if len(words) - 2 * link > REMARK:
                while k > here and k != inner:
                    k = self.parent[k]
                if k == here:
                    return True
        return False

    def texts(self, chosen: set[int], but: set[int] = frozenset()) -> list[str]:
        """Blocks in or below the chosen containers, but not in or below others, in page order."""
        below = [False] * len(self.tag)
        for k in range(len(self.tag)):
            below[k] = k not in but and (k in chosen or k > 0 and below[self.parent[k]])
        return [words for k, _, words, _ in self.kept() if below[k]]

    def beside(self, chosen: int) -> set[str]:
        """Paths of the containers with text that lie beside the chosen one or beside one around it."""
        filled = {0}
        for k, _, _, _ in self.kept():
            while k not in filled:
                filled.add(k)
                k = self.parent[k]
        around, inmost = {chosen}, chosen
        while chosen > 0:
            chosen = self.parent[chosen]
            around.add(chosen)
        return {self.path[k] for k in filled - around if self.parent[k] in around and self.parent[k] != inmost}

    def extract(self, ranked: list[str], down: list[str] = ()) -> str:
        """The text below the best of the ranked paths that holds the page's own choice but for what is voted down, else below that choice."""
        choice = self.best()
        own = self.texts({choice})
        for path in ranked:
            on = {k for k, p in enumerate(self.path) if p == path and not self.dropped[k]}
            if not on:
                continue
            got, beside = self.texts(on), {k for k, p in enumerate(self.path) if p in down and not path.startswith(p)}
            if sum(map(len, got)) >= max(1, LEAST * sum(map(len, self.texts({choice}, beside)))):
                return " ".join(got)
        return " ".join(own)


def _named(pages: DataFrame, page_id: str, url: str, source: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(pages[url], F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[source].alias("html"), host.alias("host"))


def votes(named: DataFrame) -> DataFrame:
    """Votes of pages for container paths and against those beside them: host, path, votes, downs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sources in text_blocks(batches, "html"):
            found: Counter = Counter()
            for host, source in zip(batch.column("host").to_pylist(), sources):
                if source:
                    page = Page(source)
                    choice = page.best()
                    if page.path[choice]:
                        found[host, page.path[choice], True] += 1
                        found.update((host, path, False) for path in page.beside(choice))
            if found:
                host, path, up = zip(*found)
                n = np.fromiter(found.values(), np.int64, len(found))
                up = np.array(up)
                yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(n * up), pa.array(n * ~up)], ["host", "path", "votes", "downs"])

    cast = named.select("host", "html").mapInArrow(run, "host string, path string, votes long, downs long")
    return cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("downs").alias("downs"))


def _ranked(cast: DataFrame) -> DataFrame:
    """host, paths: those with more than one vote in a hundred, best first; and down: those voted down by more than vote for them.

    They are among a host's first PATHS ones of either kind, and each task passes on no more of a host, however many paths it has.
    """
    first = lambda by: Window.partitionBy("host").orderBy(F.desc(by), "path")
    up = cast.where("votes > 0").withColumn("rank", F.row_number().over(first("votes"))).where(F.col("rank") <= PATHS)
    down = cast.where("downs > votes").withColumn("rank", F.row_number().over(first("downs"))).where(F.col("rank") <= PATHS)
    all_votes = cast.groupBy("host").agg(F.sum("votes").alias("all"))
    both = up.select("host", "path", "rank", F.col("votes").alias("n"), F.lit(True).alias("up")).unionByName(
        down.select("host", "path", "rank", F.col("downs").alias("n"), F.lit(False).alias("up")))
    listed = lambda up: F.transform(F.array_sort(F.collect_list(F.when(F.col("up") == up, F.struct("rank", "path")))), lambda x: x["path"])
    return both.join(all_votes, "host").where("n * 100 > all").groupBy("host").agg(listed(True).alias("paths"), listed(False).alias("down"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    named = _named(pages, page_id, url, source)
    ranked = stage(_ranked(stage(votes(named), "votes")), "paths")
    joined = named.join(bounded(ranked), "host", "left")
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sources in text_blocks(batches, "html"):
            paths, down = batch.column("paths").to_pylist(), batch.column("down").to_pylist()
            texts = [Page(s).extract(p or [], d or []) if s else "" for s, p, d in zip(sources, paths, down)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "paths", "down").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
