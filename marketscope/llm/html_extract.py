"""Operator 10: main text of web pages by consensus host paths.

Pass 1 parses each page into blocks and scores its containers: the good text of a
container is the text of its blocks outside links and outside boilerplate
(menus, headers, footers, sidebars, notices, adverts, forms, comments). Boilerplate is told by
tag, by role, and by what a whole class or id name says: its last word that is more than
a part of a layout (``comment-content``: comment; ``search-policy``: policy). Words of several
meanings (``widget``), and a name's first word outside articles (``related-posts``), only count
where a container holds little text or mostly links. The page's article is the outermost article or main around the
deepest container that holds COVER of its good text, or the page if there is none. The page
votes for the deepest container that holds all good text of its article, by
generalised path: tags from the root, with class names whose digits are dropped.
Spark adds the votes per host and path.

Pass 2 extracts the blocks of the containers on the host's winning path (the highest
voted path that holds all good text of the page's article; its own container if none
does), boilerplate left out.

Scale: a vote is one small row per page, combined map-side per (host, path), so a host
with a third of all pages costs a few rows per task; per host TOP_PATHS paths are
kept, and written. They are joined to the pages by host: broadcast where their measured
size is under Spark's own limit, so that no page moves; else with every host dealt to SALT tasks.

Defined cases: null html counts as empty, an empty page has an empty text; pages
without a host vote among themselves; ties go to the smaller path; repeated rows each
vote and each get a result; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketscope.llm.common import written

COVER = 0.8
TOP_PATHS = 4

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?:svg|math)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*?/>"
    r"|<(script|style|noscript|template|iframe|object|svg|math|textarea|title|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|$)"
    r"|<[!?][^>]*>"
    r"|</?[A-Za-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.DOTALL | re.IGNORECASE)
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)

FOREIGN = frozenset(("svg", "math"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
                     "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}
DROPPED_TAGS = frozenset("head nav footer aside form button input dialog menu".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar footer foot copyright "
    "sidebar aside rail widget related recommended notice notices cookie cookies consent gdpr alert popup modal overlay "
    "form search login signup subscribe newsletter comment comments disqus respond replies share sharing social".split())
#: words that only say which part of a layout a name means
LAYOUT_WORDS = frozenset(
    "content contents text body wrapper wrap container area section block box inner outer holder panel group list items item row col "
    "column main title heading top bottom left right bar zone slot unit module component region field fields icon icons button buttons "
    "link links thread input count meta info primary secondary global site page".split())
#: first words that make what follows an extra, outside articles
EXTRA_WORDS = frozenset("related recommended sponsored sponsor promoted advert advertisement ad ads cookie newsletter share social footer "
                        "sidebar nav menu comment comments popup modal banner".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
#: words that also name parts of page builders and of articles: weighed by text and links like extras
SOFT_WORDS = frozenset("widget rail form banner alert overlay modal promo promotion share sharing social search login signup "
                       "head header masthead topbar popup".split())
HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: heads that within an article name its own title
TITLE_WORDS = frozenset(("header", "head", "masthead"))
EXTRA_CHARS = 400            # of text, beyond which an extra by its first word only must be mostly links
SALT = 32
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"[0-9]+")


class Page:
    """Blocks of text and the containers around them."""

    def __init__(self, html: str):
        # containers: parallel lists; the root is number 0
        self.path, self.parent, self.depth, self.tag, self.bad = [""], [-1], [0], [""], [False]
        self.blocks: list[tuple[int, str, int]] = []          # container, text, characters in links
        self.doubtful: set[int] = set()
        self._stack = [0]
        self._links, self._parts, self._linked = 0, [], 0
        at = 0
        for m in TOKEN.finditer(html):
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            tag = TAG.match(m[0])
            if tag is None or m[1]:
                continue
            name = tag[2].lower()
            if name in FOREIGN:                      # closed by itself: as empty as a skipped one
                continue
            if tag[1]:
                self._close(name)
            else:
                self._open(name, m[0])
        if at < len(html):
            self._text(html[at:])
        self._end_block()
        self._settle()

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self._parts.append(text)
        if self._links:
            self._linked += len("".join(text.split()))

    def _end_block(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                self.blocks.append((self._stack[-1], text, self._linked))
        self._parts, self._linked = [], 0

    def _open(self, name: str, markup: str) -> None:
        if name in INLINE:
            if name == "a":
                self._links += 1
            elif name == "br":
                self._parts.append(" ")
            return
        self._end_block()
        if name in CLOSES_P:
            self._pop("p", stop=("td", "th", "li", "button"))
        for other in SELF_CLOSING.get(name, ()):
            self._pop(other, stop=("ul", "ol", "dl", "table") if other != "tr" else ("table",))
        if name in VOID or markup.endswith("/>"):
            return
        top = self._stack[-1]
        attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(markup)}
        classes = [x for c in attributes.get("class", "").lower().split() if (x := DIGITS.sub("", c).strip("-_"))]
        self.path.append(self.path[top] + "/" + ".".join([name, *sorted(set(classes))]))
        self.parent.append(top)
        self.depth.append(self.depth[top] + 1)
        self.tag.append(name)
        self.bad.append(self.bad[top] or self._boilerplate(name, attributes, top))
        self._stack.append(len(self.path) - 1)

    def _boilerplate(self, name: str, attributes: dict[str, str], top: int) -> bool:
        if name in DROPPED_TAGS:
            return True
        if name == "header":           # a site's header; an article's own one holds its title
            return "article" not in [self.tag[i] for i in self._stack]
        if name in ("html", "body", "article", "main"):
            return False
        if attributes.get("role", "").lower() in DROPPED_ROLES:
            return True
        names = HUMPS.sub("-", f"{attributes.get('class', '')} {attributes.get('id', '')}").lower().split()
        in_article = "article" in [self.tag[i] for i in self._stack]
        for spelled in names:
            words = WORDS.findall(spelled)
            head = next((w for w in reversed(words) if w not in LAYOUT_WORDS), words[-1] if words else "")
            if in_article and head in TITLE_WORDS:
                continue
            if head in DROPPED_WORDS and head not in SOFT_WORDS:
                return True
            if head in SOFT_WORDS or words and words[0] in EXTRA_WORDS and not in_article:
                self.doubtful.add(len(self.path) - 1)
        return False

    def _settle(self) -> None:
        """Doubtful containers are boilerplate if they hold little text, or mostly links."""
        if not self.doubtful:
            return
        chars, linked = dict.fromkeys(self.doubtful, 0), dict.fromkeys(self.doubtful, 0)
        for c, text, links in self.blocks:
            while c >= 0:
                if c in chars:
                    chars[c] += len(text)
                    linked[c] += links
                c = self.parent[c]
        for c, n in chars.items():
            if n < EXTRA_CHARS or 2 * linked[c] > n:
                inside = self._inside(lambda i, c=c: i == c)
                self.bad = [a or b for a, b in zip(self.bad, inside)]

    def _close(self, name: str) -> None:
        if name in INLINE:
            if name == "a":
                self._links = max(0, self._links - 1)
            return
        self._end_block()
        self._pop(name, stop=())

    def _pop(self, name: str, stop: tuple[str, ...]) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            tag = self.tag[self._stack[i]]
            if tag == name:
                del self._stack[i:]
                self._links = 0 if name != "p" else self._links
                return
            if tag in stop:
                return

    def good(self) -> list[tuple[int, str]]:
        """Blocks outside boilerplate that are not mostly links."""
        return [(c, t) for c, t, linked in self.blocks if not self.bad[c] and 2 * linked <= len(t)]

    def core(self) -> set[int]:
        """Containers of the good text of the page's article.

        The article is the outermost article or main around the deepest container that
        holds COVER of the good text; without one all good text belongs to it.
        """
        held: dict[int, int] = {}
        good = self.good()
        for c, text in good:
            while c >= 0:
                held[c] = held.get(c, 0) + len(text)
                c = self.parent[c]
        if not good:
            return set()
        enough = [c for c, n in held.items() if n >= COVER * held[0]]
        c, scope = max(enough, key=lambda x: self.depth[x]), 0
        while c > 0:
            if self.tag[c] in ("article", "main"):
                scope = c
            c = self.parent[c]
        inside = self._inside(lambda i: i == scope)
        return {c for c, _ in good if inside[c]}

    def _inside(self, chosen: Callable[[int], bool]) -> list[bool]:
        """Which containers are chosen or lie in a chosen one."""
        out = [False] * len(self.path)
        for i in range(len(out)):
            out[i] = chosen(i) or (i > 0 and out[self.parent[i]])
        return out

    def best(self) -> str:
        """Path of the deepest container that holds all good text of the article; empty if there is none."""
        core = self.core()
        if not core:
            return ""
        c = core.pop()
        for other in core:
            while c != other:                        # climb to the common ancestor
                if self.depth[other] > self.depth[c]:
                    other = self.parent[other]
                else:
                    c = self.parent[c]
        while c > 0 and self.tag[c] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "li", "td", "blockquote"):
            c = self.parent[c]                       # a block is no container
        return self.path[c]

    def text(self, paths: list[str]) -> str:
        """Blocks, in page order, inside the containers on the first of ``paths`` that hold all good text of the article."""
        core = self.core()
        for path in paths:
            chosen = self._inside(lambda i: self.path[i] == path)
            blocks = [t for c, t, _ in self.blocks if chosen[c] and not self.bad[c]]
            if blocks and all(chosen[c] for c in core):
                return "\n".join(blocks)
        return ""


def page_vote_udf():
    @pandas_udf("string")
    def page_vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([Page(h).best() for h in pages.tolist()], dtype=object)
    return page_vote


def page_text_udf():
    @pandas_udf("string")
    def page_text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for pages, paths in batches:
            out = []
            for html, host_paths in zip(pages.tolist(), paths.tolist()):
                page = Page(html)
                text = page.text(list(host_paths) if host_paths is not None else [])
                out.append(text or page.text([page.best()]))
            yield pd.Series(out, dtype=object)
    return page_text


def host_of(url: str = "url"):
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def host_paths(pages: DataFrame, top: int = TOP_PATHS) -> DataFrame:
    """(host, paths): each host's most voted container paths, best first."""
    src = pages.select(host_of().alias("host"), page_vote_udf()(F.coalesce("html", F.lit(""))).alias("path"))
    votes = src.where("path <> ''").groupBy("host", "path").agg(F.count("*").alias("votes"))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    best = votes.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("r")).select(
        "host", F.col("r.path").alias("paths"))


def threshold_bytes(df: DataFrame) -> int:
    """Spark's own limit for broadcasts, in bytes (0: none)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return max(0, int(text.rstrip("kmg")) * unit)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per input row."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"),
                       host_of().alias("host"))
    paths = written(host_paths(pages), "host-paths")
    size = paths.agg(F.sum(F.length("host") + 16 + F.aggregate("paths", F.lit(0), lambda a, p: a + F.length(p) + 16)).cast("long")).first()[0] or 0
    # length in characters: at most four bytes each
    if 4 * size <= threshold_bytes(pages):
        joined = src.join(F.broadcast(paths), "host", "left")
    else:
        salted = paths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = src.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALT)).cast("int")).join(salted, ["host", "salt"], "left")
    return (joined.select("page_id", "url", page_text_udf()("html", "paths").alias("text"))
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")))
