"""Main text of web pages by consensus host paths.

Each page is cut in blocks of text below a tree of elements. Containers are scored by the text of their
blocks that is not in links, a parent getting half of what a child has. A page votes for the paths of its good
containers, as tags and classes without digits; votes are summed per host in Spark. A page is then read
again with the best paths of its host: the first of them that has text on the page gives the core of the article, or
else the page's own best container. Around the core, the whole enclosing article or main element belongs to it, and
further out what is beside it and not mostly links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quadrille.llm.url_filter import host_of
from quadrille.session import stage

#: Paths that a host keeps, and the share of the best path's votes that each must have.
PATHS, LEAST_VOTES = 8, 0.05
#: The share of the best container's score from which a container gets a vote.
LEAST_SCORE = 0.5

TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element kinds of HTML.
RAW = frozenset("script style textarea title xmp noscript template iframe noembed noframes svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th tr tbody thead dd dt figcaption figure ul ol dl table".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
          "th": ("tr", "table"), "option": ("select",)}
# What marks other parts of a page than its article.
NOT_ARTICLE = frozenset(
    "nav footer aside form button select input dialog menu menuitem fieldset object applet audio video canvas map head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion promoted "
    "banner sidebar sidenav menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie "
    "cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations comment comments commentlist respond reply "
    "replies disqus discussion widget widgets toolbar pagination pager copyright skip hidden".split())
GOOD_NAMES = frozenset("article content main post entry story body text".split())
#: Words after which a name tells of a state, and heads of a name whose first word says what is in them.
STATES = frozenset("no non not without with has have is hide show overflow".split())
BOXES = frozenset(
    "area author avatar bar block body bottom box btn button buttons card container count field footer form group header "
    "heading holder icon icons inner item items label left link links list meta panel placeholder post posts region "
    "right row section slot stories tab tabs thread title toggle top unit wrap wrapper zone".split())


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def _names(attributes: dict[str, str]) -> set[str]:
    both = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    return {w.lower() for w in NAME_WORD.findall(both)}


def _hidden(attributes: dict[str, str]) -> bool:
    return bool("hidden" in attributes or attributes.get("aria-hidden") == "true"
                or re.search(r"display\s*:\s*none", attributes.get("style", "")))


def _marks(attributes: dict[str, str]) -> set[str]:
    """The names of other parts than the article among whole classes and ids, their heads, or the firsts of boxes."""
    found = set()
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in NAME_WORD.findall(token)]
        if not words or STATES.intersection(words[:-1]):
            continue
        first, head = words[0], words[-1]
        if len(words) == 1 or head in NAMES and head != "hidden" and not (head == "header" and first in GOOD_NAMES):
            found.add(head)
        elif head in BOXES and first not in ("header", "hidden"):
            found.add(first)
    return found & NAMES


class Page:
    """The blocks of a page and the elements they stand in."""

    def __init__(self, html: str) -> None:
        self.mutes = True
        self._reset()
        self._read(html)
        if self.muted_chars > sum(len(text) for _, text, _ in self.blocks):
            # Most of the text would be lost by names of inline elements: they do not tell of adverts here.
            self._reset()
            self.mutes = False
            self._read(html)
        self._drop_marked()

    def _reset(self) -> None:
        self.parent, self.tag, self.label, self.drop, self.weight = [-1], ["#"], [""], [False], [1.0]
        self.in_article, self.marked = [False], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self.muted_chars = 0

    def _add(self, parent: int, tag: str, attributes: dict[str, str]) -> int:
        names = _names(attributes) if attributes else set()
        within = self.in_article[parent]
        out = tag in NOT_ARTICLE or tag == "header" and not within or attributes.get("role", "").lower() in ROLES
        named = _marks(attributes) if names & NAMES else set()
        if tag in ("html", "body") or within and named <= {"header"}:
            named = set()
        self.parent.append(parent)
        self.tag.append(tag)
        classes = sorted({re.sub(r"\d+", "", c) for c in attributes.get("class", "").split()} - {""})
        self.label.append(".".join([tag, *classes]))
        self.drop.append(bool(self.drop[parent] or out or _hidden(attributes)))
        self.marked.append(bool(named))
        self.weight.append(1.5 if tag in ("article", "main") else 1.2 if names & GOOD_NAMES else 1.0)
        self.in_article.append(within or tag in ("article", "main"))
        return len(self.parent) - 1

    def _read(self, html: str) -> None:
        stack, pieces = [0], []
        link = link_chars = at = muted = 0
        mute, named = "", False

        def flush() -> None:
            nonlocal link_chars, muted
            if pieces:
                text = " ".join(unescape("".join(pieces)).split())
                if text:
                    self.blocks.append((stack[-1], text, link_chars))
                pieces.clear()
            link_chars = muted = 0

        def close(tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
            for k in range(len(stack) - 1, 0, -1):
                if self.tag[stack[k]] in tags:
                    flush()
                    del stack[k:]
                    return
                if self.tag[stack[k]] in scope:
                    return

        match = TAG.search(html)
        while match:
            if match.start() > at and muted:
                self.muted_chars += named * (match.start() - at)
            elif match.start() > at:
                piece = html[at : match.start()]
                pieces.append(piece)
                if link:
                    link_chars += len(piece)
            at = match.end()
            tag = match[2]
            if tag is not None:
                tag = tag.lower()
                if muted and tag == mute:
                    # An inline advert or the like ends with its own tag, or with the block at the latest.
                    muted += -1 if match[1] else 1
                elif match[1]:
                    if tag == "a":
                        link = 0
                    if tag not in INLINE:
                        if tag == "p":
                            flush()
                        close((tag,), ("table",) if tag in PARAGRAPHS and tag != "table" else ())
                elif tag in ("svg", "math") and match[3].endswith("/"):
                    pass
                elif tag in RAW:
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                    # A drawing or formula that is left open holds nothing but its own elements.
                    at = end.end() if end else at if tag in ("svg", "math") else len(html)
                elif tag in VOID:
                    if tag == "hr":
                        flush()
                    pieces.append(" ")
                else:
                    attributes = _attributes(match[3]) if match[3].strip() else {}
                    if tag in INLINE:
                        if tag == "a":
                            link = 1
                        if attributes and not muted:
                            named = not _hidden(attributes)
                            if not named or self.mutes and _marks(attributes):
                                mute, muted = tag, 1
                    else:
                        if tag not in ("option", "optgroup"):
                            close(("p",), ("td", "th", "table", "button", "object"))
                        if tag in CLOSES:
                            close(CLOSES[tag], SCOPES[tag])
                        if tag == "body":
                            close(("head",), ())
                        flush()
                        if not match[3].endswith("/"):
                            stack.append(self._add(stack[-1], tag, attributes))
            match = TAG.search(html, at)
        tail = html[at:]
        if tail and "<" in tail:
            tail = tail[: tail.index("<")] if re.search(r"<[a-zA-Z/!?]", tail) else tail
        if tail and not muted:
            pieces.append(tail)
        flush()

    def _drop_marked(self) -> None:
        """Drops what is below a marked name, unless that is the article or most of the text of the page."""
        if not any(self.marked):
            return
        n = len(self.parent)
        chars, articles = [0] * n, [0] * n
        for element, text, _ in self.blocks:
            if not self.drop[element]:
                chars[element] += len(text)
        for e in range(n - 1, 0, -1):
            # An article of a comment, as its name tells, is none of the page.
            articles[e] += self.tag[e] in ("article", "main") and not self.marked[e] and not self.drop[e]
            chars[self.parent[e]] += chars[e]
            articles[self.parent[e]] += articles[e]
        for e in range(1, n):
            # Comments may be longer than the article that they stand beside.
            most = not articles[0] and 2 * chars[e] > chars[0]
            named = self.marked[e] and self.tag[e] not in ("article", "main") and not articles[e] and not most
            self.drop[e] = self.drop[e] or self.drop[self.parent[e]] or named

    def scores(self) -> dict[int, float]:
        """The score of each container that has text."""
        out: dict[int, float] = {}
        for element, text, link_chars in self.blocks:
            worth = len(text) - 2 * link_chars
            if worth <= 0 or self.drop[element]:
                continue
            e, share = element, 1.0
            while e > 0 and self.tag[e] in PARAGRAPHS:
                e = self.parent[e]
            while e >= 0 and share > 0.1:
                out[e] = out.get(e, 0.0) + share * worth * self.weight[e]
                e, share = self.parent[e], share / 2
        return out

    def path(self, element: int) -> str:
        labels = []
        while element > 0:
            if self.tag[element] != "html":
                labels.append(self.label[element])
            element = self.parent[element]
        return ">".join(reversed(labels))

    def text(self, paths: list[str]) -> str:
        """The blocks below the first of the paths that has any, or below the best container."""
        scores = self.scores()
        if not scores:
            return ""
        named = {e: self.path(e) for e in range(len(self.parent))} if paths else {}
        chosen: set[int] = set()
        for path in paths:
            chosen = {e for e, p in named.items() if p == path and scores.get(e)}
            if chosen:
                break
        if not chosen:
            chosen = {max(scores, key=lambda e: (scores[e], -e))}
        whole, around = self._article(chosen)
        out = []
        for element, text, link_chars in self.blocks:
            if self.drop[element]:
                continue
            e = element
            while e >= 0 and e not in whole:
                e = self.parent[e]
            if e >= 0 or element in around and 2 * link_chars <= len(text):
                out.append(text)
        return "\n".join(out)

    def _article(self, chosen: set[int]) -> tuple[set[int], set[int]]:
        """Elements that belong to the article of these containers as a whole, and those around them."""
        whole, around = set(), set()
        for e in chosen:
            above = [e]
            while self.parent[above[-1]] >= 0:
                above.append(self.parent[above[-1]])
            marks = [k for tag in ("main", "article") for k, a in enumerate(above) if self.tag[a] == tag]
            top = marks[-1] if marks else 0
            whole.add(above[top])
            around.update(above[top + 1 :])
        if not around:
            return whole, around
        chars, links, titles = ([0] * len(self.parent) for _ in range(3))
        for element, text, link_chars in self.blocks:
            if not self.drop[element]:
                title, e = False, element
                while e >= 0 and e not in around:
                    title = title or self.tag[e] == "h1"
                    chars[e] += len(text)
                    # The headline of an article is often a link to it.
                    links[e] += 0 if title else link_chars
                    titles[e] += title
                    e = self.parent[e]
        for e, parent in enumerate(self.parent):
            if parent in around and e not in around and chars[e] and 2 * links[e] <= chars[e]:
                # Containers below the body are parts of the page, which need a sign that they are of the article.
                if self.tag[parent] not in ("body", "html", "#") or self.tag[e] in PARAGRAPHS or self.weight[e] > 1 or titles[e]:
                    whole.add(e)
        return whole, around


def page_votes(html: str) -> list[dict]:
    """A vote from 0.5 to 1 for the path of each container that is about as good as the best one."""
    page = Page(html)
    scores = page.scores()
    best = max(scores.values(), default=0.0)
    votes: dict[str, float] = {}
    for element, score in scores.items():
        if score >= LEAST_SCORE * best:
            path = page.path(element)
            votes[path] = max(votes.get(path, 0.0), score / best)
    return [{"path": p, "vote": v} for p, v in votes.items()]


def _votes(html: str):
    @pandas_udf("array<struct<path:string,vote:double>>")
    def votes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in parts:
            yield pd.Series([page_votes(h or "") for h in htmls])

    return votes(html)


def _text(html: str, paths: str):
    @pandas_udf("string")
    def text(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, winners in parts:
            yield pd.Series([Page(h or "").text(list(w) if w is not None else []) for h, w in zip(htmls, winners)])

    return text(html, paths)


def host_paths(pages: DataFrame) -> DataFrame:
    """``host, paths``: the paths that the pages of a host vote for, best first."""
    votes = (
        pages.where(F.length("host") > 0).select("host", F.explode(_votes("html")).alias("v"))
        .groupBy("host", "v.path").agg(F.sum("v.vote").alias("votes"))
    )
    # The window runs over the distinct paths of a host, not its pages.
    best = Window.partitionBy("host")
    ranked = votes.withColumns({"top": F.max("votes").over(best),
                                "rank": F.row_number().over(best.orderBy(F.desc("votes"), "path"))})
    return ranked.where((F.col("rank") <= PATHS) & (F.col("votes") >= LEAST_VOTES * F.col("top"))).groupBy("host").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths"))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page.

    ``pages`` has ``page_id, url, html``. Blocks of the article are joined by a line feed, white space inside a
    block is one space, character references are decoded. A NULL or empty page, or one without an
    article, has an empty text. Pages without a host (a NULL URL or one without ``://``) use their own best
    container. Repeated rows vote each, and are read alike. Other columns are ignored. An empty table gives
    an empty result.
    """
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"),
                        host_of(F.coalesce("url", F.lit(""))).alias("host"))
    paths = stage(host_paths(rows), "host-paths")
    found = rows.join(paths, "host", "left").select("page_id", "url", F.coalesce(_text("html", "paths"), F.lit("")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
