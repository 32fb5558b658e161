"""The main text of web pages by composite text density (Sun, Song and Liao, 2011).

For every node of the page: its characters per tag, raised or lowered by how much of both is links
(the composite density), and the sum of its children's densities. The node with the largest sum holds the
article. The smallest density on the path from the body to it is the threshold: as long as what a
parent holds besides the node is at least as dense, the parent is taken instead.

The choice is over all nodes; an <article> or <main> counts double. A node inside an <article> stands for all
of that article, and articles beside it that reach the threshold belong to the text too.

What names itself as something else (menus, footers, adverts, forms, comments, ...) is left out before densities
are computed. Tags and roles decide at once. A class or id decides by its whole names, and not for an element that
holds half of the page's text; names that articles have for their own parts need a share of links besides. Comments
may be longer than the story: they stay only if next to no plain text is left without them.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import e, log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hetgraph.llm.common import arrow_map

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|template|textarea|title|iframe|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header html hr legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of an article, and those that end an open paragraph.
OUTSIDE = frozenset("nav footer aside form button select option input label dialog menu canvas audio video applet head".split())
#: An end tag of one of these also ends what was left open inside; others end at most at the next of these.
SAME_LEVEL = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Names in class and id that say what an element is, and roles.
HINTS = frozenset(
    "ad ads adsense advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar header footer cookie cookies consent gdpr popup modal "
    "newsletter comment comments commentlist disqus pagination pager masthead topbar".split()
)
COMMENTS = frozenset("comment comments commentlist disqus".split())
#: Those that stand as well on parts of an article: they count where at least LINKED of the text is links.
SOFT = frozenset(
    "notice notices alert overlay subscribe signup login share sharing social related recommended discussion respond replies "
    "widget toolbar copyright skip".split()
)
LINKED = 0.3
#: So many times the plain text of the rest of the page may comments have.
LONGER = 20
#: Words that say where or in what form; with a hint they still make a hint of the whole name.
NEUTRAL = frozenset("area bar block bottom box container inner left links list main outer primary right secondary section site slot text top unit wrap wrapper".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
SECTIONS = frozenset(("article", "main"))
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What the sum of an <article> or <main> counts, and the part of an article's density that text around it needs.
MARK, BESIDE = 2, 0.5


def _hint(value: str) -> int:
    """3 if one of the names says comments, 2 if it is another hint, 1 if it is one that needs links, else 0."""
    found = 0
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", name) if w and w not in NEUTRAL]
        if words and all(w in HINTS or w in SOFT for w in words):
            found = max(found, 3 if COMMENTS.intersection(words) else 2 if HINTS.intersection(words) else 1)
    return found


def _outside(tag: str, rest: str, in_article: bool) -> int:
    """4 for what is never part of an article, 3 to 1 for what its names say (see ``_hint``), else 0."""
    if tag in OUTSIDE or (tag == "header" and not in_article):
        return 4
    if not rest or tag in ("html", "body"):
        return 0
    found = 0
    for name, value in _NAMED.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            if tag in SECTIONS:
                value = " ".join({"comment", "comments"}.intersection(value.split()))
            elif in_article:
                value = " ".join(x for x in value.split() if "header" not in x)
            found = max(found, _hint(value))
        elif name == "role" and value in ROLES:
            return 4
        elif name == "hidden" and not value or name == "aria-hidden" and value == "true":
            return 4
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return 4
    return found


def _tokens(source: str) -> Iterator[re.Match]:
    """Tags and comments in page order. Behind the last ``>`` no tag can end: only an open comment is looked for."""
    at, last = 0, source.rfind(">")
    while (at := source.find("<", at)) >= 0:
        if at > last and (at := source.find("<!--", at)) < 0:
            return
        if m := _TOKEN.match(source, at):
            yield m
        at = m.end() if m else at + 1


class _Page:
    """Nodes in page order, each with its parent; texts with the node they stand in."""

    def __init__(self, source: str):
        self.tags, self.parents = ["#root"], [-1]
        self.texts: list[tuple[int, str]] = []
        self.hinted: dict[int, int] = {}
        stack, skip, at, articles = [0], 0, 0, 0
        open_tags: Counter[str] = Counter()

        def close(upto: int):
            nonlocal skip, articles
            while len(stack) > upto:
                node = stack.pop()
                open_tags[self.tags[node]] -= 1
                articles -= self.tags[node] in SECTIONS
                if skip and len(stack) < skip:
                    skip = 0

        for m in _tokens(source):
            if m.start() > at and not skip:
                self.texts.append((stack[-1], source[at : m.start()]))
            at = m.end()
            tag = m["tag"]
            if not tag:
                continue
            tag = tag.lower()
            if m["end"]:
                # Unknown end tags are ignored; an inline one does not end a block around it.
                for k in range(len(stack) - 1, 0, -1) if open_tags[tag] > 0 else ():
                    name = self.tags[stack[k]]
                    if name == tag:
                        close(k)
                        break
                    if name in BLOCK and tag not in BLOCK:
                        break
                continue
            if tag in BLOCK:
                self._end_implied(tag, stack, close)
            if tag in VOID:
                if not skip:
                    self.texts.append((stack[-1], " "))
                if tag == "hr" or not skip and tag != "br":
                    self._add(tag, stack[-1])
                continue
            node = self._add(tag, stack[-1])
            if not skip and (kind := _outside(tag, m["rest"], articles > 0)):
                if kind == 4:
                    skip = len(stack) + 1
                else:
                    self.hinted[node] = kind
            stack.append(node)
            open_tags[tag] += 1
            articles += tag in SECTIONS
            if m["rest"].endswith("/") and tag not in BLOCK:
                close(len(stack) - 1)
        if at < len(source) and not skip:
            self.texts.append((stack[-1], source[at:]))
        if self.hinted:
            self._drop_hinted()

    def _drop_hinted(self):
        """Leave out the texts of what names itself as something else."""
        n = len(self.tags)
        chars, links, linked, gone = [0] * n, [0] * n, [False] * n, [False] * n
        for i in range(1, n):
            linked[i] = self.tags[i] == "a" or linked[self.parents[i]]
        for node, text in self.texts:
            size = len("".join(text.split()))
            chars[node] += size
            links[node] += size * linked[node]
        for i in range(n - 1, 0, -1):
            chars[self.parents[i]] += chars[i]
            links[self.parents[i]] += links[i]
        for i, kind in self.hinted.items():
            if kind == 3:
                gone[i] = LONGER * (chars[0] - links[0] - chars[i] + links[i]) >= chars[i]
            else:
                gone[i] = 2 * chars[i] < chars[0] and (kind == 2 or links[i] >= LINKED * chars[i])
        for i in range(1, n):
            gone[i] = gone[i] or gone[self.parents[i]]
        self.texts = [x for x in self.texts if not gone[x[0]]]

    def _add(self, tag: str, parent: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        return len(self.tags) - 1

    def _end_implied(self, tag, stack, close):
        ends = SAME_LEVEL.get(tag, {"p"} | ({tag} if tag in ("h1", "h2", "h3", "h4", "h5", "h6") else set()))
        for k in range(len(stack) - 1, 0, -1):
            name = self.tags[stack[k]]
            if name in ends:
                close(k)
                return
            if name in BLOCK and not (name == "p" and tag in SAME_LEVEL):
                return

    def densities(self):
        n = len(self.tags)
        chars, link_chars, own, heads = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = self.tags[i] == "a" or in_link[self.parents[i]]
        for node, text in self.texts:
            size = len("".join(text.split()))
            own[node] += size
            chars[node] += size
            link_chars[node] += size * in_link[node]
        for i in range(1, n):
            heads[i] = own[i] if self.tags[i] in HEADS else 0
        tags, link_tags = [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            heads[p] += chars[i] if self.tags[i] in HEADS else heads[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (self.tags[i] == "a")
        everything, all_links = max(chars[0], 1), link_chars[0]

        def density(c, t, lc, lt):
            """Characters per tag times the logarithm of text over links, damped by the page's own links."""
            if not c:
                return 0.0
            t, lt, rest = max(t, 1), max(lt, 1), max(c - lc, 1)
            return c / t * log(c * t / (max(lc, 1) * lt) + 1) / log(c / rest * lc + all_links / everything * c + e)

        self.density, self.heads = density, heads
        self.counts = (chars, tags, link_chars, link_tags)
        self.dense = [density(*(x[i] for x in self.counts)) for i in range(n)]
        self.sums = [density(o, 1, o * link, int(link)) if o else 0.0 for o, link in zip(own, in_link)]
        for i in range(1, n):
            self.sums[self.parents[i]] += self.dense[i]

    def main(self) -> list[int]:
        """The nodes of the article: one, or several articles side by side."""
        self.densities()
        chars, tags, up = self.counts[0], self.tags, self.parents
        nodes = [i for i in range(len(tags)) if chars[i]]
        if not nodes:
            return []

        def path(i):
            while i >= 0:
                yield i
                i = up[i]

        def fits(outer, best, least):
            """Whether what ``outer`` holds besides ``best`` belongs to the text."""
            rest = [x[outer] - x[best] for x in self.counts]
            return rest[0] == self.heads[outer] - self.heads[best] or self.density(*rest) >= least

        best = max(nodes, key=lambda i: (self.sums[i] * (MARK if tags[i] in SECTIONS else 1), -i))
        threshold = min(self.dense[i] for i in path(best))
        while tags[best] not in BLOCK and tags[best] != "#root":
            best = up[best]
        # The nearest <article> at or above each node.
        article = [-1] * len(tags)
        for i in range(1, len(tags)):
            article[i] = i if tags[i] == "article" else article[up[i]]
        best = article[best] if article[best] >= 0 else best
        least = threshold
        while up[best] >= 0:
            if tags[best] == "article":
                least = max(threshold, BESIDE * self.dense[best])
            outer = article[up[best]]
            if outer >= 0 and fits(outer, best, threshold):
                best = outer
            elif tags[up[best]] not in ("body", "html", "#root") and fits(up[best], best, least):
                best = up[best]
            else:
                break
        marked = any(tags[i] in SECTIONS for i in path(best))
        if tags[best] == "p" or best and not marked and self.sums[up[best]] >= self.sums[best]:
            best = up[best]
        if tags[best] != "article":
            return [best]
        return [i for i in nodes if i == best or tags[i] == "article" and up[i] == up[best] and self.dense[i] >= threshold]

    def blocks(self, tops: list[int]) -> list[str]:
        """Texts of the blocks below ``tops`` in page order."""
        inside = [False] * len(self.tags)
        for top in tops:
            inside[top] = True
        block = [0] * len(self.tags)
        for i in range(1, len(self.tags)):
            inside[i] = inside[i] or inside[self.parents[i]]
            block[i] = i if self.tags[i] in BLOCK else block[self.parents[i]]
        out, last, held = [], None, []

        def end():
            if text := " ".join(html.unescape("".join(held)).split()):
                out.append(text)
            held.clear()

        for node, text in self.texts:
            if not inside[node]:
                continue
            if block[node] != last:
                end()
                last = block[node]
            held.append(text)
        end()
        return out


def main_text(source: str) -> str:
    page = _Page(source)
    return "\n".join(page.blocks(page.main()))


def _run(batches: Iterator[dict]) -> Iterator[dict]:
    for b in batches:
        texts = [main_text(h) for h in b["html"].to_pylist()]
        yield {"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]}


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages (page_id, url, html, ...)``, whole pages.

    A null, empty or text-free page has an empty text. Null ids and urls and repeated rows are rows like all
    others; broken markup is read as far as it goes; other columns are ignored; an empty table gives no rows.
    """
    return arrow_map(
        pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")),
        _run,
        "page_id long, url string, text string, n_chars long",
    )
