"""Main-text extraction by consensus host paths.

1. Every page is parsed and its containers scored: a block of text counts for
   the container around it and half for each one further out, less the part
   inside links; what its tag or its names mark as boilerplate counts
   nothing.  Names are a weak sign (a page wrapper may be called with-sidebar):
   a container so named that holds most of the page's content stays in.  A
   container's path is its chain of tags and classes with digits generalised.
2. From a container the page climbs to the widest one around it whose further
   text is still content: the same article or main element, or headings,
   paragraphs and lists that stand beside the container.
3. In Spark, pages vote per host: the scores of a path are summed (each
   page's best scores 1), and the path with most votes wins, climbed to where
   most of its votes climb.
4. Every page is parsed again and the containers on its host's winning path
   give the text; a page without such a container uses its own best one.

Hosts are salted for the join, so one host may hold any share of the pages.

Defined cases: NULL html counts as empty; empty pages and pages without text
give the empty text; a NULL or odd url is a host of its own; repeated rows
each get their result; very long pages are parsed whole; truncated markup
ends at its end; an empty table gives an empty result; other columns are
ignored.
"""
from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import _batch

SALTS = 16
_TAG = re.compile(r"<!--(?:>|->|.*?(?:--!?>|$))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
              "strike strong sub sup time tt u var wbr img ruby rb rt rp".split())
_SKIPPED = set("script style noscript template textarea title iframe svg math canvas object audio video select "
               "option button datalist head".split())
_BOILERPLATE = set("nav aside footer form header menu dialog fieldset".split())
_MAIN = set("article main".split())
#: Elements whose text is a line or block of the container around them; lists and
#: tables are containers when scored, but blocks when climbing.
_LINES = _INLINE | set("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th tr tbody figcaption".split())
_BLOCKS = _LINES | set("ul ol dl table thead tfoot caption figure center hgroup".split())
#: A container is climbed out of when its siblings' blocks are at least 1 in so
#: much of the text around it.
_AROUND = 4
#: Blocks that an opening block of the same kind, or any block, closes.
_CLOSED_BY_BLOCK = {"p"}
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}
_CHROME = re.compile(r"(?:^|[-_\s])(?:ad|ads|advert\w*|adv|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|nav\w*|menu\w*|"
                     r"side-?bar|foot\w*|head(?:er|bar)|masthead|breadcrumbs?|share|sharing|social|related|recommend\w*|"
                     r"newsletter|subscri\w*|signup|sign-up|login|comments?|commentlist|disqus|respond|replies|popup|modal|overlay|"
                     r"toolbar|pagination|pager|widget\w*|search\w*|copyright|legal|skip\w*)(?:$|[-_\s\d])", re.I)
_CONTENT = re.compile(r"(?:^|[-_\s])(?:article|content|entry|post|story|main|body|text)(?:$|[-_\s\d])", re.I)
#: Names that say nothing but boilerplate, unlike with-sidebar or nav-open.
_PLAIN = re.compile(r"ads?|advert\w*|sponsor(?:s|ed)?|promo|banner|cookies?|consent|nav(?:bar|igation)?|menu|side-?bar|footer|header|masthead|"
                    r"breadcrumbs?|share|sharing|social|related|newsletter|login|comments?|commentlist|disqus|respond|replies|popup|modal|"
                    r"overlay|toolbar|pagination|pager|widgets?|search|copyright|legal", re.I)
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_NUMBER = re.compile(r"\d+")


class Node:
    __slots__ = ("tag", "path", "parent", "hard", "named", "plain", "content", "dropped", "bonus", "score", "link")

    def __init__(self, tag: str, names: dict[str, str], parent: "Node | None"):
        self.tag, self.parent, self.score = tag, parent, 0.0
        words = [x for x in (names.get("class"), names.get("id")) if x]
        tokens, words = " ".join(words).split(), " ".join(words)
        classes = sorted({_NUMBER.sub("#", c) for c in (names.get("class") or "").split()})
        self.path = (parent.path + "/" if parent else "") + ".".join([tag, *classes])
        self.link = tag == "a" or bool(parent and parent.link)
        self.bonus = 2.0 if tag in _MAIN else 1.5 if _CONTENT.search(words) else 1.0
        hidden = "hidden" in names or names.get("aria-hidden") == "true" or "display:none" in re.sub(
            r"\s", "", names.get("style") or "").lower()
        chrome = bool(words and _CHROME.search(words))
        clean = any(_CONTENT.search(t) and not _CHROME.search(t) for t in tokens) if chrome else self.bonus > 1
        self.content = clean and tag not in ("html", "body")
        self.named = chrome and tag not in _MAIN and tag not in ("html", "body")
        self.plain = self.named and any(_PLAIN.fullmatch(t) for t in tokens)
        self.hard = (bool(parent and parent.hard) or hidden or tag in _BOILERPLATE
                     or (names.get("role") or "").lower() in _ROLES)
        self.dropped = bool(parent and parent.dropped) or self.hard or self.named


def parse(page: str) -> list[tuple[Node, str]]:
    """The runs of a page; a node is dropped by its tag, role or style, or by
    a name unless it holds the page's content."""
    runs = list(_runs(page))
    nodes: dict[int, Node] = {}                       # with text, and all around them
    for node, text in runs:
        up = node
        while up and id(up) not in nodes:
            nodes[id(up)] = up
            up = up.parent
    if any(n.named for n in nodes.values()):
        _spare(runs, list(nodes.values()))
    return runs


def _spare(runs: list[tuple[Node, str]], nodes: list[Node]) -> None:
    """Takes back drops by name, outermost first: of a container with more
    text than is left elsewhere and most of the text in content elements, or
    without these most of the text outside plain names.  If no text is left,
    only plain names count, and if that leaves none, no name."""
    depth: dict[int, int] = {}
    for n in nodes:
        chain = []
        while n and id(n) not in depth:
            chain.append(n)
            n = n.parent
        d = depth[id(n)] if n else -1
        for x in reversed(chain):
            depth[id(x)] = d = d + 1
    nodes.sort(key=lambda n: depth[id(n)])
    # text not linked: in all, in content elements, outside named ones and outside plain ones further in
    held = {id(n): [0, 0, 0, 0] for n in nodes}
    nearest: dict[int, bool] = {}
    for n in nodes:
        nearest[id(n)] = n.content or not n.named and bool(n.parent and nearest[id(n.parent)])
    for node, text in runs:
        if text and not node.link and not node.hard and not text.isspace():
            own = held[id(node)]
            own[0] += len(text)
            own[1] += len(text) * nearest[id(node)]
            own[2] += len(text)
            own[3] += len(text)
    for n in reversed(nodes):
        if n.parent:
            into, own = held[id(n.parent)], held[id(n)]
            into[0] += own[0]
            into[1] += own[1]
            into[2] += 0 if n.named else own[2]
            into[3] += 0 if n.plain else own[3]
    _, content, left, other = held[id(nodes[0])]

    def spared(n):
        text, inner, _, own = held[id(n)]
        if text <= left:
            return False
        return 2 * inner > content if content else not n.plain and 2 * own > other

    for n in nodes:
        above = bool(n.parent and n.parent.dropped)
        if n.named and not above and not n.hard and spared(n):
            left += held[id(n)][2]
            n.dropped = False
        else:
            n.dropped = above or n.hard or n.named
    if not left:
        for n in nodes:
            n.dropped = n.hard or bool(other) and (n.plain or bool(n.parent and n.parent.dropped))


def _runs(page: str) -> Iterator[tuple[Node, str]]:
    """(container, text) of each run of text between block boundaries, white
    space as it stands and references decoded; the container is the innermost
    open element.  A block boundary yields the empty text."""
    root = node = Node("html", {}, None)
    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            rest = page[at:]
            cut = re.search(r"<(?:/?[a-zA-Z][^<>]*|/?)$", rest)      # a tag cut off at the end
            yield node, entities.unescape(rest[:cut.start()] if cut else rest)
            return
        if m.start() > at:
            yield node, entities.unescape(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                if tag not in _INLINE:
                    yield node, ""
                node = up.parent
            continue
        if tag in _SKIPPED and tag != "head":
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if tag in ("script", "style", "textarea", "title", "noscript", "iframe", "template") or close:
                at = close.end() if close else end
            if tag not in _INLINE:
                yield node, ""
            continue
        if tag == "head":
            close = re.compile(r"</head\s*>|<body[\s>]", re.I).search(page, at)
            if close:
                at = close.start() if close[0][1] != "/" else close.end()
            continue
        if tag == "html":
            continue
        if tag in _INLINE:
            if tag not in _VOID:
                node = Node(tag, _names(m[3]), node)
            continue
        yield node, ""
        node = _closed(node, root, tag)
        if tag not in _VOID and not m[3].endswith("/"):
            node = Node(tag, _names(m[3]), node)


def _names(attributes: str) -> dict[str, str]:
    if not attributes or attributes.isspace():
        return {}
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in _NAMES.findall(attributes)}


def _closed(node: Node, root: Node, tag: str) -> Node:
    """Where a new block goes: out of an open paragraph, or out of a sibling
    of its kind."""
    up, closes = node, _CLOSED_BY.get(tag, set()) | _CLOSED_BY_BLOCK
    while up is not root and (up.tag in _INLINE or up.tag in closes):
        if up.tag in closes:
            node = up.parent
        up = up.parent
    return node


def _container(node: Node) -> Node:
    """The nearest element that holds blocks rather than a line of text."""
    while node.parent and node.tag in _LINES:
        node = node.parent
    return node


class Page:
    """A page's containers by path: scores (the best one 1), and the text by
    which a path is climbed out of."""

    def __init__(self, page: str):
        found: dict[int, Node] = {}
        self.own: dict[str, int] = {}                 # text whose container is on the path
        for node, text in parse(page):
            if not text or node.dropped or node.link or text.isspace():
                continue
            up, share = _container(node), 1.0
            self.own[up.path] = self.own.get(up.path, 0) + len(text)
            while up:
                found[id(up)] = up
                up.score += share * len(text)
                up, share = up.parent, share / 2
        paths: dict[str, float] = {}
        self.up: dict[str, str | None] = {}
        self.tag: dict[str, str] = {}
        for n in found.values():
            paths[n.path] = paths.get(n.path, 0.0) + n.score * n.bonus
            self.up[n.path], self.tag[n.path] = n.parent and n.parent.path, n.tag
        best = max(paths.values(), default=0.0)
        self.scores = {p: s / best for p, s in paths.items()}
        self._sums()

    def _sums(self) -> None:
        """All text below a path; by path, the text of its own blocks, of its
        sections and of the articles in it, each by the container's path."""
        self.all = dict.fromkeys(self.up, 0)
        self.blocks: dict[str, dict[str, int]] = {}
        self.sections: dict[str, dict[str, int]] = {}
        self.articles: dict[str, dict[str, int]] = {}

        def block(p):
            while self.up[p] and self.tag[p] in _BLOCKS:
                p = self.up[p]
            return p

        for path, n in self.own.items():
            at = block(path)
            self.blocks.setdefault(at, {})[path] = n
            while self.tag[at] == "section" and self.up[at]:
                at = block(self.up[at])
                self.sections.setdefault(at, {})[path] = n
            at, inner = path, False
            while at:
                self.all[at] += n
                if inner and self.tag[at] in _MAIN:
                    self.articles.setdefault(at, {})[path] = n
                inner |= self.tag[at] == "article"
                at = self.up[at]

    def best(self) -> str | None:
        return max(self.scores, key=lambda p: (self.scores[p], -len(p), p), default=None)

    def _beyond(self, texts: dict[str, int], path: str) -> int:
        """Text of the containers that are not below ``path``."""
        total = 0
        for p, n in texts.items():
            while p and len(p) > len(path):
                p = self.up[p]
            total += n if p != path else 0
        return total

    def climb(self, path: str) -> str:
        """The widest path around ``path`` whose text beyond it is content.
        An article or main element is one text unless further articles stand in
        it; any other must have blocks of its own beside the container, as a
        share of all that would come with them."""
        at = self.up[path]
        while at:
            beyond = self.all[at] - self.all[path]
            if beyond:
                if self.tag[at] in _MAIN and not self._beyond(self.articles.get(at, {}), path):
                    path = at
                elif blocks := self._beyond(self.blocks.get(at, {}), path):
                    if _AROUND * (blocks + self._beyond(self.sections.get(at, {}), path)) >= beyond:
                        path = at
            at = self.up[at]
        return path


def score_containers(page: str) -> dict[str, float]:
    """Path -> score of a page's containers, the best one scoring 1."""
    return Page(page).scores


def extract(page: str, path: str | None) -> str:
    """Text of the containers on ``path`` (of the page's own best one, climbed,
    if it has none): blocks joined by one space."""
    texts = _texts(page, path) if path else None
    if texts is None:
        own = Page(page)
        best = own.best()
        if best is None:
            return ""
        texts = _texts(page, own.climb(best)) or ""
    return texts


def _texts(page: str, path: str) -> str | None:
    out, block, seen = [], [], False
    inside: dict[int, bool] = {}
    keep: list[Node] = []                             # keeps ids from being used again

    def within(n: Node | None) -> bool:
        if n is None:
            return False
        if id(n) not in inside:
            keep.append(n)
            inside[id(n)] = n.path == path or within(n.parent)
        return inside[id(n)]

    for node, text in parse(page):
        if not text:
            if block:
                out.append("".join(block))
                block = []
            continue
        if not node.dropped and within(node):
            seen = True
            block.append(text)
    if block:
        out.append("".join(block))
    if not seen:
        return None
    return " ".join(x for x in (_SPACE.sub(" ", b).strip() for b in out) if x)


def host_of(url: Column) -> Column:
    """Lower-cased host of a url; the whole url where it has none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.when(host != "", host).otherwise(url), F.lit(""))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """page_id, url, path (the one used first) and text of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).withColumn("host", host_of(F.col("url")))

    def vote(stream):
        for b in stream:
            tally: dict[tuple[str, str, str], float] = {}  # a batch's votes, added up before the shuffle
            for host, html in zip(b.column(0).to_pylist(), b.column(1)):
                page = Page(html.as_py() or "")
                for path, score in page.scores.items():
                    if score >= 0.25:
                        key = host, path, page.climb(path)
                        tally[key] = tally.get(key, 0.0) + score
            yield _batch([("host", pa.string()), ("path", pa.string()), ("wide", pa.string()), ("votes", pa.float64())],
                         [(*k, v) for k, v in tally.items()])

    def apply(stream):
        for b in stream:
            cols = [b.column(i).to_pylist() for i in (0, 1, 2)]
            for a in range(0, b.num_rows, 200):
                part = [(i, u, p, extract(b.column(3)[a + j].as_py() or "", p))
                        for j, (i, u, p) in enumerate(zip(*(c[a:a + 200] for c in cols)))]
                yield _batch([("page_id", pa.int64()), ("url", pa.string()), ("path", pa.string()), ("text", pa.string())], part)

    votes = (rows.select("host", "html").mapInArrow(vote, "host string, path string, wide string, votes double")
                 .groupBy("host", "path", "wide").agg(F.round(F.sum("votes"), 6).alias("votes"))
                 .groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"),
                                              F.max_by("wide", F.struct("votes", "wide")).alias("wide")))
    winners = (votes.groupBy("host").agg(F.max_by("wide", F.struct("votes", "path")).alias("path"))
                    .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.lit(SALTS)).cast("int"))
    return (salted.join(winners, ["host", "salt"], "left").select("page_id", "url", "path", "html")
                  .mapInArrow(apply, "page_id long, url string, path string, text string"))
