"""Main text of web pages by consensus host paths (operator 7).

Pass one scores the containers of each page (text in their paragraphs, less
linked text) and names the best by its generalised path of tags and classes;
one inside <article> or <main> stands for the nearest such element, and one
with a heading ahead of it for the element that holds both, as heading and lead
may lie beside it.
Spark counts these votes per host. Pass two extracts the text of each page
again from that one of its host's winning paths which scores best on the page;
a page that has none of them, or whose own best container outweighs it by far
(a template too rare to win), uses its own best container. Boilerplate elements (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, comments) give no text in
either pass.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.llm.url_filter import host_path
from renewlens.sources.store import stage

#: Share of a host's votes that makes a path one of its winners.
SHARE = 0.2
#: A winner with under this share of the score of the page's best is passed over.
LOST = 0.25
#: Text beside a container, as a share of its own, up to which a heading ahead
#: of it lifts the vote.
BESIDE = 0.3
#: Share of a host's pages on which a doubtful text block must repeat to go.
REPEATS = 0.05

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Blocks that hold text of a container rather than being one.
_TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt td th tr tbody table ul ol dl figcaption figure caption summary".split())
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_DROP_TAGS = frozenset(
    "nav header footer aside form button select option menu dialog template object svg canvas audio video map head fieldset".split()
)
_DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager "
    "pagination popup promo promotion related respond replies share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "widget".split()
)
#: Words of reader comments, dropped without a vote.
_COMMENT_WORDS = frozenset("comment comments disqus respond replies".split())
#: Text elements: of these, a class that only partly consists of drop words is
#: doubtful ("social-history"), and the host's pages decide.
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote dd dt figcaption caption".split())
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
_ROOTS = frozenset(("html", "body", "article", "main"))
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"([a-z0-9])([A-Z])")
_DIGITS = re.compile(r"\d+")


def _boiler(tag: str, attrs: dict[str, str]) -> bool | None:
    """Whether an element is boilerplate; None: doubtful."""
    if tag in _DROP_TAGS:
        return True
    if not attrs or tag in _ROOTS:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if attrs.get("role", "").lower() in _DROP_ROLES:
        return True
    words = set(_SPLIT.split(_CAMEL.sub(r"\1 \2", f"{attrs.get('class', '')} {attrs.get('id', '')}").lower())) - {""}
    if _DROP_WORDS.isdisjoint(words):
        return False
    if tag in _TEXT_TAGS and not words <= _DROP_WORDS and _COMMENT_WORDS.isdisjoint(words):
        return None
    return True


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


class Page:
    """A page as a light tree: parents, generalised paths and text blocks.
    ``repeated``: paths of doubtful elements that are boilerplate on the host."""

    def __init__(self, html: str | None, repeated: frozenset[str] = frozenset()):
        self.parent, self.tag, self.path, self.boiler = [-1], [""], [""], [False]
        self.blocks: list[tuple[int, list[tuple[str, int, bool]]]] = []
        self._stack = [0]
        self._links = 0
        self._pieces: list[tuple[str, int, bool]] = []
        self._read(html or "")
        self.doubtful = [i for i, b in enumerate(self.boiler) if b is None]
        for i in self.doubtful:
            self.boiler[i] = self.path[i] in repeated
        for i, tag in enumerate(self.tag):  # a wrapper of the article isn't boilerplate for its class
            if tag in ("article", "main"):
                p = self.parent[i]
                while p > 0:
                    if self.tag[p] not in _DROP_TAGS:
                        self.boiler[p] = False
                    p = self.parent[p]
        self.dropped = [False] * len(self.tag)
        for i in range(1, len(self.tag)):  # parents come first
            self.dropped[i] = self.boiler[i] or self.dropped[self.parent[i]]

    def _flush(self) -> None:
        if self._pieces:
            at = next((n for n in reversed(self._stack) if self.tag[n] in _BLOCK), 0)
            self.blocks.append((at, self._pieces))
            self._pieces = []

    def _pop_to(self, depth: int) -> None:
        for n in self._stack[depth:]:
            if self.tag[n] in _BLOCK:
                self._flush()
            self._links -= self.tag[n] == "a"
        del self._stack[depth:]

    def _text(self, raw: str) -> None:
        if raw:
            self._pieces.append((unescape(raw) if "&" in raw else raw, self._stack[-1], self._links > 0))

    def _close(self, tags: set[str], stop: set[str]) -> None:
        for d in range(len(self._stack) - 1, 0, -1):
            t = self.tag[self._stack[d]]
            if t in tags:
                self._flush()
                self._pop_to(d)
                return
            if t in stop:
                return

    def _open(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in _BLOCK:
            self._flush()
            if tag != "option":
                self._close({"p"}, {"td", "th", "button", "object", "table", "caption"})
            if tag in _CLOSES:
                self._close(*_CLOSES[tag])
        if tag == "br":
            self._pieces.append((" ", self._stack[-1], False))
        if tag in _VOID:
            return
        up = self._stack[-1]
        name = ".".join([tag, *sorted(_DIGITS.sub("#", c) for c in attrs.get("class", "").split())])
        self.parent.append(up)
        self.tag.append(tag)
        self.path.append(f"{self.path[up]}/{name}" if tag in _BLOCK else self.path[up])
        self.boiler.append(_boiler(tag, attrs))
        self._stack.append(len(self.tag) - 1)
        self._links += tag == "a"

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            m = _TOKEN.search(html, at)
            if m is None:
                self._text(html[at:])
                break
            self._text(html[at : m.start()])
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                blocks = tag in _BLOCK
                for d in range(len(self._stack) - 1, 0, -1):
                    t = self.tag[self._stack[d]]
                    if t == tag:
                        if blocks:
                            self._flush()
                        self._pop_to(d)
                        break
                    if t in _BLOCK and not blocks:
                        break
                continue
            raw_attrs = m[3]
            attrs = {k.lower(): a or b or c or "" for k, a, b, c in _ATTR.findall(raw_attrs)} if raw_attrs.strip(" /\n") else {}
            if tag in _RAW:
                end = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else n
                continue
            self._open(tag, attrs)
        self._flush()

    def _kept(self, pieces: list[tuple[str, int, bool]]) -> tuple[str, int]:
        text = " ".join("".join(t for t, n, _ in pieces if not self.dropped[n]).split())
        return text, sum(len(t) for t, n, link in pieces if link and not self.dropped[n])

    def scores(self) -> dict[int, float]:
        """Score of every container that holds text."""
        score: dict[int, float] = {}
        for at, pieces in self.blocks:
            text, linked = self._kept(pieces)
            worth = len(text) - min(linked, len(text))
            if worth <= 0:
                continue
            while at > 0 and self.tag[at] in _TEXTUAL:
                at = self.parent[at]
            for share in (1.0, 0.5):
                if at < 0:
                    break
                score[at] = score.get(at, 0.0) + worth * share * (1.25 if self.tag[at] in ("article", "main") else 1.0)
                at = self.parent[at]
                while at > 0 and self.tag[at] not in _BLOCK:
                    at = self.parent[at]
        return score

    def _up(self, at: int) -> Iterator[int]:
        while at > 0:
            yield at
            at = self.parent[at]

    def _article(self, at: int) -> int:
        return next((i for i in self._up(at) if self.tag[i] in ("article", "main")), at)

    def _stands_for(self, at: int) -> int:
        """The element a container votes for: the nearest article or main around
        it, or the lowest element that holds it and, ahead of it, a heading with
        little text beside, or itself."""
        whole = self._article(at)
        if at <= 0 or self.tag[whole] in ("article", "main"):
            return whole
        inside: dict[int, bool] = {}
        sizes = []
        for block, pieces in self.blocks:
            if n := len(self._kept(pieces)[0]):
                if block not in inside:
                    inside[block] = at in self._up(block)
                sizes.append((block, n, inside[block]))
        own = sum(n for _, n, within in sizes if within)
        first = next((i for i, x in enumerate(sizes) if x[2]), len(sizes))
        if not any(self.tag[block] in ("h1", "h2") for block, _, _ in sizes[:first]):
            return at
        for whole in self._up(self.parent[at]):
            held = [whole in self._up(block) for block, _, _ in sizes]
            if sum(n for (_, n, _), h in zip(sizes, held, strict=True) if h) > (1 + BESIDE) * own:
                break
            if any(h and self.tag[x[0]] in ("h1", "h2") for x, h in zip(sizes[:first], held, strict=False)):
                return whole
        return at

    def best(self) -> tuple[str, float] | None:
        """Path and score of what the best container stands for."""
        score = self.scores()
        if not score:
            return None
        at = min(score, key=lambda i: (-score[i], i))
        return self.path[self._stands_for(at)], score[at]

    def chosen(self, paths: list[str]) -> tuple[str | None, bool]:
        """(path, whether by consensus): the winner that scores best on this page
        (ties: the first), counted at the containers within it; the page's own
        best where no winner holds text or all are outweighed by far."""
        score = self.scores()
        top: dict[str, float] = {}
        own = max(score.values(), default=0.0)
        for i, s in score.items() if paths else ():
            whole = self._stands_for(i) if s == own else self._article(i)
            for p in {self.path[whole], self.path[i]}.intersection(paths):
                top[p] = max(top.get(p, 0.0), s)
        if top:
            path = min(top, key=lambda p: (-top[p], paths.index(p)))
            if top[path] >= LOST * own:
                return path, True
        elif not score:  # text in links alone has no score
            for path in paths:
                if self.extract(path):
                    return path, True
        b = self.best()
        return (b[0], False) if b else (None, False)

    def marks(self) -> set[tuple[str, int]]:
        """Path and hash of the text of every doubtful element."""
        if not self.doubtful:
            return set()
        doubtful, texts = set(self.doubtful), {}
        for at, pieces in self.blocks:
            text = " ".join("".join(t for t, _, _ in pieces).split())
            for i in self._up(at):
                if i in doubtful and text:
                    texts.setdefault(i, []).append(text)
        return {(self.path[i], _hash("\n".join(t))) for i, t in texts.items()}

    def extract(self, path: str) -> str:
        """Text of all elements at a path: blocks joined by two line ends."""
        inside = [False] * len(self.tag)
        for i in range(len(self.tag)):
            inside[i] = self.path[i] == path or (i > 0 and inside[self.parent[i]])
        texts = (self._kept(pieces)[0] for at, pieces in self.blocks if inside[at])
        return "\n\n".join(t for t in texts if t)


def votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, mark, page, votes, score): each page's vote for its best
    container (mark and page null), and the doubtful text elements of all pages
    by path, hash of their text (mark) and hash of the html (page)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                for host, text in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    page = Page(text)
                    if b := page.best():
                        rows.append((host, b[0], None, None, b[1]))
                    if marks := page.marks():
                        whole = _hash(text)
                        rows += [(host, path, mark, whole, 0.0) for path, mark in marks]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64()))],
                    ["host", "path", "mark", "page", "score"])

    cast = pages.select(host_path(url)[0].alias("host"), F.col(html).alias("html")).mapInArrow(
        run, "host string, path string, mark long, page long, score double")
    return cast.groupBy("host", "path", "mark", "page").agg(F.count(F.lit(1)).alias("votes"), F.sum(F.round("score").cast("long")).alias("score"))


def repeated(cast: DataFrame, share: float = REPEATS) -> DataFrame:
    """(host, repeated): paths of doubtful elements that stand on at least
    ``share`` of a host's voting pages and say each thing on two different pages
    or more, on average. Copies of one page are one page."""
    total = cast.where("mark IS NULL").groupBy("host").agg(F.sum("votes").alias("total"))
    marks = cast.where("mark IS NOT NULL").groupBy("host", "path", "mark").agg(F.count(F.lit(1)).alias("n"))
    per = marks.groupBy("host", "path").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"))
    found = per.join(total, "host").where((F.col("n") >= share * F.col("total")) & (F.col("n") >= 2 * F.col("different")))
    return found.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("repeated"))


def winners(cast: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, paths): the paths with at least ``share`` of a host's votes, most
    votes first; ties by score, then by name. At most 1 / share paths a host."""
    cast = cast.where("mark IS NULL")
    total = cast.groupBy("host").agg(F.sum("votes").alias("total"))
    top = cast.join(total, "host").where(F.col("votes") >= share * F.col("total"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), "path")))
    return top.groupBy("host").agg(order.getField("path").alias("paths"))


def extract(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """``pages`` (url, html, any others) with ``text``, ``text_path`` (the path
    used) and ``by_consensus`` (whether it is one of the host's winners).

    A null or empty html, or one without text, gives an empty text and a null
    path. Pages with no host vote together as the empty host. Columns called
    text, text_path or by_consensus are replaced; rows map one to one; an empty
    table gives an empty one.
    """
    own = [c for c in pages.columns if c not in ("text", "text_path", "by_consensus")]
    pages = pages.select(*own)
    cast = stage(votes(pages), "host-votes")
    won = stage(winners(cast, share).join(repeated(cast), "host", "left"), "host-paths").withColumnRenamed("host", "__host")
    # the written table's size decides how it is joined
    joined = pages.withColumn("__h", host_path("url")[0]).join(won, F.col("__h") == F.col("__host"), "left").select(
        *own, F.col("paths").alias("__paths"), F.col("repeated").alias("__repeated"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name != "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts, used, agreed = [], [], []
                for html, paths, again in zip(*(part.column(c).to_pylist() for c in ("html", "__paths", "__repeated")), strict=True):
                    page = Page(html, frozenset(again or ()))
                    path, by_host = page.chosen(paths or [])
                    text = page.extract(path) if path is not None else ""
                    agreed.append(by_host and bool(text))
                    texts.append(text)
                    used.append(path if text else None)
                keep = [c for c in part.schema.names if c not in ("html", "__paths", "__repeated")]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array(texts, pa.string()), pa.array(used, pa.string()), pa.array(agreed)],
                    [*keep, "text", "text_path", "by_consensus"])

    return joined.mapInArrow(run, f"{fields}, text string, text_path string, by_consensus boolean")


def op7_host_consensus(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "text_path", "by_consensus")
