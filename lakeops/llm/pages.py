"""Main text of web pages by removal of site templates (operator 11).

1. Each page is parsed to its elements. An element's subtree hash covers its tag, the hashes of its
   child elements and its texts, in order; attributes are left out.
2. Spark counts, for each host and subtree, the different pages that hold it. Pages with the same main
   part (the same title, first heading and longest block, if none is marked) count once, so that copies
   of an article on one host do not make the article a template.
3. Subtrees on at least ``least_pages`` different pages of their host are deleted. What the page
   itself marks as its article (or main part) is protected: inside it only recurring lists and boxes
   that are mostly links are taken for templates, never recurring paragraphs.
4. Elements that say by tag, role or class that they are menus, forms, notices and the like go as
   well, so that hosts with a single page are handled. Text remains from the main part, or from the
   whole body of a page without one.

The table of recurring subtrees is broadcast where it is small (``MOST_BROADCAST``), and otherwise
joined to the subtrees of each page; both ways give the same rows.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lakeops.session import written

LEAST_PAGES = 3
MOST_BROADCAST = 300_000
MOSTLY_LINKS = 0.5

# Groups of HTML elements, and words in roles, classes and ids of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
FURNITURE = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video nav aside footer form "
    "button select textarea input datalist dialog menu search noembed noframes".split()
)
BOXES = frozenset("div section ul ol dl table figure p span".split())
ENDS_P = BLOCKS - {"br", "button", "caption", "title", "head", "body", "html"}
ENDED_BY_SAME = {
    "li": ("li", frozenset(("ul", "ol", "menu"))),
    "dt": ("dt dd", frozenset(("dl",))),
    "dd": ("dt dd", frozenset(("dl",))),
    "tr": ("tr td th", frozenset(("table",))),
    "td": ("td th", frozenset(("tr", "table"))),
    "th": ("td th", frozenset(("tr", "table"))),
    "option": ("option", frozenset(("select",))),
}
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
HINTS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login menu "
    "navbar nav navigation breadcrumb breadcrumbs sidebar widget widgets related recommended share sharing social "
    "footer masthead pagination pager toolbar skip".split()
)
COMMENT_HINTS = frozenset("comment comments commentlist respond replies reply disqus discussion".split())

_MARKUP = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"[^\s/>]+")
_REST = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z0-9]+")
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    """The host in lower case; empty if the url names none."""
    found = _HOST.match(url) if url else None
    return found[1].lower() if found else ""


def _hints(attributes: str) -> tuple[bool, bool]:
    """Whether role, class or id name page furniture, and whether they name reader comments."""
    furniture = comments = False
    for name, double, single, bare in _ATTRIBUTES.findall(attributes):
        words = _WORDS.findall((double or single or bare).lower())
        if name.lower() == "role":
            furniture |= not ROLES.isdisjoint(words)
        else:
            furniture |= not HINTS.isdisjoint(words)
            comments |= not COMMENT_HINTS.isdisjoint(words)
    return furniture, comments


class Page:
    """The elements of a page in the order of their start tags, and its texts.

    ``parent``, ``tag``, ``digest``, ``size`` and ``linked`` have an entry for each element: its
    parent's number, name, subtree hash, characters of text, and how many of them are in links.
    ``texts`` holds (element, text) in page order; an empty text parts two blocks.
    """

    def __init__(self, source: str | None):
        self.tag = ["#page"]
        self.parent = [-1]
        self.said = [(False, False)]
        self.digest = [0]
        self.size = [0]
        self.linked = [0]
        self.texts: list[tuple[int, str]] = []
        self._parts: list[list[bytes]] = [[]]
        self._open = [0]
        if source:
            self._read(source)
        while self._open:
            self._close()
        self.main = self._main_parts()
        self.marked = any(main and not aside for main, aside in zip(self.main, self.aside))

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = _MARKUP.search(source, at)
            start = found.start() if found else end
            if start > at:
                self._text(source[at:start])
            if not found:
                return
            mark = found[0]
            if mark == "<!--":
                stop = source.find("-->", start + 4)
                # Without an end the rest is a comment, as browsers have it.
                at = end if stop < 0 else stop + 3
                continue
            if mark[1] in "!?":
                stop = source.find(">", start)
                at = end if stop < 0 else stop + 1
                continue
            closing = mark[1] == "/"
            name_end = _NAME.match(source, start + 1 + closing).end()
            name = source[start + 1 + closing : name_end].lower()
            rest = _REST.match(source, name_end)
            if rest:
                at = rest.end()
            else:  # an open quote
                stop = source.find(">", name_end)
                if stop < 0:
                    return
                at = stop + 1
            if closing:
                self._end(name)
                continue
            attributes = source[name_end : at - 1]
            self._start(name, attributes)
            if name in RAW or name in ("textarea", "title"):
                stop = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(source, at)
                inside = source[at : stop.start()] if stop else source[at:]
                if name == "title":
                    self._text(inside)
                at = stop.start() if stop else end

    def _text(self, text: str) -> None:
        if "&" in text:
            text = references.unescape(text)
        shown, number = " ".join(text.split()), self._open[-1]
        if shown:
            self._parts[-1].append(xxhash.xxh64_digest(shown))
            self.size[number] += len(shown)
            # White space at the ends may part words of neighbouring texts.
            shown = " " * text[0].isspace() + shown + " " * text[-1].isspace()
        self.texts.append((number, shown or " "))

    def _start(self, name: str, attributes: str) -> None:
        opened = self._open
        if name in ENDS_P:
            self._end_within("p", BLOCKS - {"p"})
        if name in ENDED_BY_SAME:
            ended, walls = ENDED_BY_SAME[name]
            for other in ended.split():
                self._end_within(other, walls)
        if name in BLOCKS:
            self.texts.append((opened[-1], ""))
        if name in VOID or name == "br":
            if name in BLOCKS:
                self._parts[-1].append(name.encode())
            return
        self.parent.append(opened[-1])
        self.said.append(_hints(attributes) if attributes and "=" in attributes else (False, False))
        self.digest.append(0)
        self.size.append(0)
        self.linked.append(0)
        self.tag.append(name)
        opened.append(len(self.tag) - 1)
        self._parts.append([name.encode()])
        if attributes.endswith("/") and name in ("svg", "path", "use", "g", "rect", "circle"):
            self._close()

    def _end_within(self, name: str, walls: frozenset) -> None:
        """Close the innermost open element of that name, unless another one stands between."""
        for place in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[place]]
            if tag == name:
                while len(self._open) > place:
                    self._close()
                return
            if tag in walls:
                return

    def _end(self, name: str) -> None:
        for place in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[place]] == name:
                while len(self._open) > place:
                    self._close()
                return

    def _close(self) -> None:
        number, parts = self._open.pop(), self._parts.pop()
        digest = xxhash.xxh64_digest(b"|".join(parts))
        self.digest[number] = int.from_bytes(digest, "big")
        tag = self.tag[number]
        if tag == "a":
            self.linked[number] = self.size[number]
        if tag in BLOCKS:
            self.texts.append((number, ""))
        parent = self.parent[number]
        if parent >= 0:
            self.size[parent] += self.size[number]
            self.linked[parent] += self.linked[number]
            self._parts[-1].append(digest)

    def _main_parts(self) -> list[bool]:
        """For each element whether it is, or is inside, the part of the page marked as its article."""
        parent, tag = self.parent, self.tag
        wanted = "main" if any(t == "main" and self.size[n] for n, t in enumerate(tag)) else "article"
        main = [False] * len(tag)
        self.aside = [False] * len(tag)
        for n in range(1, len(tag)):
            up, (furniture, comments) = parent[n], self.said[n]
            inside = main[up]
            starts = tag[n] == wanted and not comments and not self.aside[up]
            main[n] = inside or starts
            # An article within an article is a reader's comment.
            nested = tag[n] == "article" and self._within_article(up)
            headed = tag[n] == "header" and not inside
            by_words = (furniture or comments) and tag[n] not in ("html", "body", "main", "article")
            self.aside[n] = (
                self.aside[up]
                or tag[n] in FURNITURE
                or nested
                or headed
                or by_words
                or (comments and tag[n] == "article")
            )
        return main

    def _within_article(self, number: int) -> bool:
        while number > 0:
            if self.tag[number] == "article":
                return True
            number = self.parent[number]
        return False

    def candidates(self) -> set[int]:
        """Subtree hashes that may be templates."""
        return {self.digest[n] for n in range(1, len(self.tag)) if self._may_go(n)}

    def _may_go(self, n: int) -> bool:
        if not self.size[n] or self.tag[n] in ("html", "head", "body", "title", "main", "article", "script", "style"):
            return False
        if self.main[n] and not self.aside[n]:
            return self.tag[n] in BOXES and self.linked[n] >= MOSTLY_LINKS * self.size[n]
        return True

    def signature(self) -> int:
        """The same for pages with an equal main part; without one, with equal title, first heading and longest block."""
        if self.marked:
            return xxhash.xxh64_intdigest(self.text(lambda digest: False))
        title = heading = longest = ""
        for number, block in self._blocks([True] * len(self.tag)):
            if self.tag[number] == "title":
                title = title or block
            elif self.tag[number] == "h1":
                heading = heading or block
            elif len(block) > len(longest):
                longest = block
        return xxhash.xxh64_intdigest("\0".join((title, heading, longest)))

    def _blocks(self, kept: list[bool]) -> Iterator[tuple[int, str]]:
        """(element of its first text, text) of each block that is not blank."""
        first, pieces = 0, []
        for number, text in [*self.texts, (0, "")]:
            if text:
                if kept[number]:
                    if not pieces:
                        first = number
                    pieces.append(text)
            elif pieces:
                block = pieces[0].strip() if len(pieces) == 1 else " ".join("".join(pieces).split())
                if block:
                    yield first, block
                pieces = []

    def text(self, is_template) -> str:
        """The blocks of the main part that are neither templates nor furniture, joined by spaces."""
        gone = [False] * len(self.tag)
        for n in range(1, len(self.tag)):
            gone[n] = gone[self.parent[n]] or (self._may_go(n) and is_template(self.digest[n]))
        kept = [
            not away and not aside and (main or not self.marked) for away, aside, main in zip(gone, self.aside, self.main)
        ]
        found = self._blocks(kept)
        return " ".join(block for _, block in found)


def _mark(host: str, digest: int) -> int:
    """One number for a host and a subtree, signed as Spark has it."""
    value = xxhash.xxh64_intdigest(digest.to_bytes(8, "big"), seed=xxhash.xxh32_intdigest(host))
    return value - (1 << 64) if value >> 63 else value


def _chosen(pages: DataFrame) -> DataFrame:
    kinds = {"page_id": "long", "url": "string", "html": "string"}
    return pages.select(*(F.col(name).cast(kind).alias(name) for name, kind in kinds.items()))


def _in_pages(batch: pa.RecordBatch) -> Iterator[tuple[str, Page]]:
    for url, source in zip(batch.column("url"), batch.column("html")):
        yield host_of(url.as_py()), Page(source.as_py())


def recurring_subtrees(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``mark``: the (host, subtree) numbers found on at least ``least_pages`` different pages of the host."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for host, page in _in_pages(batch):
                signature = page.signature() >> 1
                seen.update((_mark(host, digest), signature) for digest in page.candidates())
            yield pa.RecordBatch.from_arrays(
                [pa.array([m for m, _ in seen], pa.int64()), pa.array([s for _, s in seen], pa.int64())],
                names=["mark", "signature"],
            )

    held = _chosen(pages).select("url", "html").mapInArrow(counted, "mark long, signature long")
    counts = held.distinct().groupBy("mark").agg(F.count("*").alias("__pages"))
    return written(counts.filter(F.col("__pages") >= least_pages).select("mark"), "page-templates")


def main_text(
    pages: DataFrame, least_pages: int = LEAST_PAGES, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of each row of ``pages``.

    Character references are decoded; white space within a block becomes one space; blocks are joined
    by one space in page order. A missing or empty html gives an empty text. A missing url, or one
    without host, belongs to the host with the empty name. Rows that repeat are extracted alike; very
    long pages are read whole, in time proportional to their length. An empty table gives no rows;
    other columns are not read.
    """
    templates = recurring_subtrees(pages, least_pages)
    if templates.count() <= most_broadcast:
        return _by_lookup(pages, templates)
    return _by_join(pages, templates)


def _extracted(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            batch.column("page_id"),
            batch.column("url"),
            pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
        ],
        names=["page_id", "url", "text", "n_chars"],
    )


EXTRACTED = "page_id long, url string, text string, n_chars long"


def _by_lookup(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """With the recurring subtrees, whose number was checked, in each task."""
    known = pages.sparkSession.sparkContext.broadcast(templates.toArrow().column("mark").to_numpy())

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = set(known.value.tolist())
        for batch in batches:
            yield _extracted(
                batch, [page.text(lambda d: _mark(host, d) in held) for host, page in _in_pages(batch)]
            )

    return _chosen(pages).mapInArrow(extracted, EXTRACTED)


def _page_key() -> list[Column]:
    return [F.xxhash64("url", "html").alias("__a"), F.xxhash64("html", "url", "page_id").alias("__b")]


def _by_join(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """With the recurring subtrees of each page beside it, found by a join that adaptive execution can split."""
    keyed = _chosen(pages).select("*", *_page_key())

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, marks = [], []
            for row, (host, page) in enumerate(_in_pages(batch)):
                found = {_mark(host, digest) for digest in page.candidates()}
                marks += found
                rows += [row] * len(found)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__a").take(rows), batch.column("__b").take(rows), pa.array(marks, pa.int64())],
                names=["__a", "__b", "mark"],
            )

    # Rows that repeat share a key, and a set drops what they have twice.
    held = keyed.mapInArrow(marked, "__a long, __b long, mark long").join(templates, "mark")
    marks = held.groupBy("__a", "__b").agg(F.collect_set("mark").alias("marks"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for (host, page), known in zip(_in_pages(batch), batch.column("marks")):
                held = set(known.as_py() or ())
                texts.append(page.text(lambda d: _mark(host, d) in held))
            yield _extracted(batch, texts)

    return keyed.join(marks, ["__a", "__b"], "left").mapInArrow(extracted, EXTRACTED)
