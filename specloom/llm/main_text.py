"""Main text of web pages by consensus paths of their hosts.

Every page's containers are scored by the text of their paragraphs less the text
of their links, at any depth.  A container's path is the tags and classes that lead to
it, with digits generalised, as a 64-bit hash of its parent's path and its own step.  Spark
adds up the scores per host and path.  The deepest path that holds nearly all of a
host's text wins, or the article or main around it, and every page is extracted
again from the containers under its host's winning path, or, where a page has
none, from its own best one.  A winner that stands in no article or main may have
parts of the article beside it: then a block elsewhere stays, too, unless its
container is mostly links, on the page or by the vote of the host's pages.

Votes are summed before they are shuffled, so a host with a third of all pages
is a few rows per task; pages meet their host's paths in a join salted
``SALTS`` ways, so that its pages are spread, too.  A host's list of link containers
holds paths of at least 1 / ``COMMON`` of its pages, so it has at most ``COMMON`` times
the containers of an average page.

Defined results: null or empty html gives an empty text with 0 characters; a
null url, or one without a host, counts as the host "" of its own; ties go to
the path with the least hash; repeated rows keep their row; markup that is cut off
or unbalanced is read as browsers do, open elements end with the page; very long
pages and very deep ones take memory in proportion to their length; further columns
are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from specloom.llm import ragged
from specloom.session import cut_lineage

# Fixed values of HTML: elements without content, those whose text is never shown, and those that make blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style noscript template head title svg math iframe object video audio canvas map".split()
)
ASIDE = frozenset("nav header footer aside form menu button select textarea dialog fieldset".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 html li "
    "main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body div main section html".split())
#: Elements that an opening tag of the key ends, up to the nearest of the second list.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words of a class, id or role that mark what is not the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer "
    "header masthead menu nav navbar navigation newsletter notice notices pagination pager popup modal promo promotion "
    "related share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget complementary "
    "contentinfo search alert gdpr consent reply replies respond".split()
)
#: Parts into which each host's pages are dealt.
SALTS = 32
#: Share of a host's text that the winning path must hold, if no path has all.
NEARLY_ALL = 7 / 8
#: A host's vote on a link container counts if one page in so many has it.
COMMON = 100
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


def _is_aside(tag: str, attributes: dict[str, str]) -> bool:
    """Never shown, or an aside by its tag."""
    if tag in ASIDE or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if tag in ("body", "html", "article", "main"):
        return False
    style = attributes.get("style", "").replace(" ", "").lower()
    return "display:none" in style or "visibility:hidden" in style


def _marker(tag: str, attributes: dict[str, str]) -> str | None:
    """Whether class, id or role mark an aside: as a "whole" name, or as the last "part" of one."""
    if tag in ("body", "html", "article", "main"):
        return None
    found = None
    for name in " ".join(attributes.get(x, "") for x in ("class", "id", "role")).lower().split():
        # "with-sidebar" and the like mark what holds the article, not what stands beside it
        words = [] if name.startswith(("has-", "no-", "with-", "without-")) else _WORD.findall(name)
        if words and words[-1] in ASIDE_WORDS:
            if len(words) == 1:
                return "whole"
            found = "part"
    return found


def _step(parent: int, step: str) -> int:
    """Signed 64-bit hash of a path from that of its parent."""
    data = parent.to_bytes(8, "little", signed=True) + step.encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


class _Page(HTMLParser):
    """Blocks of text in page order, each with the container it stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: path, parent and depth of each container, and the innermost article, or else main, that it stands in
        self.paths: list[int] = [_step(0, "html")]
        self.parents: list[int] = [-1]
        self.depths: list[int] = [0]
        self.frames: dict[str, list[int]] = {"article": [-1], "main": [-1]}
        #: texts of blocks with their container, and the link-corrected length of each container's own
        self.blocks: list[tuple[int, str]] = []
        self.scores: dict[int, float] = {}
        #: all blocks so far, with their link-corrected length and the innermost marked element around them
        self.found: list[tuple[int, str, float, int]] = []
        #: kind and parent of each marked element; the elements around the first main and article
        self.marks: list[tuple[str, int]] = []
        self.around: dict[str, int] = {}
        self.open: list[tuple[str, bool, bool, int, int]] = []  # tag, hidden, in a link, container, marked element
        self.names: Counter[str] = Counter()  # of the open elements
        self.held: list[str] = []
        self.linked = 0

    def _cut(self, at: int) -> None:
        """Close the open elements from ``at`` on."""
        self.names.subtract(x[0] for x in self.open[at:])
        del self.open[at:]

    def _state(self) -> tuple[bool, bool, int, int]:
        return self.open[-1][1:] if self.open else (False, False, 0, -1)

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.held)).strip()
        if text:
            _, _, at, mark = self._state()
            self.found.append((at, text, len(text) - 2.0 * min(self.linked, len(text)) + 0.1, mark))
        self.held.clear()
        self.linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in ASIDE or tag in UNSEEN:
            self.flush()
            self._end_paragraph()
        if tag in VOID:
            self.held.append(" ")
            return
        if tag in ENDS:
            own, until = ENDS[tag]
            self._pop(own, until)
        attributes = {k: v or "" for k, v in attrs}
        hidden, link, at, mark = self._state()
        if tag in CONTAINERS and tag != "html":
            classes = ".".join(sorted(set(attributes.get("class", "").lower().replace("/", "|").split())))
            self.paths.append(_step(self.paths[at], tag + (f".{_DIGITS.sub('#', classes)}" if classes else "")))
            self.parents.append(at)
            self.depths.append(self.depths[at] + 1)
            for name, held in self.frames.items():
                held.append(len(held) if tag == name else held[at])
            at = len(self.paths) - 1
        hidden = hidden or tag in UNSEEN or _is_aside(tag, attributes)
        if not hidden:
            if tag in ("main", "article"):
                self.around.setdefault(tag, mark)
            elif kind := _marker(tag, attributes):
                self.marks.append((kind, mark))
                mark = len(self.marks) - 1
        self.open.append((tag, hidden, link or tag == "a", at, mark))
        self.names[tag] += 1

    def _end_paragraph(self) -> None:
        """An open paragraph ends where a block begins, and with it what is open inside it."""
        if not self.names["p"]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == "p":
                self._cut(i)
                return
            if self.open[i][0] in BLOCKS or self.open[i][0] in ASIDE:
                return

    def _pop(self, own: set[str], until: set[str]) -> None:
        if not any(self.names[x] for x in own):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in until:
                return
            if self.open[i][0] in own:
                self.flush()
                self._cut(i)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or not self.names[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if tag in BLOCKS or tag in ASIDE or tag in UNSEEN:
                    self.flush()
                self._cut(i)
                return
            if tag not in BLOCKS and tag not in ASIDE and self.open[i][0] in BLOCKS:
                return  # a stray inline end tag ends no block

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "path"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        hidden, link, _, _ = self._state()
        if not hidden:
            self.held.append(data)
            if link:
                self.linked += len(data)

    def frame(self, at: int) -> int:
        """The innermost article, or else main, around a container; -1 for none."""
        return self.frames["article"][at] if self.frames["article"][at] >= 0 else self.frames["main"][at]

    def _lines(self, mark: int) -> Iterator[int]:
        while mark >= 0:
            yield mark
            mark = self.marks[mark][1]

    def settle(self) -> None:
        """Keep the blocks outside marked elements.

        A marked element is none if it holds the first main, or else the first
        article; if there is neither, and its mark is part of a name, if it holds
        most of the text; and in any case if nothing is left without it.
        """
        shown = set()
        if self.around:
            shown.update(self._lines(self.around.get("main", self.around.get("article", -1))))
        elif self.marks:
            held = [0] * len(self.marks)
            for _, text, _, mark in self.found:
                if mark >= 0:
                    held[mark] += len(text)
            for mark in range(len(held) - 1, -1, -1):  # inner ones come after the outer
                if (up := self.marks[mark][1]) >= 0:
                    held[up] += held[mark]
            most = sum(len(text) for _, text, _, _ in self.found) / 2
            shown.update(m for m, (kind, _) in enumerate(self.marks) if kind == "part" and held[m] > most)
        # the elements that hide what is in them
        hides: list[bool] = []
        for mark, (_, up) in enumerate(self.marks):
            hides.append(mark not in shown or up >= 0 and hides[up])
        kept = [x for x in self.found if x[3] < 0 or not hides[x[3]]] or self.found
        for at, text, gain, _ in kept:
            self.blocks.append((at, text))
            self.scores[at] = self.scores.get(at, 0.0) + gain


def parse(html: str) -> _Page:
    page = _Page()
    page.feed(html)
    if re.match("<[a-zA-Z/!?]", page.rawdata):  # a tag that the end of the page cuts off
        page.rawdata = ""
    page.close()
    page.flush()
    page.settle()
    return page


class Vote(NamedTuple):
    """What a page, or all pages of a host, say about one path."""

    wide: int  #: the path of the article or main around it, or the path itself
    framed: bool  #: whether there is one
    depth: int
    score: float  #: of all that stands in its containers, at any depth
    own: float  #: of its own blocks
    pages: int


def votes(page: _Page) -> dict[int, Vote]:
    """The page's vote on each path; in ``score``, containers full of links add nothing."""
    total = [0.0] * len(page.paths)
    for at, score in page.scores.items():
        total[at] = max(0.0, score)
    found: dict[int, Vote] = {}
    for at in range(len(page.paths) - 1, -1, -1):  # children come after their parents
        if (up := page.parents[at]) >= 0:
            total[up] += total[at]
        if total[at] or at == 0 or at in page.scores:
            frame = page.frame(at)
            path, own = page.paths[at], page.scores.get(at, 0.0)
            old = found.get(path)
            found[path] = Vote(
                page.paths[frame if frame >= 0 else at], frame >= 0, page.depths[at],
                total[at] + (old.score if old else 0.0), own + (old.own if old else 0.0), 1,
            )
    return found


def best(found: dict[int, Vote]) -> Vote:
    """The deepest path that holds nearly all of the text; the whole page if all of it is links."""
    most = max(v.score for v in found.values())
    if most <= 0:
        return min(found.items(), key=lambda x: (x[1].depth, x[0]))[1]
    enough = [(path, v) for path, v in found.items() if v.score >= NEARLY_ALL * most]
    return min(enough, key=lambda x: (-x[1].depth, -x[1].score, x[0]))[1]


def extract(page: _Page, wide: int | None, framed: bool | None, links: frozenset[int]) -> str:
    """The text by the host's winning path ``wide``, or by the page's own best one if it has nothing there.

    ``links`` are the paths that the host's pages hold for lists of links.
    """
    choices = [] if wide is None else [(wide, framed)]
    for wanted, in_frame in (*choices, best(votes(page))[:2]):
        inside = [False] * len(page.paths)
        for i, p in enumerate(page.paths):  # parents come before their children
            inside[i] = p == wanted or page.parents[i] >= 0 and inside[page.parents[i]]
        if not any(inside[at] for at, _ in page.blocks):
            continue
        if not in_frame:
            inside = [
                x or page.scores.get(at, 0.0) > 0 and page.paths[at] not in links for at, x in enumerate(inside)
            ]
        return "\n".join(text for at, text in page.blocks if inside[at])
    return ""


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^:]*://([^/?#]*)", 1)
    return F.lower(host)


_VOTES = pa.schema([
    ("host", pa.string()), ("path", pa.int64()), ("wide", pa.int64()), ("framed", pa.bool_()), ("depth", pa.int32()),
    ("score", pa.float64()), ("own", pa.float64()), ("pages", pa.int64()),
])


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[tuple[str, int], Vote] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
            for path, vote in votes(parse(html.as_py() or "")).items():
                old = sums.get((host, path))
                sums[host, path] = vote if old is None else old._replace(
                    score=old.score + vote.score, own=old.own + vote.own, pages=old.pages + 1
                )
        columns = zip(*((*key, *vote) for key, vote in sums.items()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _VOTES)], schema=_VOTES)


def host_paths(pages: DataFrame) -> DataFrame:
    """host, its winning path (wide, framed) and the paths that are lists of links on it."""
    rows = pages.select(host_of(F.col("url")).alias("host"), "html").filter(F.col("html").isNotNull())
    voted = ragged.map_in_arrow(
        rows, _vote,
        "host string, path long, wide long, framed boolean, depth int, score double, own double, pages long",
    )
    # rounded, so that the order of summing decides nothing
    summed = cut_lineage(voted.groupBy("host", "path", "wide", "framed", "depth").agg(
        F.round(F.sum("score"), 3).alias("score"), F.round(F.sum("own"), 3).alias("own"), F.sum("pages").alias("pages")
    ))
    # every page votes on its root, which has all of its text
    totals = summed.groupBy("host").agg(F.max("score").alias("_most"), F.max("pages").alias("_all"))
    known = summed.join(totals, "host")
    # the deepest path that holds nearly all of the text, as in ``best``
    deep = F.when(F.col("_most") > 0, -F.col("depth")).otherwise(F.col("depth"))
    order = Window.partitionBy("host").orderBy("_deep", F.desc("score"), "path")
    enough = known.filter(F.col("score") >= NEARLY_ALL * F.col("_most")).withColumn("_deep", deep)
    winners = enough.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").select("host", "wide", "framed")
    listed = known.filter((F.col("own") < 0) & (F.col("pages") * COMMON >= F.col("_all")))
    links = listed.groupBy("host").agg(F.collect_set("path").alias("links"))
    return winners.join(links, "host", "left")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    id_type = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [
                    extract(parse(html.as_py() or ""), wide.as_py(), framed.as_py(), frozenset(links.as_py() or ()))
                    for html, wide, framed, links in zip(*(part.column(x) for x in ("html", "wide", "framed", "links")))
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(x) for x in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    salt = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SALTS)).cast("int")
    named = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"), salt.alias("_salt"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    paths = host_paths(pages).select("host", "wide", "framed", "links", salts)
    placed = named.join(paths, ["host", "_salt"], "left").select("page_id", "url", "html", "wide", "framed", "links")
    return ragged.map_in_arrow(placed, run, f"page_id {id_type}, url string, text string, n_chars long")
