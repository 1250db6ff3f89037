"""Main text of web pages by line-block distribution (operator 8).

Markup is stripped so that every block element is a line of its own; what menus, forms, scripts and the like contain
leaves no line. Runs of empty lines are where such a part was and around containers of nothing but links. Class, id
and role names tell other parts only as whole names, and never headings, articles or what holds the main part; names
that are words of articles as well need further evidence in an article. What is dropped within a line leaves the rest of the
line together. Text lengths outside links are summed over sliding windows of lines: a surge is where a window comes above zero, the dive where one
falls back to zero. The text between a surge and its dive is kept if its largest window reaches a quarter of the
page's largest. Where the page marks an article (or else its main part, by element or by a name like "content"),
only lines in it have a length; there a line of nothing but links counts as one character, elsewhere as none.

Character references are decoded, white space inside a block becomes one space, blocks are joined by line ends.
A line break element counts as white space. Null html counts as empty; a page without main text gives the empty
string. Unclosed elements end with the page, unclosed scripts and comments too. Repeated rows and null ids are
treated like any other row. An empty table gives an empty result. Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from videonet.llm.common import arrow_map, slices, table
from videonet.llm.registry import query

WINDOW_LINES = 3
LEAST_SHARE = 0.25
BATCH_BYTES = 4 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg|object|select)(?=[\s/>])[^<>]*+(?<!/)>"
    r".*?(?:</(?P=raw)\s*+>|\Z)"
    # Outside of quotes a tag ends before the next one begins, and nothing is tried twice, so reading is linear.
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?][^<>]*+>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)

PARAGRAPHS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd table tbody thead tfoot tr td th caption blockquote pre figcaption"
    " address summary legend hr".split()
)
CONTAINERS = frozenset(
    "html head body figure details center header".split()
)
DROPPED = frozenset("nav footer aside form button dialog menu".split())
#: Elements that end a line; all others are part of one.
BLOCKS = PARAGRAPHS | CONTAINERS | DROPPED - {"button"} | frozenset("article div fieldset main section".split())
#: Ends at the next element of the same name, as these cannot be nested.
NOT_NESTED = frozenset("p li dt dd tr td th".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Class, id or role names that tell parts other than the article, as whole names.
OTHER_PARTS = frozenset(
    "ad ads adv advert advertisement advertisements adverts sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs comment"
    " comments disqus replies reply related recommended share sharing social newsletter subscribe subscription login"
    " signup search footer copyright pagination pager complementary contentinfo skip widget alert disclaimer feedback"
    " adbox adslot adsbygoogle sidenav topnav".split()
)
#: Names of two words that do so as well.
OTHER_COMPOUNDS = frozenset(
    f"{part}-{box}"
    for part in "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer"
    " gdpr menu nav navigation newsletter pagination popup promo related reply share sharing social sponsored"
    " subscribe subscription".split()
    for box in "area articles banner bar block box buttons container form icons items links list notice popup posts"
    " section signup slot unit widget wrap wrapper".split()
) | frozenset(
    f"{owner}-{part}" for owner in "main page primary secondary site user".split()
    for part in "comments footer menu nav navigation".split()
) | frozenset(("sidebar-widget", "skip-link", "disqus-thread"))
#: Names that are words of articles as well: there such an element goes only if all its text is links, if it holds
#: parts of a form, or if it is a list.
WEAK_PARTS = frozenset("share search menu notice alert skip feedback related".split())
FORM_PARTS = frozenset("form input button select textarea".split())
OTHER_OUTSIDE_ARTICLE = frozenset("header masthead topbar site-header page-header".split())
#: Elements that are never another part by their name, but for articles that hold a comment.
NEVER_OTHER = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
COMMENTS = frozenset("comment comments reply replies".split())
#: Class, id or role names of a container that holds the page's main part.
MAIN_PARTS = frozenset("article content entry main post story articlebody maincontent".split()) | frozenset(
    f"{part}-{inner}" for part in "article blog entry main news page post site story".split()
    for inner in "area body content main text".split()
)


class _Page:
    """Lines of a page, with their lengths outside links and whether they lie in an article or main part."""

    def __init__(self):
        self.lines: list[str] = []
        self.lengths: list[int] = []
        self.parts: list[int] = []  # 2 in an article, 1 in the main part
        self._texts: list[str] = []
        self._linked = 0
        self.article = self.main = self.link = 0
        self.links = self.forms = 0
        self.worded = 0  # texts with a letter or digit outside links
        self._long = 0  # lines with a length
        # Open containers without a meaning of their own: do they hold the main part, lines, links and lengths before them.
        self.boxes: list[tuple[bool, int, int, int]] = []
        # Open elements of weak names: where they end, and what was there before them.
        self.doubtful: list[tuple] = []

    def text(self, text: str) -> None:
        self._texts.append(text)
        if self.link:
            self._linked += len("".join(html.unescape(text).split()))
        elif self.doubtful and any(map(str.isalnum, text)):
            self.worded += 1

    def doubt(self, end: int, is_list: bool) -> None:
        """An element that may be another part begins."""
        self.doubtful.append((
            end, is_list, len(self.lines), len(self._texts), self._linked, self.links, self.forms, self.worded, self._long))

    def settle(self, place: int) -> None:
        """Drop those elements that ended before `place` and were other parts."""
        while self.doubtful and self.doubtful[-1][0] <= place:
            _, is_list, lines, texts, linked, links, forms, worded, long = self.doubtful.pop()
            only_links = self.links > links and self.worded == worded
            if not (is_list or only_links or self.forms > forms):
                continue
            if len(self.lines) > lines:  # a block, or something of several lines
                texts = linked = 0
            del self.lines[lines:], self.lengths[lines:], self.parts[lines:], self._texts[texts:]
            self._linked, self.worded, self._long = linked, worded, long

    def end_line(self) -> None:
        if self._texts:
            line = " ".join(html.unescape("".join(self._texts)).split())
            if line:
                self.lines.append(line)
                own = len(line) - line.count(" ") - self._linked
                self.lengths.append(max(1, own) if self.article or self.main else max(0, own))
                self._long += self.lengths[-1] > 0
                self.parts.append(2 if self.article else 1 if self.main else 0)
            self._texts, self._linked = [], 0

    def gap(self) -> None:
        """Empty lines where a part was dropped; an article is one part, whatever it contains."""
        self.end_line()
        if not (self.article or self.main):
            self.lines += [""] * WINDOW_LINES
            self.lengths += [0] * WINDOW_LINES
            self.parts += [0] * WINDOW_LINES

    def box(self, closing: bool, holds_main: bool) -> None:
        """Open or close a container; one of nothing but several links is a part of its own."""
        self.end_line()
        if not closing:
            self.boxes.append((holds_main, len(self.lines), self.links, self._long))
            self.main += holds_main
        elif self.boxes:
            held_main, first, links, long = self.boxes.pop()
            self.main -= held_main
            if self.links > links + 1 and self._long <= long and not (self.article or self.main):
                self.lines[first:first] = [""] * WINDOW_LINES
                self.lengths[first:first] = [0] * WINDOW_LINES
                self.parts[first:first] = [0] * WINDOW_LINES
                self.gap()


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), "".join(values))
    return found


def _names(attributes: dict[str, str], kinds: tuple[str, ...] = ("class", "id", "role")) -> set[str]:
    """Whole class, id and role names, their words joined by single hyphens."""
    return {
        re.sub("[-_]+", "-", name) for kind in kinds for name in attributes.get(kind, "").lower().split()
    }


def _is_hidden(attributes: dict[str, str]) -> bool:
    return ("hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
            or _NO_DISPLAY.search(attributes.get("style", "")) is not None)


def _is_other(name: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether class, id or role names tell another part; the id of a section is the place of a heading."""
    if name == "article":
        return bool(_names(attributes) & COMMENTS)
    if name in NEVER_OTHER:
        return False
    names = _names(attributes, ("class", "role") if name == "section" else ("class", "id", "role"))
    if name == "section":
        names |= _names(attributes, ("id",)) & COMMENTS
    return bool(names & OTHER_PARTS or names & OTHER_COMPOUNDS) or (not inside and bool(names & OTHER_OUTSIDE_ARTICLE))


def _is_weak(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is told to be another part by weak names only."""
    names = _names(attributes, ("class", "role") if name == "section" else ("class", "id", "role"))
    return not names & OTHER_COMPOUNDS and names & OTHER_PARTS <= WEAK_PARTS


def _outline(page: str) -> tuple[list[int], dict[int, int]]:
    """Where the main part begins, and where each element ends, by the place where it begins.

    The main part is the page's main elements, or else its articles, or else containers so named. An element
    without an end ends with the page and is not listed.
    """
    found: tuple[list[int], ...] = ([], [], [])
    ends: dict[int, int] = {}
    still_open: dict[str, list[int]] = defaultdict(list)
    for token in _TOKEN.finditer(page):
        if token["name"] is None:
            continue
        name, start = token["name"].lower(), token.start()
        of_name = still_open[name]
        if of_name and (token["close"] or name in NOT_NESTED):
            ends[of_name.pop()] = start
        if token["close"]:
            continue
        if name in VOID or token["rest"].endswith("/"):
            ends[start] = start
        else:
            of_name.append(start)
        if name == "main":
            found[0].append(token.start())
        elif name == "article" and not _is_other(name, _attributes(token["rest"]), False):
            found[1].append(token.start())
        elif name in ("div", "section") and _names(_attributes(token["rest"])) & MAIN_PARTS:
            found[2].append(token.start())
    return next((starts for starts in found if starts), []), ends


def stripped(page: str) -> _Page:
    """The page without markup, scripts and parts that are not text of an article."""
    out = _Page()
    skipped, depth = "", 0
    at = 0
    known: tuple[list[int], dict[int, int]] | None = None

    def outline() -> tuple[list[int], dict[int, int]]:
        nonlocal known
        if known is None:
            known = _outline(page)
        return known

    def holds_main(start: int) -> bool:
        """Whether the element holds the whole main part."""
        starts, ends = outline()
        return bool(starts) and start < starts[0] and ends.get(start, len(page)) > starts[-1]

    for token in _TOKEN.finditer(page):
        if not depth and token.start() > at:
            out.text(page[at:token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            out.forms += token["raw"] is not None and token["raw"].lower() in FORM_PARTS
            continue
        name, closing = name.lower(), bool(token["close"])
        if depth:
            if name == skipped:
                if not closing and name in NOT_NESTED:
                    depth = 0
                elif closing or not token["rest"].endswith("/"):
                    depth += -1 if closing else 1
            if depth:
                continue
            if closing:
                continue
        if out.doubtful and out.doubtful[-1][0] <= token.start():
            if name in BLOCKS:
                out.end_line()
            out.settle(token.start())
        opening = not closing and name not in VOID
        out.forms += not closing and name in FORM_PARTS
        attributes = _attributes(token["rest"]) if opening and token["rest"] else {}
        other = bool(attributes) and _is_other(name, attributes, out.article > 0)
        if other and out.article and name not in DROPPED and _is_weak(name, attributes) and not _is_hidden(attributes):
            other = False
            if name in BLOCKS:
                out.end_line()
            out.doubt(outline()[1].get(token.start(), len(page)), name in ("ul", "ol", "dl"))
        if opening and (
            name in DROPPED or (name == "header" and not out.article)
            or (attributes and name not in ("html", "body", "main") and _is_hidden(attributes))
            or (other and not holds_main(token.start()))
        ):
            if name in BLOCKS:
                out.gap()
            skipped, depth = name, 1
        elif name in ("article", "main"):
            out.end_line()
            setattr(out, name, max(0, getattr(out, name) + (-1 if closing else 1)))
        elif name in ("div", "section"):
            out.box(closing, not closing and bool(_names(attributes) & MAIN_PARTS))
        elif name in PARAGRAPHS:
            out.end_line()
        elif name in CONTAINERS:
            out.end_line()
        elif name == "a":
            out.link = max(0, out.link + (-1 if closing else 1))
            out.links += not closing
        elif name == "br":
            out.text(" ")
    if not depth and at < len(page):
        out.text(page[at:])
    out.end_line()
    out.settle(len(page))
    return out


def main_text(page: str | None) -> str:
    """The text between surges and dives of the page's line blocks, one block of the page a line."""
    out = stripped(page or "")
    if not out.lines:
        return ""
    level = max(out.parts)
    lengths = [n if part == level else 0 for n, part in zip(out.lengths, out.parts)]
    padded = lengths + [0] * (WINDOW_LINES - 1)
    blocks = [sum(padded[i:i + WINDOW_LINES]) for i in range(len(lengths))]
    runs, start = [], None
    for i, block in enumerate([*blocks, 0]):
        if block and start is None:
            start = i
        elif not block and start is not None:
            runs.append((max(blocks[start:i]), start, i))
            start = None
    least = LEAST_SHARE * max((peak for peak, _, _ in runs), default=0)
    return "\n".join(
        out.lines[i] for peak, first, last in runs if peak >= least for i in range(first, last)
        if out.lines[i] and out.parts[i] == level
    )


def _extract(batches):
    for batch in slices(batches, "html", BATCH_BYTES):
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return arrow_map(rows, _extract, "page_id long, url string, text string")


# The article element of the test pages, read with regular expressions: an answer found in another way.
SQL = r"""
WITH articles AS (
  SELECT page_id, url, regexp_replace(
    regexp_replace(coalesce(html, ''), '\s+', ' ', 'g'), '^.*<article>(.*)</article>.*$', '\1') AS a
  FROM pages),
plain AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(a, '<br>', ' ', 'g'),
    '</?(p|h1)>', chr(10), 'g'), '<[^>]*>', '', 'g') AS t FROM articles),
decoded AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'),
    '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS t FROM plain),
joined AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(string_split(t, chr(10)),
    lambda l: trim(regexp_replace(l, ' +', ' ', 'g'))), lambda l: l <> ''), chr(10)) AS text FROM decoded)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined
"""


@query("op8_main_text", SQL)
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
