"""Main text of web pages by differencing with the page of the nearest URL.

A page is read into lines: its block elements, in order, with character references decoded and
white space joined. Pages of one host are put in order of their path, and each is paired with the
neighbour whose path shares the longer beginning. The lines of both are aligned by their longest
common subsequence, and shared lines are deleted: what a site repeats is not the text of a page.

Markup only follows: scripts, styles, forms and page furniture (by element, role or class) go even
if no neighbour repeats them. A neighbour that shares more than half of the characters of the page's
article elements is a copy of the page, not of its site: the lines within them then stay. Otherwise headings
and text stay there too, as articles may quote each other: of an article's shared lines those go that are
neither a heading nor a sentence and have few words, such as a link or a button.

A null html is empty and gives an empty text. A page whose url has no host, or that is alone on its
host, has no partner. Pages with equal urls are neighbours, in order of page_id. Rows that repeat
are judged each; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import html
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustmill.llm.ordering import OWN, in_order
from gustmill.llm.url_filters import host_of, path_of

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_WORDS = re.compile(r"[a-z0-9]+")

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = BLOCKS - set("p li dt dd h1 h2 h3 h4 h5 h6 hr td th tr tbody thead tfoot option caption legend pre".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of the longest shared line that an article loses, if it has no full stop.
LABEL_WORDS = 5
FURNITURE = {"nav", "footer", "aside", "form", "dialog", "menu", "head", "select"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu"}
# Words in a class or id that mark a container as page furniture.
MARKS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header menu modal nav navbar navigation newsletter notice popup promo promotion related "
    "share sharing sidebar social sponsor sponsored subscribe widget".split()
)


def _is_furniture(name: str, attributes: str, in_article: bool) -> bool:
    if name in FURNITURE or (name == "header" and not in_article):
        return True
    if not attributes:
        return False
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    if ROLES & set(found.get("role", "").split()) or "hidden" in attributes.lower().split():
        return True
    if name in ("article", "main", "body", "html"):
        return False
    return bool(MARKS & set(_WORDS.findall(found.get("class", "") + " " + found.get("id", ""))))


def page_lines(page: str) -> list[tuple[str, bool, bool, bool]]:
    """Lines of a page in order: text, whether furniture, whether within the article, whether a heading."""
    lines: list[tuple[str, bool, bool, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, furniture, article, each with what is around
    mains = False
    furniture = article = heading = False

    def end_line() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            lines.append((text, furniture, article, heading))

    at, size = 0, len(page)
    while at < size:
        tag = _TAG.search(page, at)
        if tag is None:
            parts.append(page[at:])
            break
        parts.append(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            if tag[0].startswith("<![CDATA["):
                parts.append(html.escape(tag[0][9:-3]))
            continue
        if name in RAW:
            if not tag[1] and not tag[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}[^>]*>", re.I).search(page, at)
                at = close.end() if close else size
            continue
        if name == "br":
            parts.append(" ")
            continue
        marked = not tag[1] and name not in BLOCKS and tag[3] and _is_furniture(name, tag[3], article)
        if name not in BLOCKS and not marked and not any(s[0] == name for s in stack):
            continue
        end_line()
        heading = name in HEADINGS and not tag[1]
        if name not in CONTAINERS and not marked and not (not tag[1] and _is_furniture(name, tag[3], article)):
            if not tag[1] or not any(s[0] == name for s in stack):
                continue
        if tag[1]:
            if any(s[0] == name for s in stack):
                while stack.pop()[0] != name:
                    pass
                furniture, article = stack[-1][1:] if stack else (False, False)
        elif not tag[3].endswith("/"):
            furniture = furniture or _is_furniture(name, tag[3], article)
            article = article or (name in ("article", "main") and not furniture)
            mains = mains or name == "article"
            stack.append((name, furniture, article))
    end_line()
    return lines


def shared_lines(one: list[str], two: list[str]) -> set[int]:
    """Places in ``one`` of a longest common subsequence of both, by bit vectors."""
    there, here = set(two), set(one)
    own = [i for i, line in enumerate(one) if line in there]
    other = [line for line in two if line in here]
    if not own:
        return set()
    masks: dict[str, int] = {}
    for j, line in enumerate(other):
        masks[line] = masks.get(line, 0) | 1 << j
    full = (1 << len(other)) - 1
    rows = [full]
    for i in own:
        vector = rows[-1]
        met = vector & masks[one[i]]
        rows.append((vector + met | vector - met) & full)
    found, i, j = set(), len(own), len(other)
    while i and j:
        bit = 1 << j - 1
        if rows[i] & bit:
            j -= 1
        elif not rows[i - 1] & bit:
            i -= 1
        else:
            i, j = i - 1, j - 1
            found.add(own[i])
    return found


def nearest(path: str, before: str | None, after: str | None) -> int:
    """0 for the page before, 1 for the one after, -1 for none."""
    if before is None or after is None:
        return 0 if before is not None else 1 if after is not None else -1
    return int(len(os.path.commonprefix((path, after))) > len(os.path.commonprefix((path, before))))


def _label(text: str) -> bool:
    """Whether a line is too short for a text, and no sentence."""
    return len(text.split()) <= LABEL_WORDS and not re.search(r"[.!?:;…][\"'”»)]*$", text)


def main_text(lines: list[tuple[str, bool, bool, bool]], partner: list[str] | None) -> list[str]:
    """The lines that are left, in order."""
    shared = shared_lines([line[0] for line in lines], partner) if partner else set()
    own = {i: len(text) for i, (text, furniture, article, _) in enumerate(lines) if article and not furniture}
    copied = 2 * sum(n for i, n in own.items() if i in shared) > sum(own.values())
    shared -= {i for i in own if copied or lines[i][3] or not _label(lines[i][0])}
    return [line[0] for i, line in enumerate(lines) if not line[1] and i not in shared]


LINES = "page_id bigint, url string, key string, host string, path string, part int, edge int, lines array<string>, flags array<int>"
OUT = "page_id bigint, url string, text string, n_chars bigint"


def _lines(pages: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                read = [page_lines(v.as_py()) for v in part.column(7)]
                lines = pa.array([[x[0] for x in page] for page in read], pa.list_(pa.string()))
                flags = pa.array([[x[1] + 2 * x[2] + 4 * x[3] for x in page] for page in read], pa.list_(pa.int32()))
                yield pa.record_batch([*part.columns[:-1], lines, flags], [f.split()[0] for f in LINES.split(", ")])

    return pages.select("page_id", "url", "key", "host", "path", "part", "edge", "html").mapInArrow(work, LINES)


def _keyed(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    page_id = F.col("page_id").cast("bigint")
    parts = pages.select(
        page_id.alias("page_id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    key = F.concat_ws("\x01", "host", "path", F.lpad(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 20, "0"))
    return parts.select("page_id", "url", key.alias("key"), "host", "path", "html")


def extracted(pages: DataFrame, joint: str = "\n") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, with ``joint`` between blocks."""
    # The pages are dealt by their urls and read on their way, once.
    rows = in_order(_keyed(pages), False, _lines).select("part", "edge", "page_id", "url", "host", "path", "lines", "flags")

    def result(before, row, after) -> tuple:
        lines = [(t, bool(f & 1), bool(f & 2), bool(f & 4)) for t, f in zip(row[6], row[7], strict=True)]
        sides = [x if x is not None and x[0] == row[0] and x[4] == row[4] and row[4] else None for x in (before, after)]
        chosen = nearest(row[5], *[x[5] if x else None for x in sides])
        text = joint.join(main_text(lines, sides[chosen][6] if chosen >= 0 else None))
        return row[2], row[3], text, len(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = row = None
        done: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [[], [], [], []]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in OUT.split(", ")])

        for batch in batches:
            for after in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if row is not None and row[1] == OWN:
                    done.append(result(before, row, after))
                before, row = row, after
            yield batch_of()
            done = []
        if row is not None and row[1] == OWN:
            done.append(result(before, row, None))
            yield batch_of()

    return rows.mapInArrow(work, OUT)
