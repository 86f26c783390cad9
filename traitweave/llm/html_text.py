"""HTML extraction by nearest-URL page differencing.

Pages of a host are put in the order of their URL paths; each is paired with the neighbour whose path shares the longer
beginning. Both are lines of text (blocks), the lines are aligned by longest common subsequence, and those that both
share are deleted as the site's template. The markup is a second witness: lines in menus, footers, forms, adverts and
the like never count. Where a page marks its article, its lines are those in it; one of them that is aligned with a
line which its neighbour has outside the article is template all the same, and one that both articles share is a
quotation or a copy and stays.

At scale: pages are parsed where they are read, and only their lines, packed page by page, are sorted, by range of
(host, path), so that a large host spreads over tasks. A task knows both neighbours of each page but its first and its
last; these two, with their neighbours inside, are finished afterwards with the last page of the task before and the
first of the one after. So the text of a page depends on its neighbours alone, not on the size of its host or on the
number of tasks.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitweave.llm.common import cut, slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|template|noscript|textarea|iframe|svg|object|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-z][^>]*>|(?P<text>[^<]+|<)",
    re.I | re.S,
)
WORD = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var wbr img".split()
)
SKIPPED = frozenset("head nav footer aside form menu dialog button figcaption audio video canvas map".split())
MAIN = frozenset(("article", "main"))
#: Words of class, id or role that name something else than the text.
BOILERPLATE = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments complementary consent"
    " contentinfo cookie cookies dialog disqus footer masthead menu modal nav navbar navigation newsletter notice notices"
    " pager pagination popup promo promotion related search share sharing sidebar social sponsor sponsored subscribe"
    " toolbar widget".split()
)
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())
LISTS = frozenset("ul ol dl table article main section div body".split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of `pages`: id, url, text (blocks joined by one space; empty if none).

    Null html is empty; a null or odd url belongs to the host of no name. Equal urls are neighbours, in the order of
    their ids. A page that is alone on its host, or all of whose lines both neighbours share, keeps what the markup
    leaves. Other columns are not read.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    # lines hold no line feed, so they travel as one packed text, and whether each is in the article as one of 0 and 1
    page = f"id {kind}, url string, host string, path string, lines binary, inside string"
    order = ["host", "path", "id", "url"]
    parsed = rows.mapInArrow(_parse, page).repartitionByRange(*order).sortWithinPartitions(*order)
    near = "near_path string, near_lines binary, near_inside string"
    done = parsed.withColumn("part", F.spark_partition_id()).mapInArrow(_texts, f"{page}, text string, part int, edge string, {near}")
    done = cut(done, codec="zstd")
    inner = done.filter("edge IS NULL").select("id", "url", "text")

    edges = done.filter("edge IS NOT NULL")
    # the numbers of the tasks that had pages, in order: as many rows as there are tasks
    parts = sorted(r["part"] for r in edges.select("part").distinct().collect())
    places = spark.createDataFrame([(p, i) for i, p in enumerate(parts)], "part int, place int")
    edges = edges.join(F.broadcast(places), "part")
    whole = ["host", "path", "lines", "inside"]
    ends = edges.filter("edge <> 'first'").select((F.col("place") + 1).alias("place"), F.struct(*whole).alias("before"))
    starts = edges.filter("edge <> 'last'").select((F.col("place") - 1).alias("place"), F.struct(*whole).alias("after"))
    outer = edges.join(ends, "place", "left").join(starts, "place", "left")
    return inner.union(outer.select(*edges.columns, "before", "after").mapInArrow(_edge_texts, inner.schema))


def lines(html: str) -> tuple[list[str], list[bool]]:
    """The blocks of a page outside boilerplate, and whether each lies in the page's article."""
    out: list[str] = []
    inside: list[bool] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, skipped, in an article
    words: list[str] = []

    def end_block() -> None:
        if words:
            text = " ".join("".join(words).split())
            words.clear()
            if text:
                out.append(text)
                inside.append(bool(stack) and stack[-1][2])

    for m in TOKEN.finditer(html):
        text = m["text"]
        if text is not None:
            if not stack or not stack[-1][1]:
                words.append(unescape(text))
            continue
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            end_block()
        if m["end"]:
            if any(t == tag for t, _, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag in VOID:
            continue
        if tag not in INLINE and any(t == "p" for t, _, _ in stack[-3:]) or tag in CLOSED_BY_SAME:
            _close(stack, tag if tag in CLOSED_BY_SAME else "p")
        skipped, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        rest = m["rest"]
        article = article or tag in MAIN
        if tag in SKIPPED or (tag == "header" and not article):
            skipped = True
        elif rest and not skipped:
            named = {w for v in WORD.findall(rest) for w in re.split(r"[^a-z0-9]+", v.lower())}
            skipped = not BOILERPLATE.isdisjoint(named) and tag != "body" or bool(re.search(r"\bhidden\b(?!\s*=\s*.?false)", rest))
            article = article or "main" in named and "role" in rest
        if not rest.endswith("/"):
            stack.append((tag, skipped, article))
    end_block()
    return out, inside


def _close(stack: list[tuple[str, bool, bool]], tag: str) -> None:
    """An open element that a new one ends without an end tag."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == tag:
            del stack[i:]
            return
        if stack[i][0] in LISTS:
            return


def common_lines(a: list[str], b: list[str]) -> dict[int, int]:
    """Places in `a` of a longest common subsequence with `b`, and their places in `b` (Hunt and Szymanski)."""
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple | None] = []
    for i, line in enumerate(a):
        for j in places.get(line, ()):
            k = bisect_left(ends, j)
            link = (i, j, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    found: dict[int, int] = {}
    link = links[-1] if links else None
    while link:
        found[link[0]] = link[1]
        link = link[2]
    return found


def own_text(page: tuple[list[str], list[bool]], neighbours: list[tuple[list[str], list[bool]]]) -> str:
    """The lines of a page without its template, as told by the first neighbour that leaves any line."""
    text, inside = page
    marked = any(inside)
    for other, other_inside in neighbours:
        shared = common_lines(text, other)
        if marked:
            own = [i for i in range(len(text)) if inside[i] and (i not in shared or other_inside[shared[i]] or not any(other_inside))]
        else:
            own = [i for i in range(len(text)) if i not in shared]
        if own:
            return " ".join(text[i] for i in own)
    return " ".join(x for x, within in zip(text, inside, strict=True) if within or not marked)


def _alike(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "html"):
            found = [lines(html) for html in rows.column("html").to_pylist()]
            columns = [rows.column(c) for c in ("id", "url", "host", "path")]
            columns.append(pa.array([zlib.compress("\n".join(x).encode(), 1) for x, _ in found], pa.binary()))
            columns.append(pa.array(["".join("1" if i else "0" for i in x) for _, x in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "host", "path", "lines", "inside"])


def _unpacked(page: dict) -> tuple[list[str], list[bool]]:
    """The lines of a page as `lines` gives them."""
    text = zlib.decompress(page["lines"]).decode()
    return text.split("\n") if page["inside"] else [], [x == "1" for x in page["inside"]]


def _page_text(page: dict, before: dict | None, after: dict | None) -> str:
    near = [p for p in (before, after) if p and p["host"] == page["host"]]
    near.sort(key=lambda p: -_alike(p["path"], page["path"]))
    return own_text(_unpacked(page), [_unpacked(p) for p in near])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each page of a task from its two neighbours; its first and last page as they are."""
    before = now = schema = None
    out: list[dict] = []

    def finish(after: dict | None) -> None:
        row = {"id": now["id"], "url": now["url"], "part": now["part"]}
        if before and after:
            row["text"] = _page_text(now, before, after)
        else:
            near = before or after
            row |= {c: now[c] for c in ("host", "path", "lines", "inside")}
            row["edge"] = "last" if before else "first" if after else "only"
            if near and near["host"] == now["host"]:
                row |= {f"near_{c}": near[c] for c in ("path", "lines", "inside")}
        out.append(row)

    def rows() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(out, schema)
        out.clear()
        return batch

    for batch in batches:
        if schema is None:
            names = ("url", "host", "path", "lines", "inside", "text", "part", "edge", "near_path", "near_lines", "near_inside")
            kinds = {"part": pa.int32(), "lines": pa.binary(), "near_lines": pa.binary()}
            schema = pa.schema([("id", batch.schema.field("id").type), *((c, kinds.get(c, pa.string())) for c in names)])
        for start in range(0, batch.num_rows, 200):
            for after in batch.slice(start, 200).to_pylist():
                if now:
                    finish(after)
                before, now = now, after
            if out:
                yield rows()
    if now:
        finish(None)
        yield rows()


def _edge_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the first and last pages of the tasks."""
    for batch in batches:
        kind = batch.schema.field("id").type
        for start in range(0, batch.num_rows, 50):
            part = batch.slice(start, 50).to_pylist()
            texts = []
            for row in part:
                inner = None
                if row["near_path"] is not None:
                    inner = {"host": row["host"], **{c: row[f"near_{c}"] for c in ("path", "lines", "inside")}}
                before = inner if row["edge"] == "last" else row["before"]
                after = inner if row["edge"] == "first" else row["after"]
                texts.append(_page_text(row, before, after))
            columns = [pa.array([r["id"] for r in part], kind), pa.array([r["url"] for r in part], pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text"])
