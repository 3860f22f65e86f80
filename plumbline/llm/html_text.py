"""Main text of web pages: differencing against the page with the nearest url of the host, then structure."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from html import escape, unescape
from itertools import groupby
from math import ceil

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Query, body, col, in_batches, table

#: Bytes of html that a task sorts.
TASK_BYTES = 64_000_000

# Names of HTML elements, and words of class, id and role attributes that name what is not the article.
RAW = frozenset("script style noscript template iframe textarea title noembed noframes".split())
LEFT_OUT = frozenset("nav footer aside form button select menu dialog svg canvas object audio video map head".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "tfoot thead tr ul xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pagination pager "
    "popup promo promoted related replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split())

_TOKEN = regex.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", regex.S)
_ATTRIBUTE = regex.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", regex.I)
_WORD = regex.compile(r"[a-z0-9]+")
#: Names that say what a page or wrapper has or lacks, not what it is.
_ABOUT = regex.compile(r"(?:has|have|with|without|no|not|hide|show)[-_]")


def _marked(name: str, value: str) -> bool:
    """Whether a class or id names what is not the article; of an article only whole names count, not parts of one."""
    for word in value.split():
        if word in MARKS or (name != "article" and not _ABOUT.match(word) and not MARKS.isdisjoint(_WORD.findall(word))):
            return True
    return False


def _unwanted(name: str, rest: str, within: int, forms: bool = False) -> bool:
    """Whether an element is left out. The header of an article is part of it."""
    if name in LEFT_OUT and not (forms and name == "form") or (name == "header" and not within):
        return True
    # Whole pages carry all sorts of words in their classes.
    for m in _ATTRIBUTE.finditer(rest) if name not in ("html", "body", "main") else ():
        value = unescape(m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in ROLES:
                return True
        elif _marked(name, value):
            return True
    return False


def lines(html: str) -> tuple[list[str], bool]:
    """The text blocks of a page without what structure shows to be no part of the article, and whether it marks the article."""
    found, sure = blocks(html)
    return [t for t, shown in found if shown], sure


def blocks(html: str) -> tuple[list[tuple[str, bool]], bool]:
    """All text blocks of a page, whether structure admits each as part of the article, and whether the page marks the article.

    If the page has ``article`` or ``main`` elements with text, only the blocks in them are admitted. Articles that are left
    out themselves or lie in an element that is, like comments, count where the page has no others; where all text of a page
    lies in forms, they are not left out.
    """
    found, missed = _blocks(html)
    if not any(inside for _, inside, _ in found) and missed:
        revealed = _blocks(html, reveal=True)[0]
        if any(inside for _, inside, _ in revealed):
            found = revealed
    if any(inside for _, inside, _ in found):
        return [(t, inside) for t, inside, _ in found], True
    if not any(shown for _, _, shown in found) and "<form" in html.lower():
        found = _blocks(html, forms=True)[0]
    return [(t, shown) for t, _, shown in found], False


def _blocks(html: str, reveal: bool = False, forms: bool = False) -> tuple[list[tuple[str, bool, bool]], bool]:
    """The text blocks of a page, whether each is shown in an article, whether it is shown at all, and whether an article was left out.

    An element that holds the ``main`` element is not left out, with ``reveal`` neither is one that is or holds an article.
    """
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # name, left out, article
    hidden = within = at = 0
    missed = False
    text: list[str] = []
    left: list[str] = []  # of the block, what is left out

    def close() -> None:
        for part, shown in ((text, True), (left, False)):
            if part:
                block = " ".join(unescape("".join(part)).split())
                if block:
                    out.append((block, shown and within > 0, shown))
                part.clear()

    def pop() -> None:
        nonlocal hidden, within
        _, a, b = stack.pop()
        hidden -= a
        within -= b

    while m := _TOKEN.search(html, at):
        if m.start() > at:
            (left if hidden else text).append(html[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in RAW and not m["end"]:
            stop = regex.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", regex.I).search(html, at)
            at = stop.end() if stop else len(html)
            continue
        if name == "xmp" and not m["end"]:  # text without markup
            stop = regex.compile(r"</xmp(?=[\s/>])[^>]*(?:>|\Z)", regex.I).search(html, at)
            close()
            (left if hidden else text).append(escape(html[at:stop.start() if stop else len(html)]))
            close()
            at = stop.end() if stop else len(html)
            continue
        if name in BLOCKS:
            close()
        elif name in ("br", "td", "th", "img"):
            text.append(" ")
            left.append(" ")
        if m["end"]:
            if any(name == s[0] for s in stack):
                while stack[-1][0] != name:
                    pop()
                pop()
        elif name not in VOID and not (m["rest"] or "").endswith("/"):
            if name == "body":  # the head ends here at the latest
                while stack and stack[-1][0] != "html":
                    pop()
            article = name in ("article", "main")
            unwanted = _unwanted(name, m["rest"] or "", within, forms)
            if article and not within and (hidden or unwanted):
                if reveal or (name == "main" and not unwanted):
                    stack[:] = [(n, False, a) for n, _, a in stack]
                    hidden, unwanted = 0, False
                    text.clear()
                else:
                    missed = True
            if name in ("p", "li", "option", "dd", "dt", "tr", "td", "th") and stack and stack[-1][0] == name:
                pop()
            stack.append((name, unwanted, article and not unwanted))
            hidden += unwanted
            within += article and not unwanted
    (left if hidden else text).append(html[at:])
    close()
    return out, missed


def shared(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of two lists of lines.

    Common ends are taken off; for the rest, one number per line of ``a`` holds a row of the table as bits, in which
    a zero is a place where the length grows.
    """
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    found = {*range(lo), *range(len(a) - hi, len(a))}
    x, y = a[lo:len(a) - hi], b[lo:len(b) - hi]
    where: dict[str, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    row, rows = full, []
    for line in x:
        u = row & where.get(line, 0)
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    i, j = len(x), len(y)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                found.add(lo + i)
                j -= 1
    return found


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _own(page: dict, near: list[dict | None]) -> tuple[str, int, int]:
    """The text of a page, given the pages of the paths before and after it, and how many of its blocks it shares and gets back.

    All blocks, menus and the like included, are compared with those of the nearest page of the host; what both share is
    deleted. Then structure is heard: what it leaves out goes too, and what lies in a marked article comes back. A page
    without such marks of which nothing would be left is a copy, which the other neighbour may tell from the template.
    """
    host = [p for p in near if p is not None and p["host"] == page["host"]]
    host.sort(key=lambda p: -_common(p["path"], page["path"]))
    texts, shown = page["texts"], page["shown"]
    gone: set[int] = set()
    for i, p in enumerate(host):
        found = shared(texts, p["texts"])
        gone = found if not i else gone
        if page["sure"] or any(s and n not in found for n, s in enumerate(shown)):
            gone = found
            break
    back = gone if page["sure"] or all(n in gone for n, s in enumerate(shown) if s) else set()
    kept = [t for n, t in enumerate(texts) if shown[n] and (n not in gone or n in back)]
    return "\n".join(kept), len(gone), sum(shown[n] for n in back)


def _ranges(keys: DataFrame, n: int) -> tuple[list[tuple[str, str]], dict[int, int]]:
    """Borders (host, path) of about ``n`` ranges of rows, and the parts into which a range of one frequent path is dealt.

    They follow from a sample of rows of bounded size, those with the least hashes; it only decides which task has a row.
    """
    sample = sorted((r.host, r.path) for r in keys.orderBy("hash").limit(100 * n).select("host", "path").collect()) if n > 1 else []
    cuts = [sample[len(sample) * i // n] for i in range(1, n)] if sample else []
    # A path that is several cuts is a range of its own; no path but it lies before its successor.
    borders = sorted({*cuts, *((h, p + "\0") for (h, p) in cuts if cuts.count((h, p)) > 1)})
    return borders, {bisect_right(borders, c): cuts.count(c) for c in set(cuts) if cuts.count(c) > 1}


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", task_bytes: int = TASK_BYTES) -> DataFrame:
    """The id, the url, ``text``, ``n_chars``, ``n_shared`` and ``n_restored`` of every row.

    Every page is compared with the nearest page of another path of its host: of the paths before and after its own in
    order the one with the longer common beginning, and of that path's rows the one with the least id, nulls last. Blocks of their longest common
    subsequence, ``n_shared`` of them, are deleted. Structure has the last word: menus, adverts and the like go even if no
    other page has them, and where a page marks its article by ``article`` or ``main`` elements, only blocks in them stay
    and ``n_restored`` shared ones come back: what an article shares with another page, a common line or a whole copy,
    still belongs to it. So do the blocks of an unmarked page whose neighbours are copies of it.

    Pages are dealt to tasks by ranges of host and path, so a host's pages may span any number of tasks, and those of a
    frequent path too; the pages that a range needs from those beside it are sent to both, so results do not depend on ranges.

    A null html is empty and gives the empty text, a null url belongs to an empty host; ids may be null or repeat, and
    every row gives one row. Rows of the same path are not compared with each other.
    """
    rows = pages.select(col(id_col).alias("id"), col(url_col).alias("url"), body(html_col).alias("html"))
    address = F.regexp_replace(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.\-]*://", "")
    rows = rows.withColumns({"host": F.substring_index(F.substring_index(address, "/", 1), ":", 1),
                             "path": F.regexp_replace(address, r"^[^/]*", ""), "hash": F.xxhash64("id", "url")})
    total = pages.select(F.sum(F.octet_length(body(html_col)))).first()[0] or 0
    n = max(1, ceil(total / task_bytes))
    borders, parts = _ranges(rows, n)

    @F.pandas_udf("int")
    def number(host: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(borders, x) for x in zip(host, path)], dtype="int32")

    place = number("host", "path") if borders else F.lit(0)
    dealt = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col("range")] if parts else F.lit(None).cast("int")
    rows = rows.withColumn("range", place).withColumn("part", F.coalesce(F.pmod("hash", dealt), F.lit(0)).cast("int"))
    # The first page of a path, from which the paths beside it in other ranges are told, is sent to those.
    path = F.struct("host", "path")
    ends = sorted((r.range, tuple(r.lo), tuple(r.hi)) for r in rows.groupBy("range").agg(
        F.min(path).alias("lo"), F.max(path).alias("hi")).collect()) if borders else []
    guests = [(r, q, *key) for (r, lo, hi), before, after in zip(ends, [None, *ends], [*ends[1:], None])
              for key in ([before[2]] if before else []) + ([after[1]] if after else [])
              for q in range(parts.get(r, 1)) if key[0] in (lo[0], hi[0])]
    guests += [(r, q, *lo) for r, lo, _ in ends if r in parts for q in range(parts[r])]
    rank = F.struct(F.col("id").isNull(), "id", F.col("url").isNull(), "url", F.xxhash64("html"), "html")
    if guests:
        wanted = F.broadcast(pages.sparkSession.createDataFrame(guests, "to_range int, to_part int, host string, path string"))
        first = rows.join(F.broadcast(wanted.select("host", "path").distinct()), ["host", "path"], "left_semi").groupBy("host", "path").agg(
            F.min(rank).alias("least"))
        sent = first.join(wanted, ["host", "path"]).select(
            "least.id", "least.url", "least.html", "host", "path", F.lit(None).cast("long").alias("hash"), F.col("to_range").alias("range"),
            F.col("to_part").alias("part"), F.lit(True).alias("guest"))
        rows = rows.withColumn("guest", F.lit(False)).unionByName(sent)
    else:
        rows = rows.withColumn("guest", F.lit(False))
    order = ["range", "part", "host", "path", F.desc("guest"), F.asc_nulls_last("id"), F.asc_nulls_last("url"), F.xxhash64("html")]
    # Twice as many tasks as ranges: with as many, two ranges often fall to one.
    ranged = rows.repartitionByRange(2 * (n + sum(parts.values())) if n > 1 else 1, "range", "part").sortWithinPartitions(*order)
    out = rows.select("id", "url").schema.add("text", "string").add("n_shared", "long").add("n_restored", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(out)

        def read() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    page = batch.slice(i, 1).to_pylist()[0]
                    found, page["sure"] = blocks(page.pop("html"))
                    page["texts"], page["shown"] = [t for t, _ in found], [s for _, s in found]
                    yield page

        done, held = [], 0
        before, paths = None, (list(g) for _, g in groupby(read(), lambda p: (p["range"], p["part"], p["host"], p["path"])))
        group = next(paths, None)
        while group is not None:
            after = next(paths, None)
            first = group[0]
            # Other ranges begin anew, with a guest of their own.
            near = [p for p in (before, after and after[0]) if p is not None and (p["range"], p["part"]) == (first["range"], first["part"])]
            for page in group:
                if page["guest"]:
                    continue
                text, n_shared, n_restored = _own(page, near)
                done.append({"id": page["id"], "url": page["url"], "text": text, "n_shared": n_shared, "n_restored": n_restored})
                held += len(text)
                if held > 4_000_000:
                    yield pa.RecordBatch.from_pylist(done, schema=shape)
                    done, held = [], 0
            before, group = first, after
        yield pa.RecordBatch.from_pylist(done, schema=shape)

    return in_batches(ranged, run, out).select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"), "n_shared", "n_restored")


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages").select("page_id", "url", "html"))


QUERY = Query("op8_html_text", op8)
