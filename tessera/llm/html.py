"""Main text of web pages: nearest-URL page differencing over the lines that markup leaves open."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import partitions
from tessera.llm.urls import host, path

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/!?A-Za-z][^>]*>", re.S
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\bhidden\b|\bstyle\s*=\s*["'][^"']*display\s*:\s*none|\baria-hidden\s*=\s*["']?true""", re.I)

#: Fixed lists of HTML element names.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "input", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
LOOSE = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5", "h6"}
BOILER = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
#: Words of class, id and role that mark what is not the article.
MARKS = {
    "ad", "ads", "advert", "advertisement", "adverts", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}

#: Text that holds within ``article`` even where a page shares it: what stands directly in these or in ``LOOSE`` elements.
PROSE = {"blockquote", "dl", "figure", "ol", "pre", "table", "ul"}

#: Zones of a line: text of the article in such elements; other text in the article; outside of it, where markup tells nothing; not the article.
CORE, ARTICLE, OPEN, BOILERPLATE = 3, 2, 1, 0


def marked(rest: str) -> bool:
    """Whether an element's class, id or role names something besides the article, or the element is hidden."""
    if "=" not in rest:
        return False
    for m in ATTRIBUTE.finditer(rest):
        if not MARKS.isdisjoint(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", m[2] or m[3] or m[4] or "").lower())):
            return True
    return bool(HIDDEN.search(rest))


def lines(page: str) -> list[tuple[int, str]]:
    """(zone, text) of each block of text in page order: BOILERPLATE, ARTICLE, or CORE and OPEN where markup leaves it to differencing.

    Block elements end a block, inline ones and line breaks don't. Elements without their end tags are closed by the end of the
    container around them; stray end tags only end a block. An unclosed comment or script lasts to the end.
    """
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = []  # containers, with the zone before each
    zone, loose, prose, at, parts = OPEN, False, False, 0, []
    depth = 0  # of article and main

    def end() -> None:
        if parts:
            if text := " ".join(html.unescape("".join(parts)).split()):
                out.append((BOILERPLATE if loose else ARTICLE if prose and zone == CORE else zone, text))
            parts.clear()

    pos, n = 0, len(page)
    while pos < n:
        m = TOKEN.search(page, pos)
        if m is None:
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = pos = m.end()
        if (name := m["name"]) is None:
            continue
        name = name.lower()
        if name in RAW:
            if not m["close"]:
                if name in ("object", "noscript", "svg", "math"):
                    end()
                if not m["rest"].endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, pos)
                    at = pos = close.end() if close else n
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in INLINE:
            if not m["close"] and marked(m["rest"]) and name not in VOID:
                # an inline element that is marked: what it holds goes, up to its end tag
                close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, pos)
                if close and not re.search(r"<(?:p|div|article|section|main|h[1-6]|ul|table)\b", page[pos : close.start()], re.I):
                    at = pos = close.end()
            continue
        end()
        if name in VOID:
            continue
        if name in LOOSE:
            prose = not m["close"]
            loose = prose and marked(m["rest"])
            continue
        loose = prose = False
        if not m["close"]:
            if m["rest"].endswith("/"):
                continue
            stack.append((name, zone))
            if name in ("article", "main"):
                depth += 1
                zone = CORE if zone != BOILERPLATE and not marked(m["rest"]) else BOILERPLATE
            elif name in BOILER or name == "header" and not depth or name not in ("html", "body") and marked(m["rest"]):
                zone = BOILERPLATE
            elif name in PROSE and zone == CORE:
                zone = ARTICLE
        elif any(x == name for x, _ in stack):
            while True:
                x, zone = stack.pop()
                depth -= x in ("article", "main")
                if x == name:
                    break
    if at < n:
        parts.append(page[at:])
    end()
    return out


def _lengths(a: list, b: list) -> list[int]:
    """The length of the longest common subsequence of ``a`` and each prefix of ``b``; one step of big integers per line of ``a``."""
    places: dict = {}
    for k, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << k
    full = v = (1 << len(b)) - 1
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
    out, total = [0], 0
    for bit in reversed(bin(v | 1 << len(b))[3:]):
        total += bit == "0"
        out.append(total)
    return out


def common(a: list, b: list, at: int = 0) -> list[int]:
    """The places in ``a`` of one longest common subsequence with ``b``, in memory that is linear in both."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    edges = list(range(at, at + head))
    last = list(range(at + len(a) - tail, at + len(a)))
    a, b, at = a[head : len(a) - tail], b[head : len(b) - tail], at + head
    if not a or not b:
        return edges + last
    if len(a) == 1:
        return edges + [at] * (a[0] in b) + last
    mid = len(a) // 2
    left, right = _lengths(a[:mid], b), _lengths(a[mid:][::-1], b[::-1])[::-1]
    cut = max(range(len(b) + 1), key=lambda k: left[k] + right[k])
    return edges + common(a[:mid], b[:cut], at) + common(a[mid:], b[cut:], at + mid) + last


#: Pages of one host are versions of each other if they share so much of their text.
VERSION = 0.9
#: Pages beyond each edge of a range that are sent to it too.
BEYOND = 4


def shared(own: list[tuple[int, str]], other: list[tuple[int, str]]) -> set[int]:
    """The places of the lines of a page that a longest common subsequence of its lines and another page's contains."""
    return set(common([t for _, t in own], [t for _, t in other]))


def is_version(own: list[tuple[int, str]], other: list[tuple[int, str]]) -> bool:
    """Whether two pages, less their boilerplate, share nine tenths of their characters."""
    a, b = ([t for z, t in x if z != BOILERPLATE] for x in (own, other))
    if a == b:
        return True
    alike = sum(len(a[k]) for k in common(a, b))
    return 2 * alike >= VERSION * sum(map(len, a + b))


def main_text(own: list[tuple[int, str]], around: list[list[tuple[int, str]]]) -> str:
    """The text of a page, given the lines of the one or two pages nearest to it that aren't versions of it.

    Lines that markup leaves open are deleted if a longest common subsequence of the page's lines and those of each page around contains them;
    within ``article`` only if there are two such pages, neither of which shares half of the page's core. Paragraphs, headings, list
    items, cells, quotations and preformatted text within ``article`` are never deleted, as pages also share whole passages.
    """
    both = [shared(own, y) for y in around]
    gone = set.intersection(*both) if both else set()
    core = [k for k, (z, _) in enumerate(own) if z >= ARTICLE]
    firm = len(around) < 2 or any(2 * len(s.intersection(core)) >= len(core) for s in both)
    return "\n".join(t for k, (z, t) in enumerate(own) if z != BOILERPLATE and not (k in gone and (z == OPEN or z == CORE and not firm)))


def _order(pages: DataFrame) -> list:
    """Sort key of a page: host, path, url and a hash that tells pages of one url apart."""
    url = F.col("url")
    return [host(url).alias("h"), path(url).alias("p"), F.coalesce(url, F.lit("")).alias("u"), F.xxhash64("url", "page_id").alias("t")]


def cuts(pages: DataFrame, n: int) -> list[tuple[list[tuple], list[tuple]]]:
    """The first and the last ``BEYOND`` sort keys of each of up to ``n`` ranges of pages, in order; only page_id and url are read."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, tail = [], []
        for b in batches:
            head += [b.slice(k, 1) for k in range(min(b.num_rows, BEYOND - len(head)))]
            tail = (tail + [b.slice(k, 1) for k in range(max(0, b.num_rows - BEYOND), b.num_rows)])[-BEYOND:]
        for k, found in enumerate((head, tail)):
            for x in found:
                yield pa.RecordBatch.from_arrays([*x.columns, pa.array([k], pa.int32())], [*x.schema.names, "side"])

    keys = pages.select(*_order(pages)).repartitionByRange(n, "h", "p", "u", "t").sortWithinPartitions("h", "p", "u", "t")
    marked_ = keys.mapInArrow(ends, "h string, p string, u string, t bigint, side int").withColumn("r", F.spark_partition_id()).collect()
    ranges: dict[int, tuple[list, list]] = {}
    for r in marked_:
        ranges.setdefault(r.r, ([], []))[r.side].append(tuple(r)[:4])
    return sorted((sorted(set(a)), sorted(set(z))) for a, z in ranges.values())


def extract(pages: DataFrame, ranges: int | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``: the main text, blocks joined by line feeds, and its code points.

    Markup comes first. Blocks in menus, footers, asides, forms and elements whose class, id or role names a menu, header, footer,
    sidebar, notice, advert or reader comments are not the text. Differencing then runs on every page: pages of a host are sorted by path, and
    a page is aligned, line by line, with the page before it and the page after it, or with two on one side at the host's ends. Pages with nearly the same text
    are versions, which prove nothing; a run of versions is passed over to the nearest page that is none, so all of them have the same pages
    around. ``main_text`` tells what is deleted.

    A null or empty page has an empty text. Pages without a host (a null url, or one without ``://``) have no neighbours. Rows
    with equal page_id and url stay separate rows. An empty table gives an empty result; other columns are not read.

    A first job sorts the urls alone and cuts them into ranges. Each page is then parsed once, sent to its range with
    its lines compressed, and met there by its neighbours in order; the ``BEYOND`` pages beyond each edge of a range are sent to it too. So a host with
    a third of all pages spreads over many tasks. A task holds a run of versions at a time, compressed, of which a range has no more than its share of
    all pages; where these pages are all versions, the pages at an edge are judged by fewer pages around.
    """
    n = ranges or partitions(pages.sparkSession)
    parts = cuts(pages, n)
    kind = pages.schema["page_id"].dataType
    firsts = [a[0] for a, _ in parts]
    ghosts: dict[tuple, list[int]] = {}
    for k in range(len(parts)):
        before = [key for a, z in parts[max(0, k - BEYOND) : k] for key in sorted({*a, *z})][-BEYOND:]
        after = [key for a, z in parts[k + 1 : k + 1 + BEYOND] for key in sorted({*a, *z})][:BEYOND]
        for key in before + after:
            ghosts.setdefault(key, []).append(k)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            rows: list[tuple] = []
            ids = []
            for k, (page, *key) in enumerate(zip(*(b.column(j).to_pylist() for j in range(1, 6)), strict=True)):
                key = tuple(key)
                body = "\n".join(f"{z}{t}" for z, t in lines(page or ""))
                home = max(0, bisect_right(firsts, key) - 1)
                for to in (home, *ghosts.get(key, ())):
                    rows.append((to, to != home, *key, squeeze(body.encode("utf-8", "surrogatepass"))))
                    ids.append(k)
            out = pa.RecordBatch.from_pylist([dict(zip(("r", "ghost", "h", "p", "u", "t", "body"), x, strict=True)) for x in rows], parsed)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), b.column(6).take(pa.array(ids, pa.int64())), *out.columns], names)

    parsed = pa.schema([("r", pa.int32()), ("ghost", pa.bool_()), ("h", pa.string()), ("p", pa.string()), ("u", pa.string()), ("t", pa.int64()), ("body", pa.binary())])
    names = ["page_id", "url", *parsed.names]
    order = ["r", "h", "p", "u", "t", "body"]
    ids = to_arrow_type(kind)

    def main(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor().decompress
        read = lambda body: [(int(s[0]), s[1:]) for s in spread(body).decode("utf-8", "surrogatepass").split("\n") if s]
        done: list[tuple] = []
        size = 0

        def settled(run: list, around: list) -> Iterator[pa.RecordBatch]:
            """The rows of a run of versions, of which each distinct body is judged once."""
            nonlocal size
            _, bodies = run
            for body, members in bodies.items():
                if not members:
                    continue
                text = main_text(read(body), around)
                for page_id, url in members:
                    done.append((page_id, url, text))
                    size += len(text)
                    if size > 1 << 22:
                        yield batch()

        def batch() -> pa.RecordBatch:
            nonlocal size
            columns = [[d[k] for d in done] for k in range(3)]
            out = pa.RecordBatch.from_arrays([pa.array(columns[0], ids), *(pa.array(c, pa.string()) for c in columns[1:]), pa.array([len(t) for t in columns[2]], pa.int64())], ["page_id", "url", "text", "n_chars"])
            done.clear()
            size = 0
            return out

        def finish(runs: list, last: bool) -> Iterator[pa.RecordBatch]:
            """Settle the runs of a host for which the pages around are known: one on each side, or two on one side at the host's ends."""
            while runs:
                k = next((i for i, r in enumerate(runs) if r[1] is not None), len(runs))
                if k == len(runs) or not last and len(runs) <= max(k + 1, 2):
                    break
                near = [runs[i][0] for i in ((k - 1, k + 1) if 0 < k < len(runs) - 1 else (k + 1, k + 2) if not k else (k - 2, k - 1)) if 0 <= i < len(runs)]
                yield from settled(runs[k], near)
                runs[k][1] = None
            del runs[: max(0, next((i for i, r in enumerate(runs) if r[1] is not None), len(runs)) - 2)]

        at, runs = None, []  # of the host: [lines of the first page, {body: rows}]
        for b in batches:
            for x in b.to_pylist():
                place = (x["r"], x["h"])
                if place != at or not x["h"]:
                    yield from finish(runs, True)
                    at, runs = place, []
                own = None
                if not runs or x["body"] not in (runs[-1][1] or ()):
                    own = read(x["body"])
                    if not runs or not is_version(own, runs[-1][0]):
                        runs.append([own, {}])
                        yield from finish(runs, False)
                members = runs[-1][1].setdefault(x["body"], [])
                if not x["ghost"]:
                    members.append((x["page_id"], x["url"]))
        yield from finish(runs, True)
        if done:
            yield batch()

    shown = kind.simpleString()
    schema = f"page_id {shown}, url string, r int, ghost boolean, h string, p string, u string, t bigint, body binary"
    rows = pages.select("page_id", "html", *_order(pages), "url").mapInArrow(parse, schema)
    return (
        rows.repartitionById(n, F.col("r")).sortWithinPartitions(*order)
        .mapInArrow(main, f"page_id {shown}, url string, text string, n_chars bigint")
    )


def extract_table(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages``; nulls, empty pages, repeated rows and an empty table are as in ``extract``."""
    return extract(pages.select("page_id", "url", "html"))
