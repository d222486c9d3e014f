"""Main text of web pages by nearest-URL page differencing.

A page is read as lines: the text of its blocks, in page order.  Mark-up drops
what it names itself (navigation, headers and footers of the page, asides,
forms, scripts, styles, adverts, notices, comments).  What it leaves open is
decided by differencing: within each host pages are ordered by URL path, each is
aligned with the nearest page before and behind it by the longest common
subsequence of their lines, and lines shared with both (or with the only one
there is) are deleted as the site's own.

Inside a marked article a line goes only if a paired page has it outside its
article: articles on neighbouring URLs may share passages, or be copies of each
other, and differencing alone would take these for the site's.  Pages that share
nine tenths of their text are copies and are not paired: behind a run of copies,
however long, the nearest other page is found by passing whole blocks of copies.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from graphlib import CycleError, TopologicalSorter
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import written

#: Pages aligned by one task at a time, and the pages before and behind that it tries first; pages with copies alone there look further.
TILE, REACH = 64, 8
#: Pages of a host that are passed together where all of them are copies.
BLOCK = 256
#: Lines of a block up to which parts of it are summarised (times 4: of two blocks whose pages are compared at once), and cells of their tables; larger ones page by page.
LINES, MATRIX = 1 << 17, 1 << 23
#: Share of the shorter page's characters from which two pages are copies.
COPY = 0.9
#: Bits of alignment kept for reading it back; longer pages are aligned in halves.
KEPT_BITS = 1 << 29

OPEN, MAIN, ARTICLE = 0, 1, 2

# -- reading a page --------------------------------------------------------

_BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
_DROPPED = frozenset("""nav aside footer form dialog button select option datalist textarea input label fieldset menu head noscript template svg math canvas
audio video object iframe map""".split())
#: Opening one of these ends an open one of the same line, up to the nearest list, table or section around it.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table div section article main aside nav body select".split())
_ROLES = frozenset("navigation banner complementary contentinfo search dialog alertdialog alert menu menubar toolbar form".split())
#: Words of class names and ids.
_REMARKS = frozenset("comment comments disqus reply replies respond discussion reactions".split())
_SITE = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar topbar sitemap footer copyright colophon
sidebar aside rail widget widgets related recommended recommendations trending teaser teasers promo promotion outbrain taboola
ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored
cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup paywall
share sharing social follow login signin""".split())
_HEADS = frozenset("header masthead".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_HUMP = re.compile(r"([a-z0-9])([A-Z])")
_WORD = re.compile(r"[a-z0-9]+")


def _named(attributes: dict) -> set[str]:
    """Words of an element's classes and id; names such as ``has-sidebar`` say nothing about the element itself."""
    out = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = _WORD.findall(_HUMP.sub(r"\1 \2", name).lower())
        if words and words[0] not in ("has", "no", "with", "without"):
            out.update(words)
    return out


def read_lines(page: str) -> tuple[list[tuple[int, str]], bool]:
    """The page's lines as (zone, text), without what mark-up drops, and whether it has an article or main element."""
    lines: list[tuple[int, list[tuple[tuple[int, ...], str]]]] = []
    held: list[tuple[tuple[int, ...], str]] = []
    stack: list[tuple[str, int | None]] = []  # open elements, each with its number where it is dropped
    dropping: tuple[int, ...] = ()
    wrappers, lifted = set(), set()  # dropped for a class alone; those of them that turned out to hold the article
    articles = mains = 0
    marked = False
    at, numbers = 0, 0

    def flush() -> None:
        nonlocal held
        if held:
            lines.append((ARTICLE if articles else MAIN if mains else OPEN, held))
            held = []

    def close(index: int) -> None:
        nonlocal articles, mains, dropping
        for tag, number in reversed(stack[index:]):
            articles -= tag == "article"
            mains -= tag == "main"
            if number is not None:
                dropping = tuple(n for n in dropping if n != number)
        del stack[index:]

    while True:
        found = _TOKEN.search(page, at)
        text = page[at:found.start() if found else len(page)]
        if text:
            held.append((dropping, entities.unescape(text) if "&" in text else text))
        if not found:
            break
        at = found.end()
        tag = found["tag"] or found["tag2"]
        if not tag:
            if found[0].startswith("<![CDATA["):
                held.append((dropping, found[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if found["end"] or found["end2"]:
            if tag in _BLOCKS:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag == "br":
            held.append((dropping, " "))
            continue
        rest = found["rest"] or found["rest2"] or ""
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            if end or tag in ("script", "style"):
                at = end.end() if end else len(page)
            continue
        if tag in _BLOCKS:
            flush()
        attributes = {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(rest)} if rest.strip(" /") else {}
        if tag == "body" and any(t == "head" for t, _ in stack):  # a head that was never closed
            close(next(i for i, (t, _) in enumerate(stack) if t == "head"))
        if tag == "p" or tag in _CLOSES:
            same = _CLOSES.get(tag, {"p"})
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in same:
                    close(i)
                elif stack[i][0] in _SCOPES:
                    break
        if tag in _VOID or rest.endswith("/") and tag in ("svg", "path"):
            continue
        words = _named(attributes)
        role = attributes.get("role", "").lower()
        inside = bool(articles)
        if role == "main" or (tag == "div" and attributes.get("itemprop", "") == "articleBody"):
            tag_zone = "main"
        else:
            tag_zone = tag
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        drop = hidden or tag in _DROPPED or role in _ROLES or bool(words & _REMARKS) or (tag == "header" and not inside) or (tag_zone == "article" and inside)
        by_class = not drop and tag not in ("html", "body", "article", "main") and bool(words & _SITE or (words & _HEADS and not inside))
        if tag_zone in ("article", "main") and not drop:
            marked = True
            lifted.update(n for n in dropping if n in wrappers)
        number = None
        if drop or by_class:
            number, numbers = numbers, numbers + 1
            dropping += (number,)
            if by_class or tag in ("form", "header"):
                wrappers.add(number)
        if tag in ("article", "main") or tag_zone == "main":
            articles += tag == "article"
            mains += tag == "main"
        stack.append((tag, number))
        if tag_zone == "main" and tag != "main":  # a div in main's role: counted under its own tag
            stack[-1] = ("main", number)
            stack.insert(-1, (tag, None))
            mains += 1
    flush()
    out = []
    for zone, pieces in lines:
        line = " ".join("".join(t for drops, t in pieces if not drops or all(n in lifted for n in drops)).split())
        if line:
            out.append((zone, line))
    return out, marked


def main_lines(lines: list[tuple[int, str]], marked: bool, deleted: frozenset[int] | set[int] = frozenset()) -> list[str]:
    """The lines of the page's articles, without any those of its main element, without any all, less the deleted ones."""
    zones = {z for z, _ in lines}
    least = ARTICLE if ARTICLE in zones else MAIN if marked else OPEN
    return [t for i, (z, t) in enumerate(lines) if z >= least and i not in deleted]


# -- aligning two pages ----------------------------------------------------

def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Bit j of row i is 0 where the common subsequence of a[:i] and b grows at b[j]."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    yield row
    for x in a:
        met = row & places.get(x, 0)
        row = ((row + met) | (row - met)) & full
        yield row


def _growth(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the common subsequence of a and b[:j] for each j."""
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence; bit-parallel, in halves where the table would be large."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = [(i, i) for i in range(head)]
    ends_behind = [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    in_a, in_b = set(a[head:len(a) - tail]), set(b[head:len(b) - tail])
    pa = [i for i in range(head, len(a) - tail) if a[i] in in_b]
    pb = [j for j in range(head, len(b) - tail) if b[j] in in_a]
    x, y = [a[i] for i in pa], [b[j] for j in pb]
    middle: list[tuple[int, int]] = []
    if x and y and (len(x) + 1) * len(y) > KEPT_BITS and len(x) > 1:
        half = len(x) // 2
        best = int(np.argmax(_growth(x[:half], y) + _growth(x[half:][::-1], y[::-1])[::-1]))
        middle = common(x[:half], y[:best]) + [(half + i, best + j) for i, j in common(x[half:], y[best:])]
    elif x and y:
        rows, i, j = list(_rows(x, y)), len(x), len(y)
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1
            elif not rows[i - 1] >> (j - 1) & 1:
                i -= 1
            else:
                i, j = i - 1, j - 1
                middle.append((i, j))
        middle.reverse()
    return ends + [(pa[i], pb[j]) for i, j in middle] + ends_behind


def _paired(a: tuple, b: tuple) -> tuple[list[tuple[int, int]], bool]:
    """Places of the lines two pages (hashes, sizes, zones) share that differencing may delete, and whether the pages are copies."""
    (x, sx, zx), (y, sy, zy) = a, b
    met = common(x.tolist(), y.tolist())
    copies = sum(int(sx[p]) for p, _ in met) >= COPY * min(int(sx.sum()), int(sy.sum()))
    return [(p, q) for p, q in met if zx[p] == OPEN or zy[q] == OPEN], copies


def _pages(rows: pd.DataFrame) -> list[tuple]:
    return [(np.asarray(x, np.int64), np.asarray(s), np.asarray(z)) for x, s, z in zip(rows["hashes"], rows["sizes"], rows["zones"])]


_SIDES = "host string, digest binary, rank long, side int, lines array<int>, open boolean"


def _aligned(tile: pd.DataFrame) -> pd.DataFrame:
    """Rows of ``_SIDES``: the lines that a tile's own pages lose (side 0).

    A page with nothing but copies within ``REACH`` on a side gives one row for each side instead: the lines shared there, or open.
    """
    tile = tile.sort_values("rank")
    pages, hosts, own = _pages(tile), tile["host"].tolist(), tile["own"].tolist()
    done: dict[tuple[int, int], tuple[list[tuple[int, int]], bool]] = {}

    def pair(i: int, j: int) -> tuple[list[tuple[int, int]], bool]:
        if (i, j) not in done:
            done[i, j] = _paired(pages[i], pages[j])
        return done[i, j]

    out = []
    for i, (host, digest, rank) in enumerate(zip(hosts, tile["digest"], tile["rank"])):
        if not own[i] or not len(pages[i][0]):
            continue
        shared, far = {}, []
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(pages) and abs(j - i) <= REACH and hosts[j] == host:
                met, copies = pair(min(i, j), max(i, j))
                if len(pages[j][0]) and not copies:
                    shared[step] = {p if i < j else q for p, q in met}
                    break
                j += step
            else:
                if abs(j - i) > REACH:
                    far.append(step)
        if not all(shared.values()):
            continue
        if far:
            out += [(host, digest, rank, step, sorted(met), False) for step, met in shared.items()] + [(host, digest, rank, step, None, True) for step in far]
        elif shared:
            out.append((host, digest, rank, 0, sorted(set.intersection(*shared.values())), False))
    return pd.DataFrame(out, columns=["host", "digest", "rank", "side", "lines", "open"])


# -- passing runs of copies ------------------------------------------------

#: A common subsequence of some pages, their distinct lines with sizes and the largest number of times in a page, and the longest page's characters.
_SUMMARY = "core array<long>, line array<long>, size array<int>, times array<int>, longest long"


def _page_summary(page: tuple) -> tuple[list[int], dict[int, tuple[int, int]], int]:
    hashes, sizes = page[0].tolist(), page[1]
    size = dict(zip(hashes, sizes.tolist()))
    return hashes, {x: (size[x], n) for x, n in Counter(hashes).items()}, int(sizes.sum())


def _merged(a: tuple, b: tuple) -> tuple[list[int], dict[int, tuple[int, int]], int]:
    core = [a[0][p] for p, _ in common(a[0], b[0])]
    if not core:  # nothing can be told of these pages together
        return [], {}, max(a[2], b[2])
    lines = dict(a[1])
    for x, (size, n) in b[1].items():
        lines[x] = size, max(n, lines[x][1]) if x in lines else n
    return core, lines, max(a[2], b[2])


def _surely_copies(a: tuple, b: tuple) -> bool:
    """Whether every page of one summary is certainly a copy of every page of the other.

    Two such pages align at least as many lines as the cores do, and only lines
    that both summaries know: they share at least the smallest that many of these.
    """
    met = len(common(a[0], b[0]))
    if not met:
        return False
    sizes = sorted(size for x, (size, n) in a[1].items() if x in b[1] for _ in range(min(n, b[1][x][1])))
    return sum(sizes[:met]) >= COPY * min(a[2], b[2])


class _Block:
    """Pages in the order they are searched, with summaries of their halves, quarters and so on, built when asked for; none where these would take much memory."""

    def __init__(self, pages: list[tuple]) -> None:
        self.pages, self.known, self.small = pages, {}, sum(len(p[0]) for p in pages) <= LINES

    def summary(self, low: int, high: int) -> tuple:
        if (low, high) not in self.known:
            mid = (low + high) // 2
            self.known[low, high] = _page_summary(self.pages[low]) if high - low == 1 else _merged(self.summary(low, mid), self.summary(mid, high))
        return self.known[low, high]

    def first_other(self, page: tuple, summary: tuple, start: int, low: int, high: int) -> int | None:
        """Place of the first page from ``start`` on, between low and high, that is no copy of ``page``."""
        if high <= start:
            return None
        if high - low == 1:
            return None if _paired(page, self.pages[low])[1] else low
        if self.small and _surely_copies(summary, self.summary(low, high)):
            return None
        mid = (low + high) // 2
        near = self.first_other(page, summary, start, low, mid)
        return near if near is not None else self.first_other(page, summary, start, mid, high)


def _copies(asking: list[tuple], block: list[tuple]) -> np.ndarray | None:
    """Which asking pages are copies of which of the block's; None where the pages do not keep one order of their lines.

    With one order (the first, second, ... time of a line counting as different
    lines) two pages align all lines they both have, so that the shares are one
    product of matrices.
    """
    def times(page: tuple) -> list[tuple[int, int]]:
        seen: Counter = Counter()
        out = []
        for x in page[0].tolist():
            out.append((x, seen[x]))
            seen[x] += 1
        return out

    if sum(len(p[0]) for p in asking + block) > 4 * LINES:
        return None
    listed = [[times(p) for p in pages] for pages in (asking, block)]
    both = set().union(*listed[0]) & set().union(*listed[1])
    place = {x: i for i, x in enumerate(both)}
    if (len(asking) + len(block)) * len(place) > MATRIX:
        return None
    steps = {step for pages in listed for page in pages for step in pairwise([place[x] for x in page if x in place])}
    order = TopologicalSorter()
    for before, after in steps:
        order.add(after, before)
    try:
        order.prepare()
    except CycleError:
        return None
    tables = []
    for pages, lines in zip((asking, block), listed):
        table = np.zeros((len(pages), len(place)))
        for row, page, line in zip(table, pages, lines):
            for x, size in zip(line, page[1].tolist()):
                if x in place:
                    row[place[x]] = size
        tables.append(table)
    shared = tables[0] @ (tables[1] > 0).astype(float).T
    totals = [np.array([int(p[1].sum()) for p in pages]) for pages in (asking, block)]
    return shared >= COPY * np.minimum(totals[0][:, None], totals[1][None, :])


def _summarised(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    core, lines, longest = reduce(_merged, map(_page_summary, _pages(rows.sort_values("rank"))))
    row = (*key, core, list(lines), [s for s, _ in lines.values()], [n for _, n in lines.values()], longest)
    return pd.DataFrame([row], columns=[*[f"k{i}" for i in range(len(key))], "core", "line", "size", "times", "longest"])


def _undecided(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The (host, tile, side, other) whose asking pages are not all surely copies of the other block's."""
    for batch in batches:
        sides = [[(np.asarray(c).tolist(), {x: (z, n) for x, z, n in zip(np.asarray(line).tolist(), np.asarray(size).tolist(), np.asarray(times).tolist())}, longest)
                  for c, line, size, times, longest in zip(*(batch[f"{s}_{c}"] for c in ("core", "line", "size", "times", "longest")))] for s in "ab"]
        yield batch.loc[[not _surely_copies(a, b) for a, b in zip(*sides)], ["host", "tile", "side", "other"]]


def _met_further(key: tuple, asking: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """(host, digest, rank, side, away, lines) of the asking pages that have a partner in the block, the nearest of it."""
    host, tile, side, other = key
    rows = rows.sort_values("rank", ascending=side > 0)
    block, ranks, out = _Block(_pages(rows)), rows["rank"].to_numpy() * side, []
    pages = _pages(asking)
    copies = _copies(pages, block.pages)
    for i, (digest, rank, page) in enumerate(zip(asking["digest"], asking["rank"], pages)):
        start = int(np.searchsorted(ranks, rank * side, "right"))
        if copies is None:
            j = block.first_other(page, _page_summary(page), start, 0, len(rows))
        else:
            others = np.flatnonzero(~copies[i, start:])
            j = start + int(others[0]) if len(others) else None
        if j is not None:
            met = _paired(page, block.pages[j])[0] if side > 0 else _paired(block.pages[j], page)[0]
            out.append((host, digest, rank, side, abs(other - tile), sorted({p if side > 0 else q for p, q in met})))
    return pd.DataFrame(out, columns=["host", "digest", "rank", "side", "away", "lines"])


def _further(ranked: DataFrame, wanted: DataFrame) -> DataFrame:
    """(host, digest, rank, side, lines) of the wanted (host, rank, side) that have a partner beyond ``REACH``, however far on the host.

    Each round looks into twice as many blocks as the one before, so that rounds
    grow with the logarithm of a run of copies.  A block is compared with the
    asking pages of another by their summaries; where these leave it open, the
    pages themselves are compared, nearest first: all at once where they keep one
    order of their lines, else by alignment.
    """
    pages = written(ranked.join(wanted.select("host").distinct(), "host", "left_semi").where(F.size("hashes") > 0)
                    .select("host", "digest", "rank", F.floor(F.col("rank") / BLOCK).alias("tile"), "hashes", "sizes", "zones"), "searched")
    ends = pages.groupBy("host").agg(F.min("tile").alias("low"), F.max("tile").alias("high"))
    left = (wanted.select("host", "rank", "side").withColumn("tile", F.floor(F.col("rank") / BLOCK)).join(ends, "host")
            .select("host", "tile", "side", "rank", F.when(F.col("side") > 0, F.col("high") - F.col("tile")).otherwise(F.col("tile") - F.col("low")).alias("room")))
    left = written(left, "open")
    asking = pages.join(left.select("rank", "side"), "rank").groupBy("host", "tile", "side")
    asking = written(asking.applyInPandas(_summarised, f"k0 string, k1 long, k2 int, {_SUMMARY}"), "asking")
    blocks = written(pages.groupBy("host", "tile").applyInPandas(_summarised, f"k0 string, k1 long, {_SUMMARY}"), "blocks")
    names = ("core", "line", "size", "times", "longest")
    asking = asking.select(F.col("k0").alias("host"), F.col("k1").alias("tile"), F.col("k2").alias("side"), *(F.col(n).alias(f"a_{n}") for n in names))
    blocks = blocks.select(F.col("k0").alias("host"), F.col("k1").alias("other"), *(F.col(n).alias(f"b_{n}") for n in names))
    found, start, span = [], 0, 1
    while not left.isEmpty():
        away = F.explode(F.sequence(F.lit(start).cast("long"), F.least("room", F.lit(start + span - 1).cast("long"))))
        pairs = left.select("host", "tile", "side", "room").distinct().select("host", "tile", "side", away.alias("away"))
        pairs = pairs.select("host", "tile", "side", (F.col("tile") + F.col("side") * F.col("away")).alias("other"))
        pairs = pairs.join(asking, ["host", "tile", "side"]).join(blocks, ["host", "other"])
        pairs = written(pairs.mapInPandas(_undecided, "host string, tile long, side int, other long"), "pairs")
        keys = ["host", "tile", "side", "other"]
        those = pages.join(left.select("rank", "side"), "rank").join(pairs, ["host", "tile", "side"]).groupBy(*keys)
        others = pages.withColumnRenamed("tile", "other").join(pairs, ["host", "other"])
        others = others.toDF(*others.columns).groupBy(*keys)  # columns of its own, not those of the other side
        met = those.cogroup(others).applyInPandas(_met_further, "host string, digest binary, rank long, side int, away long, lines array<int>")
        met = written(met.groupBy("host", "digest", "rank", "side").agg(F.min_by("lines", "away").alias("lines")), "further")
        found.append(met)
        start, span = start + span, 2 * span
        left = written(left.where(F.col("room") >= start).join(met, ["rank", "side"], "left_anti").select("host", "tile", "side", "rank", "room"), "open")
    return reduce(DataFrame.union, found)


# -- over a table ----------------------------------------------------------

def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import xxhash

    for batch in batches:
        out = []
        for key, host, path, page in zip(batch["key"], batch["host"], batch["path"], batch["html"]):
            lines, _ = read_lines(page)
            hashes = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for _, t in lines]
            zones = [z for z, _ in lines]
            out.append((key, host, path, xxhash.xxh3_128_digest(repr((hashes, zones)).encode()), hashes, [len(t) for _, t in lines], zones))
        yield pd.DataFrame(out, columns=["key", "host", "path", "digest", "hashes", "sizes", "zones"])


def shared_lines(pages: DataFrame) -> DataFrame:
    """(key, deleted) of the pages (key, host, path, html) that lose lines to differencing.

    A host's pages with equal lines are one entry.  Entries are ranked by host
    and path with a range partitioning and the sizes of its partitions, so that a
    host of any size spreads over tasks; a tile of consecutive ranks, with
    ``REACH`` pages of context on both sides, is aligned by one task.  Pages that
    meet only copies there are searched for further.
    """
    lines = written(pages.mapInPandas(_hashed, "key long, host string, path string, digest binary, hashes array<long>, sizes array<int>, zones array<byte>"), "lines")
    entries = lines.groupBy("host", "digest").agg(F.min("path").alias("path"), F.first("hashes").alias("hashes"), F.first("sizes").alias("sizes"), F.first("zones").alias("zones"))
    placed = entries.repartitionByRange("host", "path", "digest").sortWithinPartitions("host", "path", "digest").withColumn("at", F.monotonically_increasing_id())
    placed = written(placed, "entries").withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    before, first = 0, {}
    for r in placed.groupBy("part").count().orderBy("part").collect():  # one row per partition
        first[r["part"]], before = before, before + r["count"]
    if not first:
        return lines.select("key", F.array().cast("array<int>").alias("deleted")).where("false")
    spark = lines.sparkSession
    ranked = placed.join(F.broadcast(spark.createDataFrame(list(first.items()), "part long, before long")), "part").withColumn("rank", F.col("before") + F.col("at"))
    tile = F.floor(F.col("rank") / TILE)
    near = F.sequence(F.floor((F.col("rank") - REACH) / TILE), F.floor((F.col("rank") + REACH) / TILE))
    dealt = ranked.withColumn("own_tile", tile).withColumn("tile", F.explode(near)).select(
        "tile", "rank", "host", "digest", "hashes", "sizes", "zones", (F.col("tile") == F.col("own_tile")).alias("own"))
    sides = written(dealt.groupBy("tile").applyInPandas(_aligned, _SIDES), "deleted")
    found = sides.where("side = 0").select("host", "digest", F.col("lines").alias("deleted"))
    wanted = sides.where("open")
    if not wanted.isEmpty():
        met = ["host", "digest", "rank", "side", "lines"]
        both = sides.where("side <> 0 and not open").select(met).union(_further(ranked, wanted).select(met))
        both = both.groupBy("host", "digest").agg(F.array_intersect(F.min_by("lines", "side"), F.max_by("lines", "side")).alias("deleted"))
        found = found.union(both)
    found = found.where(F.size("deleted") > 0)
    return lines.select("key", "host", "digest").distinct().join(found, ["host", "digest"]).select("key", "deleted")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    text is the page's main text, blocks joined by one space; n_chars its code
    points.  Null and empty pages have an empty text; a null URL belongs to a
    nameless host; rows repeated with one URL and html get the same text each;
    pages without a neighbour on their host keep all lines mark-up leaves open;
    other columns are ignored; an empty table gives no rows.  A page must fit
    into a task, whatever its length.
    """
    link = F.coalesce(F.col(url), F.lit(""))
    place = F.regexp_replace(link, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"),
                        F.xxhash64(F.col(url), F.col(html)).alias("key"), F.lower(F.regexp_extract(place, r"^[^/?#]*", 0)).alias("host"),
                        F.regexp_replace(place, r"^[^/?#]*|#.*$", "").alias("path"))
    found = shared_lines(rows.select("key", "host", "path", "html"))
    rows = rows.select("page_id", "url", "html", "key")
    if found.isEmpty():
        rows = rows.withColumn("deleted", F.lit(None).cast("array<int>"))
    else:
        rows = rows.join(written(found.dropDuplicates(["key"]), "lost"), "key", "left")

    @F.pandas_udf("string")
    def kept(html: pd.Series, deleted: pd.Series) -> pd.Series:
        return pd.Series([" ".join(main_lines(*read_lines(h), frozenset() if d is None else set(d))) for h, d in zip(html, deleted)], dtype=object)

    out = rows.select("page_id", "url", kept("html", "deleted").alias("text"))
    return out.select(F.col("page_id").alias(page_id), F.col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))
