"""Main text of web pages, by nearest-URL page differencing.

Pages of a host stand in order of their URL paths, equal ones once.  Each is aligned with its two neighbours by longest
common subsequence of text lines (blocks) and paired with the one that is no near copy of it and shares the longer
path prefix.  Lines that both share are deleted.  What a page and its neighbour share because one copies or
quotes the other is told from what the site repeats by counting: a line is the site's where more than half of the
host's different pages around hold it (those of a block of the order, and some before and behind it), three at least.
Only such lines are deleted from an <article> (or <main>) that is the larger part of its page, and from a page whose
neighbours are both near copies.  Elements that are no main text by their name, role or class are left out before.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.surrogate import assign_keys

# Element names of HTML and words that name a part of a page.
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas audio video".split())
ASIDE = frozenset("head nav footer aside form button select menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices popup modal newsletter subscribe signup sidebar widget widgets related recommended "
    "share sharing social comment comments commentlist reply replies respond disqus breadcrumb breadcrumbs nav navbar "
    "navigation menu pagination pager footer masthead topbar toolbar login".split()
)
CLOSED_BY = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

SITE_PAGES = 3  # different pages of a host that hold a line of the site, at least
BLOCK = 1024  # pages that are compared together
MARGIN = 64  # pages before and behind a block that are counted with it

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z0-9]+")


def _left_out(name: str, attributes: str, inside: bool) -> bool:
    if name in ASIDE or (name == "header" and not inside):
        return True
    if not attributes:
        return False
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return True
    if found.get("role") in ROLES:
        return True
    if name in ("article", "main", "body", "html"):
        return bool({"comment", "comments", "reply"} & set(_WORD.findall(found.get("class", ""))))
    return not PARTS.isdisjoint(_WORD.findall(found.get("class", "") + " " + found.get("id", "")))


def lines_of(page: str | None) -> list[tuple[str, bool]]:
    """The text blocks of a page that may be main text, and whether each stands in its article."""
    out: list[tuple[str, bool]] = []
    block: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, left out, in an article
    page, at = page or "", 0

    def end_block() -> None:
        text = " ".join(html.unescape("".join(block)).split())
        if text:
            out.append((text, inside))
        block.clear()

    left_out = inside = False
    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text and not left_out:
            block.append(text)
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name or not m[4]:
            continue
        if name not in INLINE and not left_out:
            end_block()
        if m[1]:
            if any(name == s[0] for s in stack):
                if name not in INLINE or not _crosses(stack, name):
                    while stack.pop()[0] != name:
                        pass
        elif name in RAW:
            close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            at = close.start() if close else len(page)
            stack.append((name, True, inside))
        elif name not in VOID and not m[3].endswith("/"):
            if stack and stack[-1][0] in CLOSED_BY.get(name, ()):
                stack.pop()
                left_out, inside = stack[-1][1:] if stack else (False, False)
            own = inside or name in ("article", "main")
            stack.append((name, left_out or _left_out(name, m[3], inside), own))
        left_out, inside = stack[-1][1:] if stack else (False, False)
    if not left_out:
        end_block()
    return out


def _crosses(stack: list, name: str) -> bool:
    """Whether the end tag of an inline element would close a block that was opened after it."""
    for s in reversed(stack):
        if s[0] == name:
            return False
        if s[0] not in INLINE:
            return True
    return True


def shared_lines(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of lines, as a longest rising run of matches."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    places: dict[int, list[int]] = {}
    for j in range(len(b) - end - 1, start - 1, -1):
        places.setdefault(b[j], []).append(j)  # falling
    ends: list[int] = []
    chains: list[tuple] = []
    for i in range(start, len(a) - end):
        for j in places.get(a[i], ()):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[k], chains[k] = j, chain
    out = {*range(start), *range(len(a) - end, len(a))}
    chain = chains[-1] if chains else None
    while chain:
        out.add(chain[0])
        chain = chain[1]
    return out


def _marks(lines: list[tuple[str, bool]]) -> list[int]:
    return [xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 for text, _ in lines]


def _common(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", block: int = BLOCK, margin: int = MARGIN
) -> DataFrame:
    """Every page's id, url, text (its lines joined by one space), n_shared (lines it shares with its neighbour) and
    n_deleted (lines that comparison deletes).

    White space inside a line becomes one space; character references are decoded.  A null or empty page has an empty
    text; a null url is a host of its own kind.  Pages of a host with equal lines are one page for pairing, and each
    returns.  A page alone in its host loses no line by comparison.  An article that the site's lines would halve
    stays whole.  Markup that ends early is read as far as it goes.  An empty table gives an empty result.  Other
    columns are ignored.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = [lines_of(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([[t for t, _ in x] for x in lines], pa.list_(pa.string())),
                    pa.array([[o for _, o in x] for x in lines], pa.list_(pa.bool_())),
                    pa.array([_marks(x) for x in lines], pa.list_(pa.int64())),
                ],
                names=["page_id", "url", "lines", "own", "marks"],
            )

    bare = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    host = F.lower(F.substring_index(bare, "/", 1))
    read_pages = rows.mapInArrow(
        read, "page_id long, url string, lines array<string>, own array<boolean>, marks array<long>"
    ).withColumn("page", F.xxhash64(host, "marks"))
    path = F.regexp_replace(F.regexp_replace(bare, "^[^/]*", ""), r"(\.html?|/)$", "")
    light = read_pages.select(
        "page", host.alias("host"), "marks", F.struct(path.alias("path"), F.coalesce("url", F.lit("")).alias("address")).alias("at")
    )
    light = light.groupBy("page").agg(F.min("at").alias("at"), F.first("host").alias("host"), F.first("marks").alias("marks"))
    ranked = assign_keys(light.select("page", "host", "at.*", "marks"), "rank", ["host", "path", "address", "page"])

    # Pages in blocks of ranks, each with some pages before and behind it.
    ranked = ranked.withColumn("home", F.expr(f"rank div {block}"))
    around = F.sequence(F.expr(f"(rank - {margin}) div {block}"), F.expr(f"(rank + {margin}) div {block}"))

    def compare(key, table):
        pages = {r["rank"]: r for r in table.to_pylist()}
        site = site_lines([(r["host"], r["marks"]) for r in pages.values()])
        out = []
        for rank, r in pages.items():
            if r["home"] != key[0].as_py():
                continue
            near = [pages[n] for n in (rank - 1, rank + 1) if n in pages and pages[n]["host"] == r["host"]]
            told = compared(r["path"], r["marks"], [(x["path"], x["marks"]) for x in near], site[r["host"]])
            if told[0]:
                out.append((r["page"], *told))
        kinds = {"page": pa.int64(), "shared": pa.list_(pa.int32()), "site": pa.list_(pa.int32()), "copy": pa.bool_()}
        return pa.table({c: pa.array([r[i] for r in out], kind) for i, (c, kind) in enumerate(kinds.items())})

    told = (
        ranked.withColumn("block", F.explode(around))
        .groupBy("block")
        .applyInArrow(compare, "page long, shared array<int>, site array<int>, copy boolean")
    )

    def join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, shared_counts, deleted = [], [], []
            for lines, own, shared, site, copy in zip(*(b.column(i).to_pylist() for i in range(2, 7)), strict=True):
                text, n = _kept(lines, own, set(shared or ()), set(site or ()), bool(copy))
                texts.append(" ".join(text))
                shared_counts.append(len(shared or ()))
                deleted.append(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(shared_counts, pa.int64()), pa.array(deleted, pa.int64())],
                names=["page_id", "url", "text", "n_shared", "n_deleted"],
            )

    out = (
        read_pages.drop("marks")
        .join(told, "page", "left")
        .select("page_id", "url", "lines", "own", "shared", "site", "copy")
        .mapInArrow(join_lines, "page_id long, url string, text string, n_shared long, n_deleted long")
    )
    return out.withColumnRenamed("page_id", id_col).withColumnRenamed("url", url_col)


def site_lines(pages: list[tuple[str, list[int]]]) -> dict[str, set[int]]:
    """For each host the lines that more than half of its pages hold, and three at least."""
    count: Counter = Counter(host for host, _ in pages)
    held = Counter((host, m) for host, marks in pages for m in set(marks))
    out: dict[str, set[int]] = {host: set() for host in count}
    for (host, m), n in held.items():
        if n >= SITE_PAGES and 2 * n > count[host]:
            out[host].add(m)
    return out


def compared(
    path: str, marks: list[int], sides: list[tuple[str, list[int]]], site: set[int]
) -> tuple[list[int], list[int], bool]:
    """Places of the lines shared with the paired neighbour, those of them that are the site's, and whether it is a copy.

    A neighbour is a near copy where it shares most of the lines that are not the site's.
    """
    own = [i for i, m in enumerate(marks) if m not in site]
    best: tuple = ()
    for other_path, other in sides:
        shared = shared_lines(marks, other)
        copy = bool(own) and 2 * sum(i in shared for i in own) > len(own) and len(own) > 1
        key = (not copy, _common(path, other_path))
        if not best or key > best[0]:
            best = (key, shared, copy)
    if not best:
        return [], [], False
    shared = sorted(best[1])
    return shared, [i for i in shared if marks[i] in site], best[2]


def _kept(
    lines: list[str], own: list[bool], shared: set[int], site: set[int], copy: bool
) -> tuple[list[str], int]:
    """The lines of the main text, and how many lines comparison deleted."""
    size = [len(x) for x in lines]
    inside = [i for i, o in enumerate(own) if o]
    article = sum(size[i] for i in inside)
    if inside and 2 * article >= sum(size):
        gone = site.intersection(inside)
        if 2 * sum(size[i] for i in gone) > article:
            gone = set()
        return [lines[i] for i in inside if i not in gone], len(gone)
    gone = site if copy else shared
    return [x for i, x in enumerate(lines) if i not in gone], len(gone)
