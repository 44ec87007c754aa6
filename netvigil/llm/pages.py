"""Main text of web pages: structure first, then differencing against the page with the nearest URL.

A page's lines are its blocks of text outside elements that are furniture by name, role or class. Pages are sorted by
host and path, so the pages with the longest common path prefix are neighbours; the lines of both are aligned by
their longest common subsequence and shared lines are deleted. Pages of a host with equal lines are one page here, so
each has a different neighbour. Two kinds of shared lines stay unless they are frequent on the host: those of a
neighbour that is nearly a copy of the page (the same but for frequent lines), and lines of an article or main element
that aren't links, since articles of a host do repeat passages of text. Text outside a page's article or main element is
judged by the alignment as any other; only lines that are nothing but a link go there without being shared.
"""

from __future__ import annotations

import html as references
import re
import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.llm.common import numbered
from netvigil.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark meter nobr output progress q ruby rb rp "
    "rt s samp small span strike strong sub sup time tt u var wbr".split()
)
FURNITURE = frozenset(
    "nav footer aside form button select option datalist dialog menu label fieldset legend input audio video canvas map head".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Words that mark furniture: a class or an id all of whose words are among these and PLACES.
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner cookie cookies "
    "consent gdpr notice notices popup modal overlay sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer "
    "comment comments disqus replies reply related recommended recommendations share sharing social newsletter subscribe "
    "subscription login signup signin search toolbar pagination pager widget widgets skip hidden".split()
)
#: Words that say where or in what form furniture stands; they mark nothing alone.
PLACES = frozenset(
    "site page main primary secondary global local top bottom left right upper lower inner outer sticky fixed "
    "bar box block area zone section container panel column col row list item items link links button buttons btn icon icons "
    "slot unit form post posts article articles entry google".split()
)
#: Words that name a frame around the content, not the furniture itself.
FRAMES = frozenset("with has no without wrapper layout".split())
#: Furniture that may well be longer than the main text.
LONG = frozenset(
    "comment comments disqus replies reply ad ads advert adverts advertisement advertising footer nav navbar navigation sidebar "
    "aside cookie cookies consent gdpr breadcrumb breadcrumbs recommended recommendations".split()
)
#: An element of these names starts by ending an open one of the same group.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S,
)
# One attribute after another, so that nothing is looked for inside a value.
_ATTRIBUTE = re.compile(r"([^\s\"'/>=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?|\"[^\"]*\"|'[^']*'")
_TOKEN = re.compile("[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: A line: its text, whether it is inside an article or main element, whether all of it is link text.
Line = tuple[str, bool, bool]


def _marks(value: str, words: frozenset[str]) -> set[str]:
    """The ``words`` in those names of a class or id that consist of nothing but them and places."""
    out: set[str] = set()
    if FRAMES & set(_TOKEN.findall(value)):
        return out
    for name in value.split():
        parts = set(_TOKEN.findall(name))
        if parts <= words | PLACES:
            out |= parts & words
    return out


def _kind(name: str, attributes: str) -> tuple[str, bool]:
    """``furniture``, ``header`` (in an article only its headings count), ``content``, or nothing.

    And whether it is furniture by no more than an id that doesn't tell how long it is.
    """
    if name in FURNITURE:
        return "furniture", False
    kind = "header" if name == "header" else "content" if name in ("article", "main") else ""
    if not attributes or name in ("html", "body"):
        return kind, False
    given: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1]:
            given.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    if "hidden" in given or given.get("aria-hidden") == "true" or _HIDDEN.search(given.get("style", "")):
        return "furniture", False
    roles = set(given.get("role", "").split())
    if roles & ROLES:
        return "furniture", False
    kind = "content" if roles & {"main", "article"} else kind
    for what in ("class", "id"):
        if what in given and not (what == "id" and name in HEADINGS):
            marks = _marks(given[what], WORDS)
            if marks and (kind != "content" or marks & {"comment", "comments", "reply"}):
                return "furniture", what == "id" and not marks & LONG
            if kind != "content" and _marks(given[what], frozenset(("header", "masthead"))):
                kind = "header"
    return kind, False


def lines(page: str) -> list[Line]:
    """The page's lines outside furniture: character references decoded, white space made one space.

    An element that is furniture by its id alone and holds most of the page's other text is none.
    """
    out, doubtful, total = _read(page, frozenset())
    spared = frozenset(at for at, size in doubtful.items() if 2 * size > total)
    return _read(page, spared)[0] if spared else out


def _read(page: str, spared: frozenset[int]) -> tuple[list[Line], dict[int, int], int]:
    """The lines; characters in each element that is furniture by its id alone, by place; and all characters that count."""
    out: list[Line] = []
    sizes: dict[int, int] = {}
    doubts: list[tuple[int, int, int]] = []
    total = 0
    stack: list[tuple[str, str]] = []
    names: Counter[str] = Counter()
    kinds: Counter[str] = Counter()
    pieces: list[str] = []
    linked = plain = 0
    inside = False

    def flush() -> None:
        nonlocal linked, plain
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((text, inside, linked > 0 and not plain))
            pieces.clear()
        linked = plain = 0

    def add(text: str) -> None:
        nonlocal linked, plain, inside, total
        if kinds["furniture"] == len(doubts):
            total += len(text) - text.count(" ")
        if not text or kinds["furniture"] or kinds["header"] and not (kinds["content"] and kinds["heading"]):
            return
        if not pieces:
            inside = kinds["content"] > 0
        pieces.append(references.unescape(text))
        if not text.isspace():
            linked, plain = linked + (names["a"] > 0), plain + (names["a"] == 0)

    def close(upto: int) -> None:
        while len(stack) > upto:
            name, kind = stack.pop()
            if doubts and doubts[-1][0] == len(stack):
                _, start, before = doubts.pop()
                sizes[start] = total - before
            names[name] -= 1
            kinds[kind] -= 1

    def close_named(wanted: tuple[str, ...], stop: frozenset[str]) -> None:
        for place in range(len(stack) - 1, -1, -1):
            if stack[place][0] in wanted:
                close(place)
                return
            if stack[place][0] in stop:
                return

    at = 0
    while True:
        m = _TAG.search(page, at)
        add(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            flush()
        if m[1] or m[4]:
            if names[name] > 0:
                place = len(stack) - 1
                while stack[place][0] != name:
                    place -= 1
                close(place)
            elif name == "br":
                flush()
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in VOID:
            if name in SIBLINGS:
                close_named(SIBLINGS[name], frozenset(("ul", "ol", "dl", "table", "menu")))
            elif name not in INLINE and names["p"] > 0:
                # A block ends an open paragraph, with the inline elements left open in it.
                close_named(("p",), frozenset(n for n, _ in stack[-1:] if n not in INLINE and n != "p"))
            attributes = m[3] if m[2] else m[6]
            kind, doubt = _kind(name, attributes)
            if doubt and m.start() in spared:
                kind, doubt = "", False
            kind = kind or ("heading" if name in HEADINGS else "")
            if not (attributes or "").endswith("/") or name not in ("svg", "path"):
                if doubt and kinds["furniture"] == len(doubts):
                    doubts.append((len(stack), m.start(), total))
                stack.append((name, kind))
                names[name] += 1
                kinds[kind] += 1
    flush()
    close(0)
    return out, sizes, total


# --- alignment ---------------------------------------------------------------------------------------------------

#: Cells of the alignment matrix that are kept as bits at once; larger problems are halved first.
CELLS = 1 << 28


def _rows(a: list, b: list) -> list[int]:
    """Bit-parallel LCS: after each item of ``a`` one integer whose zero bits are the steps of that row over ``b``."""
    where: dict = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, out = full, []
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        out.append(row)
    return out


def _prefix_scores(a: list, b: list) -> list[int]:
    """Length of the LCS of ``a`` with every prefix of ``b``."""
    last = _rows(a, b)[-1] if a else (1 << len(b)) - 1
    out = [0]
    for j in range(len(b)):
        out.append(out[-1] + (1 - (last >> j & 1)))
    return out


def common(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = list(range(head)), list(range(len(a) - tail, len(a)))
    both = set(a[head : len(a) - tail]) & set(b[head : len(b) - tail])
    places = [i for i in range(head, len(a) - tail) if a[i] in both]
    x, y = [a[i] for i in places], [v for v in b[head : len(b) - tail] if v in both]
    return ends[0] + [places[i] for i in _common(x, y)] + ends[1]


def _common(a: list, b: list) -> list[int]:
    if not a or not b:
        return []
    if len(set(a)) == len(a) and len(set(b)) == len(b):
        # Each item once: the longest increasing run of places.
        place = {y: j for j, y in enumerate(b)}
        tops, ids, before = [], [], []
        for i, x in enumerate(a):
            k = bisect_left(tops, place[x]) if x in place else 0
            before.append(ids[k - 1] if k else -1)
            if x in place:
                tops[k : k + 1], ids[k : k + 1] = [place[x]], [i]
        out, i = [], ids[-1] if ids else -1
        while i >= 0:
            out.append(i)
            i = before[i]
        return out[::-1]
    if len(a) > 1 and len(a) * len(b) > CELLS:
        half = len(a) // 2
        left, right = _prefix_scores(a[:half], b), _prefix_scores(a[half:][::-1], b[::-1])[::-1]
        cut = max(range(len(b) + 1), key=lambda j: left[j] + right[j])
        return _common(a[:half], b[:cut]) + [half + i for i in _common(a[half:], b[cut:])]
    rows, out, j = _rows(a, b), [], len(b) - 1
    for i in range(len(a) - 1, -1, -1):
        # The highest step at or before j: where the row's score is reached.
        steps = ~rows[i] & ((1 << j + 1) - 1)
        if not steps:
            break
        j = steps.bit_length() - 1
        above = ~rows[i - 1] & ((1 << j + 1) - 1) if i else 0
        if above.bit_count() < steps.bit_count():
            out.append(i)
            j -= 1
    return out[::-1]


# --- pages -------------------------------------------------------------------------------------------------------


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host, and path without query, fragment and closing slash; both empty for null."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|[?#].*$", "")
    host = F.lower(F.substring_index(bare, "/", 1))
    return host, F.regexp_replace(bare, r"^[^/]*/?|/+$", "")


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, has_open, sizes = [], [], []
        for page in batch.column(3).to_pylist():
            own = lines(page or "")
            hashes.append([xxhash.xxh64_intdigest(text) - (1 << 63) for text, _, _ in own])
            has_open.append(any(link or not inside for _, inside, link in own))
            sizes.append([len(text) for text, _, _ in own])
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), batch.column(2), pa.array(hashes, pa.list_(pa.int64())),
            pa.array(has_open, pa.bool_()), pa.array(sizes, pa.list_(pa.int32())),
        ], names=["key", "host", "path", "hashes", "open", "sizes"])


#: A neighbour that shares more than this part of the characters that aren't frequent on the host is a copy.
COPY = 0.9
#: A line is frequent on a host if it is on more than half of its different pages, and on this many at least.
FREQUENT = 3


def _near(path: str, other: str) -> tuple[int, int]:
    """How near two paths are: equal leading segments, then equal leading characters."""
    n = 0
    for x, y in zip(path, other):
        if x != y:
            break
        n += 1
    segments = sum(1 for x, y in zip(path.split("/"), other.split("/")) if x == y) if n else 0
    return segments, n


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines that a page shares with its nearest page, and those of them that are frequent on the host.

    Of a copy only frequent lines count. After a copy, or a page of another frame that shares nothing, the neighbour
    on the other side is asked too. A host of two different pages has nothing to tell copies by: all shared lines count.
    """
    for batch in batches:
        same_pages, gone, notices = [], [], []
        for row in batch.itertuples(index=False):
            near = [
                (path, list(hashes)) for host, path, hashes in
                ((row.before_host, row.before_path, row.before_hashes), (row.after_host, row.after_path, row.after_hashes))
                if host == row.host and hashes is not None
            ]
            near.sort(key=lambda n: _near(row.path, n[0]), reverse=True)
            own, sizes = list(row.hashes), list(row.sizes)
            frequent = set(row.frequent) if row.frequent is not None else set()
            rare = sum(size for line, size in zip(own, sizes) if line not in frequent)
            drop: set[int] = set()
            for _, other in near:
                same = common(own, other)
                copy = row.pages > 2 and sum(sizes[i] for i in same if own[i] not in frequent) > COPY * rare
                drop.update(i for i in same if not copy or own[i] in frequent)
                if same and not copy:
                    break
            if drop:
                same_pages.append(row.same)
                gone.append(sorted(drop))
                notices.append([i for i in sorted(drop) if own[i] in frequent])
        yield pd.DataFrame({
            "same": pd.Series(same_pages, dtype="int64"), "gone": pd.Series(gone, dtype=object), "notices": pd.Series(notices, dtype=object),
        })


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, gone, notices in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
            own = lines(page or "")
            article = any(inside for _, inside, _ in own)
            drop = {i for i in gone or () if own[i][2] or not own[i][1]} | set(notices or ())
            texts.append(" ".join(t for i, (t, inside, link) in enumerate(own) if i not in drop and (inside or not article or not link)))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()),
        ], names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html; other columns are ignored).

    ``text`` is the main text, blocks joined by one space; n_chars counts its code points. Null and empty html give the
    empty text; null urls form a host of their own. Pages of a host with equal lines are one page, at the first of their
    paths, and each come back; pages under one URL are neighbours too. Very long pages are read whole; an empty table gives no
    rows. Only line hashes are sorted and compared; page texts are shuffled at most
    once, and not at all when the table of deleted lines is small enough for the session to broadcast.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    key = F.xxhash64(F.col("page_id").cast("string"), "url", "html")
    host, path = host_and_path(F.col("url"))
    made = stored(rows.select(key.alias("key"), host.alias("host"), path.alias("path"), "html").mapInArrow(
        _signatures, "key long, host string, path string, hashes array<long>, open boolean, sizes array<int>"
    ).withColumn("same", F.xxhash64("host", "hashes")).withColumn("site", F.xxhash64("host")), "page-lines")
    different = made.groupBy("site", "host", "same").agg(
        F.min(F.struct("path", "hashes", "sizes")).alias("first"), F.max("open").alias("open")
    ).select("site", "host", "same", "first.*", "open")
    order = [F.col("host"), F.col("path"), F.col("same")]
    placed = stored(numbered(different, order, "place", "page-order"), "page-places")
    # Of one host at most twice the lines of its mean page can be on more than half of its pages.
    pages_of = placed.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    frequent = placed.select("site", F.explode(F.array_distinct("hashes")).alias("line")).groupBy("site", "line").count()
    frequent = frequent.where(F.col("count") >= FREQUENT).join(pages_of, "site").where("2 * count > pages")
    hosts = pages_of.join(frequent.groupBy("site").agg(F.collect_list("line").alias("frequent")), "site", "left")
    hosts = stored(hosts.where("pages > 1"), "page-hosts")
    beside = lambda step, name: placed.select(
        (F.col("place") + step).alias("place"), *[F.col(c).alias(f"{name}_{c}") for c in ("host", "path", "hashes")]
    )
    near = placed.join(hosts, "site").where("open OR frequent IS NOT NULL")
    near = near.join(beside(1, "before"), "place", "left").join(beside(-1, "after"), "place", "left")
    gone = stored(near.mapInPandas(_shared, "same long, gone array<int>, notices array<int>"), "page-shared")
    gone = stored(made.select(F.col("key").alias("other"), "same").distinct().join(gone, "same").drop("same"), "page-gone")
    joined = rows.withColumn("key", key).join(gone, F.col("key") == F.col("other"), "left")
    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "html", "gone", "notices").mapInArrow(
        _texts, f"page_id {kind}, url string, text string, n_chars long"
    )
