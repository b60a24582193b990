"""Main text of web pages: structure first, then differences to the page of the nearest url.

A page is cut into blocks (texts between block-level tags). Blocks inside menus, headers, footers, sidebars, notices,
adverts, forms and reader comments, told by their tags, roles and names, are left out, and so are scripts, styles
and the head. A class or id tells so as a whole: every word of it names such a part or its container (``related-posts``,
``header-ad``), not one among others (``related-work``); names of headings, paragraphs and other texts tell nothing. If the page marks its article (``article``, ``main``, ``role=main``, a class such as
``post-content``), the mark says which blocks are the article.

Every page of a host is compared with its neighbour by url path within the host: lines are aligned by their longest
common subsequence, and shared lines are deleted, as they belong to the site and not to the page. The mark checks what the
comparison finds: a line that a neighbour has inside its marked article is no line of the site (articles may share passages, and
every paragraph of an article is to be kept), and neither is a line of the page's own marked article that the neighbour has without
any mark; a line of the article that the neighbour has outside of its own marked one is deleted; a line outside of the article goes
though it is not shared. Pages that share most of their text are copies of one article and say
nothing about the site; the nearest page that is no copy is taken then. Equal pages of a host are folded to one before, at
their first path, and all get its lines. Pages are ordered by (host, path) over range partitions, so a host of any size is
dealt over many tasks; the pages at a partition's edges are handed to its neighbours, so that texts don't depend on the
partitions. Lines are compared by 64-bit hashes, so only these are ordered and shuffled; the texts are read in a second pass.

Defined results: null or empty html gives an empty text; a null url has no host, so nothing is differenced; repeated
pages appear each; unclosed tags and cut-off pages are read to their end; extra columns are ignored.
"""

from __future__ import annotations

import re
from hashlib import blake2b, sha256
from html import unescape

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import cut, work_folder
from nimbus.llm.url_filter import host_of, path_of

COPY = 0.7        # pages that share more of both texts are copies
TEXTS = "page_id long, url string, text string, n_chars long"

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=\s|/|$))""", re.I)
_NAMED = re.compile(r"""(?:^|(?<=\s))(?:class|id)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")

# fixed values of HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea iframe object svg math title select canvas audio video".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary "
                   "table tbody td tfoot th thead tr ul".split())
_APART = frozenset("nav footer aside form menu dialog button fieldset head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NAMES = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                   "copyright dialog disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices "
                   "pager pagination paywall popup promo promoted promotion recommended related replies reply respond search share sharing "
                   "sidebar signup social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split())
_HOLDERS = frozenset("area bar block body box button buttons card carousel container content feed footer form group header icons inner item "
                     "items label left link links list main message modal nav notice outer page panel post posts right row section "
                     "sidebar site slot space thread top unit wrap wrapper zone bottom primary secondary global".split())
_PAIRS = frozenset({("side", "bar"), ("top", "bar"), ("nav", "bar"), ("sign", "up"), ("log", "in"), ("pop", "up"), ("skip", "link"), ("bread", "crumb")})
# names of these tell nothing: they hold the text itself
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr caption figcaption code em strong b i span a abbr cite q".split())
_HEADING = frozenset("article post entry story content title hero".split())
_BODIES = frozenset({("article", "body"), ("article", "content"), ("article", "text"), ("post", "body"), ("post", "content"), ("entry", "content"),
                     ("story", "body"), ("main", "content"), ("page", "content"), ("content", "body")})
_NOT = frozenset("no not without has with".split())
_REMARKS = frozenset("comment comments disqus replies reply respond".split())


def _names_apart(parts: list[str], inside: bool) -> bool:
    """Whether the words of one class or id name a part that is none of the article; ``inside`` one its own heading may stand."""
    pairs = [x for k in range(len(parts) - 1) if (x := (parts[k], parts[k + 1])) in _PAIRS]
    words = set(parts).difference(*pairs) if pairs else set(parts)
    if inside and "header" in words and words <= _HEADING | {"header"}:
        return False
    named = {w for w in words if w in _NAMES}
    return bool(named or pairs) and all(w in named or w in _HOLDERS or w.isdigit() for w in words)


def _marks(attrs: str, inside: bool) -> tuple[bool, bool, bool]:
    """(apart from the article, reader comments, the main part) as class, id and role say; ``inside`` a marked article."""
    apart = remark = main = False
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "role":
            apart |= value.lower() in _ROLES
            main |= value.lower() == "main"
        elif key == "hidden":
            apart = True
        elif key == "aria-hidden":
            apart |= value.lower() == "true"
        elif key == "style":
            apart |= "display:none" in value.replace(" ", "").lower()
        else:
            for one in value.split():
                parts = [x.lower() for x in _PART.findall(one)]
                if not parts or parts[0] in _NOT:
                    continue                  # "no-sidebar" says how the page is laid out
                apart |= _names_apart(parts, inside)
                remark |= not _REMARKS.isdisjoint(parts) and _names_apart(parts, inside)
                main |= any(x in _BODIES for x in zip(parts, parts[1:])) and len(parts) == 2
    return apart, remark, main


def _hidden(attrs: str) -> bool:
    """Whether a text element is not shown, or has another role than text."""
    return bool(attrs) and _marks(_NAMED.sub(" ", attrs), False)[0]


def blocks(html: str) -> list[tuple[bool, bool, str]]:
    """(in the marked article, only links and no paragraph, text) of each block that is not set apart, in page order."""
    out: list[tuple[bool, bool, str]] = []
    parts: list[str] = []
    linked = [0]
    # open elements: name, set apart, in the article, in comments, in a link
    stack: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]
    at, n = 0, len(html)

    def text(raw: str) -> None:
        if raw and not stack[-1][1]:
            raw = unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if stack[-1][4]:
                linked[0] += len(raw.strip())

    def flush() -> None:
        if parts:
            whole = " ".join("".join(parts).split())
            if whole:
                inner = next((x[0] for x in reversed(stack) if x[0] in _BLOCK), "")
                out.append((stack[-1][2], linked[0] >= 0.8 * len(whole) and inner != "p", whole))
            parts.clear()
            linked[0] = 0

    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        end, attrs = (m[1], m[3]) if m[2] else (m[4], m[6])
        if name == "br":
            if not stack[-1][1]:
                parts.append(" ")
            continue
        if name in _BLOCK:
            flush()
        if end:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if name not in _BLOCK and stack[k][0] in _BLOCK:
                    break                       # an inline end tag closes nothing outside its block
            continue
        if name in _VOID:
            continue
        if name in _RAW:
            if not attrs.endswith("/"):
                close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                at = close.end() if close else n
            continue
        if attrs.endswith("/") and name not in _BLOCK:
            continue
        if name == "body":
            while len(stack) > 1 and stack[-1][0] != "html":
                stack.pop()
        elif name in ("p", "li", "td", "tr", "dd", "dt", "option") or (name in _BLOCK and stack[-1][0] == "p"):
            own = {"p"} if name not in ("li", "td", "tr", "dd", "dt", "option") else {name, "p"}
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in own:
                    del stack[k:]
                    break
                if stack[k][0] in _BLOCK:
                    break
        _, apart, main, remark, link = stack[-1]
        named, comments, marked = _marks(attrs, main) if attrs and name not in _TEXT else (_hidden(attrs), False, False)
        remark |= comments
        if name in ("article", "main") or marked:
            within = any(x[0] in ("nav", "footer", "aside", "form") for x in stack)
            apart, main = remark or comments or within or (named and name == "article" and main), not (remark or within)
        elif name not in ("html", "body"):
            apart = apart or named or name in _APART or (name == "header" and not main)
        stack.append((name, apart, main and not apart, remark, link or name == "a"))
    flush()
    return out


def joined(found: list[str]) -> str:
    return "\n\n".join(found)


def marked_text(html: str | None) -> str:
    """Text of a page that marks its article; of one whose mark is empty the blocks that are not only links."""
    found = blocks(html or "")
    if any(main for main, _, _ in found):
        return joined([t for main, _, t in found if main])
    return joined([t for _, links, t in found if not links])


def common_lines(a: list, b: list) -> set[int]:
    """Places in ``a`` of a longest common subsequence of the two lists, by bit-parallel rows.

    Equal ends are taken first, and then only what stands in both lists: what is held grows with the rest.
    """
    head = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    tail = next((k for k, (x, y) in enumerate(zip(reversed(a[head:]), reversed(b[head:]))) if x != y), min(len(a), len(b)) - head)
    out = {*range(head), *range(len(a) - tail, len(a))}
    mid, other = range(head, len(a) - tail), b[head:len(b) - tail]
    both = {a[i] for i in mid}.intersection(other)
    at = [i for i in mid if a[i] in both]
    return out | {at[k] for k in _common([a[i] for i in at], [x for x in other if x in both])}


def _common(a: list, b: list) -> set[int]:
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        u = row & where.get(x, 0)
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    # bit j of a row is 0 where the common length grows at j
    out, i, j = set(), len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            if a[i] == b[j]:
                out.add(i)
                i -= 1
                j -= 1
            else:
                j -= 1
    return out


def differ(page: tuple, near: tuple) -> list[int] | None:
    """Places of the lines of ``page`` that are its text, compared with ``near``; ``None`` if the pages are copies.

    Both are (host, path, digest, codes, sizes, marked) of a page's lines.
    """
    codes, sizes, marked = page[3:]
    same = sum(sizes[i] for i in common_lines(codes, near[3]))
    if same > COPY * sum(sizes) and same > COPY * sum(near[4]):
        return None
    site = common_lines(codes, [c for c, m in zip(near[3], near[5]) if not m])
    return checked([i for i in range(len(codes)) if i not in site], marked, any(near[5]))


def checked(different: list[int], marked: list[bool], sure: bool = True) -> list[int]:
    """The lines that differ, checked by the page's mark if it has one: those of the article, and no others.

    What the comparison deletes inside of the article stands outside of the neighbour's. That is ``sure`` if the neighbour
    marks its article; else it may be a passage that the articles share, and the mark keeps it. An article is never deleted as a whole.
    """
    if not any(marked):
        return different
    article = [i for i, m in enumerate(marked) if m]
    return [i for i in different if marked[i]] or article if sure else article


def page_lines(html: str) -> tuple[list[str], list[bool]]:
    """Lines of a page that take part in the comparison, and which of them are in its marked article."""
    found = [(t, main) for main, links, t in blocks(html) if main or not links]
    return [t for t, _ in found], [main for _, main in found]


def _code(line: str) -> int:
    return int.from_bytes(blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _digest(codes: list[int], marked: list[bool]) -> str:
    return sha256(repr((codes, marked)).encode()).hexdigest()


def _marked(batches):
    for batch in batches:
        yield _rows(batch.column(0), batch.column(1), [marked_text(h.as_py()) for h in batch.column(2)])


def _rows(ids, urls, texts):
    return pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                      names=["page_id", "url", "text", "n_chars"])


CODES = "host string, path string, digest string, codes array<long>, sizes array<int>, marked array<boolean>"
_CODES = dict(zip(("host", "path", "digest", "codes", "sizes", "marked"),
                  (pa.string(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()))))


def _codes(batches):
    """(host, path, html) as (host, path, digest, codes, sizes, marked): all that the comparison needs of a page."""
    for batch in batches:
        digests, codes, sizes, marks = [], [], [], []
        for h in batch.column(2):
            lines, marked = page_lines(h.as_py())
            codes.append([_code(t) for t in lines])
            digests.append(_digest(codes[-1], marked))
            sizes.append([len(t) for t in lines])
            marks.append(marked)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(x, t) for x, t in zip((digests, codes, sizes, marks), list(_CODES.values())[2:]))],
                                         names=list(_CODES))


def _lines(batches):
    """(page_id, url, host, html) as (page_id, url, host, digest, lines)."""
    for batch in batches:
        digests, found = [], []
        for h in batch.column(3):
            lines, marked = page_lines(h.as_py())
            digests.append(_digest([_code(t) for t in lines], marked))
            found.append(lines)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(digests, pa.string()), pa.array(found, pa.list_(pa.string()))],
                                         names=["page_id", "url", "host", "digest", "lines"])


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


def _different(page, near):
    """The first of ``near`` that is of the page's host and no copy of it, and which lines of the page it leaves."""
    for x in near:
        if x[0] == page[0]:
            left = differ(page, x)
            if left is not None:
                return x, left
    return None, None


def _pages(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _edge(rows: list) -> list:
    """The first of ``rows`` and the first page of its host that differs from it: what a page next to them may need."""
    rows = iter(rows)
    first = next(rows, None)
    if first is None:
        return []
    other = None
    for x in rows:
        if x[0] != first[0]:
            break
        if differ(first, x) is not None:
            other = x
            break
    return [first] if other is None else [first, other]


def _edges(batches):
    """Both edges of a partition's pages, (part, is the end, rank, page)."""
    rows = list(_pages(batches))
    if rows:
        part, rows = rows[0][0], [r[1:] for r in rows]
        out = [(part, end, k, *x) for end, side in ((False, rows), (True, rows[::-1])) for k, x in enumerate(_edge(side))]
        types = {"part": pa.int32(), "last": pa.bool_(), "k": pa.int32()} | _CODES
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types.values())], names=list(types))


def _chains(edges: list) -> dict[int, tuple[list, list]]:
    """Of each partition the edge pages before it and after it, nearest first, as far as a page of its edge may need them.

    ``edges``: (part, is the end, rank, host), without the pages themselves.
    """
    sides: dict[int, dict[bool, list]] = {}
    for part, last, k, host in sorted(edges):
        sides.setdefault(part, {False: [], True: []})[last].append((part, last, k, host))
    out: dict[int, tuple[list, list]] = {p: ([], []) for p in sides}
    for at, order, last in ((0, sorted(sides), True), (1, sorted(sides, reverse=True), False)):
        for p, q in zip(order, order[1:]):
            edge = sides[p][last]
            # a partition of copies only: what lies beyond it counts too
            whole = len(edge) == 1 and edge[0][3] == sides[p][not last][0][3]
            out[q][at].extend(edge + ([x for x in out[p][at] if x[3] == edge[0][3]] if whole else []))
    return out


NEAR = "host string, digest string, kept array<int>"
LINES_A_PART = 500_000            # bounds what a task holds of pages in order


def _nearest(pages: pa.Table, beside: pa.Table) -> pa.Table:
    """The pages of one partition in order: each is compared with the nearest before or after it that is no copy of it.

    ``beside`` has the pages before the partition (side 0) and after it (side 1), nearest first.
    """
    def rows_of(t: pa.Table) -> list[tuple]:
        return list(zip(*(t[c].to_pylist() for c in _CODES)))
    rows = sorted(rows_of(pages), key=lambda x: x[:3])
    nears = [rows_of(beside.filter(pa.compute.equal(beside["side"], side)).sort_by("rank")) for side in (0, 1)]
    # of each page the nearest before and after that differ, found through its neighbour's
    found = [[None, None] for _ in rows]
    for side, order, near in ((0, range(len(rows)), nears[0]), (1, range(len(rows) - 1, -1, -1), nears[1])):
        for i in order:
            got = _different(rows[i], near)
            found[i][side] = got if got[0] is not None else None
            near = [rows[i], *([got[0]] if got[0] is not None else [x for x in near[1:] if x[0] == rows[i][0]])]
    kept = []
    for i, x in enumerate(rows):
        both = sorted((f for f in found[i] if f), key=lambda f: -_prefix(f[0][1], x[1]))
        kept.append(both[0][1] if both else checked(list(range(len(x[3]))), x[5]))
    return pa.table([pa.array([x[0] for x in rows], pa.string()), pa.array([x[2] for x in rows], pa.string()), pa.array(kept, pa.list_(pa.int32()))],
                    names=["host", "digest", "kept"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages`` (``page_id, url, html``)."""
    spark, root = pages.sparkSession, work_folder(pages.sparkSession, "html")
    url = F.coalesce("url", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host_of(url).alias("host"),
                         path_of(url).alias("path"), F.coalesce("html", F.lit("")).alias("html"))
    hosted = pages.filter("host != ''")
    # copies of a host are one page, at their first path
    once = cut(hosted.select("host", "path", "html").mapInArrow(_codes, CODES).groupBy("host", "digest")
               .agg(F.min("path").alias("path"), *(F.first(c).alias(c) for c in ("codes", "sizes", "marked"))).select(*_CODES), root, "once")
    n = (once.agg(F.sum(F.size("codes"))).first()[0] or 0) // LINES_A_PART + 1
    # checkpointed, so that both passes see the same partitions
    ordered = (once.repartitionByRange(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), "host", "path", "digest")
               .sortWithinPartitions("host", "path", "digest").checkpoint()
               .select(F.spark_partition_id().alias("part"), *_CODES))
    edges = cut(ordered.mapInArrow(_edges, f"part int, last boolean, k int, {CODES}"), root, "edges")
    # only where the edges are comes to the driver; the pages go from partition to partition
    chains = _chains([tuple(e) for e in edges.select("part", "last", "k", "host").collect()])        # at most four rows a partition
    needs = spark.createDataFrame([(q, side, rank, part, last, k) for q, both in chains.items() for side, near in enumerate(both)
                                   for rank, (part, last, k, _) in enumerate(near)],
                                  "of int, side int, rank int, part int, last boolean, k int")
    beside = needs.join(edges, ["part", "last", "k"]).select("of", "side", "rank", *_CODES)
    kept = ordered.groupBy("part").cogroup(beside.groupBy("of")).applyInArrow(_nearest, NEAR)
    text = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n\n")
    compared = (hosted.select("page_id", "url", "host", "html").mapInArrow(_lines, "page_id long, url string, host string, digest string, lines array<string>")
                .join(kept, ["host", "digest"], "left").withColumn("text", F.coalesce(text, F.lit("")))
                .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))
    return pages.filter("host = ''").select("page_id", "url", "html").mapInArrow(_marked, TEXTS).unionByName(compared)
