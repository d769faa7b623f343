"""Main text of web pages by differencing each page against the page with the nearest URL.

A page is read into text lines, one per block. Pages of a host are paired by URL path: a page's partner is, of the pages before and after it in the
order of paths, the one that shares the longer start of the path. The lines of both are aligned by longest common
subsequence, and shared lines are deleted. A partner that is a copy (of the shorter page's lines, `copy_share` or more are shared) says
nothing about boilerplate; then the other one is asked, and if both are copies nothing is deleted.

Every page is aligned. What the markup says outright is checked afterwards and wins over the alignment: lines of navigation, headers, footers,
sidebars, notices, adverts, forms and comments go although no other page has them, and the paragraphs, headings, list items, cells and quotes
inside the page's article (<article> or <main>) stay although another page has them: two articles may quote the same passage. Lines of an
article that stand in none of these (text of a bare <div>, say) are the alignment's to delete. Where a page has an article, lines outside of it go.

Lines are compared by 64-bit hashes, so what is shuffled for the pairing is a few bytes a line, ranged by host and path: a host with a third of all pages is
many ranges. Pages at the ends of a range are paired in a second step over two rows a range, so that the result doesn't depend on where ranges end.

Defined cases: null or empty html gives an empty text; a null URL is host and path of nothing, among themselves; a page alone on its
host loses no line; repeated rows are copies of each other and get the same text; white space is what str.split takes. Texts are whole. Other columns
pass through; input columns with the names of the outputs are replaced.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.llm.common import materialise, tidy

#: ARTICLE: in a text element of an article; LOOSE: in an article, but in no such element; OPEN: outside of articles.
ARTICLE, LOOSE, OPEN, BOILERPLATE = "a", "l", "o", "b"
_NAME = re.compile(r"</?([A-Za-z][^\s/>\"']*)")
_ATTR = re.compile(r"""(class|id|role|style|aria-hidden|hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|\Z)""", re.I)
#: Elements whose content is never text of the page.
_RAW = frozenset("script style noscript template iframe svg math canvas object title textarea select option button audio video head".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements that stay open until their end tag; what is said of them holds for all inside.
_SCOPE = frozenset("article aside blockquote body details dialog div dl fieldset figure footer form header li main menu nav ol p section span table td tr ul".split())
#: Elements that say of what is in them that it is text; the second kind ends with the next block.
_TEXT, _LINE = frozenset("p li td blockquote".split()), frozenset("h1 h2 h3 h4 h5 h6 pre dt dd th caption figcaption".split())
_GONE = frozenset("nav footer aside form menu dialog fieldset".split())
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer masthead topbar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations comment comments disqus reply replies respond widget toolbar pagination pager search "
    "copyright skip".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())


def _gone(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _GONE or (tag == "header" and not in_article):
        return True
    if not attrs.strip() or tag in ("body", "html", "main"):
        return False
    for name, *value in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(value).lower()
        if name in ("class", "id") and not _HINTS.isdisjoint(re.split(r"[\s_-]+", value)):
            return True
        if (name == "role" and value.strip() in _ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in ("class", "id") and not in_article and "header" in re.split(r"[\s_-]+", value):
            return True
    return False


class _Marks:
    """Where the tags of a page end, in time that grows with the page, however broken its tags are."""

    def __init__(self, page: str):
        self.page = page
        self.at = {c: [m.start() for m in re.finditer(c, page)] for c in (">", '"', "'")}
        self.marks = sorted(x for v in self.at.values() for x in v)
        self.ends: dict[int, int] = {}  # of marks outside of quotes

    def next(self, c: str, start: int) -> int:
        found = self.at[c]
        k = bisect_left(found, start)
        return found[k] if k < len(found) else -1

    def end(self, start: int) -> int:
        """After the > that ends a tag that goes on at `start`, quoted ones left out; -1 if none does."""
        path = []
        while True:
            k = bisect_left(self.marks, start)
            if k == len(self.marks):
                out = -1
                break
            mark = self.marks[k]
            if mark in self.ends:
                out = self.ends[mark]
                break
            path.append(mark)
            if self.page[mark] == ">":
                out = mark + 1
                break
            close = self.next(self.page[mark], mark + 1)
            if close < 0:
                out = -1
                break
            start = close + 1
        self.ends |= dict.fromkeys(path, out)
        return out

    def tag(self, start: int) -> tuple[int, int, bool, str, str] | None:
        """The first tag from `start` on: its start and end, whether it is an end tag, its name in lower case ('' for comments and declarations) and its attributes."""
        page, at = self.page, start
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                close = page.find("-->", at + 4)
                return at, close + 3 if close >= 0 else len(page), False, "", ""
            if page.startswith(("<!", "<?"), at):
                if (close := self.next(">", at)) >= 0:
                    return at, close + 1, False, "", ""
            elif (first := at + 1 + page.startswith("</", at)) < len(page) and page[first].isascii() and page[first].isalpha() and (end := self.end(first)) >= 0:
                m = _NAME.match(page, at, end)
                return at, end, first > at + 1, m[1].lower(), page[m.end() : end - 1]
            at += 1
        return None


def lines(page: str | None) -> list[tuple[str, str]]:
    """(zone, text) of each block of a page, in page order."""
    page = page or ""
    out: list[tuple[str, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, str]] = []  # (element, zone inside it)
    zone, at, inline, held = OPEN, 0, {}, Counter()  # held: open elements by tag
    marks, endless, line = _Marks(page), set(), False  # line: in an element of _LINE

    def close() -> None:
        if parts:
            if text := " ".join("".join(parts).split()):
                out.append((ARTICLE if line and zone == LOOSE else zone, text))
            parts.clear()

    while at < len(page):
        m = marks.tag(at)
        if m is None:
            parts.append(entities.unescape(page[at:]))
            break
        start, end, closes, tag, attrs = m
        if start > at:
            parts.append(entities.unescape(page[at:start]))
        at = end
        if not tag:
            continue
        if tag in _RAW:
            if not closes and not attrs.endswith("/") and tag not in endless:
                raw_end = inline.get(tag) or inline.setdefault(tag, re.compile(rf"</{tag}\s*>", re.I))
                found = raw_end.search(page, at)
                if found is None:
                    endless.add(tag)
                # an unclosed head ends where the body begins; other unclosed raw elements take the rest
                if found is None and tag == "head":
                    found = re.compile(r"(?=<body\b)", re.I).search(page, at)
                    at = found.end() if found else at
                else:
                    at = found.end() if found else len(page)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            close()
            line = tag in _LINE and not closes
        if tag not in _SCOPE:
            continue
        if closes:
            for k in range(len(stack) - 1 if held[tag] else -1, -1, -1):
                if stack[k][0] == tag:
                    if tag == "span" and stack[k][1] != (stack[k - 1][1] if k else OPEN):
                        close()
                    held.subtract(x for x, _ in stack[k:])
                    del stack[k:]
                    break
                if tag in ("span", "p") and stack[k][0] not in ("span", "p"):
                    break  # an inline end tag doesn't end what it stands in
        elif not attrs.endswith("/"):
            if tag == "p" and stack and stack[-1][0] == "p":
                held[stack.pop()[0]] -= 1
            outer = stack[-1][1] if stack else OPEN
            inner = outer
            if outer != BOILERPLATE:
                if _gone(tag, attrs, outer != OPEN):
                    inner = BOILERPLATE
                elif outer == OPEN and tag in ("article", "main"):
                    inner = LOOSE
                elif outer == LOOSE and tag in _TEXT:
                    inner = ARTICLE
            if tag == "span" and inner != outer:
                close()
            stack.append((tag, inner))
            held[tag] += 1
        zone = stack[-1][1] if stack else OPEN
    close()
    return out


def _rows(a: list, b: list) -> Iterator[int]:
    """Bit-parallel rows of the table of common subsequences: bit j of a row is clear where b[j] lengthens the longest one of that part of `a` and b[:j]."""
    at: dict = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    yield v
    for x in a:
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: list, b: list) -> np.ndarray:
    """Lengths of the longest common subsequences of `a` and b[:j], j from 0 on."""
    for v in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(-(-len(b) // 8), "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def shared(a: list, b: list, most_bits: int = 1 << 26) -> set[int]:
    """Positions in `a` of a longest common subsequence of `a` and `b`. Equal ends go first; where the table would have more than `most_bits` bits, the problem is split in the middle of `a`."""
    common = set(a) & set(b)
    left, right = [i for i, x in enumerate(a) if x in common], [x for x in b if x in common]
    out: set[int] = set()
    work = [(left, right)]
    while work:
        left, right = work.pop()
        head = 0
        while head < min(len(left), len(right)) and a[left[head]] == right[head]:
            head += 1
        tail = 0
        while tail < min(len(left), len(right)) - head and a[left[-1 - tail]] == right[-1 - tail]:
            tail += 1
        out.update(left[:head]), out.update(left[len(left) - tail :])
        left, right = left[head : len(left) - tail], right[head : len(right) - tail]
        if not left or not right:
            continue
        mine = [a[i] for i in left]
        if len(left) > 1 and len(left) * len(right) > most_bits:
            mid = len(left) // 2
            j = int((_lengths(mine[:mid], right) + _lengths(mine[mid:][::-1], right[::-1])[::-1]).argmax())
            work += [(left[:mid], right[:j]), (left[mid:], right[j:])]
            continue
        rows, i, j = list(_rows(mine, right)), len(left), len(right)
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1
            elif not rows[i - 1] >> (j - 1) & 1:
                i -= 1
            else:
                out.add(left[i - 1])
                i, j = i - 1, j - 1
    return out


def _start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def deleted(page: tuple, before: tuple | None, after: tuple | None, copy_share: float) -> set[int]:
    """Lines of `page` to delete; pages are (host, path, hashes)."""
    near = [p for p in (before, after) if p is not None and p[0] == page[0]]
    near.sort(key=lambda p: -_start(page[1], p[1]))
    for p in near:
        same = shared(page[2], p[2])
        if len(same) < copy_share * min(len(page[2]), len(p[2])):
            return same
    return set()


def undecided(found: list[tuple[str, str]]) -> list[int]:
    """The lines of which the markup says neither that they are the article's text nor that they aren't: the alignment decides."""
    left = LOOSE if any(z in (ARTICLE, LOOSE) for z, _ in found) else OPEN
    return [i for i, (z, _) in enumerate(found) if z == left]


def text_of(page: str | None, gone: set[int] | None = None) -> str:
    """The main text: what the alignment left, checked against the markup: the text elements of an article stay, other lines of an article, and where there is none open lines, unless they are deleted."""
    found = lines(page)
    open_ = set(undecided(found)) - (gone or set())
    return "\n".join(t for i, (z, t) in enumerate(found) if z == ARTICLE or i in open_)


_PAIRED = "key long, gone array<int>, edge boolean, part int, pos int, host string, path string, hashes array<long>, free array<int>, o_host string, o_path string, o_hashes array<long>"


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def differences(pages: DataFrame, *, page: str = "html", copy_share: float = 0.8) -> DataFrame:
    """(key, gone): of each page, the numbers of the lines that its partner shares. Those of which the markup says what they are aren't given, so few rows are joined."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                found = [lines(x) for x in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([[_hash(t) for _, t in f] for f in found], pa.list_(pa.int64())), pa.array([undecided(f) for f in found], pa.list_(pa.int32()))],
                    names=["key", "host", "path", "hashes", "free"],
                )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        names = [f.name for f in schema.fields]
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))

        def edge(row: tuple, pos: int, other: tuple | None) -> list:
            return [row[0], None, True, task, pos, *row[1:5], *(other[1:4] if other else [None] * 3)]

        def batch(out: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        out: list[list] = []
        before, row = None, next(rows, None)
        while row is not None:
            after = next(rows, None)
            if before is None:
                out.append(edge(row, 0 if after else 2, after))
            elif after is None:
                out.append(edge(row, 1, before))
            elif gone := deleted(row[1:4], before[1:4], after[1:4], copy_share).intersection(row[4]):
                out.append([row[0], sorted(gone), False, task, 0, *[None] * 7])
            if len(out) >= 512:
                yield batch(out)
                out = []
            before, row = row, after
        if out:
            yield batch(out)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        for i, (key, _, pos, *rest) in enumerate(ends):
            page, free, inner = tuple(rest[:3]), rest[3], tuple(rest[4:]) if rest[4] is not None else None
            before = tuple(ends[i - 1][3:6]) if pos in (0, 2) and i else inner if pos == 1 else None
            after = tuple(ends[i + 1][3:6]) if pos in (1, 2) and i + 1 < len(ends) else inner if pos == 0 else None
            if gone := deleted(page, before, after, copy_share).intersection(free):
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([sorted(gone)], pa.list_(pa.int32()))], names=["key", "gone"])

    schema = T._parse_datatype_string(_PAIRED)
    ints, hashes = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = [pa.int64(), ints, pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.string(), hashes, ints, pa.string(), pa.string(), hashes]
    read_in = pages.select("__key", "__host", "__path", F.col(page).cast("string")).mapInArrow(tidy(read), "key long, host string, path string, hashes array<long>, free array<int>")
    ranged = read_in.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    paired, _ = materialise(ranged.mapInArrow(tidy(align), schema))
    # two rows a range: the number of ranges bounds what this one task reads
    ends = paired.where("edge").select("key", "part", "pos", "host", "path", "hashes", "free", "o_host", "o_path", "o_hashes").coalesce(1).sortWithinPartitions("part", "pos")
    done = ends.mapInArrow(tidy(finish), "key long, gone array<int>")
    return paired.where("not edge and gone is not null").select("key", "gone").unionByName(done)


def extract(pages: DataFrame, *, id_col: str = "page_id", url: str = "url", page: str = "html", copy_share: float = 0.8) -> DataFrame:
    """Adds text and n_chars to every page."""
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(address, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    rows = pages.select(*kept).withColumns(
        {
            "__key": F.xxhash64(F.col(id_col), F.col(url), F.col(page)),
            "__host": F.lower(F.substring_index(bare, "/", 1)),
            "__path": F.when(F.contains(bare, F.lit("/")), F.regexp_replace(bare, "^[^/]*", "")).otherwise(F.lit("")),
        }
    )
    gone = differences(rows, page=page, copy_share=copy_share).groupBy(F.col("key").alias("__gone_key")).agg(F.min("gone").alias("__gone"))
    joined = rows.join(gone, F.col("__key") == F.col("__gone_key"), "left").select(*kept, "__gone")
    schema = T.StructType([*pages.select(*kept).schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    place = kept.index(page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                texts = [text_of(p, set(g) if g else None) for p, g in zip(part.column(place).to_pylist(), part.column(len(kept)).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[f.name for f in schema.fields]
                )

    return joined.mapInArrow(tidy(run), schema)
