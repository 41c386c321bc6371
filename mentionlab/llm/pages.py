"""Operator 12: main text of web pages by differencing pages with nearest URLs.

A page is read into lines, one a block, each with the zone its markup gives it.  Pages of a
host are ordered by URL path, and each page is paired with its nearest one (the neighbour in that
order with the longer common path prefix).  The lines of a pair are aligned by a longest common
subsequence, and shared lines are deleted: what two different pages of a host have in common is
their template.  Pages with the same lines are one in that order, so copies are not
paired with each other; a pair that shares ``NEAR_COPY`` of its text otherwise (near copies)
says nothing about templates, and the neighbour on the other side is taken.

What differencing cannot see is left to the markup.  Lines inside navigation, headers, footers,
asides, forms and the like, or blocks whose class or id says advert, cookie, sidebar, comments
and so on, go even if no other page holds them; lines inside ``article`` (or, without one,
``main``) are the article and stay even if another page holds them, as syndicated articles and
repeated sentences would be lost otherwise.  Between the two, differencing decides.

Only numbers are compared across pages: a line travels as a 64-bit hash, and the pages
themselves are read twice instead of being shuffled; shared positions join back to them by a key,
as broadcast or shuffle as the planner finds by their size.  The order over a hot host is a range
shuffle (``number_rows``), and the joins go by host and place.

Defined cases: null or empty html gives empty text; a page without host has no partner;
repeated rows give equal results; blocks that are empty after trimming give no line; broken
markup is read like a browser's tolerant parser would (an end tag closes the nearest open element of
its name, unclosed elements end with their parent); ``br`` is white space inside its block;
very long pages are aligned by bit vectors in halves, so memory stays bounded.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlab.llm.common import Rows, free_name, written
from mentionlab.plans.ranking import number_rows

# Elements that start a new block (and end the one before); all others are inline.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option
p pre search section summary table tbody td tfoot th thead title tr ul""".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose text is never part of an article.
DROPPED = frozenset("""nav footer aside form head title menu dialog button select textarea iframe noscript template svg
object canvas audio video search datalist map""".split())
RAW = ("script", "style", "xmp", "noembed", "noframes")  # no markup inside
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
# Words that name what is around an article, as the first or last word of a class or id.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted
promotion banner cookie cookies consent gdpr notice notices newsletter subscribe subscription signup popup modal overlay
nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer masthead share sharing social related
recommended recommendations comment comments disqus reply replies respond widget widgets toolbar pagination pager login
search searchbox skip copyright disclaimer alert topbar sidenav subnav logo commentlist""".split())
UNMARKED = frozenset("with has no without".split())  # "has-sidebar" speaks of another block

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in RAW}

ARTICLE, MAIN, OTHER, AROUND = 0, 1, 2, 3  # zones of a line
NEAR_COPY = 0.85  # share of a page's text from which on the two of a pair are copies


def _around(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element's name or attributes say that it is no part of an article."""
    if name in DROPPED or (name == "header" and not in_article):
        return True
    if not attrs or attrs.isspace() or name in ("html", "body", "main") or name in HEADINGS:
        return False
    for m in _ATTR.finditer(attrs):
        key = m.group(1).lower()
        value = m.group(2) or m.group(3) or m.group(4) or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "role" and value.strip().lower() in ROLES:
            return True
        if key in ("class", "id"):
            for one in value.split():
                words = [w.lower() for w in _WORD.findall(one)]
                if words and not UNMARKED.intersection(words):
                    if words[0] in MARKS or words[-1] in MARKS:
                        return True
                    if not in_article and "header" in (words[0], words[-1]):
                        return True
    return False


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """The lines of a page, in order: decoded text, white space collapsed, and zone."""
    if not page:
        return []
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    # open elements: name, zone inside, whether headings only (a header inside an article)
    stack: list[tuple[str, int, bool]] = []
    zone, only_heads, heading = OTHER, False, False

    def end_block() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                lines.append((text, AROUND if only_heads and not heading else zone))

    def set_top() -> None:
        nonlocal zone, only_heads, heading
        zone, only_heads = stack[-1][1:] if stack else (OTHER, False)
        heading = any(s[0] in HEADINGS for s in stack)

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            parts.append(page[at:])
            break
        if tag > at:
            parts.append(page[at:tag])
        m = _TAG.match(page, tag)
        if not m:
            parts.append("<")
            at = tag + 1
            continue
        at = m.end()
        if m.group(2) is None:
            if page.startswith("<![CDATA[", tag):
                parts.append(entities.escape(page[tag + 9:at - 3 if page.endswith("]]>", tag, at) else at]))
            continue
        name = m.group(2).lower()
        if name in RAW and not m.group(1):
            stop = _RAW_END[name].search(page, at)
            closing = page.find(">", stop.start()) if stop else -1
            at = closing + 1 if closing >= 0 else size
            continue
        if name == "br" or name == "wbr":
            parts.append(" " if name == "br" else "")
            continue
        block = name in BLOCKS
        if m.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    end_block()
                    del stack[i:]
                    set_top()
                    break
            else:
                if block:
                    end_block()
            continue
        attrs = m.group(3)
        if name in VOID:
            if block:
                end_block()
            continue
        if block:
            end_block()
            if stack and (stack[-1][0] == "p" or stack[-1][0] == name in ("li", "dt", "dd", "tr", "td", "th", "option")):
                stack.pop()
                set_top()
        inside = zone in (ARTICLE, MAIN)
        around = zone == AROUND or _around(name, attrs, zone == ARTICLE)
        if not (block or around):
            continue  # inline elements without a say are not tracked
        end_block()
        if attrs.rstrip().endswith("/") and not block:
            continue
        new = AROUND if around else ARTICLE if name == "article" or zone == ARTICLE else MAIN if name == "main" or inside else zone
        stack.append((name, new, only_heads or (name == "header" and zone == ARTICLE)))
        set_top()
    end_block()
    return lines


def _hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


# ------------------------------------------------------------------ longest common subsequence
_CELLS = 1 << 28  # bits of the table that a trace back may hold (32 MB)


def _vectors(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """After each item of ``a`` the bit vector over ``b`` whose zeros count the common subsequence."""
    full = (1 << len(b)) - 1
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Length of the longest common subsequence of ``a`` and every prefix of ``b``."""
    v = (1 << len(b)) - 1
    for v in _vectors(a, b):  # noqa: B007 - the last one counts
        pass
    out, n = [0], 0
    for bit in reversed(bin(v | 1 << len(b))[3:]):
        n += bit == "0"
        out.append(n)
    return out


def aligned(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence of two sequences."""
    in_a, in_b = set(a), set(b)
    ia = [i for i, x in enumerate(a) if x in in_b]  # other items are in no common subsequence
    ib = [j for j, x in enumerate(b) if x in in_a]
    xa, xb = [a[i] for i in ia], [b[j] for j in ib]
    return [(ia[i], ib[j]) for i, j in _align(xa, xb, 0, 0)]


def _align(a: list[int], b: list[int], oa: int, ob: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    todo = [(a, b, oa, ob)]
    while todo:
        a, b, oa, ob = todo.pop()
        head = 0
        while head < min(len(a), len(b)) and a[head] == b[head]:
            out.append((oa + head, ob + head))
            head += 1
        a, b, oa, ob = a[head:], b[head:], oa + head, ob + head
        while a and b and a[-1] == b[-1]:
            out.append((oa + len(a) - 1, ob + len(b) - 1))
            a, b = a[:-1], b[:-1]
        if not a or not b:
            continue
        if len(a) > 1 and len(a) * len(b) > _CELLS:  # split where both halves together are longest
            half = len(a) // 2
            front = _lengths(a[:half], b)
            back = _lengths(a[half:][::-1], b[::-1])[::-1]
            cut = max(range(len(b) + 1), key=lambda j: front[j] + back[j])
            todo += [(a[:half], b[:cut], oa, ob), (a[half:], b[cut:], oa + half, ob + cut)]
            continue
        rows = list(_vectors(a, b))
        i, j = len(a), len(b)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
                if not i or rows[i - 1] >> (j - 1) & 1:
                    j -= 1
                    out.append((oa + i, ob + j))
    return sorted(out)


# ------------------------------------------------------------------ pairs of pages
_SIGNED = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                     ("sig", pa.binary()), ("lines", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
# sizes: length of each line, negative where differencing doesn't decide on it
_SIGNED_SQL = "k1 long, k2 long, host string, path string, sig binary, lines array<long>, sizes array<int>"
_URL = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(.*)", re.S)


def url_parts(url: str | None) -> tuple[str | None, str]:
    """Host (lower case) and path of a URL; query and fragment order pages of equal path."""
    m = _URL.match((url or "").strip())
    if not m or not m.group(1):
        return None, ""
    return m.group(1).lower(), (m.group(2).rstrip("/") or "/") + "\0" + m.group(3)


def _open(zones: set[int], zone: int) -> bool:
    """Whether differencing decides on a line of ``zone``: not on articles, nor where there is one."""
    return zone == OTHER and ARTICLE not in zones and MAIN not in zones or zone == AROUND


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Rows(_SIGNED, 2000)
    for b in batches:
        for k1, k2, url, page in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "url", "html")), strict=True):
            host, path = url_parts(url)
            if host is None:
                continue
            lines = page_lines(page)
            zones = {z for _, z in lines}
            hashes = [_hash(t) for t, _ in lines]
            sig = hashlib.sha256(b"".join(h.to_bytes(8, "big", signed=True) for h in hashes)).digest()[:16]
            out.rows.append((k1, k2, host, path, sig, hashes, [len(t) if _open(zones, z) else -len(t) for t, z in lines]))
            if out.full():
                yield out.take()
    if out.rows:
        yield out.take()


_SHARED = pa.schema([("host", pa.string()), ("sig", pa.binary()), ("near", pa.int32()), ("side", pa.int32()),
                     ("shared", pa.list_(pa.int32()))])


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Aligns pairs of neighbours; for each side the shared lines it may lose, unless they are near copies."""
    out = Rows(_SHARED, 5000)
    for b in batches:
        for r in b.to_pylist():
            pairs = aligned(r["lines"], r["lines2"])
            same = sum(abs(r["sizes"][i]) for i, _ in pairs)
            if same >= NEAR_COPY * min(sum(map(abs, r["sizes"])), sum(map(abs, r["sizes2"]))):
                continue  # near copies: what they share is no template
            near = _prefix(r["path"], r["path2"])
            out.rows.append((r["host"], r["sig"], near, 0, [i for i, _ in pairs if r["sizes"][i] > 0]))
            out.rows.append((r["host"], r["sig2"], near, 1, [j for _, j in pairs if r["sizes2"][j] > 0]))
            if out.full():
                yield out.take()
    if out.rows:
        yield out.take()


def shared_lines(signed: DataFrame) -> DataFrame:
    """``(host, sig, shared)``: positions of the lines that the nearest page of the host shares."""
    one = signed.groupBy("host", "sig").agg(
        F.min_by(F.struct("path", "lines", "sizes"), "path").alias("p")).select("host", "sig", "p.*")
    placed = written(number_rows(one, ["host"], ["path", "sig"]), "pages_in_order")
    after = placed.select("host", (F.col("pos") - 1).alias("pos"), *[
        F.col(c).alias(f"{c}2") for c in ("sig", "path", "lines", "sizes")])
    pairs = placed.join(after, ["host", "pos"])
    found = pairs.drop("pos").mapInArrow(_difference, "host string, sig binary, near int, side int, shared array<int>")
    best = found.groupBy("host", "sig").agg(F.max_by("shared", F.struct("near", "side")).alias("shared"))
    return best.filter(F.size("shared") > 0)


def _text(batches: Iterator[pa.RecordBatch], kept: int, fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, counts = [], []
        for page, gone in zip(b.column("html").to_pylist(), b.column("shared").to_pylist(), strict=True):
            lines = page_lines(page)
            deleted = set(gone or ())
            zones = {z for _, z in lines}
            best = ARTICLE if ARTICLE in zones else MAIN if MAIN in zones else OTHER
            texts.append("\n".join(t for i, (t, z) in enumerate(lines) if z == best and i not in deleted))
            counts.append(len(deleted))
        arrays = [b.column(i) for i in range(kept)]
        schema = pa.schema([*list(b.schema)[:kept], *fields])
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string()), pa.array(counts, pa.int32())], schema=schema)


def extract_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: Sequence[str] = ("page_id", "url"),
                 out: str = "text", shared_out: str = "n_shared") -> DataFrame:
    """``keep`` with the main text of every page and the number of its lines deleted as shared."""
    names = {c: f"in_{i}" for i, c in enumerate(keep)}

    def keys() -> list[Column]:  # rows of equal url and html have equal results
        return [F.xxhash64(F.col(url_col), F.col(html_col)).alias("k1"),
                F.xxhash64(F.lit("second"), F.col(html_col), F.col(url_col)).alias("k2")]

    plain = pages.select(*keys(), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    signed = written(plain.mapInArrow(_sign, _SIGNED_SQL), "page_lines")
    shared = shared_lines(signed)
    per_page = signed.select("k1", "k2", "host", "sig").join(shared, ["host", "sig"]) \
        .groupBy("k1", "k2").agg(F.first("shared").alias("shared"))
    per_page = written(per_page, "shared_lines")
    rows = pages.select(*[F.col(c).alias(n) for c, n in names.items()], *keys(), F.col(html_col).alias("html"))
    joined = rows.join(per_page, ["k1", "k2"], "left").select(*names.values(), "html", "shared")
    fields = pa.schema([("text", pa.string()), ("n_shared", pa.int32())])
    types = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    made, counted = free_name(joined, "text"), free_name(joined, "n_shared")
    schema = ", ".join([*[f"{n} {types[n]}" for n in names.values()], f"{made} string", f"{counted} int"])
    done = joined.mapInArrow(lambda batches: _text(batches, len(names), fields), schema)
    return done.select(*[F.col(n).alias(c) for c, n in names.items()], F.col(made).alias(out), F.col(counted).alias(shared_out))
