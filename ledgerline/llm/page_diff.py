"""Main text of web pages by nearest-URL page differencing.

A page's blocks of text become lines. Blocks in elements that never hold an
article (menus, page headers, footers, sidebars, notices, adverts, forms,
scripts, comments) go. Each page is then paired with its nearest pages by URL
path within the host, the lines of the two are aligned by longest common
subsequence, and lines that both have are template and deleted.

A class or id names an element outside the article by any word in it; inside
an article only if the whole name says so. A form that holds the article is none to drop.

A page with an ``article`` (else ``main``) is reduced to it, and its lines are
compared like those of any page. Two articles may quote the same passage, so
there a line goes only if the ``SEVERAL`` nearest neighbours that aren't copies
all have it at the same place in the structure (path of tags); an article with
fewer such neighbours keeps its lines. Elsewhere the nearest such neighbour decides. A neighbour is a copy, not
evidence of a template, if it leaves no line of the page or nearly none of
those lines that no third page of the host has; then the next nearest is
taken. However long the template is, it has no weight there. Pages of equal lines within a host are folded first, so
neighbours differ. A page that finds too few in the ``REACH`` before and after
it goes on in rounds, each twice as far as the one before, until it has them
or its host has no more; without any the lines stay. A neighbour is seen with
all its lines, in its article or not.

Scale: pages are read once. Only contents with a line that enough others of the
host have look for partners; no other can lose a line. Neighbours come from a distributed sort of (host,
path), so a host with a third of all pages splits like any other; pairs are
joined with 64-bit hashes of their lines, not with the lines. A pair is
aligned in one task: the memory is that of two pages. Rounds are a written
table each, as many as the logarithm of the longest way to a partner.

Defined results: null or empty html gives an empty text; a null or broken URL
has an empty host and no neighbour; pages that repeat are copies of each
other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from bisect import bisect_left
from collections.abc import Hashable, Iterator, Sequence
from hashlib import blake2b
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import col, stage_table
from ledgerline.operators.features import global_rank

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

RAW = frozenset("script style textarea title xmp noembed noframes plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var label".split())
DROPPED = frozenset("head nav footer aside form noscript template iframe svg math button select option dialog menu object "
                    "canvas audio video map fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form "
                  "advertisement note".split())
#: Words of a class or id that mark an element as outside the article.
MARKS = frozenset("nav navbar navigation menu menus submenu breadcrumb breadcrumbs masthead footer sidebar aside ad ads advert adverts "
                  "advertisement advertising advertorial sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                  "notices notification alert popup modal overlay newsletter subscribe subscription signup login search share sharing "
                  "social related recommended recommendations comment comments disqus reply replies respond pagination pager toolbar "
                  "widget copyright skip hidden topbar bottombar paywall tracking".split())
#: Words for a box, which beside a mark don't change what a class of an article's part means.
BOXES = frozenset("box block list section container wrapper wrap area links link bar item items unit slot button buttons form inner outer "
                  "content posts articles stories panel row".split())
#: An article or main element, or the end of a form.
HELD = re.compile(r"<(?:article|main)\b|</form\b", re.I)
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "p": "p"}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
                 r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
#: What may begin without an end and then takes the rest of the page.
OPENER = re.compile(r"<[!?]")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: A neighbour that shares at least this part of the characters that no third page has is a copy.
COPY = 0.9
#: Pages before and after in URL order that are looked at in the first round.
REACH = 3
#: Neighbours that must share a line of an article before it goes.
SEVERAL = 3
#: Rows of the table of deletions up to which it is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000
#: Bits of alignment state that are kept at once.
STATE_BITS = 1 << 28


def _marked(value: str, in_article: bool) -> set[str]:
    """The words of class or id names that are marks. Inside an article a name counts as a whole: all its words
    are marks or words for a box, so that ``ad-box`` is one and ``social-policy`` isn't."""
    if not in_article:
        return {w.lower() for w in WORDS.findall(value)} & MARKS
    out: set[str] = set()
    for name in value.split():
        words = {w.lower() for w in WORDS.findall(name)}
        if words <= MARKS | BOXES:
            out |= words & MARKS
    return out


def _outside(tag: str, attributes: str, in_article: bool) -> bool:
    """Does the element stand outside the article?"""
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    if not attributes or tag in ("html", "body", "main") or re.fullmatch("h[1-6]", tag):
        return False
    for name, *value in ATTRIBUTE.findall(attributes):
        name, v = name.lower(), "".join(value)
        if name == "hidden" or name == "aria-hidden" and v.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", v):
            return True
        if name == "role" and v.lower() in ROLES:
            return True
        if name in ("class", "id"):
            marks = _marked(v, in_article)
            if marks and not (tag == "article" and not marks & {"comment", "comments", "reply", "ad", "advert", "related", "promo"}):
                return True
            if not in_article and "header" in {w.lower() for w in WORDS.findall(v)}:
                return True
    return False


def blocks(html: str) -> list[tuple[str, int]]:
    """The page's lines in order with their place: 2 in an article, 1 in a main element, 0 elsewhere."""
    return [(line, place) for line, place, _ in placed_blocks(html)]


def placed_blocks(html: str) -> list[tuple[str, int, int]]:
    """The lines of ``blocks`` and the checksum of their path of tags."""
    out: list[tuple[str, int, int]] = []
    stack: list[tuple[str, bool, int, int]] = []  # tag, outside, place, checksum of the path
    open_tags: dict[str, int] = {}
    text: list[str] = []
    at, outside, place = 0, False, 0
    last = html.rfind(">") + 1  # no tag ends behind it, so none is looked for there
    scan = html[:last] + html[last:].replace("<", " ")
    held: list[tuple[int, bool]] | None = None  # what forms may hold, found when the first form comes

    def flush() -> None:
        line = " ".join(unescape("".join(text)).split())
        text.clear()
        if line:
            out.append((line, place, stack[-1][3] if stack else 0))

    def push(tag: str, gone: bool, here: int) -> None:
        nonlocal outside, place
        path = zlib.crc32(f"/{tag}".encode(), stack[-1][3]) if stack else zlib.crc32(tag.encode())
        stack.append((tag, gone, here, path))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        outside, place = gone, here

    def pop_to(k: int) -> None:
        nonlocal outside, place
        for s in stack[k:]:
            open_tags[s[0]] -= 1
        del stack[k:]
        outside, place = (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def holds_article(start: int) -> bool:
        nonlocal held
        if held is None:
            held = [(m.start(), m.group()[1] != "/") for m in HELD.finditer(html)]
        k = bisect_left(held, (start, False))
        return k < len(held) and held[k][1]

    while True:
        m = TAG.search(scan, at)
        if not outside:
            end = m or OPENER.search(html, max(at, last))  # a comment or declaration that never ends takes the rest
            text.append(html[at:end.start() if end else len(html)])
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag not in INLINE:
                flush()
            if open_tags.get(tag):
                pop_to(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
            at = end.start() if end else len(html)
            close = html.find(">", at)
            at = close + 1 if end and close >= 0 else len(html)
            continue
        if tag == "br" or tag == "wbr":
            if not outside and tag == "br":
                text.append(" ")
            continue
        gone = _outside(tag, m[3], place == 2) and not (tag == "form" and place < 2 and holds_article(at))
        if tag in INLINE:
            if gone and not outside:
                push(tag, True, place)
            continue
        flush()
        if tag in VOID or m[3].rstrip().endswith("/") and tag in ("svg", "path"):
            continue
        for other in CLOSES.get(tag, "").split():
            if stack and stack[-1][0] == other:
                pop_to(len(stack) - 1)
        here = max(place, 2 if tag == "article" else 1 if tag == "main" or 'role="main"' in m[3] else 0)
        push(tag, outside or gone, here)
    flush()
    return out


def _inner(places: Sequence[int]) -> int:
    """The place from which on lines may be the article."""
    return max(places, default=0)


def candidate_lines(html: str | None) -> tuple[list[str], bool]:
    """The lines that may be the article, and whether the page leaves open which they are."""
    found = blocks(html or "")
    inner = _inner([p for _, p in found])
    return [line for line, p in found if p >= inner], not inner


def _hash(line: str) -> int:
    return int.from_bytes(blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _masks(b: Sequence[Hashable]) -> dict[Hashable, int]:
    masks: dict[Hashable, int] = {}
    for j, line in enumerate(b):
        masks[line] = masks.get(line, 0) | 1 << j
    return masks


def _rows(a: Sequence[Hashable], b: Sequence[Hashable], keep: bool) -> list[int]:
    """Bit-parallel alignment state after each line of ``a`` (only the last if not ``keep``): zero bits count matches."""
    full, masks = (1 << len(b)) - 1, _masks(b)
    v, rows = full, []
    for line in a:
        m = masks.get(line, 0)
        u = v & m
        v = ((v + u) | (v - u)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def _lengths(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[int]:
    """Longest common subsequence of ``a`` with every prefix of ``b``."""
    v, out, n = _rows(a, b, False)[0], [0], 0
    for bit in bin(v | 1 << len(b))[:2:-1]:
        n += bit == "0"
        out.append(n)
    return out


def common(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[bool]:
    """For each line of ``a``: is it in a longest common subsequence with ``b``?"""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    mid_a, mid_b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    return [True] * lo + _common(mid_a, mid_b) + [True] * hi


def _common(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[bool]:
    if not a or not b:
        return [False] * len(a)
    if len(a) > 1 and len(a) * len(b) > STATE_BITS:  # in two halves, where the best alignment crosses
        k = len(a) // 2
        left, right = _lengths(a[:k], b), _lengths(a[k:][::-1], b[::-1])[::-1]
        j = max(range(len(b) + 1), key=lambda j: left[j] + right[j])
        return _common(a[:k], b[:j]) + _common(a[k:], b[j:])
    rows = [(1 << len(b)) - 1, *_rows(a, b, True)]
    out, i, j = [False] * len(a), len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:  # column j adds nothing to the first i lines
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1 and (rows[i] & ((1 << j) - 1)).bit_count() == (rows[i - 1] & ((1 << j) - 1)).bit_count():
            i -= 1
        elif a[i - 1] == b[j - 1]:
            out[i - 1] = True
            i, j = i - 1, j - 1
        else:
            i -= 1
    return out


def _shared(a: list[Hashable], b: list[Hashable]) -> list[bool]:
    return [False] * len(a) if set(a).isdisjoint(b) else common(a, b)


def is_copy(h: list[int], shared: list[bool], chars: list[int], one: set[int], two: set[int], two_only: bool) -> bool:
    """Is the neighbour with the ``shared`` lines a copy of the page?

    ``one`` and ``two`` are the lines that one and two contents of the host have, ``two_only`` is a host of two contents.
    """
    if all(shared):
        return True
    own = [(n, s) for x, n, s in zip(h, chars, shared, strict=True) if x in one or s and x in two]
    size = sum(n for n, _ in own)
    return not two_only and size > 0 and sum(n for n, s in own if s) >= COPY * size


def _judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For pairs: is the neighbour a copy, and which lines of the page does it share (at the same place if marked)?"""
    for b in batches:
        copies, masks = [], []
        for is_open, h, at, chars, one, two, two_only, h2, at2 in zip(
                *[b[c] for c in ("open", "h", "at", "chars", "one", "two", "two_only", "h2", "at2")], strict=True):
            h, h2 = h.tolist(), h2.tolist()
            shared = _shared(h, h2)
            copies.append(is_copy(h, shared, chars.tolist(), set(one.tolist()), set(two.tolist()), two_only))
            if not is_open and not copies[-1] and any(shared):
                shared = _shared(list(zip(h, at.tolist(), strict=True)), list(zip(h2, at2.tolist(), strict=True)))
            masks.append(shared)
        yield b[["row", "rank"]].assign(copy=copies, shared=masks)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text): one row a row of ``pages``."""
    kind = pages.select(col(id_col)).schema[0].dataType.simpleString()
    types = {"key": pa.binary(), "lines": pa.list_(pa.string()), "open": pa.bool_(), "h": pa.list_(pa.int64()), "at": pa.list_(pa.int64()),
             "mine": pa.list_(pa.bool_()), "chars": pa.list_(pa.int32())}

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in types}
            for html in b.column("html").to_pylist():
                found = placed_blocks(html or "")
                inner = _inner([p for _, p, _ in found])
                out["lines"].append([line for line, p, _ in found if p >= inner])
                out["open"].append(not inner)
                out["key"].append(blake2b("\n".join([str(not inner), *out["lines"][-1]]).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                out["h"].append([_hash(line) for line, _, _ in found])
                out["at"].append([at for _, _, at in found])
                out["mine"].append([p >= inner for _, p, _ in found])
                out["chars"].append([len(line) for line, _, _ in found])
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), *[pa.array(out[k], t) for k, t in types.items()]],
                                             names=["id", "url", *types])

    p = pages.select(col(id_col).alias("id"), col(url_col).alias("url"), col(html_col).alias("html"))
    p = p.mapInArrow(parsed, f"id {kind}, url string, key binary, lines array<string>, open boolean, h array<long>, at array<long>, mine array<boolean>, chars array<int>")
    url = F.coalesce("url", F.lit(""))
    p = stage_table(p.withColumn("row", F.monotonically_increasing_id())
                    .withColumn("host", F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)))
                    .withColumn("path", F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)), "lines", compression="zstd")  # the texts, the largest table
    known = p.where("host <> '' AND size(lines) > 0")
    firsts = known.groupBy("host", "key").agg(F.min(F.struct("path", "row")).alias("first")).select(F.col("first.row").alias("row"))
    contents = stage_table(known.join(firsts, "row").select("row", "host", "key", "path", "open", "h", "at", "mine", "chars"), "contents")
    drops = stage_table(_template(contents), "drops")
    d = drops.select(F.col("host").alias("host2"), F.col("key").alias("key2"), "drop")
    n = drops.count()
    j = p.select("id", "url", "lines", "host", "key")
    if n:
        j = j.join(F.broadcast(d) if n <= BROADCAST_ROWS else d, (F.col("host") == F.col("host2")) & (F.col("key") == F.col("key2")), "left")
        left = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x, i: ~F.get(F.col("drop"), i)))
    else:
        left = F.col("lines")
    return j.select("id", "url", F.array_join(left, "\n").alias("text"))


def _supported(contents: DataFrame) -> DataFrame:
    """Rows whose contents can lose a line: they have a candidate line that enough other contents of the host have.

    A line of an article goes only if ``SEVERAL`` neighbours have it at its
    place, one of an open page only if another page has it; so no other content
    needs a partner. Lines are counted by a hash; a collision only looks for a partner in vain.
    """
    mine, is_open = F.col("mine"), F.col("open")
    key = lambda x, at: F.xxhash64(F.col("host"), x, at)
    anywhere = bool(contents.where("open").limit(1).count())
    placed = F.zip_with("h", "at", key)
    seen = F.concat(placed, F.transform("h", lambda x: key(x, F.lit(-1).cast("long")))) if anywhere else placed
    counted = contents.select(F.explode(F.array_distinct(seen)).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = F.when(is_open, F.transform("h", lambda x: key(x, F.lit(-1).cast("long")))).otherwise(placed)
    wants = contents.select("row", "open", F.explode(F.filter(own, lambda x, i: F.get(mine, i))).alias("k")).join(counted, "k")
    return wants.where(F.col("n") > F.when(is_open, 1).otherwise(SEVERAL)).select("row").distinct()


def _own(contents: DataFrame, rows: DataFrame) -> DataFrame:
    """The candidate lines of the contents ``rows``, and which of their lines one (``one``) or two (``two``) contents of the host have."""
    lines = contents.select("host", "row", F.explode(F.array_distinct("h")).alias("x"))
    held = lines.groupBy("host", "x").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("a"), F.max("row").alias("b")).where("n <= 2")
    held = held.select("n", "x", F.explode(F.array_distinct(F.array("a", "b"))).alias("row")).join(rows, "row", "left_semi")
    rare = held.groupBy("row").agg(
        F.collect_list(F.when(F.col("n") == 1, F.col("x"))).alias("one"), F.collect_list(F.when(F.col("n") == 2, F.col("x"))).alias("two"))
    twos = contents.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("a"), F.max("row").alias("b")).where("n = 2")
    twos = twos.select(F.explode(F.array("a", "b")).alias("row"), F.lit(True).alias("two_only"))
    mine = lambda c: F.filter(c, lambda x, i: F.get(F.col("mine"), i)).alias(c)
    none = F.array().cast("array<long>")
    own = contents.join(rows, "row", "left_semi").select("row", "open", mine("h"), mine("at"), mine("chars"))
    return own.join(rare, "row", "left").join(twos, "row", "left").select(
        "row", "open", "h", "at", "chars", F.coalesce("one", none).alias("one"), F.coalesce("two", none).alias("two"),
        F.coalesce("two_only", F.lit(False)).alias("two_only"))


def _template(contents: DataFrame) -> DataFrame:
    """(host, key, drop): the lines to delete, as a flag for each candidate line, of contents that have any."""
    rows = stage_table(_supported(contents), "supported")
    if not rows.limit(1).count():
        return contents.select("host", "key", F.array(F.lit(True)).alias("drop")).limit(0)
    contents = contents.join(contents.join(rows, "row", "left_semi").select("host").distinct(), "host", "left_semi")  # neighbours are of the host
    own = stage_table(_own(contents, rows), "own")
    ranked = stage_table(global_rank(contents.select("row", "host", "path", "open"), [F.col("host"), F.col("path"), F.col("row")], "g"), "order")
    todo, nearest, width, found = ranked.join(rows, "row", "left_semi"), 1, REACH, None
    while True:
        pairs = stage_table(_pairs(todo, ranked, own, contents, nearest, nearest + width - 1), "pairs")
        now = pairs.where("NOT copy").select("row", F.struct(F.lit(nearest).alias("from"), "rank").alias("rank"), "shared")
        found = now if found is None else found.unionByName(now)
        have = found.groupBy("row").agg(F.count(F.lit(1)).alias("n"))
        short = F.coalesce("n", F.lit(0)) < F.when(F.col("open"), 1).otherwise(SEVERAL)
        todo = stage_table(todo.join(pairs.select("row").distinct(), "row").join(have, "row", "left").where(short).drop("n"), "todo")
        if not todo.limit(1).count():
            break
        nearest, width = nearest + width, 2 * width
    found = found.withColumn("k", F.row_number().over(Window.partitionBy("row").orderBy("rank"))).where(F.col("k") <= SEVERAL)
    masks = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "shared"))).alias("masks"))  # SEVERAL at most
    both = lambda a, x: F.zip_with(a, x["shared"], lambda u, v: u & v)
    masks = contents.select("row", "host", "key", "open").join(masks, "row")
    drop = F.when(F.col("open"), F.get("masks", F.lit(0))["shared"]).when(
        F.size("masks") >= SEVERAL, F.aggregate("masks", F.get("masks", F.lit(0))["shared"], both))
    return masks.select("host", "key", drop.alias("drop")).where(F.exists("drop", lambda x: x))


def _pairs(todo: DataFrame, ranked: DataFrame, own: DataFrame, contents: DataFrame, nearest: int, farthest: int) -> DataFrame:
    """(row, rank, copy, shared) of the contents of ``todo`` and those ``nearest`` to ``farthest`` away in the order of their host."""
    steps = F.transform(F.sequence(F.lit(nearest), F.lit(farthest)), lambda k: F.array(-k, k))
    near = todo.select("row", "host", "path", F.explode(F.flatten(steps)).alias("k"), "g").withColumn("g2", F.col("g") + F.col("k"))
    other = ranked.select(F.col("g").alias("g2"), F.col("host").alias("host2"), F.col("path").alias("p2"), F.col("row").alias("r2"))
    # the one with the longer common path first
    depth = F.size(F.split("path", "/")) + F.size(F.split("p2", "/"))
    same = F.aggregate(F.zip_with(F.split("path", "/"), F.split("p2", "/"), lambda a, b: a.eqNullSafe(b)), F.struct(F.lit(True).alias("on"), F.lit(0).alias("n")),
                       lambda a, x: F.struct((a["on"] & x).alias("on"), (a["n"] + F.when(a["on"] & x, 1).otherwise(0)).alias("n")))["n"]
    rank = F.struct((-same).alias("away"), depth.alias("depth"), F.col("g2").cast("long").alias("g2"))
    near = near.join(other, "g2").where("host = host2").select("row", "r2", rank.alias("rank"))
    near = near.join(own, "row")
    near = near.join(contents.select(F.col("row").alias("r2"), F.col("h").alias("h2"), F.col("at").alias("at2")), "r2").drop("r2")
    return near.mapInPandas(_judged, "row long, rank struct<away:int,depth:int,g2:long>, copy boolean, shared array<boolean>")
