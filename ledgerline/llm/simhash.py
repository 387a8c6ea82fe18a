"""SimHash near-duplicates, linked exactly through a vantage-point tree.

Fingerprint: every shingle of the whole text votes with its XXH64; a bit is
set where more than half of the votes have it.

Links (Hamming distance <= ``radius``): equal fingerprints are folded first.
The 64 bits are cut into eight blocks; on each block the Hamming distance to a
vantage point (a fingerprint of the data) is one level of the tree, and a leaf
is the tuple of those distances. By the triangle bound two fingerprints differ
in at least |d(x, v) - d(y, v)| bits of a block, and blocks are disjoint, so
the bounds of all levels add up: a leaf is pruned as soon as the sum exceeds
the radius. Each fingerprint lives in one leaf and is also sent, as a query,
to the leaves that its ball overlaps (only to those "after" its own: each pair
of leaves meets once). The number of levels follows the number of distinct
fingerprints, and the levels used are the ones that split the data best, so
that leaves stay near ``leaf_rows``. Inside a leaf the distances are computed
in blocks; a leaf emits one spanning forest, never all pairs, so no link is
lost and a dense group stays linear.

Components: large-star / small-star rounds over the links, each round written
to the shared folder, until nothing changes.

Scale: the texts are read once and never shuffled; 16 bytes a distinct
fingerprint are, ``1 + m(m+1)`` times for m levels and radius 2. Only counts
reach the driver. A leaf holds distinct fingerprints only, so copies, however
many, cost nothing; fingerprints within a few bits of each other are few
(43,745 within three bits of a centre), which bounds tight clusters.

Defined results: null and blank texts have fingerprint zero and are linked
like any other; rows that repeat are one node; a null id never names a
component unless all ids of the component are null; an empty table gives an
empty result; extra columns are carried through.
"""

from __future__ import annotations

import sys
from itertools import accumulate, product, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, fresh, stage_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

SEED, SHINGLE_WORDS, MAX_BITS = 42, 3, 2
LEAF_ROWS = 4096
BLOCKS, BLOCK_BITS = 8, 8
#: Elements of a distance block inside a leaf.
BLOCK_CELLS = 1 << 21


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """XXH64 of every k-word shingle of the A-Z-lower-cased text, repeats included."""
    w = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if len(w) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), SEED)] if w else [], dtype=np.uint64)
    joined = b" ".join(w)
    ends = list(accumulate(map(len, w), lambda a, n: a + n + 1))
    pieces = map(joined.__getitem__, map(slice, [0, *(e + 1 for e in ends)], ends[k - 1:]))
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), dtype=np.uint64, count=len(w) - k + 1)


def majority_bits(h: np.ndarray) -> int:
    """The 64 bits that more than half of ``h`` have, as a signed integer.

    Bits are counted in byte lanes: eight masks a hash, at most 255 hashes a lane.
    """
    if not len(h):
        return 0
    starts = np.arange(0, len(h), 255)
    lanes = [np.add.reduceat((h >> np.uint64(b)) & np.uint64(0x0101010101010101), starts) for b in range(8)]
    counts = np.stack([x.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64) for x in lanes], axis=1)
    return int(np.packbits(counts * 2 > len(h), axis=1, bitorder="little").reshape(8).view("<i8")[0])


def fingerprint(text: Column, k: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([0 if t is None else majority_bits(shingle_hashes(t, k)) for t in texts], dtype="int64")

    return run(text)


def _block_distance(fp: Column, vantage: int, block: int) -> Column:
    mask = ((1 << BLOCK_BITS) - 1) << (block * BLOCK_BITS)
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask
    return F.bit_count(fp.bitwiseXOR(F.lit(vantage)).bitwiseAND(F.lit(mask)))


def _levels(distinct: DataFrame, leaf_rows: int) -> tuple[int, list[int]]:
    """A vantage point and the blocks to use: the best splitting ones first, until leaves are small."""
    row = distinct.agg(F.count(F.lit(1)).alias("n"), F.min_by("fp", F.xxhash64("fp")).alias("vp")).first()
    if not row["n"]:
        return 0, []
    shells = [(b, d) for b in range(BLOCKS) for d in range(BLOCK_BITS + 1)]
    counts = distinct.agg(*[F.count_if(_block_distance(F.col("fp"), row["vp"], b) == d).alias(f"c{b}_{d}") for b, d in shells]).first()
    #: the number of equally filled shells that would split as well
    split = {b: row["n"] ** 2 / sum(counts[f"c{b}_{d}"] ** 2 for d in range(BLOCK_BITS + 1)) for b in range(BLOCKS)}
    used, leaves = [], 1.0
    for b in sorted(split, key=lambda b: (-split[b], b)):
        if row["n"] <= leaves * leaf_rows or split[b] < 1.01:
            break
        used.append(b)
        leaves *= split[b]
    return row["vp"], used


def _forest(home: np.ndarray, visiting: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a leaf, as edges of a spanning forest; visitors meet the leaf's own, not each other."""
    fps = np.concatenate([home, visiting]).view(np.uint64)  # bitwise_count of a signed number is that of its absolute value
    home = fps[:len(home)]
    root = np.arange(len(fps))
    step = max(1, BLOCK_CELLS // max(1, len(fps)))
    for lo in range(0, len(home), step):
        near = np.bitwise_count(home[lo:lo + step, None] ^ fps[None, lo + 1:]) <= radius
        a, b = np.nonzero(near)
        a, b = a + lo, b + lo + 1
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (root != root[root]).any():
                root = root[root]
    child = np.nonzero(root != np.arange(len(fps)))[0]
    return fps[child].view(np.int64), fps[root[child]].view(np.int64)


def links(distinct: DataFrame, radius: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints within ``radius`` bits of each other."""
    vantage, used = _levels(distinct, leaf_rows)
    m, base = len(used), BLOCK_BITS + 1
    # leaves that a ball can overlap: own, and those whose first difference is upward
    reach = range(-radius, radius + 1)
    moves = [o for o in product(reach, repeat=m) if sum(map(abs, o)) <= radius and next((x for x in o if x), 0) > 0]
    d = F.array(*[_block_distance(F.col("fp"), vantage, b).cast("int") for b in used]).cast("array<int>")
    own = sum((F.get("d", F.lit(i)).cast("long") * base ** i for i in range(m)), F.lit(0).cast("long"))
    each = [F.struct((F.col("own") + sum(x * base ** i for i, x in enumerate(o))).alias("leaf"),
                     F.lit(False).alias("home"),
                     F.expr(" AND ".join([f"get(d, {i}) + {x} BETWEEN 0 AND {BLOCK_BITS}" for i, x in enumerate(o) if x])).alias("ok"))
            for o in moves]
    at = F.array(F.struct(F.col("own").alias("leaf"), F.lit(True).alias("home"), F.lit(True).alias("ok")), *each)
    sent = (distinct.select("fp", d.alias("d")).withColumn("own", own)
            .select("fp", F.inline(F.filter(at, lambda x: x["ok"]))).select("leaf", "fp", "home"))

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        f, own = pdf["fp"].to_numpy(), pdf["home"].to_numpy(bool)
        a, b = _forest(np.sort(f[own]), np.sort(f[~own]), radius)
        return pd.DataFrame({"a": a, "b": b})

    return sent.groupBy("leaf").applyInPandas(meet, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of ``edges`` (a, b): alternating star rounds, each written."""
    e = stage_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a vertex move to the least vertex it sees
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        e = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small star: the vertex and its neighbours below move to the least of them
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = (e.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("x"))
            .select("x.*").where("a <> b").distinct())
        e = stage_table(e, "stars")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return e.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
        state = now


def components(prints: DataFrame, radius: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(fp, component_id): the smallest id reachable from each distinct fingerprint.

    ``prints`` has ``fp`` and ``id``.
    """
    distinct = stage_table(prints.groupBy("fp").agg(F.min("id").alias("id")), "fingerprints")
    roots = connected(links(distinct, radius, leaf_rows))
    d = stage_table(distinct.join(roots, distinct["fp"] == roots["v"], "left")
                    .select("fp", "id", F.coalesce("root", "fp").alias("root")), "rooted")
    return d.join(d.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    radius: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` (16 hex digits) and ``component_id``."""
    p = stage_table(docs.select(col(id_col).alias("id"), fingerprint(col(text_col), k).alias("fp")), "prints")
    c = components(p, radius)
    return p.join(c, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                  "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                         radius: int = MAX_BITS) -> DataFrame:
    """The columns of ``docs``, one row a component: the one with the smallest id (nulls last).

    Rows that tie on the id, repeated rows included, keep the first as written.
    """
    row, fp, kid = fresh(docs, "row", "fp", "kept")
    d = stage_table(docs.withColumn(fp, fingerprint(col(text_col), k)).withColumn(row, F.monotonically_increasing_id()), "numbered")
    p = d.select(col(fp).alias("fp"), col(row).alias("row"), col(id_col).alias("doc"))
    rank = F.struct(F.col("doc").isNull(), F.col("doc"), F.col("row"))
    best = stage_table(p.groupBy("fp").agg(F.min(rank).alias("id")), "best")
    keep = components(best, radius).select(F.col("component_id")["row"].alias(kid)).distinct()
    return d.join(keep, col(row) == col(kid), "left_semi").select(*[col(c) for c in docs.columns])
