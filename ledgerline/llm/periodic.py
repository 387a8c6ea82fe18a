"""Periodic run detection by recursive frequency splitting and lag scans.

A run is a maximal stretch of consecutive words in which words ``q`` apart are
identical, ``q`` its smallest period, of at least ``max(12, 2 q)`` words. So
every word of a run occurs in it twice or more.

Splitting: a word that occurs once in its segment can be in no run there; it
splits the segment, segments of fewer than 12 words go, and the rest is
counted again until nothing changes. Most text falls away here.

Lag scan of the surviving segments: lags below ``SHORT`` compare every word
with the one a lag before it. A longer lag q between Q and 2Q (Q a power of
two) can only belong to a run that holds a whole aligned block of Q/2 words
together with its copy q words on, so blocks are compared in place of words:
block names (equal for equal blocks, built by doubling) are compared at all
lags of the band, and each hit is extended to both sides through the names of
longer and longer blocks. All lags of a segment of n words cost n log^2 n, not
n^2, also where everything repeats.

A stretch found at several lags is a run of the smallest one: by the
periodicity lemma the smallest period divides the others and has the same ends.

Many documents are scanned together in one array, kept apart by separators.
Each document is worked on where it is read; nothing is shuffled.

Defined results: null and empty texts have no words and no runs. Texts of any
length are scanned whole. Rows that repeat and null ids give a row each; runs
that overlap are all reported, ordered by start, then period. Empty tables give
an empty result. Extra columns are carried, whatever their names.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import bundle, col, own_name, unbundle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Fewest words of a run.
LEAST = 12
#: Lags from here on are scanned in blocks (a power of two; a block has half as many words).
SHORT = 16
#: Rounds of splitting; what is left then is scanned as it is (the scan is exact on any text).
ROUNDS = 64
#: Words that are scanned together (a longer document alone).
CHUNK_WORDS = 400_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The surviving words of ``x`` (word numbers >= 0, separators < 0) and their places; a separator after each segment."""
    at = np.arange(len(x))
    for _ in range(ROUNDS):
        alive = x >= 0
        seg = np.cumsum(~alive)
        i = np.flatnonzero(alive)
        if not len(i):
            break
        key = seg[i] * (int(x.max()) + 1) + x[i]
        _, inv, n = np.unique(key, return_inverse=True, return_counts=True)
        drop = (n[inv] < 2) | (np.bincount(seg)[seg[i]] - (seg[i] > 0) < LEAST)
        if not drop.any():
            break
        x = x.copy()
        x[i[drop]] = -1
        keep = (x >= 0) | np.concatenate(([False], x[:-1] >= 0))  # a separator stays after a word only
        x, at = x[keep], at[keep]
    return x, at


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    return edge[::2], edge[1::2] - edge[::2]


def _names(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Names of the blocks of 1, 2, 4, .. up to ``2**most`` words that begin at each place: equal names, equal blocks."""
    out = [np.unique(x, return_inverse=True)[1].astype(np.int64)]
    for k in range(most):
        a, half = out[-1], 1 << k
        if len(a) <= half:
            break
        out.append(np.unique(a[:-half] * len(x) + a[half:], return_inverse=True)[1].astype(np.int64))
    return out


def _extend(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from (i, j) on are equal, and how many before them."""
    ahead, back = np.zeros_like(i), np.zeros_like(i)
    for k in range(len(names) - 1, -1, -1):
        a, step = names[k], 1 << k
        p, q = i + ahead, j + ahead  # i < j
        ok = q < len(a)
        ok[ok] = a[p[ok]] == a[q[ok]]
        ahead[ok] += step
        p, q = i - back - step, j - back - step
        ok = (p >= 0) & (q < len(a))
        ok[ok] = a[p[ok]] == a[q[ok]]
        back[ok] += step
    return ahead, back


def _long_lags(x: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, length, lag) of stretches at lags from ``SHORT`` on, in segments of ``2**most`` up to twice as many words."""
    names, n = _names(x, most), len(x)
    band = SHORT
    while band <= 1 << most:
        block = band // 2
        a = names[block.bit_length() - 1]
        start = np.arange(0, max(0, n - band - block + 1), block)
        if not len(start):
            return
        padded = np.concatenate((a, np.full(2 * band + block, -1)))
        hit, lag = np.nonzero(np.lib.stride_tricks.sliding_window_view(padded, band)[start + band] == a[start][:, None])
        i, lag = start[hit], lag + band
        ahead, back = _extend(names, i, i + lag)
        good = ahead + back >= lag
        yield (i - back)[good], (ahead + back + lag)[good], lag[good]
        band *= 2


def runs(x: np.ndarray) -> np.ndarray:
    """All runs in ``x`` as rows (start, length, period), ordered by start, then period."""
    x, at = split(x)
    x = np.where(x < 0, -1 - np.arange(len(x)), x)  # separators are equal to nothing
    found = []
    for q in range(1, SHORT):
        s, m = _stretches(x[q:] == x[:-q])
        good = m >= max(q, LEAST - q)
        found.append((s[good], m[good] + q, np.full(good.sum(), q)))
    s, m = _stretches(x >= 0)
    level = np.frexp(m.astype(float))[1] - 1  # segments of 2**level up to twice as many words go together
    for k in np.unique(level[m >= 2 * SHORT]):
        mine = level == k
        where = np.concatenate([np.arange(b, b + c + 1) for b, c in zip(s[mine], m[mine])])  # with the separator after it
        inside = np.append(x, np.iinfo(np.int64).min)[where]
        for b, c, q in _long_lags(inside, int(k)):
            found.append((where[b], c, q))
    b, c, q = (np.concatenate(v) for v in zip(*found))
    order = np.lexsort((q, c, b))
    b, c, q = b[order], c[order], q[order]
    first = np.ones(len(b), bool)
    first[1:] = (b[1:] != b[:-1]) | (c[1:] != c[:-1])
    b, c, q = b[first], c[first], q[first]
    order = np.lexsort((q, b))
    return np.stack((at[b[order]] if len(b) else b, c[order], q[order]), axis=1)


def _scan(texts: list[list[str]]) -> list[tuple[list[dict], str]]:
    """Runs and the text without repeated periods, for each document's words."""
    number: dict[str, int] = {}
    size = np.array([len(w) for w in texts])
    x = np.full(int(size.sum()) + len(texts), -1, np.int64)
    first = np.cumsum(size + 1) - size - 1
    for f, w in zip(first.tolist(), texts):
        x[f:f + len(w)] = [number.setdefault(v, len(number)) for v in w]
    found = runs(x)
    edge = np.searchsorted(found[:, 0], np.append(first, len(x)))
    out = []
    for k, w in enumerate(texts):
        mine = found[edge[k]:edge[k + 1]] - [first[k], 0, 0]
        if len(mine):
            depth = np.zeros(len(w) + 1, np.int64)
            np.add.at(depth, mine[:, 0] + mine[:, 2], 1)
            np.add.at(depth, mine[:, 0] + mine[:, 1], -1)
            gone = np.cumsum(depth) > 0
            w = [v for v, g in zip(w, gone.tolist()) if not g]
        out.append(([{"start": a, "length": b, "period": q} for a, b, q in mine.tolist()], " ".join(w)))
    return out


def detect(docs: DataFrame, carry: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``carry`` (default: all columns) plus a struct ``periodic``: n_words, runs (start, length, period) and
    collapsed, the words outside of repeated periods joined by one space (a run keeps its first period)."""
    carry = docs.columns if carry is None else carry
    d = docs.select(bundle(carry).alias("carry"), col(text_col).alias("t"))
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lo, n = [], 0, 0
            column = b.column("t")
            for k in range(len(column)):
                w = WORD.findall(column[k].as_py() or "")
                texts.append(w)
                n += len(w) + 1
                if n > CHUNK_WORDS or k == len(column) - 1:
                    done = _scan(texts)
                    yield pa.RecordBatch.from_arrays([
                        b.column("carry").slice(lo, len(texts)), pa.array([len(w) for w in texts], pa.int64()),
                        pa.array([r for r, _ in done], kind), pa.array([c for _, c in done], pa.string())],
                        names=["carry", "n_words", "runs", "collapsed"])
                    texts, lo, n = [], k + 1, 0

    p = d.mapInArrow(scan, T.StructType([d.schema["carry"], T.StructField("n_words", T.LongType()),
                                         T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())]))
    return p.select(*unbundle(F.col("carry"), carry), F.struct("n_words", "runs", "collapsed").alias(own_name("periodic", carry)))


def longest(found: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period); null without runs."""
    best = F.array_max(F.transform(found, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
