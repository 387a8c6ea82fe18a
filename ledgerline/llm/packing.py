"""Best-fit packing of token sequences by patterns fitted with non-negative least squares.

Pieces of documents are packed into sequences of at most ``limit`` tokens. All
planning works on the histogram of piece lengths, which has at most ``limit``
rows whatever the corpus holds:

1. enumerate the patterns of one to three lengths that fill a sequence exactly;
2. fit how often each pattern repeats, by non-negative least squares of the
   patterns' lengths against the histogram (coordinate descent; a pattern
   touches three lengths at most);
3. round the repeats down, the largest first, never taking more pieces of a
   length than there are;
4. pack the rest best-fit decreasing, on counts: pieces of one length that meet
   the same open space are placed together.

The plan says for every length which ranks go to which sequences and offsets.
A piece's rank among the pieces of its length comes from counts per (task,
length): every task numbers its own pieces as it reads them, and the counts of
the tasks before it are added. Nothing is sorted, no length is gathered in a
task, and token ids are shuffled only if the caller carries them.

``token_pieces`` makes the pieces: ids of the tokenizer plus an end id; longer
documents are cut into pieces of ``limit``, the first one shorter.

Defined results: null and empty texts are one piece, the end id alone. Texts
of any length are tokenized whole. Pieces with a null, zero or negative length,
or one above the limit, get a null place. Rows that repeat, null ids and ties
are pieces of their own. Empty tables give an empty result. Extra columns are
carried, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import bundle, col, own_name, stage_table, unbundle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

LIMIT, END = 1024, 2
#: Lengths are counted in units of ``limit / UNITS`` tokens (rounded up) where the limit is larger.
UNITS = 1024
#: Passes over all patterns in a fit, and how far each step goes.
SWEEPS, RELAX = 30, 1.5
#: Fixed value: the pattern that splits a text before byte-level merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of more characters go to the tokenizer itself.
LONG_TEXT = 100_000
#: Bytes of token ids that a task gathers before it hands them on.
OUT_BYTES = 8 << 20


def encoder(file: str) -> Callable[[str], list[int]]:
    """Token ids of a text, by the tokenizer in ``file`` (its JSON text), without added special tokens.

    Byte-level BPE has one result whoever computes it, so a faster library with
    the same vocabulary and split encodes the plain texts; texts with a
    special string and very long ones, and other kinds of tokenizers, go to the tokenizer.
    """
    import json

    from tokenizers import Tokenizer
    exact = Tokenizer.from_str(file)
    own = lambda t: exact.encode(t, add_special_tokens=False).ids
    j = json.loads(file)
    model, pre = j["model"], j.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and pre == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
             and j.get("normalizer") is None and not any(model.get(k) for k in (
                 "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")))
    if not plain:
        return own
    import tiktoken
    # the letters that byte-level vocabularies write for bytes: printable ones as they are, the others from U+0100 on
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = [t["content"] for t in j.get("added_tokens", [])]
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("same", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda t: own(t) if len(t) > LONG_TEXT or any(s in t for s in special) else fast(t)


def token_pieces(docs: DataFrame, path: str, carry: list[str] | None = None, text_col: str = "text",
                 limit: int = LIMIT, end: int | None = END) -> DataFrame:
    """``carry`` (default: all columns) plus a struct ``tokens``: piece (from 0), start, length and ids.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers.
    """
    spark, carry = docs.sparkSession, docs.columns if carry is None else carry
    file = spark.sparkContext.broadcast(open(path, encoding="utf-8").read())  # the file stays on the driver
    d = docs.select(bundle(carry).alias("carry"), col(text_col).alias("t"))
    token = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                          T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    kind = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file.value)
        for b in batches:
            rows, out, size = [], [], 0
            for k, t in enumerate(b.column("t").to_pylist()):
                ids = encode(t) if t else []
                if end is not None:
                    ids.append(end)
                data = np.array(ids, "<u4").tobytes()
                first = len(ids) % limit or min(limit, len(ids))
                edges = [0, *range(first, len(ids) + 1, limit)]
                for piece, (x, y) in enumerate(zip(edges, edges[1:])):
                    rows.append(k)
                    out.append({"piece": piece, "start": x, "length": y - x, "ids": data[4 * x:4 * y]})
                size += len(data)
                if size > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([b.column("carry").take(pa.array(rows)), pa.array(out, kind)], names=["carry", "tokens"])
                    rows, out, size = [], [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([b.column("carry").take(pa.array(rows)), pa.array(out, kind)], names=["carry", "tokens"])

    p = d.mapInArrow(cut, T.StructType([d.schema["carry"], T.StructField("tokens", token)]))
    return p.select(*unbundle(F.col("carry"), carry), F.col("tokens").alias(own_name("tokens", carry)))


def patterns(have: np.ndarray, limit: int) -> np.ndarray:
    """All ways to fill ``limit`` with one to three of the lengths that ``have`` counts, as rows; 0 stands for no length."""
    lengths = np.flatnonzero(have)
    lengths = lengths[lengths > 0]
    out = [(int(x), 0, 0) for x in lengths if x == limit]
    there = have > 0
    out += [(int(x), int(limit - x), 0) for x in lengths if 2 * x >= limit > x and there[limit - x]]
    for a in lengths[::-1]:
        if 3 * a < limit:
            break
        b = lengths[(lengths <= a) & (2 * lengths >= limit - a) & (lengths < limit - a)]
        b = b[there[limit - a - b]]
        out += [(int(a), int(x), int(limit - a - x)) for x in b]
    return np.array(out, int).reshape(-1, 3)


def fit(have: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Repeats x >= 0 of each pattern that make |counts(x) - have|^2 small, by over-relaxed coordinate descent from zero."""
    left, x = have.astype(float).tolist(), [0.0] * len(rows)
    columns = []
    for r in rows.tolist():
        used = [v for v in r if v]
        columns.append((used, RELAX / sum(used.count(v) ** 2 for v in set(used))))
    for _ in range(SWEEPS):
        for j, (used, share) in enumerate(columns):
            step = max(sum([left[v] for v in used]) * share, -x[j])
            if step:
                x[j] += step
                for v in used:
                    left[v] -= step
        if max(map(abs, left)) < 0.5:
            break
    return np.array(x)


def plan(have: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats) that use every piece that ``have`` counts by length, once."""
    left, out = have.astype(np.int64).copy(), []
    rows = patterns(left, limit)
    x = fit(left, rows)
    for j in np.argsort(-x, kind="stable"):
        if x[j] < 1:
            break
        used = [int(v) for v in rows[j] if v]
        n = min([int(x[j]), *(int(left[v]) // used.count(v) for v in used)])
        if n:
            for v in used:
                left[v] -= n
            out.append((tuple(used), n))
    # best fit decreasing on counts: open_[r] holds (lengths, how many sequences) with r free, free[r] their sum
    open_: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(limit + 1)]
    free = np.zeros(limit + 1, np.int64)

    def put(used: tuple[int, ...], r: int, k: int) -> None:
        open_[r].append((used, k))
        free[r] += k

    for size in range(limit, 0, -1):
        n = int(left[size])
        while n:
            fits = np.flatnonzero(free[size:])
            if len(fits):
                r = size + int(fits[0])
                used, m = open_[r].pop()
                k = min(n, m)
                free[r] -= m
                if m > k:
                    put(used, r, m - k)
                put((*used, size), r - size, k)
                n -= k
            else:  # a new sequence is the best fit of the next pieces of this length too
                each = min(limit // size, n)
                k = n // each
                put((size,) * each, limit - size * each, k)
                n -= k * each
    return out + [entry for group in open_ for entry in group]


def places(chosen: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For ranks from ``rank`` on among the pieces of ``length``: sequence ``base`` + rank - ``rank``, at slot ``slot`` of pattern ``pattern``."""
    cursor, base, out = {}, 0, []
    for p, (used, n) in enumerate(chosen):
        for slot, v in enumerate(used):
            out.append((v, cursor.get(v, 0), base, p, slot))
            cursor[v] = cursor.get(v, 0) + n
        base += n
    t = np.array(sorted(out), np.int64).reshape(-1, 5)
    return {"length": t[:, 0], "rank": t[:, 1], "base": t[:, 2], "pattern": t[:, 3], "slot": t[:, 4]}


def pack(pieces: DataFrame, length: str = "length", carry: list[str] | None = None, limit: int = LIMIT) -> DataFrame:
    """``carry`` (default: all columns) plus a struct ``packed``: sequence_id and offset (gapless from 0)."""
    carry = pieces.columns if carry is None else carry
    unit = -(-limit // UNITS)  # tokens a unit
    room = limit // unit
    d = pieces.select(bundle(carry).alias("carry"), col(length).cast("long").alias("tokens"))
    d = d.withColumn("size", F.when(
        F.col("tokens").between(1, limit), F.least(F.expr(f"(tokens + {unit - 1}) div {unit}"), F.lit(room))).otherwise(0).cast("long"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(room + 1, np.int64)
        for b in batches:
            v = b.column("size").to_numpy()
            order = np.argsort(v, kind="stable")
            counts = np.bincount(v, minlength=room + 1)
            rank = np.empty(len(v), np.int64)
            rank[order] = np.arange(len(v)) - (np.cumsum(counts) - counts)[v[order]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rank + seen[v])], names=[*b.schema.names, "rank"])
            seen += counts

    d = d.mapInArrow(number, T.StructType([*d.schema.fields, T.StructField("rank", T.LongType())]))
    d = stage_table(d.withColumn("part", F.spark_partition_id()), "pieces")
    counts = stage_table(d.groupBy("part", "size").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    have = np.zeros(room + 1, np.int64)
    for r in counts.where("size > 0").groupBy("size").agg(F.sum("n").alias("n")).collect():  # a row a length
        have[r["size"]] = r["n"]
    chosen = plan(have, room)
    t = places(chosen)
    # token offsets need the true lengths of the pieces before in a sequence; with units of one token the plan has them
    offset = np.array([sum(chosen[p][0][:s]) * unit for p, s in zip(t["pattern"].tolist(), t["slot"].tolist())], np.int64)
    key = t["length"] << 44 | t["rank"]
    before = F.sum("n").over(Window.partitionBy("size").orderBy("part")) - F.col("n")  # a row a partition at most
    d = d.join(counts.select("part", "size", before.alias("before")), ["part", "size"])
    d = d.select("carry", "tokens", "size", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, rank = b.column("size").to_numpy(), b.column("rank").to_numpy()
            at = np.maximum(np.searchsorted(key, v << 44 | rank, side="right") - 1, 0)
            seq = pa.array(t["base"][at] + rank - t["rank"][at], mask=v == 0) if len(key) else pa.nulls(len(v), pa.int64())
            off = pa.array(offset[at], mask=v == 0) if len(key) else pa.nulls(len(v), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("carry"), b.column("tokens"), seq, off], names=["carry", "tokens", "seq", "off"])

    d = d.mapInArrow(place, T.StructType([d.schema["carry"], d.schema["tokens"], T.StructField("seq", T.LongType()), T.StructField("off", T.LongType())]))
    if unit > 1:  # close the gaps that rounding up left
        d = d.withColumn("off", F.when(F.col("seq").isNotNull(), F.sum("tokens").over(Window.partitionBy("seq").orderBy("off")) - F.col("tokens")))
    return d.select(*unbundle(F.col("carry"), carry), F.struct(
        F.col("seq").alias("sequence_id"), F.col("off").alias("offset")).alias(own_name("packed", carry)))
