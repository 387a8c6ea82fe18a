"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a share of the total size by weight, capped at
``max_repeats`` times its own size, the excess reshared by weight. A source's
target is whole passes over it plus a remaining budget below its size. The
remaining budget is fitted on the source's table of document lengths: the same
share of every length first, then long lengths while they fit, and the last
few words by bounded-knapsack dynamic programming over the lengths left; where
documents are longer than these few words, the programme gets ``LONG_RESERVE``
words or the longest document. The result says how many documents of each length to take; the ones with the
lowest seeded hash are taken.

Scale: documents are counted by (source, length) with a partial aggregate; a
length table has as many rows as there are different lengths, at most the
longest document's words, so one task fits a source however many documents it
has. Which documents are taken is a threshold on the seeded hash per (source,
length), found over hash buckets whose number grows with the table, so a third
of all rows in one (source, length) still splits. Texts are not shuffled while
the threshold table is small; sources are never collected.

Defined results: size is the number of words, null text has none; a document
of size 0 takes nothing and is repeated with the whole passes only; null is a
source of its own, last; rows that repeat (same id and text) are taken as
often as the plan says, any of them; an empty table gives an empty result;
extra columns are carried through.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import col, fresh, stage_table, words
from ledgerline.operators.features import global_rank

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

WEIGHTS, MAX_REPEATS, SEED = (5, 2, 1), 3, 17
#: Words that are left to the dynamic programme after the proportional and the greedy share.
RESERVE = 20_000
#: The same for sources with longer documents than RESERVE (a table of 4 bytes a word and at most twice as long).
LONG_RESERVE = 2_000_000
#: Rows of a group table (about 60 bytes a row) up to which it is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 100_000
#: Rows aimed at in one hash bucket of one (source, length).
BUCKET_ROWS = 50_000


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, reserve: int = RESERVE) -> np.ndarray:
    """How many documents of each size to take so that the sizes sum to ``budget`` or come nearest to it,
    given the proportional share and, beyond the last ``reserve`` words, the long lengths first."""
    order = np.argsort(-sizes, kind="stable")
    s, n = sizes[order].astype(np.int64), counts[order].astype(np.int64)
    total = int((s * n).sum())
    if budget >= total:
        return counts.astype(np.int64)
    take = (n * (budget / total)).astype(np.int64)
    rest = budget - int((s * take).sum())
    longest = int(s[take < n].max(initial=0))
    if longest > reserve:
        reserve = max(LONG_RESERVE, longest)
    for i in np.nonzero((s > 0) & (take < n))[0]:
        if rest <= reserve:
            break
        k = min(int(n[i] - take[i]), (rest - reserve) // int(s[i]))
        take[i] += k
        rest -= k * int(s[i])
    # bounded knapsack: by[j] is the piece (a size, 1, 2, 4 .. times) that first reached the sum j
    free = (s > 0) & (take < n)
    top = rest + min(int(s[free].max(initial=0)), rest)  # a sum above may be nearer, but none beyond twice the rest
    by = np.full(top + 1, -1, dtype=np.int32)
    by[0], pieces = 0, [(0, 0)]
    for i in np.nonzero(free & (s <= top))[0]:
        left, times = min(int(n[i] - take[i]), top // int(s[i])), 1
        while left > 0 and by[rest] < 0:
            k = min(times, left)
            w = k * int(s[i])
            if w <= top:
                new = w + np.nonzero((by[w:] < 0) & (by[:top + 1 - w] >= 0))[0]
                by[new] = len(pieces)
                pieces.append((i, k))
            left, times = left - k, times * 2
        if by[rest] >= 0:
            break
    sums = np.nonzero(by >= 0)[0]
    j = int(sums[np.abs(sums - rest).argmin()])
    while j:
        i, k = pieces[by[j]]
        take[i] += k
        j -= k * int(s[i])
    out = np.empty_like(take)
    out[order] = take
    return out


def targets(lengths: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, size, n): shares by weight, capped and reshared."""
    s = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    s = global_rank(s, [F.col("source").asc_nulls_last()], "rank")
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = stage_table(s.withColumn("w", F.get(w, F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")))
                    .withColumn("most", F.col("source_size").cast("double") * max_repeats), "sources")
    level, capped = 0.0, F.col("most") <= F.col("w") * 0.0
    while True:  # each round caps more sources, at level words a unit of weight
        r = s.agg(F.sum("source_size").alias("all"), F.sum(F.when(capped, F.col("most")).otherwise(0.0)).alias("fixed"),
                  F.sum(F.when(capped, 0.0).otherwise(F.col("w"))).alias("open")).first()
        if not r["open"] or (r["all"] - r["fixed"]) / r["open"] <= level:
            break
        level = (r["all"] - r["fixed"]) / r["open"]
        capped = F.col("most") <= F.col("w") * level
    return s.select("source", "source_size", F.when(capped, F.col("most")).otherwise(F.col("w") * level).alias("target"))


def _bounded(counted: DataFrame):
    return F.broadcast if counted.count() <= BROADCAST_ROWS else (lambda df: df)


def mix(docs: DataFrame, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """``carry`` (default: all columns) plus a struct ``mix``: size, source_size, target and copies (0 to ``max_repeats``)."""
    carry = docs.columns if carry is None else carry
    src, size, h, row = fresh(docs, "src", "size", "h", "row")
    d = stage_table(docs.select(
        *[col(c) for c in carry], col(source_col).alias(src), F.size(words(col(text_col))).cast("long").alias(size),
        F.xxhash64(col(id_col), col(text_col), F.lit(seed)).alias(h)).withColumn(row, F.monotonically_increasing_id()), "sized")
    rows = d.select(col(src).alias("source"), col(size).alias("size"), col(h).alias("h"), col(row).alias("row"))
    lengths = stage_table(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    t = stage_table(targets(lengths, weights, max_repeats), "targets")
    plan = lengths.withColumnRenamed("source", "s2").join(_bounded(t)(t), F.col("s2").eqNullSafe(F.col("source"))).drop("s2")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("passes", passes).withColumn(
        "budget", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        return pdf.assign(pick=fit_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), int(pdf["budget"].iloc[0])))

    plan = stage_table(plan.groupBy("source").applyInPandas(
        fit, "size long, n long, source string, source_size long, target double, passes long, budget long, pick long"), "plan")
    some = stage_table(plan.where("pick > 0 AND pick < n").select(F.col("source").alias("s2"), F.col("size").alias("z2"), "pick"), "partial")
    # hash buckets in hash order, more of them for larger tables
    n_rows = lengths.agg(F.sum("n")).first()[0] or 0
    bits = min(24, max(1, math.ceil(math.log2(max(1, n_rows) / BUCKET_ROWS))))
    bucket = lambda c: F.shiftrightunsigned(c, 64 - bits)
    hint = _bounded(some)
    r = rows.join(hint(some), F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2"))).withColumn("b", bucket(F.col("h")))
    before = F.sum("c").over(Window.partitionBy("s2", "z2").orderBy("b")) - F.col("c")
    edge = stage_table(r.groupBy("s2", "z2", "pick", "b").agg(F.count(F.lit(1)).alias("c")).withColumn("need", F.col("pick") - before)
                       .where("need > 0 AND need <= c").select(F.col("s2").alias("s3"), F.col("z2").alias("z3"), F.col("b").alias("b3"), "need"), "edges")
    e = rows.withColumn("b", bucket(F.col("h"))).join(hint(edge), F.col("source").eqNullSafe(F.col("s3")) & (F.col("size") == F.col("z3")) & (F.col("b") == F.col("b3")))
    last = (e.withColumn("k", F.row_number().over(Window.partitionBy("s3", "z3").orderBy("h", "row"))).where("k = need")
            .select("s3", "z3", F.struct("b", "h", "row").alias("last")))
    p = plan.join(last, F.col("source").eqNullSafe(F.col("s3")) & (F.col("size") == F.col("z3")), "left")
    p = stage_table(p.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "source_size", "target", "passes", "pick", "n", "last"), "thresholds")
    here = F.struct(bucket(col(h)).alias("b"), col(h).alias("h"), col(row).alias("row"))
    own = p.select(F.struct("p_source", "p_size", "source_size", "target", "passes", "pick", "n", "last").alias(fresh(d, "p")[0]))
    g = col(own.columns[0])
    j = d.join(_bounded(p)(own), col(src).eqNullSafe(g["p_source"]) & (col(size) == g["p_size"]))
    taken = F.when(g["pick"] >= g["n"], 1).when(g["pick"] == 0, 0).when(here <= g["last"], 1).otherwise(0)
    return j.select(*[col(c) for c in carry], F.struct(
        col(size).alias("size"), g["source_size"].alias("source_size"), g["target"].alias("target"),
        (g["passes"] + taken).cast("long").alias("copies")).alias("mix" if "mix" not in carry else fresh(docs, "mix")[0]))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, each row as often as the mix takes it."""
    m = mix(docs, **options)
    return m.withColumn(m.columns[-1], F.explode(F.array_repeat(
        F.lit(1), col(m.columns[-1])["copies"].cast("int")))).select(*[col(c) for c in docs.columns])
