"""Merkle manifest of a data set, by lag and lead windows.

Every row is a leaf, the hash of its fields. The leaves of a group (a source)
ascend by id; each run of ``FAN`` consecutive nodes, the last one shorter,
becomes the hash of the nodes, until one node remains, the group's subroot.
The subroots in group order make the root the same way.

One level: the nodes of a level stand on the first leaf row of each, so the
siblings of a node are found a fixed number of rows before and after it. Lag
and lead columns at these offsets, masked by the node's slot and by the length
of its run, supply the siblings, and the rows in slot 0 (the first children)
hash the parents. The siblings of all levels, handed down to the leaf rows,
are the proof of a leaf.

Scale: a window spans ``FAN ** DEEP`` leaves of one group, so a group with a
third of all rows is spread over as many windows as it has blocks; the tops of
the blocks are the leaves of the next pass (three passes reach 10^10 rows a
group). Texts are hashed where they are read and never shuffled. Positions
come from a range-partitioned sort that counts rows by (partition, group).
Nothing reaches the driver but the largest group size and the root.

Defined results: a null field is written ``-``; an empty text and a null one
differ. Null groups are one group, the first; null ids come first in it. Rows
with the same id are ordered by leaf hash, and rows that repeat are leaves of
their own with equal hashes (which of them stands first makes no difference). A
group of one row has its leaf as subroot. An empty table gives an empty result.
Texts of any length are one hash. Extra columns are carried, whatever their
names; they are no part of a leaf unless ``fields`` names them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import bundle, col, own_name, stage_table, unbundle
from ledgerline.operators.features import global_rank

#: Children of a node, and levels that one window pass climbs.
FAN, DEEP = 3, 7
#: ``monotonically_increasing_id`` holds the partition above this bit and the row in it below.
ROW_BITS = 33
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def written(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    v = value.cast("string")
    return F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*[written(v) for v in values]))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf leads to with the siblings of a proof."""
    return F.aggregate(path, start, lambda h, x: digest(F.concat(x["left"], h, x["right"])))


def siblings_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""))


def _climbed(nodes: DataFrame) -> DataFrame:
    """``nodes`` (s, pos, n, h, ..) with ``block``, ``up`` (the block's top, on its first row) and ``path`` inside the block."""
    d = nodes.withColumns({"block": F.expr(f"pos div {FAN ** DEEP}L"), "up": F.col("h")})
    keep = d.columns[:-1]
    rows = Window.partitionBy("s", "block").orderBy("pos")
    pos, n, up = F.col("pos"), F.col("n"), F.col("up")
    for level in range(DEEP):
        step = FAN ** level
        d = d.withColumns({f"near{o}": (F.lead(up, o * step) if o > 0 else F.lag(up, -o * step)).over(rows)
                           for o in range(1 - FAN, FAN) if o})
        slot = F.expr(f"pos div {step}L") % FAN
        run = F.least(F.lit(FAN).cast("long"), F.ceil(n / step) - (F.expr(f"pos div {step}L") - slot))
        open_, here = n > step, pos % step == 0  # more than one node on this level; a node stands on this row
        left = F.concat(*[F.when(slot + o >= 0, F.col(f"near{o}")).otherwise("") for o in range(1 - FAN, 0)])
        right = F.concat(*[F.when(slot + o < run, F.col(f"near{o}")).otherwise("") for o in range(1, FAN)])
        parent = F.when(open_, digest(F.concat(up, right))).otherwise(up)  # by the first child
        d = d.select(*keep, F.when(pos % (step * FAN) == 0, parent).alias("up"),
                     F.when(here & open_, F.struct(left.alias("left"), right.alias("right"))).alias(f"sib{level}"))
        keep = [*keep, f"sib{level}"]
    # from the first leaf row of a node down to all its leaf rows
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.array_compact(F.array(*[F.last(f"sib{v}", ignorenulls=True).over(so_far) for v in range(DEEP)]))
    return d.withColumn("path", path).drop(*[f"sib{v}" for v in range(DEEP)])


def _tops(nodes: DataFrame) -> DataFrame:
    """The first row of each block as a node of the next pass."""
    d = _climbed(nodes).where(F.col("pos") == F.col("block") * FAN ** DEEP)
    return d.select("s", F.col("block").alias("pos"), F.ceil(F.col("n") / FAN ** DEEP).alias("n"), F.col("up").alias("h"))


def _tree(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """``nodes`` and the written tops of every pass; the last has one row a tree."""
    out = [nodes]
    while largest > 1:
        out.append(stage_table(_tops(out[-1]), "tops"))
        largest = math.ceil(largest / FAN ** DEEP)
    return out


def _down(passes: list[DataFrame], above: DataFrame, keep: list[str]) -> DataFrame:
    """Proof paths of the first table of ``passes``; ``above`` (s, path, subroot) is the way from each tree's top to the root."""
    if len(passes) == 1:
        return passes[0].join(above, "s")
    upper = passes[-1].select("s", F.col("pos").alias("block")).join(above, "s")
    for i, nodes in reversed(list(enumerate(passes[:-1]))):
        d = _climbed(nodes).join(upper.withColumnRenamed("path", "rest"), ["s", "block"])
        d = d.select("s", "pos", "subroot", *([] if i else keep), F.concat("path", "rest").alias("path"))
        if i:
            upper = stage_table(d.withColumnRenamed("pos", "block"), "paths")
    return d


def _positions(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves with s, pos and n; groups with s and n), both in order: s numbers the groups, pos the leaves of a group."""
    at = F.monotonically_increasing_id()
    part = F.shiftright("at", ROW_BITS)
    d = leaves.withColumn("row", at)  # splits rows that repeat among partitions
    d = stage_table(d.orderBy(*[F.col(c).asc_nulls_first() for c in ("g", "o", "h", "row")]).drop("row").withColumn("at", at), "leaves")
    runs = stage_table(d.groupBy(part.alias("part"), "g").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c")), "leaf_runs")
    groups = global_rank(runs.groupBy("g").agg(F.sum("c").alias("n")), [F.col("g").asc_nulls_first()], "s")
    groups = stage_table(groups.select("g", "n", (F.col("s") - 1).cast("long").alias("s")), "groups")
    before = F.sum("c").over(Window.partitionBy("g").orderBy("part")) - F.col("c")  # a row a partition at most
    runs = runs.select("part", "g", "first", before.alias("before"))
    runs = runs.join(groups.withColumnRenamed("g", "g2"), F.col("g").eqNullSafe(F.col("g2"))).select(
        F.col("part").alias("p2"), F.col("g").alias("g2"), "first", "before", "s", "n")
    d = d.join(runs, (part == F.col("p2")) & F.col("g").eqNullSafe(F.col("g2")))
    return d.select("carry", "s", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "n", "h"), groups


def prove(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "source", id_col: str = "doc_id",
          carry: list[str] | None = None) -> DataFrame:
    """``carry`` (default: all columns) plus a struct ``proof``: leaf, pos (in the group), path, subroot and root.

    ``path`` has the siblings of every level from the leaf to the root as two
    strings, those to the left and those to the right, each concatenated.
    """
    carry = docs.columns if carry is None else carry
    name = own_name("proof", carry)
    leaves = docs.select(bundle(carry).alias("carry"), col(group_col).alias("g"), col(id_col).alias("o"),
                         leaf([col(c) for c in fields]).alias("h"))
    nodes, groups = _positions(leaves)
    n_groups, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    if not n_groups:
        empty = "struct<leaf:string,pos:bigint,path:array<struct<left:string,right:string>>,subroot:string,root:string>"
        return docs.select(*[col(c) for c in carry], F.lit(None).cast(empty).alias(name)).limit(0)
    passes = _tree(nodes, largest)
    tops = stage_table(passes[-1].select("s", "h"), "subroots")
    over = _tree(tops.select(F.lit(0).cast("long").alias("s"), F.col("s").alias("pos"), F.lit(n_groups).cast("long").alias("n"), "h"), n_groups)
    root = over[-1].first()["h"]
    none = F.array().cast("array<struct<left:string,right:string>>")
    start = docs.sparkSession.range(1).select(F.col("id").alias("s"), none.alias("path"), F.lit(root).alias("subroot"))
    ways = _down(over, start, ["h"]).select(F.col("pos").alias("s"), "path", F.col("h").alias("subroot"))
    d = _down(passes, stage_table(ways, "ways"), ["carry", "h"])
    return d.select(*unbundle(F.col("carry"), carry), F.struct(
        F.col("h").alias("leaf"), "pos", "path", "subroot", F.lit(root).alias("root")).alias(name))
