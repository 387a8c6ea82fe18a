"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual`` points of a ring of 65,536 slots; a row belongs to
the next point clockwise of its key's hash. A shard takes at most its capacity,
``(1 + slack)`` times the mean number of rows; the rows of a full shard
continue clockwise to the next point whose shard has room, so balance is
guaranteed and only overflowing rows move. With ``slack`` 0 the capacities are
the mean rounded down or up, and the counts end at most one apart.

Scale: rows are put in ring order by a distributed sort of narrow columns and
numbered densely; from then on an assignment is an interval of that number.
Only the rows per ring slot (65,536 counts at most, whatever the input) are
looked at centrally to place the intervals, and the intervals come back as a
broadcast of at most slots + points x shards rows. A key that holds a third of
all rows is one slot but many intervals, so it splits like any other. Shard and
position in the shard are arithmetic on the number: no task holds a shard.

Native: DataFrame functions only.

Defined results: null text counts no bytes and has the CRC of the empty text;
null keys hash like a value; rows that repeat are placed one by one, next to
each other on the ring; an empty table gives an empty result; extra columns
are carried through.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, fresh, stage_table
from ledgerline.operators.features import global_rank

SHARDS, VIRTUAL, SEED = 24, 64, 29
SLOT_BITS = 16


def _points(spark, shards: int, virtual: int, seed: int) -> list[tuple[int, int]]:
    """The ring's points (slot, shard) in clockwise order; ``shards`` x ``virtual`` rows."""
    p = spark.range(shards * virtual).select(F.floor(F.col("id") / virtual).alias("shard"), (F.col("id") % virtual).alias("copy"))
    at = F.shiftrightunsigned(F.xxhash64("shard", "copy", F.lit(seed)), 64 - SLOT_BITS)
    return sorted((r["at"], r["shard"]) for r in p.select(at.alias("at"), "shard").collect())


def place(counts: dict[int, int], points: list[tuple[int, int]], capacity: list[int]) -> list[dict]:
    """Intervals of the dense ring number: first to the owner while it has room, the rest clockwise.

    Rows that fit their own shard stay there; overflow then walks on from its
    own point, in ring order.
    """
    arcs, k, first = [], 0, 0  # (point, first number, rows)
    slots = sorted(counts)
    for j, (at, _) in enumerate([*points, (1 << SLOT_BITS, None)]):
        n = 0
        while k < len(slots) and slots[k] <= at:
            n += counts[slots[k]]
            k += 1
        if n:
            arcs.append((j % len(points), first, n))  # past the last point: round to the first
        first += n
    load, out, overflow = [0] * len(capacity), [], []

    def give(shard: int, lo: int, n: int) -> int:
        n = min(n, capacity[shard] - load[shard])
        if n > 0:
            out.append({"lo": lo, "hi": lo + n - 1, "shard": shard, "base": load[shard]})
            load[shard] += n
        return max(n, 0)

    for j, lo, n in arcs:
        done = give(points[j][1], lo, n)
        if done < n:
            overflow.append((j, lo + done, n - done))
    for j, lo, n in overflow:
        for step in range(1, len(points) + 1):
            done = give(points[(j + step) % len(points)][1], lo, n)
            lo, n = lo + done, n - done
            if not n:
                break
    return out


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def assign(docs: DataFrame, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
           virtual: int = VIRTUAL, slack: float = 0.0, seed: int = SEED) -> DataFrame:
    """``carry`` (default: all columns) plus a struct ``placed``: size, text_crc32, shard and slot (gapless in the shard)."""
    spark = docs.sparkSession
    carry = docs.columns if carry is None else carry
    me, row, s = fresh(docs, "placed", "row", "spot")
    d = stage_table(docs.select(*[col(c) for c in carry], F.struct(
        (utf8_bytes(col(text_col)) + 8).alias("size"),
        F.crc32(F.coalesce(col(text_col), F.lit("")).cast("binary")).alias("crc"),
        F.xxhash64(col(id_col), F.lit(seed)).alias("pos")).alias(me)).withColumn(row, F.monotonically_increasing_id()), "keyed")
    slot = F.shiftrightunsigned(F.col("pos"), 64 - SLOT_BITS).cast("int")
    keys = d.select(col(row).alias("row"), col(me)["pos"].alias("pos"), col(me)["crc"].alias("crc")).withColumn("at", slot)
    ranked = global_rank(keys, [F.col("at"), F.col("pos"), F.col("crc"), F.col("row")], "g").select("row", "at", (F.col("g") - 1).alias("g"))
    counts = {r["at"]: r["n"] for r in keys.groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a ring slot
    n = sum(counts.values())
    even = [n // shards + (s < n % shards) for s in range(shards)]
    capacity = [max(e, int(e * (1 + slack))) for e in even]
    runs = place(counts, _points(spark, shards, virtual, seed), capacity)
    # the ring slots that every interval touches, for an equality join
    first, total = {}, 0
    for at in sorted(counts):
        first[at] = total
        total += counts[at]
    starts = sorted(first.items(), key=lambda x: x[1])
    runs = _with_slots(runs, starts)
    text = json.dumps(runs)
    seg = spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<lo:long,hi:long,shard:int,base:long,s0:int,s1:int>>")))
    seg = seg.select("lo", "hi", "shard", "base", F.explode(F.sequence("s0", "s1")).alias("at"))
    spot = (ranked.join(F.broadcast(seg), "at").where("g BETWEEN lo AND hi")
            .select(F.struct("row", "shard", (F.col("base") + F.col("g") - F.col("lo")).alias("slot")).alias(s)))
    j = d.join(spot, col(row) == col(s)["row"])
    return j.select(*[col(c) for c in carry], F.struct(
        col(me)["size"].alias("size"), col(me)["crc"].alias("text_crc32"), col(s)["shard"].alias("shard"),
        col(s)["slot"].alias("slot")).alias("placed" if "placed" not in carry else me))


def _with_slots(runs: list[dict], starts: list[tuple[int, int]]) -> list[dict]:
    """Adds to each interval the first and last ring slot that it touches."""
    from bisect import bisect_right
    ats, firsts = [a for a, _ in starts], [f for _, f in starts]
    return [r | {"s0": ats[bisect_right(firsts, r["lo"]) - 1], "s1": ats[bisect_right(firsts, r["hi"]) - 1]} for r in runs]
