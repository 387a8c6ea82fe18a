"""Table maintenance on plain Parquet: upsert, partial upsert, insert-ignore,
append (K1–K5, K9, K10).

Operators are pure (DataFrame in, DataFrame out); ``write_table`` puts the
result in a new folder, never the one being read, and the caller swaps.
Source deduplication is a partial aggregate (``max_by``), never a window
over the key, so a hot key does not land whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: str | Column | None) -> DataFrame:
    """One row per non-NULL key: the one with the greatest ``order`` (last wins).

    Rows with a NULL key component are kept as they are: a NULL key never
    conflicts (SQL unique-index semantics).
    """
    cols = [c for c in df.columns if c not in keys]
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    keyed, unkeyed = df.where(~has_null), df.where(has_null)
    if order is None or not cols:
        # no order given: the greatest row by its columns, so the survivor never depends on the run
        best = F.max(F.struct(*cols)) if cols else F.lit(None)
        deduped = keyed.groupBy(*keys).agg(best.alias("__r")).select(*keys, *[F.col("__r")[c].alias(c) for c in cols])
    else:
        o = F.col(order) if isinstance(order, str) else order
        deduped = (keyed.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(o.alias("o"), *cols)).alias("__r"))
                   .select(*keys, *[F.col("__r")[c].alias(c) for c in cols]))
    return deduped.select(*df.columns).unionByName(unkeyed)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """K1/K3: insert new keys, replace existing ones (all non-key columns).

    ``target ⋉̸ source ∪ dedup(source)``; equality on keys, so NULL keys
    never match and both copies stay (as a SQL unique index behaves).
    """
    src = latest_per_key(source, keys, order).select(*target.columns)
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src)


def upsert_columns(target: DataFrame, source: DataFrame, keys: list[str], update: list[str],
                   order: str | None = None) -> DataFrame:
    """K2: on a key match replace only ``update`` columns and keep the rest;
    new keys are inserted with the source's columns (others NULL)."""
    src = latest_per_key(source, keys, order)
    s = src.select(*[F.col(k) for k in keys], F.lit(True).alias("__s"),
                   *[F.col(c).alias("__s_" + c) for c in update if c in src.columns])
    t = target.withColumn("__t", F.lit(True))
    j = t.join(s, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in update and "__s_" + c in s.columns:
            out.append(F.when(F.col("__s"), F.col("__s_" + c)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("__t"), F.col(c)).alias(c))
    return j.select(*out)


def new_rows(target: DataFrame, source: DataFrame, keys: list[str], required: list[str] | None = None) -> DataFrame:
    """K4: the source rows to insert: key not present yet, the least row of each key
    (by its columns in order); rows with an empty required field are skipped. Rows
    with a NULL in the key are all inserted: NULL never conflicts."""
    src = source
    for c in required or []:
        src = src.where(F.col(c).isNotNull() & (F.col(c) != ""))
    rest = [c for c in src.columns if c not in keys]
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    src = src.withColumn("__own", F.when(has_null, F.monotonically_increasing_id()))  # a group of its own
    one = src.groupBy(*keys, "__own").agg(*([F.min(F.struct(*rest)).alias("__r")] if rest else [F.count(F.lit(1)).alias("__n")]))
    one = one.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])
    return one.join(target.select(*keys), keys, "left_anti").select(*target.columns)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str],
                  required: list[str] | None = None) -> DataFrame:
    """K4: ``target`` and the new rows of ``source``."""
    return target.unionByName(new_rows(target, source, keys, required))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (NULL keys excluded, as a unique index does)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """K10 at size: the rows of ``key_violations`` by way of 64-bit hashes.

    First only hashes are shuffled and counted. Rows whose hash occurs once
    cannot repeat a key and drop out by a semi-join, which adaptive execution
    turns into a broadcast when few hashes repeat; so whole keys are shuffled
    and counted exactly for suspects alone. Equal hashes of different keys cost
    time, not correctness. A count-min sketch is no substitute: once there are
    more keys than cells, every key is a suspect.
    """
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    h = df.where(cond).select(*keys, F.xxhash64(*keys).alias("__h"))
    suspects = h.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__h")
    return key_violations(h.join(suspects, "__h", "left_semi"), keys)


def key_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """A row a table: its rows, rows with a NULL in the key, keys that repeat, and rows beyond the first of their key."""
    out = None
    zero = F.lit(0).cast("bigint")
    for name, (df, keys) in tables.items():
        has_null = F.lit(False)
        for k in keys:
            has_null = has_null | F.col(k).isNull()
        size = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(has_null, 1)).alias("null_keys"))
        bad = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum(F.col("n") - 1), zero).alias("surplus_rows"))
        both = size.select(F.lit(name).alias("table_name"), "n_rows", "null_keys", zero.alias("repeated_keys"), zero.alias("surplus_rows")).unionByName(
            bad.select(F.lit(name).alias("table_name"), zero.alias("n_rows"), zero.alias("null_keys"), "repeated_keys", "surplus_rows"))
        out = both if out is None else out.unionByName(both)
    return out.groupBy("table_name").agg(*[F.sum(c).alias(c) for c in out.columns[1:]])


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    """Write a table version into its own folder (Parquet)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)

