"""Keyed tables that the catalog holds in buckets of their key (K1, K3, K4, K9).

A table is written with ``partitionBy(key_part).bucketBy(buckets, *keys)``.
``upsert`` and ``new_rows`` join on exactly these keys, so Spark scans the
stored side bucket by bucket and shuffles the batch alone. ``key_part`` is a
hash of the whole key; a batch reads only the parts that its keys fall in, so a
small batch doesn't read all history. Both hashes cover the whole key: a
company that holds a third of all rows spreads over all buckets.

An insert appends files. An upsert writes a new table and then replaces the
view that names the current one, so that a failed run leaves a table that
nobody reads, and readers of the old version are not disturbed.

NULL in a key never conflicts, as in a SQL unique index. Empty tables and
batches are allowed. A batch must have the table's columns; others are left out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import upsert as U

#: Buckets are the tasks of a merge, parts the grain of what a small batch reads; a table has buckets x parts files at least.
BUCKETS, PARTS = 16, 16
PART = "key_part"


def _part(keys: list[str], parts: int):
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def _gathered(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """The rows of one part and bucket in one task, so that a write makes one file for each, whatever the number of tasks.

    ``hash`` is the function by which Spark fills buckets.
    """
    return df.repartition(F.col(PART), F.pmod(F.hash(*keys), F.lit(buckets)))


def save(df: DataFrame, table: str, keys: list[str], buckets: int = BUCKETS, parts: int = PARTS, path: str | None = None,
         append: bool = False) -> None:
    """Write ``df`` to the catalog table ``table`` (below ``path``, else in the warehouse), a file for each part and bucket."""
    w = (_gathered(df.withColumn(PART, _part(keys, parts)), keys, buckets).write.format("parquet")
         .mode("append" if append else "errorifexists").partitionBy(PART).bucketBy(buckets, *keys).sortBy(*keys))
    (w.option("path", path) if path else w).saveAsTable(table)


def _layout(spark: SparkSession, table: str) -> tuple[list[str], int, int]:
    """(keys, buckets, parts) that a table was made with."""
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    keys = [k.strip().strip("`") for k in info["Bucket Columns"].strip("[]").split(",")]
    props = dict(p.split("=", 1) for p in info.get("Table Properties", "").strip("[]").split(",") if "=" in p)
    return keys, int(info["Num Buckets"]), int(props[PART])


def create(df: DataFrame, name: str, keys: list[str], buckets: int = BUCKETS, parts: int = PARTS, path: str | None = None) -> str:
    """First version of the table ``name`` from rows with unique keys; returns the version's own table name."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    save(df, table, keys, buckets, parts, f"{path}/{table}" if path else None)
    _publish(spark, name, table, parts)
    return table


def _publish(spark: SparkSession, name: str, table: str, parts: int) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PART}' = '{parts}')")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('version' = '{table}') AS SELECT * EXCEPT ({PART}) FROM {table}")


def version(spark: SparkSession, name: str) -> str:
    """The catalog table that holds the current rows of ``name``."""
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('version')").first()["value"]


def touched(spark: SparkSession, name: str, batch: DataFrame) -> DataFrame:
    """The current rows in the parts that the keys of ``batch`` fall in (one number a part comes to the driver)."""
    table = version(spark, name)
    keys, _, parts = _layout(spark, table)
    hit = sorted(r[0] for r in batch.select(_part(keys, parts)).distinct().collect())
    return spark.table(table).where(F.col(PART).isin(hit)).drop(PART)


def upserted(spark: SparkSession, name: str, batch: DataFrame, order: str | None = None) -> DataFrame:
    """K1, K3: all rows of ``name`` after the upsert, with ``key_part``; the plan has no exchange over the stored rows."""
    table = version(spark, name)
    keys, buckets, parts = _layout(spark, table)
    current = spark.table(table)
    new = U.latest_per_key(batch.select(*[c for c in current.columns if c != PART]), keys, order)
    kept = current.join(new.select(*keys), keys, "left_anti")
    return kept.unionByName(_gathered(new.withColumn(PART, _part(keys, parts)), keys, buckets))


def upsert(spark: SparkSession, name: str, batch: DataFrame, order: str | None = None, path: str | None = None) -> str:
    """K1, K3: write the rows after the upsert as a new version; returns its table name.

    The kept rows are already in buckets and are written task by task as they were read; only the batch is gathered.
    """
    keys, buckets, parts = _layout(spark, version(spark, name))
    new = f"{name}_{uuid.uuid4().hex}"
    w = (upserted(spark, name, batch, order).write.format("parquet").mode("errorifexists")
         .partitionBy(PART).bucketBy(buckets, *keys).sortBy(*keys))
    (w.option("path", f"{path}/{new}") if path else w).saveAsTable(new)
    _publish(spark, name, new, parts)
    return new


def fresh_rows(spark: SparkSession, name: str, batch: DataFrame, required: list[str] | None = None) -> DataFrame:
    """K4, K9: the rows of ``batch`` whose key the table does not have, one a key; reads keys of the touched parts only."""
    keys, _, _ = _layout(spark, version(spark, name))
    return U.new_rows(touched(spark, name, batch), batch, keys, required)


def insert(spark: SparkSession, name: str, batch: DataFrame, required: list[str] | None = None) -> None:
    """K4, K9: append the new rows of ``batch``; a batch that is brought again adds nothing (but for rows with a NULL in the key)."""
    table = version(spark, name)
    keys, buckets, parts = _layout(spark, table)
    save(fresh_rows(spark, name, batch, required), table, keys, buckets, parts, append=True)
    spark.catalog.refreshTable(table)
