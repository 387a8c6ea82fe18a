"""Catalog tables in buckets of their key: plans without an exchange over the stored rows, merges against the plain operators."""

import re
import tempfile
import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ledgerline.operators import bucketed as B
from ledgerline.operators import upsert as U

KEYS = ["cik", "d"]
SCHEMA = "cik string, d string, v double"


@pytest.fixture
def stored(spark):
    """A table of 2,000 rows, a third of them of one company, some with a NULL date."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("cik"),
        F.when(F.col("id") % 97 != 0, F.concat(F.lit("d"), "id")).alias("d"), F.col("id").cast("double").alias("v"))
    name, path = f"t_{uuid.uuid4().hex[:10]}", tempfile.mkdtemp(prefix="ll-bucketed-")
    B.create(df, name, KEYS, buckets=4, parts=8, path=path)
    yield spark, name, path, df
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges_above_scan(plan: str) -> list[int]:
    """For each scan of the stored table, how many exchanges lie on its way to the top."""
    stack, out = [], []
    for line in plan.split("\n"):
        depth = len(re.match(r"[ :+\-]*", line)[0])
        stack = [s for s in stack if s[0] < depth] + [(depth, line)]
        if "FileScan parquet" in line and "Bucketed: true" in line:
            out.append(sum("Exchange" in x for _, x in stack))
    return out


def _batch(spark):
    return spark.createDataFrame([("hot", "d3", -1.0), ("new", "x", -2.0), ("c1", None, -3.0), ("c1", None, -3.0), ("hot", "d3", -5.0)], SCHEMA)


def _sorted(df):
    return sorted(map(repr, df.select("cik", "d", "v").collect()))


def test_upsert_equals_the_plain_one_and_does_not_shuffle_the_table(stored):
    spark, name, path, df = stored
    assert _exchanges_above_scan(_plan(B.upserted(spark, name, _batch(spark)))) == [0]
    want = _sorted(U.upsert(df, _batch(spark), KEYS))
    old = B.version(spark, name)
    B.upsert(spark, name, _batch(spark), path=path)
    assert len(spark.table(old).inputFiles()) <= 4 * 8  # one file a part and bucket
    assert len(spark.table(name).inputFiles()) <= 2 * 4 * 8  # and one more for what the batch brings
    assert _sorted(spark.table(name)) == want and B.version(spark, name) != old
    assert _sorted(spark.table(old).drop(B.PART)) == _sorted(df)  # readers of the old version keep it
    again = B.upserted(spark, name, _batch(spark))
    assert _exchanges_above_scan(_plan(again)) == [0]
    assert again.count() == len(want) + 2  # the NULL keys never conflict


def test_insert_reads_the_touched_parts_only(stored):
    spark, name, _, df = stored
    b = spark.createDataFrame([("hot", "d3", -1.0), ("hot", "d3", -1.0)], SCHEMA)
    plan = _plan(B.fresh_rows(spark, name, b))
    assert _exchanges_above_scan(plan) == [0]
    assert len(B.touched(spark, name, b).inputFiles()) <= 4 < len(spark.table(name).inputFiles())  # one part, four buckets
    B.insert(spark, name, _batch(spark).where("d IS NOT NULL"))
    B.insert(spark, name, _batch(spark).where("d IS NOT NULL"))
    got = spark.table(name)
    assert got.count() == 2001 and rows(got.where("cik = 'new'"), "d", "v") == [("x", -2.0)]
    assert got.where("cik = 'hot' AND d = 'd3'").first().v == 3.0  # ignored, not replaced
    assert U.duplicate_keys(got, KEYS).count() == 0
    assert _exchanges_above_scan(_plan(B.fresh_rows(spark, name, b))) == [0]  # appended files are in the same buckets


def test_the_hot_company_spreads_over_the_buckets(stored):
    spark, name, _, _ = stored
    per = spark.table(B.version(spark, name)).where("cik = 'hot'").groupBy(F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1)).count()
    counts = [r["count"] for r in per.collect()]
    assert len(counts) == 4 and max(counts) < 2 * min(counts)


def test_empty_table_and_empty_batch(spark):
    name, path = f"t_{uuid.uuid4().hex[:10]}", tempfile.mkdtemp(prefix="ll-bucketed-")
    none = spark.createDataFrame([], SCHEMA)
    B.create(none, name, KEYS, buckets=2, parts=2, path=path)
    B.insert(spark, name, none)
    assert spark.table(name).count() == 0
    B.insert(spark, name, _batch(spark))
    assert sorted(r.v for r in spark.table(name).collect()) == [-5.0, -3.0, -3.0, -2.0]  # the least row of a key, all NULL keys
    B.upsert(spark, name, none, path=path)
    assert spark.table(name).count() == 4


def test_duplicate_keys_equal_the_plain_count(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("cik"),
                                  F.when(F.col("id") % 5 != 0, (F.col("id") % 3).cast("string")).alias("d"), F.lit(1.0).alias("v"))
    a, b = (sorted(map(tuple, f(df, KEYS).collect())) for f in (U.duplicate_keys, U.key_violations))
    assert a == b and a
    r = U.key_report({"t": (df, KEYS), "empty": (df.limit(0), KEYS)}).collect()
    got = {x.table_name: tuple(x)[1:] for x in r}
    assert got["empty"] == (0, 0, 0, 0)
    assert got["t"] == (3000, 600, len(a), sum(x[-1] - 1 for x in a))


def test_raw_facts_insert_computes_the_facts_once(spark, sf_dir, monkeypatch):
    """The held rows and both inserts read the written facts; line items are not aggregated again."""
    from ledgerline import catalog
    from ledgerline.operators import bucketed
    seen, own = [], bucketed.insert
    monkeypatch.setattr(bucketed, "insert", lambda s, n, batch, *a: (seen.extend(batch.inputFiles()), own(s, n, batch, *a)))
    assert catalog.raw_facts_insert(spark, sf_dir).count() > 0
    assert seen and not any("lineitem" in f for f in seen)
