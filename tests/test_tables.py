"""Upsert, partial upsert, insert-ignore invariants (FIXTURES §2) and analytics edges."""

from helpers import rows
from pyspark.sql import functions as F

from ledgerline.operators import analytics as A
from ledgerline.operators import upsert as U

SCHEMA = "cik string, report_date string, v double"


def test_upsert_idempotent_and_null_keys(spark):
    t = spark.createDataFrame([("1", "2020", 1.0), ("2", "2020", 2.0), ("3", None, 3.0)], SCHEMA)
    s = spark.createDataFrame([("2", "2020", 20.0), ("4", "2021", 4.0), ("3", None, 30.0)], SCHEMA)
    once = U.upsert(t, s, ["cik", "report_date"])
    twice = U.upsert(once, s, ["cik", "report_date"])
    assert rows(once, "cik", "report_date", "v", order=["cik", "v"]) == [
        ("1", "2020", 1.0), ("2", "2020", 20.0), ("3", None, 3.0), ("3", None, 30.0), ("4", "2021", 4.0)]
    assert twice.where(F.col("report_date").isNotNull()).count() == once.where(F.col("report_date").isNotNull()).count()
    assert twice.where(F.col("report_date").isNull()).count() == 3  # NULL keys never conflict


def test_upsert_last_wins_in_source(spark):
    t = spark.createDataFrame([], "cik string, ticker string, pos long")
    s = spark.createDataFrame([("1", "A", 1), ("1", "B", 2)], "cik string, ticker string, pos long")
    assert rows(U.upsert(t, s, ["cik"], order="pos"), "ticker") == [("B",)]


def test_upsert_columns_keeps_others(spark):
    t = spark.createDataFrame([("1", "A", "CA", "x")], "cik string, ticker string, state string, sic string")
    s = spark.createDataFrame([("1", "B", "NY"), ("2", "C", "TX")], "cik string, ticker string, state string")
    got = rows(U.upsert_columns(t, s, ["cik"], ["ticker", "state"]), "cik", "ticker", "state", "sic", order=["cik"])
    assert got == [("1", "B", "NY", "x"), ("2", "C", "TX", None)]


def test_insert_ignore(spark):
    t = spark.createDataFrame([(1, "1", "10-Q", "u1")], "id long, cik string, filing_type string, url string")
    s = spark.createDataFrame([(2, "1", "10-Q", "u1"), (3, "1", "10-K", "u2"), (4, "1", "10-K", "u2"),
                               (5, "1", "S-1", "")], "id long, cik string, filing_type string, url string")
    out = U.insert_ignore(t, s, ["cik", "filing_type", "url"], required=["url"])
    assert rows(out, "filing_type", "url", order=["filing_type"]) == [("10-K", "u2"), ("10-Q", "u1")]
    assert U.key_violations(out, ["cik", "filing_type", "url"]).count() == 0


def test_histogram_edges_and_coverage(spark):
    vals = [-150.0, -100.0, -50.0, 0.0, 20.0, 40.0, 60.0, 80.0, 100.0, 101.0, None]
    f = spark.createDataFrame([(str(i), v) for i, v in enumerate(vals)], "cik string, ebitda_margin double")
    h = dict(rows(A.margin_histogram(f), "bucket", "n"))
    assert h == {"<-100": 1, "[-100,-50)": 1, "[-50,0)": 1, "[0,20)": 1, "[20,40)": 1, "[40,60)": 1,
                 "[60,80)": 1, "[80,100]": 2, ">100": 1}
    empty = f.where(F.lit(False))
    r = A.coverage(empty, {"pct": "ebitda_margin"}).collect()[0]
    assert (r.n, r.pct) == (0, None)
    r = A.coverage(f, {"pct": "ebitda_margin"}).collect()[0]
    assert r.pct == 90.9


def test_snapshot_keeps_ties(spark):
    f = spark.createDataFrame([("1", "2020-01-01", 1.0), ("1", "2021-01-01", 2.0), ("1", "2021-01-01", 3.0),
                               ("2", None, 4.0)], SCHEMA)
    c = spark.createDataFrame([("1", "A"), ("2", "B")], "cik string, ticker string")
    assert sorted(r.v for r in A.latest_snapshot(f, c).collect()) == [2.0, 3.0]


def test_kd_loss_cases(spark):
    from ledgerline.operators.evaluation import kd_loss
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, None, 4.0)], "s double, y double, t double")
    assert abs(kd_loss(df, "s", "y", "t").first().loss - 1.9) < 1e-12
    assert kd_loss(df, "s", "y", None).first().loss == 1.0
    assert kd_loss(df, "s", None, "t").first().loss == 4.0
    nn = spark.createDataFrame([(1.0, None, None)], "s double, y double, t double")
    assert kd_loss(nn, "s", "y", "t").first().loss is None


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    from ledgerline.operators.evaluation import exact_quantiles
    vals = [float(x) for x in np.random.default_rng(3).normal(size=997)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double").repartition(5)
    got = exact_quantiles(df, "x", [0.0, 0.05, 0.5, 0.9, 0.95, 1.0])
    want = np.quantile(np.array(vals), [0.0, 0.05, 0.5, 0.9, 0.95, 1.0])
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_global_rank_dense(spark):
    from ledgerline.operators.features import global_rank
    df = spark.range(500).withColumn("k", (F.col("id") * 7919) % 500).repartition(6)
    r = global_rank(df, [F.col("k"), F.col("id")], "rk")
    got = [(x.k, x.rk) for x in r.orderBy("rk").collect()]
    assert [rk for _, rk in got] == list(range(1, 501))
    assert [k for k, _ in got] == sorted(k for k, _ in got)


def test_exports_and_table_listing(spark):
    import os
    import tempfile

    from ledgerline.operators.analytics import table_listing
    from ledgerline.plans.summary import export_parquet, export_universe
    tmp = tempfile.mkdtemp(prefix="ll-export-")
    f = spark.createDataFrame([("1", "2020", 1.0)], SCHEMA)
    export_parquet(f, os.path.join(tmp, "fundamentals.parquet"))
    assert spark.read.parquet(os.path.join(tmp, "fundamentals.parquet")).collect() == f.collect()
    u = spark.createDataFrame([("AAA", "0000000001", "NASDAQ")], "ticker string, cik string, exchange string")
    export_universe(u, os.path.join(tmp, "universe.json"))
    assert spark.read.json(os.path.join(tmp, "universe.json")).select("ticker", "cik", "exchange").collect() == u.collect()
    f.createOrReplaceTempView("zz_fundamentals")
    u.createOrReplaceTempView("aa_universe")
    names = [r.table_name for r in table_listing(spark).collect()]
    assert names.index("aa_universe") < names.index("zz_fundamentals")
