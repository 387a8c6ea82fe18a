"""Cell parsing (FIXTURES F-9) and feature selection."""

from pyspark.sql import functions as F

from ledgerline.functions import cells as C
from ledgerline.operators import features as X

CELLS = ["$1,234.50", "-$5", "12.5%", "1.5%", "1,234", "N/A", "–", "-", "", "null", "None", "na", "1e3",
         "1.0d", "(5)", " 7 ", "1_000", "inf"]
EXPECT = {  # cell: (money, percent, float)
    "$1,234.50": (1234.5, None, None), "-$5": (-5.0, None, None), "12.5%": (None, 0.125, None),
    "1.5%": (None, 1.5, None), "1,234": (1234.0, 12.34, None), "N/A": (None, None, None),
    "–": (None, None, None), "-": (None, None, None), "": (None, None, None), "null": (None, None, None),
    "None": (None, None, None), "na": (None, None, None), "1e3": (1000.0, 10.0, 1000.0),
    "1.0d": (None, None, None), "(5)": (None, None, None), " 7 ": (7.0, 0.07, 7.0),
    "1_000": (1000.0, 10.0, 1000.0), "inf": (None, None, None),
}


def test_cell_parsers(spark):
    df = spark.createDataFrame([(c,) for c in CELLS], "c string")
    got = df.select("c", C.parse_money("c").alias("m"), C.parse_percent("c").alias("p"),
                    C.to_float("c").alias("f")).collect()
    for r in got:
        assert (r.m, r.p, r.f) == EXPECT[r.c], r


def test_parser_kind():
    assert C.parser_kind("YoY Growth%", False) == "percent"
    assert C.parser_kind("Net Income Margin", True) == "percent"
    assert C.parser_kind("Employee Count", True) == "money"
    assert C.parser_kind("Employee Count", False) == "float"
    assert C.parser_kind("Total Debt", False) == "money"


def test_leaky_and_headers(spark):
    assert X.is_leaky("EV/Revenue") and X.is_leaky(" Market Cap ") and not X.is_leaky("Total Debt")
    df = spark.createDataFrame([("A", "1")], "`ticker` string, ` total debt ` string")
    assert X.normalise_headers(df).columns == ["Ticker", "Total Debt"]


def test_fit_features_rules(spark):
    rows = []
    for i in range(10):
        rows.append((f"T{i}", str(i + 1),
                     str(i) if i < 7 else "N/A",          # exactly 70 % valid: kept
                     str(i) if i < 6 else "N/A",          # 60 % valid: dropped
                     "5",                                 # constant: dropped
                     str(i * 2), "$%d" % i))
    df = spark.createDataFrame(rows, "Ticker string, `Revenue Multiple` string, Seventy string, Sixty string, "
                                     "Flat string, `EV/Revenue` string, Other string")
    med, names, plan = X.fit_features(df)
    assert names == ["Seventy", "Other"]
    assert plan == {"Seventy": "float", "Other": "money"}
    out = X.apply_features(df, med, names, plan).orderBy("Ticker").collect()
    assert [r["Seventy__num"] for r in out][-1] == 3.0  # median of 0..6


def test_chronological_split(spark):
    df = spark.createDataFrame([(i % 3, f"2020-01-{1 + i // 3:02d}") for i in range(20)] + [(9, None)],
                               "cik int, report_date string")
    s = X.chronological_split(df, "report_date", ["cik"], 0.2)
    assert s.where(F.col("split") == "train").count() == 16 and s.count() == 20
    newest_train = s.where(F.col("split") == "train").agg(F.max("report_date")).first()[0]
    oldest_val = s.where(F.col("split") == "val").agg(F.min("report_date")).first()[0]
    assert newest_train <= oldest_val


def test_hash_split_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = sorted(r.k for r in X.hash_split(df, ["k"]).where("is_test").collect())
    b = sorted(r.k for r in X.hash_split(df.repartition(7), ["k"]).where("is_test").collect())
    assert a == b and 150 < len(a) < 250


def test_ps_ratio_and_teacher(spark):
    df = spark.createDataFrame([("1", 10.0, 5.0), ("2", 1.0, 0.0), ("3", None, 2.0)],
                               "cik string, market_cap double, revenue_ltm double")
    assert [r.ps for r in df.select(X.ps_ratio(df).alias("ps")).orderBy("ps").collect()] == [None, None, 2.0]
    nocol = df.drop("market_cap")
    assert nocol.select(X.ps_ratio(nocol).alias("ps")).where("ps is not null").count() == 0
    ids = spark.createDataFrame([("A", "1"), ("B", "2")], "ticker string, cik string")
    t = spark.createDataFrame([("A", float("nan")), ("B", 3.0)], "ticker string, pred double")
    got = sorted((r.ticker, r.teacher_pred) for r in X.join_teacher(ids, t).collect())
    assert got == [("A", None), ("B", 3.0)]


def test_prepare_supervised_fits_on_train_only(spark):
    import pytest

    from ledgerline.plans.training import prepare_supervised
    rows = [("1", "A", "2020-01-01", 10.0, None, 5.0, 100.0), ("2", "B", "2020-02-01", 20.0, 7.0, None, 200.0),
            ("3", "C", "2020-03-01", 30.0, 9.0, 1.0, 300.0)]
    schema = "cik string, ticker string, report_date string, revenue_lq double, ebitda_lq double, " \
             "market_cap double, revenue_ltm double"
    train = spark.createDataFrame(rows, schema)
    val = spark.createDataFrame([("4", "D", "2021-01-01", 1000.0, None, None, 50.0)], schema)
    teacher = spark.createDataFrame([("A", 1.5), ("D", float("inf"))], "ticker string, pred double")
    out = prepare_supervised(train, {"val": val}, teacher)
    assert out["features"] == ["revenue_lq", "ebitda_lq", "revenue_ltm"]  # market_cap is leaky
    tr = {r.ticker: r for r in out["train"].collect()}
    assert abs(sum(r.revenue_lq for r in tr.values())) < 1e-12          # centred on train
    v = out["val"].collect()[0]
    assert v.ebitda_lq == (8.0 - 8.0) / ((2.0 / 3.0) ** 0.5)           # train median 8 imputed, train std
    assert v.teacher_pred is None and tr["A"].teacher_pred == 1.5
    assert tr["A"].ps_target == 5.0 / 100.0
    none = spark.createDataFrame([("1", "A", "2020-01-01", 10.0, 1.0, None, 100.0)], schema)
    with pytest.raises(ValueError):
        prepare_supervised(none, require_ps=True)
