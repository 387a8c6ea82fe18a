"""End-to-end: landed JSON → four tables, twice (idempotent upserts), then the summary."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans import fundamentals as P
from ledgerline.plans import summary as SM


def _write_lines(path, docs):
    with open(path, "w") as fh:
        for d in docs:
            fh.write(json.dumps(d) + "\n")


def _landing(tmp):
    facts = [
        {"cik": 1, "facts": {"us-gaap": {
            S.REVENUE_TAGS[1]: {"units": {"USD": [
                {"end": f"2023-0{3 * q}-30", "val": 100 * q, "form": "10-Q", "fy": 2023, "fp": f"Q{q}", "qtrs": q}
                for q in (1, 2, 3)]}},
            "NetIncomeLoss": {"units": {"USD": [
                {"end": "2023-09-30", "val": 30, "form": "10-Q", "fy": 2023, "fp": "Q3", "qtrs": 3}]}}}}},
        {"cik": 2, "facts": {"dei": {S.SHARES_DEI_TAG: {"units": {"shares": [
            {"end": "2023-06-30", "val": 5, "form": "10-Q", "fy": 2023, "fp": "Q2"}]}}}}},
        {"cik": 3, "facts": {"us-gaap": {}}},
    ]
    subs = [
        {"cik": "1", "name": "One", "filings": {"recent": {"form": ["10-Q", "10-K"], "accessionNumber": ["a-1", "a-2"],
                                                          "primaryDocument": ["q.htm", "k.htm"],
                                                          "filingDate": ["2023-11-01", "2023-02-01"]}}},
        {"cik": "2", "entityType": "other", "filings": {"recent": {"form": ["8-K"], "accessionNumber": ["b-1"],
                                                                  "primaryDocument": ["e.htm"],
                                                                  "filingDate": ["2023-12-01"]}}},
    ]
    tmap = {"0": {"ticker": "one", "cik_str": 1, "title": "One"}, "1": {"ticker": "TWO", "cik_str": 2, "title": "Two"},
            "2": {"ticker": "THR", "cik_str": 3, "title": "Three"}}
    _write_lines(os.path.join(tmp, "facts.json"), facts)
    _write_lines(os.path.join(tmp, "subs.json"), subs)
    with open(os.path.join(tmp, "tickers.json"), "w") as fh:
        json.dump(tmap, fh)


def test_end_to_end(spark):
    tmp = tempfile.mkdtemp(prefix="ll-e2e-")
    _landing(tmp)
    store = os.path.join(tmp, "store")
    from ledgerline.sources import facts as FA, submissions as SU, symbols as SY
    tm = SY.ticker_map(SY.read_ticker_map_json(spark, os.path.join(tmp, "tickers.json")))
    new = P.build_tables(spark, FA.read_company_facts(spark, os.path.join(tmp, "facts.json"), multi_line=False),
                         SU.read_submissions(spark, os.path.join(tmp, "subs.json"), multi_line=False), tm)
    P.apply_to_store(spark, new, store)
    P.apply_to_store(spark, new, store)  # second run: upserts are idempotent, audit appends
    f = P.read_current(spark, store, "fundamentals")
    assert f.count() == 2  # company 3 has no submissions (J7)
    one = f.where(F.col("cik") == "0000000001").first()
    assert (one.report_date, one.revenue_lq, one.net_income_lq) == ("2023-09-30", 100.0, 30.0)
    assert one.net_income_margin == 30.0
    two = f.where(F.col("cik") == "0000000002").first()
    assert (two.report_date, two.shares_outstanding, two.revenue_lq) == ("2023-12-01", 5.0, None)
    c = P.read_current(spark, store, "companies")
    assert sorted((r.cik, r.ticker, r.name) for r in c.collect()) == [
        ("0000000001", "ONE", "One"), ("0000000002", "TWO", "other")]
    fl = P.read_current(spark, store, "filings")
    assert fl.count() == 2
    assert P.read_current(spark, store, "fundamentals_audit").count() == 2 * 3
    views = SM.register_store(spark, store)
    assert "fundamentals" in views
    out = SM.summary(spark, f, c, fl)
    assert out["companies"].first().companies == 2
    assert out["coverage"].first().pct_rev_lq == 50.0


def test_store_survives_a_crash_and_a_replay(spark, monkeypatch):
    tmp = tempfile.mkdtemp(prefix="ll-store-")
    _landing(tmp)
    store = os.path.join(tmp, "store")
    from ledgerline.sources import facts as FA, submissions as SU, symbols as SY
    docs = FA.read_company_facts(spark, os.path.join(tmp, "facts.json"), multi_line=False)
    subs = SU.read_submissions(spark, os.path.join(tmp, "subs.json"), multi_line=False)
    new = P.build_tables(spark, docs, subs, SY.ticker_map(SY.read_ticker_map_json(spark, os.path.join(tmp, "tickers.json"))))
    assert [r.cik for r in P.skipped_companies(docs, subs).collect()] == ["0000000003"]

    write, calls = P.U.write_table, []

    def failing(df, path, **k):
        calls.append(path)
        if len(calls) == 3:
            df.limit(1).write.parquet(path)  # a partial folder
            raise OSError("lost")
        write(df, path, **k)

    monkeypatch.setattr(P.U, "write_table", failing)
    try:
        P.apply_to_store(spark, new, store, "s", 0)
        raise AssertionError("must fail")
    except OSError:
        pass
    assert P.read_current(spark, store, "companies") is None  # nothing of the failed run is seen
    monkeypatch.setattr(P.U, "write_table", write)
    first = P.apply_to_store(spark, new, store, "s", 0)
    assert P.apply_to_store(spark, new, store, "s", 0) == {}  # a replayed batch
    assert P.read_current(spark, store, "fundamentals_audit").count() == 3
    P.apply_to_store(spark, new, store, "s", 1)
    kept = P.read_manifest(spark, store)["tables"]["fundamentals_audit"].values()
    assert len(kept) == 2 and any(first["fundamentals_audit"].endswith(k) for k in kept)  # appended, not rewritten
    assert P.read_current(spark, store, "filings").count() == 2 and P.read_current(spark, store, "companies").count() == 2


def test_a_company_without_facts_has_a_row(spark):
    tmp = tempfile.mkdtemp(prefix="ll-nofacts-")
    _write_lines(os.path.join(tmp, "f.json"), [{"cik": 1, "facts": {"us-gaap": {}}}])
    _write_lines(os.path.join(tmp, "s.json"), [{"cik": "1", "name": "One", "filings": {"recent": {
        "form": ["10-Q"], "accessionNumber": ["a-1"], "primaryDocument": ["q.htm"], "filingDate": ["2023-11-01"]}}}])
    with open(os.path.join(tmp, "t.json"), "w") as fh:
        json.dump({"0": {"ticker": "one", "cik_str": 1, "title": "One"}}, fh)
    from ledgerline.sources import facts as FA, submissions as SU, symbols as SY
    new = P.build_tables(spark, FA.read_company_facts(spark, os.path.join(tmp, "f.json"), multi_line=False),
                         SU.read_submissions(spark, os.path.join(tmp, "s.json"), multi_line=False),
                         SY.ticker_map(SY.read_ticker_map_json(spark, os.path.join(tmp, "t.json"))))
    assert [(r.cik, r.ticker) for r in new["companies"].collect()] == [("0000000001", "ONE")]
    f = new["fundamentals"].collect()
    assert len(f) == 1 and f[0].revenue_lq is None and f[0].report_date == "2023-11-01"


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "lq" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_streaming_landing(spark):
    from ledgerline.streaming import landing
    tmp = tempfile.mkdtemp(prefix="ll-stream-")
    _landing(tmp)
    land = os.path.join(tmp, "landing")
    os.makedirs(land)
    os.replace(os.path.join(tmp, "facts.json"), os.path.join(land, "batch1.json"))
    store = os.path.join(tmp, "store")
    q = landing.start(spark, land, os.path.join(tmp, "subs.json"), os.path.join(tmp, "tickers.json"), store,
                      checkpoint=os.path.join(tmp, "ckpt"), multi_line=False)
    q.awaitTermination(300)
    f = P.read_current(spark, store, "fundamentals")
    assert f is not None and f.count() == 2


def test_train_and_report(spark, sf_dir):
    from ledgerline.plans import training as T
    from ledgerline.sources import driver as D
    out = tempfile.mkdtemp(prefix="ll-train-")
    rep = T.train_and_report(spark, D.part_sheet(spark, sf_dir), out, ensemble=2)
    assert rep["feature_count"] >= 3 and rep["metrics"]["n_test"] > 0
    assert rep["metrics"]["mae"] >= 0
    from ledgerline.operators import features as X
    sheet = D.part_sheet(spark, sf_dir)
    med, names, plan = X.fit_features(X.with_target(X.normalise_headers(sheet)))
    req = spark.createDataFrame([(" p1 ",), ("nope",)], "ticker string")
    # score with the stored members (feature names come from the fitted report)
    scored = T.score_tickers(spark, sheet, req, out, [n.removesuffix(X.FEATURE_SUFFIX) for n in rep["feature_names"]],
                             rep["parsers"], 2).collect()
    assert len(scored) == 2
