"""Submissions (F-5), ticker map (F-6), symbol directories (F-7), tickers list (F-8)."""

import json
import os
import tempfile

from helpers import rows
from pyspark.sql import functions as F

from ledgerline.sources import submissions as SU
from ledgerline.sources import symbols as SY


def write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w") as fh:
        fh.write(text)
    return p


SUBS = {
    "cik": "0000000042", "name": 7, "entityType": "operating",
    "addresses": {"business": {"stateOrCountry": "CA"}}, "stateOfIncorporation": "DE", "sic": "7372",
    "sicDescription": "Software", "fiscalYearEnd": "1231",
    "filings": {"recent": {"form": ["8-K", "10-Q", "10-Q", "10-K"],
                           "accessionNumber": ["0001-23-000001", "0001-23-000002", "0001-23-000003", "0001-23-000004"],
                           "primaryDocument": ["a.htm", "b.htm", "c.htm", "d.htm"],
                           "filingDate": ["2023-11-01", "2023-10-30", "2023-07-30", "2023-02-01"]}},
}


def test_submissions(spark):
    tmp = tempfile.mkdtemp(prefix="ll-subs-")
    p = write(tmp, "s.json", json.dumps(SUBS))
    subs = SU.read_submissions(spark, p)
    links = rows(SU.latest_filing_links(SU.recent_filings(subs)), "filing_type", "url", order=["filing_type"])
    assert links == [("10-K", "https://www.sec.gov/Archives/edgar/data/42/000123000004/d.htm"),
                     ("10-Q", "https://www.sec.gov/Archives/edgar/data/42/000123000002/b.htm")]
    assert rows(SU.newest_filing_date(SU.recent_filings(subs)), "filing_date") == [("2023-11-01",)]
    m = SU.company_metadata(subs).collect()[0]
    assert (m.cik, m.business_state, m.state_incorp) == ("0000000042", "CA", "DE")


def test_ticker_map(spark):
    tmp = tempfile.mkdtemp(prefix="ll-tm-")
    doc = {"0": {"ticker": "abc", "cik_str": 1, "title": "A"}, "1": {"ticker": " ", "cik_str": 2, "title": "B"},
           "2": {"ticker": "XY", "cik_str": 3, "title": "C"}, "3": {"ticker": "xy", "cik_str": 4, "title": "D"},
           "4": {"ticker": "Q", "cik_str": "", "title": "E"}, "5": {"ticker": "LONG", "cik_str": 12345678901, "title": "F"}}
    p = write(tmp, "m.json", json.dumps(doc))
    tm = SY.ticker_map(SY.read_ticker_map_json(spark, p))
    assert rows(tm, "ticker", "cik", order=["ticker"]) == [
        ("ABC", "0000000001"), ("LONG", "12345678901"), ("XY", "0000000004")]
    assert [r.ticker for r in SY.all_tickers(tm).collect()] == ["ABC", "LONG", "XY"]  # S9: ALL, sorted


def test_symbol_directories_and_universe(spark):
    tmp = tempfile.mkdtemp(prefix="ll-dir-")
    nas = write(tmp, "nasdaqlisted.txt", "Symbol|Security Name|ETF|Test Issue\nAAA|A Inc|N|N\nBB.W|B wt|N|N\n"
                "ETF1|Fund|Y|N\nTST|Test|N|Y\nDUP|Dup Nasdaq|N|N\nFile Creation Time: 0101202400:00|||\n")
    oth = write(tmp, "otherlisted.txt", "ACT Symbol|Security Name|Exchange|ETF|Test Issue\nCCC|C Corp|N|N|N\n"
                "DUP|Dup Other|N|N|N\nD$P|Pref|N|N|N\nE^R|Right|A|N|N\nFile Creation Time: 0101202400:00||||\n")
    d = SY.symbol_directory(SY.read_symbol_directory(spark, nas), SY.read_symbol_directory(spark, oth))
    assert rows(d, "ticker", "exchange", order=["ticker"]) == [
        ("AAA", "NASDAQ"), ("CCC", "N"), ("DUP", "NASDAQ"), ("ETF1", "NASDAQ"), ("TST", "NASDAQ")]
    tm = spark.createDataFrame([("AAA", "0000000001", 0), ("CCC", "0000000002", 1)], "ticker string, cik string, pos long")
    u = SY.universe(d, tm)
    assert rows(u, "ticker", "cik") == [("CCC", "0000000002"), ("AAA", "0000000001"), ("DUP", None)]
    u2 = SY.universe(d, tm, include_etfs=True, exchanges=["n"])
    assert rows(u2, "ticker") == [("CCC",)]
    empty = d.where(F.lit(False))
    assert rows(SY.universe(empty, tm), "ticker", "exchange") == [("AAA", "UNKNOWN"), ("CCC", "UNKNOWN")]


def test_tickers_list(spark):
    tmp = tempfile.mkdtemp(prefix="ll-tk-")
    p = write(tmp, "t.txt", "# comment\nmsft\n\n adbe \nAAPL\n")
    arg = SY.tickers_from_arg(spark, "aapl, ,MSFT")
    f = SY.read_tickers_file(spark, p)
    merged = arg.unionByName(f).groupBy("ticker").agg(F.min("pos").alias("pos"))
    assert [r.ticker for r in merged.orderBy("pos").collect()] == ["AAPL", "MSFT", "ADBE"]


def test_variant_scan_equals_the_declared_schema_and_survives_odd_parts(spark):
    from helpers import doc, entries

    from ledgerline.sources import facts as FA
    good = doc(7, {"Revenues": entries(("2023-03-31", "1.5", "10-Q", 2023, "Q1", 1), ("2023-06-30", 2e3, "10-Q", "2023", "Q2", 2))},
               extra_ns={"dei": {"Shares": {"units": {"shares": [{"val": 5, "scale": 3, "end": "2023-03-31"}]}}},
                         "own": {"X": {"units": {"EUR": [{"val": "1_0", "segment": {}}, {"val": 1, "segment": {"a": 1}}, {"val": 2, "dimensional": True},
                                                         {"val": 3, "dimensional": "false"}, {"val": "n/a"}, {"val": None}]}}}})
    texts = spark.createDataFrame([(json.dumps(good),)], "value string")
    want = FA.facts_frame(FA.parse_company_facts(texts)).collect()
    got = FA.entries_frame(FA.variant_entries(texts)).collect()
    key = lambda r: (r.namespace, r.tag, r.unit, r.pos)
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 5
    odd = {"cik": 8, "facts": {"us-gaap": {"A": 5, "B": {"units": "none"}, "C": {"units": {"USD": 1}}, "D": {"units": {"USD": [7, None, [1], {"val": 4}]}},
                                           "E": {"label": "x"}}, "dei": [], "bad": None}}
    more = [json.dumps(odd), "no json", "", None, "{}", json.dumps({"facts": odd["facts"]}), json.dumps({"cik": "", "facts": 3}), "[1]"]
    rows_ = FA.entries_frame(FA.variant_entries(spark.createDataFrame([(t,) for t in more], "value string"))).collect()
    assert [(r.cik, r.tag, r.pos, r.val) for r in sorted(rows_, key=key)] == [("0000000008", "D", 3, 4.0)]
