"""Customers as filers: each tier, guard and fallback has rows, and the figures equal the SQL's."""

import os

import duckdb
import pytest

from ledgerline import catalog, oracles
from ledgerline import schemas as S


def sql_rows(sf_dir, name):
    con = duckdb.connect()
    for t in ("customer", "orders", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    rel = con.execute(oracles.ORACLES[name])
    cols = [c[0] for c in rel.description]
    return [dict(zip(cols, r)) for r in rel.fetchall()]


@pytest.fixture(scope="module")
def filed(spark, sf_dir):
    summ, fund = catalog._filers(spark, sf_dir)
    return [r.asDict() for r in fund.collect()], [r.asDict() for r in summ.collect()]


def near(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 1e-9 * max(abs(a), abs(b)))


def test_fundamentals_equal_the_sql(filed, sf_dir):
    want = {r["cik"]: r for r in sql_rows(sf_dir, "fundamentals_tiers")}
    got = {r["cik"]: r for r in filed[0]}
    assert got.keys() == want.keys()
    for cik, w in want.items():
        assert not [c for c in w if not near(got[cik][c], w[c])], cik


def test_every_tier_is_reached(filed):
    tags = {}
    for r in filed[1]:
        tags.setdefault(r["metric"], set()).add(r["tag"])
    assert tags["revenue"] == set(S.REVENUE_TAGS)
    assert tags["ebitda"] == {S.EBITDA_DIRECT_TAG, S.EBITDA_COMPOSITE_TAG}
    assert tags["cash"] == {S.CASH_DIRECT_TAG, S.CASH_COMPOSITE_TAG}
    assert tags["shares"] == {S.SHARES_TAG, S.SHARES_DEI_TAG}
    assert tags["deferred_revenue"] == {S.DEFERRED_COMPOSITE_TAG, S.DEFERRED_TOTAL_TAG}
    assert {r["form"] for r in filed[1]} == {"10-Q", "10-K", "20-F"}


def test_every_guard_and_fallback_is_reached(filed):
    fund = filed[0]
    has = lambda c, r: r[c] is not None
    # margins: kept, beyond 100, revenue not positive
    assert any(has("ebitda_margin", r) for r in fund)
    assert any(has("net_income_lq", r) and (r["revenue_lq"] or 0) > 0 and abs(r["net_income_lq"]) > r["revenue_lq"]
               and not has("net_income_margin", r) for r in fund)
    assert any(has("net_income_lq", r) and has("revenue_lq", r) and r["revenue_lq"] <= 0
               and not has("net_income_margin", r) for r in fund)
    # stamps: revenue, net income, operating income, newest filing, none but the filing's date
    assert any(has("revenue_lq", r) for r in fund)
    assert any(not has("revenue_lq", r) and has("net_income_lq", r) and has("fiscal_year", r) for r in fund)
    assert any(not has("revenue_lq", r) and not has("net_income_lq", r) and has("fiscal_year", r) for r in fund)
    assert any(has("report_date", r) and not has("fiscal_year", r) for r in fund)
    # prices: with and without, with and without a share count
    assert any(has("market_cap", r) for r in fund)
    assert any(has("stock_price", r) and not has("market_cap", r) for r in fund)
    assert any(not has("stock_price", r) and has("shares_outstanding", r) for r in fund)


@pytest.mark.parametrize("name", ["audit_tiers", "submissions_scan", "companies_both", "directory_scan"])
def test_landed_sources_equal_the_sql(spark, sf_dir, name):
    got = [r.asDict() for r in catalog.REGISTRY[name](spark, sf_dir).collect()]
    want = sql_rows(sf_dir, name)
    assert set(got[0]) == set(want[0])
    key = lambda r: tuple((str(type(v).__name__), str(v)) for _, v in sorted(r.items()))
    assert sorted(map(key, got)) == sorted(map(key, want))
