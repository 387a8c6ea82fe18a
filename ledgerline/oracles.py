"""DuckDB text for the oracle check of every query in ``ledgerline.catalog``.

Written independently of the Spark operators (plain SQL windows and
joins over the driver views), so a match is evidence, not an echo.
"""

from __future__ import annotations

# Shared adapter: lineitem per (supplier, year, quarter) as fact entries.
AF = """
li AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS cik,
         CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(quarter(l_shipdate) AS INTEGER) AS q,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(l_quantity AS DECIMAL(18,2)) AS qty,
         CAST(l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l_tax AS DECIMAL(4,2)) AS tax,
         l_returnflag AS flag, l_linestatus AS status
  FROM lineitem),
sq AS (
  SELECT cik, yr, q,
         SUM(price) AS revenue,
         SUM(CASE WHEN flag = 'R' THEN -price ELSE price END) AS op_income,
         SUM(CASE WHEN flag = 'A' THEN price WHEN flag = 'R' THEN -price ELSE 0 END) AS net_income,
         SUM(qty) AS da,
         SUM(CASE WHEN status = 'F' THEN price * (1 - disc) END) AS cash,
         SUM(CASE WHEN tax >= 0.06 THEN price * tax END) AS sti,
         SUM(CASE WHEN disc >= 0.09 THEN price * disc END) AS debt_nc,
         SUM(CASE WHEN disc <= 0.01 THEN price * disc END) AS debt_c,
         SUM(CASE WHEN flag = 'R' THEN qty END) AS borrow,
         COUNT(*) AS shares
  FROM li GROUP BY cik, yr, q),
ytd AS (
  SELECT *,
         SUM(revenue) OVER w AS revenue_ytd, SUM(op_income) OVER w AS op_ytd,
         SUM(net_income) OVER w AS ni_ytd, SUM(da) OVER w AS da_ytd
  FROM sq
  WINDOW w AS (PARTITION BY cik, yr ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
fe AS (
  SELECT cik, 'us-gaap' AS namespace,
         CASE WHEN yr >= 1998 THEN 'RevenueFromContractWithCustomerExcludingAssessedTax' ELSE 'SalesRevenueNet' END AS tag,
         'USD' AS unit, yr, q, CAST(revenue_ytd AS DECIMAL(30,4)) AS v, q AS qtrs FROM ytd
  UNION ALL SELECT cik, 'us-gaap',
         CASE WHEN yr >= 1998 THEN 'RevenueFromContractWithCustomerExcludingAssessedTax' ELSE 'SalesRevenueNet' END,
         'EUR', yr, q, CAST(CASE WHEN q = 4 THEN revenue_ytd * 0.9 END AS DECIMAL(30,4)), q FROM ytd
  UNION ALL SELECT cik, 'us-gaap', 'OperatingIncomeLoss', 'USD', yr, q, CAST(op_ytd AS DECIMAL(30,4)), q FROM ytd
  UNION ALL SELECT cik, 'us-gaap', 'NetIncomeLoss', 'USD', yr, q, CAST(ni_ytd AS DECIMAL(30,4)), q FROM ytd
  UNION ALL SELECT cik, 'us-gaap', 'DepreciationAndAmortization', 'USD', yr, q, CAST(da_ytd AS DECIMAL(30,4)), q FROM ytd
  UNION ALL SELECT cik, 'us-gaap', 'CashAndCashEquivalentsAtCarryingValue', 'USD', yr, q, CAST(cash AS DECIMAL(30,4)), NULL FROM ytd
  UNION ALL SELECT cik, 'us-gaap', 'ShortTermInvestments', 'USD', yr, q, CAST(sti AS DECIMAL(30,4)), NULL FROM ytd
  UNION ALL SELECT cik, 'us-gaap', 'LongTermDebtNoncurrent', 'USD', yr, q, CAST(debt_nc AS DECIMAL(30,4)), NULL FROM ytd
  UNION ALL SELECT cik, 'us-gaap', 'LongTermDebtCurrent', 'USD', yr, q, CAST(debt_c AS DECIMAL(30,4)), NULL FROM ytd
  UNION ALL SELECT cik, 'us-gaap', 'ShortTermBorrowings', 'USD', yr, q, CAST(borrow AS DECIMAL(30,4)), NULL FROM ytd
  UNION ALL SELECT cik, 'dei', 'EntityCommonStockSharesOutstanding', 'shares', yr, q, CAST(shares AS DECIMAL(30,4)), NULL FROM ytd),
facts AS (
  SELECT cik, namespace, tag, unit,
         last_day(make_date(yr, q * 3, 1)) AS "end",
         CASE WHEN q = 4 THEN '10-K' ELSE '10-Q' END AS form,
         CAST(yr AS INTEGER) AS fy,
         CASE WHEN q = 4 THEN 'FY' ELSE 'Q' || CAST(q AS VARCHAR) END AS fp,
         CAST(qtrs AS INTEGER) AS qtrs, CAST(v AS DECIMAL(30,4)) AS val, 0 AS scale_applied,
         CAST(yr * 10 + q AS BIGINT) AS pos
  FROM fe WHERE v IS NOT NULL)
"""

FP_IDX = "CASE {c} WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'Q4' THEN 4 ELSE 0 END"

# Revenue: first tag with rows wins; then YTD → quarter.
REVENUE_SERIES = """
rev_tagged AS (
  SELECT *, 'revenue' AS metric,
         CASE tag WHEN 'RevenueFromContractWithCustomerExcludingAssessedTax' THEN 1 WHEN 'Revenues' THEN 2
                  WHEN 'SalesRevenueNet' THEN 3 WHEN 'SalesRevenueGoodsNet' THEN 4
                  WHEN 'SalesRevenueServicesAndOtherNet' THEN 5 END AS prio
  FROM facts WHERE namespace = 'us-gaap' AND unit = 'USD'
    AND tag IN ('RevenueFromContractWithCustomerExcludingAssessedTax', 'Revenues', 'SalesRevenueNet',
                'SalesRevenueGoodsNet', 'SalesRevenueServicesAndOtherNet')),
rev_raw AS (SELECT * FROM rev_tagged QUALIFY prio = min(prio) OVER (PARTITION BY cik)),
ni_raw AS (SELECT *, 'net_income' AS metric, 1 AS prio FROM facts
           WHERE namespace = 'us-gaap' AND unit = 'USD' AND tag = 'NetIncomeLoss'),
op_raw AS (SELECT *, 'ebitda' AS metric, 1 AS prio FROM facts
           WHERE namespace = 'us-gaap' AND unit = 'USD' AND tag = 'OperatingIncomeLoss'),
da_raw AS (SELECT *, 'ebitda' AS metric, 2 AS prio FROM facts
           WHERE namespace = 'us-gaap' AND unit = 'USD' AND tag = 'DepreciationAndAmortization'),
flows AS (SELECT * FROM rev_raw UNION ALL SELECT * FROM ni_raw UNION ALL SELECT * FROM op_raw
          UNION ALL SELECT * FROM da_raw),
lagged AS (
  SELECT *, lag(val) OVER w AS pv, lag(qtrs) OVER w AS pq, lag(fp) OVER w AS pfp
  FROM flows
  WINDOW w AS (PARTITION BY cik, metric, tag, form, fy ORDER BY "end" ASC NULLS LAST, pos ASC NULLS LAST)),
quarterly AS (
  SELECT cik, metric, tag, unit, "end", form, fy, fp, qtrs, scale_applied, pos, prio,
         CASE WHEN val IS NULL THEN NULL
              WHEN ((qtrs IS NOT NULL AND pq IS NOT NULL AND pq = qtrs - 1)
                    OR (""" + FP_IDX.format(c="fp") + """ > 0 AND """ + FP_IDX.format(c="pfp") + """ > 0
                        AND """ + FP_IDX.format(c="pfp") + """ = """ + FP_IDX.format(c="fp") + """ - 1))
                   AND pv IS NOT NULL THEN val - pv
              ELSE val END AS val
  FROM lagged),
ebitda_join AS (
  SELECT a.cik, 'ebitda' AS metric, a."end", a.form, a.fy, a.fp,
         COALESCE(a.val, 0) + COALESCE(b.val, 0) AS val, a.pos AS pos, b.pos AS pos2
  FROM quarterly a JOIN quarterly b
    ON a.cik = b.cik AND a.metric = 'ebitda' AND a.prio = 1 AND b.metric = 'ebitda' AND b.prio = 2
   AND a."end" IS NOT DISTINCT FROM b."end" AND a.form IS NOT DISTINCT FROM b.form
   AND a.fy IS NOT DISTINCT FROM b.fy AND a.fp IS NOT DISTINCT FROM b.fp),
flow_series AS (
  SELECT cik, metric, tag, "end", form, fy, fp, val, pos, 0 AS pos2 FROM quarterly WHERE metric <> 'ebitda'
  UNION ALL SELECT cik, metric, 'OperatingIncomeLoss+DepreciationAndAmortization', "end", form, fy, fp, val, pos, pos2
  FROM ebitda_join),
flow_tiered AS (
  SELECT *, CASE WHEN form = '10-Q' THEN 1 WHEN form = '10-K' THEN 2 ELSE 3 END AS ftier FROM flow_series
  QUALIFY ftier = min(CASE WHEN form = '10-Q' THEN 1 WHEN form = '10-K' THEN 2 ELSE 3 END)
                  OVER (PARTITION BY cik, metric)),
flow_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cik, metric
                               ORDER BY form DESC NULLS FIRST, fy DESC NULLS FIRST, "end" DESC NULLS FIRST,
                                        pos DESC, pos2 DESC) AS rn
  FROM flow_tiered),
flow_summary AS (
  SELECT cik, metric,
         CAST(max(CASE WHEN rn = 1 THEN val END) AS DOUBLE) AS lq,
         CAST(max(CASE WHEN rn = 1 THEN val END) AS DOUBLE) * 4.0 AS annualized,
         CASE WHEN count(*) >= 4 THEN COALESCE(CAST(sum(CASE WHEN rn <= 4 THEN val END) AS DOUBLE), 0.0) END AS ltm,
         CASE WHEN count(*) >= 5 AND max(CASE WHEN rn = 5 THEN CAST(val AS DOUBLE) END) <> 0 THEN
              (CAST(max(CASE WHEN rn = 1 THEN val END) AS DOUBLE) - max(CASE WHEN rn = 5 THEN CAST(val AS DOUBLE) END))
              / max(CASE WHEN rn = 5 THEN CAST(val AS DOUBLE) END) * 100.0 END AS yoy,
         max(CASE WHEN rn = 1 THEN "end" END) AS report_date,
         max(CASE WHEN rn = 1 THEN fy END) AS fy,
         max(CASE WHEN rn = 1 THEN fp END) AS fp
  FROM flow_ranked WHERE rn <= 8 GROUP BY cik, metric)
"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


ORACLES: dict[str, str] = {}

ORACLES["latest_metrics"] = with_ctes(AF, REVENUE_SERIES) + """
SELECT cik, metric, lq, annualized, ltm, yoy, report_date, fy, fp FROM flow_summary
"""


ORACLES["quarterly_from_ytd"] = with_ctes(AF, REVENUE_SERIES) + """
SELECT cik, metric, "end" AS period_end, form, fy, fp, CAST(val AS DOUBLE) AS quarter_val FROM flow_series
"""

ORACLES["latest_quarters_n"] = with_ctes(AF, REVENUE_SERIES) + """
SELECT cik, metric, CAST(rn AS INTEGER) AS rn, "end" AS period_end, form, fy, fp, CAST(val AS DOUBLE) AS quarter_val
FROM flow_ranked WHERE rn <= 8
"""

ORACLES["metric_ltm"] = with_ctes(AF, REVENUE_SERIES) + "SELECT cik, metric, ltm FROM flow_summary"
ORACLES["metric_yoy"] = with_ctes(AF, REVENUE_SERIES) + "SELECT cik, metric, yoy FROM flow_summary"
ORACLES["metric_annualized"] = with_ctes(AF, REVENUE_SERIES) + "SELECT cik, metric, lq, annualized FROM flow_summary"

ORACLES["ebitda_composite"] = with_ctes(AF, REVENUE_SERIES) + """
SELECT cik, 'OperatingIncomeLoss+DepreciationAndAmortization' AS tag, "end" AS period_end, form, fy, fp,
       CAST(val AS DOUBLE) AS ebitda_val
FROM ebitda_join
"""

MARGIN = """
CASE WHEN {n}.cik IS NOT NULL AND {d}.cik IS NOT NULL
      AND {n}."end" IS NOT DISTINCT FROM {d}."end" AND {n}.form IS NOT DISTINCT FROM {d}.form
      AND {n}.fy IS NOT DISTINCT FROM {d}.fy AND {n}.fp IS NOT DISTINCT FROM {d}.fp
      AND CAST({d}.val AS DOUBLE) > 0
      AND abs(CAST({n}.val AS DOUBLE) / CAST({d}.val AS DOUBLE) * 100.0) <= 100
     THEN CAST({n}.val AS DOUBLE) / CAST({d}.val AS DOUBLE) * 100.0 END"""

NEWEST_FLOWS = """
newest AS (SELECT * FROM flow_ranked WHERE rn = 1),
flow_ciks AS (SELECT DISTINCT cik FROM newest),
flow_wide AS (
  SELECT c.cik,""" + MARGIN.format(n="e", d="r") + """ AS ebitda_margin,""" + MARGIN.format(n="ni", d="r") + """ AS net_income_margin
  FROM flow_ciks c
  LEFT JOIN newest r ON r.cik = c.cik AND r.metric = 'revenue'
  LEFT JOIN newest e ON e.cik = c.cik AND e.metric = 'ebitda'
  LEFT JOIN newest ni ON ni.cik = c.cik AND ni.metric = 'net_income')
"""

ORACLES["margin_aligned"] = with_ctes(AF, REVENUE_SERIES, NEWEST_FLOWS) + """
SELECT cik, ebitda_margin, net_income_margin FROM flow_wide
"""

BALANCE = """
bal_sum AS (
  SELECT cik, 'cash' AS metric, 'CashAndCashEquivalentsAtCarryingValue(+ShortTermInvestments)' AS tag,
         "end", form, fy, fp, SUM(val) AS val
  FROM facts
  WHERE namespace = 'us-gaap' AND unit = 'USD'
    AND tag IN ('CashAndCashEquivalentsAtCarryingValue', 'ShortTermInvestments')
    AND "end" IS NOT NULL AND form IS NOT NULL AND fy IS NOT NULL AND fp IS NOT NULL
  GROUP BY cik, "end", form, fy, fp
  UNION ALL
  SELECT cik, 'debt', 'LongTermDebtNoncurrent+LongTermDebtCurrent+ShortTermBorrowings',
         "end", form, fy, fp, SUM(val)
  FROM facts
  WHERE namespace = 'us-gaap' AND unit = 'USD'
    AND tag IN ('LongTermDebtNoncurrent', 'LongTermDebtCurrent', 'ShortTermBorrowings')
    AND "end" IS NOT NULL AND form IS NOT NULL AND fy IS NOT NULL AND fp IS NOT NULL
  GROUP BY cik, "end", form, fy, fp),
bal_all AS (
  SELECT cik, metric, tag, 'USD' AS unit, "end", form, fy, fp, val, 0 AS scale_applied,
         CAST(NULL AS BIGINT) AS pos, 'sum' AS kind FROM bal_sum
  UNION ALL
  SELECT cik, 'shares', tag, unit, "end", form, fy, fp, val, scale_applied, pos, 'raw'
  FROM facts WHERE namespace = 'dei' AND tag = 'EntityCommonStockSharesOutstanding' AND unit = 'shares'
  UNION ALL
  SELECT cik, 'operating_income', tag, unit, "end", form, fy, fp, val, scale_applied, pos, 'raw'
  FROM facts WHERE namespace = 'us-gaap' AND tag = 'OperatingIncomeLoss' AND unit = 'USD'),
bal_tiered AS (
  SELECT *, CASE WHEN form = '10-Q' THEN 1 WHEN form = '10-K' THEN 2 ELSE 3 END AS ftier FROM bal_all),
bal_newest AS (
  SELECT * FROM bal_tiered
  QUALIFY ftier = min(ftier) OVER (PARTITION BY cik, metric)
      AND row_number() OVER (PARTITION BY cik, metric ORDER BY ftier,
            "end" DESC NULLS FIRST, form DESC NULLS FIRST,
            CASE WHEN kind = 'sum' THEN fy END DESC NULLS FIRST,
            CASE WHEN kind = 'sum' THEN fp END DESC NULLS FIRST, pos DESC NULLS FIRST) = 1)
"""

ORACLES["component_sum"] = with_ctes(AF, BALANCE) + """
SELECT cik, metric, tag, "end" AS period_end, form, fy, fp, CAST(val AS DOUBLE) AS val FROM bal_sum
"""

ORACLES["tag_priority"] = with_ctes(AF, REVENUE_SERIES) + """
SELECT cik, tag, count(*) AS n_rows FROM rev_raw GROUP BY cik, tag
"""


# The accepted (metric, namespace, tag, unit), stated here and not taken from the engine.
ACCEPTED = """
mm(metric, namespace, tag, unit) AS (VALUES
  ('revenue', 'us-gaap', 'RevenueFromContractWithCustomerExcludingAssessedTax', 'USD'),
  ('revenue', 'us-gaap', 'Revenues', 'USD'),
  ('revenue', 'us-gaap', 'SalesRevenueNet', 'USD'),
  ('revenue', 'us-gaap', 'SalesRevenueGoodsNet', 'USD'),
  ('revenue', 'us-gaap', 'SalesRevenueServicesAndOtherNet', 'USD'),
  ('ebitda', 'us-gaap', 'EarningsBeforeInterestTaxesDepreciationAndAmortization', 'USD'),
  ('ebitda', 'us-gaap', 'OperatingIncomeLoss', 'USD'),
  ('ebitda', 'us-gaap', 'DepreciationAndAmortization', 'USD'),
  ('net_income', 'us-gaap', 'NetIncomeLoss', 'USD'),
  ('operating_income', 'us-gaap', 'OperatingIncomeLoss', 'USD'),
  ('cash', 'us-gaap', 'CashCashEquivalentsAndShortTermInvestments', 'USD'),
  ('cash', 'us-gaap', 'CashAndCashEquivalentsAtCarryingValue', 'USD'),
  ('cash', 'us-gaap', 'ShortTermInvestments', 'USD'),
  ('debt', 'us-gaap', 'LongTermDebtNoncurrent', 'USD'),
  ('debt', 'us-gaap', 'LongTermDebtCurrent', 'USD'),
  ('debt', 'us-gaap', 'ShortTermBorrowings', 'USD'),
  ('shares', 'us-gaap', 'CommonStockSharesOutstanding', 'shares'),
  ('shares', 'dei', 'EntityCommonStockSharesOutstanding', 'shares'),
  ('deferred_revenue', 'us-gaap', 'ContractWithCustomerLiabilityCurrent', 'USD'),
  ('deferred_revenue', 'us-gaap', 'ContractWithCustomerLiabilityNoncurrent', 'USD'),
  ('deferred_revenue', 'us-gaap', 'DeferredRevenueCurrent', 'USD'),
  ('deferred_revenue', 'us-gaap', 'DeferredRevenueNoncurrent', 'USD'),
  ('deferred_revenue', 'us-gaap', 'DeferredRevenue', 'USD'))
"""

ORACLES["unit_filter"] = with_ctes(AF, ACCEPTED) + """
SELECT mm.metric, f.tag, f.unit, count(*) AS n_facts
FROM facts f JOIN mm ON f.namespace = mm.namespace AND f.tag = mm.tag AND f.unit = mm.unit
GROUP BY mm.metric, f.tag, f.unit
"""

ORACLES["facts_scan"] = with_ctes(AF) + """
SELECT cik, namespace, tag, unit, "end" AS period_end, form, fy, fp, qtrs,
       CAST(val AS DOUBLE) * CASE WHEN fp = 'Q1' THEN 1000.0 ELSE 1.0 END AS val,
       CASE WHEN fp = 'Q1' THEN 3 ELSE 0 END AS scale_applied
FROM (SELECT * FROM facts
      UNION ALL SELECT * REPLACE ('ifrs-full' AS namespace) FROM facts WHERE tag = 'NetIncomeLoss')
"""

ORACLES["scale_normalise"] = """
WITH raw AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'n/a'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS v,
         CASE WHEN l_linenumber = 1 THEN '3' WHEN l_linenumber = 2 THEN 'x' WHEN l_linenumber = 3 THEN NULL
              WHEN l_linenumber = 4 THEN '-2' ELSE CAST(l_linenumber - 5 AS VARCHAR) END AS s
  FROM lineitem)
SELECT l_orderkey, l_linenumber,
       TRY_CAST(v AS DOUBLE) * pow(10.0, COALESCE(TRY_CAST(s AS INTEGER), 0)) AS val,
       CAST(COALESCE(TRY_CAST(s AS INTEGER), 0) AS INTEGER) AS scale_applied
FROM raw WHERE TRY_CAST(v AS DOUBLE) IS NOT NULL
"""

STAMPS = """
sup AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik FROM supplier),
filing AS (SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS cik,
                  max(CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS newest_filing
           FROM lineitem GROUP BY 1),
stamp_cands AS (
  SELECT cik, "end", fy, fp, CASE metric WHEN 'revenue' THEN 1 ELSE 2 END AS o
  FROM newest WHERE metric IN ('revenue', 'net_income') AND "end" IS NOT NULL
  UNION ALL
  SELECT cik, "end", fy, fp, 3 FROM bal_newest WHERE metric = 'operating_income' AND "end" IS NOT NULL),
stamp AS (SELECT * FROM stamp_cands QUALIFY row_number() OVER (PARTITION BY cik ORDER BY o) = 1),
stamped AS (
  SELECT s.cik,
         COALESCE(CAST(st."end" AS VARCHAR), fl.newest_filing) AS report_date,
         CAST(st.fy AS INTEGER) AS fiscal_year, st.fp AS fiscal_period
  FROM sup s LEFT JOIN stamp st ON st.cik = s.cik LEFT JOIN filing fl ON fl.cik = s.cik)
"""

ORACLES["report_stamp"] = with_ctes(AF, REVENUE_SERIES, NEWEST_FLOWS, BALANCE, STAMPS) + """
SELECT cik, report_date, fiscal_year, fiscal_period FROM stamped
"""

ORACLES["audit_rows"] = with_ctes(AF, REVENUE_SERIES, NEWEST_FLOWS, BALANCE, STAMPS) + """
, audit_src AS (
  SELECT cik, CASE metric WHEN 'revenue' THEN 'revenue_lq' WHEN 'ebitda' THEN 'ebitda_lq'
                          ELSE 'net_income_lq' END AS metric,
         CAST(val AS DOUBLE) AS value, tag AS source_tag, 'USD' AS unit,
         CASE WHEN metric = 'ebitda' THEN 0 ELSE 0 END AS scale_applied, form, fy, fp
  FROM newest
  UNION ALL
  SELECT cik, CASE metric WHEN 'cash' THEN 'cash_sti' WHEN 'debt' THEN 'total_debt'
                          ELSE 'shares_outstanding' END,
         CAST(val AS DOUBLE), tag, unit, scale_applied, form, fy, fp
  FROM bal_newest WHERE metric IN ('cash', 'debt', 'shares'))
SELECT a.cik, s.report_date, s.fiscal_year, s.fiscal_period, a.metric, a.value, a.source_tag, a.unit,
       CAST(a.scale_applied AS INTEGER) AS scale_applied, a.form, CAST(a.fy AS INTEGER) AS fy, a.fp
FROM audit_src a LEFT JOIN stamped s ON s.cik = a.cik
"""

ORACLES["fundamentals_table"] = with_ctes(AF, REVENUE_SERIES, NEWEST_FLOWS, BALANCE, STAMPS) + """
SELECT st.cik, st.report_date, st.fiscal_year, st.fiscal_period,
       rs.lq AS revenue_lq, rs.annualized AS revenue_annualized, rs.ltm AS revenue_ltm, rs.yoy AS revenue_yoy,
       es.lq AS ebitda_lq, es.annualized AS ebitda_annualized, es.ltm AS ebitda_ltm, es.yoy AS ebitda_yoy,
       fw.ebitda_margin,
       ns.lq AS net_income_lq, ns.annualized AS net_income_annualized, ns.ltm AS net_income_ltm,
       ns.yoy AS net_income_yoy, fw.net_income_margin,
       CAST(NULL AS DOUBLE) AS gross_profit_lq, CAST(NULL AS DOUBLE) AS gross_margin,
       CAST(NULL AS DOUBLE) AS operating_income_lq, CAST(NULL AS DOUBLE) AS operating_margin,
       CAST(NULL AS DOUBLE) AS cfo_lq, CAST(NULL AS DOUBLE) AS capex_lq, CAST(NULL AS DOUBLE) AS fcf_lq,
       CAST(bc.val AS DOUBLE) AS cash_sti, CAST(bd.val AS DOUBLE) AS total_debt,
       CAST(bs.val AS DOUBLE) AS shares_outstanding,
       CAST(NULL AS DOUBLE) AS stock_price, CAST(NULL AS DOUBLE) AS market_cap,
       CAST(NULL AS DOUBLE) AS deferred_revenue
FROM stamped st
LEFT JOIN flow_summary rs ON rs.cik = st.cik AND rs.metric = 'revenue'
LEFT JOIN flow_summary es ON es.cik = st.cik AND es.metric = 'ebitda'
LEFT JOIN flow_summary ns ON ns.cik = st.cik AND ns.metric = 'net_income'
LEFT JOIN flow_wide fw ON fw.cik = st.cik
LEFT JOIN bal_newest bc ON bc.cik = st.cik AND bc.metric = 'cash'
LEFT JOIN bal_newest bd ON bd.cik = st.cik AND bd.metric = 'debt'
LEFT JOIN bal_newest bs ON bs.cik = st.cik AND bs.metric = 'shares'
"""


DIRECTORY = """
nas AS (
  SELECT upper(trim('S' || CAST(s_suppkey AS VARCHAR))) AS ticker, 'NASDAQ' AS exchange, s_name AS name,
         s_acctbal < 0 AS etf, false AS test, 0 AS src, CAST(s_suppkey AS BIGINT) AS pos
  FROM supplier),
oth AS (
  SELECT upper(trim('C' || CAST(c_custkey AS VARCHAR) || CASE WHEN c_mktsegment = 'MACHINERY' THEN '.W' ELSE '' END)) AS ticker,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'BUILDING' THEN 'N' WHEN 'FURNITURE' THEN 'P' ELSE 'Z' END AS exchange,
         c_name AS name, c_acctbal < 0 AS etf, c_mktsegment = 'HOUSEHOLD' AS test, 1 AS src, CAST(c_custkey AS BIGINT) AS pos
  FROM customer
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), 'N', s_name, false, false, 1, CAST(s_suppkey AS BIGINT) + 4294967296
  FROM supplier WHERE s_acctbal > 9000),
dir AS (
  SELECT * FROM (SELECT * FROM nas UNION ALL SELECT * FROM oth)
  WHERE ticker IS NOT NULL AND NOT regexp_matches(ticker, '[\\^~$.]')
  QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY src, pos) = 1)
"""

TICKER_MAP = """
tm_raw AS (
  SELECT 'c' || CAST(c_custkey AS VARCHAR) AS ticker, CAST(c_custkey AS VARCHAR) AS cik_str, c_name AS title,
         CAST(c_custkey AS BIGINT) AS pos
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT ' S' || CAST(s_suppkey AS VARCHAR), CAST(s_suppkey + 100000000 AS VARCHAR), s_name,
         CAST(s_suppkey AS BIGINT) + 4294967296 FROM supplier
  UNION ALL
  SELECT substring(n_name, 1, 2), CAST(n_nationkey + 900000000 AS VARCHAR), n_name,
         CAST(n_nationkey AS BIGINT) + 8589934592 FROM nation),
tm AS (
  SELECT upper(trim(ticker)) AS ticker, lpad(trim(cik_str), 10, '0') AS cik, title, pos FROM tm_raw
  WHERE upper(trim(ticker)) <> '' AND trim(cik_str) <> ''
  QUALIFY row_number() OVER (PARTITION BY upper(trim(ticker)) ORDER BY pos DESC) = 1)
"""

REQUESTED = """
req_lines AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'C' || CAST(o_custkey AS VARCHAR)
                            WHEN 'O' THEN '  c' || CAST(o_custkey AS VARCHAR) || ' '
                            ELSE '# C' || CAST(o_custkey AS VARCHAR) END AS line,
         o_orderkey AS pos
  FROM orders),
req AS (
  SELECT upper(trim(line)) AS ticker, min(pos) AS pos FROM req_lines
  WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')
  GROUP BY 1)
"""

ORACLES["symbol_filter"] = with_ctes(DIRECTORY) + "SELECT ticker, exchange, name, etf, test FROM dir"

ORACLES["universe"] = with_ctes(DIRECTORY, TICKER_MAP) + """
SELECT d.ticker, tm.cik, d.exchange, d.name, d.etf, d.test
FROM dir d LEFT JOIN tm ON tm.ticker = d.ticker
WHERE NOT d.test AND NOT d.etf AND upper(d.exchange) IN ('NASDAQ', 'N', 'A')
"""

ORACLES["ticker_lookup"] = with_ctes(TICKER_MAP, REQUESTED) + """
SELECT r.ticker, tm.cik, r.pos AS first_pos FROM req r JOIN tm ON tm.ticker = r.ticker
"""

ORACLES["ticker_missing"] = with_ctes(TICKER_MAP, REQUESTED) + """
SELECT r.ticker, r.pos AS first_pos FROM req r WHERE NOT EXISTS (SELECT 1 FROM tm WHERE tm.ticker = r.ticker)
"""

ORACLES["ticker_map_table"] = with_ctes(TICKER_MAP) + "SELECT ticker, cik, title FROM tm"

FILINGS = """
ofl AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
         CASE o_orderpriority WHEN '1-URGENT' THEN '10-K' WHEN '2-HIGH' THEN '10-Q'
                              WHEN '3-MEDIUM' THEN 'S-1' ELSE '8-K' END AS form,
         lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '-' || strftime(CAST(o_orderdate AS DATE), '%y') || '-'
           || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS accession,
         'd' || CAST(o_orderkey AS VARCHAR) || '.htm' AS document,
         CAST(o_orderdate AS DATE) AS d, o_orderkey
  FROM orders),
links AS (
  SELECT cik, form AS filing_type,
         'https://www.sec.gov/Archives/edgar/data/' || CAST(CAST(cik AS BIGINT) AS VARCHAR) || '/'
           || replace(accession, '-', '') || '/' || document AS url
  FROM ofl WHERE form IN ('10-Q', '10-K', 'S-1')
  QUALIFY row_number() OVER (PARTITION BY cik, form ORDER BY d DESC, o_orderkey DESC) = 1)
"""

ORACLES["latest_filing_url"] = with_ctes(FILINGS) + "SELECT cik, filing_type, url FROM links"


HISTORY = """
oh AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CAST(o_orderdate AS DATE) AS d,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderstatus AS st, o_orderpriority AS pr
  FROM orders),
ohg AS (
  SELECT cik, d, SUM(price) AS total,
         SUM(CASE WHEN st = 'F' THEN price END) AS f_sum,
         SUM(CASE WHEN st = 'O' THEN price END) AS o_sum,
         SUM(CASE WHEN st = 'F' THEN price WHEN st = 'O' THEN -price END) AS fo,
         SUM(CASE WHEN st = 'O' THEN price WHEN st = 'P' THEN -price END) AS op,
         SUM(CASE WHEN pr IN ('1-URGENT', '2-HIGH') THEN price END) AS cash,
         SUM(CASE WHEN pr = '5-LOW' THEN price END) AS debt,
         SUM(CASE WHEN pr = '4-NOT SPECIFIED' THEN 1000 END) AS shares
  FROM oh GROUP BY cik, d),
hist AS (
  SELECT cik, CAST(d AS VARCHAR) AS report_date, CAST(year(d) AS INTEGER) AS fiscal_year,
         'Q' || CAST(quarter(d) AS VARCHAR) AS fiscal_period,
         CAST(total AS DOUBLE) AS revenue_lq, CAST(f_sum AS DOUBLE) AS ebitda_lq,
         CAST(o_sum AS DOUBLE) AS net_income_lq, CAST(cash AS DOUBLE) AS cash_sti,
         CAST(debt AS DOUBLE) AS total_debt, CAST(shares AS DOUBLE) AS shares_outstanding,
         CAST(fo AS DOUBLE) / 2000.0 AS ebitda_margin,
         CAST(op AS DOUBLE) / 2000.0 AS net_income_margin,
         CAST(NULL AS DOUBLE) AS market_cap, CAST(total AS DOUBLE) * 4.0 AS revenue_ltm
  FROM ohg)
"""

CUSTOMER_COMPANIES = """
comp AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, 'C' || CAST(c_custkey AS VARCHAR) AS ticker,
         c_name AS name, CAST(c_nationkey AS VARCHAR) AS business_state, c_mktsegment AS state_incorp,
         CAST(c_nationkey AS VARCHAR) AS sic, c_mktsegment AS sic_description, '1231' AS fiscal_year_end,
         CAST(c_acctbal AS DOUBLE) AS last_price, CAST(NULL AS DOUBLE) AS market_cap
  FROM customer)
"""


def _pct1(expr: str) -> str:
    return (f"CASE WHEN count(*) > 0 THEN CAST((2000 * CAST({expr} AS BIGINT) + count(*)) // (2 * count(*)) "
            f"AS DOUBLE) / 10.0 END")


ORACLES["company_count"] = "SELECT count(*) AS companies FROM customer"

ORACLES["coverage_pct"] = with_ctes(HISTORY) + "SELECT count(*) AS n, " + ", ".join(
    f"{_pct1(f'count({c})')} AS {a}" for a, c in [
        ("pct_rev_lq", "revenue_lq"), ("pct_ebitda_lq", "ebitda_lq"), ("pct_ni_lq", "net_income_lq"),
        ("pct_cash_sti", "cash_sti"), ("pct_debt", "total_debt"), ("pct_shares", "shares_outstanding")]) + " FROM hist"

ORACLES["null_pct"] = with_ctes(HISTORY) + "SELECT " + ", ".join(
    f"{_pct1(f'count(*) FILTER (WHERE {c} IS NULL)')} AS {a}" for a, c in [
        ("pct_null_report_date", "report_date"), ("pct_null_revenue_lq", "revenue_lq"),
        ("pct_null_ebitda_lq", "ebitda_lq"), ("pct_null_net_income_lq", "net_income_lq"),
        ("pct_null_cash_sti", "cash_sti"), ("pct_null_total_debt", "total_debt"),
        ("pct_null_shares", "shares_outstanding")]) + " FROM hist"

ORACLES["rows_per_date"] = with_ctes(HISTORY) + """
SELECT report_date, count(*) AS "rows" FROM hist WHERE report_date IS NOT NULL
GROUP BY report_date ORDER BY report_date DESC LIMIT 5
"""

ORACLES["sample_rows"] = with_ctes(HISTORY, CUSTOMER_COMPANIES) + """
SELECT c.ticker, f.report_date, f.revenue_lq, f.net_income_lq
FROM hist f JOIN comp c USING (cik)
WHERE f.revenue_lq IS NOT NULL AND f.net_income_lq IS NOT NULL
ORDER BY c.ticker, f.report_date LIMIT 10
"""

ORACLES["margin_histogram"] = with_ctes(HISTORY) + """
, base AS (SELECT ebitda_margin AS m FROM hist WHERE ebitda_margin IS NOT NULL)
SELECT CASE WHEN m < -100 THEN '<-100' WHEN m < -50 THEN '[-100,-50)' WHEN m < 0 THEN '[-50,0)'
            WHEN m < 20 THEN '[0,20)' WHEN m < 40 THEN '[20,40)' WHEN m < 60 THEN '[40,60)'
            WHEN m < 80 THEN '[60,80)' WHEN m <= 100 THEN '[80,100]' ELSE '>100' END AS bucket,
       count(*) AS n
FROM base GROUP BY 1 ORDER BY 1
"""

ORACLES["margin_outliers"] = with_ctes(HISTORY, CUSTOMER_COMPANIES, FILINGS) + """
, fil AS (SELECT CAST(cik AS BIGINT) * 10 + CASE filing_type WHEN '10-Q' THEN 1 WHEN '10-K' THEN 2 ELSE 3 END AS id,
                 cik, filing_type, url FROM links)
SELECT c.ticker, f.report_date, f.ebitda_margin, f.net_income_margin,
       (SELECT url FROM fil WHERE fil.cik = f.cik AND filing_type IN ('10-Q', '10-K') ORDER BY id DESC LIMIT 1) AS filing_url
FROM hist f JOIN comp c USING (cik)
WHERE (abs(f.ebitda_margin) > 100 OR abs(f.net_income_margin) > 100)
ORDER BY abs(COALESCE(f.ebitda_margin, 0)) + abs(COALESCE(f.net_income_margin, 0)) DESC, c.ticker, f.report_date
LIMIT 20
"""

ORACLES["snapshot_latest"] = with_ctes(HISTORY, CUSTOMER_COMPANIES) + """
, latest AS (
  SELECT f.* FROM (SELECT cik, max(report_date) AS mr FROM hist GROUP BY cik) j
  JOIN hist f ON f.cik = j.cik AND f.report_date = j.mr)
SELECT l.*, c.ticker FROM latest l JOIN comp c USING (cik) WHERE l.report_date IS NOT NULL
"""

HALVES = """
tgt AS (SELECT * FROM comp WHERE sic_description IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')),
src AS (SELECT cik, lower(ticker) AS ticker, upper(name) AS name, 'X' || business_state AS business_state,
               state_incorp, '9999' AS sic, sic_description, fiscal_year_end, last_price, market_cap
        FROM comp WHERE sic_description IN ('FURNITURE', 'HOUSEHOLD', 'MACHINERY'))
"""

ORACLES["upsert_company"] = with_ctes(CUSTOMER_COMPANIES, HALVES) + """
SELECT * FROM tgt WHERE cik NOT IN (SELECT cik FROM src)
UNION ALL SELECT * FROM src
"""

ORACLES["upsert_company_partial"] = with_ctes(CUSTOMER_COMPANIES, HALVES) + """
SELECT COALESCE(t.cik, s.cik) AS cik,
       CASE WHEN s.cik IS NOT NULL THEN s.ticker ELSE t.ticker END AS ticker,
       CASE WHEN s.cik IS NOT NULL THEN s.name ELSE t.name END AS name,
       CASE WHEN s.cik IS NOT NULL THEN s.business_state ELSE t.business_state END AS business_state,
       t.state_incorp, t.sic, t.sic_description, t.fiscal_year_end,
       CASE WHEN s.cik IS NOT NULL THEN s.last_price ELSE t.last_price END AS last_price,
       CASE WHEN s.cik IS NOT NULL THEN s.market_cap ELSE t.market_cap END AS market_cap
FROM tgt t FULL OUTER JOIN src s ON t.cik = s.cik
"""

ORACLES["upsert_period"] = with_ctes(HISTORY) + """
, tgt AS (SELECT * FROM hist WHERE report_date < '1999-01-01'),
src AS (SELECT * REPLACE (revenue_lq * 2.0 AS revenue_lq) FROM hist WHERE report_date >= '1998-01-01')
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.cik = t.cik AND s.report_date = t.report_date)
UNION ALL SELECT * FROM src
"""

ORACLES["insert_ignore"] = with_ctes(FILINGS) + """
SELECT cik, filing_type, url FROM links WHERE filing_type = '10-K'
UNION ALL
SELECT cik, filing_type, url FROM links l
WHERE url IS NOT NULL AND url <> ''
  AND NOT EXISTS (SELECT 1 FROM links t WHERE t.filing_type = '10-K' AND t.cik = l.cik
                  AND t.filing_type = l.filing_type AND t.url = l.url)
"""

ORACLES["bucketed_upsert_period"] = ORACLES["upsert_period"]

ORACLES["raw_facts_insert"] = with_ctes(AF) + """
, raw AS (
  SELECT cik, tag AS concept, unit, CAST("end" AS VARCHAR) AS "end", CAST(fy AS INTEGER) AS fy, fp, form,
         CAST(val AS DOUBLE) AS val, 'null' AS dims
  FROM facts WHERE namespace = 'us-gaap'
  QUALIFY row_number() OVER (PARTITION BY cik, tag, unit ORDER BY pos DESC) <= 4),
one AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY cik, concept, unit, "end", form, dims
                             ORDER BY fy NULLS FIRST, fp NULLS FIRST, val NULLS FIRST) = 1)
SELECT * REPLACE (CASE WHEN form = '10-K' THEN val + 1.0 ELSE val END AS val) FROM one
"""


def _key_row(name: str, rel: str, keys: list[str]) -> str:
    """One line of the key report in SQL."""
    cols, no_null = ", ".join(keys), " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""
SELECT '{name}' AS table_name, (SELECT COUNT(*) FROM {rel}) AS n_rows,
       (SELECT COUNT(*) FROM {rel} WHERE NOT ({no_null})) AS null_keys,
       COUNT(*) AS repeated_keys, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT {cols}, COUNT(*) AS n FROM {rel} WHERE {no_null} GROUP BY {cols} HAVING COUNT(*) > 1)"""


ORACLES["key_report"] = with_ctes(CUSTOMER_COMPANIES, HALVES, HISTORY, FILINGS, AF) + """
, bothcomp AS (SELECT cik FROM tgt UNION ALL SELECT cik FROM src),
fund0 AS (SELECT * FROM hist UNION ALL SELECT * FROM hist WHERE fiscal_year = 1997),
fund AS (SELECT cik, CASE WHEN fiscal_period <> 'Q4' THEN report_date END AS report_date FROM fund0),
rawf AS (
  SELECT cik, tag AS concept, unit, CAST("end" AS VARCHAR) AS "end", form, 'null' AS dims
  FROM facts WHERE namespace = 'us-gaap'
  QUALIFY row_number() OVER (PARTITION BY cik, tag, unit ORDER BY pos DESC) <= 4)
""" + "\nUNION ALL".join([
    _key_row("companies", "bothcomp", ["cik"]), _key_row("fundamentals", "fund", ["cik", "report_date"]),
    _key_row("filings", "links", ["cik", "filing_type", "url"]),
    _key_row("facts_raw", "rawf", ["cik", "concept", "unit", '"end"', "form", "dims"])])


SHEET = """
sheet AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS ticker,
         CASE WHEN p_size > 47 THEN 'N/A' ELSE CAST(p_size AS VARCHAR) || '.5' END AS c_target,
         '$' || format('{:,.2f}', p_retailprice * 10) AS c_revenue,
         CAST(p_size AS VARCHAR) || '%' AS c_yoy,
         CASE WHEN p_type = 'PROMO' THEN '-' ELSE CAST(p_size - 25 AS VARCHAR) || '%' END AS c_margin,
         CASE WHEN p_type = 'ECONOMY' THEN '–' ELSE CAST(p_size * 10 AS VARCHAR) END AS c_emp,
         CASE WHEN p_type = 'SMALL' THEN 'null' ELSE '$' || format('{:,.2f}', p_retailprice * 2) END AS c_debt,
         CAST(p_size + 1980 AS VARCHAR) AS c_ipo,
         regexp_extract(p_brand, '#([0-9]+)', 1) AS c_brand,
         '1' AS c_listed,
         CASE WHEN p_size < 10 THEN CAST(p_size AS VARCHAR) ELSE 'N/A' END AS c_sparse
  FROM part)
"""

MISSING = "('', 'N/A', 'NA', 'na', 'null', 'None', '–', '-')"


def _money(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR trim({c}) IN {MISSING} THEN NULL "
            f"ELSE TRY_CAST(trim(replace(replace({c}, '$', ''), ',', '')) AS DOUBLE) END")


def _float(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR trim({c}) IN {MISSING} THEN NULL ELSE TRY_CAST(trim({c}) AS DOUBLE) END"


def _pct(c: str) -> str:
    v = f"TRY_CAST(trim(replace(regexp_replace(trim({c}), '%$', ''), ',', '')) AS DOUBLE)"
    return (f"CASE WHEN {c} IS NULL OR trim({c}) IN {MISSING} THEN NULL "
            f"WHEN abs({v}) > 2 THEN {v} / 100.0 ELSE {v} END")


ORACLES["parse_money"] = with_ctes(SHEET) + f"""
SELECT ticker, {_money('c_revenue')} AS last_quarter_revenue, {_money('c_debt')} AS total_debt,
       {_money('c_emp')} AS employee_count FROM sheet
"""

ORACLES["parse_percent"] = with_ctes(SHEET) + f"""
SELECT ticker, {_pct('c_yoy')} AS yoy_growth, {_pct('c_margin')} AS ebitda_margin,
       {_pct('c_debt')} AS debt_as_percent FROM sheet
"""

ORACLES["parse_float"] = with_ctes(SHEET) + f"""
SELECT ticker, {_float('c_target')} AS revenue_multiple, {_float('c_emp')} AS employee_count,
       {_float('c_revenue')} AS revenue_as_float FROM sheet
"""

# name → (parsed expression); parser chosen by name hints / "$" presence
SHEET_FEATURES = [
    ("Last Quarter Revenue", _money("c_revenue")),
    ("YoY Growth%", _pct("c_yoy")),
    ("EBITDA Margin", _pct("c_margin")),
    ("Employee Count", _float("c_emp")),
    ("Total Debt", _money("c_debt")),
    ("IPO Year", _float("c_ipo")),
    ("Brand Rank", _float("c_brand")),
    ("Listed", _float("c_listed")),
    ("Sparse Metric", _float("c_sparse")),
]

PARSED = """
parsed AS (
  SELECT ticker, """ + ",\n         ".join(f'{e} AS "{n}"' for n, e in SHEET_FEATURES) + """
  FROM sheet WHERE """ + _float("c_target") + """ IS NOT NULL),
plong AS (
  SELECT ticker, feature, value FROM parsed
  UNPIVOT INCLUDE NULLS (value FOR feature IN (""" + ", ".join(f'"{n}"' for n, _ in SHEET_FEATURES) + """)))
"""

ORACLES["parse_dispatch"] = with_ctes(SHEET, PARSED) + "SELECT ticker, feature, CAST(value AS DOUBLE) AS value FROM plong"

ORACLES["valid_ratio"] = with_ctes(SHEET, PARSED) + """
SELECT feature, CAST(count(value) AS DOUBLE) / count(*) AS valid_ratio FROM plong GROUP BY feature
"""

KEPT = """
kept AS (SELECT feature FROM plong GROUP BY feature HAVING CAST(count(value) AS DOUBLE) / count(*) >= 0.7),
med AS (SELECT feature, median(value) AS m FROM plong GROUP BY feature),
filled AS (
  SELECT p.ticker, p.feature, COALESCE(p.value, m.m, 0.0) AS value
  FROM plong p JOIN kept k ON k.feature = p.feature JOIN med m ON m.feature = p.feature)
"""

ORACLES["impute_median"] = with_ctes(SHEET, PARSED, KEPT) + "SELECT ticker, feature, CAST(value AS DOUBLE) AS value FROM filled"

ORACLES["constant_columns"] = with_ctes(SHEET, PARSED, KEPT) + """
SELECT feature, stddev_samp(value) AS std, COALESCE(stddev_samp(value) <= 1e-12, true) AS is_constant
FROM filled GROUP BY feature
"""

SNAPSHOT = """
latest AS (
  SELECT f.* FROM (SELECT cik, max(report_date) AS mr FROM hist GROUP BY cik) j
  JOIN hist f ON f.cik = j.cik AND f.report_date = j.mr),
snap AS (SELECT l.*, c.ticker FROM latest l JOIN comp c USING (cik) WHERE l.report_date IS NOT NULL)
"""

STD_COLS = ["revenue_lq", "ebitda_lq", "net_income_lq", "cash_sti", "total_debt", "ebitda_margin",
            "net_income_margin", "revenue_ltm"]

ORACLES["standardize"] = with_ctes(HISTORY, CUSTOMER_COMPANIES, SNAPSHOT) + """
, med AS (SELECT """ + ", ".join(f"median({c}) AS m_{c}" for c in STD_COLS) + """ FROM snap),
filled AS (SELECT s.cik, s.report_date, """ + ", ".join(f"COALESCE(s.{c}, med.m_{c}, 0.0) AS {c}" for c in STD_COLS) + """
           FROM snap s CROSS JOIN med),
sc AS (SELECT """ + ", ".join(
    f"avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS std_{c}"
    for c in STD_COLS) + """ FROM filled)
SELECT cik, report_date, """ + ", ".join(f"({c} - mean_{c}) / std_{c} AS {c}" for c in STD_COLS) + """
FROM filled CROSS JOIN sc
"""

ORACLES["split_chronological"] = with_ctes(HISTORY) + """
, d AS (SELECT cik, report_date FROM hist WHERE report_date IS NOT NULL)
SELECT cik, report_date,
       CASE WHEN row_number() OVER (ORDER BY report_date, cik) <= CAST(floor((SELECT count(*) FROM d) * 0.8) AS BIGINT)
            THEN 'train' ELSE 'val' END AS split
FROM d
"""

ORACLES["ps_ratio"] = with_ctes(HISTORY, CUSTOMER_COMPANIES) + """
SELECT h.cik, h.report_date,
       CASE WHEN isfinite(c.last_price * h.shares_outstanding / h.revenue_ltm)
            THEN c.last_price * h.shares_outstanding / h.revenue_ltm END AS ps
FROM hist h LEFT JOIN comp c ON c.cik = h.cik
"""

ORACLES["teacher_join"] = with_ctes(HISTORY, CUSTOMER_COMPANIES, SNAPSHOT) + """
, teacher AS (SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker, max(o_totalprice) / 1000.0 AS pred
              FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT s.cik, s.ticker, s.report_date, t.pred AS teacher_pred
FROM snap s LEFT JOIN teacher t ON t.ticker = s.ticker
"""


LABELLED = """
lab AS (
  SELECT l_orderkey, l_linenumber, l_quantity AS actual, l_extendedprice * 0.0005 AS predicted,
         l_extendedprice AS price,
         CASE WHEN l_linestatus = 'F' THEN l_extendedprice * 0.0004 END AS teacher,
         CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS y_kd,
         l_shipdate >= TIMESTAMP '2001-01-01' AS holdout, l_extendedprice AS f_price
  FROM lineitem)
"""

ORACLES["regression_metrics"] = with_ctes(LABELLED) + """
, e AS (SELECT actual AS yd, predicted - actual AS err FROM lab),
a AS (SELECT sum(abs(err)) / count(*) AS mae, sqrt(sum(err * err) / count(*)) AS rmse,
             sum(err * err) AS sse, var_pop(yd) * count(*) AS sst,
             quantile_cont(abs(err), 0.5) AS median_ae, quantile_cont(abs(err), 0.9) AS p90_ae,
             quantile_cont(abs(err), 0.95) AS p95_ae,
             avg(CASE WHEN abs(yd) >= 1e-8 THEN abs(err) / abs(yd) END) * 100.0 AS mape_percent,
             count(*) AS n_test
      FROM e)
SELECT mae, rmse, CASE WHEN sst > 0 THEN 1.0 - sse / sst END AS r2, median_ae, p90_ae, p95_ae, mape_percent, n_test FROM a
"""

ORACLES["residual_histogram"] = with_ctes(LABELLED) + """
, r AS (SELECT predicted - actual AS r FROM lab),
g AS (SELECT min(r) AS lo, max(r) AS hi FROM r),
b AS (SELECT CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor((r - lo) / (hi - lo) * 30) AS BIGINT) + 1, 30) END AS bin,
             lo, hi FROM r CROSS JOIN g),
h AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(i AS INTEGER) AS bin, lo + (hi - lo) * (i - 1) / 30 AS lo_edge, lo + (hi - lo) * i / 30 AS hi_edge,
       COALESCE(n, 0) AS n
FROM range(1, 31) t(i) CROSS JOIN g LEFT JOIN h ON h.bin = t.i
"""

ORACLES["top_errors"] = with_ctes(LABELLED) + """
SELECT l_orderkey, l_linenumber, actual, predicted, abs(predicted - actual) AS abs_err
FROM lab ORDER BY abs_err DESC, l_orderkey, l_linenumber LIMIT 15
"""

ORACLES["clip_scale"] = with_ctes(LABELLED) + """
, q AS (SELECT quantile_cont(f_price, 0.05) AS lo, quantile_cont(f_price, 0.95) AS hi FROM lab)
SELECT l_orderkey, l_linenumber, f_price,
       CASE WHEN hi - lo <= 1e-12 THEN 40.0
            ELSE 20.0 + 100.0 * least(greatest((f_price - lo) / (hi - lo), 0.0), 1.0) END AS size
FROM lab CROSS JOIN q
"""

ORACLES["kd_loss"] = with_ctes(LABELLED) + """
, a AS (SELECT avg(abs(predicted - y_kd)) AS l1, avg(pow(predicted - teacher, 2)) AS mse FROM lab)
SELECT l1, mse, CASE WHEN l1 IS NOT NULL AND mse IS NOT NULL THEN 0.7 * l1 + 0.30000000000000004 * mse
                     ELSE COALESCE(l1, mse) END AS loss FROM a
"""

_M = [f"price * CAST({r} AS DOUBLE)" for r in ["0.0004", "0.00045", "0.0005", "0.00055", "0.0006"]]
ORACLES["ensemble_stats"] = with_ctes(LABELLED) + """
, m AS (SELECT l_orderkey, l_linenumber, (""" + " + ".join(_M) + """) / 5.0 AS pred_mean, """ + ", ".join(
    f"{e} AS m{i}" for i, e in enumerate(_M)) + """ FROM lab)
SELECT l_orderkey, l_linenumber, pred_mean,
       sqrt((""" + " + ".join(f"(m{i} - pred_mean) * (m{i} - pred_mean)" for i in range(5)) + """) / 5.0) AS pred_std FROM m
"""

ORACLES["sorted_parity"] = with_ctes(LABELLED) + """
SELECT l_orderkey, l_linenumber, actual, predicted,
       row_number() OVER (ORDER BY actual, l_orderkey, l_linenumber, predicted) AS rank
FROM lab WHERE holdout
"""


ORACLES["raw_facts_last4"] = with_ctes(AF) + """
SELECT cik, tag AS concept, unit, CAST("end" AS VARCHAR) AS "end", fy, fp, form, CAST(val AS DOUBLE) AS val,
       'null' AS dims
FROM facts WHERE namespace = 'us-gaap'
QUALIFY row_number() OVER (PARTITION BY cik, tag, unit ORDER BY pos DESC) <= 4
"""


# The fitted feature set on this sheet: "Listed" is constant and "Sparse Metric"
# is under the 70 % valid bar, so these seven survive (M1 rules).
SURVIVORS = ["Last Quarter Revenue", "YoY Growth%", "EBITDA Margin", "Employee Count", "Total Debt",
             "IPO Year", "Brand Rank"]

ORACLES["ticker_features"] = with_ctes(SHEET, PARSED) + """
, med AS (SELECT feature, median(value) AS m FROM plong GROUP BY feature),
allrows AS (SELECT ticker, """ + ", ".join(f'{e} AS "{n}"' for n, e in SHEET_FEATURES if n in SURVIVORS) + """ FROM sheet),
feats AS (
  SELECT ticker, """ + ",\n         ".join(
    f"""COALESCE("{n}", (SELECT m FROM med WHERE feature = '{n}'), 0.0) AS "{n}__num\"""" for n in SURVIVORS) + """
  FROM allrows),
req AS (SELECT DISTINCT ' p' || CAST(l_partkey AS VARCHAR) AS ticker FROM lineitem)
SELECT r.ticker, """ + ", ".join(f'f."{n}__num"' for n in SURVIVORS) + """
FROM req r LEFT JOIN feats f ON upper(trim(f.ticker)) = upper(trim(r.ticker))
"""


# One row a quarter (the newest filed), the fourth quarter from the year where it wasn't filed.
ORACLES["metric_calendar"] = with_ctes(AF, REVENUE_SERIES) + """
, filed AS (
  SELECT cik, metric, fy, CASE WHEN form = '10-Q' THEN fp ELSE 'FY' END AS part, val, "end", pos FROM flow_series
  WHERE fy IS NOT NULL AND val IS NOT NULL
    AND ((form = '10-Q' AND fp IN ('Q1', 'Q2', 'Q3', 'Q4')) OR (form = '10-K' AND fp = 'FY'))
  QUALIFY row_number() OVER (PARTITION BY cik, metric, fy, part
                             ORDER BY "end" DESC NULLS LAST, pos DESC NULLS LAST, val DESC) = 1),
derived AS (
  SELECT y.cik, y.metric, y.fy, 'Q4' AS part, y.val - q.s AS val
  FROM filed y JOIN (SELECT cik, metric, fy, sum(val) AS s, count(*) AS n FROM filed
                     WHERE part IN ('Q1', 'Q2', 'Q3') GROUP BY cik, metric, fy) q USING (cik, metric, fy)
  WHERE y.part = 'FY' AND q.n = 3
    AND NOT EXISTS (SELECT 1 FROM filed f WHERE f.cik = y.cik AND f.metric = y.metric AND f.fy = y.fy AND f.part = 'Q4')),
quarters AS (
  SELECT cik, metric, val, fy * 4 + CAST(substr(part, 2) AS INTEGER) - 1 AS qi
  FROM (SELECT cik, metric, fy, part, val FROM filed WHERE part <> 'FY' UNION ALL SELECT * FROM derived)),
newest AS (SELECT cik, metric, max(qi) AS top FROM quarters GROUP BY cik, metric)
SELECT n.cik, n.metric, CAST(a.val AS DOUBLE) AS lq,
       (SELECT CASE WHEN count(*) = 4 THEN CAST(sum(q.val) AS DOUBLE) END FROM quarters q
        WHERE q.cik = n.cik AND q.metric = n.metric AND q.qi > n.top - 4) AS ltm,
       CASE WHEN CAST(p.val AS DOUBLE) <> 0
            THEN (CAST(a.val AS DOUBLE) - CAST(p.val AS DOUBLE)) / CAST(p.val AS DOUBLE) * 100.0 END AS yoy
FROM newest n JOIN quarters a ON a.cik = n.cik AND a.metric = n.metric AND a.qi = n.top
LEFT JOIN quarters p ON p.cik = n.cik AND p.metric = n.metric AND p.qi = n.top - 4
"""

# Customers as filers (``sources/filers.py``): what they file, and their figures by tier.
FILERS = """
cu AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_custkey AS k, c_nationkey AS n, c_mktsegment AS seg,
              c_acctbal AS bal FROM customer),
oq AS (
  SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(quarter(o_orderdate) AS INTEGER) AS q,
         SUM(CASE WHEN o_orderpriority = '5-LOW' THEN -p ELSE p END) AS rev,
         SUM(CASE o_orderstatus WHEN 'F' THEN 2 * p WHEN 'O' THEN -p ELSE p END) AS oi,
         SUM(CASE o_orderstatus WHEN 'F' THEN p WHEN 'O' THEN -p ELSE 3 * p END) AS ni,
         SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN p END) AS urgent,
         SUM(CASE WHEN o_orderpriority <> '1-URGENT' THEN p END) AS other,
         SUM(p) AS total, CAST(COUNT(*) AS DECIMAL(18,2)) AS cnt
  FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders) GROUP BY ALL),
oy AS (
  SELECT cu.cik, cu.n, cu.seg, o.yr, o.q, o.urgent, o.other, o.cnt,
         SUM(o.rev) OVER w AS rev, SUM(o.oi) OVER w AS oi, SUM(o.ni) OVER w AS ni, SUM(o.total) OVER w AS total,
         SUM(o.cnt) OVER w * 100 AS da
  FROM oq o JOIN cu ON cu.k = o.k AND cu.bal >= 0
  WINDOW w AS (PARTITION BY o.k, o.yr ORDER BY o.q ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
filed AS (SELECT *, CASE WHEN q = 4 THEN 'FY' ELSE 'Q' || q END AS p FROM oy WHERE seg <> 'HOUSEHOLD' OR q = 4),
ff AS (
  SELECT *, 'RevenueFromContractWithCustomerExcludingAssessedTax' AS tag, rev AS v, q AS qtrs, p AS fp
  FROM filed WHERE n % 8 = 0
  UNION ALL SELECT *, 'Revenues', rev, q, p FROM filed WHERE n % 8 = 1 OR (n % 8 = 5 AND yr < 1997)
  UNION ALL SELECT *, 'SalesRevenueNet', rev, q, p FROM filed WHERE n % 8 IN (2, 5)
  UNION ALL SELECT *, 'SalesRevenueGoodsNet', rev, q, p FROM filed WHERE n % 8 = 3
  UNION ALL SELECT *, 'SalesRevenueServicesAndOtherNet', rev, q, p FROM filed WHERE n % 8 = 4
  UNION ALL SELECT *, 'EarningsBeforeInterestTaxesDepreciationAndAmortization', total, q, p FROM filed WHERE n % 3 = 0
  UNION ALL SELECT *, 'OperatingIncomeLoss', oi, q, p FROM filed
  UNION ALL SELECT *, 'DepreciationAndAmortization', da, q, p FROM filed WHERE n % 3 <> 2
  UNION ALL SELECT *, 'NetIncomeLoss', ni, q, p FROM filed WHERE n % 8 <> 7
  UNION ALL SELECT *, 'CashCashEquivalentsAndShortTermInvestments', total, NULL, p FROM filed WHERE n % 2 = 0
  UNION ALL SELECT *, 'CashAndCashEquivalentsAtCarryingValue', urgent, NULL, p FROM filed WHERE n % 4 IN (1, 2)
  UNION ALL SELECT *, 'ShortTermInvestments', other, NULL, p FROM filed WHERE n % 4 IN (1, 2)
  UNION ALL SELECT *, 'LongTermDebtNoncurrent', other, NULL, p FROM filed WHERE n % 2 = 0
  UNION ALL SELECT *, 'LongTermDebtCurrent', urgent, NULL, p FROM filed WHERE n % 2 = 1
  UNION ALL SELECT *, 'ShortTermBorrowings', cnt * 7, NULL, p FROM filed WHERE n % 2 = 1
  UNION ALL SELECT *, 'CommonStockSharesOutstanding', cnt * 1000, NULL, p FROM filed WHERE n % 3 <> 1
  UNION ALL SELECT *, 'EntityCommonStockSharesOutstanding', cnt * 3000, NULL, p FROM filed WHERE n % 3 <> 0
  UNION ALL SELECT *, 'ContractWithCustomerLiabilityCurrent', cnt * 11, NULL, CASE WHEN n <> 13 THEN p END
            FROM filed WHERE n % 5 IN (0, 3) AND q IN (1, 3)
  UNION ALL SELECT *, 'ContractWithCustomerLiabilityNoncurrent', cnt * 13, NULL, CASE WHEN n <> 13 THEN p END
            FROM filed WHERE n % 5 IN (0, 3)
  UNION ALL SELECT *, 'DeferredRevenueCurrent', cnt * 17, NULL, p FROM filed WHERE n % 5 IN (1, 3)
  UNION ALL SELECT *, 'DeferredRevenueNoncurrent', cnt * 19, NULL, p FROM filed WHERE n % 5 IN (1, 3) AND q > 2
  UNION ALL SELECT *, 'DeferredRevenue', cnt * 23, NULL, p FROM filed WHERE n % 5 IN (2, 3)),
roles(metric, rnk, tag, kind, out_tag) AS (VALUES
  ('revenue', 1, 'RevenueFromContractWithCustomerExcludingAssessedTax', 'flow', NULL), ('revenue', 2, 'Revenues', 'flow', NULL),
  ('revenue', 3, 'SalesRevenueNet', 'flow', NULL), ('revenue', 4, 'SalesRevenueGoodsNet', 'flow', NULL),
  ('revenue', 5, 'SalesRevenueServicesAndOtherNet', 'flow', NULL),
  ('ebitda', 1, 'EarningsBeforeInterestTaxesDepreciationAndAmortization', 'flow', NULL),
  ('ebitda', 2, 'OperatingIncomeLoss', 'left', NULL), ('ebitda', 2, 'DepreciationAndAmortization', 'right', NULL),
  ('net_income', 1, 'NetIncomeLoss', 'flow', NULL), ('operating_income', 1, 'OperatingIncomeLoss', 'point', NULL),
  ('cash', 1, 'CashCashEquivalentsAndShortTermInvestments', 'point', NULL),
  ('cash', 2, 'CashAndCashEquivalentsAtCarryingValue', 'sum', 'CashAndCashEquivalentsAtCarryingValue(+ShortTermInvestments)'),
  ('cash', 2, 'ShortTermInvestments', 'sum', 'CashAndCashEquivalentsAtCarryingValue(+ShortTermInvestments)'),
  ('debt', 1, 'LongTermDebtNoncurrent', 'sum', 'LongTermDebtNoncurrent+LongTermDebtCurrent+ShortTermBorrowings'),
  ('debt', 1, 'LongTermDebtCurrent', 'sum', 'LongTermDebtNoncurrent+LongTermDebtCurrent+ShortTermBorrowings'),
  ('debt', 1, 'ShortTermBorrowings', 'sum', 'LongTermDebtNoncurrent+LongTermDebtCurrent+ShortTermBorrowings'),
  ('shares', 1, 'CommonStockSharesOutstanding', 'point', NULL), ('shares', 2, 'EntityCommonStockSharesOutstanding', 'point', NULL),
  ('deferred_revenue', 1, 'ContractWithCustomerLiabilityCurrent', 'sum', 'DeferredRevenue(Total)'),
  ('deferred_revenue', 1, 'ContractWithCustomerLiabilityNoncurrent', 'sum', 'DeferredRevenue(Total)'),
  ('deferred_revenue', 2, 'DeferredRevenueCurrent', 'sum', 'DeferredRevenue(Total)'),
  ('deferred_revenue', 2, 'DeferredRevenueNoncurrent', 'sum', 'DeferredRevenue(Total)'),
  ('deferred_revenue', 3, 'DeferredRevenue', 'point', NULL)),
chosen AS (
  SELECT f.cik, r.metric, r.kind, f.tag, r.out_tag, f.yr, f.q, f.fp, f.qtrs, CAST(f.v AS DECIMAL(30,4)) AS v,
         CASE WHEN f.seg = 'MACHINERY' THEN '20-F' WHEN f.q = 4 THEN '10-K' ELSE '10-Q' END AS form
  FROM ff f JOIN roles r USING (tag) WHERE f.v IS NOT NULL
  QUALIFY r.rnk = min(r.rnk) OVER (PARTITION BY f.cik, r.metric)),
single AS (
  SELECT *, CASE WHEN kind IN ('flow', 'left', 'right') AND lag(qtrs) OVER w = qtrs - 1 THEN v - lag(v) OVER w ELSE v END AS val
  FROM chosen WHERE kind <> 'sum'
  WINDOW w AS (PARTITION BY cik, metric, tag, form, yr ORDER BY q)),
rowset AS (
  SELECT cik, metric, tag, form, yr, q, fp, val, kind FROM single WHERE kind IN ('flow', 'point')
  UNION ALL
  SELECT a.cik, a.metric, 'OperatingIncomeLoss+DepreciationAndAmortization', a.form, a.yr, a.q, a.fp, a.val + b.val, 'flow'
  FROM single a JOIN single b USING (cik, metric, form, yr, q) WHERE a.kind = 'left' AND b.kind = 'right'
  UNION ALL
  SELECT cik, metric, out_tag, form, yr, q, fp, SUM(v), 'point' FROM chosen
  WHERE kind = 'sum' AND fp IS NOT NULL GROUP BY ALL),
best_form AS (
  SELECT *, CASE form WHEN '10-Q' THEN 1 WHEN '10-K' THEN 2 ELSE 3 END AS ft FROM rowset
  QUALIFY ft = min(ft) OVER (PARTITION BY cik, metric)),
numbered AS (SELECT *, CAST(val AS DOUBLE) AS d, row_number() OVER (PARTITION BY cik, metric ORDER BY yr DESC, q DESC) AS rn
             FROM best_form),
fig AS (
  SELECT cik, metric, max(d) FILTER (rn = 1) AS lq, max(d) FILTER (rn = 1) * 4.0 AS annualized,
         CASE WHEN count(*) >= 4 THEN CAST(sum(val) FILTER (rn <= 4) AS DOUBLE) END AS ltm,
         CASE WHEN max(d) FILTER (rn = 5) <> 0 THEN
              (max(d) FILTER (rn = 1) - max(d) FILTER (rn = 5)) / max(d) FILTER (rn = 5) * 100.0 END AS yoy,
         max(tag) FILTER (rn = 1) AS tag, max(form) FILTER (rn = 1) AS form, max(yr) FILTER (rn = 1) AS yr,
         max(q) FILTER (rn = 1) AS q, max(fp) FILTER (rn = 1) AS fp
  FROM numbered GROUP BY cik, metric),
last_filed AS (SELECT o_custkey AS k, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS d FROM orders GROUP BY 1),
wide AS (
  SELECT cu.cik,
         COALESCE(CAST(last_day(make_date(COALESCE(r.yr, ni.yr, oi.yr), COALESCE(r.q, ni.q, oi.q) * 3, 1)) AS VARCHAR), lf.d)
           AS report_date,
         COALESCE(r.yr, ni.yr, oi.yr) AS fiscal_year, COALESCE(r.fp, ni.fp, oi.fp) AS fiscal_period,
         r.lq AS revenue_lq, r.annualized AS revenue_annualized, r.ltm AS revenue_ltm, r.yoy AS revenue_yoy,
         e.lq AS ebitda_lq, e.annualized AS ebitda_annualized, e.ltm AS ebitda_ltm, e.yoy AS ebitda_yoy,
         CASE WHEN (e.yr, e.q, e.form) = (r.yr, r.q, r.form) AND r.lq > 0 AND abs(e.lq / r.lq * 100.0) <= 100
              THEN e.lq / r.lq * 100.0 END AS ebitda_margin,
         ni.lq AS net_income_lq, ni.annualized AS net_income_annualized, ni.ltm AS net_income_ltm, ni.yoy AS net_income_yoy,
         CASE WHEN (ni.yr, ni.q, ni.form) = (r.yr, r.q, r.form) AND r.lq > 0 AND abs(ni.lq / r.lq * 100.0) <= 100
              THEN ni.lq / r.lq * 100.0 END AS net_income_margin,
         CAST(NULL AS DOUBLE) AS gross_profit_lq, CAST(NULL AS DOUBLE) AS gross_margin,
         CAST(NULL AS DOUBLE) AS operating_income_lq, CAST(NULL AS DOUBLE) AS operating_margin,
         CAST(NULL AS DOUBLE) AS cfo_lq, CAST(NULL AS DOUBLE) AS capex_lq, CAST(NULL AS DOUBLE) AS fcf_lq,
         ca.lq AS cash_sti, de.lq AS total_debt, sh.lq AS shares_outstanding,
         CASE WHEN cu.bal > 1000 THEN cu.bal END AS stock_price,
         CASE WHEN cu.bal > 1000 THEN cu.bal * sh.lq END AS market_cap, dr.lq AS deferred_revenue
  FROM cu LEFT JOIN last_filed lf ON lf.k = cu.k
  LEFT JOIN fig r ON r.cik = cu.cik AND r.metric = 'revenue' LEFT JOIN fig e ON e.cik = cu.cik AND e.metric = 'ebitda'
  LEFT JOIN fig ni ON ni.cik = cu.cik AND ni.metric = 'net_income'
  LEFT JOIN fig oi ON oi.cik = cu.cik AND oi.metric = 'operating_income'
  LEFT JOIN fig ca ON ca.cik = cu.cik AND ca.metric = 'cash' LEFT JOIN fig de ON de.cik = cu.cik AND de.metric = 'debt'
  LEFT JOIN fig sh ON sh.cik = cu.cik AND sh.metric = 'shares'
  LEFT JOIN fig dr ON dr.cik = cu.cik AND dr.metric = 'deferred_revenue')
"""

ORACLES["fundamentals_tiers"] = with_ctes(FILERS) + "SELECT * FROM wide"

ORACLES["audit_tiers"] = with_ctes(FILERS) + """
SELECT f.cik, w.report_date, w.fiscal_year, w.fiscal_period,
       CASE f.metric WHEN 'cash' THEN 'cash_sti' WHEN 'debt' THEN 'total_debt' WHEN 'shares' THEN 'shares_outstanding'
                     WHEN 'deferred_revenue' THEN 'deferred_revenue' ELSE f.metric || '_lq' END AS metric,
       f.lq AS value, f.tag AS source_tag, CASE WHEN f.metric = 'shares' THEN 'shares' ELSE 'USD' END AS unit,
       CAST(0 AS INTEGER) AS scale_applied, f.form, f.yr AS fy, f.fp
FROM fig f JOIN wide w USING (cik) WHERE f.metric <> 'operating_income'
"""

SUBMISSIONS = """
filing AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
         row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) - 1 AS pos,
         CASE o_orderpriority WHEN '1-URGENT' THEN '10-K' WHEN '2-HIGH' THEN '10-Q' WHEN '3-MEDIUM' THEN 'S-1' ELSE '8-K' END AS form,
         lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '-' || strftime(o_orderdate, '%y') || '-'
           || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') AS accession,
         'd' || o_orderkey || '.htm' AS document, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filing_date
  FROM orders)
"""

ORACLES["submissions_scan"] = with_ctes(SUBMISSIONS) + """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN c_acctbal >= 0 THEN c_name ELSE 'operating' END AS name,
       CASE WHEN c_nationkey > 0 THEN CAST(c_nationkey AS VARCHAR) END AS business_state, c_mktsegment AS state_incorp,
       CAST(c_nationkey AS VARCHAR) AS sic, CAST(NULL AS VARCHAR) AS sic_description, '1231' AS fiscal_year_end,
       f.pos, f.form, f.accession, f.document, f.filing_date
FROM customer LEFT JOIN filing f ON f.cik = lpad(CAST(c_custkey AS VARCHAR), 10, '0')
"""

ORACLES["companies_both"] = """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik,
       c_acctbal >= 0 AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                                  AND (c_mktsegment <> 'HOUSEHOLD' OR quarter(o_orderdate) = 4)) AS loaded
FROM customer
"""

ORACLES["directory_scan"] = ORACLES["symbol_filter"]
