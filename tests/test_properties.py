"""Property tests: YTD round trip, histogram totals, repartition invariance."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.analytics import margin_histogram
from ledgerline.operators.series import to_quarterly_col

QUARTERS = st.lists(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=3), min_size=1, max_size=40)


@settings(max_examples=3, deadline=None)
@given(QUARTERS, st.booleans())
def test_ytd_round_trip(spark, companies, with_qtrs):
    """Year-to-date rows built from known quarters must de-accumulate to the quarters."""
    rows, expect = [], {}
    for c, qs in enumerate(companies):
        ytd = 0
        for i, v in enumerate(qs, start=1):
            ytd += v
            rows.append((str(c), "revenue", "t", "10-Q", 2020, f"2020-0{3 * i}-28", i, i if with_qtrs else None,
                         f"Q{i}", float(ytd)))
            expect[(str(c), i)] = float(v)
    random.Random(len(rows)).shuffle(rows)
    df = spark.createDataFrame(rows, "cik string, metric string, tag string, form string, fy int, end string, "
                                     "pos long, qtrs int, fp string, val double").repartition(7)
    got = {(r.cik, r.pos): r.q for r in df.select("cik", "pos", to_quarterly_col().alias("q")).collect()}
    assert got == expect


def test_histogram_counts_sum(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 401 - 200).cast("double").alias("ebitda_margin"))
    h = margin_histogram(df)
    assert sum(r.n for r in h.collect()) == 5000


def test_summary_repartition_invariant(spark, sf_dir):
    from ledgerline import schemas as S
    from ledgerline.operators import metrics as M
    from ledgerline.operators.series import resolve_series
    from ledgerline.sources import driver as D
    facts = D.lineitem_facts(spark, sf_dir)
    mm = S.metric_map(spark, M.FLOW_METRICS)

    def run(f):
        return sorted(tuple(r) for r in M.metric_summary(
            resolve_series(f, mm, S.map_kinds(M.FLOW_METRICS))).select("cik", "metric", "lq", "ltm", "yoy").collect())
    base = run(facts)
    assert run(facts.repartition(1)) == base
    assert run(facts.repartition(64)) == base
