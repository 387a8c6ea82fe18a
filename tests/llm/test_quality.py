from collections import Counter

import brute

from ledgerline.llm import quality

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rows(df):
    return [(r["doc_id"], r["quality"]) for r in df.collect()]


def test_statistics_votes_and_posterior_match_brute_force(make, documents):
    texts = [(900001, None), (900002, ""), (900003, " \t\n\x0b "), (900004, "a b c d e f g h " * 5), (900005, "x\ny\nx\n \n \nx #$|"),
             (900005, "x\ny\nx\n \n \nx #$|"), (None, "the same " * 4000), (900007, "w" * 100000)]
    docs = documents.unionByName(make(texts))
    got = rows(quality.label(docs, carry=["doc_id", "text"]).select("doc_id", "quality"))
    want = {(r["doc_id"], r["text"]): brute.quality(r["text"]) for r in docs.collect()}
    assert sorted(tuple(q[s] for s in STATS) for _, q in got) == sorted(tuple(w[s] for s in STATS) for r in docs.collect() for w in [want[r["doc_id"], r["text"]]])
    patterns = Counter(tuple(q["votes"]) for _, q in got)
    p = brute.em(patterns, quality.ON_GOOD, quality.ON_BAD, quality.TOLERANCE, quality.MAX_STEPS)
    for _, q in got:
        assert q["base_failed"] == (q["n_words"] < 20 or 100 * q["n_repeat_words"] > 30 * q["n_words"])
        assert abs(q["p_good"] - p[tuple(q["votes"])]) < 1e-6
        assert q["kept"] == (not q["base_failed"] and q["p_good"] >= 0.5)


def test_rules_agree_with_labels(spark, documents, sf_dir):
    """Held-out quality labels, never used by the operator: kept documents are mostly good ones."""
    q = quality.label(documents, carry=["doc_id"]).select("doc_id", "quality.kept")
    r = q.join(spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality IS NOT NULL"), "doc_id").collect()
    good = [x["kept"] for x in r if x["quality"] == 1]
    assert sum(good) >= 0.9 * len(good)


def test_empty_extra_and_clashing_columns(spark, make):
    none = make([]).selectExpr("*", "1 AS quality", "2 AS `__raw`", "3 AS `a.b`")
    assert quality.label(none).count() == 0 and quality.keep_good(none).columns == none.columns
    some = make([(1, "Plain words of a sentence that is long enough to be kept by every rule that looks at it. " * 1 + "More of them follow here, and they differ.")])
    some = some.selectExpr("*", "1 AS quality", "2 AS `__raw`", "3 AS `a.b`")
    assert quality.keep_good(some).collect() == some.collect()
