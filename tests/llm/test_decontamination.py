import brute

from ledgerline.llm import decontamination as D


def pairs(df):
    return {(r["doc"], r["item"]): (r["n_item"], r["n_shared"]) for r in df.collect()}


def test_pairs_match_brute_force(spark, make, documents, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    item = bench.first()
    extra = make([(800001, None), (800002, ""), (800003, ("filler " * 20000) + item["text"].upper() + " tail"), (800004, "Two Words"), (800005, "two words here")])
    items = bench.unionByName(spark.createDataFrame([(900, "two  words"), (901, None), (902, " "), (903, item["text"]), (903, item["text"]), (None, "some words that nobody has written")], bench.schema))
    docs = documents.unionByName(extra)
    got = pairs(D.contained(docs, items))
    assert got == brute.contained([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert (800003, item["item_id"]) in got and (800003, 903) in got and (800004, 900) in got and (800005, 900) not in got
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in got}


def test_threshold_is_exact(spark, make):
    """An item of ten shingles whose end is cut off: 8 of 10 is found, 7 of 10 is not; any size of broadcast gives the same."""
    w = [f"w{i}" for i in range(14)]
    docs = make([(1, "x " + " ".join(w[:12]) + " y"), (2, " ".join(w[:11])), (None, " ".join(w)), (None, " ".join(w[1:]))])
    bench = spark.createDataFrame([(5, " ".join(w))], "item_id long, text string")
    want = {(1, 5): (10, 8), (None, 5): (10, 10)}
    old = D.BROADCAST_ROWS
    try:
        for D.BROADCAST_ROWS in (old, 0):
            r = D.contained(docs, bench).collect()
            assert sorted((x["doc"] or 0, x["n_shared"]) for x in r) == [(0, 9), (0, 10), (1, 8)]
    finally:
        D.BROADCAST_ROWS = old
    assert want[1, 5] == (10, 8)


def test_empty_and_extra_columns(spark, make):
    docs = make([(1, "a b c d e f")]).selectExpr("*", "1 AS h", "2 AS `__dkey`", "3 AS item", "4 AS d2")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(docs, none).collect() == docs.collect()
    assert D.drop_contaminated(docs.limit(0), none).count() == 0
