import random

import brute
import pytest

from ledgerline.llm import simhash


def test_documents_match_brute_force(make, documents):
    more = make([(700001, None), (700002, ""), (700003, "one two"), (None, "one two"), (700005, "ONE two"), (700005, "ONE two"), (700007, "Ö ö " * 30000)])
    docs = documents.unionByName(more)
    got = simhash.near_duplicates(docs).collect()
    prints = [(brute.fingerprint(r["text"]), r["doc_id"]) for r in docs.collect()]
    comp = brute.components(prints)
    assert sorted(((f"{f:016x}", i, comp[f]) for f, i in prints), key=str) == sorted(((r["fingerprint"], r["doc_id"], r["component_id"]) for r in got), key=str)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(comp.values()))


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_loses_no_link(spark, seed):
    """Clusters and chains of fingerprints with leaves of a few rows: all eight levels are used."""
    rnd = random.Random(seed)
    fps = []
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(40):
            fps.append(x)
            x ^= 1 << rnd.randrange(64)
            if rnd.random() < .7:
                x ^= 1 << rnd.randrange(64)
            if rnd.random() < .1:
                x = rnd.getrandbits(64)
    pairs = [(f - (1 << 64) if f >= 1 << 63 else f, i) for i, f in enumerate(fps)]
    df = spark.createDataFrame(pairs, "fp long, id long")
    want = brute.components([(f & (1 << 64) - 1, i) for f, i in pairs])
    for leaf in (2, 50, 4096):
        got = {r["fp"] & (1 << 64) - 1: r["component_id"] for r in simhash.components(df, leaf_rows=leaf).collect()}
        assert got == want


def test_empty_and_extra_columns(make):
    none = make([]).selectExpr("*", "1 AS fp", "2 AS `__row`")
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0
    two = make([(2, "a b c d"), (1, "a b c d"), (1, "a b c d")]).selectExpr("*", "1 AS fp", "2 AS `__row`", "3 AS id")
    assert [r["doc_id"] for r in simhash.drop_near_duplicates(two).collect()] == [1]
